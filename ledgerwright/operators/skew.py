"""Salting for joins whose hot keys AQE cannot split.

AQE splits a skewed shuffle partition of a sort-merge join only when both
children are plain shuffles. When one side is an aggregate of the other on the
same keys (per-group statistics joined back to their rows), that side arrives
already partitioned by the aggregate and a hot group's rows would all meet in
one task. Hot keys are salted instead:

* a key is hot when its row count exceeds ``hot_rows``. There are at most
  ``rows / hot_rows`` such keys, so they are broadcast: left to the planner, the
  large side would be shuffled for them before their size is known;
* a hot key gets ``ceil(rows of the key / hot_rows)`` salts, at least two. Its
  rows on the large side get a deterministic salt from their own id, and the
  key's single statistics row is replicated once per salt; every other key
  keeps salt 0 and one copy.

A task then joins about ``hot_rows`` rows of a hot key, however many it has,
and nothing else is replicated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 2_000_000   # rows one join task should handle for a single key
COUNT_BUCKETS = 65_536         # keys are first counted by bucket; only keys of crowded buckets are counted one by one


def _salts(count: Column, hot_rows: int, salts: int | None) -> Column:
    """Salts of a hot key with ``count`` rows."""
    return (F.lit(salts) if salts else F.greatest(F.ceil(count / F.lit(hot_rows)), F.lit(2))).cast("bigint")


def _salted(large: DataFrame, fanned: DataFrame, hot: DataFrame, keys: Sequence[str], salt_by: Sequence[str], how: str) -> DataFrame:
    """``large`` joined with ``fanned``, which has one copy per salt of a key; ``hot`` is (keys, __hot)."""
    salt = F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(*[F.col(c) for c in salt_by]), F.col("__hot"))) \
        .otherwise(F.lit(0).cast("bigint"))
    salted = large.join(F.broadcast(hot), list(keys), "left").withColumn("__salt", salt).drop("__hot")
    return salted.join(fanned, [*keys, "__salt"], how).drop("__salt")


def _fan(salts: Column) -> Column:
    """One copy per salt; a NULL number of salts is one copy."""
    return F.explode(F.when(salts.isNotNull(), F.sequence(F.lit(0).cast("bigint"), salts - 1))
                     .otherwise(F.array(F.lit(0).cast("bigint"))))


def salted_join(large: DataFrame, small: DataFrame, keys: Sequence[str], salt_by: Sequence[str],
                count_column: str, hot_rows: int = DEFAULT_HOT_ROWS, salts: int | None = None,
                how: str = "inner") -> DataFrame:
    """``large.join(small, keys, how)`` with each hot key spread over tasks by its row count.

    ``salts`` fixes the number of salts of every hot key instead.

    ``small`` has one row per key and ``count_column`` = that key's number of
    rows in ``large``. ``salt_by`` are columns of ``large`` that vary within a
    key (a row id); the salt is their hash, so reruns place every row alike.
    """
    spread = F.when(F.col(count_column) > F.lit(hot_rows), _salts(F.col(count_column), hot_rows, salts))
    hot = small.select(*keys, spread.alias("__hot")).filter(F.col("__hot").isNotNull())
    return _salted(large, small.withColumn("__salt", _fan(spread)), hot, keys, salt_by, how)


def hot_keys(large: DataFrame, keys: Sequence[str], hot_rows: int = DEFAULT_HOT_ROWS, buckets: int = COUNT_BUCKETS) -> DataFrame:
    """The keys with more than ``hot_rows`` rows in ``large``, and their number of rows ``__n``.

    A hot key makes its bucket of keys crowded, so rows are counted by bucket, and then by
    key where the bucket is crowded: almost nothing is shuffled while no key is hot. There
    are at most ``rows / hot_rows`` crowded buckets and hot keys.
    """
    rows = large.select(*keys).where(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    crowded = (rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
               .select("__bucket"))
    return (rows.join(F.broadcast(crowded), "__bucket", "left_semi").groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows))


def counted_salted_join(large: DataFrame, small: DataFrame, keys: Sequence[str], salt_by: Sequence[str],
                        hot_rows: int = DEFAULT_HOT_ROWS, salts: int | None = None,
                        how: str = "inner", measures: Sequence[Column] = ()) -> DataFrame:
    """:func:`salted_join` for a ``small`` side that does not know its keys' row counts.

    With ``measures``, ``small`` has many rows per key and is joined as ``groupBy(keys).agg(measures)``:
    its rows are fanned first, so that the aggregate's shuffle by key and salt is the join's.

    The hot keys are found by :func:`hot_keys` and broadcast to both sides, so the join
    shuffles each side once, whatever the number of keys.
    """
    hot = hot_keys(large, keys, hot_rows).select(*keys, _salts(F.col("__n"), hot_rows, salts).alias("__hot"))
    fanned = small.join(F.broadcast(hot), list(keys), "left").withColumn("__salt", _fan(F.col("__hot"))).drop("__hot")
    if measures:
        fanned = fanned.groupBy(*keys, "__salt").agg(*measures)
    return _salted(large, fanned, hot, keys, salt_by, how)
