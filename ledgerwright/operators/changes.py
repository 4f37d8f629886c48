"""Row differences between a stored table and the rows of a new load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of the values, a NULL told from every value and from a NULL elsewhere."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str],
                keep: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks, or holds with other values in ``compare``.

    Added is ``change`` (added or changed). A changed row has the stored values of the
    ``keep`` columns. ``keys`` are unique in both tables and NULL equals NULL in them. Of
    ``old`` only keys, a hash and the kept columns are read; both sides meet in one aggregate
    on the keys, without a join. Keys gone from ``new`` are no change.
    """
    kept = F.struct(row_hash(compare).alias("hash"), *[F.col(c) for c in keep])
    row = F.struct(*[F.col(c) for c in new.columns])
    before = old.select(*keys, kept.alias("__old"))
    after = new.select(*keys, row_hash(compare).alias("__hash"), row.alias("__new"))
    met = (before.unionByName(after, allowMissingColumns=True).groupBy(*keys)
           .agg(F.max("__old").alias("__old"), F.max("__hash").alias("__hash"), F.max("__new").alias("__new")))
    found = met.where(F.col("__new").isNotNull() & (F.col("__old").isNull() | (F.col("__old.hash") != F.col("__hash"))))
    was = F.col("__old").isNotNull()
    return found.select(*[F.when(was, F.col(f"__old.{c}")).otherwise(F.col(f"__new.{c}")).alias(c) if c in keep
                          else F.col(f"__new.{c}").alias(c) for c in new.columns],
                        F.when(was, F.lit("changed")).otherwise(F.lit("added")).alias("change"))
