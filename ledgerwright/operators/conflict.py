"""Write conflict policies as DataFrame algebra (no MERGE needed).

Each policy takes the current ``target`` and an incoming ``batch`` and returns
the next version of the target. The caller writes that version to a *new*
location (see :mod:`ledgerwright.operators.tables`); a path is never overwritten
while it is being read. Every policy first makes the batch unique on the key
with a total order, so the result does not depend on row order or partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import first_by, last_by


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Plain append (no key)."""
    return target.unionByName(batch.select(*target.columns))


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                     order: Sequence[str | Column]) -> DataFrame:
    """``INSERT .. ON CONFLICT (keys) DO NOTHING``: the first row per new key is added,
    existing keys keep their row."""
    fresh = first_by(batch.select(*target.columns), keys, order)
    return target.unionByName(fresh.join(target.select(*keys), list(keys), "left_anti"))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column]) -> DataFrame:
    """``INSERT .. ON CONFLICT (keys) DO UPDATE``: the last batch row per key replaces the
    target row; other target rows stay."""
    newest = last_by(batch.select(*target.columns), keys, order)
    kept = target.join(newest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(newest)


def upsert_partial(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                   update: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Upsert that replaces only the ``update`` columns of existing rows.

    Untouched columns keep the target's value; new keys take the batch's value
    for every column.
    """
    newest = last_by(batch.select(*target.columns), keys, order)
    t, b = target.alias("t"), newest.alias("b")
    cond = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]
    j = t.join(b, cond, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"b.{c}")).alias(c))
        elif c in update:
            out.append(F.when(F.col(f"b.{keys[0]}").isNotNull(), F.col(f"b.{c}"))
                        .otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col(f"t.{keys[0]}").isNotNull(), F.col(f"t.{c}"))
                        .otherwise(F.col(f"b.{c}")).alias(c))
    return j.select(*out)


def _tagged(batches: Sequence[DataFrame]) -> DataFrame:
    cols = batches[0].columns
    out = None
    for i, b in enumerate(batches):
        b = b.select(*cols, F.lit(i).alias("__batch"))
        out = b if out is None else out.unionByName(b)
    return out


def insert_if_absent_all(batches: Sequence[DataFrame], keys: Sequence[str],
                         order: Sequence[str | Column]) -> DataFrame:
    """``insert_if_absent`` of ``batches`` in sequence, computed in one pass.

    A key keeps the first row of the earliest batch that has it, i.e. the
    first row by (batch number, order): one shuffle instead of one per batch.
    """
    return first_by(_tagged(batches), keys, ["__batch", *order]).drop("__batch")


def upsert_all(batches: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``upsert`` of ``batches`` in sequence, computed in one pass: the last row by (batch, order)."""
    return last_by(_tagged(batches), keys, ["__batch", *order]).drop("__batch")


def upsert_partial_all(batches: Sequence[DataFrame], keys: Sequence[str], update: Sequence[str],
                       order: Sequence[str]) -> DataFrame:
    """``upsert_partial`` of ``batches`` in sequence, computed in one ``groupBy``.

    Per key, the ``update`` columns come from the last row by (batch, order);
    every other column comes from the batch that first had the key (its last
    row by order), exactly as applying the batches one after another. Both
    picks are ``max_by`` over a total order, aggregated partially before the
    shuffle.
    """
    rows = _tagged(batches)
    cols = [c for c in rows.columns if c not in keys and c != "__batch"]
    kept = [c for c in cols if c not in update]
    tail = [F.col(c) for c in cols if c not in order]
    newest = F.struct(F.col("__batch"), *[F.col(c) for c in order], *tail)
    first_batch = F.struct((-F.col("__batch")).alias("__nb"), *[F.col(c) for c in order], *tail)
    g = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in update]), newest).alias("__u"),
        F.max_by(F.struct(*[F.col(c) for c in kept]), first_batch).alias("__k"))
    return g.select(*keys, *[F.col(f"__u.{c}").alias(c) if c in update else F.col(f"__k.{c}").alias(c)
                             for c in cols])


def apply_batches(policy, target: DataFrame, batches: Sequence[DataFrame], **kw) -> DataFrame:
    for b in batches:
        target = policy(target, b, **kw)
    return target
