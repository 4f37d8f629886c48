"""Deterministic in-batch deduplication.

"First wins" / "last wins" need a total order: the given ordering, then every
remaining column as a tie-break, so the surviving row never depends on row
order or partitioning. Both are ``row_number() = 1`` over the key. Spark plans
that filter as a *partial* group limit before the shuffle (each map task keeps
only its best row per key) and a final one after it, so a key holding a large
share of the rows is reduced on the map side instead of landing whole in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], descending: bool) -> DataFrame:
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    named = {c for c in order if isinstance(c, str)}
    tie = [F.col(c) for c in df.columns if c not in keys and c not in named]
    cols = order_cols + tie
    if descending:
        cols = [c.desc() for c in cols]
    w = Window.partitionBy(*keys).orderBy(*cols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the smallest by ``order`` (ties broken by the remaining columns)."""
    return _pick(df, keys, order, descending=False)


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the largest by ``order`` (ties broken by the remaining columns)."""
    return _pick(df, keys, order, descending=True)
