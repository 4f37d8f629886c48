"""Incremental extraction from a source table into a staging target.

Every extract is a filter on the source that Catalyst can push into the scan:
a high-watermark on an id or timestamp column, or a half-open date window. A
watermark that depends on the target is a scalar subquery, so the plan stays
lazy and the value is pushed to the scan at run time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json as J
from ..functions.timeparts import day_before, ntz


def high_watermark(target: DataFrame, column: str, default) -> Column:
    """``coalesce(max(target.column), default)`` as a scalar subquery column."""
    return target.select(F.coalesce(F.max(column), F.lit(default))).scalar()


def extract_by_id(source: DataFrame, target: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows of ``source`` whose id is above the largest id already in ``target`` (-1 if empty)."""
    return source.filter(F.col(id_column) > high_watermark(target, id_column, -1))


def bind_columns(source: DataFrame, target_schema: T.StructType | Sequence[str],
                 drop: Sequence[str] = ()) -> DataFrame:
    """Select the target's columns from ``source`` by name, in the target's order.

    ``drop`` removes source-only columns (a surrogate id the target generates
    itself). A column missing from the source is an error, never a silent
    positional shift.
    """
    names = target_schema.names if isinstance(target_schema, T.StructType) else list(target_schema)
    src = source.drop(*drop)
    missing = [n for n in names if n not in src.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    if isinstance(target_schema, T.StructType):
        return src.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target_schema.fields])
    return src.select(*names)


def quarantine_split(raw: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Row-tolerant typing: ``try_cast`` each text column; a row whose cast fails goes to quarantine.

    Returns ``(good, bad)``; ``good`` has the typed columns, ``bad`` keeps the raw
    text plus the list of failing columns. Both come from one scan.
    """
    typed = raw.select(*raw.columns, *[
        F.col(c).try_cast(t).alias(f"__t_{c}") for c, t in casts.items()])
    failed = F.filter(F.array(*[
        F.when(F.col(f"__t_{c}").isNull() & F.col(c).isNotNull(), F.lit(c)) for c in casts]),
        lambda x: x.isNotNull())
    typed = typed.withColumn("__failed", failed)
    good = (typed.filter(F.size("__failed") == 0)
            .select(*[F.col(f"__t_{c}").alias(c) if c in casts else F.col(c) for c in raw.columns]))
    bad = typed.filter(F.size("__failed") > 0).select(*raw.columns, F.col("__failed").alias("failed_columns"))
    return good, bad


def failed_casts(casts: dict[str, str], value=F.col) -> Column:
    """Names of the text columns of ``casts`` whose text is there but does not cast to its type."""
    return F.filter(F.array(*[F.when(value(c).isNotNull() & value(c).try_cast(t).isNull(), F.lit(c))
                              for c, t in casts.items()]), lambda x: x.isNotNull())


def routed(documents: DataFrame, text_column: str, schema: T.StructType, *keep: str) -> DataFrame:
    """Every document as one row, in one pass: typed by ``schema``, with where it belongs.

    Added are ``status`` (good or rejected), ``reason`` (NULL, "not an object", or the
    columns that do not cast, comma-joined), ``failed_columns`` and, for rejected rows,
    ``raw``, the document's text. Write it partitioned by ``status``: what reads the good
    rows prunes the others, and good + rejected is the input.
    """
    casts = {f.name: f.dataType.simpleString() for f in schema.fields if not isinstance(f.dataType, T.StringType)}
    text = J.parse_fields(documents, text_column, J.as_text(schema), *keep, text_column)
    no_object = F.json_object_keys(text_column).isNull()
    checked = text.select("*", failed_casts(casts).alias("failed_columns"))
    reason = F.when(no_object, F.lit("not an object")).when(F.size("failed_columns") > 0, F.concat_ws(",", "failed_columns"))
    return (checked.withColumn("reason", reason)
            .select(*keep, *[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in schema.names],
                    F.when(F.col("reason").isNull(), F.lit("good")).otherwise(F.lit("rejected")).alias("status"),
                    "reason", "failed_columns", F.when(F.col("reason").isNotNull(), F.col(text_column)).alias("raw")))


def since(source: DataFrame, ts_column: str, watermark: _dt.datetime) -> DataFrame:
    """Rows strictly after the watermark (pushed to the scan)."""
    return source.filter(F.col(ts_column) > ntz(watermark))


def newest_n(source: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The ``n`` newest rows by ``order`` descending (a top-k, planned as TakeOrderedAndProject)."""
    return source.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def window_yesterday(source: DataFrame, ts_column: str, run_date: _dt.date) -> DataFrame:
    """Half-open window ``[run_date - 1 day, run_date)``."""
    start, end = day_before(run_date)
    return source.filter((F.col(ts_column) >= ntz(start)) & (F.col(ts_column) < ntz(end)))


def document_envelope(rows: DataFrame, id_column: str, ts_column: str) -> DataFrame:
    """Split a record into (object_id, update_ts, object_value JSON of the other fields)."""
    rest = [c for c in rows.columns if c not in (id_column, ts_column)]
    return rows.select(F.col(id_column).cast("string").alias("object_id"),
                       F.col(ts_column).alias("update_ts"),
                       J.to_text(F.struct(*[F.col(c) for c in rest])).alias("object_value"))


def split_malformed(docs: DataFrame, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Documents whose text is valid JSON, and the rest (quarantine), from one scan.

    ``try_parse_json`` is NULL exactly for malformed text, so a document is
    never dropped silently: it lands on one side or the other.
    """
    ok = F.try_parse_json(F.col(text_column)).isNotNull()
    return docs.filter(ok), docs.filter(~ok | F.col(text_column).isNull())
