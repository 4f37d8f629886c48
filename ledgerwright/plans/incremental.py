"""Incremental loads over the ``events`` stream table: batches, watermarks, conflict policies.

The events table plays the role of a bonus-system source read in three runs:
T1 = ts < 2024-01-11, T2 = 2024-01-11 <= ts < 2024-01-21, T3 = the rest. Each run
is one batch handed to a conflict policy; the policies are the ones the
warehouse uses for its own tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.money import TOTAL, cents_to_money, to_cents
from ..functions.timeparts import ntz
from ..operators import conflict, watermark
from ..operators.dedup import first_by, last_by
from ..sources import extract

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def batches(events: DataFrame) -> list[DataFrame]:
    c1, c2 = ntz(params.BATCH_CUT_1), ntz(params.BATCH_CUT_2)
    ts = F.col("ts")
    return [events.filter(ts < c1), events.filter((ts >= c1) & (ts < c2)), events.filter(ts >= c2)]


# ---------------------------------------------------------------- extraction

def extract_by_id(events: DataFrame) -> DataFrame:
    """Target holds the events below half of the largest id; extract everything above its max."""
    half = events.select(F.max("event_id")).scalar()
    target = events.filter(F.col("event_id") * 2 < half)
    return extract.extract_by_id(events, target, "event_id").select("event_id", "event_type", "value")


def extract_bind_columns(events: DataFrame) -> DataFrame:
    """A source with shuffled columns and its own surrogate id, bound to the target by name."""
    source = events.select("props", "value", "event_type", "user_id", "ts", "event_id",
                           (F.col("event_id") + 1).alias("id"))
    return extract.bind_columns(source, EVENT_COLUMNS, drop=["id"])


def raw_text_events(events: DataFrame) -> DataFrame:
    """Events as the source sends them: every value as text; every 17th value is malformed."""
    txt = F.format_string("%.2f", F.col("value"))
    bad = F.col("event_id") % 17 == 0
    return events.select(F.col("event_id").cast("string").alias("event_id"), "event_type",
                         F.when(bad, F.concat(txt, F.lit("x"))).otherwise(txt).alias("value"))


def quarantine_summary(events: DataFrame) -> DataFrame:
    good, bad = extract.quarantine_split(raw_text_events(events),
                                         {"event_id": "bigint", "value": "decimal(14,2)"})
    g = good.agg(F.lit("good").alias("status"), F.count(F.lit(1)).alias("rows"),
                 F.sum("value").cast(TOTAL).alias("value_sum"))
    b = bad.agg(F.lit("bad").alias("status"), F.count(F.lit(1)).alias("rows"),
                F.lit(None).cast(TOTAL).alias("value_sum"))
    return g.unionByName(b)


# ---------------------------------------------------------------- watermarks and settings

def control_from(batch: DataFrame) -> DataFrame:
    return watermark.batch_max(batch, "event_type", "ts")


def watermark_read(events: DataFrame) -> DataFrame:
    """Control rows exist for two targets (click, view); the others read the default."""
    t1 = batches(events)[0]
    control = control_from(t1.filter(F.col("event_type").isin("click", "view")))
    targets = events.select(F.col("event_type").alias("target"))
    return watermark.read(control, targets)


def watermark_advance(events: DataFrame) -> DataFrame:
    """Control after T1, advanced by T2; signup's T2 batch is empty and keeps its value."""
    t1, t2, _ = batches(events)
    control = control_from(t1)
    return watermark.advance(control, control_from(t2.filter(F.col("event_type") != "signup")))


def settings_rows(batch: DataFrame) -> DataFrame:
    last = last_by(batch.select("event_type", "ts", "event_id"), ["event_type"], ["ts", "event_id"])
    return last.select(F.col("event_type").alias("key"),
                       F.to_json(F.struct(F.col("event_id").alias("last_event_id"),
                                          F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("last_ts")))
                       .alias("value"), "ts")


def settings_upsert(events: DataFrame) -> DataFrame:
    """Keyed settings (key, JSON value): written from T1, upserted by T2 (signup absent from T2)."""
    t1, t2, _ = batches(events)
    target = settings_rows(t1)
    upd = settings_rows(t2.filter(F.col("event_type") != "signup"))
    out = conflict.upsert(target, upd, ["key"], ["ts"])
    parsed = F.from_json("value", "last_event_id bigint, last_ts string")
    return out.select("key", parsed["last_event_id"].alias("last_event_id"),
                      F.to_timestamp_ntz(parsed["last_ts"]).alias("last_ts"))


def load_report(events: DataFrame) -> DataFrame:
    """Per source: rows read, rows above its watermark, and whether the batch is empty."""
    t1, t2, _ = batches(events)
    control = control_from(t1.unionByName(t2)).filter(F.col("target") != "signup").unionByName(
        control_from(events.filter(F.col("event_type") == "signup")))
    e = events.join(control.withColumnRenamed("target", "event_type"), "event_type", "left")
    wm = F.coalesce(F.col("watermark"), ntz(params.DEFAULT_WATERMARK))
    return (e.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("rows_read"),
                 F.sum(F.when(F.col("ts") > wm, 1).otherwise(0)).cast("bigint").alias("rows_new"))
            .withColumn("is_empty", F.col("rows_new") == 0))


def events_ordered(events: DataFrame) -> DataFrame:
    """Last event per user under the total order (ts, event_id)."""
    return last_by(events.select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"]) \
        .select("user_id", "event_id", "ts")


# ---------------------------------------------------------------- conflict policies

def _money_value(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", cents_to_money(to_cents(F.col("value"))))


def append_facts(events: DataFrame) -> DataFrame:
    bs = batches(events)
    target = conflict.apply_batches(conflict.append, bs[0], bs[1:])
    return (_money_value(target).groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").cast(TOTAL).alias("value_sum")))


def insert_if_absent(events: DataFrame) -> DataFrame:
    cols = ["user_id", "event_type", "event_id", "ts"]
    bs = [b.select(*cols) for b in batches(events)]
    order = ["ts", "event_id"]
    target = first_by(bs[0], ["user_id", "event_type"], order)
    for b in bs[1:]:
        target = conflict.insert_if_absent(target, b, ["user_id", "event_type"], order)
    return target.select("user_id", "event_type", "event_id")


def _upsert_all(events: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    bs = [b.select(*cols) for b in batches(events)]
    target = last_by(bs[0], keys, ["ts", "event_id"])
    for b in bs[1:]:
        target = conflict.upsert(target, b, keys, ["ts", "event_id"])
    return target


def upsert_by_key(events: DataFrame) -> DataFrame:
    return _upsert_all(events, ["user_id"], ["user_id", "event_id", "ts", "value"]) \
        .select("user_id", "event_id", "ts", "value")


def upsert_composite_key(events: DataFrame) -> DataFrame:
    return _upsert_all(events, ["user_id", "event_type"], ["user_id", "event_type", "event_id", "ts", "value"]) \
        .select("user_id", "event_type", "event_id", "ts", "value")


def upsert_partial(events: DataFrame) -> DataFrame:
    """T1 sets value and first_ts; later batches update the value only."""
    def rows(b: DataFrame) -> DataFrame:
        last = last_by(b.select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"])
        return last.select("user_id", "value", F.col("ts").alias("first_ts"), "event_id")

    bs = [rows(b) for b in batches(events)]
    target = bs[0]
    for b in bs[1:]:
        target = conflict.upsert_partial(target, b, ["user_id"], ["value", "event_id"], ["first_ts", "event_id"])
    return target.select("user_id", "value", "first_ts")
