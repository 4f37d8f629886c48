"""File-source streaming loads: three landed batches upserted equal the batch query."""

import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerwright.operators.tables import TableStore
from ledgerwright.plans import incremental
from ledgerwright.streaming import incremental as S
from tests.conftest import SF_SMOKE

COLS = ["user_id", "event_id", "ts", "value"]


def test_streamed_upserts_equal_batch_upserts(spark):
    events = spark.read.parquet(f"{SF_SMOKE}/events.parquet").select(*COLS)
    landing = tempfile.mkdtemp(prefix="lw-landing-", dir="/tmp")
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    policy = S.upsert_policy(["user_id"], ["ts", "event_id"])
    schema = events.schema
    for b in incremental.batches(spark.read.parquet(f"{SF_SMOKE}/events.parquet")):
        b.select(*COLS).write.mode("append").parquet(landing)      # a new run's files arrive
        S.load_landed_files(spark, landing, schema, store, "events_latest", policy).awaitTermination()
    assert len(store.versions("events_latest")) == 3
    got = sorted(map(tuple, store.read("events_latest").select(*COLS).collect()))
    want = sorted(map(tuple, E.queries()["upsert_by_key"](spark, SF_SMOKE).select(*COLS).collect()))
    assert got == want


def test_rerun_without_new_files_writes_nothing(spark):
    events = spark.read.parquet(f"{SF_SMOKE}/events.parquet").select(*COLS).filter(F.col("event_id") < 100)
    landing = tempfile.mkdtemp(prefix="lw-landing-", dir="/tmp")
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    events.write.mode("overwrite").parquet(landing)
    policy = S.append_policy()
    S.load_landed_files(spark, landing, events.schema, store, "ev", policy).awaitTermination()
    v = store.versions("ev")
    S.load_landed_files(spark, landing, events.schema, store, "ev", policy).awaitTermination()
    assert store.versions("ev") == v
    assert store.read("ev").count() == events.count()


def test_streamed_api_pages_equal_staging(spark):
    from ledgerwright.sources import fixtures as fx
    from ledgerwright.sources.tables import Tables
    t = Tables(spark, SF_SMOKE)
    pages = fx.pages(fx.delivery_entities(t))
    landing = tempfile.mkdtemp(prefix="lw-pages-", dir="/tmp")
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    # two API runs: the second re-sends part of the first (overlap) and the rest
    pages.filter(F.col("page_no") % 2 == 0).select("content").write.mode("append").text(landing)
    S.load_delivery_pages(spark, landing, store).awaitTermination()
    again = (F.col("page_no") % 2 == 1) | (F.col("page_no") >= 3)   # every odd page, plus repeats
    pages.filter(again).select("content").write.mode("append").text(landing)
    S.load_delivery_pages(spark, landing, store).awaitTermination()
    want = fx.stg_deliveries(t)
    got = store.read("deliveries").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert store.read("deliveries_quarantine").count() == 0


def test_replayed_epoch_is_not_applied_twice(spark):
    import os
    events = spark.read.parquet(f"{SF_SMOKE}/events.parquet").select(*COLS).filter(F.col("event_id") < 200)
    landing = tempfile.mkdtemp(prefix="lw-landing-", dir="/tmp")
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    events.write.mode("overwrite").parquet(landing)
    ckpt = f"{store.root}/_streams/replay"
    S.load_landed_files(spark, landing, events.schema, store, "ev", S.append_policy(), checkpoint=ckpt).awaitTermination()
    before = store.versions("ev")
    # crash between the table write and the stream's commit: the epoch runs again on restart
    os.remove(f"{ckpt}/commits/0")
    if os.path.exists(f"{ckpt}/commits/.0.crc"):
        os.remove(f"{ckpt}/commits/.0.crc")
    S.load_landed_files(spark, landing, events.schema, store, "ev", S.append_policy(), checkpoint=ckpt).awaitTermination()
    assert os.path.exists(f"{ckpt}/commits/0")          # the epoch did run again ...
    assert store.versions("ev") == before                # ... and wrote nothing
    assert store.read("ev").count() == events.count()    # append not applied twice
