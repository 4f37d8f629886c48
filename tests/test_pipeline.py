"""Full staging -> dds -> cdm run into a versioned store; stored marts equal the lazy queries."""

import tempfile

import pytest

import __spark_entry__ as E
from ledgerwright.operators import quality as Q
from ledgerwright.operators.tables import TableStore
from ledgerwright.plans import pipeline
from tests.conftest import SF_SMOKE


@pytest.fixture(scope="module")
def run(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    return store, pipeline.run(spark, SF_SMOKE, store)


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stored_ledger_equals_query(spark, run):
    store, out = run
    want = E.queries()["courier_ledger_prev_month"](spark, SF_SMOKE)
    assert _rows(store.read("dm_courier_ledger"), want.columns) == _rows(want, want.columns)


def test_stored_report_equals_query(spark, run):
    store, out = run
    want = E.queries()["settlement_report"](spark, SF_SMOKE)
    assert _rows(out["dm_settlement_report"], want.columns) == _rows(want, want.columns)


def test_surrogate_keys_are_unique(run):
    store, out = run
    for t in ("dm_restaurants", "dm_users", "dm_couriers", "dm_deliveries", "dm_orders", "dm_products",
              "dm_timestamps"):
        assert Q.unique(out[t], t, ["id"]).first().violations == 0, t


def test_versions_never_overwrite(spark, run):
    store, out = run
    before = store.versions("dm_couriers")
    store.write("dm_couriers", store.read("dm_couriers"))
    assert store.versions("dm_couriers") == before + [before[-1] + 1]
    assert store.read("dm_couriers").count() == store.read("dm_couriers", before[-1]).count()


def test_ledger_republication_replaces_its_month_only(spark, run):
    store, out = run
    before = store.read("dm_courier_ledger").count()
    again = pipeline.marts.courier_ledger(
        pipeline.marts.restrict_to_month(
            out["dm_deliveries"].select("delivery_id", "courier_id", "delivery_ts", "rate", "order_sum", "tip_sum"),
            pipeline.params.RUN_DATE),
        out["dm_couriers"])
    store.overwrite_partitions("dm_courier_ledger", again, ["settlement_year", "settlement_month"])
    assert store.read("dm_courier_ledger").count() == before


def test_watermarks_recorded(run):
    store, out = run
    targets = {r.target for r in store.read("srv_etl_settings").collect()}
    assert {"dm_timestamps_order", "dm_timestamps_delivery", "dm_restaurants", "dm_settlement_report"} <= targets


def test_failed_write_is_invisible_and_retry_succeeds(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    store.write("t", spark.range(3))
    # a crashed attempt: a version directory without the committer's _SUCCESS marker
    spark.range(100).write.parquet(f"{store.root}/t/v=2")
    import os
    os.remove(f"{store.root}/t/v=2/_SUCCESS")
    assert store.versions("t") == [1] and store.read("t").count() == 3
    store.write("t", spark.range(5))
    assert store.versions("t") == [1, 3] and store.read("t").count() == 5


TABLES = ["dm_restaurants", "dm_users", "dm_couriers", "dm_timestamps", "dm_deliveries", "dm_products",
          "dm_orders", "fct_product_sales", "dm_courier_ledger", "dm_settlement_report"]


def _snapshot(store):
    return {t: sorted(map(tuple, store.read(t).select(*sorted(store.read(t).columns)).collect())) for t in TABLES}


def test_rerun_is_idempotent(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    pipeline.run(spark, SF_SMOKE, store)
    first = _snapshot(store)
    versions = {t: store.versions(t) for t in TABLES}
    pipeline.run(spark, SF_SMOKE, store)
    assert _snapshot(store) == first
    assert all(len(store.versions(t)) >= len(versions[t]) for t in TABLES)


def test_late_users_load_their_orders_on_the_next_run(spark):
    from pyspark.sql import functions as F
    from ledgerwright.plans.warehouse import Warehouse
    full = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    pipeline.run(spark, SF_SMOKE, full)
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    users = Warehouse(spark, SF_SMOKE).user_docs
    # hold back the users whose key ends in 1 or 3 (their logins are not shared with anyone)
    early = users.filter(~F.substring("object_id", -1, 1).isin("1", "3"))
    out1 = pipeline.run(spark, SF_SMOKE, store, sources={"ordersystem_users": early})
    assert out1["dm_orders"].count() < full.read("dm_orders").count()
    pipeline.run(spark, SF_SMOKE, store)
    for t in ("dm_orders", "fct_product_sales", "dm_settlement_report"):
        cols = sorted(c for c in full.read(t).columns if c != "id")
        assert sorted(map(tuple, store.read(t).select(*cols).collect())) == \
            sorted(map(tuple, full.read(t).select(*cols).collect())), t


def test_vacuum_keeps_newest_versions(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    for n in range(4):
        store.write("t", spark.range(n + 1))
    assert store.vacuum("t", keep=2) == [1, 2]
    assert store.versions("t") == [3, 4] and store.read("t").count() == 4
    assert store.vacuum("t", keep=2) == []


def test_month_ledger_prunes_delivery_partitions(spark, run):
    import contextlib
    import io
    store, out = run
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        pipeline.marts.restrict_to_month(store.read("dm_deliveries"), pipeline.params.RUN_DATE).explain("formatted")
    import re
    plan = re.sub(r"#\d+L?", "", buf.getvalue())
    assert "PartitionFilters: [isnotnull(delivery_month), (delivery_month = 2024-10-01)]" in plan
    assert "GreaterThanOrEqual(delivery_ts,2024-10-01T00:00" in plan


def test_partition_merge_rewrites_only_touched_months(spark):
    import os
    from ledgerwright.operators import conflict
    from ledgerwright.operators.tables import merge_partitions
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    rows = spark.createDataFrame([(1, "a", "2024-09"), (2, "b", "2024-10"), (3, "c", "2024-10")],
                                 "k int, v string, month string")
    policy = lambda old, new: conflict.insert_if_absent(old, new, ["k"], ["v"])
    merge_partitions(store, "t", rows, ["month"], policy)
    sept = f"{store.path('t')}/month=2024-09"
    sept_files = sorted(os.listdir(sept))
    batch = spark.createDataFrame([(3, "dup", "2024-10"), (4, "d", "2024-10")], "k int, v string, month string")
    out = merge_partitions(store, "t", batch, ["month"], policy)
    assert sorted((r.k, r.v, r.month) for r in out.collect()) == [
        (1, "a", "2024-09"), (2, "b", "2024-10"), (3, "c", "2024-10"), (4, "d", "2024-10")]
    assert sorted(os.listdir(sept)) == sept_files          # the untouched month was not rewritten
    assert store.versions("t") == [1]


def test_report_prunes_fact_months(spark, run):
    import contextlib
    import io
    import re
    store, out = run
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        pipeline.facts.closed_since(store.read("fct_product_sales")).explain("formatted")
    plan = re.sub(r"#\d+L?", "", buf.getvalue())
    assert "PartitionFilters: [isnotnull(order_month), (order_month >= 2026-01-01)]" in plan


def test_run_with_vacuum_keeps_one_version(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="lw-store-", dir="/tmp"))
    pipeline.run(spark, SF_SMOKE, store)
    pipeline.run(spark, SF_SMOKE, store, keep_versions=1)
    assert "dm_orders" in store.tables() and "_streams" not in store.tables()
    assert all(len(store.versions(t)) == 1 for t in store.tables())
    assert store.read("dm_courier_ledger").count() > 0
