"""What the large tables' plans shuffle and write: each row once, narrow, and only what is read."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from ledgerwright.operators import contract as C
from ledgerwright.operators import skew
from ledgerwright.plans import contracts, dims, marts
from ledgerwright.plans.snapshot import Snapshot
from ledgerwright.plans.warehouse import Warehouse
from ledgerwright.sources import fixtures as fx
from tests.conftest import SF_SMOKE


def exchanged(df) -> list[str]:
    """The columns of every hash exchange of the plan, reused ones left out."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: (\[.*\])\nArguments: hashpartitioning", out.getvalue())


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_counted_salted_join_moves_the_rows_once(spark, no_broadcast):
    large = spark.range(1000).select((F.col("id") % 400).alias("k"), "id", F.concat(F.lit("row "), F.col("id")).alias("wide"))
    small = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    out = skew.counted_salted_join(large, small, ["k"], ["id"], hot_rows=100)
    assert sum("wide#" in columns for columns in exchanged(out)) == 1
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, large.join(small, "k").collect()))


@pytest.mark.parametrize("buckets", [1, 7, 65536])
def test_hot_keys_are_exact_whatever_the_buckets(spark, buckets):
    rows = spark.range(3000).select(F.when(F.col("id") < 900, F.lit(1)).when(F.col("id") < 1500, F.lit(2))
                                    .when(F.col("id") < 2000, F.lit(None)).otherwise(F.col("id")).alias("k"))
    got = skew.hot_keys(rows, ["k"], hot_rows=600, buckets=buckets)
    assert [tuple(r) for r in got.collect()] == [(1, 900)]


def test_left_salted_join_keeps_rows_without_a_match(spark):
    large = spark.range(500).select(F.when(F.col("id") < 300, F.lit(0)).when(F.col("id") < 310, F.lit(None))
                                    .otherwise(F.col("id")).alias("k"), "id")
    small = spark.createDataFrame([(0, "hot"), (400, "cold")], "k long, v string")
    got = skew.counted_salted_join(large, small, ["k"], ["id"], hot_rows=50, salts=4, how="left")
    assert {(r.id, r.v) for r in got.collect()} == {(i, "hot" if i < 300 else "cold" if i == 400 else None) for i in range(500)}
    assert got.count() == 500


def test_deliveries_read_twice_have_one_shuffle(spark):
    w = Warehouse(spark, SF_SMOKE)
    d = w.deliveries
    seconds = d.filter(F.col("delivery_ts") > F.lit("2022-01-01").cast("timestamp_ntz")).select("delivery_ts").distinct()
    both = seconds.select(F.col("delivery_ts").cast("string").alias("x")).union(d.select(F.col("courier_id").alias("x")))
    both.write.format("noop").mode("overwrite").save()
    rows = both._jdf.queryExecution().executedPlan
    both.collect()
    assert "ReusedExchange" in rows().toString()


def test_delivery_pages_equal_the_general_pages_and_shuffle_narrow_lines(spark):
    w = Warehouse(spark, SF_SMOKE)
    want = fx.pages(fx.delivery_entities(w.t))
    got = fx.delivery_pages(w.t)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    landing = exchanged(dims.land_pages(got))
    assert exchanged(w.delivery_landing()) and len(landing) == 3   # lines by key, lines by page, landed texts
    assert not any("delivery_id#" in c or "buf#" in c for c in landing)


def test_pages_of_no_key_and_of_the_overlap(spark):
    e = spark.createDataFrame([(None, "none"), (3, "first"), (43, "both"), (55, "own")], "page_key long, name string")
    got = {r.page_no: r.content for r in fx.pages(e).collect()}
    assert got == {None: '[{"name":"none"}]', 0: '[{"name":"first"},{"name":"both"}]', 1: '[{"name":"both"},{"name":"own"}]'}


def test_documents_are_collected_where_their_lines_are(spark):
    w = Warehouse(spark, SF_SMOKE)
    for docs, lines in ((w.order_docs, "l_extendedprice#"), (w.bonus_events, "l_extendedprice#"), (w.restaurant_docs_v1, "l_partkey#")):
        moved = exchanged(docs)
        assert sum(lines in c for c in moved) == 1
        assert not any("buf#" in c for c in moved)


def test_a_suite_writes_only_the_columns_it_reads(spark):
    w = Warehouse(spark, SF_SMOKE)
    found = C.rules(contracts.contracts(), ("check",))
    tables, _ = contracts._tables(w, Snapshot(spark, "test"), C.tables_of(found), C.columns_of(found))
    assert tables["dm_deliveries"].columns == ["order_sum"]
    assert set(tables["dm_products"].columns) == {"restaurant_id", "product_id", "product_price", "active_from"}
    assert "event_id" not in tables["fct_product_sales"].columns
    whole = {(r.table, r.rule): r.violations for r in contracts.suite(w).collect()}
    for kind in C.KINDS:
        part = {(r.table, r.rule): r.violations for r in contracts.suite(w, (kind,)).collect()}
        assert part == {k: v for k, v in whole.items() if k[1].startswith(f"{kind}:")}


def test_fact_lines_shuffle_neither_totals_nor_what_the_order_brings(spark, no_broadcast):
    lines = [c for c in exchanged(Warehouse(spark, SF_SMOKE).fact_lines) if "bonus_grant#" in c]
    assert len(lines) == 2   # to their product versions, then to their orders
    assert not any("total_sum#" in c or "order_status#" in c or "order_ts#" in c for c in lines)


def test_timestamps_are_shuffled_once_for_a_join_by_second(spark, no_broadcast):
    w = Warehouse(spark, SF_SMOKE)
    snapshot = Snapshot(spark, "test")
    moved = exchanged(dims.join_second_precision(snapshot.put(w.deliveries, "d"), snapshot.put(w.dim_timestamps, "t")))
    assert sum("min#" in c for c in moved) == 1 and not any("dim_ts#" in c for c in moved)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_measures_of_a_fanned_side_are_those_of_its_keys(spark, how):
    large = spark.range(500).select(F.when(F.col("id") < 300, F.lit(0)).when(F.col("id") < 310, F.lit(None))
                                    .otherwise(F.col("id")).alias("k"), "id")
    small = spark.createDataFrame([(0, 7), (0, 5), (400, 9), (400, 2), (None, 1), (9999, 3)], "k long, v long")
    least = F.min("v").alias("v")
    got = skew.counted_salted_join(large, small, ["k"], ["id"], hot_rows=50, salts=4, how=how, measures=[least])
    want = large.join(small.groupBy("k").agg(least), "k", how)
    assert sorted(map(str, got.select("k", "id", "v").collect())) == sorted(map(str, want.select("k", "id", "v").collect()))


def test_the_ledger_shuffles_no_decimal_sums(spark):
    d = spark.createDataFrame([("C1", "D1", 5, "999999999999.99", "0.01"), ("C1", "D2", 3, None, "1.00"),
                               ("C2", "D3", 4, "-12.34", None)], "courier_id string, delivery_id string, rate int, o string, t string")
    d = d.select("courier_id", "delivery_id", "rate", F.col("o").cast("decimal(14,2)").alias("order_sum"),
                 F.col("t").cast("decimal(14,2)").alias("tip_sum"), F.lit("2024-10-05 10:00:00").cast("timestamp_ntz").alias("delivery_ts"))
    couriers = spark.createDataFrame([("C1", "a"), ("C2", "b")], "courier_id string, courier_name string")
    ledger = marts.courier_ledger(d, couriers)
    assert not any("isEmpty#" in c for c in exchanged(ledger))
    got = {r.courier_id: tuple(None if v is None else str(v) for v in (r.orders_total_sum, r.courier_order_sum, r.courier_tips_sum,
                                                                       r.courier_reward_sum)) for r in ledger.collect()}
    assert got == {"C1": ("999999999999.99", "70000000150.00", "1.01", "70000000150.96"), "C2": ("-12.34", "150.00", None, None)}


def test_a_suite_writes_only_the_columns_of_the_deliveries_that_are_read(spark):
    for kind, kept in (("check", {"rate", "sum", "tip_sum"}), ("fk", {"order_id", "rate", "sum", "tip_sum"}),
                       ("not_null", {"order_id", "address", "rate", "sum", "tip_sum"})):
        found = C.rules(contracts.contracts(), (kind,))
        assert contracts._layer_columns(C.columns_of(found))["deliveries"] == {"delivery_id", "courier_id", "delivery_ts"} | kept
    w = Warehouse(spark, SF_SMOKE)
    narrow = dims.dim_deliveries(w.deliveries.drop("address", "rate"), w.dim_timestamps, w.dim_couriers)
    assert narrow.columns == ["delivery_id", "order_id", "courier_id", "delivery_ts", "order_sum", "tip_sum"]
    assert narrow.exceptAll(w.dim_deliveries.select(*narrow.columns)).count() == 0 and narrow.count() == w.dim_deliveries.count()
