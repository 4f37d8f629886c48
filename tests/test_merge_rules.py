"""One answer however runs are split: whole-table keys, first-run policies, salts by count."""

from __future__ import annotations

import datetime as dt

import pytest

from ledgerwright.operators.skew import salted_join
from ledgerwright.operators.tables import TableStore
from ledgerwright.plans import facts, pipeline
from ledgerwright.session import CLUSTER_CONF, apply_conf

SCHEMA = "delivery_id string, delivery_ts timestamp_ntz, tip_sum int, delivery_month date"


def _delivery(key, month, tip):
    return (key, dt.datetime(2024, month, 3), tip, dt.date(2024, month, 1))


def test_a_repeated_delivery_is_stored_once(spark, tmp_path):
    rows = [_delivery("d1", 10, 1), _delivery("d1", 11, 2), _delivery("d2", 10, 3), _delivery("d2", 10, 4)]
    whole, split = TableStore(spark, str(tmp_path / "whole")), TableStore(spark, str(tmp_path / "split"))
    pipeline._merge_by_month(whole, "dm_deliveries", spark.createDataFrame(rows, SCHEMA), "delivery_month")
    for part in (rows[::2], rows[1::2]):
        pipeline._merge_by_month(split, "dm_deliveries", spark.createDataFrame(part, SCHEMA), "delivery_month")
    got = [sorted((r.delivery_id, r.tip_sum) for r in s.read("dm_deliveries").collect()) for s in (whole, split)]
    assert got[0] == got[1] == [("d1", 1), ("d2", 3)]


def test_first_run_applies_the_policy(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    frame = spark.createDataFrame([("c1", "A"), ("c1", "B")], "courier_id string, courier_name string")
    out = pipeline._merge(store, "dm_couriers", frame)
    assert [r.courier_id for r in out.collect()] == ["c1"]


def test_a_product_twice_in_an_event_is_two_lines_and_a_bad_date_is_no_failure(spark):
    def event(date):
        return ('{"user_id":1,"order_id":"o1","order_date":"%s","product_payments":['
                '{"product_id":"p","product_name":"n","price":10,"quantity":1,"bonus_payment":0,"bonus_grant":0},'
                '{"product_id":"p","product_name":"n","price":7,"quantity":1,"bonus_payment":0,"bonus_grant":0}]}') % date
    rows = [(1, "bonus_transaction", event("2024-05-01 10:00:00")), (2, "bonus_transaction", event("never"))]
    lines = facts.payment_lines(spark.createDataFrame(rows, "id int, event_type string, event_value string")).collect()
    assert sorted((r.event_id, r.line, int(r.total_sum)) for r in lines) == [(1, 0, 10), (1, 1, 7)]


def test_salts_follow_the_count_of_a_key(spark):
    large = spark.range(1000).selectExpr("id", "if(id < 900, 0, id) as k")
    small = large.groupBy("k").count()
    out = salted_join(large, small, ["k"], ["id"], "count", hot_rows=100)
    assert out.count() == 1000 and out.where("k = 0").select("count").distinct().first()[0] == 900


def test_cluster_sizes_are_not_reset_by_a_query(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        apply_conf(spark, cluster=True)
        apply_conf(spark)
        assert spark.conf.get(key) == CLUSTER_CONF[key]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
