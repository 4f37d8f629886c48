"""Nothing is dropped in silence: good and rejected rows together are the input, from one scan."""

from ledgerwright.plans import dims, facts
from ledgerwright.sources import fixtures as fx
from ledgerwright.sources.tables import Tables
from tests.conftest import SF_SMOKE


def test_bad_pages_and_elements_are_rejected_rows(spark):
    pages = [(0, '[{"delivery_id":"D1","rate":5}, 7, null, "x", [1]]'), (1, '[{"delivery_id":"D2"}'), (2, "no page"), (3, None),
             (4, '{"delivery_id":"D3","rate":4}'), (5, "[]")]
    out = dims.route_deliveries(dims.land_pages(spark.createDataFrame(pages, "page_no bigint, content string"))).collect()
    assert sorted((r.status, r.reason or "", r.delivery_id or "", r.raw or "") for r in out) == [
        ("good", "", "D1", ""), ("good", "", "D3", ""), *[("rejected", "not an object", "", raw) for raw in (
            "", "7", "[1]", '[{"delivery_id":"D2"}', "no page", "x")]]


def test_bad_events_dates_and_amounts_are_rejected_lines(spark):
    def event(date, payments):
        return '{"order_id":"o","order_date":"%s","product_payments":%s}' % (date, payments)
    good = '{"product_id":"p","price":10,"quantity":2}'
    rows = [(1, event("2024-05-01 10:00:00", f'[{good}, null, {{"product_id":"q","price":"abc","quantity":"2.5"}}]')),
            (2, event("never", f"[{good}]")), (3, "{"), (4, None), (5, event("2024-05-01 10:00:00", "null")),
            (6, event("2021-05-01 10:00:00", f"[{good}]")), (7, event("2024-05-01 10:00:00", "[]"))]
    events = spark.createDataFrame([(i, "bonus_transaction", v) for i, v in rows] + [(8, "user_rank", "{")],
                                   "id int, event_type string, event_value string")
    out = facts.route_payment_lines(events).collect()
    assert sorted(((r.event_id, r.line, r.status, r.reason, r.total_sum and int(r.total_sum)) for r in out), key=str) == [
        (1, 0, "good", None, 20), (1, 1, "rejected", "payment", None), (1, 2, "rejected", "quantity,price", None),
        (2, None, "rejected", "order_date", None), (3, None, "rejected", "event", None), (4, None, "rejected", "event", None),
        (5, None, "rejected", "product_payments", None)]
    assert {r.event_id: r.raw for r in out}[2] == rows[1][1]


def test_one_scan_for_good_and_rejected(spark):
    landing = spark.read.parquet(f"{SF_SMOKE}/region.parquet").selectExpr("r_name as content", "r_name as load_ts")
    plan = dims.route_deliveries(landing)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1 and "Join" not in plan and "Union" not in plan
    t = Tables(spark, SF_SMOKE)
    assert dims.land_pages(fx.damaged_delivery_pages(t)).filter("content like '[%'").count() > 0
