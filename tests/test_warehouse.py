"""Warehouse-level properties and contracts on the smoke scale."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerwright.plans import contracts, dims, facts, marts
from ledgerwright.plans.warehouse import Warehouse
from tests.conftest import SF_SMOKE


@pytest.fixture(scope="module")
def w(spark):
    return Warehouse(spark, SF_SMOKE)


def test_orders_matched_plus_unmatched_is_input(w):
    docs = w.order_docs.count()
    matched = w.dim_orders.count()
    unmatched = dims.orders_unmatched(w.order_docs, w.dim_timestamps, w.dim_users, w.dim_restaurants).count()
    assert matched + unmatched == docs
    assert unmatched > 0


def test_facts_matched_plus_unmatched_is_input(w):
    lines = w.payment_lines.count()
    matched = facts.fct_product_sales(w.payment_lines, w.dim_orders, w.products_closed).count()
    unmatched = facts.facts_unmatched(w.payment_lines, w.dim_orders, w.products_closed).count()
    assert matched + unmatched == lines


def test_ledger_totals_equal_delivery_totals(w):
    ledger = w.courier_ledger().agg(F.sum("orders_total_sum"), F.sum("orders_count")).first()
    deliv = w.deliveries.agg(F.sum("sum"), F.count(F.lit(1))).first()
    assert ledger[0] == deliv[0] and ledger[1] == deliv[1]


def test_report_reward_is_total_minus_bonus_minus_fee(w):
    for r in w.settlement_report().collect():
        exact = r.orders_total_sum - r.orders_bonus_payment_sum - r.orders_total_sum * Decimal("0.25")
        assert abs(r.restaurant_reward_sum - exact) <= Decimal("0.01")
        assert r.order_processing_fee == (r.orders_total_sum * Decimal("0.25")).quantize(Decimal("0.01"),
                                                                                          rounding="ROUND_HALF_UP")


def test_report_as_coded_counts_lines(w):
    a = {r.restaurant_id: r.orders_count for r in w.settlement_report(True).collect()}
    b = {r.restaurant_id: r.orders_count for r in w.settlement_report(False).collect()}
    assert a.keys() == b.keys() and all(b[k] >= a[k] for k in a) and any(b[k] > a[k] for k in a)


def test_reruns_are_idempotent(spark):
    q = E.queries()
    for name in ("upsert_by_key", "insert_if_absent", "dim_couriers", "dim_restaurants"):
        a = sorted(map(tuple, q[name](spark, SF_SMOKE).collect()))
        b = sorted(map(tuple, q[name](spark, SF_SMOKE).collect()))
        assert a == b, name


def _violations(df):
    return {(r.table, r.rule): r.violations for r in df.collect()}


def test_contracts_hold_on_produced_tables(w):
    for suite in (contracts.qc_not_null, contracts.qc_unique, contracts.qc_unique_composite,
                  contracts.qc_check, contracts.qc_defaults):
        for (table, rule), n in _violations(suite(w)).items():
            planted = table in ("deliveries_raw", "ordersystem_users", "lineitem", "ordersystem_orders")
            if not planted:
                assert n == 0, (table, rule, n)


def test_planted_violations_are_found(w):
    v = _violations(contracts.qc_unique(w))
    assert v[("ordersystem_users", "unique:user_login")] > 0
    assert v[("dm_users", "unique:user_login")] == 0
    c = _violations(contracts.qc_check(w))
    assert c[("lineitem", "check:year")] > 0
    fk = _violations(contracts.qc_foreign_key(w))
    assert fk[("dm_deliveries", "fk:order_id->dm_orders")] > 0
    assert fk[("fct_product_sales", "fk:order_id->dm_orders")] == 0


def test_missing_tables_lists_only_unbuilt_sources(w):
    assert sorted(r.table_name for r in contracts.missing_tables(w).collect()) == [
        "bonussystem_ranks", "bonussystem_users", "srv_etl_settings"]


def test_single_groupby_ledger_equals_window_form(w):
    """The candidate-sum ledger equals summing per-delivery pay with the monthly tier."""
    lines = (w.ledger_input.select("delivery_id", F.year("delivery_ts").alias("y"), F.month("delivery_ts").alias("m"))
             .join(marts.delivery_pay_lines(w.ledger_input), "delivery_id")
             .groupBy("courier_id", "y", "m").agg(F.sum("pay").cast("decimal(14,2)").alias("pay")))
    ledger = w.courier_ledger().select("courier_id", F.col("settlement_year").alias("y"),
                                       F.col("settlement_month").alias("m"), F.col("courier_order_sum").alias("pay"))
    assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, ledger.collect()))
