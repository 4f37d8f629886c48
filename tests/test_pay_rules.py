"""Ledger rules on hand-made deliveries, checked against a plain-Python computation."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest

from ledgerwright.functions.timeparts import month_range
from ledgerwright.plans import marts

SCHEMA = "delivery_id string, courier_id string, delivery_ts timestamp_ntz, rate int, order_sum decimal(14,2), tip_sum decimal(14,2)"
TIERS = [(Decimal("4"), Decimal("0.05"), 100), (Decimal("4.5"), Decimal("0.07"), 150),
         (Decimal("4.9"), Decimal("0.08"), 175), (None, Decimal("0.10"), 200)]
C2 = Decimal("0.01")


def q2(x: Decimal) -> Decimal:
    return x.quantize(C2, rounding=ROUND_HALF_UP)


def documented(rows):
    """(courier, y, m) -> expected ledger measures, computed row by row in Python."""
    groups = {}
    for r in rows:
        groups.setdefault((r[1], r[2].year, r[2].month), []).append(r)
    out = {}
    for k, g in groups.items():
        n, sr = len(g), sum(r[3] for r in g)
        avg = Decimal(sr) / n
        tier = next(t for t in TIERS if t[0] is None or avg < t[0])
        pay = sum(max(r[4] * tier[1], Decimal(tier[2])) for r in g)
        tips = sum(r[5] for r in g)
        total = sum(r[4] for r in g)
        out[k] = dict(orders_count=n, orders_total_sum=q2(total), rate_avg=q2(avg),
                      order_processing_fee=q2(total * Decimal("0.25")), courier_order_sum=q2(pay),
                      courier_tips_sum=q2(tips), courier_reward_sum=q2(pay + tips * Decimal("0.95")))
    return out


def coded_pay(rate, s):
    """The original CASE chain, clause by clause."""
    for bound, p, mn in TIERS[:-1]:
        if rate is not None and rate < bound and s * p > mn:
            return s * p
        if rate is not None and rate < bound and s * p < mn:
            return Decimal(mn)
    if rate is not None and rate >= Decimal("4.9") and s * Decimal("0.10") > 200:
        return s * Decimal("0.10")
    return Decimal(200)


def make(spark, rows):
    deliveries = spark.createDataFrame(rows, SCHEMA)
    couriers = spark.createDataFrame(sorted({(r[1], f"name {r[1]}") for r in rows}),
                                     "courier_id string, courier_name string")
    return deliveries, couriers


def ratings_rows(courier, ratings, amount="1000.00", day=dt.datetime(2024, 10, 5, 12)):
    return [(f"{courier}-{i}", courier, day, r, Decimal(amount), Decimal("10.00")) for i, r in enumerate(ratings)]


# Averages exactly on and next to every tier bound: 3.99, 4.00, 4.49, 4.50, 4.89, 4.90.
BOUNDARY_RATINGS = {
    "c399": [4] * 99 + [3],
    "c400": [4] * 3,
    "c449": [5] * 49 + [4] * 51,
    "c450": [5, 4],
    "c489": [5] * 89 + [4] * 11,
    "c490": [5] * 9 + [4],
}


@pytest.mark.parametrize("amount", ["100.00", "1999.99", "2000.00", "2000.01", "2142.86", "2187.50", "2500.00"])
def test_documented_tiers_at_bounds(spark, amount):
    rows = [r for c, rs in BOUNDARY_RATINGS.items() for r in ratings_rows(c, rs, amount)]
    d, c = make(spark, rows)
    got = {(r.courier_id, r.settlement_year, r.settlement_month): r.asDict()
           for r in marts.courier_ledger(d, c).collect()}
    want = documented(rows)
    assert set(got) == set(want)
    for k, v in want.items():
        for col, val in v.items():
            assert got[k][col] == val, (k, col)


def test_tier_choice_uses_monthly_average(spark):
    rows = ratings_rows("c", [5] * 9 + [4])          # average 4.9 -> 10 %
    d, c = make(spark, rows)
    lines = marts.delivery_pay_lines(d).collect()
    assert {r.tier_percent for r in lines} == {10}
    assert all(r.pay == Decimal("200.0000") for r in lines)  # 10 % of 1000 = 100 < minimum 200


@pytest.mark.parametrize("rate,amount,expected", [
    (3, "2000.00", "150.00"),   # 5 % equals the minimum 100: falls through to the 7 % tier's minimum
    (3, "2500.00", "125.00"),
    (4, "2187.50", "153.13"),   # rating 4 is below 4.5: 7 % = 153.125 > 150
    (5, "1000.00", "200.00"),
    (None, "5000.00", "200.00"),  # no rating: the ELSE branch
])
def test_coded_fall_through(spark, rate, amount, expected):
    rows = [("d", "c", dt.datetime(2024, 10, 1), rate, Decimal(amount), Decimal("0.00"))]
    d, c = make(spark, rows)
    got = marts.courier_ledger_as_coded(d, c).collect()[0]
    assert got.courier_order_sum == Decimal(expected)
    assert got.courier_order_sum == q2(coded_pay(None if rate is None else Decimal(rate), Decimal(amount)))


def test_coded_reward_formula(spark):
    rows = [("d1", "c", dt.datetime(2024, 10, 1), 5, Decimal("3000.00"), Decimal("40.00"))]
    d, c = make(spark, rows)
    coded = marts.courier_ledger_as_coded(d, c).collect()[0]
    spec = marts.courier_ledger(d, c).collect()[0]
    assert coded.courier_reward_sum == q2((Decimal("300.00") + Decimal("40.00")) * Decimal("0.95"))
    assert spec.courier_reward_sum == q2(Decimal("300.00") + Decimal("40.00") * Decimal("0.95"))


def test_previous_month_january_run_crosses_year():
    assert month_range(dt.date(2025, 1, 10)) == (dt.datetime(2024, 12, 1), dt.datetime(2025, 1, 1))
    assert month_range(dt.date(2024, 3, 31)) == (dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1))


def test_month_edges_and_microseconds(spark):
    edge = [
        ("a", "c", dt.datetime(2024, 9, 30, 23, 59, 59, 999999), 5, Decimal("10.00"), Decimal("0")),
        ("b", "c", dt.datetime(2024, 10, 1, 0, 0, 0), 5, Decimal("20.00"), Decimal("0")),
        ("e", "c", dt.datetime(2024, 10, 31, 23, 59, 59, 999999), 5, Decimal("30.00"), Decimal("0")),
        ("f", "c", dt.datetime(2024, 11, 1, 0, 0, 0), 5, Decimal("40.00"), Decimal("0")),
    ]
    d, c = make(spark, edge)
    got = marts.courier_ledger(marts.restrict_to_month(d, dt.date(2024, 11, 10)), c).collect()
    assert len(got) == 1 and got[0].orders_count == 2 and got[0].orders_total_sum == Decimal("50.00")


def test_rate_avg_rounds_half_up(spark):
    rows = ratings_rows("c", [5, 5, 4, 4, 4, 4, 4, 4])   # 4.25
    rows += ratings_rows("k", [5] * 5 + [4] * 3)          # 4.625 -> 4.63
    d, c = make(spark, rows)
    got = {r.courier_id: r.rate_avg for r in marts.courier_ledger(d, c).collect()}
    assert got == {"c": Decimal("4.25"), "k": Decimal("4.63")}
