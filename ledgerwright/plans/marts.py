"""Settlement marts: the monthly courier ledger and the restaurant settlement report."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pay
from ..functions.money import MONEY, from_units, pct, to_units
from ..functions.timeparts import month_range, ntz
from ..operators.skew import DEFAULT_HOT_ROWS, salted_join

LEDGER_COLUMNS = ["courier_id", "courier_name", "settlement_year", "settlement_month",
                  "orders_count", "orders_total_sum", "rate_avg", "order_processing_fee",
                  "courier_order_sum", "courier_tips_sum", "courier_reward_sum"]

REPORT_COLUMNS = ["restaurant_id", "restaurant_name", "settlement_date", "orders_count",
                  "orders_total_sum", "orders_bonus_payment_sum", "orders_bonus_granted_sum",
                  "order_processing_fee", "restaurant_reward_sum"]


def _month_keys(deliveries: DataFrame) -> DataFrame:
    return deliveries.select(
        "courier_id", "rate", "order_sum", "tip_sum",
        F.year("delivery_ts").alias("settlement_year"),
        F.month("delivery_ts").alias("settlement_month"))


def restrict_to_month(deliveries: DataFrame, run_date: _dt.date) -> DataFrame:
    """Deliveries of the calendar month before ``run_date``.

    A range on ``delivery_ts`` (pushed to the parquet scan); on a stored table
    laid out by ``delivery_month`` also an equality on that partition column,
    so only the month's directory is listed and read.
    """
    start, end = month_range(run_date)
    out = deliveries.filter((F.col("delivery_ts") >= ntz(start)) & (F.col("delivery_ts") < ntz(end)))
    if "delivery_month" in deliveries.columns:
        out = out.filter(F.col("delivery_month") == F.lit(start.date()))
    return out


def _with_names(ledger: DataFrame, couriers: DataFrame) -> DataFrame:
    # Aggregate first, then attach names: the join sees one row per (courier, month).
    return (ledger.join(couriers.select("courier_id", "courier_name"), "courier_id")
            .select(*LEDGER_COLUMNS))


def _ledger(g, pay_sum, reward) -> DataFrame:
    """Contract columns of the ledger from the per-(courier, year, month) aggregate ``g``."""
    total = from_units(F.col("total"), 2)
    return g.select(
        "courier_id",
        F.col("settlement_year").cast("int").alias("settlement_year"),
        F.col("settlement_month").cast("int").alias("settlement_month"),
        F.col("n").cast("bigint").alias("orders_count"),
        total.cast(MONEY).alias("orders_total_sum"),
        pay.rate_avg(F.col("sum_rate"), F.col("n")).alias("rate_avg"),
        pct(total, str(pay.FEE)).cast(MONEY).alias("order_processing_fee"),
        pay_sum.cast(MONEY).alias("courier_order_sum"),
        from_units(F.col("tips"), 2).cast(MONEY).alias("courier_tips_sum"),
        reward.cast(MONEY).alias("courier_reward_sum"),
    )


def _base_measures():
    """Count and sums; amounts are summed in cents, a third of the width of decimal sums in the shuffle."""
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col("rate").cast("bigint")).alias("sum_rate"),
            F.sum(to_units(F.col("order_sum"), 2)).alias("total"), F.sum(to_units(F.col("tip_sum"), 2)).alias("tips")]


def courier_ledger(deliveries: DataFrame, couriers: DataFrame) -> DataFrame:
    """Ledger by the documented rules: tier by the courier's average rating in the month.

    The pay of every delivery depends on an aggregate of its group. Instead of a
    window followed by a second aggregate, the four candidate pay sums (one per
    tier) are computed in the same single ``groupBy`` as the other measures and
    the right one is picked afterwards: one exchange, partial aggregation on the
    map side, no sort, and no group is ever held whole by one task.
    """
    g = (_month_keys(deliveries)
         .groupBy("courier_id", "settlement_year", "settlement_month")
         .agg(*_base_measures(),
              *[F.sum(to_units(pay.tier_pay(F.col("order_sum"), t), 4)).alias(f"cand{i}")
                for i, t in enumerate(pay.TIERS)]))
    idx = pay.tier_index(F.col("sum_rate"), F.col("n"))
    pay_sum = from_units(pay.pick(idx, [F.col(f"cand{i}") for i in range(len(pay.TIERS))]), 4)
    reward = pay_sum + pct(from_units(F.col("tips"), 2), str(pay.TIPS_KEPT))
    return _with_names(_ledger(g, pay_sum, reward), couriers)


def courier_ledger_as_coded(deliveries: DataFrame, couriers: DataFrame) -> DataFrame:
    """Ledger with the original job's formulas.

    Each delivery's own rating picks its tier (with the strict-comparison fall
    through of :func:`pay.coded_delivery_pay`) and the reward is
    ``(pay + tips) * 0.95``. Grouping and month handling are the same as the
    documented ledger.
    """
    g = (_month_keys(deliveries)
         .withColumn("line_pay", pay.coded_delivery_pay(F.col("rate"), F.col("order_sum")))
         .groupBy("courier_id", "settlement_year", "settlement_month")
         .agg(*_base_measures(), F.sum("line_pay").alias("pay_sum")))
    reward = pct(F.col("pay_sum") + from_units(F.col("tips"), 2), str(pay.TIPS_KEPT))
    return _with_names(_ledger(g, F.col("pay_sum"), reward), couriers)


def delivery_pay_lines(deliveries: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Per-delivery pay with the tier of the courier's monthly average.

    The monthly statistics are aggregated (partially, map side) and joined back
    on (courier, year, month). This is the same result as
    ``avg(rate) over (partition by courier, year, month)`` without putting all
    deliveries of a busy courier into one window partition. The join back
    salts the courier-months with more than ``hot_rows`` deliveries (by
    delivery id): the statistics side comes out of the aggregate already
    partitioned by the key, which AQE cannot split, so such a courier would
    otherwise be joined by one task.
    """
    d = deliveries.select("delivery_id", "courier_id", "rate", "order_sum",
                          F.year("delivery_ts").alias("y"), F.month("delivery_ts").alias("m"))
    stats = (d.groupBy("courier_id", "y", "m")
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("rate").cast("bigint")).alias("sum_rate")))
    j = salted_join(d, stats, ["courier_id", "y", "m"], salt_by=["delivery_id"], count_column="n",
                    hot_rows=hot_rows)
    idx = pay.tier_index(F.col("sum_rate"), F.col("n"))
    line_pay = pay.pick(idx, [pay.tier_pay(F.col("order_sum"), t) for t in pay.TIERS])
    return j.select(
        "delivery_id", "courier_id",
        pay.rate_avg(F.col("sum_rate"), F.col("n")).alias("rate_avg"),
        pay.tier_percent(idx).alias("tier_percent"),
        line_pay.cast("decimal(14,4)").alias("pay"))


def settlement_report(lines: DataFrame, restaurants: DataFrame, settlement_date: _dt.date,
                      distinct_orders: bool = True) -> DataFrame:
    """Per restaurant: orders, totals, bonuses, 25 % fee and the restaurant's reward.

    ``lines`` are the qualifying fact lines with (restaurant_id, order_id,
    total_sum, bonus_payment, bonus_grant). ``distinct_orders`` counts orders;
    ``False`` counts fact lines like the original job.
    """
    # Two partial aggregations instead of a distinct aggregate (which Spark
    # rewrites with an Expand that duplicates every line before the shuffle):
    # per (restaurant, order) first, then per restaurant.
    per_order = (lines.groupBy("restaurant_id", "order_id")
                 .agg(F.count(F.lit(1)).alias("lines"), F.sum("total_sum").alias("total"),
                      F.sum("bonus_payment").alias("paid"), F.sum("bonus_grant").alias("granted")))
    count = F.count(F.lit(1)) if distinct_orders else F.sum("lines")
    g = (per_order.groupBy("restaurant_id")
         .agg(count.alias("n"), F.sum("total").alias("total"),
              F.sum("paid").alias("paid"), F.sum("granted").alias("granted")))
    fee = pct(F.col("total"), str(pay.FEE))
    out = g.select(
        "restaurant_id",
        F.lit(settlement_date).alias("settlement_date"),
        F.col("n").cast("int").alias("orders_count"),
        F.col("total").cast(MONEY).alias("orders_total_sum"),
        F.col("paid").cast(MONEY).alias("orders_bonus_payment_sum"),
        F.col("granted").cast(MONEY).alias("orders_bonus_granted_sum"),
        fee.cast(MONEY).alias("order_processing_fee"),
        (F.col("total") - F.col("paid") - fee).cast(MONEY).alias("restaurant_reward_sum"))
    names = restaurants.select("restaurant_id", "restaurant_name")
    return out.join(names, "restaurant_id").select(*REPORT_COLUMNS)
