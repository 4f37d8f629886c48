"""Product-sales facts from bonus-system events."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions import json as J
from ..functions.money import MONEY
from ..functions.timeparts import ntz
from ..operators.skew import DEFAULT_HOT_ROWS
from ..operators.validity import valid_at
from ..operators.waiting import Lookup, resolve
from ..sources.extract import failed_casts

FACT_COLUMNS = ["order_id", "product_id", "count", "price", "total_sum", "bonus_payment", "bonus_grant"]


def _total(count: Column, price: Column) -> Column:
    return (count * price).cast(MONEY)


def route_payment_lines(events: DataFrame, watermark: _dt.datetime = params.DEFAULT_WATERMARK) -> DataFrame:
    """``bonus_transaction`` events after the watermark -> one row per product payment, with its status.

    One pass. Rejected rows carry the reason and the text: an event that is no JSON object
    ("event"), has no readable date ("order_date") or no list of payments
    ("product_payments") is one row without a line; a payment that is NULL ("payment") or
    whose amounts do not cast (their names) is its line. An absent amount is no failure.
    The event type and the order date are filtered before the payment array is exploded,
    so only qualifying payloads are expanded.
    """
    payments = J.as_text(J.BONUS_EVENT)["product_payments"].dataType
    bonus = events.filter(F.col("event_type") == "bonus_transaction")
    e = (J.parse_fields(bonus, "event_value", J.as_text(J.BONUS_EVENT), "id", "event_value")
         .select(F.col("id").alias("event_id"), "order_id", "event_value", "product_payments",
                 F.try_to_timestamp(F.col("order_date"), F.lit(J.ORDER_DATE_FORMAT)).cast("timestamp_ntz").alias("order_date"))
         .withColumn("fault", F.when(F.json_object_keys("event_value").isNull(), F.lit("event"))
                     .when(F.col("order_date").isNull(), F.lit("order_date"))
                     .when(F.col("product_payments").isNull(), F.lit("product_payments")))
         .filter(F.col("fault").isNotNull() | (F.col("order_date") > ntz(watermark))))
    whole = F.col("fault").isNotNull()
    items = F.when(whole, F.array(F.lit(None).cast(payments.elementType))).otherwise(F.col("product_payments"))
    lines = e.select("event_id", "order_id", "order_date", "fault", F.when(whole, F.col("event_value")).alias("event_value"),
                     F.posexplode(items).alias("line", "p"))
    casts = {c: J.PAYMENT[c].dataType.simpleString() for c in ("quantity", "price", "bonus_payment", "bonus_grant")}
    failed = F.concat_ws(",", failed_casts(casts, lambda c: F.col(f"p.{c}")))
    reason = F.coalesce("fault", F.when(F.col("p").isNull(), F.lit("payment")), F.when(failed != "", failed))
    value = {c: F.col(f"p.{c}").try_cast(t) for c, t in casts.items()}
    return (lines.withColumn("reason", reason)
            .select("event_id", F.when(F.col("fault").isNull(), F.col("line")).alias("line"), "order_id", "order_date",
                    F.col("p.product_id").alias("product_id"), value["quantity"].alias("count"), value["price"].alias("price"),
                    _total(value["quantity"], value["price"]).alias("total_sum"),
                    value["bonus_payment"].alias("bonus_payment"), value["bonus_grant"].alias("bonus_grant"),
                    F.when(F.col("reason").isNull(), F.lit("good")).otherwise(F.lit("rejected")).alias("status"), "reason",
                    F.when(F.col("reason").isNotNull(), F.coalesce("event_value", J.to_text(F.col("p")))).alias("raw")))


def payment_lines(events: DataFrame, watermark: _dt.datetime = params.DEFAULT_WATERMARK) -> DataFrame:
    """The good rows of :func:`route_payment_lines`: one per product payment."""
    return good_lines(route_payment_lines(events, watermark))


def good_lines(routed: DataFrame) -> DataFrame:
    return routed.filter("status = 'good'").drop("status", "reason", "raw")


def _tried(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Every payment line with its order and product version, or with NULLs where there is none."""
    o = orders.select(F.col("order_key").alias("order_id"), "restaurant_id", "order_ts", "order_status",
                      F.lit(True).alias("has_order"))
    p = products.select(F.col("product_id").alias("p_id"), "active_from", "active_to",
                        F.lit(True).alias("has_product"))
    j = lines.join(o, "order_id", "left")
    cond = ((j["product_id"] == p["p_id"]) & (j["order_date"] >= p["active_from"])
            & (j["order_date"] < p["active_to"]))
    return j.join(p, cond, "left")


def fact_lines(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Payment lines resolved to a known order and the product version valid at the order date.

    Keeps the order's restaurant, time and status for the settlement report, so
    the report needs no second join with the orders. The products come first: what the
    order brings, and the date that only the version needs, are then shuffled by no join,
    nor is the lines' total, which follows from their count and price.
    """
    lines = lines.drop("total_sum")
    o = orders.select(F.col("order_key").alias("order_id"), "restaurant_id", "order_ts", "order_status")
    p = products.select(F.col("product_id").alias("p_id"), "active_from", "active_to")
    valid = ((lines["product_id"] == p["p_id"]) & (lines["order_date"] >= p["active_from"])
             & (lines["order_date"] < p["active_to"]))
    return lines.join(p, valid).join(o, "order_id").withColumn("total_sum", _total(F.col("count"), F.col("price")))


def fact_lines_by_time(lines: DataFrame, orders: DataFrame, versions: DataFrame,
                       hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """:func:`fact_lines` with the product version found by time (``operators.validity``).

    ``versions`` are the product versions as appended, not closed: each is valid until the
    next one of its product. No line is paired with a version that isn't its own, so a
    product with many versions, or with most of the lines, costs no more than its rows.
    """
    o = orders.select(F.col("order_key").alias("order_id"), "restaurant_id", "order_ts", "order_status")
    v = versions.select("product_id", "active_from", F.col("active_from").alias("version_from"))
    found = valid_at(lines.join(o, "order_id"), v, "product_id", "order_date", "active_from", ["version_from"],
                     ["event_id", "line"], hot_rows)
    return found.where(F.col("version_from").isNotNull() & (F.col("order_date") < ntz(params.OPEN_END)))


def line_lookups(orders: DataFrame, versions: DataFrame) -> list[Lookup]:
    """What a payment line needs: its order, then a version of its product that started by its date."""
    return [Lookup("order", orders.select(F.col("order_key").alias("order_id"), "restaurant_id", "order_ts", "order_status"), "order_id"),
            Lookup("product", versions.select("product_id", "active_from"), "product_id", ("order_date", "active_from"))]


def resolve_lines(lines: DataFrame, orders: DataFrame, versions: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Every payment line with its order, the start of its product version, and the first of the two that is ``missing``."""
    order, product = line_lookups(orders, versions)
    found = resolve(lines, [order], ["event_id", "line"], hot_rows)
    v = product.keys.withColumn("version_from", F.col("active_from"))
    found = valid_at(found, v, "product_id", "order_date", "active_from", ["version_from"], ["event_id", "line"], hot_rows)
    none = F.col("missing").isNull() & (F.col("version_from").isNull() | (F.col("order_date") >= ntz(params.OPEN_END)))
    return (found.withColumn("missing_key", F.when(none, F.col("product_id")).otherwise(F.col("missing_key")))
            .withColumn("missing", F.when(none, F.lit(product.name)).otherwise(F.col("missing"))))


def resolved_lines(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("missing").isNull()).drop("missing", "missing_key")


def fct_product_sales(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    return fact_lines(lines, orders, products).select(*FACT_COLUMNS)


def facts_unmatched(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Payment lines without an order or without a valid product version, with the first reason."""
    j = _tried(lines, orders, products)
    reason = (F.when(F.col("has_order").isNull(), F.lit("order"))
               .when(F.col("has_product").isNull(), F.lit("product")))
    return (j.select("order_id", "product_id", reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


def closed_since(facts: DataFrame, watermark: _dt.datetime = params.SETTLEMENT_WATERMARK) -> DataFrame:
    """Fact lines of CLOSED orders whose order time is after the settlement watermark.

    On a stored fact table laid out by ``order_month`` the months before the
    watermark's month are pruned as partitions.
    """
    out = facts.filter((F.col("order_status") == "CLOSED") & (F.col("order_ts") > ntz(watermark)))
    if "order_month" in facts.columns:
        out = out.filter(F.col("order_month") >= F.lit(_dt.date(watermark.year, watermark.month, 1)))
    return out
