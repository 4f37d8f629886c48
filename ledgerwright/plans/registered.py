"""Every registered query, grouped by layer. Each reads the driver tables of one sf_dir."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params
from ..functions import json as J
from ..functions.money import TOTAL, cents_to_money, pct, to_cents
from ..functions.text import strip_brackets
from ..functions.timeparts import calendar_parts, trunc_second
from ..operators import conflict
from ..sources import extract
from ..sources import fixtures as fx
from . import contracts, dims, facts, incremental, marts
from .catalog import query
from .warehouse import Warehouse


# ---------------------------------------------------------------- marts

@query("courier_ledger")
def courier_ledger(w: Warehouse):
    """Monthly courier ledger by the documented rules, all months."""
    return w.courier_ledger()


@query("courier_ledger_as_coded")
def courier_ledger_as_coded(w: Warehouse):
    return w.courier_ledger_as_coded()


@query("courier_ledger_prev_month")
def courier_ledger_prev_month(w: Warehouse):
    return w.courier_ledger_prev_month()


@query("delivery_pay_lines")
def delivery_pay_lines(w: Warehouse):
    return marts.delivery_pay_lines(w.ledger_input)


@query("settlement_report")
def settlement_report(w: Warehouse):
    """Restaurant settlement over CLOSED orders after the settlement watermark; orders counted once."""
    return w.settlement_report(distinct_orders=True)


@query("settlement_report_as_coded")
def settlement_report_as_coded(w: Warehouse):
    """Same report counting fact lines as orders, like the original job."""
    return w.settlement_report(distinct_orders=False)


# ---------------------------------------------------------------- API landing and staging

@query("land_courier_pages")
def land_courier_pages(w: Warehouse):
    e = J.parse(F.col("content"), J.COURIER)
    return w.courier_landing(1).select(e["_id"].alias("courier_id"), e["name"].alias("courier_name"))


@query("land_delivery_pages")
def land_delivery_pages(w: Warehouse):
    e = J.parse(F.col("content"), J.DELIVERY)
    return w.delivery_landing().select(e["delivery_id"].alias("delivery_id"), e["order_id"].alias("order_id"),
                                       e["courier_id"].alias("courier_id"), e["delivery_ts"].alias("delivery_ts"))


@query("stg_couriers")
def stg_couriers(w: Warehouse):
    """Staging couriers after the second API run (truncate + insert: only that run's names)."""
    return dims.stg_couriers(w.courier_landing(2)).drop("load_ts")


@query("stg_deliveries")
def stg_deliveries(w: Warehouse):
    return dims.stg_deliveries(w.delivery_landing()).drop("load_ts")


@query("route_deliveries")
def route_deliveries(w: Warehouse):
    """Deliveries of damaged pages: each landed row once, good or rejected with its reason."""
    out = dims.route_deliveries(dims.land_pages(fx.damaged_delivery_pages(w.t)))
    item = F.when(F.col("raw").startswith("["), F.lit("page")).otherwise(F.coalesce("delivery_id", "raw"))
    return out.select("status", "reason", item.alias("item"))


@query("route_payment_lines")
def route_payment_lines(w: Warehouse):
    """Payment lines of damaged events: bad events, dates and amounts are rows, not gaps."""
    return facts.route_payment_lines(fx.damaged_bonus_events(w.t)) \
        .select("event_id", "line", "status", "reason", "product_id", "total_sum")


# ---------------------------------------------------------------- dds

@query("dim_couriers")
def dim_couriers(w: Warehouse):
    return w.dim_couriers


@query("dim_timestamps")
def dim_timestamps(w: Warehouse):
    return w.dim_timestamps


@query("join_second_precision")
def join_second_precision(w: Warehouse):
    return dims.join_second_precision(w.deliveries, w.dim_timestamps)


@query("dim_deliveries")
def dim_deliveries(w: Warehouse):
    return w.dim_deliveries


@query("dim_restaurants")
def dim_restaurants(w: Warehouse):
    return w.dim_restaurants


@query("dim_users")
def dim_users(w: Warehouse):
    return w.dim_users


@query("menu_explode")
def menu_explode(w: Warehouse):
    return dims.menu_explode(w.restaurant_docs_v1)


@query("dim_products")
def dim_products(w: Warehouse):
    return w.dim_products


@query("products_versions_closed")
def products_versions_closed(w: Warehouse):
    return w.products_closed


@query("order_doc_fields")
def order_doc_fields(w: Warehouse):
    return dims.order_doc_fields(w.order_docs)


@query("order_items_explode")
def order_items_explode(w: Warehouse):
    return dims.order_items_explode(w.order_docs)


@query("order_statuses_explode")
def order_statuses_explode(w: Warehouse):
    return dims.order_statuses_explode(w.order_docs)


@query("dim_orders")
def dim_orders(w: Warehouse):
    return w.dim_orders


@query("orders_unmatched")
def orders_unmatched(w: Warehouse):
    return dims.orders_unmatched(w.order_docs, w.dim_timestamps, w.dim_users, w.dim_restaurants)


@query("fct_product_sales")
def fct_product_sales(w: Warehouse):
    return facts.fct_product_sales(w.payment_lines, w.dim_orders, w.products_closed)


@query("fct_product_sales_by_time")
def fct_product_sales_by_time(w: Warehouse):
    """The same facts, each line's product version carried forward in time instead of joined by range."""
    return facts.fact_lines_by_time(w.payment_lines, w.dim_orders, w.dim_products).select(*facts.FACT_COLUMNS)


@query("facts_unmatched")
def facts_unmatched(w: Warehouse):
    return facts.facts_unmatched(w.payment_lines, w.dim_orders, w.products_closed)


@query("fk_deliveries_orders")
def fk_deliveries_orders(w: Warehouse):
    """Deliveries whose order is not in dm_orders, counted by why the order is missing."""
    unmatched = dims.orders_unmatched(w.order_docs, w.dim_timestamps, w.dim_users, w.dim_restaurants,
                                      watermark=None)
    d = w.deliveries.select("order_id")
    missing = d.join(w.dim_orders.select(F.col("order_key").alias("order_id")), "order_id", "left_anti")
    return (missing.join(unmatched.select(F.col("order_key").alias("order_id"), "reason"), "order_id", "left")
            .groupBy(F.coalesce(F.col("reason"), F.lit("missing")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("deliveries")))


# ---------------------------------------------------------------- extraction and watermarks (events)

@query("extract_by_id")
def extract_by_id(w: Warehouse):
    return incremental.extract_by_id(w.t.events)


@query("extract_bind_columns")
def extract_bind_columns(w: Warehouse):
    return incremental.extract_bind_columns(w.t.events)


@query("quarantine_split")
def quarantine_split(w: Warehouse):
    return incremental.quarantine_summary(w.t.events)


@query("extract_documents_since")
def extract_documents_since(w: Warehouse):
    return extract.since(w.t.events, "ts", params.EVENTS_WATERMARK).select("event_id", "ts", "user_id")


@query("extract_newest_n")
def extract_newest_n(w: Warehouse):
    """Top-k by design: the 1000 newest documents (the limit is the operator)."""
    return extract.newest_n(w.t.events.select("event_id", "ts"), 1000, ["ts", "event_id"])


@query("document_envelope")
def document_envelope(w: Warehouse):
    return extract.document_envelope(w.t.events, "event_id", "ts")


@query("window_yesterday")
def window_yesterday(w: Warehouse):
    return extract.window_yesterday(w.t.events, "ts", params.BATCH_CUT_2).select("event_id", "ts")


@query("watermark_read")
def watermark_read(w: Warehouse):
    return incremental.watermark_read(w.t.events)


@query("watermark_advance")
def watermark_advance(w: Warehouse):
    return incremental.watermark_advance(w.t.events)


@query("settings_upsert")
def settings_upsert(w: Warehouse):
    return incremental.settings_upsert(w.t.events)


@query("timestamps_time_of_day_filter")
def timestamps_time_of_day_filter(w: Warehouse):
    """The literal time-of-day watermark filter, counted per day."""
    kept = dims.timestamps_time_of_day_filter(w.t.events.withColumnRenamed("ts", "update_ts"))
    return kept.groupBy(F.to_date("update_ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query("load_report")
def load_report(w: Warehouse):
    return incremental.load_report(w.t.events)


@query("events_ordered")
def events_ordered(w: Warehouse):
    return incremental.events_ordered(w.t.events)


# ---------------------------------------------------------------- conflict policies

@query("append_facts")
def append_facts(w: Warehouse):
    return incremental.append_facts(w.t.events)


@query("insert_if_absent")
def insert_if_absent(w: Warehouse):
    return incremental.insert_if_absent(w.t.events)


@query("upsert_by_key")
def upsert_by_key(w: Warehouse):
    return incremental.upsert_by_key(w.t.events)


@query("upsert_composite_key")
def upsert_composite_key(w: Warehouse):
    return incremental.upsert_composite_key(w.t.events)


@query("upsert_partial")
def upsert_partial(w: Warehouse):
    return incremental.upsert_partial(w.t.events)


@query("courier_ledger_upsert")
def courier_ledger_upsert(w: Warehouse):
    """Ledger of rate-5 deliveries, then the full 2024 ledger upserted by (courier, year, month)."""
    keys = ["courier_id", "settlement_year", "settlement_month"]
    first = marts.courier_ledger(w.ledger_input.filter(F.col("rate") == 5), w.dim_couriers)
    update = w.courier_ledger().filter(F.col("settlement_year") == 2024)
    return conflict.upsert(first, update, keys, ["orders_count"])


@query("missing_tables")
def missing_tables(w: Warehouse):
    return contracts.missing_tables(w)


# ---------------------------------------------------------------- scalar functions

@query("json_paths")
def json_paths(w: Warehouse):
    e = w.t.events
    return e.select("event_id", J.path_text(F.col("props"), "$.k").cast("int").alias("k"),
                    J.path_text(F.col("props"), "$.missing").alias("missing"))


@query("timestamp_parts")
def timestamp_parts(w: Warehouse):
    parts = calendar_parts(F.col("ts"))
    return w.t.events.select("event_id", *[v.alias(k) for k, v in parts.items()],
                             trunc_second(F.col("ts")).alias("ts_second"))


@query("text_clean")
def text_clean(w: Warehouse):
    p = w.t.part
    decorated = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(") [x]"))
    return p.select("p_partkey",
                    F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("replaced"),
                    strip_brackets(decorated).alias("stripped"),
                    F.startswith(F.col("p_name"), F.lit("small")).alias("starts_small"),
                    F.endswith(F.col("p_name"), F.lit("gear")).alias("ends_gear"),
                    F.length(F.col("p_name")).alias("name_length"))


@query("fee_arithmetic")
def fee_arithmetic(w: Warehouse):
    li = w.t.lineitem
    g = li.groupBy("l_returnflag").agg(F.sum(cents_to_money(to_cents(F.col("l_extendedprice")))).alias("t"))
    fee = pct(F.col("t"), "0.25")
    return g.select("l_returnflag", F.col("t").cast(TOTAL).alias("total"), fee.cast(TOTAL).alias("fee"),
                    (F.col("t") - fee).cast(TOTAL).alias("remainder"))


# ---------------------------------------------------------------- contracts

for _name in ("qc_not_null", "qc_unique", "qc_unique_composite", "qc_foreign_key", "qc_check", "qc_defaults",
              "qc_contracts"):
    query(_name)(getattr(contracts, _name))
