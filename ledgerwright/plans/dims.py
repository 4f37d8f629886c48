"""Warehouse (dds) dimensions and links, each a DataFrame -> DataFrame function.

Natural keys are kept throughout: the stored-table writer adds surrogate
``xxhash64`` ids, the query results compare on natural keys.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params
from ..functions import json as J
from ..functions.text import strip_brackets
from ..functions.timeparts import calendar_parts, ntz, time_of_day, trunc_second
from ..operators.conflict import insert_if_absent, insert_if_absent_all, upsert_partial_all
from ..operators.dedup import last_by
from ..operators.skew import counted_salted_join
from ..operators.waiting import Lookup
from ..sources.extract import routed

OPEN_END = params.OPEN_END


# ---------------------------------------------------------------- API landing and staging

def land_pages(pages: DataFrame, run_ts: _dt.datetime = params.RUN_TS) -> DataFrame:
    """Landing table of an API: one JSON text per entity, unique on the text.

    Each page is a JSON array; its elements are kept as their raw JSON text
    (typing happens in staging, where bad values are quarantined rather than
    nulled). Pages overlap, so the same entity arrives more than once;
    uniqueness on the whole content keeps one copy. A page that is no JSON array
    lands as a single entity, its whole text, which staging rejects unless it
    is an object: no page vanishes. ``load_ts`` is the run time parameter.
    """
    items = J.parse(F.col("content"), J.T.ArrayType(J.T.StringType()))
    return (pages.select(F.explode(F.coalesce(items, F.array("content"))).alias("content"))
            .distinct()
            .withColumn("load_ts", ntz(run_ts)))


def stg_couriers(landing: DataFrame) -> DataFrame:
    """Typed couriers; landed text that is no JSON object holds none and stays in the landing table."""
    e = J.parse(F.col("content"), J.COURIER)
    return (landing.filter(F.json_object_keys("content").isNotNull())
            .select(e["_id"].alias("courier_id"), e["name"].alias("courier_name"), "load_ts"))


def route_deliveries(landing: DataFrame) -> DataFrame:
    """Landing -> staging deliveries, every landed row with its status (see ``extract.routed``).

    Text that is no JSON object, and a delivery whose value does not cast (a rating
    "4.7", an amount "abc"), are rejected with the reason instead of becoming NULL.
    """
    return routed(landing, "content", J.DELIVERY, "load_ts")


def stg_deliveries_checked(landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`route_deliveries` as (typed rows, rejected rows)."""
    every = route_deliveries(landing)
    return (every.filter("status = 'good'").select(*J.DELIVERY.names, "load_ts"),
            every.filter("status = 'rejected'").drop("status"))


def stg_deliveries(landing: DataFrame) -> DataFrame:
    good, _ = stg_deliveries_checked(landing)
    return good.select("order_id", "delivery_id", "courier_id", "address", "order_ts", "delivery_ts",
                       "rate", "sum", "tip_sum", "load_ts")


# ---------------------------------------------------------------- couriers, deliveries

def dim_couriers(*batches: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Couriers, first name wins: the batches are inserted if absent by courier_id, in order.

    All batches of a run are applied in one pass; an ``existing`` table is
    kept as is and only absent couriers are added.
    """
    cols = ["courier_id", "courier_name"]
    fresh = insert_if_absent_all([b.select(*cols) for b in batches], ["courier_id"], ["courier_name"])
    if existing is None:
        return fresh
    return insert_if_absent(existing.select(*cols), fresh, ["courier_id"], ["courier_name"])


def _earliest() -> Column:
    """The timestamp that stands for its second."""
    return F.min("ts").alias("dim_ts")


def timestamp_seconds(timestamps: DataFrame, mark: int) -> DataFrame:
    """The timestamps of a mark with their second."""
    return timestamps.filter(F.col("special_mark") == mark).select(trunc_second(F.col("ts")).alias("sec"), "ts")


def timestamp_keys(timestamps: DataFrame, mark: int) -> DataFrame:
    """One timestamp per (second, mark) for second-precision joins: the earliest."""
    return timestamp_seconds(timestamps, mark).groupBy("sec").agg(_earliest())


def _with_timestamp(rows: DataFrame, timestamps: DataFrame, mark: int, row_id: str) -> DataFrame:
    """``rows`` that have a timestamp of ``mark`` in their second ``sec``, with it.

    A second holding a large share of the rows is salted (AQE cannot split it: the
    timestamps arrive aggregated, and so partitioned, by the second).
    """
    return counted_salted_join(rows, timestamp_seconds(timestamps, mark), ["sec"], [row_id], measures=[_earliest()])


def dim_deliveries(deliveries: DataFrame, timestamps: DataFrame, couriers: DataFrame) -> DataFrame:
    """Deliveries that resolve to a delivery timestamp (second precision) and a courier.

    ``deliveries`` need their id, courier and time; of the other columns those that they have are kept.
    """
    d = deliveries.withColumn("sec", trunc_second(F.col("delivery_ts")))
    j = (_with_timestamp(d, timestamps, 1, "delivery_id")
          .join(couriers.select("courier_id"), "courier_id"))
    kept = {c: c for c in ("delivery_id", "order_id", "courier_id", "address", "delivery_ts", "rate")}
    return j.select(*[F.col(c).alias(name) for c, name in {**kept, "sum": "order_sum", "tip_sum": "tip_sum"}.items()
                      if c in deliveries.columns])


def delivery_lookups(timestamps: DataFrame, couriers: DataFrame) -> list[Lookup]:
    """What a delivery needs: a timestamp of its second and its courier, in this order."""
    return [Lookup("timestamp", timestamp_keys(timestamps, 1), "sec"), Lookup("courier", couriers.select("courier_id"), "courier_id")]


def resolved_deliveries(resolved: DataFrame) -> DataFrame:
    """:func:`dim_deliveries` of rows that :func:`delivery_lookups` were tried on."""
    return (resolved.filter(F.col("missing").isNull())
            .select("delivery_id", "order_id", "courier_id", "address", "delivery_ts", "rate",
                    F.col("sum").alias("order_sum"), "tip_sum"))


def join_second_precision(deliveries: DataFrame, timestamps: DataFrame) -> DataFrame:
    d = deliveries.select("delivery_id", trunc_second(F.col("delivery_ts")).alias("sec"))
    return _with_timestamp(d, timestamps, 1, "delivery_id").select("delivery_id", "dim_ts")


# ---------------------------------------------------------------- timestamps

def dim_timestamps(orders: DataFrame, deliveries: DataFrame,
                   order_watermark: _dt.datetime = params.DEFAULT_WATERMARK,
                   delivery_watermark: _dt.datetime = params.DEFAULT_WATERMARK) -> DataFrame:
    """Order update times (mark 0) and delivery times (mark 1), split into calendar parts.

    Each source is filtered by its own full-timestamp watermark; (ts, mark) is unique.
    """
    o = (orders.filter(F.col("update_ts") > ntz(order_watermark))
         .select(F.col("update_ts").alias("ts"), F.lit(0).alias("special_mark")))
    d = (deliveries.filter(F.col("delivery_ts") > ntz(delivery_watermark))
         .select(F.col("delivery_ts").alias("ts"), F.lit(1).alias("special_mark")))
    u = o.unionByName(d).distinct()
    parts = calendar_parts(F.col("ts"))
    return u.select("ts", *[v.alias(k) for k, v in parts.items()],
                    F.col("special_mark").cast("int").alias("special_mark"))


def timestamps_time_of_day_filter(orders: DataFrame, watermark_time: str = "12:00:00") -> DataFrame:
    """The original time-of-day filter: keep rows whose *time of day* is after the watermark's."""
    return orders.filter(time_of_day(F.col("update_ts")) > F.lit(watermark_time))


# ---------------------------------------------------------------- restaurants, users, products

def restaurant_rows(docs: DataFrame) -> DataFrame:
    doc = J.parse(F.col("object_value"), J.RESTAURANT_HEADER)
    return docs.select(F.col("object_id").alias("restaurant_id"), doc["name"].alias("restaurant_name"),
                       F.col("update_ts").alias("active_from"), ntz(OPEN_END).alias("active_to"))


def dim_restaurants(*doc_batches: DataFrame,
                    watermark: _dt.datetime = params.DEFAULT_WATERMARK) -> DataFrame:
    """Restaurants upserted by restaurant_id: name and active_from replaced, active_to kept.

    All document batches of a run are applied in one pass.
    """
    rows = [restaurant_rows(docs.filter(F.col("update_ts") > ntz(watermark))) for docs in doc_batches]
    return upsert_partial_all(rows, ["restaurant_id"], ["restaurant_name", "active_from"],
                              ["active_from", "restaurant_name"])


def dim_users(docs: DataFrame) -> DataFrame:
    """Users upserted by login: the newest document wins, then the greatest user_id."""
    doc = J.parse(F.col("object_value"), J.USER)
    rows = docs.select(F.col("object_id").alias("user_id"), doc["name"].alias("user_name"),
                       doc["login"].alias("user_login"), "update_ts")
    return last_by(rows, ["user_login"], ["update_ts", "user_id"]).select("user_id", "user_name", "user_login")


def menu_explode(docs: DataFrame) -> DataFrame:
    """Menu array of each restaurant document -> one row per product."""
    doc = J.parse(F.col("object_value"), J.RESTAURANT)
    items = docs.select(F.col("object_id").alias("restaurant_id"), F.explode(doc["menu"]).alias("m"))
    name = F.col("m.name")
    return items.select("restaurant_id", F.col("m._id").alias("product_id"), name.alias("product_name"),
                        strip_brackets(name).alias("product_name_clean"),
                        F.col("m.price").alias("product_price"))


def dim_products(doc_batches: list[DataFrame], restaurants: DataFrame,
                 watermark: _dt.datetime = params.DEFAULT_WATERMARK) -> DataFrame:
    """Product versions: every menu item of every new restaurant document, appended.

    A version starts at the document's update time; ``active_to`` is open.
    Only items of known restaurants are kept (inner join on the natural id).
    """
    out = None
    for docs in doc_batches:
        docs = docs.filter(F.col("update_ts") > ntz(watermark))
        doc = J.parse(F.col("object_value"), J.RESTAURANT)
        rows = docs.select(F.col("object_id").alias("restaurant_id"), F.col("update_ts").alias("active_from"),
                           F.explode(doc["menu"]).alias("m"))
        rows = rows.select("restaurant_id", F.col("m._id").alias("product_id"),
                           F.col("m.name").alias("product_name"),
                           F.coalesce(F.col("m.price"), F.lit(0).cast("decimal(14,2)")).alias("product_price"),
                           "active_from", ntz(OPEN_END).alias("active_to"))
        out = rows if out is None else out.unionByName(rows)
    return out.join(restaurants.select("restaurant_id"), "restaurant_id")


def products_versions_closed(products: DataFrame) -> DataFrame:
    """Close each version at the start of the next one of the same product."""
    w = Window.partitionBy("restaurant_id", "product_id").orderBy("active_from")
    return products.withColumn("active_to", F.coalesce(F.lead("active_from").over(w), ntz(OPEN_END)))


# ---------------------------------------------------------------- orders

def order_doc_fields(docs: DataFrame) -> DataFrame:
    doc = J.parse(F.col("object_value"), J.ORDER_HEADER)
    return docs.select(F.col("object_id").alias("order_id"), doc["restaurant"]["id"].alias("restaurant_id"),
                       doc["date"].alias("order_date"), doc["user"]["id"].alias("user_id"),
                       doc["final_status"].alias("final_status"))


def order_items_explode(docs: DataFrame) -> DataFrame:
    doc = J.parse(F.col("object_value"), J.ORDER)
    return (docs.select(F.col("object_id").alias("order_id"), F.explode(doc["order_items"]).alias("i"))
            .select("order_id", F.col("i.id").alias("product_id"), F.col("i.name").alias("product_name"),
                    F.col("i.price").alias("price"), F.col("i.quantity").alias("quantity")))


def order_statuses_explode(docs: DataFrame) -> DataFrame:
    doc = J.parse(F.col("object_value"), J.ORDER)
    return (docs.select(F.col("object_id").alias("order_id"), F.explode(doc["statuses"]).alias("s"))
            .select("order_id", F.col("s.status").alias("status"), F.col("s.dttm").alias("dttm")))


def order_headers(docs: DataFrame) -> DataFrame:
    """Typed header of each order document: its ids, date, last status and update time, parsed once."""
    return (J.parse_fields(docs, "object_value", J.ORDER_HEADER, "object_id", "update_ts")
            .select(F.col("object_id").alias("order_id"), F.col("restaurant.id").alias("restaurant_id"),
                    F.col("date").alias("order_date"), F.col("user.id").alias("user_id"), "final_status", "update_ts"))


def _order_candidates(headers: DataFrame, watermark: _dt.datetime | None) -> DataFrame:
    """Order headers with their second; ``watermark=None`` takes every order."""
    f = headers if "order_date" in headers.columns else order_headers(headers)
    if watermark is not None:
        f = f.filter(F.col("order_date") > ntz(watermark))
    return f.withColumn("sec", trunc_second(F.col("order_date")))


def dim_orders(docs: DataFrame, timestamps: DataFrame, users: DataFrame, restaurants: DataFrame,
               watermark: _dt.datetime = params.DEFAULT_WATERMARK) -> DataFrame:
    """Orders that resolve to an order timestamp (second precision, mark 0), a user and a restaurant.

    ``docs`` are order documents, or headers that :func:`order_headers` has parsed.
    """
    f = _order_candidates(docs, watermark)
    j = (_with_timestamp(f, timestamps, 0, "order_id")
          .join(users.select("user_id"), "user_id")
          .join(restaurants.select("restaurant_id"), "restaurant_id"))
    return j.select(F.col("order_id").alias("order_key"), "user_id", "restaurant_id",
                    F.col("dim_ts").alias("order_ts"), F.col("final_status").alias("order_status"))


def order_candidates(docs: DataFrame, watermark: _dt.datetime = params.DEFAULT_WATERMARK) -> DataFrame:
    """Headers of the orders dated after the watermark, with the second that their timestamp is found by."""
    return _order_candidates(docs, watermark)


def order_lookups(timestamps: DataFrame, users: DataFrame, restaurants: DataFrame) -> list[Lookup]:
    """What an order needs: a timestamp of its second, its restaurant and its user, in this order."""
    return [Lookup("timestamp", timestamp_keys(timestamps, 0), "sec"),
            Lookup("restaurant", restaurants.select("restaurant_id"), "restaurant_id"),
            Lookup("user", users.select("user_id"), "user_id")]


def resolved_orders(resolved: DataFrame) -> DataFrame:
    """:func:`dim_orders` of rows that :func:`order_lookups` were tried on."""
    return (resolved.filter(F.col("missing").isNull())
            .select(F.col("order_id").alias("order_key"), "user_id", "restaurant_id",
                    F.col("dim_ts").alias("order_ts"), F.col("final_status").alias("order_status")))


def orders_unmatched(docs: DataFrame, timestamps: DataFrame, users: DataFrame, restaurants: DataFrame,
                     watermark: _dt.datetime | None = params.DEFAULT_WATERMARK) -> DataFrame:
    """Orders the inner joins of :func:`dim_orders` drop, with the first failing lookup."""
    f = _order_candidates(docs, watermark)
    j = (f.join(timestamp_keys(timestamps, 0).withColumn("has_ts", F.lit(True)), "sec", "left")
          .join(restaurants.select("restaurant_id").withColumn("has_r", F.lit(True)), "restaurant_id", "left")
          .join(users.select("user_id").withColumn("has_u", F.lit(True)), "user_id", "left"))
    reason = (F.when(F.col("has_ts").isNull(), F.lit("timestamp"))
               .when(F.col("has_r").isNull(), F.lit("restaurant"))
               .when(F.col("has_u").isNull(), F.lit("user")))
    return (j.select(F.col("order_id").alias("order_key"), reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))

