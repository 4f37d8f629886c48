"""Source-system shaped inputs derived from the driver tables.

The settlement warehouse reads three source systems: a courier API (JSON pages
of couriers and deliveries), an order system (JSON documents of restaurants,
users and orders) and a bonus system (events with a JSON payload). None of them
ship with data, so each is rendered here from the driver tables by a fixed,
deterministic recipe. Every recipe is a DataFrame plan over the driver parquet,
so the inputs grow with the scale factor and nothing passes through the driver.

The recipes (shared with the DuckDB oracle in ``plans.oracle``):

* delivery: one per lineitem, deduplicated on (l_orderkey, l_linenumber)
* courier: one per supplier; order documents: one per order; restaurant
  documents: one per supplier with its supplied parts as the menu; user
  documents: one per customer; bonus events: one per order.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.json import to_text
from ..functions.money import cents_to_money, idiv, to_cents
from ..functions.timeparts import ntz, plus_hours, plus_seconds, shift_years
from ..operators.dedup import first_by
from .tables import Tables

# Fixed values of the recipes.
PAGE_STRIDE = 40          # a page starts every 40 keys ...
PAGE_OVERLAP = 10         # ... and repeats the first 10 keys of the next page (50 per page)
DOC_EPOCH = _dt.datetime(2022, 6, 1)
MENU_V2_EVERY = 7         # restaurants with s_suppkey % 7 = 0 publish a second menu ...
MENU_V2_DELAY_YEARS = 1   # ... one year later ...
MENU_V2_PRICE_PCT = 110   # ... with prices +10 %
LATE_ORDER_EVERY = 50     # orders with o_orderkey % 50 = 0 are updated one hour after their date
NO_BONUS_EVERY = 10       # orders with o_orderkey % 10 = 0 produce no bonus transaction
STATUS_BY_CODE = {"F": "CLOSED", "O": "CANCELLED", "P": "DELIVERING"}


def _id(prefix: str, *parts: Column) -> Column:
    out = [F.lit(prefix)]
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit("-"))
        out.append(p.cast("string"))
    return F.concat(*out)


# ---------------------------------------------------------------- deliveries

def delivery_lines(t: Tables) -> DataFrame:
    """One candidate delivery per lineitem, before deduplication (numeric columns only)."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate",
        idiv(to_cents(F.col("l_extendedprice")), 25).alias("oc"),
        F.round(F.col("l_tax") * 100).cast("int").alias("taxp"),
    )


def delivery_candidates(t: Tables) -> DataFrame:
    """Candidates with their delivery id (for contract checks on the raw input)."""
    return delivery_lines(t).select(
        _id("D", F.col("l_orderkey"), F.col("l_linenumber")).alias("delivery_id"), "*")


def stg_deliveries(t: Tables) -> DataFrame:
    """Staging contract of deliveries (see :func:`deliveries_keyed`)."""
    return deliveries_keyed(t).drop("l_orderkey")


def deliveries_keyed(t: Tables) -> DataFrame:
    """Staging deliveries plus their numeric order key: the first candidate per (order, line).

    Candidates are ordered by (delivery_ts, courier_id, order cents, tax percent,
    l_partkey). Inside one (order, line) the delivery time differs only by the
    ship day and the courier id only by the decimal text of the supplier key, so
    the same order is taken on those numeric/short fields. The deduplication
    runs on numeric keys with a narrow payload; ids, texts and timestamps are
    built afterwards, on the deduplicated rows only.
    """
    return delivery_rows(first_lines(t)).drop("l_linenumber")


def first_lines(t: Tables) -> DataFrame:
    """The first candidate per (order, line), narrow.

    The supplier key travels as its text alone, which orders the candidates and holds the key.
    So every reader of the deliveries, whatever it needs of them, has the same shuffle, and a
    query that reads them several times (their seconds, their rows) writes it once.
    """
    narrow = delivery_lines(t).withColumn("supp_text", F.col("l_suppkey").cast("string")).drop("l_suppkey")
    return first_by(narrow, ["l_orderkey", "l_linenumber"], ["l_shipdate", "supp_text", "oc", "taxp", "l_partkey"])


def delivery_rows(lines: DataFrame, *keep: str) -> DataFrame:
    """Ids, texts and timestamps of the lines of :func:`first_lines`, with the columns ``keep``."""
    d = lines.withColumn("l_suppkey", F.col("supp_text").cast("bigint"))
    sk4 = F.col("l_suppkey") % 4
    pk5 = (F.col("l_partkey") % 5) == 0
    rate = (F.when(sk4 == 0, F.lit(5))
             .when(sk4 == 1, F.when(pk5, F.lit(4)).otherwise(F.lit(5)))
             .when(sk4 == 2, F.when(pk5, F.lit(5)).otherwise(F.lit(4)))
             .otherwise(F.lit(2) + (F.col("l_partkey") % 3))).cast("int")
    day = shift_years(F.col("l_shipdate"), params.YEAR_SHIFT)
    secs = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101) % 86400
    tip_cents = idiv(F.col("oc") * F.col("taxp"), 100)
    # stated with the keys' presence, so that a filter on the time adds no filter of its own below the shuffle
    keyed = F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull()
    return d.select(
        *keep, "l_orderkey", "l_linenumber",
        _id("O", F.col("l_orderkey")).alias("order_id"),
        _id("D", F.col("l_orderkey"), F.col("l_linenumber")).alias("delivery_id"),
        _id("C", F.col("l_suppkey")).alias("courier_id"),
        F.concat(F.lit("addr "), F.col("l_orderkey").cast("string")).alias("address"),
        day.alias("order_ts"),
        F.when(keyed, plus_seconds(day, secs)).alias("delivery_ts"),
        rate.alias("rate"),
        cents_to_money(F.col("oc")).alias("sum"),
        cents_to_money(tip_cents).alias("tip_sum"),
    )


# ---------------------------------------------------------------- couriers

def courier_entities(t: Tables, batch: int = 1) -> DataFrame:
    """Courier API entities; batch 2 renames every tenth courier."""
    s = t.supplier
    name = F.col("s_name")
    if batch == 2:
        name = F.when(F.col("s_suppkey") % 10 == 0, F.concat(name, F.lit(" Jr."))).otherwise(name)
    return s.select(F.col("s_suppkey").alias("page_key"),
                    _id("C", F.col("s_suppkey")).alias("_id"), name.alias("name"))


DELIVERY_FIELDS = ["order_id", "order_ts", "delivery_id", "courier_id", "address", "delivery_ts", "rate", "sum", "tip_sum"]


def delivery_entities(t: Tables) -> DataFrame:
    """Delivery API entities (the staging deliveries with JSON field names)."""
    return deliveries_keyed(t).select(F.col("l_orderkey").alias("page_key"), *DELIVERY_FIELDS)


def pages(entities: DataFrame, stride: int = PAGE_STRIDE, overlap: int = PAGE_OVERLAP) -> DataFrame:
    """Group entities into JSON array pages; consecutive pages overlap.

    Page ``p`` holds the entities with ``page_key`` in ``[p*stride, p*stride + stride + overlap)``,
    so a page is bounded by the key density and keys near a page start appear twice.
    Output: (page_no bigint, content string JSON array).
    """
    fields = [c for c in entities.columns if c != "page_key"]
    body = F.struct(*[F.col(c) for c in fields])
    k = F.col("page_key")
    both = entities.select(F.explode(page_numbers(k, stride, overlap)).alias("page_no"), k.alias("k"), body.alias("e"))
    return (_page_items(both)
            .select("page_no", to_text(F.transform("items", lambda x: x["e"])).alias("content")))


def page_numbers(key: Column, stride: int = PAGE_STRIDE, overlap: int = PAGE_OVERLAP) -> Column:
    """The pages that hold an entity: its own, and the one before if its key is among the first of a page."""
    own = idiv(key, stride)
    return F.when((key % stride < overlap) & (key >= stride), F.array(own, own - 1)).otherwise(F.array(own))


def _page_items(rows: DataFrame) -> DataFrame:
    """Rows (page_no, k, e) -> each page with its sorted items."""
    return rows.groupBy("page_no").agg(F.sort_array(F.collect_list(F.struct("k", "e"))).alias("items"))


def _placed_deliveries(t: Tables) -> DataFrame:
    """Delivery entities with the pages they are on, all of a page in one task.

    The narrow lines are dealt to their pages, once, and the entities' texts are built
    where the page is: neither texts nor half-built pages are shuffled.
    """
    lines = first_lines(t).withColumn("page_no", F.explode(page_numbers(F.col("l_orderkey"))))
    return (delivery_rows(lines.repartition("page_no"), "page_no")
            .select("page_no", F.col("l_orderkey").alias("k"), *DELIVERY_FIELDS))


def delivery_pages(t: Tables) -> DataFrame:
    """``pages(delivery_entities(t))``, shuffled as narrow lines."""
    e = F.struct(*[F.col(c) for c in DELIVERY_FIELDS])
    return (_page_items(_placed_deliveries(t).select("page_no", "k", e.alias("e")))
            .select("page_no", to_text(F.transform("items", lambda x: x["e"])).alias("content")))


def damaged_delivery_pages(t: Tables) -> DataFrame:
    """Delivery pages with planted damage: cut pages, elements that are no objects, ratings that are no numbers.

    Orders with l_orderkey % 17 = 2 send bare ids, those with l_orderkey % 13 = 5 a rating
    "high"; pages with page_no % 11 = 3 lack their last character.
    """
    k = F.col("k")
    text = to_text(F.struct(*[F.col(c) for c in DELIVERY_FIELDS]))
    text = (F.when(k % 17 == 2, F.concat(F.lit('"'), F.col("delivery_id"), F.lit('"')))
            .when(k % 13 == 5, F.regexp_replace(text, '"rate":[0-9]+', '"rate":"high"')).otherwise(text))
    page = (_page_items(_placed_deliveries(t).select("page_no", k, text.alias("e")))
            .select("page_no", F.concat(F.lit("["), F.concat_ws(",", F.transform("items", lambda x: x["e"])), F.lit("]")).alias("content")))
    cut = F.expr("substring(content, 1, length(content) - 1)")
    return page.select("page_no", F.when(F.col("page_no") % 11 == 3, cut).otherwise(F.col("content")).alias("content"))


# ---------------------------------------------------------------- payment lines

def payment_lines(t: Tables, named: bool = True) -> DataFrame:
    """Bonus-system payment lines: lineitems grouped by (order, part, supplier).

    Output: l_orderkey, product_id, product_name, quantity int, price_cents, discount_pct,
    cost_cents, bonus_payment_cents, bonus_grant_cents. Lines of no order are left out.
    Without ``named`` the product name is NULL and a line stands once, whatever its parts.

    The lines get their names first and are then dealt by their order alone, so that grouping
    them here, and their documents above, needs no further exchange: one while the parts are
    broadcast, two where they are too many. A part that repeats repeats its lines: its rows are
    counted by name, which the grouped line keeps, and the line is repeated afterwards.
    """
    li = (t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
          .where(F.col("l_orderkey").isNotNull()))
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    if named:
        names = (t.part.groupBy(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("product_name"))
                 .agg(F.count(F.lit(1)).alias("copies")))
        li, keys = li.join(names, "l_partkey", "left"), [*keys, "product_name", "copies"]
    g = (li.repartition("l_orderkey").groupBy(*keys)
           .agg(F.max("l_quantity").cast("int").alias("quantity"),
                F.max(idiv(to_cents(F.col("l_extendedprice")), F.col("l_quantity").cast("bigint"))).alias("price_cents"),
                F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("discount_pct")))
    if named:
        one = F.lit(1).cast("bigint")
        g = g.withColumn("copy", F.explode(F.sequence(one, F.coalesce("copies", one))))
    else:
        g = g.withColumn("product_name", F.lit(None).cast("string"))
    cost = F.col("quantity").cast("bigint") * F.col("price_cents")
    return g.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        _id("P", F.col("l_partkey"), F.col("l_suppkey")).alias("product_id"),
        "product_name", "quantity", "price_cents", "discount_pct",
        cost.alias("cost_cents"),
        idiv(cost * F.col("discount_pct"), 100).alias("bonus_payment_cents"),
        idiv(cost, 50).alias("bonus_grant_cents"),
    )


# ---------------------------------------------------------------- order documents

def order_date(orderkey: Column, orderdate: Column) -> Column:
    return plus_seconds(shift_years(orderdate, params.YEAR_SHIFT), (orderkey * 37) % 86400)


def order_documents(t: Tables, named: bool = True) -> DataFrame:
    """Order-system documents: (object_id, object_value JSON, update_ts).

    Without ``named`` their items have no names, for readers of the times alone.
    """
    lines = payment_lines(t, named)
    per_order = (lines.groupBy("l_orderkey")
                 .agg(F.min("l_suppkey").alias("min_supp"),
                      F.sum("bonus_payment_cents").alias("bonus_cents"),
                      F.sort_array(F.collect_list(F.struct(
                          F.col("product_id").alias("id"),
                          F.col("product_name").alias("name"),
                          cents_to_money(F.col("price_cents")).alias("price"),
                          F.col("quantity")))).alias("order_items")))
    o = t.orders.join(per_order, t.orders["o_orderkey"] == per_order["l_orderkey"], "left")
    date = order_date(F.col("o_orderkey"), F.col("o_orderdate"))
    late = (F.col("o_orderkey") % LATE_ORDER_EVERY) == 0
    update_ts = F.when(late, plus_hours(date, F.lit(1))).otherwise(date)
    status = F.col("o_orderstatus")
    for code, name in STATUS_BY_CODE.items():
        status = F.when(F.col("o_orderstatus") == code, F.lit(name)).otherwise(status)
    o = o.select(F.col("o_orderkey"), F.col("o_custkey"), F.col("min_supp"), F.col("bonus_cents"),
                 F.col("order_items"), date.alias("date"), update_ts.alias("update_ts"),
                 status.alias("final_status"))
    doc = F.struct(
        _id("O", F.col("o_orderkey")).alias("_id"),
        F.struct(F.when(F.col("min_supp").isNotNull(), _id("R", F.col("min_supp"))).alias("id"))
         .alias("restaurant"),
        F.col("date"),
        F.struct(_id("U", F.col("o_custkey")).alias("id")).alias("user"),
        F.coalesce(F.col("order_items"), F.array().cast(
            "array<struct<id:string,name:string,price:decimal(14,2),quantity:int>>")).alias("order_items"),
        cents_to_money(F.coalesce(F.col("bonus_cents"), F.lit(0).cast("bigint"))).alias("bonus_payment"),
        F.array(F.struct(F.lit("OPEN").alias("status"), F.col("date").alias("dttm")),
                F.struct(F.col("final_status").alias("status"), F.col("update_ts").alias("dttm")))
         .alias("statuses"),
        F.col("final_status"),
    )
    return o.select(_id("O", F.col("o_orderkey")).alias("object_id"),
                    to_text(doc).alias("object_value"), F.col("update_ts"))


# ---------------------------------------------------------------- restaurant documents

def restaurant_documents(t: Tables, version: int = 1) -> DataFrame:
    """Restaurant documents with their menu; version 2 exists for every seventh restaurant."""
    # dealt by supplier alone: the parts of a menu are told apart and collected in the same task
    menu_rows = (t.lineitem.select("l_suppkey", "l_partkey").where(F.col("l_suppkey").isNotNull())
                 .repartition("l_suppkey").distinct()
                 .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand",
                                     "p_retailprice"), "l_partkey"))
    price = to_cents(F.col("p_retailprice"))
    if version == 2:
        price = idiv(price * MENU_V2_PRICE_PCT, 100)
    pname = F.when(F.col("l_partkey") % 9 == 0,
                   F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(") [hot]"))
                   ).otherwise(F.col("p_name"))
    menus = (menu_rows.groupBy("l_suppkey")
             .agg(F.sort_array(F.collect_list(F.struct(
                 _id("P", F.col("l_partkey"), F.col("l_suppkey")).alias("_id"),
                 pname.alias("name"),
                 cents_to_money(price).alias("price")))).alias("menu")))
    s = t.supplier
    if version == 2:
        s = s.filter(F.col("s_suppkey") % MENU_V2_EVERY == 0)
    s = s.join(menus, s["s_suppkey"] == menus["l_suppkey"], "left")
    name = F.when(F.col("s_suppkey") % 10 == 0,
                  F.concat(F.col("s_name"), F.lit(' "Grill" (north) [1]'))).otherwise(F.col("s_name"))
    if version == 2:
        name = F.concat(name, F.lit(" II"))
    update_ts = plus_hours(ntz(DOC_EPOCH), F.col("s_suppkey"))
    if version == 2:
        update_ts = shift_years(update_ts, MENU_V2_DELAY_YEARS)
    doc = F.struct(_id("R", F.col("s_suppkey")).alias("_id"), name.alias("name"),
                   F.coalesce(F.col("menu"), F.array().cast(
                       "array<struct<_id:string,name:string,price:decimal(14,2)>>")).alias("menu"))
    return s.select(_id("R", F.col("s_suppkey")).alias("object_id"),
                    to_text(doc).alias("object_value"), update_ts.alias("update_ts"))


# ---------------------------------------------------------------- user documents

def user_documents(t: Tables) -> DataFrame:
    """User documents; every customer with c_custkey % 10 = 9 reuses the previous login."""
    c = t.customer
    login_key = F.when(F.col("c_custkey") % 10 == 9, F.col("c_custkey") - 1).otherwise(F.col("c_custkey"))
    doc = F.struct(_id("U", F.col("c_custkey")).alias("_id"), F.col("c_name").alias("name"),
                   F.concat(F.lit("user"), login_key.cast("string")).alias("login"))
    update_ts = ntz(DOC_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("c_custkey").cast("int"))
    return c.select(_id("U", F.col("c_custkey")).alias("object_id"),
                    to_text(doc).alias("object_value"), update_ts.alias("update_ts"))


# ---------------------------------------------------------------- bonus events

def bonus_events(t: Tables) -> DataFrame:
    """Bonus-system events: (id, event_ts, event_type, event_value JSON)."""
    lines = payment_lines(t)
    per_order = (lines.groupBy("l_orderkey")
                 .agg(F.sort_array(F.collect_list(F.struct(
                     F.col("product_id"), F.col("product_name"),
                     cents_to_money(F.col("price_cents")).alias("price"),
                     F.col("quantity"),
                     cents_to_money(F.col("cost_cents")).alias("product_cost"),
                     cents_to_money(F.col("bonus_payment_cents")).alias("bonus_payment"),
                     cents_to_money(F.col("bonus_grant_cents")).alias("bonus_grant")))).alias("pp")))
    o = t.orders.join(per_order, t.orders["o_orderkey"] == per_order["l_orderkey"], "left")
    date = order_date(F.col("o_orderkey"), F.col("o_orderdate"))
    bonus = (F.col("o_orderkey") % NO_BONUS_EVERY) != 0
    payments = F.when(bonus, F.coalesce(F.col("pp"), F.array().cast(per_order.schema["pp"].dataType.simpleString())))
    value = F.struct(
        _id("U", F.col("o_custkey")).alias("user_id"),
        _id("O", F.col("o_orderkey")).alias("order_id"),
        F.date_format(date, "yyyy-MM-dd HH:mm:ss").alias("order_date"),
        payments.alias("product_payments"))
    return o.select(
        F.col("o_orderkey").alias("id"),
        plus_seconds(date, F.lit(300)).alias("event_ts"),
        F.when(bonus, F.lit("bonus_transaction")).otherwise(F.lit("user_rank")).alias("event_type"),
        to_text(value).alias("event_value"))


def damaged_bonus_events(t: Tables) -> DataFrame:
    """Bonus events with planted damage: id % 31 = 4 cut text, id % 29 = 3 no date, id % 37 = 5 prices that are no numbers."""
    v = F.col("event_value")
    return bonus_events(t).withColumn("event_value", F.when(F.col("id") % 31 == 4, F.expr("substring(event_value, 1, length(event_value) - 2)"))
                                      .when(F.col("id") % 29 == 3, F.regexp_replace(v, '"order_date":"[^"]*"', '"order_date":"someday"'))
                                      .when(F.col("id") % 37 == 5, F.regexp_replace(v, '"price":[0-9.]+', '"price":"1x"'))
                                      .otherwise(v))
