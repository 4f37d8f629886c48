"""Documents with hostile text survive the JSON round trip; malformed ones are quarantined."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerwright.functions import json as J
from ledgerwright.plans import dims
from ledgerwright.sources import extract

HOSTILE = ['Café "Grill" (north) [1]', "Пельменная «Уют»", "a}, {b", "it's (x) ]y[", ""]


def test_restaurant_names_and_menu_survive(spark):
    rows = []
    for i, name in enumerate(HOSTILE):
        doc = {"_id": f"R{i}", "name": name, "menu": [{"_id": f"P{i}", "name": name + " (big)", "price": Decimal("12.50")}]}
        rows.append((f"R{i}", doc, dt.datetime(2023, 1, 1)))
    df = spark.createDataFrame(rows, "object_id string, d struct<_id:string,name:string,menu:array<struct<_id:string,name:string,price:decimal(14,2)>>>, update_ts timestamp_ntz")
    docs = df.select("object_id", J.to_text(F.col("d")).alias("object_value"), "update_ts")
    got = {r.restaurant_id: r.restaurant_name for r in dims.dim_restaurants(docs).collect()}
    assert got == {f"R{i}": n for i, n in enumerate(HOSTILE)}
    menu = {r.product_id: (r.product_name, r.product_name_clean, r.product_price)
            for r in dims.menu_explode(docs).collect()}
    assert menu["P0"][0] == 'Café "Grill" (north) [1] (big)'
    assert menu["P0"][1] == 'Café "Grill" north [1 big'
    assert str(menu["P1"][2]) == "12.50"


def test_malformed_documents_go_to_quarantine(spark):
    docs = spark.createDataFrame(
        [("1", '{"name": "ok"}'), ("2", '{"name": "broken"'), ("3", None), ("4", "[1, 2]"), ("5", "{'py': 'repr'}")],
        "object_id string, object_value string")
    good, bad = extract.split_malformed(docs, "object_value")
    assert sorted(r.object_id for r in good.collect()) == ["1", "4"]
    assert sorted(r.object_id for r in bad.collect()) == ["2", "3", "5"]


def test_missing_fields_parse_as_null(spark):
    docs = spark.createDataFrame([("O1", '{"_id": "O1", "final_status": "CLOSED"}', dt.datetime(2024, 1, 1))],
                                 "object_id string, object_value string, update_ts timestamp_ntz")
    r = dims.order_doc_fields(docs).collect()[0]
    assert r.restaurant_id is None and r.user_id is None and r.final_status == "CLOSED"


def test_quarantine_split_routes_bad_casts(spark):
    raw = spark.createDataFrame([("1", "4.70"), ("x", "1.00"), ("3", "n/a"), ("4", None)],
                                "id string, amount string")
    good, bad = extract.quarantine_split(raw, {"id": "bigint", "amount": "decimal(14,2)"})
    assert sorted((r.id, str(r.amount)) for r in good.collect()) == [(1, "4.70"), (4, "None")]
    assert sorted((r.id, r.failed_columns) for r in bad.collect()) == [("3", ["amount"]), ("x", ["id"])]


def test_api_deliveries_quarantine_bad_values(spark):
    good_page = ('[{"order_id":"O1","order_ts":"2024-10-01T10:00:00","delivery_id":"D1","courier_id":"C1",'
                 '"address":"a","delivery_ts":"2024-10-01T11:00:00","rate":5,"sum":100.50,"tip_sum":1.00},'
                 '{"order_id":"O2","order_ts":"2024-10-01T10:00:00","delivery_id":"D2","courier_id":"C1",'
                 '"address":"b","delivery_ts":"2024-10-01T11:00:00","rate":"4.7","sum":100.50,"tip_sum":1.00},'
                 '{"order_id":"O3","order_ts":"2024-10-01T10:00:00","delivery_id":"D3","courier_id":"C1",'
                 '"address":"c","delivery_ts":"not a time","rate":4,"sum":"abc","tip_sum":1.00}]')
    pages = spark.createDataFrame([(0, good_page)], "page_no bigint, content string")
    landing = dims.land_pages(pages)
    good, bad = dims.stg_deliveries_checked(landing)
    g = good.collect()
    assert [(r.delivery_id, r.rate, str(r.sum)) for r in g] == [("D1", 5, "100.50")]
    assert sorted((r.delivery_id, sorted(r.failed_columns)) for r in bad.collect()) == [
        ("D2", ["rate"]), ("D3", ["delivery_ts", "sum"])]
