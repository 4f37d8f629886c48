"""A status that changes between two loads reaches the orders, their facts and the second report only."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerwright.operators.changes import row_changes
from ledgerwright.operators.tables import TableStore
from ledgerwright.plans import pipeline
from ledgerwright.plans.warehouse import Warehouse
from tests.conftest import SF_SMOKE


def test_row_changes(spark):
    schema = "k string, a string, b string, month int"
    old = spark.createDataFrame([("same", "x", None, 1), ("moved", "x", None, 1), ("nulls", None, "x", 1), ("gone", "x", "y", 1), (None, "x", "y", 1)], schema)
    new = spark.createDataFrame([("same", "x", None, 2), ("moved", "z", None, 2), ("nulls", "x", None, 2), ("new", None, None, 2), (None, "x", "y", 2)], schema)
    got = row_changes(old, new, ["k"], ["a", "b"], keep=["month"])
    assert got.columns == ["k", "a", "b", "month", "change"]
    assert sorted(map(tuple, got.collect())) == [("moved", "z", None, 1, "changed"), ("new", None, None, 2, "added"), ("nulls", "x", None, 1, "changed")]
    assert row_changes(old, old, ["k"], ["a", "b"]).count() == 0
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_open_then_closed_reaches_the_second_report(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    docs = Warehouse(spark, SF_SMOKE).order_docs
    late = F.col("object_id").rlike("[13]$")
    opened = docs.withColumn("object_value", F.when(late, F.regexp_replace(
        "object_value", '"final_status":"CLOSED"', '"final_status":"OPEN"')).otherwise(F.col("object_value")))
    first = pipeline.run(spark, SF_SMOKE, store, sources={"ordersystem_orders": opened})
    report = sorted(map(tuple, first["dm_settlement_report"].collect()))
    lines = first["fct_product_sales"].count()
    orders = first["dm_orders"].filter("order_status = 'OPEN'").count()
    assert orders > 0 and lines > 0
    second = pipeline.run(spark, SF_SMOKE, store)
    want = E.queries()["settlement_report"](spark, SF_SMOKE)
    got = sorted(map(tuple, second["dm_settlement_report"].select(*want.columns).collect()))
    assert got == sorted(map(tuple, want.collect())) and got != report
    changes = store.read("dm_orders_changes")
    assert changes.count() == changes.filter("change = 'changed' and order_status = 'CLOSED'").count() == orders
    facts = store.read("fct_product_sales")
    assert facts.count() == lines and store.read("dm_orders").filter("order_status = 'OPEN'").count() == 0
    stale = facts.join(store.read("dm_orders").select(F.col("order_key").alias("order_id"), F.col("order_status").alias("now")), "order_id")
    assert stale.count() == lines and stale.filter("order_status <> now").count() == 0
