"""Compiled contracts: planted violations, one scan per table, hot keys reduced before the shuffle."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from ledgerwright.operators import contract as C
from ledgerwright.plans import contracts
from ledgerwright.plans.snapshot import Snapshot, needed
from ledgerwright.plans.warehouse import Warehouse
from tests.conftest import SF_SMOKE

def _contracts():
    return [
        C.Contract("parent", ["id"], {"size": F.col("size") >= 0}, ["size"], [["id"], ["id", "size"]]),
        C.Contract("child", ["parent_id"], unique=[["a", "b"]], foreign={"parent_id": ("parent", "id")}),
        C.Contract("other", foreign={"ref": ("parent", "id"), "second": ("parent", "id")}),
    ]


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "parent": spark.createDataFrame([("x", 1), ("x", 2), ("y", -1), (None, None), ("z", None)], "id string, size int"),
        "child": spark.createDataFrame([("x", "1:", "2"), ("x", "1", ":2"), ("q", "1", ":2"), (None, "1", None)] + [("gone", "k", str(i))
                                       for i in range(300)], "parent_id string, a string, b string"),
        "other": spark.createDataFrame([("y", "x"), ("gone", "x"), (None, None)], "ref string, second string")}


def _counts(df):
    return {(r.table, r.rule): r.violations for r in df.collect()}


def test_planted_violations(tables):
    got = _counts(C.evaluate(tables, C.rules(_contracts())))
    assert got == {
        ("parent", "not_null:id"): 1, ("parent", "check:size"): 1, ("parent", "default:size"): 2,
        ("parent", "unique:id"): 1, ("parent", "unique:id,size"): 0,
        ("child", "not_null:parent_id"): 1, ("child", "unique:a,b"): 1, ("child", "fk:parent_id->parent"): 301,
        ("other", "fk:ref->parent"): 1, ("other", "fk:second->parent"): 0}


@pytest.mark.parametrize("kinds,arity", [(("fk",), None), (("unique",), 1), (("unique",), 2), (("not_null", "check"), None)])
def test_a_part_of_the_rules_gives_the_same_counts(tables, kinds, arity):
    whole = _counts(C.evaluate(tables, C.rules(_contracts())))
    got = _counts(C.evaluate(tables, C.rules(_contracts(), kinds, arity)))
    assert got and all(whole[k] == v for k, v in got.items())
    assert {k[1].split(":")[0] for k in got} <= set(kinds)


def test_empty_tables_report_zero(tables):
    got = _counts(C.evaluate({n: t.limit(0) for n, t in tables.items()}, C.rules(_contracts())))
    assert len(got) == 10 and set(got.values()) == {0}


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_every_table_is_scanned_once_and_nothing_is_joined(spark, tables):
    snapshot = Snapshot(spark, "test")
    written = {n: snapshot.put(t, n) for n, t in tables.items()}
    plan = _plan(C.evaluate(written, C.rules(_contracts())))
    body = plan.split("== Initial Plan ==")[-1] if "== Initial Plan ==" in plan else plan
    tree = body.split("\n\n")[0]
    assert tree.count("Scan parquet") == 3
    assert tree.count("Join") == 1  # of the list of rules with their counts, after both aggregates
    assert "partial_sum" in plan


def test_the_whole_suite_reads_fourteen_tables_once(spark):
    w = Warehouse(spark, SF_SMOKE)
    found = C.rules(contracts.contracts())
    snapshot = Snapshot(spark, "test")
    tables, _ = contracts._tables(w, snapshot, C.tables_of(found))
    plan = _plan(C.evaluate(tables, found))
    assert plan.split("\n\n")[0].count("Scan parquet") == 14
    assert sum(r.kind == "fk" for r in found) == 14
    got = _counts(contracts.suite(w))
    for planted in (("deliveries_raw", "unique:delivery_id"), ("ordersystem_users", "unique:user_login"),
                    ("lineitem", "check:year"), ("ordersystem_orders", "fk:user_id->dm_users"),
                    ("ordersystem_orders", "fk:order_date->dm_timestamps"), ("dm_deliveries", "fk:order_id->dm_orders")):
        assert got[planted] > 0, planted
    assert all(v == 0 for k, v in got.items() if k[0] == "dm_orders")


def test_layers_come_after_their_inputs():
    order = needed(["fact_lines", "dim_deliveries"])
    assert order.index("dim_orders") < order.index("fact_lines") and order.index("dim_timestamps") < order.index("dim_deliveries")
    assert "dim_users" in order
