"""Plan shape: pushdown, exchange counts, no Python evaluation, no cartesian products."""

import contextlib
import datetime as dt
import io
import re
import tempfile

import pytest

import __spark_entry__ as E
from ledgerwright.plans import marts
from ledgerwright.plans.warehouse import Warehouse
from tests.conftest import SF_SMOKE

QUERIES = E.queries()


def plan_of(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cartesian(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMOKE), "extended")
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                "PythonUDF"):
        assert bad not in p, bad


def test_ledger_over_stored_deliveries_has_one_shuffle(spark):
    w = Warehouse(spark, SF_SMOKE)
    path = tempfile.mkdtemp(prefix="lw-deliv-", dir="/tmp")
    w.ledger_input.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    couriers_path = tempfile.mkdtemp(prefix="lw-cour-", dir="/tmp")
    w.dim_couriers.write.mode("overwrite").parquet(couriers_path)
    p = plan_of(marts.courier_ledger(stored, spark.read.parquet(couriers_path)))
    shuffles = re.findall(r"Arguments: hashpartitioning", p)
    assert len(shuffles) == 1, p
    assert "Window" not in p and "SortMergeJoin" not in p


def test_ledger_month_filter_reaches_scan(spark):
    w = Warehouse(spark, SF_SMOKE)
    path = tempfile.mkdtemp(prefix="lw-deliv-", dir="/tmp")
    w.ledger_input.write.mode("overwrite").parquet(path)
    p = plan_of(marts.restrict_to_month(spark.read.parquet(path), dt.date(2024, 11, 10)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(delivery_ts,2024-10-01T00:00.*LessThan\(delivery_ts,2024-11-01", p)


def test_incremental_filter_reaches_scan(spark):
    p = plan_of(QUERIES["extract_documents_since"](spark, SF_SMOKE))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(ts,2024-01-21", p)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p


def test_high_watermark_is_a_pushed_scalar_subquery(spark):
    p = plan_of(QUERIES["extract_by_id"](spark, SF_SMOKE))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(event_id,ScalarSubquery", p)


def test_top_k_is_take_ordered(spark):
    p = plan_of(QUERIES["extract_newest_n"](spark, SF_SMOKE))
    assert "TakeOrderedAndProject" in p


def test_dedup_reduces_map_side(spark):
    """First/last-wins keeps a partial group limit before the shuffle (hot keys are reduced early)."""
    p = plan_of(QUERIES["stg_deliveries"](spark, SF_SMOKE), "extended")
    physical = p.split("== Physical Plan ==")[1]
    partial = physical.index("WindowGroupLimit")
    assert "Partial" in physical and physical.rindex("Exchange hashpartitioning") < physical.rindex("Partial")
    assert partial >= 0
