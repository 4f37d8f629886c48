"""Every registered query against its DuckDB oracle (the driver's correctness gate, on sf0.001)."""

import pytest

import __spark_entry__ as E
from ledgerwright.plans import catalog
from ledgerwright.plans.oracle import SQL
from tests.conftest import SF_SMOKE
from tools.compare import differences, duck

QUERIES = catalog.queries()
ORACLE = {k: v for k, v in SQL.items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


def test_entry_registers_them_without_the_optional_operators(monkeypatch):
    import builtins
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name in ("corpus_pipeline", "tiktoken"):
            raise ModuleNotFoundError("not here", name=name)
        return real(name, *args, **kwargs)
    monkeypatch.setattr(builtins, "__import__", without)
    assert set(E.queries()) == set(QUERIES) and E.oracle_sql() == ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMOKE).toArrow()
    want = con.sql(ORACLE[name]).to_arrow_table()
    assert differences(got, want) == []


def test_document_envelope_rows(spark):
    out = E.queries()["document_envelope"](spark, SF_SMOKE)
    assert out.columns == ["object_id", "update_ts", "object_value"]
    assert out.count() == spark.read.parquet(f"{SF_SMOKE}/events.parquet").count()
    row = out.orderBy("object_id").first()
    assert row.object_value.startswith("{") and '"event_type"' in row.object_value


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["courier_id", "courier_name", "settlement_year", "settlement_month"]
    rows = df.collect()
    assert rows and all(r.settlement_year == 2024 and r.settlement_month == 10 for r in rows)
