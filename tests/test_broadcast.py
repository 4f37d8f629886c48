"""Which side of a join goes through the driver: by its measured rows, not by the size of its compressed file."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerwright.session import CLUSTER_CONF, FILE_BROADCAST_BYTES, SESSION_CONF
from ledgerwright.sources import fixtures as fx
from ledgerwright.sources.tables import Tables

RUN_TIME_BYTES = int(SESSION_CONF["spark.sql.adaptive.autoBroadcastJoinThreshold"])


def joined(spark, keys, path) -> str:
    """The joins that ran when a few rows were joined, left, with the table at ``path``."""
    out = keys.join(spark.read.parquet(str(path)), "k", "left")
    plan = out._jdf.queryExecution().executedPlan()
    assert len(out.collect()) == keys.count()
    return " ".join(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan.toString().split("Initial Plan")[0]))


def file_bytes(path) -> int:
    return sum(p.stat().st_size for p in path.glob("*.parquet"))


def test_a_small_file_of_many_rows_is_not_broadcast(spark, tmp_path):
    path = tmp_path / "dense"
    n = 1_400_000
    spark.range(n).select(F.col("id").alias("k"), F.lit("same name").alias("name")).coalesce(1).write.parquet(str(path))
    assert FILE_BROADCAST_BYTES < file_bytes(path) < RUN_TIME_BYTES < n * 32   # a row takes 40 bytes
    assert joined(spark, spark.range(500).select((F.col("id") * 7).alias("k")), path) == "SortMergeJoin"


def test_a_larger_file_of_few_rows_is_broadcast_once_measured(spark, tmp_path):
    path = tmp_path / "sparse"
    name = F.concat(*[F.md5(F.concat(F.lit(x), F.col("id").cast("string"))) for x in "ab"])
    spark.range(60_000).select(F.col("id").alias("k"), name.alias("name")).coalesce(1).write.parquet(str(path))
    assert file_bytes(path) > FILE_BROADCAST_BYTES
    assert joined(spark, spark.range(500).select((F.col("id") * 7).alias("k")), path) == "BroadcastHashJoin"


@pytest.mark.parametrize("conf", [SESSION_CONF, CLUSTER_CONF])
def test_files_are_bounded_far_below_measured_rows(conf):
    limit = int(conf["spark.sql.autoBroadcastJoinThreshold"])
    assert 8 * limit <= int(conf["spark.sql.adaptive.autoBroadcastJoinThreshold"])


def test_documents_hold_the_same_names_however_the_parts_are_joined(spark, tmp_path):
    """Parts that repeat, that no line names, that are named by NULL: rows of both joins."""
    def write(name, sql):
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    write("part", "select * from values (1L, 'bolt', 'B1', 9.5D), (1L, 'bolt', 'B1', 9.5D), (1L, 'nut', 'B2', 9.5D), (2L, null, 'B1', 1D), "
                  "(null, 'lost', 'B1', 1D), (9L, 'unused', 'B1', 1D) as t(p_partkey, p_name, p_brand, p_retailprice)")
    write("lineitem", "select l_orderkey, l_partkey, l_suppkey, 1 l_linenumber, 2D l_quantity, 10D l_extendedprice, 0.05D l_discount from values "
                      "(1L, 1L, 1L), (1L, 1L, 1L), (1L, 2L, 1L), (2L, null, 1L), (2L, 3L, null), (null, 1L, 1L), (4L, 1L, 2L) as t(l_orderkey, l_partkey, l_suppkey)")
    write("orders", "select o_orderkey, 5L o_custkey, 'F' o_orderstatus, timestamp_ntz'1998-01-01 00:00:00' o_orderdate from values "
                    "(1L), (1L), (2L), (3L), (4L), (null) as t(o_orderkey)")
    t = Tables(spark, str(tmp_path))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        found = []
        for limit in ("33554432", "-1"):
            for k in old:
                spark.conf.set(k, limit)
            found.append([sorted(map(str, make(t).collect())) for make in (fx.order_documents, fx.bonus_events, fx.payment_lines)])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert found[0] == found[1]
    documents, events, lines = found[0]
    assert len(documents) == len(events) == 6 and len(lines) == 3 + 1 + 1 + 1 + 3
    first = next(d for d in documents if '"_id":"O1"' in d)
    assert first.count('"name":"bolt"') == 2 and first.count('"name":"nut"') == 1 and first.count('"id":"P2-1"') == 1
