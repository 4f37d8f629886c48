"""Shared Spark helpers of the text-corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it on a cluster. Only where that is unset, as
    in tests, a folder of its own is made and set as the checkpoint folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="corpus-")
        context.setCheckpointDir(named)
    return named.rstrip("/")


class Tables:
    """Written intermediate tables: they cut lineage and survive lost executors.

    Each operator call has a folder of its own below the shared folder. ``drop``
    removes a table that later tables no longer read, so disk use stays bounded.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.get(name, df)

    def get(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def crc32_mod(column: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids count as remainder 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % n, F.lit(0))


def partitions_for(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of a table that may be broadcast, as its counted rows and the widths of its columns tell.
BROADCAST_BYTES = 64 << 20
_WIDTHS = {"bigint": 8, "double": 8, "int": 4, "boolean": 1}


def bounded(table: DataFrame) -> DataFrame:
    """A written narrow table, to be broadcast only where its counted rows times their width are within the bound.

    Texts and arrays count as 64 bytes: only tables whose texts and arrays are short are given
    here. Beyond the bound the same join is a shuffled one, whose hot keys AQE splits.
    """
    width = 16 + sum(_WIDTHS.get(f.dataType.simpleString(), 64) for f in table.schema.fields)
    return F.broadcast(table) if table.count() * width <= BROADCAST_BYTES else table


def vocabulary_path(name: str) -> str:
    """The file of a public tokenizer, where this process runs; a name that is a path is taken as it is."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def components(tables: Tables, links: DataFrame, name: str, max_rounds: int = 40) -> DataFrame:
    """Connected components of ``links`` (a, b): rows (node, component = smallest node).

    Every round each node takes the smallest label among its neighbours (a
    partial aggregate, so a hub with many links is reduced before the shuffle)
    and then the label of its label, which halves long chains. Rounds end when
    no label changes; each round is a written table.
    """
    edges = tables.put(links.select("a", "b").where("a <> b").union(
        links.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct(), f"{name}-edges")
    labels = tables.put(edges.groupBy(F.col("a").alias("node"))
                        .agg(F.least(F.min("b"), F.first("a")).alias("component")), f"{name}-0")
    for k in range(1, max_rounds):
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        step = (labels.join(near, "node")
                .select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid")))
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        step = tables.put(step.join(jump, "mid", "left").select(
            "node", "old", F.least("mid", F.coalesce("far", "mid")).alias("component")), f"{name}-{k}")
        tables.drop(f"{name}-{k - 1}")
        labels = step.select("node", "component")
        if step.where("old <> component").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
