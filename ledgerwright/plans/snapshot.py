"""Warehouse layers written once for a query that reads several of them.

The registered queries start from the driver tables, and a suite that checks ten tables
would rebuild their common inputs for each. :func:`stored` writes the layers a suite needs
in the order of the load, each from the ones already written, below the folder
that ``spark.checkpoint.dir`` names, and returns a warehouse that reads them.
Written tables also cut lineage, so a lost executor costs one layer.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_root
from .warehouse import Warehouse

#: Layers in load order, with the layers each is built from.
LAYERS: dict[str, tuple[str, ...]] = {
    "deliveries": (), "order_headers": (), "dim_couriers": (), "dim_restaurants": (), "dim_users": (),
    "dim_timestamps": ("deliveries", "order_headers"),
    "dim_products": ("dim_restaurants",),
    "dim_orders": ("order_headers", "dim_timestamps", "dim_users", "dim_restaurants"),
    "dim_deliveries": ("deliveries", "dim_timestamps", "dim_couriers"),
    "fact_lines": ("dim_orders", "dim_products"),
}


class Snapshot:
    """A folder of written tables; ``drop`` removes those that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def needed(names: Iterable[str]) -> list[str]:
    """``names`` and all layers below them, in load order."""
    wanted, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += LAYERS[name]
    return [n for n in LAYERS if n in wanted]


def stored(w: Warehouse, snapshot: Snapshot, names: Iterable[str],
           columns: Mapping[str, set[str]] | None = None) -> tuple[Warehouse, list[str]]:
    """A warehouse that reads ``names`` and their inputs from the snapshot, and the names written.

    ``columns`` names those of a layer that its readers use; a layer not in it is written whole.
    """
    out, written = w.copy(), needed(names)
    for name in written:
        layer = getattr(out, name)
        if columns and name in columns:
            layer = layer.select(*[c for c in layer.columns if c in columns[name]])
        out.replace(name, snapshot.put(layer, name))
    return out, written
