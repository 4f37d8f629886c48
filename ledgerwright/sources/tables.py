"""Driver tables: one parquet file per table under an ``sf_dir``."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")


class Tables:
    """Lazy readers over the driver parquet files.

    Every accessor returns a plain ``spark.read.parquet`` DataFrame, so Catalyst
    prunes columns and pushes filters into the scan of whatever query uses it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.read("supplier")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def region(self) -> DataFrame:
        return self.read("region")
