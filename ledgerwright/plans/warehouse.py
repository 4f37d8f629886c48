"""The warehouse over one scale factor: every layer as a lazily built DataFrame.

``Warehouse(spark, sf_dir)`` wires sources -> staging -> dds -> cdm exactly in
the dependency order of the original job (restaurants, timestamps, users,
couriers, deliveries, products, orders, facts, then the marts). Nothing is
computed until a query result is consumed; each attribute is a plan that
Catalyst prunes to the columns its consumer uses.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..sources import fixtures as fx
from ..sources.tables import Tables
from . import dims, facts, marts


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = Tables(spark, sf_dir)

    def copy(self) -> Warehouse:
        """The same warehouse without anything replaced."""
        out = object.__new__(Warehouse)
        out.spark, out.t = self.spark, self.t
        return out

    def replace(self, name: str, table: DataFrame) -> None:
        """Read a layer from ``table`` from now on, and build the layers above it from that."""
        self.__dict__[name] = table
        if name == "order_headers":
            self.__dict__["order_times"] = table.select("update_ts")

    # ------------------------------------------------ sources (staging contents)
    @cached_property
    def deliveries(self) -> DataFrame:
        """Staging deliveries as the courier API delivers them."""
        return fx.stg_deliveries(self.t)

    def couriers_batch(self, batch: int) -> DataFrame:
        e = fx.courier_entities(self.t, batch)
        return e.select(F.col("_id").alias("courier_id"), F.col("name").alias("courier_name"))

    @cached_property
    def order_docs(self) -> DataFrame:
        return fx.order_documents(self.t)

    @cached_property
    def order_headers(self) -> DataFrame:
        return dims.order_headers(self.order_docs)

    @cached_property
    def order_times(self) -> DataFrame:
        """Update times of orders: unparsed, so the documents' text is not even rendered."""
        return fx.order_documents(self.t, named=False).select("update_ts")

    @cached_property
    def restaurant_docs_v1(self) -> DataFrame:
        return fx.restaurant_documents(self.t, 1)

    @cached_property
    def restaurant_docs_v2(self) -> DataFrame:
        return fx.restaurant_documents(self.t, 2)

    @cached_property
    def user_docs(self) -> DataFrame:
        return fx.user_documents(self.t)

    @cached_property
    def bonus_events(self) -> DataFrame:
        return fx.bonus_events(self.t)

    # ------------------------------------------------ API landing path
    def delivery_landing(self) -> DataFrame:
        return dims.land_pages(fx.delivery_pages(self.t))

    def courier_landing(self, batch: int = 1) -> DataFrame:
        return dims.land_pages(fx.pages(fx.courier_entities(self.t, batch)))

    # ------------------------------------------------ dds
    @cached_property
    def dim_couriers(self) -> DataFrame:
        return dims.dim_couriers(self.couriers_batch(1), self.couriers_batch(2))

    @cached_property
    def dim_timestamps(self) -> DataFrame:
        return dims.dim_timestamps(self.order_times, self.deliveries)

    @cached_property
    def dim_deliveries(self) -> DataFrame:
        return dims.dim_deliveries(self.deliveries, self.dim_timestamps, self.dim_couriers)

    @cached_property
    def dim_restaurants(self) -> DataFrame:
        return dims.dim_restaurants(self.restaurant_docs_v1, self.restaurant_docs_v2)

    @cached_property
    def dim_users(self) -> DataFrame:
        return dims.dim_users(self.user_docs)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dims.dim_products([self.restaurant_docs_v1, self.restaurant_docs_v2], self.dim_restaurants)

    @cached_property
    def products_closed(self) -> DataFrame:
        return dims.products_versions_closed(self.dim_products)

    @cached_property
    def dim_orders(self) -> DataFrame:
        return dims.dim_orders(self.order_headers, self.dim_timestamps, self.dim_users, self.dim_restaurants)

    @cached_property
    def payment_lines(self) -> DataFrame:
        return facts.payment_lines(self.bonus_events)

    @cached_property
    def fact_lines(self) -> DataFrame:
        return facts.fact_lines(self.payment_lines, self.dim_orders, self.products_closed)

    # ------------------------------------------------ cdm inputs
    @cached_property
    def ledger_input(self) -> DataFrame:
        """Delivery measures the ledger reads (the dm_deliveries columns it needs).

        Calendar parts are derived from the delivery's own timestamp: every
        delivery second has exactly one row in the timestamp dimension, so a
        join with it would only repeat ``year``/``month`` of the same value.
        """
        return self.deliveries.select("delivery_id", "courier_id", "delivery_ts", "rate",
                                      F.col("sum").alias("order_sum"), "tip_sum")

    def courier_ledger(self) -> DataFrame:
        return marts.courier_ledger(self.ledger_input, self.dim_couriers)

    def courier_ledger_as_coded(self) -> DataFrame:
        return marts.courier_ledger_as_coded(self.ledger_input, self.dim_couriers)

    def courier_ledger_prev_month(self, run_date=params.RUN_DATE) -> DataFrame:
        return marts.courier_ledger(marts.restrict_to_month(self.ledger_input, run_date), self.dim_couriers)

    def settlement_report(self, distinct_orders: bool = True) -> DataFrame:
        lines = facts.closed_since(self.fact_lines)
        return marts.settlement_report(lines, self.dim_restaurants, params.SETTLEMENT_DATE, distinct_orders)
