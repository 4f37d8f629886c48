"""The warehouse's table contracts, and suites (NOT NULL, UNIQUE, FOREIGN KEY, CHECK, DEFAULT) over them.

The produced tables carry the constraints of their definitions. Source-shaped inputs carry
planted violations: raw delivery lines repeat delivery ids, some order documents have no
restaurant, user documents share logins, orders are updated after their date, and the
unshifted driver dates fall before the contract years.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.contract import KINDS, Contract, columns_of, evaluate, rules, tables_of
from ..sources import fixtures as fx
from .snapshot import Snapshot, stored
from .warehouse import Warehouse

LEDGER_MONEY = ["orders_total_sum", "order_processing_fee", "courier_order_sum", "courier_tips_sum",
                "courier_reward_sum"]
FACT_MONEY = ["price", "total_sum", "bonus_payment", "bonus_grant"]
REPORT_MONEY = ["orders_total_sum", "orders_bonus_payment_sum", "orders_bonus_granted_sum", "order_processing_fee",
                "restaurant_reward_sum"]


def _in(c: str, lo, hi) -> F.Column:
    return (F.col(c) >= lo) & (F.col(c) <= hi)


def _positive(*columns: str) -> dict[str, F.Column]:
    return {c: F.col(c) >= 0 for c in columns}


def contracts() -> list[Contract]:
    """Every constraint of the warehouse tables, and the same rules on source-shaped inputs."""
    restaurants, users = ("dm_restaurants", "restaurant_id"), ("dm_users", "user_id")
    couriers, orders, times = ("dm_couriers", "courier_id"), ("dm_orders", "order_key"), ("dm_timestamps", "ts")
    years = {"year": _in("year", 2022, 2200)}
    return [
        Contract("dm_restaurants", ["restaurant_id", "restaurant_name", "active_from", "active_to"],
                 unique=[["restaurant_id"]]),
        Contract("dm_users", ["user_id", "user_name", "user_login"], unique=[["user_id"], ["user_login"]]),
        Contract("dm_timestamps", ["ts", "year", "month", "day", "time", "date"],
                 {**years, "month": _in("month", 1, 12), "day": _in("day", 1, 31)}, ["special_mark"],
                 [["ts", "special_mark"]]),
        Contract("dm_products", ["restaurant_id", "product_id", "product_name", "product_price", "active_from", "active_to"],
                 _positive("product_price"), ["product_price"], foreign={"restaurant_id": restaurants}),
        Contract("dm_orders", ["order_key", "user_id", "restaurant_id", "order_ts", "order_status"], unique=[["order_key"]],
                 foreign={"user_id": users, "restaurant_id": restaurants, "order_ts": times}),
        Contract("fct_product_sales", ["product_id", "order_id", "count", *FACT_MONEY], _positive("count", *FACT_MONEY),
                 ["count", *FACT_MONEY], [["order_id", "product_id"]],
                 {"order_id": orders, "product_id": ("dm_products", "product_id")}),
        Contract("dm_couriers", ["courier_id", "courier_name"], unique=[["courier_id"]]),
        Contract("dm_deliveries", ["delivery_id", "order_id", "courier_id", "address", "delivery_ts", "rate", "order_sum",
                                   "tip_sum"], _positive("order_sum"), ["tip_sum"], [["delivery_id"]],
                 {"courier_id": couriers, "order_id": orders, "delivery_ts": times}),
        Contract("dm_courier_ledger", ["courier_id", "courier_name", "settlement_year", "settlement_month", "orders_count",
                                       "rate_avg", *LEDGER_MONEY],
                 {"settlement_year": _in("settlement_year", 2022, 2200), "settlement_month": _in("settlement_month", 1, 12),
                  **_positive("orders_count", "rate_avg", *LEDGER_MONEY)}, [*LEDGER_MONEY, "rate_avg"],
                 [["courier_id", "settlement_year", "settlement_month"]], {"courier_id": couriers}),
        Contract("dm_settlement_report", ["restaurant_id", "restaurant_name", "settlement_date", "orders_count", *REPORT_MONEY],
                 {"settlement_date": (F.col("settlement_date") >= F.lit(_dt.date(2022, 1, 1)))
                  & (F.col("settlement_date") < F.lit(_dt.date(2500, 1, 1))), **_positive("orders_count", *REPORT_MONEY)},
                 REPORT_MONEY, foreign={"restaurant_id": restaurants}),
        # source-shaped inputs
        Contract("ordersystem_orders", ["order_id", "restaurant_id", "order_date", "user_id"],
                 foreign={"restaurant_id": restaurants, "user_id": users, "order_date": times}),
        Contract("ordersystem_users", unique=[["user_login"]]),
        Contract("deliveries_raw", unique=[["delivery_id"]]),
        Contract("lineitem", checks=years, unique=[["l_orderkey", "l_linenumber"]]),
    ]


#: Warehouse layer behind each produced table.
_LAYER = {"dm_restaurants": "dim_restaurants", "dm_users": "dim_users", "dm_timestamps": "dim_timestamps",
          "dm_products": "dim_products", "dm_orders": "dim_orders", "fct_product_sales": "fact_lines",
          "dm_couriers": "dim_couriers", "dm_deliveries": "dim_deliveries", "ordersystem_orders": "order_headers"}


#: What the layers and marts above read of a layer, beside what rules read. Layers not listed are narrow.
_READ_ABOVE = {
    "deliveries": {"delivery_id", "courier_id", "delivery_ts"},
    "dim_timestamps": {"ts", "special_mark"}, "dim_products": {"restaurant_id", "product_id", "active_from"},
    "dim_deliveries": set(), "fact_lines": {"order_id", "restaurant_id", "order_ts", "order_status"},
}


def _layer_columns(columns: dict[str, set[str]]) -> dict[str, set[str]]:
    """The columns of the wide layers that are read when rules read ``columns`` of the tables."""
    out = {layer: set(above) for layer, above in _READ_ABOVE.items()}
    for table, read in columns.items():
        if _LAYER.get(table) in out:
            out[_LAYER[table]] |= read
    if "dm_courier_ledger" in columns:
        out["deliveries"] |= {"rate", "sum", "tip_sum"}
    out["deliveries"] |= {"sum" if c == "order_sum" else c for c in columns.get("dm_deliveries", ())}
    if "dm_settlement_report" in columns:
        out["fact_lines"] |= {"total_sum", "bonus_payment", "bonus_grant"}
    return out


def _tables(w: Warehouse, snapshot: Snapshot, names: set[str],
            columns: dict[str, set[str]] | None = None) -> tuple[dict[str, DataFrame], list[str]]:
    """The named contract tables, produced ones written, and the names written.

    With ``columns``, those that rules read of each table, no other column of a wide layer is written.
    """
    marts = {"dm_courier_ledger": ("deliveries", "dim_couriers"), "dm_settlement_report": ("fact_lines", "dim_restaurants")}
    layers = [_LAYER[n] for n in names if n in _LAYER] + [x for n in names for x in marts.get(n, ())]
    own, written = stored(w, snapshot, layers, None if columns is None else _layer_columns(columns))
    out = {n: getattr(own, _LAYER[n]) for n in names if n in _LAYER}
    for name, make in (("dm_courier_ledger", own.courier_ledger), ("dm_settlement_report", own.settlement_report)):
        if name in names:
            out[name] = snapshot.put(make(), name)
            written.append(name)
    raw = {"ordersystem_users": lambda: w.user_docs.select(F.get_json_object("object_value", "$.login").alias("user_login")),
           "deliveries_raw": lambda: fx.delivery_candidates(w.t),
           "lineitem": lambda: w.t.lineitem.select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"))}
    return out | {n: make() for n, make in raw.items() if n in names}, written


def suite(w: Warehouse, kinds: tuple[str, ...] = KINDS, arity: int | None = None) -> DataFrame:
    """Rows (table, rule, violations) of the rules of ``kinds``: every table read once, from its written copy."""
    found = rules(contracts(), kinds, arity)
    snapshot = Snapshot(w.spark, "contracts")
    tables, written = _tables(w, snapshot, tables_of(found), columns_of(found))
    out = snapshot.put(evaluate(tables, found), "violations")
    snapshot.drop(*written)
    return out


def qc_not_null(w: Warehouse) -> DataFrame:
    return suite(w, ("not_null",))


def qc_unique(w: Warehouse) -> DataFrame:
    return suite(w, ("unique",), 1)


def qc_unique_composite(w: Warehouse) -> DataFrame:
    return suite(w, ("unique",), 2)


def qc_foreign_key(w: Warehouse) -> DataFrame:
    return suite(w, ("fk",))


def qc_check(w: Warehouse) -> DataFrame:
    return suite(w, ("check",))


def qc_defaults(w: Warehouse) -> DataFrame:
    return suite(w, ("default",))


def qc_contracts(w: Warehouse) -> DataFrame:
    """All rules of all tables in one pass."""
    return suite(w)


# Every table of the warehouse contract, by layer.
CONTRACT_TABLES = [
    "srv_etl_settings", "bonussystem_users", "bonussystem_ranks", "bonussystem_events",
    "ordersystem_orders", "ordersystem_restaurants", "ordersystem_users", "couriers", "deliveries",
    "api_couriers", "api_deliveries",
    "dm_restaurants", "dm_users", "dm_timestamps", "dm_products", "dm_orders", "fct_product_sales",
    "dm_couriers", "dm_deliveries",
    "dm_courier_ledger", "dm_settlement_report",
]


def present_tables(w: Warehouse) -> dict[str, DataFrame]:
    """Tables this warehouse produces from its sources."""
    return {
        "bonussystem_events": w.bonus_events, "ordersystem_orders": w.order_docs,
        "ordersystem_restaurants": w.restaurant_docs_v1, "ordersystem_users": w.user_docs,
        "couriers": w.couriers_batch(1), "deliveries": w.deliveries,
        "api_couriers": w.courier_landing(1), "api_deliveries": w.delivery_landing(),
        "dm_restaurants": w.dim_restaurants, "dm_users": w.dim_users, "dm_timestamps": w.dim_timestamps,
        "dm_products": w.dim_products, "dm_orders": w.dim_orders, "fct_product_sales": w.fact_lines,
        "dm_couriers": w.dim_couriers, "dm_deliveries": w.dim_deliveries,
        "dm_courier_ledger": w.courier_ledger(), "dm_settlement_report": w.settlement_report(),
    }


def missing_tables(w: Warehouse) -> DataFrame:
    """Contract tables that are absent or empty (the bootstrap check re-aimed at data)."""
    present = [df.limit(1).select(F.lit(name).alias("table_name"))
               for name, df in present_tables(w).items()]
    have = present[0]
    for p in present[1:]:
        have = have.unionByName(p)
    expected = w.spark.createDataFrame([(n,) for n in CONTRACT_TABLES], "table_name string")
    return expected.join(have, "table_name", "left_anti")
