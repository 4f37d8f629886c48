"""Independent DuckDB SQL for every registered query.

The oracle never goes through JSON documents, pages or conflict policies: it
computes each result directly from the driver tables with the same recipes,
written as plain SQL. ``||`` is used for concatenation and ``//`` for integer
division; every output column is cast to the type the Spark query returns.
"""

from __future__ import annotations

# ---------------------------------------------------------------- shared CTEs

MONEY = "DECIMAL(14,2)"


def m(cents: str) -> str:
    """bigint cents -> DECIMAL(14,2), exactly."""
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS {MONEY})"


DELIVERIES = f"""
dl AS (
  SELECT 'D' || l_orderkey || '-' || l_linenumber AS delivery_id,
         'O' || l_orderkey AS order_id,
         'C' || l_suppkey AS courier_id,
         'addr ' || l_orderkey AS address,
         l_shipdate + INTERVAL 28 YEAR AS order_ts,
         l_shipdate + INTERVAL 28 YEAR + to_seconds((l_orderkey * 37 + l_linenumber * 101) % 86400) AS delivery_ts,
         CAST(CASE l_suppkey % 4
                WHEN 0 THEN 5
                WHEN 1 THEN CASE WHEN l_partkey % 5 = 0 THEN 4 ELSE 5 END
                WHEN 2 THEN CASE WHEN l_partkey % 5 = 0 THEN 5 ELSE 4 END
                ELSE 2 + l_partkey % 3 END AS INTEGER) AS rate,
         CAST(round(l_extendedprice * 100) AS BIGINT) // 25 AS oc,
         CAST(round(l_tax * 100) AS INTEGER) AS taxp,
         l_partkey, l_orderkey, l_suppkey
  FROM lineitem),
dd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY delivery_id
                                 ORDER BY delivery_ts, courier_id, oc, taxp, l_partkey) AS rn
    FROM dl) WHERE rn = 1),
deliv AS (
  SELECT order_id, delivery_id, courier_id, address, order_ts, delivery_ts, rate,
         {m('oc')} AS sum, {m('(oc * taxp) // 100')} AS tip_sum, oc, (oc * taxp) // 100 AS tipc,
         l_orderkey, l_suppkey
  FROM dd)"""

COURIERS = """
cour AS (SELECT 'C' || s_suppkey AS courier_id, s_name AS courier_name FROM supplier)"""


def _ledger_groups(where: str = "") -> str:
    cands = ",\n         ".join(
        f"sum(greatest(sum * {p}, {mn})) AS c{i}"
        for i, (p, mn) in enumerate([("0.05", 100), ("0.07", 150), ("0.08", 175), ("0.10", 200)]))
    return f"""
lg AS (
  SELECT courier_id, year(delivery_ts) AS y, month(delivery_ts) AS mo,
         count(*) AS n, sum(rate) AS sr,
         CAST(sum(sum) AS DECIMAL(18,2)) AS total, CAST(sum(tip_sum) AS DECIMAL(18,2)) AS tips,
         {cands}
  FROM deliv {where}
  GROUP BY 1, 2, 3)"""


LEDGER_SELECT = f"""
SELECT lg.courier_id, cour.courier_name,
       CAST(y AS INTEGER) AS settlement_year, CAST(mo AS INTEGER) AS settlement_month,
       CAST(n AS BIGINT) AS orders_count,
       CAST(total AS {MONEY}) AS orders_total_sum,
       CAST(CAST((200 * sr + n) // (2 * n) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(4,2)) AS rate_avg,
       CAST(total * 0.25 AS {MONEY}) AS order_processing_fee,
       CAST(pay AS {MONEY}) AS courier_order_sum,
       CAST(tips AS {MONEY}) AS courier_tips_sum,
       CAST(pay + tips * 0.95 AS {MONEY}) AS courier_reward_sum
FROM (SELECT *, CAST(CASE WHEN 10 * sr < 40 * n THEN c0 WHEN 10 * sr < 45 * n THEN c1
                          WHEN 10 * sr < 49 * n THEN c2 ELSE c3 END AS DECIMAL(24,4)) AS pay
      FROM lg) lg
JOIN cour ON cour.courier_id = lg.courier_id"""

CODED_PAY = """CASE
    WHEN rate < 4 AND sum * 0.05 > 100 THEN sum * 0.05
    WHEN rate < 4 AND sum * 0.05 < 100 THEN 100
    WHEN rate < 4.5 AND sum * 0.07 > 150 THEN sum * 0.07
    WHEN rate < 4.5 AND sum * 0.07 < 150 THEN 150
    WHEN rate < 4.9 AND sum * 0.08 > 175 THEN sum * 0.08
    WHEN rate < 4.9 AND sum * 0.08 < 175 THEN 175
    WHEN rate >= 4.9 AND sum * 0.10 > 200 THEN sum * 0.10
    ELSE 200 END"""

LEDGER_CODED = f"""
WITH {DELIVERIES}, {COURIERS},
lg AS (
  SELECT courier_id, year(delivery_ts) AS y, month(delivery_ts) AS mo, count(*) AS n, sum(rate) AS sr,
         CAST(sum(sum) AS DECIMAL(18,2)) AS total, CAST(sum(tip_sum) AS DECIMAL(18,2)) AS tips,
         CAST(sum({CODED_PAY}) AS DECIMAL(24,4)) AS pay
  FROM deliv GROUP BY 1, 2, 3)
SELECT lg.courier_id, cour.courier_name,
       CAST(y AS INTEGER) AS settlement_year, CAST(mo AS INTEGER) AS settlement_month,
       CAST(n AS BIGINT) AS orders_count,
       CAST(total AS {MONEY}) AS orders_total_sum,
       CAST(CAST((200 * sr + n) // (2 * n) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(4,2)) AS rate_avg,
       CAST(total * 0.25 AS {MONEY}) AS order_processing_fee,
       CAST(pay AS {MONEY}) AS courier_order_sum,
       CAST(tips AS {MONEY}) AS courier_tips_sum,
       CAST((pay + tips) * 0.95 AS {MONEY}) AS courier_reward_sum
FROM lg JOIN cour ON cour.courier_id = lg.courier_id"""

DELIVERY_PAY_LINES = f"""
WITH {DELIVERIES},
st AS (SELECT courier_id, year(delivery_ts) AS y, month(delivery_ts) AS mo, count(*) AS n, sum(rate) AS sr
       FROM deliv GROUP BY 1, 2, 3),
j AS (SELECT d.delivery_id, d.courier_id, d.sum, st.n, st.sr,
             CASE WHEN 10 * sr < 40 * n THEN 0 WHEN 10 * sr < 45 * n THEN 1
                  WHEN 10 * sr < 49 * n THEN 2 ELSE 3 END AS t
      FROM deliv d JOIN st ON d.courier_id = st.courier_id
                          AND year(d.delivery_ts) = st.y AND month(d.delivery_ts) = st.mo)
SELECT delivery_id, courier_id,
       CAST(CAST((200 * sr + n) // (2 * n) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(4,2)) AS rate_avg,
       CAST([5, 7, 8, 10][t + 1] AS INTEGER) AS tier_percent,
       CAST(CASE t WHEN 0 THEN greatest(sum * 0.05, 100) WHEN 1 THEN greatest(sum * 0.07, 150)
                   WHEN 2 THEN greatest(sum * 0.08, 175) ELSE greatest(sum * 0.10, 200) END
            AS DECIMAL(14,4)) AS pay
FROM j"""


def ledger(where: str = "") -> str:
    return f"WITH {DELIVERIES}, {COURIERS}, {_ledger_groups(where)}\n{LEDGER_SELECT}"


SQL: dict[str, str] = {
    "courier_ledger": ledger(),
    "courier_ledger_as_coded": LEDGER_CODED,
    "courier_ledger_prev_month": ledger(
        "WHERE delivery_ts >= TIMESTAMP '2024-10-01 00:00:00' AND delivery_ts < TIMESTAMP '2024-11-01 00:00:00'"),
    "delivery_pay_lines": DELIVERY_PAY_LINES,
}


# ---------------------------------------------------------------- documents, dims, facts

ORDERS = """
od AS (
  SELECT 'O' || o_orderkey AS order_id,
         CASE WHEN ms.min_supp IS NULL THEN NULL ELSE 'R' || ms.min_supp END AS restaurant_id,
         o_orderdate + INTERVAL 28 YEAR + to_seconds((o_orderkey * 37) % 86400) AS order_date,
         'U' || o_custkey AS user_id,
         CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'CANCELLED' WHEN 'P' THEN 'DELIVERING'
              ELSE o_orderstatus END AS final_status,
         o_orderkey
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS min_supp FROM lineitem GROUP BY 1) ms
    ON ms.l_orderkey = o_orderkey),
odu AS (
  SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN order_date + INTERVAL 1 HOUR ELSE order_date END AS update_ts
  FROM od)"""

USERS = """
ud AS (
  SELECT 'U' || c_custkey AS user_id, c_name AS user_name,
         'user' || CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS user_login,
         TIMESTAMP '2022-06-01 00:00:00' + to_minutes(c_custkey) AS update_ts
  FROM customer),
du AS (
  SELECT user_id, user_name, user_login FROM (
    SELECT *, row_number() OVER (PARTITION BY user_login ORDER BY update_ts DESC, user_id DESC) AS rn FROM ud)
  WHERE rn = 1)"""

RESTAURANTS = """
r1 AS (
  SELECT s_suppkey, 'R' || s_suppkey AS restaurant_id,
         s_name || CASE WHEN s_suppkey % 10 = 0 THEN ' "Grill" (north) [1]' ELSE '' END AS name1,
         TIMESTAMP '2022-06-01 00:00:00' + to_hours(s_suppkey) AS ts1
  FROM supplier),
rest AS (
  SELECT restaurant_id,
         CASE WHEN s_suppkey % 7 = 0 THEN name1 || ' II' ELSE name1 END AS restaurant_name,
         CASE WHEN s_suppkey % 7 = 0 THEN ts1 + INTERVAL 1 YEAR ELSE ts1 END AS active_from,
         TIMESTAMP '2099-12-31 00:00:00' AS active_to,
         s_suppkey, ts1
  FROM r1)"""

MENU = """
menu AS (
  SELECT 'R' || l_suppkey AS restaurant_id, 'P' || l_partkey || '-' || l_suppkey AS product_id,
         p_name || CASE WHEN l_partkey % 9 = 0 THEN ' (' || p_brand || ') [hot]' ELSE '' END AS product_name,
         CAST(round(p_retailprice * 100) AS BIGINT) AS price1, l_suppkey
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) s JOIN part ON p_partkey = l_partkey),
prod AS (
  SELECT menu.restaurant_id, product_id, product_name, """ + m("price1") + """ AS product_price,
         r1.ts1 AS active_from, TIMESTAMP '2099-12-31 00:00:00' AS active_to,
         CASE WHEN l_suppkey % 7 = 0 THEN r1.ts1 + INTERVAL 1 YEAR ELSE TIMESTAMP '2099-12-31 00:00:00' END AS closed_to
  FROM menu JOIN r1 ON r1.s_suppkey = menu.l_suppkey
  UNION ALL
  SELECT menu.restaurant_id, product_id, product_name, """ + m("(price1 * 110) // 100") + """,
         r1.ts1 + INTERVAL 1 YEAR, TIMESTAMP '2099-12-31 00:00:00', TIMESTAMP '2099-12-31 00:00:00'
  FROM menu JOIN r1 ON r1.s_suppkey = menu.l_suppkey WHERE l_suppkey % 7 = 0)"""

PAYMENTS = """
pl0 AS (
  SELECT l_orderkey, l_partkey, l_suppkey, CAST(max(l_quantity) AS INTEGER) AS quantity,
         max(CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) AS price_cents,
         max(CAST(round(l_discount * 100) AS INTEGER)) AS discount_pct
  FROM lineitem GROUP BY 1, 2, 3),
pl AS (
  SELECT pl0.*, 'O' || l_orderkey AS order_id, 'P' || l_partkey || '-' || l_suppkey AS product_id,
         p_name AS product_name, CAST(quantity AS BIGINT) * price_cents AS cost_cents,
         (CAST(quantity AS BIGINT) * price_cents * discount_pct) // 100 AS bp_cents,
         (CAST(quantity AS BIGINT) * price_cents) // 50 AS bg_cents
  FROM pl0 LEFT JOIN part ON p_partkey = l_partkey)"""

DIM_ORDERS = f"""
tk0 AS (SELECT date_trunc('second', update_ts) AS sec, min(update_ts) AS dim_ts FROM odu
        WHERE update_ts > TIMESTAMP '2022-01-01 00:00:00' GROUP BY 1),
dord AS (
  SELECT odu.order_id AS order_key, odu.user_id, odu.restaurant_id, tk0.dim_ts AS order_ts,
         odu.final_status AS order_status
  FROM odu JOIN tk0 ON tk0.sec = date_trunc('second', odu.order_date)
           JOIN du ON du.user_id = odu.user_id
           JOIN rest ON rest.restaurant_id = odu.restaurant_id
  WHERE odu.order_date > TIMESTAMP '2022-01-01 00:00:00')"""

WH = f"{DELIVERIES}, {COURIERS}, {ORDERS}, {USERS}, {RESTAURANTS}, {DIM_ORDERS}"

FACTS = f"""
fl AS (
  SELECT pl.order_id, pl.product_id, pl.quantity AS count, {m('pl.price_cents')} AS price,
         {m('pl.cost_cents')} AS total_sum, {m('pl.bp_cents')} AS bonus_payment,
         {m('pl.bg_cents')} AS bonus_grant, dord.restaurant_id, dord.order_ts, dord.order_status
  FROM pl JOIN dord ON dord.order_key = pl.order_id
  WHERE pl.l_orderkey % 10 <> 0)"""


def _report(count: str) -> str:
    return f"""
WITH {WH}, {PAYMENTS}, {FACTS},
g AS (SELECT restaurant_id, {count} AS n, CAST(sum(total_sum) AS DECIMAL(18,2)) AS total,
             CAST(sum(bonus_payment) AS DECIMAL(18,2)) AS paid, CAST(sum(bonus_grant) AS DECIMAL(18,2)) AS granted
      FROM fl WHERE order_status = 'CLOSED' AND order_ts > TIMESTAMP '2026-01-01 00:00:00' GROUP BY 1)
SELECT g.restaurant_id, rest.restaurant_name, DATE '2029-12-10' AS settlement_date,
       CAST(n AS INTEGER) AS orders_count, CAST(total AS {MONEY}) AS orders_total_sum,
       CAST(paid AS {MONEY}) AS orders_bonus_payment_sum, CAST(granted AS {MONEY}) AS orders_bonus_granted_sum,
       CAST(total * 0.25 AS {MONEY}) AS order_processing_fee,
       CAST(total - paid - total * 0.25 AS {MONEY}) AS restaurant_reward_sum
FROM g JOIN rest ON rest.restaurant_id = g.restaurant_id"""


TS_ALL = """
tsu AS (
  SELECT DISTINCT update_ts AS ts, 0 AS special_mark FROM odu WHERE update_ts > TIMESTAMP '2022-01-01 00:00:00'
  UNION
  SELECT DISTINCT delivery_ts, 1 FROM deliv WHERE delivery_ts > TIMESTAMP '2022-01-01 00:00:00'),
tk1 AS (SELECT date_trunc('second', ts) AS sec, min(ts) AS dim_ts FROM tsu WHERE special_mark = 1 GROUP BY 1)"""

SQL.update({
    "stg_deliveries": f"WITH {DELIVERIES} SELECT order_id, delivery_id, courier_id, address, order_ts, "
                      "delivery_ts, rate, sum, tip_sum FROM deliv",
    "land_delivery_pages": f"WITH {DELIVERIES} SELECT delivery_id, order_id, courier_id, delivery_ts FROM deliv",
    "land_courier_pages": f"WITH {COURIERS} SELECT courier_id, courier_name FROM cour",
    "stg_couriers": "SELECT 'C' || s_suppkey AS courier_id, "
                    "s_name || CASE WHEN s_suppkey % 10 = 0 THEN ' Jr.' ELSE '' END AS courier_name FROM supplier",
    "dim_couriers": f"WITH {COURIERS} SELECT courier_id, courier_name FROM cour",
    "dim_timestamps": f"""WITH {DELIVERIES}, {ORDERS}, {TS_ALL}
SELECT ts, CAST(year(ts) AS SMALLINT) AS year, CAST(month(ts) AS SMALLINT) AS month,
       CAST(day(ts) AS SMALLINT) AS day, strftime(ts, '%H:%M:%S.%f') AS time, CAST(ts AS DATE) AS date,
       CAST(special_mark AS INTEGER) AS special_mark FROM tsu""",
    "join_second_precision": f"""WITH {DELIVERIES}, {ORDERS}, {TS_ALL}
SELECT delivery_id, dim_ts FROM deliv JOIN tk1 ON tk1.sec = date_trunc('second', deliv.delivery_ts)""",
    "dim_deliveries": f"""WITH {DELIVERIES}, {COURIERS}, {ORDERS}, {TS_ALL}
SELECT delivery_id, order_id, deliv.courier_id, address, delivery_ts, rate, sum AS order_sum, tip_sum
FROM deliv JOIN tk1 ON tk1.sec = date_trunc('second', deliv.delivery_ts)
           JOIN cour ON cour.courier_id = deliv.courier_id""",
    "dim_restaurants": f"WITH {RESTAURANTS} SELECT restaurant_id, restaurant_name, active_from, active_to FROM rest",
    "dim_users": f"WITH {USERS} SELECT user_id, user_name, user_login FROM du",
    "menu_explode": f"""WITH {RESTAURANTS}, {MENU}
SELECT restaurant_id, product_id, product_name, regexp_replace(product_name, '[()\\]]', '', 'g') AS product_name_clean,
       {m('price1')} AS product_price FROM menu""",
    "dim_products": f"""WITH {RESTAURANTS}, {MENU}
SELECT restaurant_id, product_id, product_name, product_price, active_from, active_to FROM prod""",
    "products_versions_closed": f"""WITH {RESTAURANTS}, {MENU}
SELECT restaurant_id, product_id, product_name, product_price, active_from, closed_to AS active_to FROM prod""",
    "order_doc_fields": f"WITH {ORDERS} SELECT order_id, restaurant_id, order_date, user_id, final_status FROM od",
    "order_items_explode": f"""WITH {PAYMENTS}
SELECT order_id, product_id, product_name, {m('price_cents')} AS price, quantity FROM pl""",
    "order_statuses_explode": f"""WITH {ORDERS}
SELECT order_id, 'OPEN' AS status, order_date AS dttm FROM odu
UNION ALL SELECT order_id, final_status, update_ts FROM odu""",
    "dim_orders": f"WITH {WH} SELECT order_key, user_id, restaurant_id, order_ts, order_status FROM dord",
    "orders_unmatched": f"""WITH {WH}
SELECT odu.order_id AS order_key,
       CASE WHEN tk0.sec IS NULL THEN 'timestamp' WHEN rest.restaurant_id IS NULL THEN 'restaurant'
            WHEN du.user_id IS NULL THEN 'user' END AS reason
FROM odu LEFT JOIN tk0 ON tk0.sec = date_trunc('second', odu.order_date)
         LEFT JOIN rest ON rest.restaurant_id = odu.restaurant_id
         LEFT JOIN du ON du.user_id = odu.user_id
WHERE odu.order_date > TIMESTAMP '2022-01-01 00:00:00'
  AND (tk0.sec IS NULL OR rest.restaurant_id IS NULL OR du.user_id IS NULL)""",
    "fct_product_sales": f"""WITH {WH}, {PAYMENTS}, {FACTS}
SELECT order_id, product_id, count, price, total_sum, bonus_payment, bonus_grant FROM fl""",
    "facts_unmatched": f"""WITH {WH}, {PAYMENTS}
SELECT pl.order_id, pl.product_id, 'order' AS reason
FROM pl LEFT JOIN dord ON dord.order_key = pl.order_id
WHERE pl.l_orderkey % 10 <> 0 AND dord.order_key IS NULL""",
    "settlement_report": _report("count(DISTINCT order_id)"),
    "settlement_report_as_coded": _report("count(*)"),
    "fk_deliveries_orders": f"""WITH {WH},
unm AS (
  SELECT odu.order_id,
         CASE WHEN tk0.sec IS NULL THEN 'timestamp' WHEN rest.restaurant_id IS NULL THEN 'restaurant'
              WHEN du.user_id IS NULL THEN 'user' END AS reason
  FROM odu LEFT JOIN tk0 ON tk0.sec = date_trunc('second', odu.order_date)
           LEFT JOIN rest ON rest.restaurant_id = odu.restaurant_id
           LEFT JOIN du ON du.user_id = odu.user_id)
SELECT coalesce(unm.reason, 'missing') AS reason, CAST(count(*) AS BIGINT) AS deliveries
FROM deliv LEFT JOIN dord ON dord.order_key = deliv.order_id
           LEFT JOIN unm ON unm.order_id = deliv.order_id
WHERE dord.order_key IS NULL
GROUP BY 1""",
})


SQL["route_deliveries"] = f"""WITH {DELIVERIES},
pe AS (
  SELECT l_orderkey // 40 AS page_no, l_orderkey, delivery_id FROM deliv
  UNION ALL
  SELECT l_orderkey // 40 - 1, l_orderkey, delivery_id FROM deliv WHERE l_orderkey % 40 < 10 AND l_orderkey >= 40)
SELECT DISTINCT CASE WHEN l_orderkey % 17 = 2 OR l_orderkey % 13 = 5 THEN 'rejected' ELSE 'good' END AS status,
       CASE WHEN l_orderkey % 17 = 2 THEN 'not an object' WHEN l_orderkey % 13 = 5 THEN 'rate' END AS reason,
       delivery_id AS item
FROM pe WHERE page_no % 11 <> 3
UNION ALL
SELECT 'rejected', 'not an object', 'page' FROM (SELECT DISTINCT page_no FROM pe WHERE page_no % 11 = 3)"""
SQL["route_payment_lines"] = f"""WITH {PAYMENTS},
ev AS (SELECT o_orderkey, CASE WHEN o_orderkey % 31 = 4 THEN 'event' WHEN o_orderkey % 29 = 3 THEN 'order_date' END AS fault
       FROM orders WHERE o_orderkey % 10 <> 0)
SELECT o_orderkey AS event_id, CAST(NULL AS INTEGER) AS line, 'rejected' AS status, fault AS reason,
       CAST(NULL AS VARCHAR) AS product_id, CAST(NULL AS {MONEY}) AS total_sum
FROM ev WHERE fault IS NOT NULL
UNION ALL
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY product_id) - 1 AS INTEGER),
       CASE WHEN l_orderkey % 37 = 5 THEN 'rejected' ELSE 'good' END, CASE WHEN l_orderkey % 37 = 5 THEN 'price' END,
       product_id, CASE WHEN l_orderkey % 37 = 5 THEN NULL ELSE {m('cost_cents')} END
FROM pl JOIN ev ON o_orderkey = l_orderkey WHERE fault IS NULL"""
SQL["fct_product_sales_by_time"] = SQL["fct_product_sales"]


# ---------------------------------------------------------------- ledger / report as CTEs

def ledger_cte(name: str, where: str = "") -> str:
    """A CTE ``name`` holding the documented ledger of the deliveries matching ``where``."""
    body = _ledger_groups(where).replace("lg AS (", f"{name}_g AS (", 1)
    sel = LEDGER_SELECT.replace("FROM lg) lg", f"FROM {name}_g) lg")
    return f"{body},\n{name} AS ({sel})"


def report_cte(name: str = "rep") -> str:
    """Payments, facts and a CTE ``name`` holding the (distinct-order) settlement report."""
    tail = _report("count(DISTINCT order_id)").split(f"{FACTS},", 1)[1]
    groups, select = tail.split("\nSELECT ", 1)
    groups = groups.replace("g AS (", f"{name}_g AS (", 1).strip()
    select = "SELECT " + select.replace("FROM g JOIN", f"FROM {name}_g g JOIN")
    return f"{PAYMENTS}, {FACTS}, {groups},\n{name} AS ({select})"


# ---------------------------------------------------------------- events: extraction, watermarks, policies

T1 = "TIMESTAMP '2024-01-11 00:00:00'"
T2 = "TIMESTAMP '2024-01-21 00:00:00'"
DEFAULT_WM = "TIMESTAMP '2022-01-01 00:00:00'"
TOTAL = "DECIMAL(20,2)"


def _last(partition: str, cols: str, where: str = "", desc: bool = True) -> str:
    d = "DESC" if desc else ""
    w = f"WHERE {where}" if where else ""
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {partition} "
            f"ORDER BY ts {d}, event_id {d}) AS rn FROM events {w}) WHERE rn = 1")


SQL.update({
    "extract_by_id": """SELECT event_id, event_type, value FROM events
WHERE event_id > (SELECT coalesce(max(event_id), -1) FROM events
                  WHERE event_id * 2 < (SELECT max(event_id) FROM events))""",
    "extract_bind_columns": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "quarantine_split": f"""WITH r AS (
  SELECT CAST(event_id AS VARCHAR) AS eid,
         CASE WHEN event_id % 17 = 0 THEN printf('%.2f', value) || 'x' ELSE printf('%.2f', value) END AS v
  FROM events),
k AS (SELECT TRY_CAST(v AS DECIMAL(14,2)) AS d,
             (TRY_CAST(eid AS BIGINT) IS NULL AND eid IS NOT NULL)
             OR (TRY_CAST(v AS DECIMAL(14,2)) IS NULL AND v IS NOT NULL) AS bad
      FROM r)
SELECT 'good' AS status, CAST(count(*) AS BIGINT) AS rows, CAST(sum(d) AS {TOTAL}) AS value_sum FROM k WHERE NOT bad
UNION ALL
SELECT 'bad', CAST(count(*) AS BIGINT), CAST(NULL AS {TOTAL}) FROM k WHERE bad""",
    "extract_documents_since": f"SELECT event_id, ts, user_id FROM events WHERE ts > {T2}",
    "extract_newest_n": "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000",
    "window_yesterday": f"SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND ts < {T2}",
    "watermark_read": f"""WITH c AS (SELECT event_type AS target, max(ts) AS w FROM events
           WHERE ts < {T1} AND event_type IN ('click', 'view') GROUP BY 1)
SELECT t.target, coalesce(c.w, {DEFAULT_WM}) AS watermark
FROM (SELECT DISTINCT event_type AS target FROM events) t LEFT JOIN c ON c.target = t.target""",
    "watermark_advance": f"""SELECT target, max(watermark) AS watermark FROM (
  SELECT event_type AS target, max(ts) AS watermark FROM events WHERE ts < {T1} GROUP BY 1
  UNION ALL
  SELECT event_type, max(ts) FROM events WHERE ts >= {T1} AND ts < {T2} AND event_type <> 'signup' GROUP BY 1)
GROUP BY 1""",
    "settings_upsert": f"""SELECT event_type AS key, event_id AS last_event_id, ts AS last_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY b DESC, ts DESC, event_id DESC) AS rn FROM (
    SELECT event_type, event_id, ts, CASE WHEN ts < {T1} THEN 1 ELSE 2 END AS b FROM events
    WHERE ts < {T1} OR (ts < {T2} AND event_type <> 'signup')))
WHERE rn = 1""",
    "timestamps_time_of_day_filter": """SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS rows FROM events
WHERE strftime(ts, '%H:%M:%S.%f') > '12:00:00' GROUP BY 1""",
    "load_report": f"""WITH c AS (
  SELECT event_type, max(ts) AS watermark FROM events WHERE ts < {T2} AND event_type <> 'signup' GROUP BY 1
  UNION ALL
  SELECT event_type, max(ts) FROM events WHERE event_type = 'signup' GROUP BY 1),
g AS (SELECT e.event_type, count(*) AS n,
             sum(CASE WHEN e.ts > coalesce(c.watermark, {DEFAULT_WM}) THEN 1 ELSE 0 END) AS k
      FROM events e LEFT JOIN c ON c.event_type = e.event_type GROUP BY 1)
SELECT event_type, CAST(n AS BIGINT) AS rows_read, CAST(k AS BIGINT) AS rows_new, k = 0 AS is_empty FROM g""",
    "events_ordered": _last("user_id", "user_id, event_id, ts"),
    "append_facts": f"""SELECT event_type, CAST(count(*) AS BIGINT) AS rows,
       CAST(sum({m('CAST(round(value * 100) AS BIGINT)')}) AS {TOTAL}) AS value_sum
FROM events GROUP BY 1""",
    "insert_if_absent": _last("user_id, event_type", "user_id, event_type, event_id", desc=False),
    "upsert_by_key": _last("user_id", "user_id, event_id, ts, value"),
    "upsert_composite_key": _last("user_id, event_type", "user_id, event_type, event_id, ts, value"),
    "upsert_partial": f"""WITH b AS (
  SELECT *, CASE WHEN ts < {T1} THEN 1 WHEN ts < {T2} THEN 2 ELSE 3 END AS batch FROM events),
lb AS (SELECT user_id, batch, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, batch ORDER BY ts DESC, event_id DESC) AS rn FROM b)
  WHERE rn = 1),
f AS (SELECT user_id, ts AS first_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch) AS rn FROM lb) WHERE rn = 1),
l AS (SELECT user_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch DESC) AS rn FROM lb) WHERE rn = 1)
SELECT l.user_id, l.value, f.first_ts FROM l JOIN f ON f.user_id = l.user_id""",
    "courier_ledger_upsert": f"""WITH {DELIVERIES}, {COURIERS}, {ledger_cte('full_l')}, {ledger_cte('five_l', 'WHERE rate = 5')}
SELECT * FROM five_l
WHERE (courier_id, settlement_year, settlement_month) NOT IN (
  SELECT (courier_id, settlement_year, settlement_month) FROM full_l WHERE settlement_year = 2024)
UNION ALL
SELECT * FROM full_l WHERE settlement_year = 2024""",
    "json_paths": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.missing') AS missing FROM events""",
    "timestamp_parts": """SELECT event_id, CAST(year(ts) AS SMALLINT) AS year, CAST(month(ts) AS SMALLINT) AS month,
       CAST(day(ts) AS SMALLINT) AS day, strftime(ts, '%H:%M:%S.%f') AS time, CAST(ts AS DATE) AS date,
       date_trunc('second', ts) AS ts_second FROM events""",
    "text_clean": """SELECT p_partkey, replace(p_name, ' ', '_') AS replaced,
       regexp_replace(p_name || ' (' || p_brand || ') [x]', '[()\\]]', '', 'g') AS stripped,
       starts_with(p_name, 'small') AS starts_small, ends_with(p_name, 'gear') AS ends_gear,
       CAST(length(p_name) AS INTEGER) AS name_length FROM part""",
    "fee_arithmetic": f"""SELECT l_returnflag, CAST(t AS {TOTAL}) AS total, CAST(t * 0.25 AS {TOTAL}) AS fee,
       CAST(t - t * 0.25 AS {TOTAL}) AS remainder
FROM (SELECT l_returnflag, CAST(sum({m('CAST(round(l_extendedprice * 100) AS BIGINT)')}) AS DECIMAL(20,2)) AS t
      FROM lineitem GROUP BY 1)""",
})


# ---------------------------------------------------------------- contracts

DIM_DELIVERIES = """
ddel AS (
  SELECT delivery_id, order_id, deliv.courier_id, address, delivery_ts, rate, sum AS order_sum, tip_sum
  FROM deliv JOIN tk1 ON tk1.sec = date_trunc('second', deliv.delivery_ts)
             JOIN cour ON cour.courier_id = deliv.courier_id),
dts AS (SELECT ts, year(ts) AS year, month(ts) AS month, day(ts) AS day, strftime(ts, '%H:%M:%S.%f') AS time,
               CAST(ts AS DATE) AS date, special_mark FROM tsu)"""



def _rows(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _nn(cte: str, table: str, cols: list[str]) -> list[str]:
    return [f"SELECT '{table}' AS \"table\", 'not_null:{c}' AS rule, "
            f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {cte}" for c in cols]


def _uq(cte: str, table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return (f"SELECT '{table}' AS \"table\", 'unique:{','.join(keys)}' AS rule, CAST(count(*) AS BIGINT) AS violations "
            f"FROM (SELECT {k} FROM {cte} WHERE {nn} GROUP BY {k} HAVING count(*) > 1)")


def _fk(cte: str, table: str, col: str, parent: str, pcol: str, pname: str) -> str:
    return (f"SELECT '{table}' AS \"table\", 'fk:{col}->{pname}' AS rule, CAST(count(*) AS BIGINT) AS violations "
            f"FROM {cte} c WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")


def _ck(cte: str, table: str, rules: dict[str, str]) -> list[str]:
    return [f"SELECT '{table}' AS \"table\", 'check:{n}' AS rule, "
            f"CAST(count(*) FILTER (WHERE NOT ({p})) AS BIGINT) AS violations FROM {cte}" for n, p in rules.items()]


def _df(cte: str, table: str, cols: list[str]) -> list[str]:
    return [f"SELECT '{table}' AS \"table\", 'default:{c}' AS rule, "
            f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {cte}" for c in cols]


_BASE = f"WITH {WH}, {TS_ALL}, {DIM_DELIVERIES}, {ledger_cte('led')}"
_FULL = f"{_BASE}, {MENU}, {report_cte('rep')}"
LEDGER_MONEY = ["orders_total_sum", "order_processing_fee", "courier_order_sum", "courier_tips_sum",
                "courier_reward_sum"]
FACT_MONEY = ["price", "total_sum", "bonus_payment", "bonus_grant"]


def _between(c: str, lo, hi) -> str:
    return f"{c} >= {lo} AND {c} <= {hi}"


REPORT_MONEY = ["orders_total_sum", "orders_bonus_payment_sum", "orders_bonus_granted_sum", "order_processing_fee",
                "restaurant_reward_sum"]


def _positive(*columns: str) -> dict[str, str]:
    return {c: f"{c} >= 0" for c in columns}


_QC = {
    "qc_not_null": (
        _nn("rest", "dm_restaurants", ["restaurant_id", "restaurant_name", "active_from", "active_to"])
        + _nn("du", "dm_users", ["user_id", "user_name", "user_login"])
        + _nn("dts", "dm_timestamps", ["ts", "year", "month", "day", "time", "date"])
        + _nn("prod", "dm_products", ["restaurant_id", "product_id", "product_name", "product_price", "active_from",
                                      "active_to"])
        + _nn("dord", "dm_orders", ["order_key", "user_id", "restaurant_id", "order_ts", "order_status"])
        + _nn("fl", "fct_product_sales", ["product_id", "order_id", "count", *FACT_MONEY])
        + _nn("cour", "dm_couriers", ["courier_id", "courier_name"])
        + _nn("ddel", "dm_deliveries", ["delivery_id", "order_id", "courier_id", "address", "delivery_ts", "rate",
                                        "order_sum", "tip_sum"])
        + _nn("led", "dm_courier_ledger", ["courier_id", "courier_name", "settlement_year", "settlement_month",
                                           "orders_count", "rate_avg", *LEDGER_MONEY])
        + _nn("rep", "dm_settlement_report", ["restaurant_id", "restaurant_name", "settlement_date", "orders_count",
                                              *REPORT_MONEY])
        + _nn("od", "ordersystem_orders", ["order_id", "restaurant_id", "order_date", "user_id"])),
    "qc_unique": [
        _uq("rest", "dm_restaurants", ["restaurant_id"]),
        _uq("du", "dm_users", ["user_id"]),
        _uq("du", "dm_users", ["user_login"]),
        _uq("dord", "dm_orders", ["order_key"]),
        _uq("cour", "dm_couriers", ["courier_id"]),
        _uq("ddel", "dm_deliveries", ["delivery_id"]),
        _uq("ud", "ordersystem_users", ["user_login"]),
        _uq("dl", "deliveries_raw", ["delivery_id"])],
    "qc_unique_composite": [
        _uq("tsu", "dm_timestamps", ["ts", "special_mark"]),
        _uq("fl", "fct_product_sales", ["order_id", "product_id"]),
        _uq("led", "dm_courier_ledger", ["courier_id", "settlement_year", "settlement_month"]),
        _uq("lineitem", "lineitem", ["l_orderkey", "l_linenumber"])],
    "qc_foreign_key": [
        _fk("prod", "dm_products", "restaurant_id", "rest", "restaurant_id", "dm_restaurants"),
        _fk("dord", "dm_orders", "user_id", "du", "user_id", "dm_users"),
        _fk("dord", "dm_orders", "restaurant_id", "rest", "restaurant_id", "dm_restaurants"),
        _fk("dord", "dm_orders", "order_ts", "tsu", "ts", "dm_timestamps"),
        _fk("fl", "fct_product_sales", "order_id", "dord", "order_key", "dm_orders"),
        _fk("fl", "fct_product_sales", "product_id", "prod", "product_id", "dm_products"),
        _fk("ddel", "dm_deliveries", "courier_id", "cour", "courier_id", "dm_couriers"),
        _fk("ddel", "dm_deliveries", "order_id", "dord", "order_key", "dm_orders"),
        _fk("ddel", "dm_deliveries", "delivery_ts", "tsu", "ts", "dm_timestamps"),
        _fk("led", "dm_courier_ledger", "courier_id", "cour", "courier_id", "dm_couriers"),
        _fk("rep", "dm_settlement_report", "restaurant_id", "rest", "restaurant_id", "dm_restaurants"),
        _fk("od", "ordersystem_orders", "restaurant_id", "rest", "restaurant_id", "dm_restaurants"),
        _fk("od", "ordersystem_orders", "user_id", "du", "user_id", "dm_users"),
        _fk("od", "ordersystem_orders", "order_date", "tsu", "ts", "dm_timestamps")],
    "qc_check": (
        _ck("dts", "dm_timestamps", {"year": _between("year", 2022, 2200), "month": _between("month", 1, 12),
                                     "day": _between("day", 1, 31)})
        + _ck("prod", "dm_products", _positive("product_price"))
        + _ck("fl", "fct_product_sales", _positive("count", *FACT_MONEY))
        + _ck("ddel", "dm_deliveries", _positive("order_sum"))
        + _ck("led", "dm_courier_ledger", {
            "settlement_year": _between("settlement_year", 2022, 2200),
            "settlement_month": _between("settlement_month", 1, 12),
            **_positive("orders_count", "rate_avg", *LEDGER_MONEY)})
        + _ck("rep", "dm_settlement_report", {
            "settlement_date": "settlement_date >= DATE '2022-01-01' AND settlement_date < DATE '2500-01-01'",
            **_positive("orders_count", *REPORT_MONEY)})
        + _ck("li", "lineitem", {"year": _between("year", 2022, 2200)})),
    "qc_defaults": (
        _df("tsu", "dm_timestamps", ["special_mark"])
        + _df("prod", "dm_products", ["product_price"])
        + _df("fl", "fct_product_sales", ["count", *FACT_MONEY])
        + _df("ddel", "dm_deliveries", ["tip_sum"])
        + _df("led", "dm_courier_ledger", LEDGER_MONEY + ["rate_avg"])
        + _df("rep", "dm_settlement_report", REPORT_MONEY)),
}
_QC["qc_contracts"] = [part for parts in list(_QC.values()) for part in parts]
SQL.update({name: f"{_FULL}, li AS (SELECT year(l_shipdate) AS year FROM lineitem)\n" + _rows(parts)
            for name, parts in _QC.items()})

_PRESENT = {
    "bonussystem_events": "orders", "ordersystem_orders": "od", "ordersystem_restaurants": "r1",
    "ordersystem_users": "ud", "couriers": "cour", "deliveries": "deliv", "api_couriers": "cour",
    "api_deliveries": "deliv", "dm_restaurants": "rest", "dm_users": "du", "dm_timestamps": "tsu",
    "dm_products": "prod", "dm_orders": "dord", "fct_product_sales": "fl", "dm_couriers": "cour",
    "dm_deliveries": "ddel", "dm_courier_ledger": "led", "dm_settlement_report": "rep",
}
_CONTRACT = ["srv_etl_settings", "bonussystem_users", "bonussystem_ranks", "bonussystem_events",
             "ordersystem_orders", "ordersystem_restaurants", "ordersystem_users", "couriers", "deliveries",
             "api_couriers", "api_deliveries", "dm_restaurants", "dm_users", "dm_timestamps", "dm_products",
             "dm_orders", "fct_product_sales", "dm_couriers", "dm_deliveries", "dm_courier_ledger",
             "dm_settlement_report"]

SQL["missing_tables"] = (
    f"{_FULL},\ncontract AS (SELECT * FROM (VALUES {', '.join(f'({chr(39)}{n}{chr(39)})' for n in _CONTRACT)}) t(table_name)),\n"
    "present AS (\n" + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name WHERE EXISTS (SELECT 1 FROM {c})" for n, c in _PRESENT.items())
    + ")\nSELECT table_name FROM contract WHERE table_name NOT IN (SELECT table_name FROM present)")

# The envelope's JSON text is compared byte for byte: DuckDB's to_json of the
# same struct writes the same compact text as Spark's for these columns.
SQL["document_envelope"] = """SELECT CAST(event_id AS VARCHAR) AS object_id, ts AS update_ts,
       to_json(struct_pack(user_id := user_id, event_type := event_type, value := value,
                           props := props))::VARCHAR AS object_value
FROM events"""
