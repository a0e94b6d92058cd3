"""SQL counterparts of the catalog, for an independent engine on the same tables.

They state each result in the plainest form (joins of every pair, window over the
whole group), not in the form the Spark operators use.
"""

from __future__ import annotations

import re

from mercata.functions import grounding as g
from mercata.operators import budget
from mercata.plans import testbed as t
from mercata.plans.catalog import FIRST_DAY, LAST_DAY
from mercata.sources.readers import NULL_TEXTS


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DAY = "strftime(event_date, '%Y%m%d')"
MICROS = "epoch_us({})"
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
SOURCE = f"CASE WHEN k % 12 = 9 THEN '<other>' ELSE {_list(s for s, _ in t.CLASSES)}[k % 6 + 1] END"
MEDIUM = f"{_list(m for _, m in t.CLASSES)}[k % 6 + 1]"
EVENT_CASE = "CASE event_type " + " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b in t.EVENT_NAME.items()) + " END"
TYPE_CASE = ("CASE WHEN medium LIKE '%cpc%' OR medium LIKE '%paid%' THEN 'paid' "
             "WHEN medium LIKE '%email%' THEN 'email' WHEN medium LIKE '%organic%' THEN 'organic' "
             "WHEN medium LIKE '%(none)%' OR medium LIKE '%direct%' THEN 'direct' "
             "WHEN medium LIKE '%referral%' THEN 'referral' ELSE 'other' END")


def pct(a: str, b: str) -> str:
    """a / b in percent, two decimals, half up, in whole numbers."""
    return (f"CASE WHEN {b} = 0 THEN NULL ELSE CAST((20000 * CAST({a} AS HUGEINT) + {b}) "
            f"// (2 * CAST({b} AS HUGEINT)) AS BIGINT) / 100.0 END")


def cents(c: str) -> str:
    return f"CAST(({c}) * 100 AS HUGEINT)"


def ratio(num_cents: str, den: str) -> str:
    """Cents over a whole number, two decimals, half up."""
    return (f"CASE WHEN {den} = 0 THEN NULL ELSE CAST((2 * {num_cents} + {den}) // (2 * {den}) "
            f"AS BIGINT) / 100.0 END")


# Named building blocks; each may use the ones it lists.
CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), f"""
        SELECT event_id, ts, CAST(ts AS DATE) AS event_date,
               CAST(user_id AS VARCHAR) AS user_pseudo_id, {EVENT_CASE} AS event_name,
               CAST(value AS DECIMAL(18,2)) AS value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events"""),
    "stg": (("ev",), f"""
        SELECT event_id, event_date, ts AS event_datetime, event_name, user_pseudo_id,
               CAST({DAY} AS BIGINT) AS ga_session_id, user_pseudo_id || '_' || {DAY} AS session_id,
               'https://shop.example/p/' || k AS page_location, {SOURCE} AS traffic_source,
               {MEDIUM} AS traffic_medium,
               CASE WHEN k % 6 = 1 THEN 'spring_sale' ELSE '(not set)' END AS campaign_name,
               {_list(t.DEVICES)}[k % 3 + 1] AS device_category,
               {_list(t.COUNTRIES)}[k % 4 + 1] AS country,
               CASE WHEN event_name = 'purchase' THEN 'T' || event_id END AS transaction_id,
               CASE WHEN event_name = 'purchase' THEN value END AS items_value
        FROM ev"""),
    # Nested view of the same events: missing session ids, item lists, unpriced items.
    "it": (("ev",), f"""
        SELECT *, 'SKU' || num AS item_id, 'Item ' || num AS item_name,
               'cat' || (num % 5) AS item_category,
               CASE WHEN (event_id + i) % 19 <> 0 THEN CAST(value + i AS DECIMAL(18,2)) END AS price,
               CAST(1 + (event_id + i) % 3 AS INTEGER) AS quantity
        FROM (SELECT *, (k * 7 + i * 13) % 50 AS num
              FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM ev))"""),
    "nested": (("ev", "it"), f"""
        SELECT ev.*, CASE WHEN event_id % 11 <> 0 THEN CAST({DAY} AS BIGINT) END AS ga_session_id,
               v.items_value
        FROM ev LEFT JOIN (SELECT event_id, SUM(price * quantity) AS items_value
                           FROM it GROUP BY event_id) v USING (event_id)"""),
    "sitems": (("it",), f"""
        SELECT event_date, ts AS event_datetime, user_pseudo_id, CAST({DAY} AS BIGINT) AS ga_session_id,
               user_pseudo_id || '_' || {DAY} AS session_id, event_name,
               CASE WHEN event_name = 'purchase' THEN 'T' || event_id END AS transaction_id,
               item_id, item_name, item_category, COALESCE(price, 0) AS price, quantity
        FROM it WHERE event_name <> 'page_view'"""),
    "raw1": (("stg",), f"""
        SELECT event_id * 2 AS line_no,
               CASE WHEN event_id % 97 = 0 THEN '2024-13-99' ELSE {DAY} END AS event_date,
               {MICROS.format('event_datetime')} AS event_timestamp, event_name,
               CASE WHEN event_id % 101 <> 0 THEN user_pseudo_id END AS user_pseudo_id,
               ga_session_id, page_location,
               CASE WHEN event_id % 17 <> 0 THEN traffic_source END AS traffic_source,
               CASE WHEN event_id % 19 <> 0 THEN traffic_medium END AS traffic_medium,
               campaign_name, device_category,
               CASE WHEN event_id % 31 <> 0 THEN country END AS country,
               CASE WHEN event_id % 13 <> 0 THEN transaction_id END AS transaction_id,
               CASE WHEN event_id % 29 = 0 THEN -items_value ELSE items_value END AS items_value,
               CASE WHEN event_id % 101 <> 0 THEN session_id END AS session_id
        FROM stg"""),
    "raw": (("raw1",), """
        SELECT * FROM raw1 UNION ALL
        SELECT * REPLACE (line_no + 1 AS line_no, 'repeated' AS campaign_name)
        FROM raw1 WHERE line_no % 46 = 0"""),
    "raw_u": (("raw",), """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_pseudo_id, event_name, event_timestamp
                                         ORDER BY line_no) AS rn FROM raw) WHERE rn = 1"""),
    "cln": (("raw_u",), """
        SELECT line_no, CAST(TRY_STRPTIME(event_date, '%Y%m%d') AS DATE) AS event_date,
               make_timestamp(event_timestamp) AS event_datetime, event_name, user_pseudo_id,
               ga_session_id, COALESCE(session_id, 'unknown_session') AS session_id, page_location,
               COALESCE(traffic_source, 'unknown') AS traffic_source,
               COALESCE(traffic_medium, 'unknown') AS traffic_medium,
               COALESCE(campaign_name, 'unknown') AS campaign_name,
               COALESCE(device_category, 'unknown') AS device_category,
               COALESCE(country, 'unknown') AS country, transaction_id,
               CASE WHEN items_value >= 0 THEN items_value END AS items_value,
               event_name = 'purchase' AND transaction_id IS NULL AS is_flagged_incomplete_purchase
        FROM raw_u WHERE user_pseudo_id IS NOT NULL AND event_name IS NOT NULL"""),
    "rit1": (("it",), f"""
        SELECT event_id * 8 + (i - 1) * 2 AS line_no, {DAY} AS event_date,
               {MICROS.format('ts')} AS event_timestamp, user_pseudo_id,
               CAST({DAY} AS BIGINT) AS ga_session_id, event_name,
               CASE WHEN event_name = 'purchase' THEN 'T' || event_id END AS transaction_id,
               CASE WHEN event_id % 37 <> 0 THEN item_id END AS item_id,
               CASE WHEN event_id % 41 <> 0 THEN item_name END AS item_name, item_category,
               CASE WHEN event_id % 43 = 0 THEN -price ELSE price END AS price,
               CASE WHEN event_id % 47 = 0 THEN -quantity WHEN event_id % 53 = 0 THEN 0
                    ELSE quantity END AS quantity,
               user_pseudo_id || '_' || {DAY} AS session_id
        FROM it WHERE event_name <> 'page_view'"""),
    "rit": (("rit1",), """
        SELECT * FROM rit1 UNION ALL
        SELECT * REPLACE (line_no + 1 AS line_no, 'repeated' AS item_category)
        FROM rit1 WHERE (line_no // 8) % 23 = 0"""),
    "cit": (("rit",), """
        SELECT * EXCLUDE (rn) FROM (
            SELECT * REPLACE (COALESCE(item_name, 'unknown') AS item_name,
                              COALESCE(item_category, 'unknown') AS item_category,
                              CASE WHEN price IS NULL OR price < 0 THEN 0 ELSE price END AS price,
                              CASE WHEN quantity IS NULL OR quantity < 0 THEN 1 ELSE quantity END
                                  AS quantity),
                   ROW_NUMBER() OVER (PARTITION BY user_pseudo_id, event_name, event_timestamp,
                                                   item_id ORDER BY line_no) AS rn
            FROM rit WHERE item_id IS NOT NULL) WHERE rn = 1"""),
    "chan": ((), "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{n}', '{ty}')" for i, n, ty in t.CHANNEL_ROWS)
        + ") v(channel_id, channel_name, channel_type)"),
    "schan": (("ev",), f"""
        SELECT k % 6 + 1 AS channel_id, lower(({SOURCE}) || ' / ' || ({MEDIUM})) AS channel_name,
               CASE WHEN event_id % 7 <> 0 THEN {_list(ty for _, _, ty in t.CHANNEL_ROWS)}[k % 6 + 1]
               END AS channel_type, event_id AS line_no
        FROM ev WHERE k % 6 < 5"""),
    "schan_u": (("schan",), """
        SELECT channel_id, channel_name, channel_type FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY channel_id ORDER BY line_no) AS rn FROM schan)
        WHERE rn = 1"""),
    "rcamp": (("ev",), """
        SELECT k AS campaign_id, CASE WHEN k <> 31 THEN 2 END AS channel_id,
               'google / cpc - Campaign ' || k AS campaign_name,
               CASE WHEN k % 5 = 0 THEN hi ELSE lo END AS start_date,
               CASE WHEN k % 5 = 0 THEN lo ELSE hi END AS end_date, budget
        FROM (SELECT k, budget, CAST(d AS DATE) + k % 20 AS lo, CAST(d AS DATE) + k % 20 + k % 9 AS hi
              FROM (SELECT k, date_trunc('month', MIN(event_date)) AS d, SUM(value) AS budget
                    FROM ev WHERE k % 6 = 1 GROUP BY k))"""),
    "camp": (("rcamp",), """
        SELECT campaign_id, channel_id, campaign_name,
               CASE WHEN end_date < start_date THEN end_date ELSE start_date END AS start_date,
               CASE WHEN end_date < start_date THEN start_date ELSE end_date END AS end_date, budget
        FROM rcamp WHERE channel_id IS NOT NULL"""),
    "daily": (("ev",), """
        SELECT 2 AS channel_id, event_date AS spend_date,
               CAST((CAST(SUM(value) * 100 AS BIGINT) + 1) // 2 / 100.0 AS DECIMAL(18,2)) AS amount
        FROM ev WHERE k % 6 = 1 AND event_name = 'add_to_cart' GROUP BY event_date"""),
    "g_cust": (("cln",), "SELECT user_pseudo_id, MIN(event_date) AS day FROM cln GROUP BY 1"),
    "g_sess": (("cln", "g_cust"), """
        SELECT session_id, CASE WHEN event_date IS NULL THEN 'null session_date'
                                WHEN day IS NULL THEN 'orphan customer_id' END AS reason
        FROM (SELECT session_id, user_pseudo_id, event_date, ROW_NUMBER() OVER (
                  PARTITION BY session_id ORDER BY event_datetime, line_no) AS rn FROM cln)
        JOIN g_cust USING (user_pseudo_id) WHERE rn = 1"""),
    "g_ord": (("cln", "g_cust", "g_sess"), """
        SELECT transaction_id, CASE WHEN event_date IS NULL THEN 'null order_date'
                                    WHEN items_value IS NULL THEN 'null order_total'
                                    WHEN day IS NULL THEN 'orphan customer_id'
                                    WHEN reason IS NOT NULL THEN 'orphan session_id' END AS reason
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
                                           ORDER BY event_datetime, line_no) AS rn
              FROM cln WHERE event_name = 'purchase' AND transaction_id IS NOT NULL)
        JOIN g_cust USING (user_pseudo_id) JOIN g_sess USING (session_id) WHERE rn = 1"""),
    "spend": (("daily", "camp"), """
        SELECT CAST(strftime(spend_date, '%Y%m%d') AS INTEGER) AS spend_id, channel_id,
               COALESCE((SELECT MIN(campaign_id) FROM camp c WHERE c.channel_id = d.channel_id
                           AND d.spend_date BETWEEN c.start_date AND c.end_date),
                        (SELECT MIN(campaign_id) FROM camp c WHERE c.channel_id = d.channel_id))
                   AS campaign_id, spend_date, amount
        FROM daily d"""),
    "rspend": (("ev",), """
        SELECT event_id AS line_no, 2 AS channel_id, k AS campaign_id, event_date AS spend_date,
               CASE WHEN event_id % 3 = 0 THEN -value WHEN event_id % 5 <> 0 THEN value END AS amount
        FROM ev WHERE k % 6 = 1 AND event_name = 'add_to_cart'"""),
    "sess": (("stg",), """
        SELECT session_id, user_pseudo_id AS customer_id, event_date AS session_date,
               traffic_source, traffic_medium, campaign_name, device_category
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY session_id
                                           ORDER BY event_datetime, event_id) AS rn FROM stg)
        WHERE rn = 1"""),
    "ord": (("stg",), """
        SELECT transaction_id AS order_id, user_pseudo_id AS customer_id, session_id,
               event_date AS order_date, items_value AS order_total
        FROM stg WHERE transaction_id IS NOT NULL"""),
    # Every session on or before each order, the last ten kept.
    "tp": (("ord", "sess", "chan"), """
        SELECT order_id, customer_id, order_date, order_total, session_date, session_id, channel_id,
               ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY session_date, session_id) AS pos
        FROM (SELECT o.order_id, o.customer_id, o.order_date, o.order_total, s.session_date,
                     s.session_id, c.channel_id,
                     ROW_NUMBER() OVER (PARTITION BY o.order_id
                                        ORDER BY s.session_date DESC, s.session_id DESC) AS recent
              FROM ord o JOIN sess s ON o.customer_id = s.customer_id
                                    AND s.session_date <= o.order_date
              LEFT JOIN chan c ON lower(s.traffic_source || ' / ' || s.traffic_medium)
                                = lower(c.channel_name))
        WHERE recent <= 10"""),
    "credit": (("tp",), """
        SELECT order_id, channel_id,
               CAST(order_total / COUNT(*) OVER (PARTITION BY order_id) AS DECIMAL(28,10)) AS linear,
               CAST(CAST(order_total AS DOUBLE) * w / SUM(w) OVER (PARTITION BY order_id)
                    AS DECIMAL(28,10)) AS time_decay
        FROM (SELECT *, pow(0.5, greatest(order_date - session_date, 0) / 7.0) AS w
              FROM tp WHERE channel_id IS NOT NULL)"""),
    "lc": (("ord", "sess", "chan"), """
        WITH sums AS (SELECT session_id, SUM(order_total) AS revenue, COUNT(DISTINCT order_id) AS n
                      FROM ord GROUP BY session_id),
             keyed AS (SELECT session_id, lower(concat_ws(' / ', traffic_source, traffic_medium)) AS name
                       FROM sess WHERE traffic_source IS NOT NULL AND traffic_medium IS NOT NULL),
             names AS (SELECT channel_id, lower(channel_name) AS name FROM chan)
        SELECT channel_id, 'last_click' AS attribution_model, SUM(revenue) AS attributed_revenue,
               CAST(SUM(n) AS BIGINT) AS attributed_orders
        FROM sums JOIN keyed USING (session_id) JOIN names USING (name) GROUP BY ALL"""),
    "multi": (("credit",), """
        SELECT channel_id, 'linear' AS attribution_model, ROUND(SUM(linear), 2) AS attributed_revenue,
               COUNT(DISTINCT order_id) AS attributed_orders FROM credit GROUP BY channel_id
        UNION ALL
        SELECT channel_id, 'time_decay', ROUND(SUM(time_decay), 2), COUNT(DISTINCT order_id)
        FROM credit GROUP BY channel_id"""),
    "cmp": (("lc", "multi", "chan"), """
        SELECT channel_name, attribution_model, CAST(attributed_revenue AS DECIMAL(28,2))
                   AS attributed_revenue, attributed_orders
        FROM (SELECT * FROM lc UNION ALL SELECT * FROM multi) JOIN chan USING (channel_id)"""),
    "funnel": (("stg", "sess"), f"""
        SELECT *, {pct('add_to_cart_customers', 'view_item_customers')} AS view_to_cart_rate_pct,
               {pct('begin_checkout_customers', 'add_to_cart_customers')} AS cart_to_checkout_rate_pct,
               {pct('purchase_customers', 'begin_checkout_customers')} AS checkout_to_purchase_rate_pct,
               {pct('purchase_customers', 'view_item_customers')} AS overall_conversion_rate_pct
        FROM (SELECT s.traffic_source, s.traffic_medium, """ + ", ".join(
        f"COUNT(DISTINCT CASE WHEN e.event_name = '{n}' THEN s.customer_id END) AS {n}_customers"
        for n in ("view_item", "add_to_cart", "begin_checkout", "purchase")) + """
              FROM stg e JOIN sess s ON e.session_id = s.session_id GROUP BY 1, 2)"""),
    "first_s": (("sess",), """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
                                         ORDER BY session_date, session_id) AS rn FROM sess)
        WHERE rn = 1"""),
    "payers": (("first_s", "ord", "chan"), """
        WITH names AS (SELECT channel_id, lower(channel_name) AS name FROM chan),
             won AS (SELECT lower(concat_ws(' / ', traffic_source, traffic_medium)) AS name, COUNT(*) AS n
                     FROM first_s SEMI JOIN ord USING (customer_id)
                     WHERE traffic_source IS NOT NULL AND traffic_medium IS NOT NULL GROUP BY 1)
        SELECT channel_id, CAST(SUM(n) AS BIGINT) AS new_paying_customers
        FROM won JOIN names USING (name) GROUP BY ALL"""),
    "cac": (("chan", "spend", "lc", "payers"), f"""
        SELECT channel_id, channel_name, channel_type, COALESCE(s, 0) AS total_spend,
               COALESCE(attributed_orders, 0) AS total_orders,
               COALESCE(attributed_revenue, 0) AS total_revenue,
               COALESCE(new_paying_customers, 0) AS new_paying_customers,
               CASE WHEN channel_type = 'paid' THEN
                   {ratio(cents('s'), 'new_paying_customers')} END AS cac,
               CASE WHEN channel_type = 'paid' THEN
                   {ratio('100 * ' + cents('attributed_revenue'), cents('s'))} END AS roas
        FROM chan LEFT JOIN (SELECT channel_id, SUM(amount) AS s FROM spend GROUP BY 1)
             USING (channel_id)
        LEFT JOIN lc USING (channel_id) LEFT JOIN payers USING (channel_id)"""),
    # Order family.
    "oo": ((), """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_custkey || '_' || strftime(o_orderdate, '%Y%m%d') AS session_id,
               CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS order_total FROM orders"""),
    "os": ((), f"""
        SELECT o_custkey || '_' || strftime(d, '%Y%m%d') AS session_id,
               CAST(o_custkey AS VARCHAR) AS customer_id, d AS session_date,
               {_list(s for s, _ in t.CLASSES)}[cls] AS traffic_source,
               {_list(m for _, m in t.CLASSES)}[cls] AS traffic_medium
        FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d,
                     CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS cls,
                     ROW_NUMBER() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                        ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1"""),
    "op": ((), """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(18,2)) AS base_price FROM part"""),
    "oi": ((), """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
                    AS DECIMAL(18,2)) AS unit_price
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "oc": ((), """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders WHERE o_custkey = c_custkey)
                   AS first_seen_date, n_name AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""),
    "ltv": (("oo", "os"), f"""
        SELECT f.customer_id, f.traffic_source AS acquisition_source,
               f.traffic_medium AS acquisition_medium, f.session_date AS acquisition_date,
               COALESCE(n, 0) AS total_orders, COALESCE(revenue, 0) AS historical_ltv,
               first_order_date, last_order_date,
               {ratio(cents('revenue'), 'n')} AS average_order_value
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
                                           ORDER BY session_date, session_id) AS rn FROM os) f
        LEFT JOIN (SELECT customer_id, COUNT(DISTINCT order_id) AS n, SUM(order_total) AS revenue,
                          MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
                   FROM oo GROUP BY 1) o ON f.customer_id = o.customer_id
        WHERE rn = 1"""),
    "pay": (("ltv",), "SELECT CAST(historical_ltv AS DOUBLE) AS x FROM ltv WHERE total_orders > 0"),
    "price": (("oi", "op"), f"""
        SELECT product_id, product_name, category, base_price,
               {ratio('ps', 'np')} AS avg_selling_price,
               COALESCE({pct('GREATEST(np * b - ps, 0)', '(np * b)')}, 0) AS discount_pct,
               times_purchased, product_revenue
        FROM (SELECT product_id, COUNT(DISTINCT order_id) AS times_purchased,
                     SUM(quantity * unit_price) AS product_revenue, COUNT(unit_price) AS np,
                     {cents('SUM(unit_price)')} AS ps FROM oi GROUP BY 1)
        JOIN (SELECT *, {cents('base_price')} AS b FROM op) USING (product_id)"""),
    "cohort": (("oo",), """
        SELECT CAST(date_trunc('month', f) AS DATE) AS cohort_month,
               CAST((year(order_date) - year(f)) * 12 + month(order_date) - month(f) AS INTEGER)
                   AS month_number,
               COUNT(DISTINCT customer_id) AS active_customers
        FROM oo JOIN (SELECT customer_id, MIN(order_date) AS f FROM oo GROUP BY 1)
             USING (customer_id) GROUP BY 1, 2"""),
    # Dirty marts of the quality checks.
    "q_customers": (("raw",), "SELECT user_pseudo_id AS customer_id FROM raw WHERE country IS NOT NULL"),
    "q_orders": (("raw",), """
        SELECT transaction_id AS order_id, user_pseudo_id AS customer_id, items_value AS order_total,
               CAST(TRY_STRPTIME(event_date, '%Y%m%d') AS DATE) AS order_date
        FROM raw WHERE event_name = 'purchase'"""),
    "q_items": (("rit",), """
        SELECT transaction_id AS order_id, item_id AS product_id, quantity, price AS unit_price
        FROM rit WHERE event_name = 'purchase'"""),
    "q_products": (("sitems",), """
        SELECT item_id AS product_id, price AS base_price FROM sitems WHERE price > 100"""),
    "q_sessions": (("raw",), "SELECT session_id, user_pseudo_id AS customer_id FROM raw"),
}


def with_ctes(body: str, *names: str) -> str:
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in done:
            for need in CTE[name][0]:
                add(need)
            done[name] = CTE[name][1]

    for n in names:
        add(n)
    if not done:
        return body.strip()
    return ("WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in done.items()) + "\n" + body.strip())


# --- quality checks ------------------------------------------------------

def _check(name: str, table: str, count_sql: str, what: str) -> str:
    return (f"SELECT '{name}' AS check_name, '{table}' AS table_name, "
            f"CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n || ' {what} found' AS details "
            f"FROM ({count_sql})")


def _nulls(names: dict[str, str]) -> list[str]:
    rules = (("customers", "customer_id"), ("orders", "customer_id"), ("orders", "order_id"),
             ("orders", "order_total"), ("order_items", "product_id"),
             ("order_items", "quantity"), ("sessions", "session_id"), ("sessions", "customer_id"))
    return [_check(f"Null Check: {c}", tb,
                   f"SELECT COUNT(*) AS n FROM {names[tb]} WHERE {c} IS NULL", "null values")
            for tb, c in rules]


def _duplicates(names: dict[str, str]) -> list[str]:
    rules = (("customers", "customer_id"), ("orders", "order_id"), ("products", "product_id"),
             ("sessions", "session_id"))
    return [_check(f"Duplicate PK Check: {c}", tb,
                   f"SELECT COUNT(*) AS n FROM (SELECT {c} FROM {names[tb]} GROUP BY {c} "
                   f"HAVING COUNT(*) > 1)", "duplicate keys") for tb, c in rules]


def _orphans(names: dict[str, str]) -> list[str]:
    rules = (("orders", "customer_id", "customers", "customer_id"),
             ("order_items", "order_id", "orders", "order_id"),
             ("order_items", "product_id", "products", "product_id"),
             ("sessions", "customer_id", "customers", "customer_id"))
    return [_check(f"Orphan FK Check: {fk} -> {p}.{pk}", ch,
                   f"SELECT COUNT(*) AS n FROM {names[ch]} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM {names[p]} p WHERE p.{pk} = c.{fk})", "orphaned rows")
            for ch, fk, p, pk in rules]


def _invalid(names: dict[str, str], lo: str, hi: str) -> list[str]:
    rules = (("orders", "order_total", "order_total < 0"),
             ("order_items", "quantity", "quantity <= 0"),
             ("order_items", "unit_price", "unit_price < 0"),
             ("products", "base_price", "base_price < 0"), ("ad_spend", "amount", "amount < 0"),
             ("orders", "order_date", f"order_date < DATE '{lo}' OR order_date > DATE '{hi}'"),
             ("campaigns", "dates", "end_date < start_date"))
    return [_check(f"Invalid Value Check: {w}", tb,
                   f"SELECT COUNT(*) AS n FROM {names[tb]} WHERE {p}", "invalid values")
            for tb, w, p in rules]


CLEAN_MARTS = {"customers": "oc", "orders": "oo", "order_items": "oi", "products": "op",
               "sessions": "os", "ad_spend": "spend", "campaigns": "rcamp"}
DIRTY_MARTS = {"customers": "q_customers", "orders": "q_orders", "order_items": "q_items",
               "products": "q_products", "sessions": "q_sessions", "ad_spend": "rspend",
               "campaigns": "rcamp"}


# --- text ----------------------------------------------------------------

NUMBERS = ("list_transform(regexp_extract_all(replace({}, ',', ''), '" + g.NUMBER_PATTERN
           + "'), lambda x: abs(CAST(x AS DOUBLE)))")
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _first_bad(r: str, p: str) -> str:
    near = "abs(n - p) <= 0.1 OR (p <> 0 AND abs(n - p) / p <= 0.015)"
    return f"list_filter({r}, lambda n: len(list_filter({p}, lambda p: {near})) = 0)[1]"


def _plain(c: str) -> str:
    return f"regexp_replace(CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR), '(\\.\\d)0$', '\\1')"


def _sentence(name: str, spend: str, revenue: str, roas: str, cac: str, direction: str,
              change: str) -> str:
    values = [name, _plain(spend), _plain(revenue), _plain(roas), _plain(cac), direction, change]
    parts = re.split("%s", budget.SENTENCE)
    out = [_q(parts[0].replace("%%", "%"))]
    for value, part in zip(values, parts[1:]):
        out += [value, _q(part.replace("%%", "%"))]
    return " || ".join(out)


DIRECTION = "CASE WHEN roas > 1.5 THEN 'Increase' WHEN roas < 0.8 THEN 'Decrease' ELSE 'Maintain' END"
CHANGE = "CASE WHEN roas > 1.5 THEN 15 WHEN roas < 0.8 THEN -20 ELSE 0 END"
PERFORMANCE = f"""
    SELECT channel_id, channel_name, CAST(total_spend AS DOUBLE) AS total_spend,
           CAST(total_revenue AS DOUBLE) AS total_revenue, cac, roas,
           CAST(attributed_revenue AS DOUBLE) AS attributed_revenue_linear,
           ROUND(CAST(attributed_revenue AS DOUBLE) / CAST(total_spend AS DOUBLE), 8)
               AS marginal_roas_signal,
           {_q(budget.DATA_LIMITATION)} AS data_limitation
    FROM cac LEFT JOIN (SELECT channel_id, attributed_revenue FROM multi
                        WHERE attribution_model = 'linear') USING (channel_id)
    WHERE cac IS NOT NULL"""

RAW_COLUMNS = ("event_date, event_timestamp, event_name, user_pseudo_id, ga_session_id, "
               "page_location, traffic_source, traffic_medium, campaign_name, device_category, "
               "country, transaction_id, CAST(items_value AS DOUBLE) AS items_value, session_id")
ITEM_COLUMNS = ("user_pseudo_id, ga_session_id, session_id, event_name, transaction_id, item_id, "
                "item_name, item_category, CAST(price AS DOUBLE) AS price, quantity")
MODEL_COLUMNS = ("channel_id, attribution_model, CAST(attributed_revenue AS DOUBLE) "
                 "AS attributed_revenue, attributed_orders")
LTV_COLUMNS = ("customer_id, acquisition_source, acquisition_medium, CAST(acquisition_date AS VARCHAR) "
               "AS acquisition_date, total_orders, CAST(historical_ltv AS DOUBLE) AS historical_ltv, "
               "CAST(first_order_date AS VARCHAR) AS first_order_date, CAST(last_order_date AS VARCHAR) "
               "AS last_order_date, average_order_value")
SESSION_COLUMNS = ("session_id, customer_id, CAST(session_date AS VARCHAR) AS session_date, "
                   "traffic_source, traffic_medium, campaign_name, device_category")
CAC_COLUMNS = ("channel_id, channel_name, channel_type, CAST(total_spend AS DOUBLE) AS total_spend, "
               "total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue, new_paying_customers, "
               "cac, roas")
PRICE_COLUMNS = ("product_id, product_name, category, CAST(base_price AS DOUBLE) AS base_price, "
                 "avg_selling_price, discount_pct, times_purchased, "
                 "CAST(product_revenue AS DOUBLE) AS product_revenue")
CAMPAIGN_COLUMNS = ("campaign_id, channel_id, campaign_name, CAST(start_date AS VARCHAR) AS start_date, "
                    "CAST(end_date AS VARCHAR) AS end_date, CAST(budget AS DOUBLE) AS budget")


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    def add(key: str, body: str, *ctes: str) -> None:
        q[key] = with_ctes(body, *ctes)

    # sources and sinks
    kept = "event_id % 13 <> 0"
    units = "COALESCE((SELECT SUM(1 + (event_id + i) % 3) FROM unnest(range(1, k % 3 + 1)) u(i)), 0)"
    add("scan_events_nested", f"""SELECT event_id, {DAY} AS event_date,
        {MICROS.format('ts')} AS event_timestamp, event_name, user_pseudo_id,
        CASE WHEN {DAY} >= '20240115' THEN {_list(t.COUNTRIES)}[k % 4 + 1] END AS country, k % 3 AS n_items,
        CAST({units} AS BIGINT) AS units
        FROM ev WHERE {DAY} BETWEEN '20240108' AND '20240121' AND {kept}""", "ev")
    add("scan_items_nested", f"""SELECT event_id, {DAY} AS event_date, event_name, k % 3 AS n_items,
        CAST({units} AS BIGINT) AS units
        FROM ev WHERE {DAY} BETWEEN '20240105' AND '20240118' AND {kept} AND event_name <> 'page_view'""", "ev")
    add("read_csv_records", f"""SELECT doc_id, CASE WHEN lang NOT IN ({', '.join(map(_q, NULL_TEXTS))}) THEN lang END AS lang,
        length(x) AS length, md5(x) AS digest
        FROM (SELECT *, CASE WHEN text NOT IN ({', '.join(map(_q, NULL_TEXTS))}) THEN text END AS x FROM documents)""")
    add("read_csv_typed", f"SELECT {RAW_COLUMNS} FROM raw", "raw")
    add("read_columns", "SELECT o_orderkey, o_custkey FROM orders")
    add("read_view", """SELECT product_id, discount_pct, CAST(product_revenue AS DOUBLE)
        AS product_revenue FROM price WHERE discount_pct >= 5
        ORDER BY price.product_revenue DESC, product_id LIMIT 50""", "price")
    add("write_csv", """SELECT product_id, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS units,
        CAST(SUM(unit_price) AS DOUBLE) AS price_sum FROM oi GROUP BY product_id""", "oi")
    add("full_refresh", """SELECT order_id, customer_id, session_id, CAST(order_date AS VARCHAR)
        AS order_date, order_status, CAST(order_total AS DOUBLE) AS order_total FROM oo""", "oo")
    once = " UNION ALL ".join(_nulls(CLEAN_MARTS))
    add("append_log", f"{once} UNION ALL {once}", "oc", "oo", "oi", "os")
    add("conform_schema", f"""SELECT CAST(event_date AS VARCHAR) AS event_date,
        CAST(NULL AS VARCHAR) AS event_datetime, {ITEM_COLUMNS} FROM sitems""", "sitems")
    add("row_counts", " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {c}" for n, c in (
            ("stg_marketing_channels", "schan"), ("stg_campaigns", "camp"),
            ("stg_ad_spend", "spend"), ("stg_ga4_events", "stg"), ("stg_ga4_items", "sitems"))),
        "schan", "camp", "spend", "stg", "sitems")

    # nested extraction
    add("event_param", """SELECT event_id, ga_session_id, 'https://shop.example/p/' || k
        AS page_location FROM nested""", "nested")
    add("items_value", "SELECT event_id, CAST(items_value AS DOUBLE) AS items_value FROM nested",
        "nested")
    add("explode_items", f"""SELECT {DAY} AS event_date, {MICROS.format('ts')} AS event_timestamp,
        user_pseudo_id, g AS ga_session_id, event_name,
        CASE WHEN event_name = 'purchase' THEN 'T' || event_id END AS transaction_id, item_id,
        item_name, item_category, CAST(price AS DOUBLE) AS price, quantity,
        user_pseudo_id || '_' || COALESCE(CAST(g AS VARCHAR), '<NA>') AS session_id
        FROM (SELECT *, CASE WHEN event_id % 11 <> 0 THEN CAST({DAY} AS BIGINT) END AS g FROM it)
        WHERE event_name <> 'page_view'""", "it")
    add("flatten_struct", f"""SELECT {DAY} AS event_date, {MICROS.format('n.ts')} AS event_timestamp,
        n.event_name, n.user_pseudo_id, n.ga_session_id, s.page_location, s.traffic_source,
        s.traffic_medium, s.campaign_name, s.device_category, s.country, s.transaction_id,
        CAST(n.items_value AS DOUBLE) AS items_value,
        n.user_pseudo_id || '_' || COALESCE(CAST(n.ga_session_id AS VARCHAR), '<NA>') AS session_id
        FROM nested n JOIN stg s USING (event_id)""".replace("event_date, '%Y", "n.event_date, '%Y"),
        "nested", "stg")
    add("session_key", """SELECT event_id, user_pseudo_id || '_' ||
        COALESCE(CAST(ga_session_id AS VARCHAR), '<NA>') AS session_id FROM nested""", "nested")

    # cleaning
    add("parse_date_coerce", """SELECT line_no, CAST(CAST(TRY_STRPTIME(event_date, '%Y%m%d') AS DATE)
        AS VARCHAR) AS event_date FROM raw""", "raw")
    add("epoch_micros", f"""SELECT line_no, {STAMP.format('make_timestamp(event_timestamp)')}
        AS event_datetime FROM raw""", "raw")
    add("dedup_first", f"SELECT line_no, {RAW_COLUMNS} FROM raw_u", "raw_u")
    add("drop_null_keys", """SELECT line_no, user_pseudo_id, event_name FROM raw
        WHERE user_pseudo_id IS NOT NULL AND event_name IS NOT NULL""", "raw")
    add("fill_unknown", "SELECT line_no, " + ", ".join(
        f"COALESCE({c}, 'unknown') AS {c}" for c in (
            "traffic_source", "traffic_medium", "campaign_name", "device_category", "country"))
        + ", COALESCE(session_id, 'unknown_session') AS session_id FROM raw", "raw")
    add("negative_to_null", """SELECT line_no, CASE WHEN items_value >= 0 THEN
        CAST(items_value AS DOUBLE) END AS items_value FROM raw""", "raw")
    add("invalid_to_default", """SELECT line_no, CAST(CASE WHEN price IS NULL OR price < 0 THEN 0
        ELSE price END AS DOUBLE) AS price, CASE WHEN quantity IS NULL OR quantity < 0 THEN 1
        ELSE quantity END AS quantity FROM rit""", "rit")
    add("flag_incomplete_purchase", """SELECT line_no, event_name, transaction_id,
        event_name = 'purchase' AND transaction_id IS NULL AS is_flagged_incomplete_purchase
        FROM raw""", "raw")
    add("swap_inverted_dates", """SELECT campaign_id, channel_id, campaign_name,
        CAST(LEAST(start_date, end_date) AS VARCHAR) AS start_date,
        CAST(GREATEST(start_date, end_date) AS VARCHAR) AS end_date,
        CAST(budget AS DOUBLE) AS budget FROM rcamp""", "rcamp")
    kept = "FROM raw_u WHERE user_pseudo_id IS NOT NULL AND event_name IS NOT NULL"
    filled = " + ".join(f"COUNT(*) FILTER ({c} IS NULL)" for c in (
        "traffic_source", "traffic_medium", "campaign_name", "device_category", "country",
        "session_id"))
    add("cleaning_log", f"""
        SELECT 'ga4_events.csv' AS file, (SELECT COUNT(*) FROM raw) AS rows_in,
               (SELECT COUNT(*) FROM cln) AS rows_out,
               (SELECT COUNT(*) FROM raw) - (SELECT COUNT(*) FROM raw_u) AS duplicates_removed,
               (SELECT {filled} {kept}) AS nulls_fixed,
               (SELECT COUNT(*) FILTER (items_value < 0) {kept}) AS invalid_values_fixed
        UNION ALL
        SELECT 'marketing_channels.csv', (SELECT COUNT(*) FROM schan), (SELECT COUNT(*) FROM schan_u),
               (SELECT COUNT(*) FROM schan) - (SELECT COUNT(*) FROM schan_u),
               (SELECT COUNT(*) FILTER (channel_type IS NULL) FROM schan_u), 0
        UNION ALL
        SELECT 'campaigns.csv', (SELECT COUNT(*) FROM rcamp), (SELECT COUNT(*) FROM camp), 0, 0,
               (SELECT COUNT(*) FILTER (end_date < start_date) FROM rcamp)
        UNION ALL
        SELECT 'ad_spend.csv', (SELECT COUNT(*) FROM rspend),
               (SELECT COUNT(DISTINCT (channel_id, campaign_id, spend_date)) FROM rspend),
               (SELECT COUNT(*) - COUNT(DISTINCT (channel_id, campaign_id, spend_date)) FROM rspend),
               0, (SELECT COUNT(*) FILTER (amount IS NULL OR amount < 0) FROM rspend)
        UNION ALL
        SELECT 'ga4_items.csv', (SELECT COUNT(*) FROM rit), (SELECT COUNT(*) FROM cit),
               (SELECT COUNT(*) FROM rit WHERE item_id IS NOT NULL) - (SELECT COUNT(*) FROM cit),
               (SELECT COUNT(*) FILTER (item_name IS NULL) + COUNT(*) FILTER (item_category IS NULL)
                FROM rit WHERE item_id IS NOT NULL),
               (SELECT COUNT(*) FILTER (price IS NULL OR price < 0)
                     + COUNT(*) FILTER (quantity IS NULL OR quantity < 0)
                FROM rit WHERE item_id IS NOT NULL)""",
        "raw", "cln", "schan", "schan_u", "rcamp", "camp", "rspend", "rit", "cit")
    add("clean_ga4_events", f"""SELECT CAST(event_date AS VARCHAR) AS event_date,
        {STAMP.format('event_datetime')} AS event_datetime, event_name, user_pseudo_id, ga_session_id,
        session_id, page_location, traffic_source, traffic_medium, campaign_name, device_category,
        country, transaction_id, CAST(items_value AS DOUBLE) AS items_value,
        is_flagged_incomplete_purchase FROM cln""", "cln")
    add("clean_ga4_items", f"""SELECT CAST(CAST(TRY_STRPTIME(event_date, '%Y%m%d') AS DATE) AS VARCHAR)
        AS event_date, {STAMP.format('make_timestamp(event_timestamp)')} AS event_datetime,
        {ITEM_COLUMNS} FROM cit""", "cit")
    add("clean_ad_spend", """SELECT line_no, channel_id, campaign_id, CAST(spend_date AS VARCHAR)
        AS spend_date, CAST(CASE WHEN amount IS NULL OR amount < 0 THEN 0 ELSE amount END AS DOUBLE)
        AS amount
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY channel_id, campaign_id, spend_date
                                           ORDER BY line_no) AS rn FROM rspend)
        WHERE rn = 1""", "rspend")

    # channels and spend
    add("channel_dimension", f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY first) AS INTEGER) AS channel_id,
        channel_name, {TYPE_CASE} AS channel_type
        FROM (SELECT lower(COALESCE(traffic_source, 'unknown') || ' / ' ||
                           COALESCE(traffic_medium, 'unknown')) AS channel_name,
                     lower(COALESCE(traffic_medium, 'unknown')) AS medium, MIN(line_no) AS first
              FROM raw GROUP BY 1, 2)""", "raw")
    add("channel_type", f"""SELECT event_id, {TYPE_CASE} AS channel_type
        FROM (SELECT event_id, lower(traffic_medium) AS medium FROM stg)""", "stg")
    add("paying_customers_by_channel", """SELECT COALESCE(traffic_source, 'unknown') AS source,
        COALESCE(traffic_medium, 'unknown') AS medium,
        COUNT(DISTINCT user_pseudo_id) AS paying_customers
        FROM raw WHERE event_name = 'purchase' GROUP BY 1, 2""", "raw")
    add("calibrated_spend", f"""SELECT CAST(channel_id AS INTEGER) AS channel_id,
        CAST({t.TARGET_CAC} * n AS DOUBLE) AS total_spend
        FROM (SELECT channel_name, {TYPE_CASE} AS channel_type, n, ROW_NUMBER() OVER (ORDER BY first) AS channel_id
              FROM (SELECT lower(traffic_source || ' / ' || traffic_medium) AS channel_name, MIN(event_id) AS first,
                           MIN(lower(traffic_medium)) AS medium, COUNT(DISTINCT
                           CASE WHEN event_name = 'purchase' THEN user_pseudo_id END) AS n
                    FROM stg GROUP BY 1))
        WHERE channel_type = 'paid'""", "stg")
    add("proportional_allocation", """SELECT o_orderkey, o_custkey, ROUND(s, 10) AS share,
        CAST(ROUND(CAST(s * c_acctbal AS DECIMAL(28,10)), 2) AS DOUBLE) AS amount
        FROM (SELECT o_orderkey, o_custkey, c_acctbal, o_totalprice / CAST(SUM(CAST(o_totalprice
                     AS DECIMAL(28,10))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS s
              FROM orders JOIN customer ON o_custkey = c_custkey)""")
    add("dow_seasonality", """SELECT CAST(d AS VARCHAR) AS spend_date,
        [1.2, 1.2, 1.1, 1.1, 1.0, 0.7, 0.7][isodow(d)]::DOUBLE
            * CASE WHEN d = DATE '2024-01-15' THEN 2 ELSE 1 END AS weight, n
        FROM (SELECT CAST(unnest(generate_series((SELECT MIN(event_date) FROM ev),
                     (SELECT MAX(event_date) FROM ev), INTERVAL 1 DAY)) AS DATE) AS d)
        LEFT JOIN (SELECT event_date, COUNT(*) AS n FROM ev GROUP BY 1) ON d = event_date""", "ev")
    add("planned_ad_spend", f"""
        SELECT channel_id, COALESCE(
                   (SELECT MIN(campaign_id) FROM camp WHERE d BETWEEN start_date AND end_date),
                   (SELECT MIN(campaign_id) FROM camp)) AS campaign_id,
               CAST(d AS VARCHAR) AS spend_date,
               CAST(ROUND(CAST(w / SUM(w) OVER () * {t.TARGET_CAC} * n AS DECIMAL(28,10)), 2)
                    AS DOUBLE) AS amount
        FROM (SELECT d, [1.2, 1.2, 1.1, 1.1, 1.0, 0.7, 0.7][isodow(d)]::DOUBLE AS w
              FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31',
                                                       INTERVAL 1 DAY)) AS DATE) AS d))
        JOIN (SELECT channel_name, n, CAST(ROW_NUMBER() OVER (ORDER BY first) AS INTEGER) AS channel_id
              FROM (SELECT lower(traffic_source || ' / ' || traffic_medium) AS channel_name, MIN(event_id) AS first,
                           COUNT(DISTINCT CASE WHEN event_name = 'purchase'
                                               THEN user_pseudo_id END) AS n FROM stg GROUP BY 1))
          ON channel_name = 'google / cpc'""", "camp", "stg")
    spend = ("channel_id, campaign_id, CAST(spend_date AS VARCHAR) AS spend_date, "
             "CAST(amount AS DOUBLE) AS amount")
    add("assign_active_campaign", f"SELECT {spend} FROM spend", "spend")

    # marts
    add("mart_channels", """SELECT DISTINCT channel_id, channel_name,
        COALESCE(channel_type, 'unknown') AS channel_type FROM schan_u""", "schan_u")
    add("mart_campaigns", f"SELECT {CAMPAIGN_COLUMNS} FROM camp", "camp")
    add("mart_ad_spend", f"SELECT spend_id, {spend} FROM spend", "spend")
    add("mart_products", """SELECT item_id AS product_id, item_name AS product_name,
        item_category AS category, CAST(price AS DOUBLE) AS base_price
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY event_datetime DESC,
              price DESC, item_name DESC, item_category DESC) AS rn FROM sitems) WHERE rn = 1""",
        "sitems")
    add("mart_customers", """SELECT user_pseudo_id AS customer_id, CAST(MIN(event_date) AS VARCHAR)
        AS first_seen_date, MAX(country) AS country FROM stg GROUP BY 1""", "stg")
    add("mart_sessions", f"SELECT {SESSION_COLUMNS} FROM sess", "sess")
    add("mart_events", f"""SELECT session_id, event_name, {STAMP.format('event_datetime')}
        AS event_datetime, CAST(NULL AS VARCHAR) AS product_id FROM stg""", "stg")
    first_buy = """(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
        ORDER BY event_datetime, line_no) AS rn FROM cln
        WHERE event_name = 'purchase' AND transaction_id IS NOT NULL) WHERE rn = 1)"""
    add("mart_orders", f"""SELECT transaction_id AS order_id, user_pseudo_id AS customer_id, session_id,
        CAST(event_date AS VARCHAR) AS order_date, 'completed' AS order_status,
        CAST(items_value AS DOUBLE) AS order_total FROM {first_buy}""", "cln")
    add("mart_order_items", """SELECT transaction_id AS order_id, item_id AS product_id, quantity,
        CAST(price AS DOUBLE) AS unit_price FROM sitems WHERE event_name = 'purchase'""", "sitems")
    add("enforce_constraints", f"""SELECT transaction_id AS order_id,
        CASE WHEN event_date IS NULL THEN 'null order_date'
             WHEN items_value IS NULL THEN 'null order_total'
             WHEN session_id NOT IN (
                 SELECT session_id FROM (SELECT session_id, traffic_source, ROW_NUMBER() OVER (
                     PARTITION BY session_id ORDER BY event_datetime, line_no) AS rn FROM cln)
                 WHERE rn = 1 AND traffic_source <> 'unknown') THEN 'orphan session_id'
             ELSE 'valid' END AS reason, CAST(items_value AS DOUBLE) AS order_total
        FROM {first_buy}""", "cln")

    # Refused rows; what refers to a refused row is an orphan.
    add("mart_quarantine", f"""SELECT table_name, reason, COUNT(*) AS rows FROM (
        SELECT 'customers' AS table_name, 'null first_seen_date' AS reason FROM g_cust WHERE day IS NULL
        UNION ALL SELECT 'sessions', reason FROM g_sess WHERE reason IS NOT NULL
        UNION ALL SELECT 'campaigns', 'null channel_id' FROM rcamp WHERE channel_id IS NULL
        UNION ALL SELECT 'orders', reason FROM g_ord WHERE reason IS NOT NULL
        UNION ALL SELECT 'events', 'orphan session_id' FROM cln
            JOIN g_sess USING (session_id) WHERE reason IS NOT NULL
        UNION ALL SELECT 'order_items', 'orphan order_id' FROM cit
            WHERE event_name = 'purchase'
              AND transaction_id NOT IN (SELECT transaction_id FROM g_ord WHERE reason IS NULL)
        UNION ALL SELECT 'ad_spend', CASE WHEN amount IS NULL THEN 'null amount' ELSE 'orphan campaign_id' END
            FROM rspend WHERE amount IS NULL
               OR campaign_id NOT IN (SELECT campaign_id FROM rcamp WHERE channel_id IS NOT NULL))
        GROUP BY 1, 2""", "g_cust", "g_sess", "g_ord", "rcamp", "cit", "rspend")

    # views
    add("funnel_conversion", "SELECT * FROM funnel", "funnel")
    add("channel_cac_roas", f"SELECT {CAC_COLUMNS} FROM cac", "cac")
    add("spend_by_channel", """SELECT channel_id, CAST(SUM(amount) AS DOUBLE) AS total_spend
        FROM spend GROUP BY 1""", "spend")
    add("orders_by_channel", """SELECT channel_id, attributed_orders AS total_orders,
        CAST(attributed_revenue AS DOUBLE) AS total_revenue FROM lc""", "lc")
    add("first_session", f"SELECT {SESSION_COLUMNS} FROM first_s", "first_s")
    add("new_paying_customers", "SELECT * FROM payers", "payers")
    cohort = """SELECT CAST(cohort_month AS VARCHAR) AS cohort_month, month_number, active_customers
        FROM cohort"""
    add("cohort_retention", cohort, "cohort")
    add("customer_ltv", f"SELECT {LTV_COLUMNS} FROM ltv", "ltv")
    add("customer_segments", """SELECT customer_id, acquisition_source, acquisition_medium,
        total_orders, CAST(historical_ltv AS DOUBLE) AS historical_ltv,
        IF(greatest(total_orders / 12, historical_ltv / 3000000) >= 1, 'VIP', COALESCE(label, 'Unknown')) AS segment
        FROM ltv LEFT JOIN (VALUES (0, 'No Purchase'), (1, 'One-Time Buyer'), (2, 'Repeat Customer'),
                            (3, 'Repeat Customer')) AS bands(orders, label)
             ON orders = COALESCE(total_orders, 0)""", "ltv")
    add("pricing_analytics", f"SELECT {PRICE_COLUMNS} FROM price", "price")

    # touchpoints and attribution
    add("touchpoint_candidates", """SELECT customer_id, CAST(order_date AS VARCHAR) AS order_date,
        COUNT(DISTINCT order_id) AS n_orders, COUNT(DISTINCT session_id) AS candidates
        FROM (SELECT o.order_id, o.customer_id, o.order_date, s.session_id
              FROM ord o JOIN sess s ON o.customer_id = s.customer_id
                                    AND s.session_date <= o.order_date)
        GROUP BY 1, 2""", "ord", "sess")
    add("last_k_touchpoints", """SELECT customer_id, order_id, CAST(order_date AS VARCHAR)
        AS order_date, CAST(session_date AS VARCHAR) AS session_date, session_id,
        CAST(pos AS INTEGER) AS touchpoint_order FROM tp""", "tp")
    add("touchpoint_order", f"""SELECT customer_id, order_id, channel_id,
        {STAMP.format('CAST(session_date AS TIMESTAMP)')} AS touchpoint_timestamp,
        CAST(pos AS INTEGER) AS touchpoint_order FROM tp""", "tp")
    add("match_channel", """SELECT session_id, traffic_source, traffic_medium, channel_id
        FROM sess LEFT JOIN chan ON lower(traffic_source || ' / ' || traffic_medium)
                                  = lower(channel_name)""", "sess", "chan")
    add("touchpoint_summary", f"""SELECT n AS total_touchpoints,
        {pct('n', '(100 * o)')} AS avg_touchpoints_per_order, u AS unmatched_channels
        FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT order_id) AS o,
                     COUNT(*) FILTER (channel_id IS NULL) AS u FROM tp)""", "tp")
    add("attribution_last_click", f"SELECT {MODEL_COLUMNS} FROM lc", "lc")
    for model in ("linear", "time_decay"):
        add(f"attribution_{model}", f"""SELECT {MODEL_COLUMNS} FROM multi
            WHERE attribution_model = '{model}'""", "multi")
    add("channel_attribution", f"SELECT {MODEL_COLUMNS} FROM multi", "multi")
    add("attribution_comparison", """SELECT channel_name, attribution_model,
        CAST(attributed_revenue AS DOUBLE) AS attributed_revenue, attributed_orders FROM cmp""",
        "cmp")
    half_up = ("CASE WHEN l = 0 THEN NULL ELSE sign({0} - l) * CAST((20000 * abs({0} - l) + l) "
               "// (2 * l) AS BIGINT) / 100.0 END")
    add("attribution_pivot", f"""SELECT channel_name, l / 100.0 AS last_click, n / 100.0 AS linear,
        d / 100.0 AS time_decay, {half_up.format('n')} AS linear_uplift_pct,
        {half_up.format('d')} AS time_decay_uplift_pct
        FROM (SELECT channel_name, """ + ", ".join(
        f"CAST(SUM(attributed_revenue) FILTER (attribution_model = '{m}') * 100 AS BIGINT) AS {a}"
        for m, a in (("last_click", "l"), ("linear", "n"), ("time_decay", "d")))
        + " FROM cmp GROUP BY 1)", "cmp")

    # data quality
    dirty = ("q_customers", "q_orders", "q_items", "q_products", "q_sessions", "rspend", "rcamp")
    every = ("oc", "oo", "oi", "op", "os", "spend", "rcamp")
    add("dq_nulls", " UNION ALL ".join(_nulls(DIRTY_MARTS)), *dirty)
    add("dq_duplicate_keys", " UNION ALL ".join(_duplicates(DIRTY_MARTS)), *dirty)
    add("dq_orphans", " UNION ALL ".join(_orphans(DIRTY_MARTS)), *dirty)
    add("dq_invalid_values", " UNION ALL ".join(_invalid(DIRTY_MARTS, "2024-01-03", "2024-01-28")),
        *dirty)
    report = " UNION ALL ".join(_nulls(CLEAN_MARTS) + _duplicates(CLEAN_MARTS)
                                + _orphans(CLEAN_MARTS)
                                + _invalid(CLEAN_MARTS, FIRST_DAY, LAST_DAY))
    add("dq_report", report, *every)
    add("dq_summary", f"""SELECT COUNT(*) FILTER (status = 'PASS') AS passed, COUNT(*) AS total
        FROM ({report})""", *every)

    # budget and grounding
    add("channel_performance", PERFORMANCE, "cac", "multi")
    add("budget_recommendation", f"""SELECT channel_name, roas, {DIRECTION} AS recommend_direction,
        {CHANGE} AS suggested_change_pct FROM ({PERFORMANCE})""", "cac", "multi")
    said = _sentence("channel_name", "total_spend", "attributed_revenue_linear", "roas", "cac",
                     f"({DIRECTION})", f"CAST({CHANGE} AS VARCHAR)")
    add("render_explanation", f"""SELECT channel_name, {_q(budget.PROMPT_HEAD)} || response ||
        {_q(budget.PROMPT_TAIL)} AS prompt, response
        FROM (SELECT channel_name, {said} AS response FROM ({PERFORMANCE}))""", "cac", "multi")
    add("extract_numbers", f"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, n[i] AS number
        FROM (SELECT doc_id, n, unnest(range(1, len(n) + 1)) AS i
              FROM (SELECT doc_id, {NUMBERS.format('text')} AS n FROM documents))""")
    add("unverified_numbers", f"""SELECT page_id, {_first_bad('r', 'p')} AS number
        FROM (SELECT page_id, {NUMBERS.format('shown')} AS r, {NUMBERS.format('url')} AS p
              FROM (SELECT *, regexp_replace(regexp_replace(html, '(?s)^.*<body[^>]*>', ''), '<[^>]*>', ' ', 'g') AS shown
                    FROM pages))""")
    near = """len(list_filter(t, lambda i: len(list_filter(m, lambda j: abs(i - j) <= 5)) > 0)) > 0"""
    add("metric_mislabel", f"""SELECT doc_id, {near} AS flagged
        FROM (SELECT doc_id, list_filter(range(1, len(w) + 1), lambda i: contains(w[i], 'THE')) AS t,
                     list_filter(range(1, len(w) + 1), lambda i: contains(w[i], '$')) AS m
              FROM (SELECT doc_id, regexp_split_to_array(upper(text), '{SPACES}') AS w
                    FROM documents))""")
    # One explanation per order; the prompt holds the exact figures.
    advice = (f"({DIRECTION})", f"CAST({CHANGE} AS VARCHAR)")
    exact = _sentence("o_orderpriority", "s", "r", "roas", "c", *advice)
    altered = _sentence("o_orderpriority", "s", "f", "roas", "c", *advice)
    roas_by_dollar = """len(list_filter(range(1, len(w) + 1), lambda i: contains(upper(w[i]), 'ROAS')
        AND len(list_filter(w[greatest(i - 5, 1):i + 5], lambda x: contains(x, '$'))) > 0)) > 0"""
    add("validation_status", f"""
        SELECT o_orderpriority AS channel_name, {DIRECTION} AS recommend_direction,
               {CHANGE} AS suggested_change_pct, response AS llm_explanation,
               CASE WHEN {_first_bad('rn', 'pn')} IS NOT NULL
                        THEN '{g.STATUS_UNVERIFIED}'
                    WHEN {roas_by_dollar} THEN '{g.STATUS_MISLABELLED}'
                    ELSE '{g.STATUS_PASSED}' END AS validation_status
        FROM (SELECT *, {NUMBERS.format('response')} AS rn, {NUMBERS.format('prompt')} AS pn,
                     string_split(response, ' ') AS w
              FROM (SELECT o_orderpriority, roas, {exact} AS prompt,
                           CASE WHEN key4 = 3 THEN 'Spent $' || {_plain('s')} || '.'
                                ELSE {altered} END AS response
                    FROM (SELECT o_orderpriority, o_orderkey % 4 AS key4,
                                 [10.00, 0.50, 0.80, 1.50, 1.51][CAST(o_orderkey % 5 + 1 AS INTEGER)] AS roas,
                                 CAST(ROUND(p * 0.1, 2) AS DECIMAL(18,2)) AS s, p AS r,
                                 o_orderkey % 50 + 10 AS c,
                                 CAST(ROUND(p * CASE o_orderkey % 4 WHEN 1 THEN 1.01 WHEN 2 THEN 1.05
                                            ELSE 1.00 END, 2) AS DECIMAL(18,2)) AS f
                          FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders))))""")

    # statistics and rankings
    named = "traffic_source || ' / ' || traffic_medium AS channel_name"
    add("top_channels_by_views", f"""SELECT {named}, view_item_customers FROM funnel
        ORDER BY view_item_customers DESC, channel_name LIMIT 5""", "funnel")
    add("top_conversion", f"""SELECT {named}, overall_conversion_rate_pct FROM funnel
        ORDER BY overall_conversion_rate_pct DESC NULLS LAST, channel_name LIMIT 8""", "funnel")
    add("ltv_describe", """SELECT COUNT(x) AS count, ROUND(AVG(x), 4) AS mean,
        ROUND(STDDEV_SAMP(x), 4) AS std, ROUND(MIN(x), 4) AS min,
        ROUND(QUANTILE_CONT(x, 0.25), 4) AS p25, ROUND(QUANTILE_CONT(x, 0.5), 4) AS p50,
        ROUND(QUANTILE_CONT(x, 0.75), 4) AS p75, ROUND(MAX(x), 4) AS max FROM pay""", "pay")
    add("ltv_skew", """SELECT ROUND(SKEWNESS(x), 8) AS skewness,
        SKEWNESS(x) > 1.5 AS log_scale FROM pay""", "pay")
    add("ltv_histogram", """SELECT b AS bin, ROUND(lo + (hi - lo) / 50 * (b - 1), 4) AS lo,
        ROUND(lo + (hi - lo) / 50 * b, 4) AS hi, COALESCE(n, 0) AS n
        FROM (SELECT unnest(range(1, 51)) AS b, (SELECT MIN(x) FROM pay) AS lo,
                     (SELECT MAX(x) FROM pay) AS hi)
        LEFT JOIN (SELECT LEAST(CAST(floor(50.0 * (x - (SELECT MIN(x) FROM pay)) /
                   ((SELECT MAX(x) FROM pay) - (SELECT MIN(x) FROM pay))) AS BIGINT) + 1, 50) AS b,
                   COUNT(*) AS n FROM pay GROUP BY 1) USING (b)""", "pay")
    add("discount_vs_volume", "SELECT discount_pct, times_purchased FROM price", "price")
    add("top_ltv", """SELECT customer_id, acquisition_source AS traffic_source, total_orders,
        CAST(historical_ltv AS DOUBLE) AS historical_ltv, average_order_value FROM ltv
        ORDER BY ltv.historical_ltv DESC, customer_id LIMIT 5""", "ltv")
    add("top_products", """SELECT product_name, CAST(base_price AS DOUBLE) AS base_price,
        avg_selling_price, discount_pct, times_purchased, CAST(product_revenue AS DOUBLE)
        AS product_revenue FROM price ORDER BY price.product_revenue DESC, product_id LIMIT 5""",
        "price")
    add("paid_channels", """SELECT channel_id, CAST(total_spend AS DOUBLE) AS total_spend,
        CAST(total_revenue AS DOUBLE) AS total_revenue, new_paying_customers, cac, roas FROM cac
        WHERE cac IS NOT NULL""", "cac")
    add("cohort_head", cohort + " ORDER BY cohort_month, month_number LIMIT 10", "cohort")
    return q
