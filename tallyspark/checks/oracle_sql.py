"""DuckDB oracle SQL, one statement per registered query.

Written from the model rules applied to the *original* testdata tables
(``orders``, ``lineitem``, ``part``, ``customer``, ``events`` views): typed
values are computed directly from the fixture rules (FIXTURES.md §2), not by
re-parsing JSON, so a mistake in the Spark JSON/dedup/join path shows up as a
mismatch. Money sums use DECIMAL like the Spark side (D9); integer sums are
cast back to BIGINT.
"""

from __future__ import annotations

from tallyspark.checks import declared_tests as declared
from tallyspark.params import CHECK_BATCH_NO

FLOOR = "20240105"

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def with_(final: str, *needs: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` the needed CTEs (dependencies first), then ``extra`` local
    CTEs, then ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    parts += [f"{n} AS (\n{body}\n)" for n, body in (extra or [])]
    if not parts:
        return final
    return "WITH " + ",\n".join(parts) + "\n" + final


def cents(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE)"


# ---------------------------------------------------------------------------
# Shop orders (versions -> latest) and line items
# ---------------------------------------------------------------------------
_ORDER_COLS = "o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS od"
cte("order_versions", [], f"""
  SELECT {_ORDER_COLS}, 1 AS v, TIMESTAMP '2002-01-01' AS ingested_at FROM orders
  UNION ALL SELECT {_ORDER_COLS}, 2, TIMESTAMP '2002-01-02' FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL SELECT {_ORDER_COLS}, 3, TIMESTAMP '2002-01-04' FROM orders WHERE o_orderkey % 13 = 0
  UNION ALL SELECT {_ORDER_COLS}, 4, TIMESTAMP '2002-01-03' FROM orders WHERE o_orderkey % 17 = 0""")

cte("order_typed", ["order_versions"], f"""
  SELECT v, payload_updated, 'shop-a' AS shop_domain, k AS order_id,
    '#' || CAST(1000 + k AS VARCHAR) AS order_name, CAST(1000 + k AS BIGINT) AS order_number,
    CASE WHEN k % 19 = 0 OR k % 23 = 0 THEN NULL ELSE o_custkey END AS customer_id,
    od AS created_at, od AS processed_at,
    coalesce(payload_updated, raw_updated, od) AS updated_at,
    CASE WHEN k % 29 = 0 THEN od + INTERVAL 3 DAY END AS cancelled_at,
    CASE WHEN v = 2 THEN 'refunded' WHEN v = 3 THEN 'stale' WHEN o_orderstatus = 'F' THEN 'paid'
         WHEN o_orderstatus = 'O' THEN 'pending' WHEN o_orderstatus = 'P' THEN 'partially_refunded'
    END AS financial_status,
    CASE WHEN k % 2 = 0 THEN 'fulfilled' END AS fulfillment_status,
    CASE WHEN k % 11 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN k % 37 = 0 THEN NULL ELSE {cents('o_totalprice * 0.9')} END AS subtotal_price,
    {cents('o_totalprice * 0.08')} AS total_tax,
    CASE WHEN k % 3 = 0 THEN 5.0 ELSE 0.0 END::DOUBLE AS total_discounts,
    o_totalprice + CASE WHEN k % 41 = 0 THEN 0.004 ELSE 0.0 END::DOUBLE AS total_price,
    ingested_at
  FROM (SELECT *,
          CASE WHEN v = 3 OR k % 31 = 0 THEN NULL
               WHEN v = 2 THEN od + INTERVAL 3 DAY ELSE od + INTERVAL 1 DAY END AS payload_updated,
          CASE WHEN v = 2 THEN od + INTERVAL 3 DAY ELSE od + INTERVAL 1 DAY END AS raw_updated
        FROM order_versions)""")

cte("stg_orders", ["order_typed"], """
  SELECT * EXCLUDE (v, payload_updated, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payload_updated DESC NULLS LAST,
                                 ingested_at DESC) AS rn
    FROM order_typed) WHERE rn = 1""")

# The first landed snapshot only (every order's V1).
cte("stg_orders_v1", ["order_typed"], """
  SELECT * EXCLUDE (v, payload_updated) FROM order_typed WHERE v = 1""")

cte("line_base", [], f"""
  SELECT l_orderkey, id AS order_item_id,
    CASE WHEN id % 41 = 0 THEN NULL ELSE l_partkey END AS product_id,
    l_partkey * 10 + 1 AS variant_id,
    CASE WHEN l_partkey % 10 = 0 THEN '[SALE] ' || p.p_name ELSE p.p_name END AS line_title,
    CASE WHEN id % 53 = 0 THEN NULL ELSE 'SKU-' || CAST(l_partkey AS VARCHAR) END AS sku,
    qty AS quantity,
    {cents('l_extendedprice / l_quantity')} AS unit_price,
    {cents('l_extendedprice * l_discount')} AS line_discount,
    qty * {cents('l_extendedprice / l_quantity')} AS line_gross_sales
  FROM (
    SELECT *, CASE WHEN id % 97 = 0 THEN 0 WHEN id % 89 = 0 THEN NULL
                   ELSE CAST(l_quantity AS BIGINT) END AS qty
    FROM (SELECT *, l_orderkey * 1000 + row_number() OVER (
            PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS id
          FROM lineitem)
  ) l
  LEFT JOIN part p ON p.p_partkey = l.l_partkey""")


def _lines_of(orders_cte: str) -> str:
    return f"""
  SELECT o.shop_domain, o.order_id, o.created_at AS order_created_at,
    o.updated_at AS order_updated_at, o.currency, l.order_item_id, l.product_id, l.variant_id,
    l.line_title, l.sku, l.quantity, l.unit_price, l.line_discount, l.line_gross_sales,
    o.customer_id, o.financial_status, o.fulfillment_status
  FROM line_base l JOIN {orders_cte} o ON o.order_id = l.l_orderkey"""


cte("stg_lines", ["line_base", "stg_orders"], _lines_of("stg_orders"))
cte("stg_lines_v1", ["line_base", "stg_orders_v1"], _lines_of("stg_orders_v1"))

cte("fct_orders", ["stg_orders"], f"""
  SELECT shop_domain, order_id, customer_id, created_at AS order_created_at,
    CAST(created_at AS DATE) AS order_created_date, CAST(updated_at AS DATE) AS order_updated_date,
    updated_at AS order_updated_at, order_number, order_name, currency, financial_status,
    subtotal_price, total_discounts, total_tax, total_price,
    '{CHECK_BATCH_NO}' AS transform_batch_no
  FROM stg_orders WHERE order_id IS NOT NULL""")

cte("stg_customers", [], """
  SELECT 'shop-a' AS shop_domain, c_custkey AS customer_id,
    CAST(DATE '2001-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at,
    TIMESTAMP '2002-01-01' AS ingested_at
  FROM customer""")

cte("product_versions", [], """
  SELECT p_partkey AS p, p_name, p_brand, p_type, p_retailprice, 1 AS v,
         TIMESTAMP '2002-01-01' AS ingested_at FROM part
  UNION ALL
  SELECT p_partkey, p_name, p_brand, p_type, p_retailprice, 2, TIMESTAMP '2002-01-02'
  FROM part WHERE p_partkey % 7 = 0""")

cte("stg_products", ["product_versions"], """
  SELECT 'shop-a' AS shop_domain, p AS product_id, created_at,
    CASE WHEN v = 2 THEN created_at + INTERVAL 30 DAY ELSE created_at + INTERVAL 1 DAY END AS updated_at,
    CASE WHEN v = 2 THEN p_name || ' (v2)' ELSE p_name END AS product_title,
    p_brand AS vendor, p_type AS product_type,
    CASE WHEN p % 50 = 0 THEN 'unknown' WHEN p % 3 = 0 THEN 'active' WHEN p % 3 = 1 THEN 'archived'
         ELSE 'draft' END AS status,
    ingested_at, p_retailprice
  FROM (SELECT *, CAST(DATE '2001-01-01' + CAST(p % 365 AS INTEGER) AS TIMESTAMP) AS created_at,
               row_number() OVER (PARTITION BY p ORDER BY v DESC) AS rn
        FROM product_versions) WHERE rn = 1""")

cte("stg_product_variants", ["stg_products"], """
  SELECT shop_domain, product_id, product_id * 10 + pos AS variant_id,
    'Variant ' || CAST(pos AS VARCHAR) AS variant_title,
    'SKU-' || CAST(product_id AS VARCHAR) || '-' || CAST(pos AS VARCHAR) AS sku,
    p_retailprice + pos AS price, CAST(pos AS BIGINT) AS position, ingested_at
  FROM (SELECT *, unnest(range(1, CAST(product_id % 3 AS BIGINT) + 1)) AS pos FROM stg_products)""")

# ---------------------------------------------------------------------------
# Analytics events
# ---------------------------------------------------------------------------
# The order a purchase names: one hot order for every twentieth event id, else
# one order for each four ids (so the matched orders grow with the events).
TXN_KEY = "(CASE WHEN {e} % 20 = 19 THEN 7 ELSE {e} // 4 END)"

cte("ev", [], f"""
  SELECT e.event_id AS e, e.user_id AS u, e.ts, e.event_type, e.value,
    CASE e.event_type WHEN 'view' THEN CASE WHEN e.event_id % 2 = 0 THEN 'page_view' ELSE 'view_item' END
         WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'begin_checkout'
         WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'user_engagement' END AS event_name,
    strftime(e.ts, '%Y%m%d') AS suffix,
    o.o_totalprice
  FROM events e
  LEFT JOIN orders o ON e.event_type = 'purchase' AND e.event_id % 10 >= 5
                     AND o.o_orderkey = {TXN_KEY.format(e='e.event_id')}
  WHERE strftime(e.ts, '%Y%m%d') >= '{FLOOR}'""")

cte("stg_events", ["ev"], f"""
  SELECT
    'u' || CAST(u AS VARCHAR) || '-' || CAST(epoch_us(ts) AS VARCHAR) || '-' || event_name AS event_key,
    CAST(ts AS DATE) AS event_date, ts AS event_timestamp, event_name,
    'u' || CAST(u AS VARCHAR) AS user_pseudo_id,
    CASE WHEN e % 20 = 7 THEN NULL ELSE CAST(epoch(date_trunc('day', ts)) AS BIGINT) + u END AS ga_session_id,
    '/p/' || CAST(e % 50 AS VARCHAR) AS page_location,
    CAST(u % 5 + 1 AS BIGINT) AS ga_session_number,
    'Page ' || CAST(e % 50 AS VARCHAR) AS page_title,
    CASE (e + u) % 5 WHEN 1 THEN 'google' WHEN 2 THEN 'tagassistant' WHEN 3 THEN 'admin.shopify'
         WHEN 4 THEN 'referral' END AS source,
    CASE WHEN (e + u) % 2 = 0 THEN 'organic' END AS medium,
    CASE WHEN e % 4 = 0 THEN NULL ELSE 'camp' || CAST(u % 3 AS VARCHAR) END AS campaign,
    CASE WHEN e % 9 = 0 THEN NULL WHEN e % 9 = 1 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN event_type <> 'purchase' THEN NULL
         WHEN e % 10 IN (0, 1) THEN NULL
         WHEN e % 10 = 2 THEN 'Not_Set'
         WHEN e % 10 = 3 THEN '(not set)'
         WHEN e % 10 = 4 THEN CAST(e + 900000000 AS VARCHAR)
         ELSE CAST({TXN_KEY.format(e='e')} AS VARCHAR) END AS transaction_id,
    CASE WHEN event_type <> 'purchase' THEN NULL
         WHEN e % 10 = 0 THEN NULL
         WHEN e % 10 = 1 THEN '  '
         WHEN e % 10 = 2 THEN 'Not_Set'
         WHEN e % 10 = 3 THEN '(not set)'
         WHEN e % 10 = 4 THEN CAST(e + 900000000 AS VARCHAR)
         WHEN e % 10 = 5 THEN ' ' || CAST({TXN_KEY.format(e='e')} AS VARCHAR) || ' '
         ELSE CAST({TXN_KEY.format(e='e')} AS VARCHAR) END AS raw_transaction_id,
    CASE WHEN event_type <> 'purchase' OR e % 7 = 6 THEN NULL
         WHEN o_totalprice IS NOT NULL THEN
           o_totalprice + CASE e % 7 WHEN 0 THEN 5.0 WHEN 1 THEN 0.5 WHEN 2 THEN -25.0 ELSE 0.0 END::DOUBLE
         ELSE value END AS purchase_revenue,
    suffix AS source_table_suffix,
    e, u
  FROM ev""")

cte("stg_sessions", ["stg_events"], """
  SELECT user_pseudo_id || '-' || CAST(ga_session_id AS VARCHAR) AS session_key,
    user_pseudo_id, ga_session_id,
    min(event_timestamp) AS session_start_at, max(event_timestamp) AS session_end_at,
    count(*) AS event_count,
    count(*) FILTER (WHERE event_name = 'page_view') AS page_view_count,
    count(*) FILTER (WHERE event_name = 'view_item') AS view_item_count,
    count(*) FILTER (WHERE event_name = 'add_to_cart') AS add_to_cart_count,
    count(*) FILTER (WHERE event_name = 'begin_checkout') AS begin_checkout_count,
    count(*) FILTER (WHERE event_name = 'purchase') AS purchase_count,
    first(source ORDER BY event_timestamp, event_key) FILTER (WHERE source IS NOT NULL) AS source,
    first(medium ORDER BY event_timestamp, event_key) FILTER (WHERE medium IS NOT NULL) AS medium,
    first(campaign ORDER BY event_timestamp, event_key) FILTER (WHERE campaign IS NOT NULL) AS campaign
  FROM stg_events WHERE ga_session_id IS NOT NULL
  GROUP BY 1, 2, 3""")

cte("stg_purchases", ["stg_events"], """
  SELECT event_key, event_date, event_timestamp, user_pseudo_id,
    user_pseudo_id || '-' || CAST(ga_session_id AS VARCHAR) AS session_key,
    ga_session_id, transaction_id, purchase_revenue, currency, source, medium, campaign
  FROM stg_events WHERE event_name = 'purchase'""")

cte("stg_items", ["stg_events"], """
  SELECT event_key, event_date, event_timestamp, event_name, user_pseudo_id,
    user_pseudo_id || '-' || CAST(ga_session_id AS VARCHAR) AS session_key,
    ga_session_id, transaction_id, currency,
    CAST(i + 1 AS BIGINT) AS item_index,
    CASE WHEN i = 3 THEN NULL ELSE 'P' || CAST(e * 7 + i AS VARCHAR) END AS item_id,
    'Item ' || CAST((e * 7 + i) % 100 AS VARCHAR) AS item_name,
    'Brand ' || CAST(i % 3 AS VARCHAR) AS item_brand,
    CAST(NULL AS VARCHAR) AS item_variant,
    'cat' || CAST((e + i) % 4 AS VARCHAR) AS item_category,
    CAST(NULL AS VARCHAR) AS item_category2, CAST(NULL AS VARCHAR) AS item_category3,
    CAST(NULL AS VARCHAR) AS item_category4, CAST(NULL AS VARCHAR) AS item_category5,
    CAST((e * 7 + i) % 100 AS DOUBLE) + 0.5 AS price,
    CAST(i + 1 AS BIGINT) AS quantity,
    (CAST((e * 7 + i) % 100 AS DOUBLE) + 0.5) * (i + 1) AS item_revenue,
    CASE WHEN i = 1 THEN 'SAVE10' END AS coupon,
    'shop-a' AS affiliation
  FROM (SELECT *, unnest(range(0, e % 5)) AS i FROM stg_events WHERE e % 5 > 0)""")

cte("reconciliation", ["stg_purchases", "stg_orders"], """
  SELECT p.event_key AS ga4_event_key, p.event_timestamp AS ga4_event_timestamp,
    p.transaction_id AS ga4_transaction_id, p.purchase_revenue AS ga4_purchase_revenue,
    p.currency AS ga4_currency, p.user_pseudo_id, p.session_key, p.source, p.medium, p.campaign,
    o.order_id AS shopify_order_id, o.order_name AS shopify_order_name,
    o.order_number AS shopify_order_number, o.created_at AS shopify_created_at,
    o.total_price AS shopify_total_price, o.currency AS shopify_currency, o.customer_id,
    o.financial_status, o.fulfillment_status,
    CASE WHEN p.transaction_id IS NULL THEN 'missing_transaction_id'
         WHEN lower(p.transaction_id) = 'not_set' THEN 'not_set_transaction_id'
         WHEN o.order_id IS NOT NULL THEN 'matched'
         ELSE 'unmatched_transaction_id' END AS match_status,
    CASE WHEN o.order_id IS NOT NULL THEN 'order_id' END AS match_type,
    p.purchase_revenue - o.total_price AS revenue_difference,
    p.currency = o.currency AS same_currency
  FROM stg_purchases p
  LEFT JOIN stg_orders o ON p.transaction_id = CAST(o.order_id AS VARCHAR)""")

cte("attribution", ["fct_orders", "reconciliation"], """
  SELECT o.order_id, o.customer_id, o.order_created_at, o.order_created_date, o.currency,
    o.financial_status, o.subtotal_price, o.total_discounts, o.total_tax, o.total_price,
    m.ga4_event_key, m.ga4_event_timestamp, CAST(m.ga4_event_timestamp AS DATE) AS ga4_purchase_date,
    m.ga4_transaction_id, m.user_pseudo_id, m.session_key,
    'purchase_session' AS attribution_model,
    m.shopify_order_id IS NOT NULL AS is_attributed,
    coalesce(m.source, 'unattributed') AS attributed_source,
    coalesce(m.medium, 'unattributed') AS attributed_medium,
    coalesce(m.campaign, 'unattributed') AS attributed_campaign,
    m.revenue_difference, m.same_currency
  FROM fct_orders o
  LEFT JOIN (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY shopify_order_id
                                   ORDER BY ga4_event_timestamp, ga4_event_key) AS rn
      FROM reconciliation WHERE match_status = 'matched') WHERE rn = 1
  ) m ON o.order_id = m.shopify_order_id""")

cte("channel_revenue", ["attribution"], f"""
  SELECT *,
    CASE WHEN orders = 0 THEN NULL ELSE CAST(attributed_orders AS DOUBLE) / orders END
      AS order_attribution_coverage_rate,
    CASE WHEN total_revenue = 0 THEN NULL ELSE attributed_revenue / total_revenue END
      AS revenue_attribution_coverage_rate,
    CASE WHEN orders = 0 THEN NULL ELSE total_revenue / orders END AS average_order_value
  FROM (
    SELECT order_created_date AS revenue_date, currency, attributed_source, attributed_medium,
      attributed_campaign,
      count(DISTINCT order_id) AS orders,
      count(DISTINCT customer_id) AS customers,
      count(DISTINCT CASE WHEN is_attributed THEN order_id END) AS attributed_orders,
      count(DISTINCT CASE WHEN NOT is_attributed THEN order_id END) AS unattributed_orders,
      {money('subtotal_price')} AS subtotal_revenue,
      {money('total_discounts')} AS discounts,
      {money('total_tax')} AS tax,
      {money('total_price')} AS total_revenue,
      {money('CASE WHEN is_attributed THEN total_price ELSE 0 END')} AS attributed_revenue,
      {money('CASE WHEN NOT is_attributed THEN total_price ELSE 0 END')} AS unattributed_revenue
    FROM attribution GROUP BY 1, 2, 3, 4, 5)""")

cte("funnel", ["stg_sessions", "reconciliation"], f"""
  SELECT *,
    CASE WHEN sessions = 0 THEN NULL ELSE CAST(view_item_sessions AS DOUBLE) / sessions END
      AS session_to_view_item_rate,
    CASE WHEN view_item_sessions = 0 THEN NULL ELSE CAST(add_to_cart_sessions AS DOUBLE) / view_item_sessions END
      AS view_item_to_cart_rate,
    CASE WHEN add_to_cart_sessions = 0 THEN NULL ELSE CAST(checkout_sessions AS DOUBLE) / add_to_cart_sessions END
      AS cart_to_checkout_rate,
    CASE WHEN checkout_sessions = 0 THEN NULL ELSE CAST(matched_purchase_sessions AS DOUBLE) / checkout_sessions END
      AS checkout_to_purchase_rate,
    CASE WHEN sessions = 0 THEN NULL ELSE CAST(matched_purchase_sessions AS DOUBLE) / sessions END
      AS session_to_purchase_rate,
    CASE WHEN sessions = 0 THEN NULL ELSE shopify_revenue / sessions END AS revenue_per_session
  FROM (
    SELECT s.event_date, s.source, s.medium, s.campaign,
      count(DISTINCT s.session_key) AS sessions,
      count(DISTINCT CASE WHEN s.page_view_count > 0 THEN s.session_key END) AS page_view_sessions,
      count(DISTINCT CASE WHEN s.view_item_count > 0 THEN s.session_key END) AS view_item_sessions,
      count(DISTINCT CASE WHEN s.add_to_cart_count > 0 THEN s.session_key END) AS add_to_cart_sessions,
      count(DISTINCT CASE WHEN s.begin_checkout_count > 0 THEN s.session_key END) AS checkout_sessions,
      count(DISTINCT CASE WHEN s.purchase_count > 0 THEN s.session_key END) AS ga4_purchase_sessions,
      count(DISTINCT CASE WHEN o.matched_orders > 0 THEN s.session_key END) AS matched_purchase_sessions,
      CAST(sum(coalesce(o.matched_orders, 0)) AS BIGINT) AS matched_orders,
      CAST(sum(coalesce(o.shopify_revenue, 0)) AS DOUBLE) AS shopify_revenue
    FROM (SELECT CAST(session_start_at AS DATE) AS event_date, session_key,
            coalesce(source, '(not set)') AS source, coalesce(medium, '(not set)') AS medium,
            coalesce(campaign, '(not set)') AS campaign, page_view_count, view_item_count,
            add_to_cart_count, begin_checkout_count, purchase_count
          FROM stg_sessions) s
    LEFT JOIN (
      SELECT session_key, count(DISTINCT shopify_order_id) AS matched_orders,
        SUM(CAST(shopify_total_price AS DECIMAL(28,6))) AS shopify_revenue
      FROM reconciliation WHERE match_status = 'matched' GROUP BY 1
    ) o ON s.session_key = o.session_key
    GROUP BY 1, 2, 3, 4)""")


def _all(name: str) -> str:
    return with_(f"SELECT * FROM {name}", name)


ORDER_COLS = ("shop_domain, order_id, order_name, order_number, customer_id, created_at, processed_at, "
              "updated_at, cancelled_at, financial_status, fulfillment_status, currency, subtotal_price, "
              "total_tax, total_discounts, total_price, ingested_at")
LINE_COLS = ("shop_domain, order_id, order_created_at, order_updated_at, currency, order_item_id, product_id, "
             "variant_id, line_title, sku, quantity, unit_price, line_discount, line_gross_sales")
EVENT_COLS = ("event_key, event_date, event_timestamp, event_name, user_pseudo_id, ga_session_id, page_location, "
              "ga_session_number, page_title, source, medium, campaign, currency, transaction_id, "
              "purchase_revenue, source_table_suffix")


def model_sql() -> dict[str, str]:
    return {
        "stg_orders": with_(f"SELECT {ORDER_COLS} FROM stg_orders", "stg_orders"),
        "stg_order_line_items": with_(f"SELECT {LINE_COLS} FROM stg_lines", "stg_lines"),
        "stg_customers": _all("stg_customers"),
        "stg_products": with_("SELECT shop_domain, product_id, created_at, updated_at, product_title, vendor, "
                              "product_type, status, ingested_at FROM stg_products", "stg_products"),
        "stg_product_variants": _all("stg_product_variants"),
        "ga_events_staged": with_(f"SELECT {EVENT_COLS} FROM stg_events", "stg_events"),
        "stg_ga_sessions": _all("stg_sessions"),
        "stg_ga_purchases": _all("stg_purchases"),
        "stg_ga_items": with_("SELECT event_key, event_date, event_timestamp, event_name, user_pseudo_id, session_key, "
              "ga_session_id, transaction_id, currency, item_index, item_id, item_name, item_brand, "
              "item_variant, item_category, item_category2, item_category3, item_category4, "
              "item_category5, price, quantity, item_revenue, coupon, affiliation FROM stg_items",
              "stg_items"),
        "purchase_reconciliation": _all("reconciliation"),
        "order_attribution": _all("attribution"),
        "order_attribution_bucketed": _all("attribution"),
        "fct_attributed_orders": _all("attribution"),
        "fct_orders": _all("fct_orders"),
        "fct_order_lines": with_(
            f"SELECT shop_domain, order_id, order_item_id, customer_id, order_created_at, order_updated_at, "
            f"financial_status, fulfillment_status, currency, product_id, variant_id, sku, line_title, quantity, "
            f"unit_price, line_discount, line_gross_sales, '{CHECK_BATCH_NO}' AS transform_batch_no "
            f"FROM stg_lines WHERE order_id IS NOT NULL", "stg_lines"),
        "fct_channel_revenue": _all("channel_revenue"),
        "fct_funnel": _all("funnel"),
    }


# ---------------------------------------------------------------------------
# Quality suite
# ---------------------------------------------------------------------------
MODEL_CTE = {
    "stg_ga_events": "stg_events", "stg_ga_sessions": "stg_sessions",
    "stg_ga_purchases": "stg_purchases", "stg_ga_items": "stg_items", "stg_orders": "stg_orders",
    "stg_order_line_items": "stg_lines", "stg_customers": "stg_customers",
    "stg_products": "stg_products", "stg_product_variants": "stg_product_variants",
    "purchase_reconciliation": "reconciliation", "order_attribution": "attribution",
    "fct_funnel": "funnel", "fct_attributed_orders": "attribution",
    "fct_channel_revenue": "channel_revenue",
}

_STATUS = ("CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status")


def _summary(model: str, column: str, test: str, severity: str, failures_sql: str) -> str:
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, "
            f"'{severity}' AS severity, CAST(({failures_sql}) AS BIGINT) AS failures")


def _wrap(parts: list[str], ctes: set[str]) -> str:
    body = "\nUNION ALL\n".join(parts)
    return with_(f"SELECT *, {_STATUS} FROM (\n{body}\n)", *sorted(ctes))


def _not_null_parts():
    parts, ctes = [], set()
    for model, c, sev in declared.columns(declared.NOT_NULL):
        t = MODEL_CTE[model]
        ctes.add(t)
        parts.append(_summary(model, c, "not_null", sev, f"SELECT count(*) FROM {t} WHERE {c} IS NULL"))
    return parts, ctes


def _unique_parts():
    parts, ctes = [], set()
    for model, c, sev in declared.columns(declared.UNIQUE):
        t = MODEL_CTE[model]
        ctes.add(t)
        parts.append(_summary(model, c, "unique", sev,
                              f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
                              f"GROUP BY {c} HAVING count(*) > 1)"))
    return parts, ctes


def _accepted_parts():
    parts, ctes = [], set()
    for model, c, sev, where, values in declared.ACCEPTED_VALUES:
        t = MODEL_CTE[model]
        ctes.add(t)
        parts.append(_summary(model, c, "accepted_values", sev,
                              f"SELECT count(*) FROM (SELECT DISTINCT {c} FROM {t} WHERE ({where}) AND {c} NOT IN ({values}))"))
    return parts, ctes


def _combination_parts():
    parts, ctes = [], set()
    for model, sev, cols in declared.UNIQUE_COMBINATION:
        t = MODEL_CTE[model]
        ctes.add(t)
        cl = ", ".join(cols)
        parts.append(_summary(model, ",".join(cols), "unique_combination_of_columns", sev,
                              f"SELECT count(*) FROM (SELECT {cl} FROM {t} GROUP BY {cl} HAVING count(*) > 1)"))
    return parts, ctes


# The singular tests' failing-row SQL.
SINGULAR_SQL = {
    "dq_purchase_missing_txn": ("stg_purchases",
        "SELECT event_key, event_date, event_timestamp, user_pseudo_id, session_key, transaction_id "
        "FROM stg_purchases WHERE transaction_id IS NULL"),
    "dq_funnel_grain": ("funnel",
        "SELECT event_date, source, medium, campaign, count(*) AS row_count FROM funnel "
        "GROUP BY 1, 2, 3, 4 HAVING count(*) > 1"),
    "dq_funnel_rates": ("funnel",
        "SELECT event_date, source, medium, campaign, session_to_view_item_rate, session_to_purchase_rate "
        "FROM funnel WHERE session_to_view_item_rate NOT BETWEEN 0 AND 1 "
        "OR session_to_purchase_rate NOT BETWEEN 0 AND 1"),
    "dq_funnel_step_over_one": ("funnel",
        "SELECT event_date, source, medium, campaign, view_item_to_cart_rate, cart_to_checkout_rate, "
        "checkout_to_purchase_rate FROM funnel WHERE view_item_to_cart_rate > 1 "
        "OR cart_to_checkout_rate > 1 OR checkout_to_purchase_rate > 1"),
    "dq_funnel_non_negative": ("funnel",
        "SELECT event_date, source, medium, campaign, sessions, page_view_sessions, view_item_sessions, "
        "add_to_cart_sessions, checkout_sessions, ga4_purchase_sessions, matched_purchase_sessions, "
        "matched_orders, shopify_revenue FROM funnel WHERE sessions < 0 OR page_view_sessions < 0 "
        "OR view_item_sessions < 0 OR add_to_cart_sessions < 0 OR checkout_sessions < 0 "
        "OR ga4_purchase_sessions < 0 OR matched_purchase_sessions < 0 OR matched_orders < 0 "
        "OR shopify_revenue < 0"),
    "dq_large_revenue_difference": ("reconciliation",
        "SELECT ga4_event_key, ga4_transaction_id, shopify_order_id, ga4_purchase_revenue, "
        "shopify_total_price, revenue_difference FROM reconciliation "
        "WHERE match_status = 'matched' AND abs(coalesce(revenue_difference, 0)) > 1"),
    "dq_unmatched_purchases": ("reconciliation",
        "SELECT ga4_event_key, ga4_event_timestamp, ga4_transaction_id, match_status "
        "FROM reconciliation WHERE match_status != 'matched'"),
    "dq_line_quantity": ("stg_lines",
        "SELECT order_id, order_item_id, quantity FROM stg_lines WHERE quantity <= 0 OR quantity IS NULL"),
    "dq_order_totals": ("stg_orders",
        "SELECT order_id, subtotal_price, total_tax, total_discounts, total_price FROM stg_orders "
        "WHERE coalesce(subtotal_price, 0) < 0 OR coalesce(total_tax, 0) < 0 "
        "OR coalesce(total_discounts, 0) < 0 OR coalesce(total_price, 0) < 0"),
}

# Query name of each singular test -> its suite name, model and severity.
SINGULAR_META = {
    "dq_purchase_missing_txn": ("purchases_have_transaction_id", "stg_ga_purchases", "warn"),
    "dq_funnel_grain": ("funnel_unique_grain", "fct_funnel", "error"),
    "dq_funnel_rates": ("funnel_rates_between_zero_and_one", "fct_funnel", "error"),
    "dq_funnel_step_over_one": ("funnel_step_rates_over_one", "fct_funnel", "warn"),
    "dq_funnel_non_negative": ("funnel_metrics_are_non_negative", "fct_funnel", "error"),
    "dq_large_revenue_difference": ("reconciliation_large_revenue_difference", "purchase_reconciliation", "warn"),
    "dq_unmatched_purchases": ("reconciliation_unmatched_purchases", "purchase_reconciliation", "warn"),
    "dq_line_quantity": ("order_line_quantities_are_positive", "stg_order_line_items", "error"),
    "dq_order_totals": ("order_totals_are_non_negative", "stg_orders", "error"),
}


def _singular_parts():
    parts, ctes = [], set()
    for q, (t, sql) in SINGULAR_SQL.items():
        name, model, sev = SINGULAR_META[q]
        ctes.add(t)
        parts.append(_summary(model, "", name, sev, f"SELECT count(*) FROM ({sql})"))
    return parts, ctes


def quality_sql() -> dict[str, str]:
    # Parameter keys each event carries, from the fixture rules.
    out = {"dq_duplicate_param_keys": with_("""
      SELECT 'u' || CAST(u AS VARCHAR) AS user_pseudo_id, epoch_us(ts) AS event_timestamp,
        event_name, suffix AS _table_suffix
      FROM (SELECT *, list_filter([
              CASE WHEN e % 20 <> 7 THEN 'ga_session_id' END, 'ga_session_number', 'page_location',
              CASE WHEN (e + u) % 5 <> 0 THEN 'source' END, CASE WHEN (e + u) % 2 = 0 THEN 'medium' END,
              CASE WHEN e % 4 <> 0 THEN 'campaign' END, CASE WHEN e % 9 <> 0 THEN 'currency' END,
              'page_title'], lambda x: x IS NOT NULL) AS param_keys
            FROM ev)
      WHERE len(param_keys) <> len(list_distinct(param_keys))""", "ev")}
    groups = {"dq_not_null": _not_null_parts(), "dq_unique": _unique_parts(),
              "dq_accepted_values": _accepted_parts(), "dq_unique_combination": _combination_parts()}
    for k, (parts, ctes) in groups.items():
        out[k] = _wrap(parts, ctes)
    for q, (t, sql) in SINGULAR_SQL.items():
        out[q] = with_(sql, t)
    all_parts, all_ctes = [], set()
    for parts, ctes in list(groups.values()) + [_singular_parts()]:
        all_parts += parts
        all_ctes |= ctes
    out["dq_suite"] = _wrap(all_parts, all_ctes)
    return out


# ---------------------------------------------------------------------------
# Analyses, dashboard metrics, tie-outs
# ---------------------------------------------------------------------------
def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / ({b}) END"


def report_sql(top_k: int = 10) -> dict[str, str]:
    dec = "CAST({} AS DECIMAL(28,6))"
    return {
        "orders_daily_profile": with_(f"""
          SELECT *, {_ratio('total_price', 'orders')} AS average_order_value FROM (
            SELECT order_created_date, currency, count(*) AS orders, count(DISTINCT customer_id) AS customers,
              {money('subtotal_price')} AS subtotal_price, {money('total_discounts')} AS total_discounts,
              {money('total_tax')} AS total_tax, {money('total_price')} AS total_price
            FROM fct_orders GROUP BY 1, 2)
          ORDER BY order_created_date DESC, currency""", "fct_orders"),
        "ga_event_profile": with_("""
          SELECT event_date, event_timestamp, event_name, user_pseudo_id, ga_session_id, page_location,
            raw_transaction_id AS transaction_id, purchase_revenue, source_table_suffix
          FROM stg_events""", "stg_events"),
        "dash_executive": with_(f"""
          SELECT total_revenue, orders, {_ratio('total_revenue', 'orders')} AS average_order_value,
            attributed_revenue, unattributed_revenue, attributed_orders,
            {_ratio('attributed_revenue', 'total_revenue')} AS revenue_attribution_coverage_rate
          FROM (SELECT {money('total_revenue')} AS total_revenue, CAST(sum(orders) AS BIGINT) AS orders,
                  {money('attributed_revenue')} AS attributed_revenue,
                  {money('unattributed_revenue')} AS unattributed_revenue,
                  CAST(sum(attributed_orders) AS BIGINT) AS attributed_orders
                FROM channel_revenue)""", "channel_revenue"),
        "dash_top_channels": with_(f"""
          SELECT attributed_source || ' / ' || attributed_medium AS channel,
            {money('total_revenue')} AS total_revenue, CAST(sum(orders) AS BIGINT) AS orders
          FROM channel_revenue GROUP BY 1 ORDER BY total_revenue DESC, channel LIMIT {top_k}""",
                                   "channel_revenue"),
        "dash_funnel": with_(f"""
          SELECT *, {_ratio('view_item_sessions', 'sessions')} AS session_to_view_item_rate,
            {_ratio('add_to_cart_sessions', 'view_item_sessions')} AS view_item_to_cart_rate,
            {_ratio('checkout_sessions', 'add_to_cart_sessions')} AS cart_to_checkout_rate,
            {_ratio('matched_purchase_sessions', 'checkout_sessions')} AS checkout_to_purchase_rate,
            {_ratio('matched_purchase_sessions', 'sessions')} AS session_to_purchase_rate,
            {_ratio('shopify_revenue', 'sessions')} AS revenue_per_session
          FROM (SELECT source, medium, campaign,
                  CAST(sum(sessions) AS BIGINT) AS sessions,
                  CAST(sum(page_view_sessions) AS BIGINT) AS page_view_sessions,
                  CAST(sum(view_item_sessions) AS BIGINT) AS view_item_sessions,
                  CAST(sum(add_to_cart_sessions) AS BIGINT) AS add_to_cart_sessions,
                  CAST(sum(checkout_sessions) AS BIGINT) AS checkout_sessions,
                  CAST(sum(ga4_purchase_sessions) AS BIGINT) AS ga4_purchase_sessions,
                  CAST(sum(matched_purchase_sessions) AS BIGINT) AS matched_purchase_sessions,
                  CAST(sum(matched_orders) AS BIGINT) AS matched_orders,
                  {money('shopify_revenue')} AS shopify_revenue
                FROM funnel GROUP BY 1, 2, 3)""", "funnel"),
        "dash_channel": with_(f"""
          SELECT *, {_ratio('attributed_revenue', 'total_revenue')} AS revenue_attribution_coverage_rate,
            {_ratio('attributed_orders', 'orders')} AS order_attribution_coverage_rate,
            {_ratio('total_revenue', 'orders')} AS average_order_value
          FROM (SELECT attributed_source, attributed_medium, attributed_campaign,
                  {money('total_revenue')} AS total_revenue, {money('attributed_revenue')} AS attributed_revenue,
                  {money('unattributed_revenue')} AS unattributed_revenue,
                  CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(attributed_orders) AS BIGINT) AS attributed_orders,
                  CAST(sum(unattributed_orders) AS BIGINT) AS unattributed_orders
                FROM channel_revenue GROUP BY 1, 2, 3)""", "channel_revenue"),
        "dash_reconciliation": with_(f"""
          SELECT *, {_ratio('matched_purchases', 'purchase_events')} AS match_rate FROM (
            SELECT count(*) AS purchase_events,
              count(*) FILTER (WHERE match_status = 'matched') AS matched_purchases,
              count(*) FILTER (WHERE match_status = 'unmatched_transaction_id') AS unmatched_purchases,
              count(*) FILTER (WHERE match_status = 'missing_transaction_id') AS missing_transaction_ids,
              count(*) FILTER (WHERE match_status = 'not_set_transaction_id') AS not_set_transaction_ids,
              count(*) FILTER (WHERE match_status IN ('missing_transaction_id', 'not_set_transaction_id'))
                AS invalid_transaction_ids,
              count(*) FILTER (WHERE same_currency = false) AS currency_mismatches,
              count(*) FILTER (WHERE match_status = 'matched' AND abs(coalesce(revenue_difference, 0)) > 1)
                AS large_revenue_differences,
              {money("CASE WHEN match_status = 'matched' THEN ga4_purchase_revenue END")} AS matched_event_revenue,
              {money("CASE WHEN match_status = 'matched' THEN shopify_total_price END")} AS matched_order_revenue
            FROM reconciliation)""", "reconciliation"),
        "tieout_revenue": with_(f"""
          SELECT CAST(a AS DOUBLE) AS channel_revenue_total, CAST(b AS DOUBLE) AS order_revenue_total,
            CAST(a - b AS DOUBLE) AS difference, abs(a - b) < 0.005 AS tied
          FROM (SELECT (SELECT sum({dec.format('total_revenue')}) FROM channel_revenue) AS a,
                       (SELECT sum({dec.format('total_price')}) FROM fct_orders) AS b)""",
                                "channel_revenue", "fct_orders"),
        "tieout_attribution_split": with_(f"""
          SELECT CAST(att AS DOUBLE) AS attributed_revenue, CAST(un AS DOUBLE) AS unattributed_revenue,
            CAST(tot AS DOUBLE) AS total_revenue, CAST(att + un - tot AS DOUBLE) AS difference,
            abs(att + un - tot) < 0.005 AS tied
          FROM (SELECT sum({dec.format('attributed_revenue')}) AS att,
                  sum({dec.format('unattributed_revenue')}) AS un, sum({dec.format('total_revenue')}) AS tot
                FROM channel_revenue)""", "channel_revenue"),
        "tieout_purchases": with_("""
          SELECT *, matched + not_matched - purchase_events AS difference,
            matched + not_matched - purchase_events = 0 AS tied
          FROM (SELECT count(*) AS purchase_events,
                  count(*) FILTER (WHERE match_status = 'matched') AS matched,
                  count(*) FILTER (WHERE match_status != 'matched') AS not_matched
                FROM reconciliation)""", "reconciliation"),
        "tieout_layers": with_(f"""
          SELECT s AS stg_orders, f AS fct_orders, a AS attributed_orders,
            CAST(fr AS DOUBLE) AS fct_orders_revenue, CAST(ar AS DOUBLE) AS attributed_orders_revenue,
            s = f AND f = a AS counts_tied, abs(fr - ar) < 0.005 AS revenue_tied
          FROM (SELECT (SELECT count(*) FROM stg_orders) AS s, (SELECT count(*) FROM fct_orders) AS f,
                  (SELECT count(*) FROM attribution) AS a,
                  (SELECT sum({dec.format('total_price')}) FROM fct_orders) AS fr,
                  (SELECT sum({dec.format('total_price')}) FROM attribution) AS ar)""",
                               "stg_orders", "fct_orders", "attribution"),
        "attribution_coverage": with_(f"""
          SELECT *, {_ratio('attributed_orders', 'orders')} AS order_attribution_rate,
            {_ratio('attributed_revenue', 'total_revenue')} AS revenue_attribution_rate
          FROM (SELECT count(*) AS orders, count(*) FILTER (WHERE is_attributed) AS attributed_orders,
                  count(*) FILTER (WHERE NOT is_attributed) AS unattributed_orders,
                  {money('CASE WHEN is_attributed THEN total_price END')} AS attributed_revenue,
                  {money('CASE WHEN NOT is_attributed THEN total_price END')} AS unattributed_revenue,
                  {money('total_price')} AS total_revenue
                FROM attribution)""", "attribution"),
    }


# ---------------------------------------------------------------------------
# Landing and incremental facts
# ---------------------------------------------------------------------------
# The first landed snapshot of each order (V1): its payload's updated_at.
cte("api_orders", [], """
  SELECT o_orderkey AS order_id,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END AS updated_at,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'partially_refunded'
    END AS financial_status
  FROM orders""")

cte("fct_orders_v1", ["stg_orders_v1"], f"""
  SELECT shop_domain, order_id, customer_id, created_at AS order_created_at,
    CAST(created_at AS DATE) AS order_created_date, CAST(updated_at AS DATE) AS order_updated_date,
    updated_at AS order_updated_at, order_number, order_name, currency, financial_status,
    subtotal_price, total_discounts, total_tax, total_price, '{CHECK_BATCH_NO}' AS transform_batch_no
  FROM stg_orders_v1 WHERE order_id IS NOT NULL""")

_LINE_FACT = ("shop_domain, order_id, order_item_id, customer_id, order_created_at, order_updated_at, "
              "financial_status, fulfillment_status, currency, product_id, variant_id, sku, line_title, "
              "quantity, unit_price, line_discount, line_gross_sales")


def landing_sql() -> dict[str, str]:
    ckpt = "TIMESTAMP '1998-01-01'"
    return {
        "landing_unwrap_pages": with_("SELECT * FROM api_orders", "api_orders"),
        "landing_raw_rows": with_("SELECT 'shop-a' AS shop_domain, order_id, updated_at, CAST(1 AS BIGINT) "
                                  "AS batch_no FROM api_orders", "api_orders"),
        "landing_incremental_filter": with_(
            f"SELECT order_id, updated_at FROM api_orders WHERE updated_at IS NULL OR updated_at > {ckpt}",
            "api_orders"),
        "landing_high_watermark": with_(
            f"SELECT 'order' AS source, max(updated_at) AS last_updated_at FROM api_orders "
            f"WHERE updated_at IS NULL OR updated_at > {ckpt}", "api_orders"),
        "landing_state_merge": with_(f"""
          SELECT 'order' AS source, coalesce((SELECT max(updated_at) FROM api_orders WHERE updated_at > {ckpt}),
                                             {ckpt}) AS last_updated_at
          UNION ALL
          SELECT 'product', coalesce((SELECT max(u) FROM (
              SELECT CAST(DATE '2001-01-01' + CAST(p_partkey % 365 AS INTEGER) AS TIMESTAMP)
                     + INTERVAL 1 DAY AS u FROM part) WHERE u > TIMESTAMP '2001-06-01'),
            TIMESTAMP '2001-06-01')
          UNION ALL
          SELECT 'customer', TIMESTAMP '2001-03-01'""", "api_orders"),
        "landing_append_idempotent": with_(
            "SELECT order_id, updated_at, CAST(1 AS BIGINT) AS batch_no FROM api_orders "
            "UNION ALL SELECT order_id, updated_at, CAST(2 AS BIGINT) FROM api_orders WHERE updated_at IS NULL",
            "api_orders"),
        "source_contract": with_("""
          SELECT 'shop' AS source_name, 'raw_customers' AS table_name, 'ingested_at' AS loaded_at_field,
                 count(*) + count(*) FILTER (WHERE c_custkey % 6 = 0) AS row_count,
                 CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS BIGINT) AS missing FROM customer
          UNION ALL SELECT 'shop', 'raw_products', 'ingested_at', count(*), NULL, NULL FROM product_versions
          UNION ALL SELECT 'shop', 'raw_orders', 'ingested_at', count(*), unnest(['order_id', 'updated_at', 'payload_json']), 0
                    FROM order_versions
          UNION ALL SELECT 'analytics', 'events', NULL, n, c, CASE WHEN c = 'items' THEN no_items ELSE 0 END
                    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 10 = 0) AS no_items FROM events),
                         (SELECT unnest(['event_name', 'event_timestamp', 'event_date', 'user_pseudo_id', 'event_params',
                                         'items']) AS c)""", "order_versions", "product_versions"),
        # Columns and described columns are the tables' contract.
        "published_marts": with_("""
          SELECT 'fct_orders' AS table_name, count(*) AS row_count, CAST(16 AS BIGINT) AS columns,
                 CAST(4 AS BIGINT) AS described_columns, 'One row per shop order, latest version' AS comment FROM fct_orders
          UNION ALL SELECT 'fct_order_lines', (SELECT count(*) FROM stg_lines WHERE order_id IS NOT NULL), 18, 4, 'One row per order line'
          UNION ALL SELECT 'fct_attributed_orders', (SELECT count(*) FROM attribution), 23, 3,
                           'One row per order with its channel, or unattributed'
          UNION ALL SELECT 'fct_channel_revenue', (SELECT count(*) FROM channel_revenue), 18, 3, 'Revenue per day, currency and channel'
          UNION ALL SELECT 'fct_funnel', (SELECT count(*) FROM funnel), 19, 2,
                           'Sessions per day and channel that reached each step'""",
                                 "fct_orders", "stg_lines", "attribution", "channel_revenue", "funnel"),
        "landing_second_snapshot": with_(
            "SELECT order_id, updated_at, CAST(1 AS BIGINT) AS batch_no FROM api_orders UNION ALL "
            "SELECT o_orderkey, CASE WHEN o_orderkey % 31 <> 0 THEN o_orderdate + INTERVAL 3 DAY END, CAST(2 AS BIGINT) "
            "FROM orders WHERE o_orderkey % 7 = 0 AND (o_orderkey % 31 = 0 OR o_orderdate + INTERVAL 3 DAY > "
            "(SELECT max(updated_at) FROM api_orders))", "api_orders"),
        "landing_stream_batches": with_(
            "SELECT order_id, updated_at, max(updated_at) OVER () AS last_updated_at FROM api_orders", "api_orders"),
        # Read again: records without a time; of the later versions those past the first
        # run's watermark or without a time (version 3 has none, version 4 repeats the first).
        "landing_stream_new_checkpoint": with_(
            "SELECT order_id, updated_at FROM api_orders "
            "UNION ALL SELECT order_id, updated_at FROM api_orders WHERE updated_at IS NULL "
            "UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 31 <> 0 THEN o_orderdate + INTERVAL 3 DAY END "
            "FROM orders WHERE o_orderkey % 7 = 0 AND (o_orderkey % 31 = 0 OR o_orderdate + INTERVAL 3 DAY > "
            "(SELECT max(updated_at) FROM api_orders)) "
            "UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 13 = 0 "
            "UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey % 31 = 0", "api_orders"),
        # Shards before 20240115 have no items; the last day's is an intraday shard.
        "ga_events_from_shards": with_(
            "SELECT event_key, event_date, event_name, ga_session_id, source, transaction_id, purchase_revenue, "
            "CASE WHEN source_table_suffix = '20240130' THEN 'intraday_20240130' ELSE source_table_suffix END AS source_table_suffix, "
            "CASE WHEN source_table_suffix >= '20240115' THEN CAST(e % 5 AS BIGINT) ELSE 0 END AS n_items FROM stg_events", "stg_events"),
        "landing_stream_idempotent": with_("SELECT order_id, updated_at FROM api_orders", "api_orders"),
        "source_freshness": with_("""
          SELECT 'raw_orders' AS source_name, 'ingested_at' AS loaded_at_field,
                 max(ingested_at) AS max_loaded_at, count(*) AS row_count FROM order_versions
          UNION ALL
          SELECT 'raw_products', 'ingested_at', max(ingested_at), count(*) FROM product_versions
          UNION ALL
          SELECT 'raw_customers', 'ingested_at',
                 CASE WHEN count(*) FILTER (WHERE c_custkey % 6 = 0) > 0 THEN TIMESTAMP '2002-01-02'
                      ELSE TIMESTAMP '2002-01-01' END,
                 count(*) + count(*) FILTER (WHERE c_custkey % 6 = 0) FROM customer""",
                                  "order_versions", "product_versions"),
        "fct_orders_incremental_merge": with_(
            "SELECT * FROM upd UNION ALL SELECT * FROM fct_orders_v1 t "
            "WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.order_id = t.order_id)",
            "fct_orders_v1", "fct_orders", extra=[
                ("bound", "SELECT max(order_updated_at) - INTERVAL 1 DAY AS b FROM fct_orders_v1"),
                ("upd", "SELECT * FROM fct_orders WHERE order_updated_at >= "
                        "(SELECT coalesce(b, TIMESTAMP '1900-01-01') FROM bound)")]),
        "fct_order_lines_incremental_merge": with_(
            "SELECT * FROM upd UNION ALL SELECT * FROM tgt t "
            "WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.order_item_id = t.order_item_id)",
            "stg_lines_v1", "stg_lines", "stg_orders", extra=[
                ("tgt", f"SELECT {_LINE_FACT}, '{CHECK_BATCH_NO}' AS transform_batch_no FROM stg_lines_v1 "
                        f"WHERE order_id IS NOT NULL"),
                ("bound", "SELECT max(order_updated_at) - INTERVAL 1 DAY AS b FROM tgt"),
                ("upd", f"SELECT {_LINE_FACT}, '{CHECK_BATCH_NO}' AS transform_batch_no FROM stg_lines "
                        f"WHERE order_id IN (SELECT order_id FROM stg_orders WHERE updated_at >= "
                        f"(SELECT coalesce(b, TIMESTAMP '1900-01-01') FROM bound))")]),
    }
