"""Marts: order and order-line facts (M12, M13), attributed orders (M14),
channel revenue (M15, the flagship) and the session funnel (M16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.money import money_sum, ratio
from tallyspark.operators.incremental import changed_since
from tallyspark.params import Params
from tallyspark.plans.reconcile import ATTRIBUTION_COLUMNS, matched_of

# The contract's column order.
FCT_ORDER_COLUMNS = [
    "shop_domain", "order_id", "customer_id", "order_created_at", "order_created_date",
    "order_updated_date", "order_updated_at", "order_number", "order_name", "currency",
    "financial_status", "subtotal_price", "total_discounts", "total_tax", "total_price",
    "transform_batch_no",
]

# The contract's column order.
FCT_LINE_COLUMNS = [
    "shop_domain", "order_id", "order_item_id", "customer_id", "order_created_at",
    "order_updated_at", "financial_status", "fulfillment_status", "currency", "product_id",
    "variant_id", "sku", "line_title", "quantity", "unit_price", "line_discount",
    "line_gross_sales", "transform_batch_no",
]


def _changed(df: DataFrame, updated: str, bound) -> DataFrame:
    """Rows of orders changed since ``bound`` (``None``: all). Orders, and the
    lines that carry their order's update time, are filtered where they stand:
    the changed-id set of the reference is the same rows. A NULL id never
    passes."""
    kept = df.where(F.col("order_id").isNotNull())
    return kept if bound is None else changed_since(kept, updated, bound)


def fct_orders(stg_orders: DataFrame, params: Params | None = None, bound=None) -> DataFrame:
    """M12. ``bound`` (a timestamp column/literal) selects the incremental
    window; ``None`` is a full build. Of orders without number, name or status
    (written for readers of neither), the fact has none."""
    params = params or Params()
    o = _changed(stg_orders, "updated_at", bound)
    carried = lambda *names: [c for c in names if c in o.columns]
    return o.select(
        "shop_domain", "order_id", "customer_id",
        F.col("created_at").alias("order_created_at"),
        F.to_date("created_at").alias("order_created_date"),
        F.to_date("updated_at").alias("order_updated_date"),
        F.col("updated_at").alias("order_updated_at"),
        *carried("order_number", "order_name"), "currency", *carried("financial_status"), "subtotal_price",
        "total_discounts", "total_tax", "total_price",
        F.lit(params.transform_batch_no).alias("transform_batch_no"))


def fct_order_lines(lines_wide: DataFrame, params: Params | None = None, bound=None) -> DataFrame:
    """M13 from the wide line rows (lines already carry their order's
    columns; see ``staging.order_lines_wide``). Incremental runs keep lines
    of orders changed since ``bound`` (no fan-out, D3)."""
    params = params or Params()
    li = _changed(lines_wide, "order_updated_at", bound)
    return li.select(
        "shop_domain", "order_id", "order_item_id", "customer_id", "order_created_at",
        "order_updated_at", "financial_status", "fulfillment_status", "currency", "product_id",
        "variant_id", "sku", "line_title", "quantity", "unit_price", "line_discount",
        "line_gross_sales", F.lit(params.transform_batch_no).alias("transform_batch_no"))


# The contract's column order.
FCT_ATTRIBUTED_COLUMNS = [
    "order_id", "customer_id", "order_created_at", "order_created_date", "ga4_purchase_date",
    "currency", "financial_status", "subtotal_price", "total_discounts", "total_tax",
    "total_price", "attribution_model", "is_attributed", "attributed_source",
    "attributed_medium", "attributed_campaign", "ga4_event_key", "ga4_event_timestamp",
    "ga4_transaction_id", "user_pseudo_id", "session_key", "revenue_difference",
    "same_currency",
]
assert sorted(FCT_ATTRIBUTED_COLUMNS) == sorted(ATTRIBUTION_COLUMNS)


def fct_attributed_orders(order_attribution: DataFrame) -> DataFrame:
    """The 23-column attributed-order contract (fewer, where M11 was written with fewer)."""
    return order_attribution.select(*[c for c in FCT_ATTRIBUTED_COLUMNS if c in order_attribution.columns])


# The mart's grain and columns.
CHANNEL_KEYS = ["revenue_date", "currency", "attributed_source", "attributed_medium",
                "attributed_campaign"]
CHANNEL_COLUMNS = CHANNEL_KEYS + [
    "orders", "customers", "attributed_orders", "unattributed_orders", "subtotal_revenue",
    "discounts", "tax", "total_revenue", "attributed_revenue", "unattributed_revenue",
    "order_attribution_coverage_rate", "revenue_attribution_coverage_rate",
    "average_order_value",
]


def fct_channel_revenue(attributed: DataFrame) -> DataFrame:
    """Revenue by order date, currency and attributed channel.

    Orders, then customers, then channels, each distinct count as a plain count of
    the level before it; no row is copied per distinct count. The first level
    groups by order id and keeps the partitioning of the join that made the
    attributed orders, if that joined by key: the first shuffle then carries
    one narrow row per order and customer, partially added up. An order id with
    several rows (orders of several shops) counts once in a channel, its money
    as often as it stands. Money is summed exactly (decimal).
    """
    a = attributed.select(
        F.col("order_created_date").alias("revenue_date"), "currency", "attributed_source",
        "attributed_medium", "attributed_campaign", "order_id", "customer_id", "is_attributed",
        "subtotal_price", "total_discounts", "total_tax", "total_price")
    att = F.col("is_attributed")
    money = ["subtotal_revenue", "discounts", "tax", "total_revenue", "attributed_revenue", "unattributed_revenue"]
    counts = ["orders", "attributed_orders", "unattributed_orders"]
    # One row per order and customer, almost always one per order.
    per_order = a.groupBy("order_id", *CHANNEL_KEYS, "customer_id").agg(
        F.max(att).alias("_any_attributed"), F.max(~att).alias("_any_unattributed"),
        money_sum("subtotal_price").alias("subtotal_revenue"), money_sum("total_discounts").alias("discounts"),
        money_sum("total_tax").alias("tax"), money_sum("total_price").alias("total_revenue"),
        money_sum(F.when(att, F.col("total_price")).otherwise(F.lit(0.0))).alias("attributed_revenue"),
        money_sum(F.when(~att, F.col("total_price")).otherwise(F.lit(0.0))).alias("unattributed_revenue"))
    same = Window.partitionBy("order_id", *CHANNEL_KEYS)
    first = F.row_number().over(same.orderBy("customer_id")) == 1
    known = F.col("order_id").isNotNull()
    flagged = per_order.select(
        *CHANNEL_KEYS, "customer_id", *money, (first & known).cast("bigint").alias("orders"),
        (first & known & F.max("_any_attributed").over(same)).cast("bigint").alias("attributed_orders"),
        (first & known & F.max("_any_unattributed").over(same)).cast("bigint").alias("unattributed_orders"))
    per_customer = flagged.groupBy(*CHANNEL_KEYS, "customer_id").agg(*[F.sum(c).alias(c) for c in counts + money])
    g = per_customer.groupBy(*CHANNEL_KEYS).agg(
        F.count("customer_id").alias("customers"), *[F.sum(c).alias(c) for c in counts],
        *[F.sum(c).cast("double").alias(c) for c in money])
    return g.select(
        *CHANNEL_KEYS, "orders", "customers", "attributed_orders", "unattributed_orders",
        "subtotal_revenue", "discounts", "tax", "total_revenue", "attributed_revenue",
        "unattributed_revenue",
        ratio("attributed_orders", "orders").alias("order_attribution_coverage_rate"),
        ratio("attributed_revenue", "total_revenue").alias("revenue_attribution_coverage_rate"),
        ratio("total_revenue", "orders").alias("average_order_value"),
    )


NOT_SET = "(not set)"
# The mart's grain.
FUNNEL_KEYS = ["event_date", "source", "medium", "campaign"]
FUNNEL_COLUMNS = FUNNEL_KEYS + [
    "sessions", "page_view_sessions", "view_item_sessions", "add_to_cart_sessions",
    "checkout_sessions", "ga4_purchase_sessions", "matched_purchase_sessions", "matched_orders",
    "shopify_revenue", "session_to_view_item_rate", "view_item_to_cart_rate",
    "cart_to_checkout_rate", "checkout_to_purchase_rate", "session_to_purchase_rate",
    "revenue_per_session",
]


def fct_funnel(sessions: DataFrame, reconciliation: DataFrame) -> DataFrame:
    """M16 from the sessions and the reconciliation."""
    return funnel_of_matched(sessions, matched_of(reconciliation))


def funnel_of_matched(sessions: DataFrame, matched: DataFrame) -> DataFrame:
    """Sessions and funnel steps by session date and traffic source, from
    the sessions and the matched purchases (session, order, order total).

    Matched orders are pre-aggregated per order and session under the
    partitioning of the order join, then per session. The
    ``count(distinct if(flag, session_key))`` family is computed from a
    per-(group, session_key) aggregate; grouping by session_key first keeps
    the join's partitioning, so no extra shuffle is added.
    Revenue is summed per purchase event (an order bought twice in a session
    counts twice, D11); rates use matched purchases.
    """
    s = sessions.select(
        F.to_date("session_start_at").alias("event_date"), "session_key",
        F.coalesce("source", F.lit(NOT_SET)).alias("source"),
        F.coalesce("medium", F.lit(NOT_SET)).alias("medium"),
        F.coalesce("campaign", F.lit(NOT_SET)).alias("campaign"),
        (F.col("page_view_count") > 0).alias("had_page_view"),
        (F.col("view_item_count") > 0).alias("had_view_item"),
        (F.col("add_to_cart_count") > 0).alias("had_add_to_cart"),
        (F.col("begin_checkout_count") > 0).alias("had_begin_checkout"),
        (F.col("purchase_count") > 0).alias("had_ga4_purchase"))
    per_order = matched.groupBy("order_id", "session_key").agg(money_sum("total_price").alias("_revenue"))
    m = per_order.groupBy(F.col("session_key").alias("_m_session_key")).agg(
        F.count("order_id").alias("_matched_orders"), F.sum("_revenue").alias("_revenue"))
    j = s.join(m, s.session_key == m._m_session_key, "left")
    flags = ["had_page_view", "had_view_item", "had_add_to_cart", "had_begin_checkout", "had_ga4_purchase"]
    per_session = j.groupBy("session_key", *FUNNEL_KEYS).agg(
        *[F.max(f).alias(f) for f in flags],
        F.max(F.col("_matched_orders") > 0).alias("_had_match"),
        F.sum(F.coalesce("_matched_orders", F.lit(0))).alias("_mo"),
        F.sum(F.coalesce("_revenue", F.lit(0).cast("decimal(38,6)"))).alias("_rev"))
    key = F.col("session_key").isNotNull()
    f = per_session.groupBy(*FUNNEL_KEYS).agg(
        F.count("session_key").alias("sessions"),
        F.count_if(key & F.col("had_page_view")).alias("page_view_sessions"),
        F.count_if(key & F.col("had_view_item")).alias("view_item_sessions"),
        F.count_if(key & F.col("had_add_to_cart")).alias("add_to_cart_sessions"),
        F.count_if(key & F.col("had_begin_checkout")).alias("checkout_sessions"),
        F.count_if(key & F.col("had_ga4_purchase")).alias("ga4_purchase_sessions"),
        F.count_if(key & F.col("_had_match")).alias("matched_purchase_sessions"),
        F.sum("_mo").alias("matched_orders"),
        F.sum("_rev").cast("double").alias("shopify_revenue"))
    return f.select(
        *FUNNEL_KEYS, "sessions", "page_view_sessions", "view_item_sessions",
        "add_to_cart_sessions", "checkout_sessions", "ga4_purchase_sessions",
        "matched_purchase_sessions", "matched_orders", "shopify_revenue",
        ratio("view_item_sessions", "sessions").alias("session_to_view_item_rate"),
        ratio("add_to_cart_sessions", "view_item_sessions").alias("view_item_to_cart_rate"),
        ratio("checkout_sessions", "add_to_cart_sessions").alias("cart_to_checkout_rate"),
        ratio("matched_purchase_sessions", "checkout_sessions").alias("checkout_to_purchase_rate"),
        ratio("matched_purchase_sessions", "sessions").alias("session_to_purchase_rate"),
        ratio("shopify_revenue", "sessions").alias("revenue_per_session"),
    )
