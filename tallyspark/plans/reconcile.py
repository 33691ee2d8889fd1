"""Purchase-to-order reconciliation (M10) and order attribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.dedup import first_per_key
from tallyspark.operators.joins import left_join_spread

# Match statuses, in the order they are tested.
MATCH_STATUSES = ["matched", "missing_transaction_id", "not_set_transaction_id", "unmatched_transaction_id"]
ATTRIBUTION_MODEL = "purchase_session"
UNATTRIBUTED = "unattributed"

# The contract's column order.
RECONCILIATION_COLUMNS = [
    "ga4_event_key", "ga4_event_timestamp", "ga4_transaction_id", "ga4_purchase_revenue",
    "ga4_currency", "user_pseudo_id", "session_key", "source", "medium", "campaign",
    "shopify_order_id", "shopify_order_name", "shopify_order_number", "shopify_created_at",
    "shopify_total_price", "shopify_currency", "customer_id", "financial_status",
    "fulfillment_status", "match_status", "match_type", "revenue_difference", "same_currency",
]


# Columns that are only carried along, and their names in ``stg_orders``.
ORDER_SIDE = {"shopify_order_name": "order_name", "shopify_order_number": "order_number", "shopify_created_at": "created_at",
              "customer_id": "customer_id", "financial_status": "financial_status", "fulfillment_status": "fulfillment_status"}


def purchase_reconciliation(purchases: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Every purchase event, left-joined to the shop order whose id text
    equals the transaction id.

    The order side is cast to text (casting the event side to a number
    would fail on ``'not_set'``). Events whose id is NULL or not an integer
    literal can never match; they are spread over the shuffle (one scan).
    Of orders without some of the columns, the result has none of these.
    """
    p = purchases.select(
        F.col("event_key").alias("ga4_event_key"),
        F.col("event_timestamp").alias("ga4_event_timestamp"),
        F.col("transaction_id").alias("ga4_transaction_id"),
        F.col("purchase_revenue").alias("ga4_purchase_revenue"),
        F.col("currency").alias("ga4_currency"),
        "user_pseudo_id", "session_key", "source", "medium", "campaign")
    o = stg_orders.select(
        F.col("order_id").cast("string").alias("_order_key"),
        F.col("order_id").alias("shopify_order_id"),
        F.col("total_price").alias("shopify_total_price"),
        F.col("currency").alias("shopify_currency"),
        *[F.col(c).alias(a) for a, c in ORDER_SIDE.items() if c in stg_orders.columns],
    ).where(F.col("_order_key").isNotNull())
    eligible = F.col("ga4_transaction_id").rlike("^-?[0-9]+$")
    j = left_join_spread(p, o, "ga4_transaction_id", "_order_key", eligible, "ga4_event_key").drop("_order_key")
    txn = F.col("ga4_transaction_id")
    matched = F.col("shopify_order_id").isNotNull()
    return j.select(
        *[c for c in RECONCILIATION_COLUMNS[:19] if c not in ORDER_SIDE or c in o.columns],
        F.when(txn.isNull(), "missing_transaction_id")
         .when(F.lower(txn) == "not_set", "not_set_transaction_id")
         .when(matched, "matched")
         .otherwise("unmatched_transaction_id").alias("match_status"),
        F.when(matched, F.lit("order_id")).alias("match_type"),
        (F.col("ga4_purchase_revenue") - F.col("shopify_total_price")).alias("revenue_difference"),
        (F.col("ga4_currency") == F.col("shopify_currency")).alias("same_currency"),
    )


# The contract's column order.
ATTRIBUTION_COLUMNS = [
    "order_id", "customer_id", "order_created_at", "order_created_date", "currency",
    "financial_status", "subtotal_price", "total_discounts", "total_tax", "total_price",
    "ga4_event_key", "ga4_event_timestamp", "ga4_purchase_date", "ga4_transaction_id",
    "user_pseudo_id", "session_key", "attribution_model", "is_attributed",
    "attributed_source", "attributed_medium", "attributed_campaign", "revenue_difference",
    "same_currency",
]


def order_number_of(transaction_id) -> Column:
    """The order id that a transaction id names: the integer whose text it is
    exactly (``'007'`` and ``'-0'`` name none), else NULL."""
    txn = F.col(transaction_id)
    return F.when(txn.rlike("^(0|-?[1-9][0-9]*)$"), txn.try_cast("bigint"))


def matched_purchases(purchases: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """``session_key, order_id, total_price`` per purchase event of a session
    that M10 matches: its matched rows without the columns that nobody asked for.
    Joined on the order id as a number, so that groupings by it (and more) keep
    the join's partitioning."""
    p = purchases.select("session_key", order_number_of("transaction_id").alias("_named")).where(
        F.col("session_key").isNotNull() & F.col("_named").isNotNull())
    o = stg_orders.select("order_id", "total_price")
    return o.join(p, o.order_id == p._named).select("session_key", "order_id", "total_price")


def matched_of(reconciliation: DataFrame) -> DataFrame:
    """The same from the written M10."""
    return reconciliation.where((F.col("match_status") == "matched") & F.col("session_key").isNotNull()).select(
        "session_key", F.col("shopify_order_id").alias("order_id"), F.col("shopify_total_price").alias("total_price"))


def order_attribution(fct_orders: DataFrame, purchases: DataFrame) -> DataFrame:
    """Every order, with its first matched purchase (by event time, then
    event key: the reference leaves ties arbitrary, D5) as the attribution
    touch. Unmatched orders keep their revenue, labelled ``unattributed``.

    A purchase matches an order when its transaction id equals the order id
    as text (M10), so "first matched purchase per order" is "first purchase
    per transaction id", joined to the order on that id. It is computed from
    the purchases directly: one partial aggregate per id (a hot id collapses
    map-side) and one join, instead of re-deriving the reconciliation's
    order join. Same rows as the M10-based form while ``order_id`` is unique
    (D2); ``tests`` check the two forms agree. Of orders without some of the
    columns, the result has none of these.
    """
    p = purchases.select(
        order_number_of("transaction_id").alias("_named"),
        "transaction_id", "event_timestamp", "event_key", "user_pseudo_id", "session_key",
        "source", "medium", "campaign", "purchase_revenue",
        F.col("currency").alias("_ga_currency")).where(F.col("_named").isNotNull())
    first = first_per_key(p, "_named", ["event_timestamp", "event_key"])
    kept = [c for c in ATTRIBUTION_COLUMNS[:10] if c in fct_orders.columns]
    o = fct_orders.select(*kept)
    # On the number, not its text: groupings by order id keep the join's partitioning.
    j = o.join(first, o.order_id == first._named, "left")
    matched = F.col("transaction_id").isNotNull()
    return j.select(
        *kept,
        F.col("event_key").alias("ga4_event_key"),
        F.col("event_timestamp").alias("ga4_event_timestamp"),
        F.to_date("event_timestamp").alias("ga4_purchase_date"),
        F.col("transaction_id").alias("ga4_transaction_id"),
        "user_pseudo_id", "session_key",
        F.lit(ATTRIBUTION_MODEL).alias("attribution_model"),
        matched.alias("is_attributed"),
        F.coalesce(F.col("source"), F.lit(UNATTRIBUTED)).alias("attributed_source"),
        F.coalesce(F.col("medium"), F.lit(UNATTRIBUTED)).alias("attributed_medium"),
        F.coalesce(F.col("campaign"), F.lit(UNATTRIBUTED)).alias("attributed_campaign"),
        (F.col("purchase_revenue") - F.col("total_price")).alias("revenue_difference"),
        (F.col("_ga_currency") == F.col("currency")).alias("same_currency"),
    )


def order_attribution_via_reconciliation(fct_orders: DataFrame, reconciliation: DataFrame) -> DataFrame:
    """M11 in the reference's literal form (first matched row of M10 per
    order). Kept as the cross-check for ``order_attribution``."""
    m = reconciliation.where(F.col("match_status") == "matched").select(
        "shopify_order_id", "ga4_event_timestamp", "ga4_event_key", "ga4_transaction_id",
        "user_pseudo_id", "session_key", "source", "medium", "campaign",
        "revenue_difference", "same_currency")
    first = first_per_key(m, "shopify_order_id", ["ga4_event_timestamp", "ga4_event_key"])
    o = fct_orders.select("order_id", "customer_id", "order_created_at", "order_created_date",
                          "currency", "financial_status", "subtotal_price", "total_discounts",
                          "total_tax", "total_price")
    j = o.join(first, o.order_id == first.shopify_order_id, "left")
    return j.select(
        "order_id", "customer_id", "order_created_at", "order_created_date", "currency",
        "financial_status", "subtotal_price", "total_discounts", "total_tax", "total_price",
        "ga4_event_key", "ga4_event_timestamp",
        F.to_date("ga4_event_timestamp").alias("ga4_purchase_date"),
        "ga4_transaction_id", "user_pseudo_id", "session_key",
        F.lit(ATTRIBUTION_MODEL).alias("attribution_model"),
        F.col("shopify_order_id").isNotNull().alias("is_attributed"),
        F.coalesce(F.col("source"), F.lit(UNATTRIBUTED)).alias("attributed_source"),
        F.coalesce(F.col("medium"), F.lit(UNATTRIBUTED)).alias("attributed_medium"),
        F.coalesce(F.col("campaign"), F.lit(UNATTRIBUTED)).alias("attributed_campaign"),
        "revenue_difference", "same_currency",
    )
