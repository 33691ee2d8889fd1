"""Analyses, dashboard metrics and tie-outs (D-1..D-11).

Dashboard rates are ratios of sums over the marts (never averages of
per-row rates). Money totals are summed exactly (decimal) and returned as
DOUBLE; tie-out differences are taken in decimal before conversion.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.functions.events import event_param
from tallyspark.functions.money import money_sum, ratio
from tallyspark.plans.staging import scan_shards

# A tie-out holds when the absolute difference is below half a cent.
TIE_TOLERANCE = 0.005


def orders_daily_profile(fct_orders: DataFrame) -> DataFrame:
    """D-1: orders by created date and currency, newest first."""
    d = fct_orders.groupBy("order_created_date", "currency").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        money_sum("subtotal_price").cast("double").alias("subtotal_price"),
        money_sum("total_discounts").cast("double").alias("total_discounts"),
        money_sum("total_tax").cast("double").alias("total_tax"),
        money_sum("total_price").cast("double").alias("total_price"))
    return d.select("*", ratio("total_price", "orders").alias("average_order_value")).orderBy(
        F.col("order_created_date").desc(), F.col("currency"))


def ga_event_profile(events: DataFrame, params) -> DataFrame:
    """D-2: raw event extraction (no dedup, transaction id untrimmed)."""
    ev = scan_shards(events, params)
    return ev.select(
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_timestamp"),
        "event_name", "user_pseudo_id",
        event_param("ga_session_id", "int").alias("ga_session_id"),
        event_param("page_location", "string").alias("page_location"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
        F.col("_table_suffix").alias("source_table_suffix"))


def dash_executive(channel_revenue: DataFrame) -> DataFrame:
    """D-3: executive scorecard, one row."""
    t = channel_revenue.agg(
        money_sum("total_revenue").cast("double").alias("total_revenue"),
        F.sum("orders").alias("orders"),
        money_sum("attributed_revenue").cast("double").alias("attributed_revenue"),
        money_sum("unattributed_revenue").cast("double").alias("unattributed_revenue"),
        F.sum("attributed_orders").alias("attributed_orders"))
    return t.select("total_revenue", "orders",
                    ratio("total_revenue", "orders").alias("average_order_value"),
                    "attributed_revenue", "unattributed_revenue", "attributed_orders",
                    ratio("attributed_revenue", "total_revenue").alias("revenue_attribution_coverage_rate"))


def _channel(df: DataFrame):
    return F.concat_ws(" / ", F.col("attributed_source"), F.col("attributed_medium"))


def dash_top_channels(channel_revenue: DataFrame, k: int) -> DataFrame:
    """L3: top-k channels (source / medium) by revenue; ties by name. The
    limit is the feature (a top-k report); it runs as TakeOrderedAndProject."""
    c = channel_revenue.groupBy(_channel(channel_revenue).alias("channel")).agg(
        money_sum("total_revenue").cast("double").alias("total_revenue"),
        F.sum("orders").alias("orders"))
    return c.orderBy(F.col("total_revenue").desc(), F.col("channel")).limit(k)


def dash_funnel(funnel: DataFrame) -> DataFrame:
    """D-4: funnel page by source / medium / campaign."""
    steps = ["sessions", "page_view_sessions", "view_item_sessions", "add_to_cart_sessions",
             "checkout_sessions", "ga4_purchase_sessions", "matched_purchase_sessions", "matched_orders"]
    g = funnel.groupBy("source", "medium", "campaign").agg(
        *[F.sum(c).alias(c) for c in steps],
        money_sum("shopify_revenue").cast("double").alias("shopify_revenue"))
    return g.select(
        "*",
        ratio("view_item_sessions", "sessions").alias("session_to_view_item_rate"),
        ratio("add_to_cart_sessions", "view_item_sessions").alias("view_item_to_cart_rate"),
        ratio("checkout_sessions", "add_to_cart_sessions").alias("cart_to_checkout_rate"),
        ratio("matched_purchase_sessions", "checkout_sessions").alias("checkout_to_purchase_rate"),
        ratio("matched_purchase_sessions", "sessions").alias("session_to_purchase_rate"),
        ratio("shopify_revenue", "sessions").alias("revenue_per_session"))


def dash_channel(channel_revenue: DataFrame) -> DataFrame:
    """D-5: channel page by attributed source / medium / campaign."""
    g = channel_revenue.groupBy("attributed_source", "attributed_medium", "attributed_campaign").agg(
        money_sum("total_revenue").cast("double").alias("total_revenue"),
        money_sum("attributed_revenue").cast("double").alias("attributed_revenue"),
        money_sum("unattributed_revenue").cast("double").alias("unattributed_revenue"),
        F.sum("orders").alias("orders"),
        F.sum("attributed_orders").alias("attributed_orders"),
        F.sum("unattributed_orders").alias("unattributed_orders"))
    return g.select(
        "*",
        ratio("attributed_revenue", "total_revenue").alias("revenue_attribution_coverage_rate"),
        ratio("attributed_orders", "orders").alias("order_attribution_coverage_rate"),
        ratio("total_revenue", "orders").alias("average_order_value"))


def dash_reconciliation(reconciliation: DataFrame) -> DataFrame:
    """D-6: reconciliation page, one row. Invalid ids = missing + not_set;
    currency mismatch = ``same_currency = false``."""
    st = F.col("match_status")
    matched = st == "matched"
    t = reconciliation.agg(
        F.count(F.lit(1)).alias("purchase_events"),
        F.count_if(matched).alias("matched_purchases"),
        F.count_if(st == "unmatched_transaction_id").alias("unmatched_purchases"),
        F.count_if(st == "missing_transaction_id").alias("missing_transaction_ids"),
        F.count_if(st == "not_set_transaction_id").alias("not_set_transaction_ids"),
        F.count_if(st.isin("missing_transaction_id", "not_set_transaction_id")).alias("invalid_transaction_ids"),
        F.count_if(F.col("same_currency") == F.lit(False)).alias("currency_mismatches"),
        F.count_if(matched & (F.abs(F.coalesce("revenue_difference", F.lit(0.0))) > 1))
         .alias("large_revenue_differences"),
        money_sum(F.when(matched, F.col("ga4_purchase_revenue"))).cast("double").alias("matched_event_revenue"),
        money_sum(F.when(matched, F.col("shopify_total_price"))).cast("double").alias("matched_order_revenue"))
    return t.select("*", ratio("matched_purchases", "purchase_events").alias("match_rate"))


def _tie(a: str, b: str):
    diff = (F.col(a).cast("decimal(38,2)") - F.col(b).cast("decimal(38,2)"))
    return diff.cast("double").alias("difference"), (F.abs(diff) < TIE_TOLERANCE).alias("tied")


def written_totals(spark, root: str, models) -> dict[str, dict[str, Decimal | None]]:
    """The totals kept beside the written models of a full run (``build_all``)."""
    return {n: {k: Decimal(v) if v is not None else None for k, v in files.read_json(spark, f"{root}/{n}/_totals.json").items()} for n in models}


def _row(spark, schema: str, *values) -> DataFrame:
    return spark.createDataFrame([values], schema)


def _near(a: Decimal | None, b: Decimal | None) -> bool | None:
    return None if a is None or b is None else abs(a - b) < Decimal(str(TIE_TOLERANCE))


def _f(x: Decimal | None) -> float | None:
    return None if x is None else float(x)


def tieouts_of_run(spark, root: str) -> dict[str, DataFrame]:
    """D-7, D-8 and D-10 of a full run, from its written totals alone: nothing is read but
    one small file per model, and nothing is written."""
    t = written_totals(spark, root, ("stg_orders", "fct_orders", "fct_attributed_orders", "fct_channel_revenue"))
    channel, orders, attributed = t["fct_channel_revenue"], t["fct_orders"], t["fct_attributed_orders"]
    cents = Decimal("0.01")

    def less(a, b):
        return None if a is None or b is None else float(a.quantize(cents, ROUND_HALF_UP) - b.quantize(cents, ROUND_HALF_UP))
    a, b = channel["total_revenue"], orders["total_price"]
    parts = [channel["attributed_revenue"], channel["unattributed_revenue"]]
    split = None if None in parts else sum(parts)
    counts = [int(t[n]["rows"]) for n in ("stg_orders", "fct_orders", "fct_attributed_orders")]
    return {
        "tieout_revenue": _row(spark, "channel_revenue_total double, order_revenue_total double, difference double, tied boolean",
                               _f(a), _f(b), less(a, b), _near(a, b)),
        "tieout_attribution_split": _row(
            spark, "attributed_revenue double, unattributed_revenue double, total_revenue double, difference double, tied boolean",
            *map(_f, parts), _f(a), less(split, a), _near(split, a)),
        "tieout_layers": _row(
            spark, "stg_orders long, fct_orders long, attributed_orders long, fct_orders_revenue double, "
            "attributed_orders_revenue double, counts_tied boolean, revenue_tied boolean",
            *counts, _f(b), _f(attributed["total_price"]), len(set(counts)) == 1, _near(b, attributed["total_price"])),
    }


def tieout_revenue(channel_revenue: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """D-7: channel-revenue total equals the order fact's total price."""
    a = channel_revenue.agg(money_sum("total_revenue").alias("_a"))
    b = fct_orders.agg(money_sum("total_price").alias("_b"))
    # Two one-row totals side by side (union + max: no join needed).
    j = a.unionByName(b, allowMissingColumns=True).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    diff, tied = _tie("_a", "_b")
    return j.select(F.col("_a").cast("double").alias("channel_revenue_total"),
                    F.col("_b").cast("double").alias("order_revenue_total"), diff, tied)


def tieout_attribution_split(channel_revenue: DataFrame) -> DataFrame:
    """D-8: attributed + unattributed revenue equals total revenue."""
    t = channel_revenue.agg(money_sum("attributed_revenue").alias("_att"),
                            money_sum("unattributed_revenue").alias("_un"),
                            money_sum("total_revenue").alias("_tot"))
    t = t.select("*", (F.col("_att") + F.col("_un")).alias("_split"))
    diff, tied = _tie("_split", "_tot")
    return t.select(F.col("_att").cast("double").alias("attributed_revenue"),
                    F.col("_un").cast("double").alias("unattributed_revenue"),
                    F.col("_tot").cast("double").alias("total_revenue"), diff, tied)


def tieout_purchases(reconciliation: DataFrame) -> DataFrame:
    """D-9: matched + not matched equals all purchase events."""
    t = reconciliation.agg(F.count(F.lit(1)).alias("purchase_events"),
                           F.count_if(F.col("match_status") == "matched").alias("matched"),
                           F.count_if(F.col("match_status") != "matched").alias("not_matched"))
    d = F.col("matched") + F.col("not_matched") - F.col("purchase_events")
    return t.select("*", d.alias("difference"), (d == 0).alias("tied"))


def tieout_layers(stg_orders: DataFrame, fct_orders: DataFrame, attributed: DataFrame) -> DataFrame:
    """D-10: staged orders vs order fact (rows), order fact vs attributed
    orders (rows and revenue)."""
    s = stg_orders.agg(F.count(F.lit(1)).alias("stg_orders"))
    f = fct_orders.agg(F.count(F.lit(1)).alias("fct_orders"), money_sum("total_price").alias("_fr"))
    a = attributed.agg(F.count(F.lit(1)).alias("attributed_orders"), money_sum("total_price").alias("_ar"))
    t = (s.unionByName(f, allowMissingColumns=True).unionByName(a, allowMissingColumns=True)
         .agg(*[F.max(c).alias(c) for c in ["stg_orders", "fct_orders", "_fr", "attributed_orders", "_ar"]]))
    diff = F.col("_fr") - F.col("_ar")
    return t.select(
        "stg_orders", "fct_orders", "attributed_orders",
        F.col("_fr").cast("double").alias("fct_orders_revenue"),
        F.col("_ar").cast("double").alias("attributed_orders_revenue"),
        ((F.col("stg_orders") == F.col("fct_orders")) & (F.col("fct_orders") == F.col("attributed_orders")))
        .alias("counts_tied"),
        (F.abs(diff) < TIE_TOLERANCE).alias("revenue_tied"))


def attribution_coverage(attributed: DataFrame) -> DataFrame:
    """D-11: attribution coverage over the attributed-order mart."""
    att = F.col("is_attributed")
    t = attributed.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(att).alias("attributed_orders"),
        F.count_if(~att).alias("unattributed_orders"),
        money_sum(F.when(att, F.col("total_price"))).cast("double").alias("attributed_revenue"),
        money_sum(F.when(~att, F.col("total_price"))).cast("double").alias("unattributed_revenue"),
        money_sum("total_price").cast("double").alias("total_revenue"))
    return t.select("*", ratio("attributed_orders", "orders").alias("order_attribution_rate"),
                    ratio("attributed_revenue", "total_revenue").alias("revenue_attribution_rate"))

