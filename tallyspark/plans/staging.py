"""Staging models (M1-M9): typed, deduplicated views of the raw inputs.

Each function takes DataFrames and returns a DataFrame whose columns are the
model's contract, in order.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.casts import safe_bigint, safe_double, safe_timestamp
from tallyspark.functions.events import event_param
from tallyspark.functions.json import (number_text, parse_fields, path_value, scalar_text,
                                       top_level_key)
from tallyspark.operators.dedup import dedup_latest
from tallyspark.params import Params
from tallyspark.sources.schemas import EVENT_PARAM_KINDS, ITEM_STRING_FIELDS

# Whitespace stripped by the warehouse TRIM.
WHITESPACE = " \t\n\r\u000b\u000c"

# The contract's column order.
ORDER_COLUMNS = [
    "shop_domain", "order_id", "order_name", "order_number", "customer_id", "created_at",
    "processed_at", "updated_at", "cancelled_at", "financial_status", "fulfillment_status",
    "currency", "subtotal_price", "total_tax", "total_discounts", "total_price", "ingested_at",
    "payload_json",
]


def _latest(df: DataFrame, keys, sort_ts) -> DataFrame:
    """Latest version per key: payload timestamp desc nulls last, then
    ``ingested_at`` desc, then a hash of the payload text (deterministic
    tiebreak for exact ties, D5). The text itself doesn't follow the hash: it
    would bring every payload into the exchange, to decide ties of versions
    whose times and 64-bit hashes are equal and whose texts differ."""
    return dedup_latest(df, keys, [sort_ts.desc_nulls_last(), F.col("ingested_at").desc_nulls_last(),
                                   F.xxhash64("payload_json").desc()])


# Fields of the payloads.
ORDER_FIELDS = ["name", "order_number", "customer_id", "created_at", "processed_at", "updated_at",
                "cancelled_at", "financial_status", "fulfillment_status", "currency", "subtotal_price",
                "total_tax", "total_discounts", "total_price"]


# Columns of M2 that can be read before the dedup: the line's field and its cast.
NARROW_LINE = {"order_item_id": ("id", safe_bigint), "product_id": ("product_id", safe_bigint),
               "variant_id": ("variant_id", safe_bigint), "quantity": ("quantity", safe_bigint),
               "unit_price": ("price", safe_double), "line_discount": ("total_discount", safe_double)}


def _narrow_lines(docs: Column, columns: Sequence[str], known: Collection[str] = ()) -> Column:
    """``columns`` of each line's text; of those in ``known`` only whether there is a value (true, else
    NULL). Two steps, so that a text is parsed once: a lambda shares no common expression."""
    parsed = F.transform(docs, lambda d: parse_fields(d, sorted({NARROW_LINE[c][0] for c in columns})))

    def value(p: Column, c: str) -> Column:
        v = NARROW_LINE[c][1](number_text(p, NARROW_LINE[c][0]))
        return F.when(v.isNotNull(), F.lit(True)) if c in known else v
    return F.transform(parsed, lambda p: F.struct(*[value(p, c).alias(c) for c in columns]))


def stg_orders_parsed(raw_orders: DataFrame, params: Params | None = None,
                      line_columns: Sequence[str] | None = None, known: Collection[str] = ()) -> DataFrame:
    """M1 plus ``_li`` (raw text of each line item, used by M2), or, given
    ``line_columns`` (of ``NARROW_LINE``), plus ``_lines``: those columns of each
    line, so that a reader of few of them sorts numbers and no text (of none: no ``_lines``). Of those in
    ``known`` a line has true for any value, for readers that ask no more.

    The payload is parsed once, and fields are extracted *before* the dedup
    shuffle: the parse is per row either way, and this lets column pruning
    keep the wide payload (with its line items) out of the exchange whenever
    the consumer does not need it (e.g. the order fact).
    """
    params = params or Params()
    cust_key = top_level_key(params.order_customer_path)
    scalars = ORDER_FIELDS if cust_key in (None, "customer_id") else ORDER_FIELDS + [cust_key]
    raw = raw_orders.select("shop_domain", "order_id", F.col("updated_at").alias("raw_updated_at"),
                            "ingested_at", "payload_json",
                            parse_fields("payload_json", scalars, ["line_items"]).alias("_p"))
    p, doc = F.col("_p"), F.col("payload_json")
    txt = lambda k: scalar_text(p, doc, k)
    num = lambda k: number_text(p, k)
    customer = num(cust_key) if cust_key else path_value(doc, params.order_customer_path)
    created = safe_timestamp(num("created_at"))
    payload_updated = safe_timestamp(num("updated_at"))
    typed = raw.select(
        "shop_domain",
        "order_id",
        txt("name").alias("order_name"),
        safe_bigint(num("order_number")).alias("order_number"),
        safe_bigint(customer).alias("customer_id"),
        created.alias("created_at"),
        safe_timestamp(num("processed_at")).alias("processed_at"),
        F.coalesce(payload_updated, F.col("raw_updated_at"), created).alias("updated_at"),
        safe_timestamp(num("cancelled_at")).alias("cancelled_at"),
        txt("financial_status").alias("financial_status"),
        txt("fulfillment_status").alias("fulfillment_status"),
        txt("currency").alias("currency"),
        safe_double(num("subtotal_price")).alias("subtotal_price"),
        safe_double(num("total_tax")).alias("total_tax"),
        safe_double(num("total_discounts")).alias("total_discounts"),
        safe_double(num("total_price")).alias("total_price"),
        "ingested_at",
        "payload_json",
        *([p["line_items"].alias("_li")] if line_columns is None
          else [_narrow_lines(p["line_items"], line_columns, known).alias("_lines")] if line_columns else []),
        payload_updated.alias("_sort_ts"),
    )
    return _latest(typed, ["shop_domain", "order_id"], F.col("_sort_ts")).drop("_sort_ts")


def stg_orders(raw_orders: DataFrame, params: Params | None = None) -> DataFrame:
    """M1: latest version per (shop_domain, order_id) with typed fields."""
    return stg_orders_parsed(raw_orders, params).select(*ORDER_COLUMNS)


# The contract's column order.
LINE_COLUMNS = [
    "shop_domain", "order_id", "order_created_at", "order_updated_at", "currency", "order_item_id",
    "product_id", "variant_id", "line_title", "sku", "quantity", "unit_price", "line_discount",
    "line_gross_sales",
]


# Fields of the payloads.
LINE_FIELDS = ["id", "product_id", "variant_id", "title", "sku", "quantity", "price", "total_discount"]


def order_lines_wide(orders_parsed: DataFrame) -> DataFrame:
    """Exploded ``$.line_items`` of M1, carrying the order's own columns.

    A line comes from exactly one M1 row, whose (shop_domain, order_id) is
    unique, so the fact table's join back to the order is replaced by carrying
    the columns along (same rows, no shuffle)."""
    o = orders_parsed.select(
        "shop_domain", "order_id", F.col("created_at").alias("order_created_at"),
        F.col("updated_at").alias("order_updated_at"), "currency", "customer_id",
        "financial_status", "fulfillment_status",
        F.explode("_li").alias("_doc"))
    o = o.withColumn("_p", parse_fields("_doc", LINE_FIELDS))
    p, doc = F.col("_p"), F.col("_doc")
    qty = safe_bigint(number_text(p, "quantity"))
    price = safe_double(number_text(p, "price"))
    return o.select(
        "shop_domain", "order_id", "order_created_at", "order_updated_at", "currency",
        safe_bigint(number_text(p, "id")).alias("order_item_id"),
        safe_bigint(number_text(p, "product_id")).alias("product_id"),
        safe_bigint(number_text(p, "variant_id")).alias("variant_id"),
        scalar_text(p, doc, "title").alias("line_title"),
        scalar_text(p, doc, "sku").alias("sku"),
        qty.alias("quantity"),
        price.alias("unit_price"),
        safe_double(number_text(p, "total_discount")).alias("line_discount"),
        (qty * price).alias("line_gross_sales"),
        "customer_id", "financial_status", "fulfillment_status",
    )


def stg_order_line_items(raw_orders: DataFrame, params: Params | None = None) -> DataFrame:
    """M2: one row per element of the order's ``$.line_items``."""
    return order_lines_wide(stg_orders_parsed(raw_orders, params)).select(*LINE_COLUMNS)


def narrow_columns(columns: Sequence[str]) -> list[str] | None:
    """The ``line_columns`` from which ``columns`` of M2 can be had; ``None`` where it takes the text."""
    own = [c for c in columns if c not in ("shop_domain", "order_id")]
    if not set(own) <= set(NARROW_LINE):
        return None
    return own or ["order_item_id"][:len(columns)]  # one, to have the rows


def narrow_order_lines(orders_parsed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of M2 from ``stg_orders_parsed`` with ``_lines`` that hold those of a line."""
    lines = orders_parsed.select("shop_domain", "order_id", F.explode("_lines").alias("_line"))
    return lines.select(*[F.col(f"_line.{c}").alias(c) if c in NARROW_LINE else F.col(c) for c in columns])


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    """M3: latest customer by payload ``created_at`` (not updated_at), then
    ingest time. No personal fields are carried."""
    raw = raw_customers.select("shop_domain", "payload_json", "ingested_at",
                               parse_fields("payload_json", ["id", "created_at"]).alias("_p"))
    typed = raw.select("shop_domain", safe_bigint(F.col("_p.id")).alias("customer_id"),
                       safe_timestamp(F.col("_p.created_at")).alias("created_at"),
                       "ingested_at", "payload_json")
    latest = _latest(typed, ["shop_domain", "customer_id"], F.col("created_at"))
    return latest.select("shop_domain", "customer_id", "created_at", "ingested_at")


# Fields of the payloads.
PRODUCT_FIELDS = ["id", "created_at", "updated_at", "title", "vendor", "product_type", "status"]
VARIANT_FIELDS = ["id", "title", "sku", "price", "position"]


def stg_products_parsed(raw_products: DataFrame) -> DataFrame:
    """M4 plus ``_variants`` (raw text of each variant, used by M5)."""
    raw = raw_products.select("shop_domain", "payload_json", "ingested_at",
                              parse_fields("payload_json", PRODUCT_FIELDS, ["variants"]).alias("_p"))
    p, doc = F.col("_p"), F.col("payload_json")
    typed = raw.select(
        "shop_domain", safe_bigint(number_text(p, "id")).alias("product_id"),
        safe_timestamp(number_text(p, "created_at")).alias("created_at"),
        safe_timestamp(number_text(p, "updated_at")).alias("updated_at"),
        scalar_text(p, doc, "title").alias("product_title"),
        scalar_text(p, doc, "vendor").alias("vendor"),
        scalar_text(p, doc, "product_type").alias("product_type"),
        scalar_text(p, doc, "status").alias("status"),
        "payload_json", "ingested_at", p["variants"].alias("_variants"))
    return _latest(typed, ["shop_domain", "product_id"], F.col("updated_at"))


# The contract's column order.
PRODUCT_COLUMNS = ["shop_domain", "product_id", "created_at", "updated_at", "product_title", "vendor",
                   "product_type", "status", "payload_json", "ingested_at"]


def stg_products(raw_products: DataFrame) -> DataFrame:
    """M4: latest product version per (shop_domain, payload id)."""
    return stg_products_parsed(raw_products).select(*PRODUCT_COLUMNS)


def product_variants(products_parsed: DataFrame) -> DataFrame:
    """M5: one row per element of the latest product's ``$.variants``."""
    v = products_parsed.select(
        "shop_domain", "product_id", "ingested_at", F.explode("_variants").alias("_doc"))
    v = v.withColumn("_p", parse_fields("_doc", VARIANT_FIELDS))
    p, doc = F.col("_p"), F.col("_doc")
    return v.select(
        "shop_domain", "product_id",
        safe_bigint(number_text(p, "id")).alias("variant_id"),
        scalar_text(p, doc, "title").alias("variant_title"),
        scalar_text(p, doc, "sku").alias("sku"),
        safe_double(number_text(p, "price")).alias("price"),
        safe_bigint(number_text(p, "position")).alias("position"), "ingested_at")


def stg_product_variants(raw_products: DataFrame) -> DataFrame:
    return product_variants(stg_products_parsed(raw_products))


# --------------------------------------------------------------------------
# Analytics events
# --------------------------------------------------------------------------

def scan_shards(events: DataFrame, params: Params | None = None) -> DataFrame:
    """Shard scan with the suffix floor (a string compare, as in the
    reference: ``'intraday_20260401' >= '20260401'``). On a table partitioned
    by ``_table_suffix`` this is a partition filter."""
    params = params or Params()
    out = events.where(F.col("_table_suffix") >= F.lit(params.event_suffix_floor))
    if params.daily_shards_only:
        out = out.where(F.col("_table_suffix").rlike("^[0-9]{8}$"))
    return out


def stg_ga_events(events: DataFrame, params: Params | None = None) -> DataFrame:
    """M6: one row per event with the parameters pulled out of the repeated
    key/value record (higher-order lookup, no join)."""
    ev = scan_shards(events, params)
    p = {k: event_param(k, kind).alias(k) for k, kind in EVENT_PARAM_KINDS.items()}
    return ev.select(
        F.concat(F.col("user_pseudo_id"), F.lit("-"), F.col("event_timestamp").cast("string"),
                 F.lit("-"), F.col("event_name")).alias("event_key"),
        F.to_date(F.col("event_date"), "yyyyMMdd").alias("event_date"),
        F.timestamp_micros(F.col("event_timestamp")).alias("event_timestamp"),
        "event_name", "user_pseudo_id",
        p["ga_session_id"], p["page_location"], p["ga_session_number"], p["page_title"],
        p["source"], p["medium"], p["campaign"], p["currency"],
        F.nullif(F.trim(F.col("ecommerce.transaction_id"), F.lit(WHITESPACE)), F.lit("")).alias("transaction_id"),
        F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
        "items",
        F.col("_table_suffix").alias("source_table_suffix"),
    )


def _session_key(user: str = "user_pseudo_id", sid: str = "ga_session_id"):
    return F.concat(F.col(user), F.lit("-"), F.col(sid).cast("string"))


# Event names of the funnel.
FUNNEL_STEPS = ["page_view", "view_item", "add_to_cart", "begin_checkout", "purchase"]


def stg_ga_sessions(stg_events: DataFrame) -> DataFrame:
    """M7: one row per (session_key, user, session id).

    ``any_value`` is made deterministic (D4): per column, the earliest
    non-NULL value by (event_timestamp, event_key). Partial aggregation
    collapses a hot session map-side.
    """
    ev = stg_events.where(F.col("ga_session_id").isNotNull())
    order = F.struct("event_timestamp", "event_key")

    def earliest(c: str):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)

    return ev.groupBy(_session_key().alias("session_key"), "user_pseudo_id", "ga_session_id").agg(
        F.min("event_timestamp").alias("session_start_at"),
        F.max("event_timestamp").alias("session_end_at"),
        F.count(F.lit(1)).alias("event_count"),
        *[F.count_if(F.col("event_name") == s).alias(f"{s}_count") for s in FUNNEL_STEPS],
        earliest("source"), earliest("medium"), earliest("campaign"),
    )


# The contract's column order.
PURCHASE_COLUMNS = ["event_key", "event_date", "event_timestamp", "user_pseudo_id", "session_key",
                    "ga_session_id", "transaction_id", "purchase_revenue", "currency", "source",
                    "medium", "campaign"]


def stg_ga_purchases(stg_events: DataFrame) -> DataFrame:
    """M8: purchase events; NULL session_key when the session id is missing."""
    return stg_events.where(F.col("event_name") == "purchase").select(
        "event_key", "event_date", "event_timestamp", "user_pseudo_id",
        _session_key().alias("session_key"), "ga_session_id", "transaction_id",
        "purchase_revenue", "currency", "source", "medium", "campaign")


def stg_ga_items(stg_events: DataFrame) -> DataFrame:
    """M9: one row per item of events with a non-empty ``items`` array,
    1-based ``item_index``."""
    ev = stg_events.where(F.array_size("items") > 0).select(
        "event_key", "event_date", "event_timestamp", "event_name", "user_pseudo_id",
        _session_key().alias("session_key"), "ga_session_id", "transaction_id", "currency",
        F.posexplode("items").alias("_pos", "_item"))
    return ev.select(
        "event_key", "event_date", "event_timestamp", "event_name", "user_pseudo_id",
        "session_key", "ga_session_id", "transaction_id", "currency",
        (F.col("_pos") + 1).cast("bigint").alias("item_index"),
        *[F.col(f"_item.{f}").alias(f) for f in ITEM_STRING_FIELDS],
        *[F.col(f"_item.{f}").alias(f) for f in ("price", "quantity", "item_revenue", "coupon", "affiliation")],
    )
