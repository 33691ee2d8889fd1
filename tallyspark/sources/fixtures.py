"""Raw shop tables and the analytics event export, derived from the testdata.

The reference reads JSON records landed from a shop API and a nested
web-analytics export. The testdata is a TPC-H-like star schema plus a flat
``events`` table, so these functions derive, with Spark, inputs of the
reference's shape (FIXTURES.md §2): every rule is a column expression, so
the work grows with the tables and runs distributed.

Fixed values (rules the SQL oracle repeats; change both together):
  * cents(x) = floor(x * 100 + 0.5) / 100
  * order versions: V1 all (ingested 2002-01-01), V2 when k%7=0 (updated +2
    days, status 'refunded', ingested 2002-01-02), V3 when k%13=0 (no
    updated_at, status 'stale', ingested 2002-01-04), V4 when k%17=0 (copy of
    V1, ingested 2002-01-03)
  * order statuses: F paid, O pending, P partially_refunded
  * product statuses by p%3: active, archived, draft; 'unknown' when p%50=0
  * event names: view -> page_view (even id) / view_item (odd id),
    click -> add_to_cart, signup -> begin_checkout, purchase -> purchase,
    error -> user_engagement
  * traffic sources by (e+u)%5: none, google, tagassistant, admin.shopify,
    referral
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.params import Params
from tallyspark.sources.schemas import ITEM

SHOP_DOMAIN = "shop-a"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
PRODUCT_EPOCH = "2001-01-01"
CUSTOMER_EPOCH = "2001-01-01"

ORDER_VERSION_INGESTED = {1: "2002-01-01", 2: "2002-01-02", 3: "2002-01-04", 4: "2002-01-03"}
ORDER_STATUS = {"F": "paid", "O": "pending", "P": "partially_refunded"}
PRODUCT_STATUS = ["active", "archived", "draft"]
EVENT_NAME = {"click": "add_to_cart", "signup": "begin_checkout",
              "purchase": "purchase", "error": "user_engagement"}
TRAFFIC_SOURCES = [None, "google", "tagassistant", "admin.shopify", "referral"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cents(x: Column) -> Column:
    return F.floor(x * 100 + F.lit(0.5)) / 100


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS)


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# --------------------------------------------------------------------------
# Orders and line items
# --------------------------------------------------------------------------

# The order of an order's lines: by number, then by all else that is read, so that ties are equal lines.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
              "l_discount", "p_name")


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: ``line_items``, the JSON array (text) of its lines.

    One shuffle and one sort, of narrow lines by order: the windows stream over
    it, and its order serves the join with the orders too. (Grouped with
    ``groupBy``, the lines are sorted before the shuffle and after it, and the
    arrays once more for the join.) A line is written as JSON between the
    windows, where it is a row: once, in generated code. The title needs the
    part name: a join the planner may broadcast when the part table is small,
    else shuffle.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        "l_quantity", "l_extendedprice", "l_discount")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = li.join(part, li.l_partkey == part.p_partkey, "left")
    by_order = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    whole = by_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    documents = (li.where(F.col("l_orderkey").isNotNull())
                 .select("l_orderkey", *LINE_ORDER, F.row_number().over(by_order).alias("_n"))
                 .withColumn("_document", _line_document()))
    return (documents.select("l_orderkey", "_n", F.collect_list("_document").over(whole).alias("_documents"))
            .where(F.col("_n") == 1)
            .select("l_orderkey", F.concat(F.lit("["), F.array_join("_documents", ","), F.lit("]")).alias("line_items")))


def _line_document() -> Column:
    """The JSON object (text) of a line, the ``_n``-th of its order."""
    item_id = F.col("l_orderkey") * 1000 + F.col("_n")
    pk = F.col("l_partkey")
    title = F.when(pk % 10 == 0, F.concat(F.lit("[SALE] "), F.col("p_name"))).otherwise(F.col("p_name"))
    qty = (F.when(item_id % 97 == 0, F.lit("0"))
           .when(item_id % 89 == 0, F.lit("2.0"))
           .otherwise(F.col("l_quantity").cast("bigint").cast("string")))
    return F.to_json(F.struct(
        item_id.alias("id"),
        F.when(item_id % 41 != 0, pk).alias("product_id"),
        (pk * 10 + 1).alias("variant_id"),
        title.alias("title"),
        # An object for some lines, else text: two fields of the name, of which one is NULL and not written.
        F.when((item_id % 53 == 0) & pk.isNotNull(), F.struct(pk.alias("code"))).alias("sku"),
        F.when(item_id % 53 != 0, F.concat(F.lit("SKU-"), pk.cast("string"))).alias("sku"),
        qty.alias("quantity"),
        cents(F.col("l_extendedprice") / F.col("l_quantity")).cast("string").alias("price"),
        cents(F.col("l_extendedprice") * F.col("l_discount")).cast("string").alias("total_discount"),
    ))


def raw_orders(spark: SparkSession, sf_dir: str, params: Params | None = None) -> DataFrame:
    """The raw orders table: one row per (order, landed version)."""
    shop = (params or Params()).shop_domain
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    o = o.join(_line_items(spark, sf_dir), o.o_orderkey == F.col("l_orderkey"), "left")
    k = F.col("o_orderkey")
    od = F.col("o_orderdate").cast("timestamp")
    total = F.col("o_totalprice")
    shown_total = total + F.when(k % 41 == 0, 0.004).otherwise(0.0)  # amounts below a cent

    versions = F.filter(F.array(*[F.lit(v) for v in (1, 2, 3, 4)]),
                        lambda v: (v == 1) | ((v == 2) & (k % 7 == 0))
                        | ((v == 3) & (k % 13 == 0)) | ((v == 4) & (k % 17 == 0)))
    o = o.withColumn("v", F.explode(versions))
    v = F.col("v")

    status = F.col("o_orderstatus")
    fin = F.when(v == 2, "refunded").when(v == 3, "stale")
    for code, name in ORDER_STATUS.items():
        fin = fin.when(status == code, name)
    payload_updated = (F.when((v == 3) | (k % 31 == 0), F.lit(None))
                       .when(v == 2, iso(od + F.expr("INTERVAL 3 DAYS")))
                       .otherwise(iso(od + F.expr("INTERVAL 1 DAY"))))
    raw_updated = F.when(v == 2, od + F.expr("INTERVAL 3 DAYS")).otherwise(od + F.expr("INTERVAL 1 DAY"))
    ingested = F.lit(None).cast("timestamp")
    for ver, day in ORDER_VERSION_INGESTED.items():
        ingested = F.when(v == ver, _ts(day)).otherwise(ingested)

    payload = F.struct(
        k.alias("id"),
        F.concat(F.lit("#"), (k + 1000).cast("string")).alias("name"),
        (k + 1000).cast("string").alias("order_number"),
        F.when(k % 19 == 0, F.lit(None)).when(k % 23 == 0, F.lit("abc"))
         .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        iso(od).alias("created_at"),
        iso(od).alias("processed_at"),
        payload_updated.alias("updated_at"),
        F.when(k % 29 == 0, iso(od + F.expr("INTERVAL 3 DAYS"))).alias("cancelled_at"),
        fin.alias("financial_status"),
        F.when(k % 2 == 0, F.lit("fulfilled")).alias("fulfillment_status"),
        F.when(k % 11 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("currency"),
        F.when(k % 37 == 0, F.lit("n/a")).otherwise(cents(total * 0.9).cast("string")).alias("subtotal_price"),
        cents(total * 0.08).cast("string").alias("total_tax"),
        F.when(k % 3 == 0, F.lit("5.00")).otherwise(F.lit("0.00")).alias("total_discounts"),
        shown_total.cast("string").alias("total_price"),
    )
    # The lines are JSON already, the same for all versions: the payload's last field. (It is never
    # the first: an order always has a currency.)
    items = F.coalesce(F.col("line_items"), F.when(k % 2 == 0, F.lit("[]")))
    o = o.withColumn("_payload", F.to_json(payload))
    head = F.col("_payload").substr(F.lit(1), F.length("_payload") - 1)
    return o.select(
        F.lit(shop).alias("shop_domain"),
        k.alias("order_id"),
        raw_updated.alias("updated_at"),
        ingested.alias("ingested_at"),
        F.when(items.isNull(), F.col("_payload"))
         .otherwise(F.concat(head, F.lit(',"line_items":'), items, F.lit("}"))).alias("payload_json"),
        v.cast("bigint").alias("batch_no"),
    )


# --------------------------------------------------------------------------
# Products and customers
# --------------------------------------------------------------------------

def raw_products(spark: SparkSession, sf_dir: str, params: Params | None = None) -> DataFrame:
    shop = (params or Params()).shop_domain
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    pk = F.col("p_partkey")
    p = p.withColumn("v", F.explode(F.filter(F.array(F.lit(1), F.lit(2)),
                                             lambda v: (v == 1) | (pk % 7 == 0))))
    v = F.col("v")
    created = F.date_add(F.lit(PRODUCT_EPOCH).cast("date"), (pk % 365).cast("int")).cast("timestamp")
    updated = F.when(v == 2, created + F.expr("INTERVAL 30 DAYS")).otherwise(created + F.expr("INTERVAL 1 DAY"))
    status = F.when(pk % 50 == 0, F.lit("unknown"))
    for i, name in enumerate(PRODUCT_STATUS):
        status = status.when(pk % 3 == i, name)
    n_variants = (pk % 3).cast("int")
    variants = F.when(n_variants > 0, F.transform(F.sequence(F.lit(1), n_variants), lambda pos: F.struct(
        (pk * 10 + pos).alias("id"),
        F.concat(F.lit("Variant "), pos.cast("string")).alias("title"),
        F.concat(F.lit("SKU-"), pk.cast("string"), F.lit("-"), pos.cast("string")).alias("sku"),
        (F.col("p_retailprice") + pos).cast("string").alias("price"),
        pos.alias("position"),
    ))).otherwise(F.array().cast("array<struct<id:bigint,title:string,sku:string,price:string,position:int>>"))
    payload = F.struct(
        pk.alias("id"),
        iso(created).alias("created_at"),
        iso(updated).alias("updated_at"),
        F.when(v == 2, F.concat(F.col("p_name"), F.lit(" (v2)"))).otherwise(F.col("p_name")).alias("title"),
        F.col("p_brand").alias("vendor"),
        F.col("p_type").alias("product_type"),
        status.alias("status"),
        variants.alias("variants"),
    )
    return p.select(
        F.lit(shop).alias("shop_domain"), pk.alias("product_id"), updated.alias("updated_at"),
        F.when(v == 2, _ts("2002-01-02")).otherwise(_ts("2002-01-01")).alias("ingested_at"),
        F.to_json(payload).alias("payload_json"), v.cast("bigint").alias("batch_no"))


def raw_customers(spark: SparkSession, sf_dir: str, params: Params | None = None) -> DataFrame:
    shop = (params or Params()).shop_domain
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    ck = F.col("c_custkey")
    c = c.withColumn("v", F.explode(F.filter(F.array(F.lit(1), F.lit(2)),
                                             lambda v: (v == 1) | (ck % 6 == 0))))
    v = F.col("v")
    created = F.date_add(F.lit(CUSTOMER_EPOCH).cast("date"), (ck % 365).cast("int")).cast("timestamp")
    created = F.when(v == 2, created - F.expr("INTERVAL 30 DAYS")).otherwise(created)
    payload = F.struct(ck.alias("id"), iso(created).alias("created_at"))
    return c.select(
        F.lit(shop).alias("shop_domain"), ck.alias("customer_id"), F.lit(None).cast("timestamp").alias("updated_at"),
        F.when(v == 2, _ts("2002-01-02")).otherwise(_ts("2002-01-01")).alias("ingested_at"),
        F.to_json(payload).alias("payload_json"), v.cast("bigint").alias("batch_no"))


# --------------------------------------------------------------------------
# Analytics events
# --------------------------------------------------------------------------

def _param(key: str, string_value: Column | None = None, int_value: Column | None = None) -> Column:
    return F.struct(F.lit(key).alias("key"), F.struct(
        (string_value if string_value is not None else F.lit(None).cast("string")).alias("string_value"),
        (int_value if int_value is not None else F.lit(None).cast("bigint")).alias("int_value"),
    ).alias("value"))


# Fixed value: the folder of rows without a partition value, read back as NULL.
NO_SUFFIX = "__HIVE_DEFAULT_PARTITION__"


def ga_events(spark: SparkSession, sf_dir: str, suffix_floor: str | None = None, by_suffix: bool = False) -> DataFrame:
    """The nested event export (``events_*`` shards as one relation with a
    ``_table_suffix`` column).

    ``suffix_floor`` (optional) is applied as ``ts >= floor`` on the source
    scan, so it reaches the parquet reader as a pushed filter -- the analogue
    of shard pruning for a table that is not laid out by day. The staging
    model still applies the string-compare predicate itself.

    ``by_suffix`` is for a write partitioned by ``_table_suffix``: the rows of a
    task come ordered by it, sorted while they are narrow. The write, which
    needs that order, else sorts the nested events, 30 times as wide. A missing
    suffix is then the name of its folder (the write looks for the order of a
    column that can't be NULL).
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    if suffix_floor and len(suffix_floor) == 8 and suffix_floor.isdigit():
        floor_ts = F.to_timestamp_ntz(F.lit(suffix_floor), F.lit("yyyyMMdd"))
        ev = ev.where(F.col("ts") >= floor_ts)
    e, u, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    is_purchase = et == "purchase"

    # Order totals for purchase revenue. A purchase names one hot order for
    # every twentieth event id, else one order for each four ids: several
    # purchases per order, and orders that grow with the events. Other events
    # get keys of their own that match nothing, so they don't meet in one task.
    totals = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    txn_key = F.when(e % 20 == 19, F.lit(7).cast("bigint")).otherwise(F.floor(e / 4).cast("bigint"))
    ev = ev.withColumn("txn_order_key", F.when(is_purchase & (e % 10 >= 5), txn_key).otherwise(-1 - e))
    ev = ev.join(totals, F.col("txn_order_key") == F.col("o_orderkey"), "left")

    name = F.when(et == "view", F.when(e % 2 == 0, F.lit("page_view")).otherwise(F.lit("view_item")))
    for src, dst in EVENT_NAME.items():
        name = name.when(et == src, dst)
    ts = F.col("ts")
    suffix = F.date_format(ts, "yyyyMMdd")
    ev = ev.withColumn("_table_suffix", F.coalesce(suffix, F.lit(NO_SUFFIX)) if by_suffix else suffix)
    if by_suffix:
        ev = ev.sortWithinPartitions("_table_suffix")
    session_id = F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + u
    src_bucket = (e + u) % 5
    source = F.lit(None).cast("string")
    for i, s in enumerate(TRAFFIC_SOURCES):
        if s is not None:
            source = F.when(src_bucket == i, F.lit(s)).otherwise(source)
    params = F.filter(F.array(
        F.when(e % 20 != 7, _param("ga_session_id", int_value=session_id)),
        _param("ga_session_number", int_value=(u % 5) + 1),
        _param("page_location", string_value=F.concat(F.lit("/p/"), (e % 50).cast("string"))),
        F.when(src_bucket != 0, _param("source", string_value=source)),
        F.when((e + u) % 2 == 0, _param("medium", string_value=F.lit("organic"))),
        F.when(e % 4 != 0, _param("campaign", string_value=F.concat(F.lit("camp"), (u % 3).cast("string")))),
        F.when(e % 9 != 0, _param("currency", string_value=F.when(e % 9 == 1, F.lit("EUR")).otherwise(F.lit("USD")))),
        _param("page_title", string_value=F.concat(F.lit("Page "), (e % 50).cast("string"))),
    ), lambda p: p.isNotNull())

    kind = e % 10
    txn = (F.when(kind == 0, F.lit(None).cast("string"))
           .when(kind == 1, F.lit("  "))
           .when(kind == 2, F.lit("Not_Set"))
           .when(kind == 3, F.lit("(not set)"))
           .when(kind == 4, (e + 900000000).cast("string"))
           .when(kind == 5, F.concat(F.lit(" "), txn_key.cast("string"), F.lit(" ")))
           .otherwise(txn_key.cast("string")))
    adj = (F.when(e % 7 == 0, F.lit(5.0)).when(e % 7 == 1, F.lit(0.5))
           .when(e % 7 == 2, F.lit(-25.0)).otherwise(F.lit(0.0)))
    revenue = (F.when(e % 7 == 6, F.lit(None).cast("double"))
               .when(F.col("o_totalprice").isNotNull(), F.col("o_totalprice") + adj)
               .otherwise(F.col("value")))
    ecommerce = F.when(is_purchase, F.struct(txn.alias("transaction_id"), revenue.alias("purchase_revenue")))

    n_items = (e % 5).cast("int")

    def item(i: Column) -> Column:
        code = e * 7 + i
        price = (code % 100).cast("double") + F.lit(0.5)
        none = F.lit(None).cast("string")
        return F.struct(
            F.when(i != 3, F.concat(F.lit("P"), code.cast("string"))).alias("item_id"),
            F.concat(F.lit("Item "), (code % 100).cast("string")).alias("item_name"),
            F.concat(F.lit("Brand "), (i % 3).cast("string")).alias("item_brand"),
            none.alias("item_variant"),
            F.concat(F.lit("cat"), ((e + i) % 4).cast("string")).alias("item_category"),
            none.alias("item_category2"), none.alias("item_category3"),
            none.alias("item_category4"), none.alias("item_category5"),
            price.alias("price"),
            (i + 1).cast("bigint").alias("quantity"),
            (price * (i + 1)).alias("item_revenue"),
            F.when(i == 1, F.lit("SAVE10")).alias("coupon"),
            F.lit(SHOP_DOMAIN).alias("affiliation"),
        )

    items = (F.when(n_items > 0, F.transform(F.sequence(F.lit(0), n_items - 1), item))
             .when(e % 10 != 0, F.array().cast(T.ArrayType(ITEM))))
    return ev.select(
        name.alias("event_name"),
        F.unix_micros(ts.cast("timestamp")).alias("event_timestamp"),
        suffix.alias("event_date"),
        F.concat(F.lit("u"), u.cast("string")).alias("user_pseudo_id"),
        params.alias("event_params"),
        ecommerce.alias("ecommerce"),
        items.alias("items"),
        "_table_suffix",
    )
