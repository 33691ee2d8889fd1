"""Declared input schemas (survey §1.4). Everything is explicit; nothing is
inferred."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_ENTITIES = ("order", "product", "customer")


def raw_entity_schema(entity: str) -> T.StructType:
    return T.StructType([
        T.StructField("shop_domain", T.StringType()),
        T.StructField(f"{entity}_id", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("payload_json", T.StringType()),
        T.StructField("batch_no", T.LongType()),
    ])


STATE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), nullable=False),
    T.StructField("last_updated_at", T.TimestampType()),
])

EVENT_PARAM = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StructType([
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
    ])),
])

ECOMMERCE = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("purchase_revenue", T.DoubleType()),
])

ITEM_STRING_FIELDS = ("item_id", "item_name", "item_brand", "item_variant", "item_category",
                      "item_category2", "item_category3", "item_category4", "item_category5")
ITEM = T.StructType(
    [T.StructField(n, T.StringType()) for n in ITEM_STRING_FIELDS]
    + [T.StructField("price", T.DoubleType()),
       T.StructField("quantity", T.LongType()),
       T.StructField("item_revenue", T.DoubleType()),
       T.StructField("coupon", T.StringType()),
       T.StructField("affiliation", T.StringType())])

GA_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_name", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    T.StructField("ecommerce", ECOMMERCE),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("_table_suffix", T.StringType()),
])

# Event param keys read by the staging model, with the value field they use.
EVENT_PARAM_KINDS = {
    "ga_session_id": "int",
    "page_location": "string",
    "ga_session_number": "int",
    "page_title": "string",
    "source": "string",
    "medium": "string",
    "campaign": "string",
    "currency": "string",
}
