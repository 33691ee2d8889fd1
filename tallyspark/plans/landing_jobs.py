"""Landing and incremental-fact jobs over testdata-derived records.

Each function lands or merges real data (the order/product/customer records
derived from the testdata tables) into fresh locations under the shared
folder and returns the resulting table as a DataFrame.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.plans import staging
from tallyspark.plans.incremental import run_fct_order_lines, run_fct_orders
from tallyspark.session import fresh_path
from tallyspark.sources import landing
from tallyspark.sources.shards import read_shards
from tallyspark.streaming.landing_stream import land_stream

# Checkpoints the check scenarios start from (parameters of the scenario).
ORDER_CHECKPOINT = _dt.datetime(1998, 1, 1)
PRODUCT_CHECKPOINT = _dt.datetime(2001, 6, 1)
CUSTOMER_CHECKPOINT = _dt.datetime(2001, 3, 1)
RUN_INGESTED_AT = _dt.datetime(2024, 2, 1)


def api_snapshot(raw: DataFrame, version: int = 1) -> DataFrame:
    """The API's answer for one entity at one time, as a ``payload_json``
    column: the records of that landed version (the first has every record, a
    later one those that changed)."""
    return raw.where(F.col("batch_no") == version).select("payload_json")


def _pages_dir(m, entity: str) -> str:
    raw = {"order": lambda: m.inputs.raw_orders, "product": lambda: m.inputs.raw_products,
           "customer": lambda: m.inputs.raw_customers}[entity]
    return m.inputs.pages_path(entity, lambda: api_snapshot(raw()))


def landed_pages(m, entity: str = "order") -> DataFrame:
    """The entity's API snapshot as landed page files (written once per
    inputs), read as text lines."""
    return landing.read_pages(m.spark, _pages_dir(m, entity))


def unwrap_orders(m) -> DataFrame:
    """Records unwrapped from landed order pages."""
    recs = landing.unwrap_pages(landed_pages(m))
    return recs.select(
        F.get_json_object("payload_json", "$.id").cast("bigint").alias("order_id"),
        F.get_json_object("payload_json", "$.updated_at").try_cast("timestamp").alias("updated_at"),
        F.get_json_object("payload_json", "$.financial_status").alias("financial_status"))


def shaped_rows(m) -> DataFrame:
    """Raw rows shaped from the landed records (wall-clock ingest time
    left out of the published form)."""
    rows = landing.raw_rows(landing.unwrap_pages(landed_pages(m)), "order", m.params.shop_domain, 1)
    return rows.select("shop_domain", "order_id", "updated_at", "batch_no")


def _order_rows(m) -> DataFrame:
    return landing.raw_rows(landing.unwrap_pages(landed_pages(m)), "order", m.params.shop_domain, 1,
                            RUN_INGESTED_AT)


def filtered_rows(m) -> DataFrame:
    """S4 with a stored checkpoint for ``order``."""
    state = landing.state_of(m.spark, [("order", ORDER_CHECKPOINT)])
    return landing.incremental_filter(_order_rows(m), state, "order").select("order_id", "updated_at")


def batch_watermark(m) -> DataFrame:
    """S6 over the kept rows."""
    state = landing.state_of(m.spark, [("order", ORDER_CHECKPOINT)])
    return landing.high_watermark(landing.incremental_filter(_order_rows(m), state, "order"), "order")


def state_after_landing(m) -> DataFrame:
    """Land orders, products and customers against stored
    checkpoints; return the checkpoint table afterwards."""
    root = fresh_path(m.spark, "landing")
    state_path = f"{root}/landing_state"
    landing.commit_state(landing.state_of(m.spark, [
        ("order", ORDER_CHECKPOINT), ("product", PRODUCT_CHECKPOINT),
        ("customer", CUSTOMER_CHECKPOINT)]), state_path)
    entities = {e: landing.unwrap_pages(landed_pages(m, e)) for e in ("order", "product", "customer")}
    landing.land_entities(m.spark, entities, root, m.params.shop_domain, 1, RUN_INGESTED_AT)
    return landing.read_state(m.spark, state_path)


def append_twice(m) -> DataFrame:
    """The same pages landed twice. The second run keeps only records
    without ``updated_at`` (they always pass the checkpoint, D17)."""
    root = fresh_path(m.spark, "landing-rerun")
    pages = landed_pages(m)
    for batch_no in (1, 2):
        landing.land_batch(m.spark, landing.unwrap_pages(pages), "order", f"{root}/raw_orders",
                           f"{root}/landing_state", m.params.shop_domain, batch_no, RUN_INGESTED_AT)
    return landing.read_raw(m.spark, "order", f"{root}/raw_orders").select("order_id", "updated_at", "batch_no")


def second_snapshot(m) -> DataFrame:
    """S3-S8 over two snapshots: every record, then the changed ones. The
    second run lands what was updated after the first run's watermark (and
    records without ``updated_at``, D17)."""
    root = fresh_path(m.spark, "landing-second")
    changed = fresh_path(m.spark, "pages-second")
    landing.write_pages(api_snapshot(m.inputs.raw_orders, 2), "order", changed)
    for batch_no, pages in ((1, landed_pages(m)), (2, landing.read_pages(m.spark, changed))):
        landing.land_batch(m.spark, landing.unwrap_pages(pages), "order", f"{root}/raw_orders",
                           f"{root}/landing_state", m.params.shop_domain, batch_no, RUN_INGESTED_AT)
    files.delete(m.spark, changed)  # landed: the result reads the raw table
    return landing.read_raw(m.spark, "order", f"{root}/raw_orders").select("order_id", "updated_at", "batch_no")


def stream_in_batches(m) -> DataFrame:
    """The streaming landing in six micro-batches (up to eleven, where the files
    don't divide by six): the same rows as in one batch, and one checkpoint at
    the end. Page files are bounded, so a micro-batch of a large snapshot has
    many; a snapshot of fewer than six files is dealt over six first."""
    root = fresh_path(m.spark, "landing-batches")
    pages = _pages_dir(m, "order")
    n_files = sum(n.startswith("part-") for n in files.names(m.spark, pages))
    if n_files < 6:
        landing.read_pages(m.spark, pages).repartition(6).write.text(f"{root}/pages")
        pages, n_files = f"{root}/pages", 6
    land_stream(m.spark, pages, "order", f"{root}/raw_orders", f"{root}/landing_state",
                f"{root}/_checkpoint", m.params.shop_domain, max_files_per_trigger=n_files // 6)
    rows = landing.read_raw(m.spark, "order", f"{root}/raw_orders").select("order_id", "updated_at")
    state = landing.read_state(m.spark, f"{root}/landing_state").select("last_updated_at")
    # One row by construction: the run's one commit.
    return rows.withColumn("last_updated_at", state.scalar())


def stream_twice(m) -> DataFrame:
    """Streaming landing run twice over the same page files: the second run
    finds no new file and lands nothing."""
    root = fresh_path(m.spark, "landing-stream")
    pages_dir = _pages_dir(m, "order")
    for _ in range(2):
        land_stream(m.spark, pages_dir, "order", f"{root}/raw_orders", f"{root}/landing_state",
                    f"{root}/_checkpoint", m.params.shop_domain)
    return landing.read_raw(m.spark, "order", f"{root}/raw_orders").select("order_id", "updated_at")


def stream_new_checkpoint(m) -> DataFrame:
    """The first snapshot streamed; then all later versions arrive and the
    stream's checkpoint is replaced by a new one at the same path. The new
    stream reads every page again, adds what is newer than the source's
    checkpoint (and records without ``updated_at``, D17), and takes nothing away."""
    root = fresh_path(m.spark, "landing-new-checkpoint")
    pages, checkpoint = f"{root}/pages", f"{root}/_checkpoint"
    landing.write_pages(api_snapshot(m.inputs.raw_orders), "order", pages)
    for version in (1, 2):
        land_stream(m.spark, pages, "order", f"{root}/raw_orders", f"{root}/landing_state", checkpoint, m.params.shop_domain)
        if version == 1:
            files.delete(m.spark, checkpoint)
            landing.write_pages(m.inputs.raw_orders.where(F.col("batch_no") > 1).select("payload_json"), "order", pages, mode="append")
    files.delete(m.spark, pages)  # landed: the result reads the raw table
    return landing.read_raw(m.spark, "order", f"{root}/raw_orders").select("order_id", "updated_at")


# From this day on the shards of the scenario have ``items`` (older ones lack the
# column) and a column that the schema doesn't know.
SHARDS_CHANGED = "20240115"


def write_shards(events: DataFrame, root: str) -> None:
    """The event export as daily folders of two layouts, one of them an intraday shard."""
    spark, day = events.sparkSession, F.col("_table_suffix")
    aside = f"{root}/_writing"
    old, new = events.where(day < SHARDS_CHANGED).drop("items"), events.where(day >= SHARDS_CHANGED).withColumn("platform", F.lit("WEB"))
    for name, part in (("old", old), ("new", new)):
        part.hint("rebalance", "_table_suffix").write.partitionBy("_table_suffix").parquet(f"{aside}/{name}")
        for folder in files.names(spark, f"{aside}/{name}"):
            if folder.startswith("_table_suffix="):
                suffix = folder.removeprefix("_table_suffix=")
                files.rename(spark, f"{aside}/{name}/{folder}", f"{root}/events_{'intraday_' if suffix == '20240130' else ''}{suffix}")


def events_from_shards(m) -> DataFrame:
    """Events and items staged from separate daily shards of two layouts:
    per event its shard, and its items with their prices."""
    root = fresh_path(m.spark, "event-shards")
    write_shards(m.inputs.ga_events, root)
    events = staging.stg_ga_events(read_shards(m.spark, root, m.params.event_suffix_floor), m.params)
    return events.select("event_key", "event_date", "event_name", "ga_session_id", "source", "transaction_id", "purchase_revenue",
                         "source_table_suffix", F.coalesce(F.array_size("items"), F.lit(0)).cast("bigint").alias("n_items"))


def source_freshness(m) -> DataFrame:
    """Per raw source, the latest load time (``ingested_at``) and rows."""
    out = None
    for name, raw in (("raw_orders", m.inputs.raw_orders), ("raw_products", m.inputs.raw_products),
                      ("raw_customers", m.inputs.raw_customers)):
        df = raw.agg(F.max("ingested_at").alias("max_loaded_at"), F.count(F.lit(1)).alias("row_count"))
        df = df.select(F.lit(name).alias("source_name"), F.lit("ingested_at").alias("loaded_at_field"),
                       "max_loaded_at", "row_count")
        out = df if out is None else out.unionByName(df)
    return out


def _first_snapshot(m) -> DataFrame:
    return m.inputs.raw_orders.where(F.col("batch_no") == 1)


def orders_merged(m) -> DataFrame:
    """O3 + O4 on the order fact: build from the first snapshot, then merge
    the orders changed within the lookback of the full raw table."""
    path = fresh_path(m.spark, "fct_orders")
    run_fct_orders(m.spark, _first_snapshot(m), path, m.params)
    return run_fct_orders(m.spark, m.inputs.raw_orders, path, m.params)


def order_lines_merged(m) -> DataFrame:
    path = fresh_path(m.spark, "fct_order_lines")
    run_fct_order_lines(m.spark, _first_snapshot(m), path, m.params)
    return run_fct_order_lines(m.spark, m.inputs.raw_orders, path, m.params)
