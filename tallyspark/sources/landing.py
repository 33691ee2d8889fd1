"""Incremental landing of API records into append-only raw tables.

Pages of records are landed as files, one page object per line:
``{"orders": [{...}, ...]}`` -- the record list is the value of the page's
*first* key. A landing batch:

1. unwraps pages into records (S1) and shapes raw rows (S2);
2. drops records at or before the source's checkpoint (S4; records without
   ``updated_at`` always pass, quirk D17);
3. appends the kept rows to the raw table (S8), *then*
4. moves the checkpoint to the batch high watermark (S6, S7) -- so a crash
   between 3 and 4 re-appends rows, which the staging dedup absorbs.

The checkpoint table has one row per source (keyed merge), so the slice the
filter reads is at most one row and is broadcast.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspark.files import exists
from tallyspark.functions.casts import safe_bigint, safe_timestamp
from tallyspark.functions.json import number_text, parse_fields
from tallyspark.operators.dedup import dedup_latest
from tallyspark.operators.incremental import merge_into
from tallyspark.sources.schemas import STATE_SCHEMA, raw_entity_schema

API_PAGE_SIZE = 250
# Records per page file: compressed files are read whole, so each is small.
RECORDS_PER_FILE = 100_000


# Numbers that JSON can't hold, as the parser writes them.
NON_FINITE = ('"Infinity"', '"-Infinity"', '"NaN"')


# ---------------------------------------------------------------------------
# S1 / S2
# ---------------------------------------------------------------------------

def write_pages(records: DataFrame, entity: str, path: str, page_size: int = API_PAGE_SIZE,
                mode: str = "overwrite") -> None:
    """Land ``records`` (column ``payload_json``) as API pages of at most
    ``page_size`` records. A page is ``page_size`` successive rows of a task,
    put together as they pass: no shuffle, and one page in memory at a time.
    The files are compressed (JSON repeats its keys) and bounded in records,
    so that a large snapshot is many files and as many tasks read it."""
    def pages(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        held = pa.array([], pa.large_string())

        def put_together(texts: pa.Array) -> pa.RecordBatch:
            starts = np.append(np.arange(0, len(texts), page_size), len(texts))
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), texts), pa.scalar(",", pa.large_string()))
            ends = [pa.scalar(t, pa.large_string()) for t in ('{"' + entity + 's": [', "]}", "")]
            whole = pc.binary_join_element_wise(ends[0], joined, ends[1], ends[2])
            return pa.RecordBatch.from_arrays([whole.cast(pa.string())], ["value"])

        for batch in batches:
            held = pa.concat_arrays([held, batch.column(0).drop_null().cast(pa.large_string())])
            full = len(held) // page_size * page_size
            if full:
                yield put_together(held[:full])
                held = held[full:]
        if len(held):
            yield put_together(held)

    (records.select("payload_json").mapInArrow(pages, "value string")
     .write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", max(1, RECORDS_PER_FILE // page_size)).text(path))


def read_pages(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed page files as text: one page per line, or with
    ``whole_files`` one page per file, of any layout."""
    return spark.read.text(path, wholetext=whole_files)


def unwrap_pages(pages: DataFrame) -> DataFrame:
    """One row per record (raw JSON text), from the first key's array. A
    page that can't be read, or whose first value is no array, is an error:
    its records must not vanish. Blank lines are no pages.

    One parse yields the records of a page whose values are all arrays. Any other
    page is parsed by steps: its first value as text, the records from that."""
    said = F.concat(F.lit("unreadable page: "), F.substring("value", 1, 200))
    # Each parse is a column of its own: it is read more than once below.
    parsed = (pages.where(F.col("value").rlike(r"[^\t\r\n ]"))  # found at the first characters of a page
              .select("value", F.get(F.map_values(F.from_json("value", "map<string,array<string>>")), 0).alias("_arrays"))
              # By steps also where a record is a number out of range, which the one parse leaves in quotes.
              .select("value", F.when(F.arrays_overlap("_arrays", F.array(*map(F.lit, NON_FINITE))), F.lit(None))
                      .otherwise(F.col("_arrays")).alias("_whole"))
              .select("value", "_whole", F.when(F.col("_whole").isNull(), F.get(F.map_values(F.from_json("value", "map<string,string>")), 0)).alias("_first"))
              .select("value", "_whole", "_first", F.from_json("_first", "array<string>").alias("_records")))
    unreadable = F.col("_records").isNull() | ~F.ltrim(F.substring("_first", 1, 100)).startswith("[")
    records = F.when(F.col("_whole").isNotNull(), F.col("_whole")).when(unreadable, F.raise_error(said)).otherwise(F.col("_records"))
    return parsed.select(F.explode(records).alias("payload_json"))


def raw_rows(records: DataFrame, entity: str, shop_domain: str, batch_no: int,
             ingested_at: _dt.datetime | None = None) -> DataFrame:
    """``(shop_domain, {entity}_id, updated_at, ingested_at, payload_json,
    batch_no)``; one ``ingested_at`` and one ``batch_no`` per run."""
    ingested = (F.lit(ingested_at).cast("timestamp") if ingested_at is not None
                else F.current_timestamp())
    # One parse of a record for both fields; a field of a struct reads as its text.
    parsed = records.select("payload_json", parse_fields("payload_json", ["id", "updated_at"]).alias("_p"))
    return parsed.select(
        F.lit(shop_domain).alias("shop_domain"),
        safe_bigint(number_text(F.col("_p"), "id")).alias(f"{entity}_id"),
        safe_timestamp(number_text(F.col("_p"), "updated_at")).alias("updated_at"),
        ingested.alias("ingested_at"),
        F.col("payload_json"),
        F.lit(batch_no).cast("bigint").alias("batch_no"),
    )


# ---------------------------------------------------------------------------
# Checkpoint state
# ---------------------------------------------------------------------------

def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def state_of(spark: SparkSession, rows: list[tuple[str, _dt.datetime | None]]) -> DataFrame:
    return spark.createDataFrame(rows, STATE_SCHEMA)


def checkpoint_of(state: DataFrame, source: str) -> DataFrame:
    """S3: the source's checkpoint row -- a parameter-bound query with
    ``LIMIT 1`` (at most one row by construction)."""
    return state.sparkSession.sql(
        "SELECT source, last_updated_at FROM {state} WHERE source = :source LIMIT 1",
        args={"source": source}, state=state)


def api_lower_bound(ts) -> F.Column:
    """The request's ``updated_at_min`` -- the checkpoint in UTC,
    formatted to whole seconds with a ``Z`` suffix (so inclusive of records a
    fraction of a second before the checkpoint; S4 drops them)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def source_window(rows: DataFrame, state: DataFrame, source: str) -> DataFrame:
    """What the source returns for ``updated_at >= updated_at_min``
    (whole-second bound, inclusive). Records without ``updated_at`` are kept.
    Applied before S4 it only narrows the input; S4 decides."""
    ckpt = F.broadcast(checkpoint_of(state, source).select(
        F.col("source").alias("_src"), F.col("last_updated_at").alias("_ckpt")))
    j = rows.withColumn("_src", F.lit(source)).join(ckpt, "_src", "left")
    bound = F.to_timestamp(api_lower_bound(F.col("_ckpt")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    keep = F.col("_ckpt").isNull() | F.col("updated_at").isNull() | (F.col("updated_at") >= bound)
    return j.where(keep).drop("_src", "_ckpt")


def incremental_filter(rows: DataFrame, state: DataFrame, source: str) -> DataFrame:
    """Drop a record iff both the checkpoint and its ``updated_at`` exist
    and ``updated_at <= checkpoint``. The checkpoint slice is one row at most
    (S3, ``LIMIT 1``), so it is broadcast."""
    ckpt = F.broadcast(checkpoint_of(state, source).select(
        F.col("source").alias("_src"), F.col("last_updated_at").alias("_ckpt")))
    j = rows.withColumn("_src", F.lit(source)).join(ckpt, "_src", "left")
    keep = F.col("_ckpt").isNull() | F.col("updated_at").isNull() | (F.col("updated_at") > F.col("_ckpt"))
    return j.where(keep).drop("_src", "_ckpt")


def high_watermark(kept: DataFrame, source: str) -> DataFrame:
    """One row ``(source, max updated_at over kept rows)``; NULL when no
    kept row has an ``updated_at``."""
    return kept.agg(F.max("updated_at").alias("last_updated_at")).select(
        F.lit(source).alias("source"), "last_updated_at")


def merge_state(state: DataFrame, watermark: DataFrame) -> DataFrame:
    """Upsert the watermark on ``source`` -- only when it is non-NULL
    (a batch whose rows have no ``updated_at`` leaves the checkpoint)."""
    updates = watermark.where(F.col("last_updated_at").isNotNull())
    return merge_into(state, updates, ["source"]).select("source", "last_updated_at")


# ---------------------------------------------------------------------------
# One landing run
# ---------------------------------------------------------------------------

# The checkpoint table is an append-only log: every commit appends one row
# per source. Appends commit atomically, so a crash at any point leaves the
# previous checkpoint readable (an overwrite would delete it first). The
# current state is the latest row per source.
STATE_LOG_SCHEMA = "source string, last_updated_at timestamp, committed_at timestamp"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Current checkpoint per source (latest committed row); empty before the
    first commit (S9)."""
    if not exists(spark, path):
        return empty_state(spark)
    log = spark.read.schema(STATE_LOG_SCHEMA).parquet(path)
    latest = dedup_latest(log, ["source"], [F.col("committed_at").desc(), F.col("last_updated_at").desc()])
    return latest.select("source", "last_updated_at")


def commit_state(state: DataFrame, path: str) -> None:
    """Append ``state`` rows to the checkpoint log (one row per source)."""
    state.select("source", "last_updated_at", F.current_timestamp().alias("committed_at")) \
        .coalesce(1).write.mode("append").parquet(path)


def ensure_raw_table(spark: SparkSession, entity: str, path: str) -> None:
    """Create the raw table (explicit schema, partitioned by batch) if it
    is missing; a no-op when it exists."""
    if not exists(spark, path):
        (spark.createDataFrame([], raw_entity_schema(entity)).write.mode("append")
         .partitionBy("batch_no").parquet(path))


def read_raw(spark: SparkSession, entity: str, path: str) -> DataFrame:
    return spark.read.schema(raw_entity_schema(entity)).parquet(path)


def land_batch(spark: SparkSession, records: DataFrame, entity: str, raw_path: str,
               state_path: str, shop_domain: str, batch_no: int,
               ingested_at: _dt.datetime | None = None) -> dict:
    """Run S2-S8 for one entity: filter by checkpoint, append, then commit the
    checkpoint. Returns the kept-row count and the new checkpoint."""
    ensure_raw_table(spark, entity, raw_path)
    kept = kept_rows(records, read_state(spark, state_path), entity, shop_domain, batch_no, ingested_at)
    # The batch high watermark (S6) is observed while the append runs -- no
    # second pass over the source or the table. max() is idempotent, so task
    # retries cannot skew it.
    obs = Observation(f"landing-{entity}-{batch_no}")
    kept = kept.observe(obs, F.max(F.unix_micros("updated_at")).alias("wm_us"),
                        F.count(F.lit(1)).alias("rows"))
    kept.write.mode("append").option("compression", "zstd").partitionBy("batch_no").parquet(raw_path)
    metrics = obs.get
    commit_watermark(spark, entity, metrics["wm_us"], state_path)
    return {"entity": entity, "batch_no": batch_no, "rows": metrics["rows"]}


def commit_watermark(spark: SparkSession, entity: str, wm_us: int | None, state_path: str) -> None:
    """Only a non-NULL watermark moves the checkpoint (upsert on source =
    append to the log; the latest row per source wins)."""
    if wm_us is not None:
        commit_state(spark.range(1).select(
            F.lit(entity).alias("source"),
            F.timestamp_micros(F.lit(wm_us).cast("bigint")).alias("last_updated_at")), state_path)


def kept_rows(records: DataFrame, state: DataFrame, entity: str, shop_domain: str, batch_no: int,
              ingested_at: _dt.datetime | None = None) -> DataFrame:
    """S2-S5 of one batch: the shaped rows that pass the checkpoint ``state``."""
    shaped = raw_rows(records, entity, shop_domain, batch_no, ingested_at)
    kept = incremental_filter(source_window(shaped, state, entity), state, entity)
    return kept.select(*raw_entity_schema(entity).fieldNames())


def land_entities(spark: SparkSession, entities: dict[str, DataFrame], root: str, shop_domain: str,
                  batch_no: int, ingested_at: _dt.datetime | None = None) -> None:
    """The same landing job for several entities (orders, products,
    customers), each with its own raw table (``{root}/raw_{entity}s``) and
    its own row in the shared checkpoint table (``{root}/landing_state``).
    Entities run one after another; a failure stops the later ones, and a
    rerun resumes from each entity's committed checkpoint."""
    for entity, records in entities.items():
        land_batch(spark, records, entity, f"{root}/raw_{entity}s", f"{root}/landing_state",
                   shop_domain, batch_no, ingested_at)
