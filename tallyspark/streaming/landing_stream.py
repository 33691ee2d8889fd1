"""Landing as a file-source stream (S1-S8 delivered incrementally).

New page files under ``pages_dir`` are picked up once each: the stream
checkpoint remembers which files were processed, so a rerun over the same
directory lands nothing. ``trigger(availableNow=True)`` processes what is
there and stops, which suits a scheduled job.

A run has one bound and one commit, however many micro-batches it takes: the
checkpoint is read before the stream starts and moved after it has ended, so
a micro-batch never drops records that are older than an earlier one's.

Landing only ever adds. A micro-batch is known by the stream's own id (in its
checkpoint's metadata; a new checkpoint, at whatever path, has a new one) and
its epoch, and is published as one folder of the raw table with one rename
(``sources.ledger``). A replayed epoch finds its folder and lands nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.sources.landing import commit_watermark, ensure_raw_table, kept_rows, read_state, unwrap_pages
from tallyspark.sources.ledger import Ledger


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint when it first ran."""
    return files.read_json(spark, f"{checkpoint}/metadata")["id"]


def land_stream(spark: SparkSession, pages_dir: str, entity: str, raw_path: str, state_path: str,
                checkpoint: str, shop_domain: str, max_files_per_trigger: int | None = None,
                whole_files: bool = False) -> None:
    ensure_raw_table(spark, entity, raw_path)
    # The bound as a value: the state table may be written while the run lasts.
    rows = [tuple(r) for r in read_state(spark, state_path).where(F.col("source") == entity).collect()]
    state = spark.createDataFrame(rows, "source string, last_updated_at timestamp")

    reader = spark.readStream.schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    records = unwrap_pages(reader.text(pages_dir, wholetext=whole_files))

    def one_batch(batch: DataFrame, epoch_id: int) -> None:
        Ledger(spark, raw_path, stream_id(spark, checkpoint)).land(
            epoch_id, lambda batch_no: kept_rows(batch, state, entity, shop_domain, batch_no))

    q = (records.writeStream.foreachBatch(one_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()

    # The watermark of the epochs that no commit covers yet, so that also a run
    # that broke off before its commit counts. Read from their entries alone.
    ledger = Ledger(spark, raw_path, str(q.id))
    entries = ledger.uncommitted()
    wm = max((e["watermark"] for e in entries if e["watermark"] is not None), default=None)
    before = [r[1] for r in rows if r[1] is not None]
    moved = spark.range(1).select(F.unix_micros(F.lit(before[0]).cast("timestamp"))).first()[0] if before else None
    if wm is not None and (moved is None or wm > moved):
        commit_watermark(spark, entity, wm, state_path)
    if entries:
        ledger.commit(max(e["epoch"] for e in entries))
