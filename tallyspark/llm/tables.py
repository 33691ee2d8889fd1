"""Helpers shared by the operators: input tables, written intermediates,
and word hashing inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.session import fresh_path

# Words of every contract: maximal runs of anything but these six bytes.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts
    the lineage, gives the planner real sizes, and survives a lost executor."""
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return _read(df, path)


def _read(df: DataFrame, path: str) -> DataFrame:
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stepped(df: DataFrame, name: str) -> DataFrame:
    """``written``, after which the step's shuffle files are removed: a job of many steps
    has those of one at a time on disk."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def used_up(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for t in tables:
        files.delete(t.sparkSession, t.written_at)


ROWS_PER_BATCH = 1000


def map_texts(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` in small record batches: a row holds a whole text, so
    Spark's 10,000 rows a batch cost each Python worker and its executor some
    hundred MB. The session's limit is lowered, never raised."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= ROWS_PER_BATCH:
        conf.set(key, str(ROWS_PER_BATCH))
    return df.mapInArrow(function, schema)


def words_of(text: Column) -> Column:
    """Array of the words of a text, as a native expression (null: empty)."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


# ---------------------------------------------------------------- inside tasks

class WordHashes(dict):
    """64-bit hash per word, remembered for up to ``limit`` distinct words."""

    def __init__(self, clean=None, limit: int = 1 << 18):
        super().__init__()
        self.clean, self.limit = clean, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        w = self.clean(word) if self.clean else word
        h = xxhash.xxh64_intdigest(w) if w or not self.clean else 0
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser over uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MULT = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (empty if fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= _MULT
        out += h[j:j + n]
    return mix64(out)


def sequence_hash(h: np.ndarray) -> np.ndarray:
    """One hash for a whole short sequence, distinct from its windows'."""
    return mix64(window_hashes(h, len(h)) + np.uint64(len(h)))


def utf8_lists(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as bytes; null is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
    return [b"" if x is None else x for x in col.to_pylist()]


def slices(texts: list[bytes], limit: int):
    """Index ranges whose texts total about ``limit`` bytes (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def text_blocks(batches, limit: int):
    """(ids, texts) of the batches' rows (doc_id, text), regrouped to blocks of
    about ``limit`` bytes of text."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), utf8_lists(b, "text")):
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if texts:
        yield ids, texts


# ------------------------------------------- occurrences, dealt out in blobs

def bucket_count(docs: DataFrame, per_bucket: int = 2_000_000) -> int:
    """Buckets for the occurrences of the texts' words: about ``per_bucket``
    words each by the size of the texts, and no fewer than the session's
    shuffle partitions."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // (6 * per_bucket)))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def planes(x: np.ndarray) -> bytes:
    """The array byte plane by byte plane: high planes are mostly zero and
    shrink to nothing in the shuffle's compression."""
    return x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    if not len(sorted_keys):
        return np.empty(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1])
