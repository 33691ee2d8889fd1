"""Operator 5, substring deduplication by known windows, in place of a relative
Lempel-Ziv parse: where a run is copied from is not kept.

The reference of a document is every document with a smaller id. It is
indexed by all its runs of ``k`` words, in blocks by hash: each block of the
index is one bucket, which holds the smallest document id per run. A run that
stands in the reference is known, and the words of known runs are the
duplicate spans. What is called a factor here is a maximal stretch of known
runs that overlap or touch: they may come from different documents, so a
factor need not be a copy of one place, and a greedy parse along one source
may have more factors. The words removed are the same for every choice of
sources, since every known run is cut whole.

The plan: (1) a map hashes the runs of each block of documents, keeps, of
equal runs in the block, those of its smallest document (the others are
duplicates already, so a passage in a third of all documents is sent once per
block), and deals them into buckets as byte blobs; (2) each bucket finds the
smallest id per run and sends the places of the others to their documents'
group; (3) groups of documents and places are brought together and parsed. A
bucket holds about 2 million runs and a group 12 MB of text, whatever the size of
the corpus; hashes have 64 bits.

Defined cases: a null text is empty; a null id is nobody's reference and is
never cut; rows that share an id are not each other's reference and are
parsed each; repeated rows get equal results; texts are parsed whole; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import (WordHashes, bucket_count, bucket_of, from_planes, map_texts, mix64, planes, runs, table, text_blocks,
                     utf8_lists, window_hashes)

BLOCK_BYTES = 4 << 20
BLOBS = "bucket int, owners binary, tags binary, counts binary, places binary, hashes binary"
_FIELDS = ["bucket", "owners", "tags", "counts", "places", "hashes"]
_SCHEMA = pa.schema([("bucket", pa.int32()), *((f, pa.binary()) for f in _FIELDS[1:])])
PARSED = "doc_id long, n_words long, n_removed long, n_factors long, kept_sha256 string, spans array<struct<start:long,words:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))
_PARSED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_factors", pa.int64()),
                     ("kept_sha256", pa.string()), ("spans", _SPANS)])


def _tag(text: bytes) -> int:
    return xxhash.xxh32_intdigest(text)


def _group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return bucket_of(mix64(ids.astype(np.int64).view(np.uint64)), groups)


def _deal(to: np.ndarray, owner: np.ndarray, tag: np.ndarray, place: np.ndarray, hashes: np.ndarray | None, base: int):
    """Rows of BLOBS, one per value of ``to``: owners with a count of places
    each, in order."""
    if not len(to):
        return
    order = np.lexsort((place, tag, owner, to)) if hashes is None else np.argsort(to, kind="stable")
    to, owner, tag, place = to[order], owner[order], tag[order], place[order]
    hashes = hashes[order] if hashes is not None else None
    cut = runs(to)
    for a, b in zip(cut, [*cut[1:], len(to)]):
        o, t, p = owner[a:b], tag[a:b], place[a:b]
        first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (t[1:] != t[:-1])]))
        counts = np.diff(np.append(first, b - a)).astype(np.uint32)
        yield (int(to[a]) + base, planes(o[first]), planes(t[first]), planes(counts), planes(p),
               hashes[a:b].tobytes() if hashes is not None else b"")


def _undeal(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    counts = from_planes(row["counts"], np.uint32)
    return (np.repeat(from_planes(row["owners"], np.int64), counts), np.repeat(from_planes(row["tags"], np.uint32), counts),
            from_planes(row["places"], np.uint32), np.frombuffer(row["hashes"], np.uint64))


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _index_blocks(k: int, buckets: int, groups: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for ids, texts in text_blocks(batches, BLOCK_BYTES):
            hs = [window_hashes(words.of(t.split()), k) if i is not None else np.empty(0, np.uint64)
                  for i, t in zip(ids, texts)]
            sizes = np.array([len(h) for h in hs])
            if not sizes.sum():
                continue
            h = np.concatenate(hs)
            owner = np.repeat(np.array([i or 0 for i in ids], np.int64), sizes)
            tag = np.repeat(np.array([_tag(t) for t in texts], np.uint32), sizes)
            place = (np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.uint32)
            # Of equal runs in this block, those of the smallest document go on.
            order = np.argsort(h)
            cut = runs(h[order])
            least = np.minimum.reduceat(owner[order], cut)
            known = np.empty(len(h), bool)
            known[order] = owner[order] > np.repeat(least, np.diff(np.append(cut, len(h))))
            new = ~known
            rows = list(_deal(bucket_of(h[new], buckets), owner[new], tag[new], place[new], h[new], 0))
            rows += _deal(_group_of(owner[known], groups), owner[known], tag[known], place[known], None, buckets)
            for i in range(0, len(rows), 64):
                yield _batch(rows[i:i + 64])
    return index


def _find_known(buckets: int, groups: int):
    def find(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        if rows[0]["bucket"] >= buckets:  # places that are known already
            return pa.Table.from_batches([_batch([tuple(r[f] for f in _FIELDS) for r in rows])])
        owner, tag, place, h = (np.concatenate(x) for x in zip(*map(_undeal, rows)))
        del rows
        order = np.argsort(h)
        cut = runs(h[order])
        least = np.minimum.reduceat(owner[order], cut)
        found = order[owner[order] > np.repeat(least, np.diff(np.append(cut, len(h))))]
        out = list(_deal(_group_of(owner[found], groups), owner[found], tag[found], place[found], None, buckets))
        return pa.Table.from_batches([_batch(out)] if out else [], schema=_SCHEMA)
    return find


def factorise(places: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Factors (start, words), the union of the known runs: ``places`` are the
    words at which a run of ``k`` words stands in the reference. From such a word
    the factor goes on while a known run begins before its end or at it."""
    out: list[tuple[int, int]] = []
    for p in np.unique(places).tolist():
        if out and p <= out[-1][0] + out[-1][1]:
            out[-1] = (out[-1][0], p + k - out[-1][0])
        else:
            out.append((p, k))
    return out


def _pack(groups: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = utf8_lists(b, "text")
            ids = b.column(0).to_pylist()
            group = _group_of(np.array([i or 0 for i in ids], np.int64), groups)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group + 0, pa.int32()), b.column(0), pa.array([press.compress(t) for t in texts], pa.binary())],
                names=["bucket", "doc_id", "packed"])
    return pack


def _parse(k: int):
    def parse(docs: pa.Table, blobs: pa.Table) -> pa.Table:
        places: dict[tuple[int, int], list] = defaultdict(list)
        for row in blobs.to_pylist():
            counts = from_planes(row["counts"], np.uint32)
            parts = np.split(from_planes(row["places"], np.uint32), np.cumsum(counts)[:-1])
            for o, t, p in zip(from_planes(row["owners"], np.int64).tolist(), from_planes(row["tags"], np.uint32).tolist(), parts):
                places[o, t].append(p)
        open_ = zstandard.ZstdDecompressor()
        rows = []
        for i, packed in zip(docs.column("doc_id").to_pylist(), docs.column("packed").to_pylist()):
            text = open_.decompress(packed)
            words = text.split()
            mine = places.get((i, _tag(text)), ())
            factors = factorise(np.concatenate(mine), k) if len(mine) else []
            n = len(words)
            for start, size in reversed(factors):
                del words[start:start + size]
            rows.append((i, n, n - len(words), len(factors), hashlib.sha256(b" ".join(words)).hexdigest(),
                         [{"start": s, "words": m} for s, m in factors]))
        if not rows:
            return _PARSED.empty_table()
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARSED)], schema=_PARSED)
    return parse


def parse_against_smaller(docs: DataFrame, k: int = 13) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``n_words, n_removed,
    n_factors``, the factors as word ``spans``, and the digest of the kept words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = bucket_count(docs)
    groups = max(buckets, 1)
    known = (map_texts(docs, _index_blocks(k, buckets, groups), BLOBS)
             .groupBy("bucket").applyInArrow(_find_known(buckets, groups), BLOBS)
             .withColumn("bucket", F.col("bucket") - buckets))
    packed = map_texts(docs, _pack(groups), "bucket int, doc_id long, packed binary")
    return (packed.groupBy("bucket").cogroup(known.groupBy("bucket"))
            .applyInArrow(_parse(k), PARSED))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over every whole text of ``documents``: runs of 13 words."""
    return parse_against_smaller(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", "n_factors")


ORACLE_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words
  FROM documents),
windows AS (
  SELECT r, doc_id, p, array_to_string(words[p:p + 12], ' ') AS win
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM texts WHERE doc_id IS NOT NULL)),
known AS (SELECT r, p FROM windows QUALIFY min(doc_id) OVER (PARTITION BY win) < doc_id),
gone AS (SELECT DISTINCT r, p + k AS i FROM known, (SELECT unnest(range(0, 13)) AS k)),
said AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM said ANTI JOIN gone USING (r, i) GROUP BY r),
factors AS (SELECT r, count(*) AS n FROM (
  SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS q FROM known) WHERE q IS NULL OR p > q + 13 GROUP BY r)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(len(t.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256, CAST(coalesce(f.n, 0) AS BIGINT) AS n_factors
FROM texts t LEFT JOIN kept k USING (r) LEFT JOIN factors f USING (r)
"""
