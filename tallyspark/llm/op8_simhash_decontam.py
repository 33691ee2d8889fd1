"""Operator 8, benchmark decontamination by SimHash over item-sized windows.

Texts and items become words (lower-cased, letters and digits only) and
shingles of five words; an item of fewer words is one shingle, the whole
sequence. A shingle weighs 1 + ln(items / items that hold it), counted over
the whole benchmark; one that no item holds weighs as one of a single item.

For every item the window of its length slides over the whole document; a
document shorter than the item is one window:

1. A document is looked at closer for an item only if it holds shingles worth
   ``similarity`` of the item's weight; any matching window has them, so
   nothing is lost.
2. Each window that holds such a shingle gets a SimHash of 128 bits: prefix
   sums of the signed shingle weights, one difference per window.
3. Multi-index: the fingerprint is cut into 16 blocks. Two fingerprints within
   ``radius`` bits agree in some block up to ``radius // 16`` bits, so looking
   each block up in a table of its near values returns every item within the
   radius. The Hamming distance is then checked.
4. Candidates are verified by the exact weighted Jaccard similarity of the
   window's and the item's shingle multisets.

At similarity 0.8 a window differs from its item in 19 +- 4 of 128 bits; the
default radius of 40 is five standard deviations off.

The benchmark is a stated query set: it is collected in blocks of at most
``block_items`` items and each block is one map over the documents, without a
shuffle. Of several blocks, the shingles of two items or more are counted with
Spark first and collected too (16 bytes each), since a window in one block's
scan can hold another block's shingles: results don't depend on the blocks.
The documents are never collected.

Defined cases: null texts are empty and match nothing; null ids are kept;
items without words match nothing; repeated items and documents are reported
each; equal best windows: the first is reported; very long texts are scanned
whole; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import WordHashes, map_texts, mix64, sequence_hash, table, utf8_lists, window_hashes

WORDS, BITS, BLOCKS = 5, 128, 16
MATCHES = ("doc_id long, item_id long, similarity double, start_word long, n_words long, n_windows long")
_DROP = re.compile(r"[\W_]+")


def clean_word(word: bytes) -> bytes:
    w = word.decode("utf-8", "replace").lower()
    return (w if w.isalnum() else _DROP.sub("", w)).encode()


def _words(text: bytes, hashes: WordHashes) -> np.ndarray:
    h = hashes.of(text.split())
    return h[h != 0] if len(h) else h


def _signs(shingles: np.ndarray) -> np.ndarray:
    """n x BITS of +1 and -1 from the shingles' hashes."""
    two = np.stack([mix64(shingles + np.uint64(1)), mix64(shingles + np.uint64(2))], axis=1)
    bits = np.unpackbits(np.ascontiguousarray(two).view(np.uint8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def _near_bytes(distance: int) -> np.ndarray:
    """256 x 256: byte values within so many bits of each other."""
    pop = np.array([bin(i).count("1") for i in range(256)], np.uint8)
    v = np.arange(256)
    return pop[v[:, None] ^ v[None, :]] <= distance


def _item_shingles(words: np.ndarray) -> np.ndarray:
    return window_hashes(words, WORDS) if len(words) >= WORDS else sequence_hash(words)


class Items:
    """The index over one block of benchmark items. ``common`` is (items,
    shingles of two items or more, items that hold them) over all blocks;
    without it the block is the whole benchmark."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float, radius: int,
                 common: tuple[int, np.ndarray, np.ndarray] | None = None):
        self.similarity, self.radius = similarity, radius
        hashes = WordHashes(clean_word)
        kept = []
        for item_id, text in items:
            h = _words((text or "").encode(), hashes)
            if len(h):
                kept.append((item_id, len(h), _item_shingles(h)))
        self.ids = [k[0] for k in kept]
        self.lengths = [k[1] for k in kept]
        self.counts = [Counter(k[2].tolist()) for k in kept]
        holders: dict[int, list[int]] = defaultdict(list)
        for i, c in enumerate(self.counts):
            for s in c:
                holders[s].append(i)
        self.holders = dict(holders)
        self.shingles = np.array(sorted(holders), np.uint64)
        if common is None:
            times = np.array([len(holders[s]) for s in self.shingles.tolist()], np.int64)
            common = len(kept), self.shingles[times > 1], times[times > 1]
        n = max(1, common[0])
        self.common, self.common_weight = common[1], 1 + np.log(n / common[2])
        self.default = 1 + math.log(n)
        self.weight = dict(zip(self.shingles.tolist(), self.weights(self.shingles).tolist()))
        self.total = [sum(self.weight[s] * m for s, m in c.items()) for c in self.counts]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.shingles >> np.uint64(44)] = True
        self.short = sorted({x for x in self.lengths if x < WORDS})
        # Per item length: fingerprints as bytes, and the near-value table of each block.
        near = _near_bytes(radius // BLOCKS)
        self.groups: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, x in enumerate(self.lengths):
            by_length[x].append(i)
        for x, members in by_length.items():
            prints = []
            for i in members:
                sh = np.array(list(self.counts[i].elements()), np.uint64)
                w = np.array([self.weight[s] for s in sh.tolist()], np.float32)
                prints.append(np.packbits((_signs(sh) * w[:, None]).sum(axis=0) > 1e-3))
            prints = np.array(prints, np.uint8)
            tables = np.stack([near[:, prints[:, b]] for b in range(BLOCKS)])  # block, value, item
            self.groups[x] = (np.array(members), prints, tables)

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(shingles), self.default)
        if len(self.common):
            k = np.minimum(np.searchsorted(self.common, shingles), len(self.common) - 1)
            held = self.common[k] == shingles
            out[held] = self.common_weight[k[held]]
        return out

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Positions of the shingles that some item holds."""
        at = np.flatnonzero(self.maybe[shingles >> np.uint64(44)])
        if len(at) and len(self.shingles):
            k = np.searchsorted(self.shingles, shingles[at])
            at = at[self.shingles[np.minimum(k, len(self.shingles) - 1)] == shingles[at]]
        return at

    def match(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, best similarity, its start, windows) of one document."""
        out = []
        for size in [WORDS, *self.short]:
            sh = window_hashes(words, WORDS) if size == WORDS else None
            if sh is None:
                sh = window_hashes(words, size)
                sh = mix64(sh + np.uint64(size)) if len(sh) else sh
            at = self.hits(sh) if len(sh) else sh
            if len(at):
                out += self._in_regions(sh, at, size)
        return out

    def _in_regions(self, sh: np.ndarray, at: np.ndarray, size: int):
        found = defaultdict(set)
        for p in at.tolist():
            for i in self.holders[int(sh[p])]:
                if min(self.lengths[i], WORDS) == size:
                    found[i].add(int(sh[p]))
        plausible = defaultdict(set)
        for i, have in found.items():
            held = sum(self.weight[s] * self.counts[i][s] for s in have)
            if held >= self.similarity * self.total[i] * (1 - 1e-9):
                plausible[self.lengths[i]].add(i)
        out = []
        for length, items in plausible.items():
            m = min(length - size + 1, len(sh))  # shingles of a window, the whole of a shorter document
            n = len(sh) - m + 1
            # Windows that hold a hit, as runs of starts.
            mark = np.zeros(n + 1, np.int32)
            np.add.at(mark, np.clip(at - m + 1, 0, n), 1)
            np.add.at(mark, np.clip(at + 1, 0, n), -1)
            starts = np.flatnonzero(np.cumsum(mark[:n]) > 0)
            best: dict[int, tuple[float, int, int]] = {}
            for a in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                for b in range(0, len(a), 4096):
                    self._windows(sh, a[b:b + 4096], m, length, items, best)
            out += [(i, *x) for i, x in best.items()]
        return out

    def _windows(self, sh, starts, m, length, items, best) -> None:
        lo = int(starts[0])
        part = sh[lo:int(starts[-1]) + m]
        weights = self.weights(part)
        w = weights.astype(np.float32)
        sums = np.zeros((len(part) + 1, BITS), np.float64)
        np.cumsum(_signs(part) * w[:, None], axis=0, out=sums[1:])
        prints = np.packbits(sums[starts - lo + m] - sums[starts - lo] > 1e-3, axis=1)
        members, own, tables = self.groups[length]
        near = np.zeros((len(starts), len(members)), bool)
        for b in range(BLOCKS):
            near |= tables[b][prints[:, b]]
        for k, j in zip(*np.nonzero(near)):
            i = int(members[j])
            if i not in items or np.unpackbits(prints[k] ^ own[j]).sum() > self.radius:
                continue
            s = int(starts[k])
            window = sh[s:s + m].tolist()
            value = self._similarity(Counter(window), dict(zip(window, weights[s - lo:s - lo + m].tolist())), i)
            if value >= self.similarity:
                old = best.get(i, (-1.0, 0, 0))
                best[i] = (value, s, old[2] + 1) if value > old[0] else (old[0], old[1], old[2] + 1)

    def _similarity(self, window: Counter, weight: dict[int, float], i: int) -> float:
        item = self.counts[i]
        shared = union = 0.0
        for s in window.keys() | item.keys():
            w = weight[s] if s in weight else self.weight[s]
            a, b = window[s], item[s]
            shared += w * min(a, b)
            union += w * max(a, b)
        return shared / union if union else 0.0


def find_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = 40,
                       block_items: int = 20_000) -> DataFrame:
    """One row per document and item it holds: ``doc_id, item_id,
    similarity`` (of the best window), ``start_word`` (in normalised words),
    ``n_words`` (the item's), ``n_windows`` (at or above the similarity)."""
    return reduce(DataFrame.unionAll, [
        map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _matcher(index), MATCHES)
        for index in _indexes(benchmark, similarity, radius, block_items)])


def _indexes(benchmark: DataFrame, similarity: float, radius: int, block_items: int) -> Iterator[Items]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-items.count() // block_items))
    common = _common(items) if blocks > 1 else None
    for k in range(blocks):
        own = items if blocks == 1 else items.filter(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Items([tuple(r) for r in own.collect()], similarity, radius, common)


def _common(items: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Items with words, and the ascending shingles that two of them or more
    hold, with how many do."""
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(clean_word)
        for b in batches:
            parts = [w for t in utf8_lists(b, "text") if len(w := _words(t, hashes))]
            if parts:
                held = np.concatenate([np.unique(_item_shingles(w)) for w in parts])
                # A null per item counts the items.
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.nulls(len(parts), pa.int64()), pa.array(held.view(np.int64))])], names=["shingle"])

    counted = (map_texts(items, shingles, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
               .filter("n > 1 or shingle is null").toArrow())
    n = counted.column("n").to_numpy()
    of_items = counted.column("shingle").is_null().to_numpy()
    keys = counted.column("shingle").fill_null(0).to_numpy()[~of_items].astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return int(n[of_items].sum()), keys[order], n[~of_items][order]


def _matcher(index: Items):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(clean_word)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), utf8_lists(b, "text")):
                for i, value, start, n in index.match(_words(text, hashes)) if text else ():
                    rows.append((doc, index.ids[i], value, start, index.lengths[i], n))
            if rows:
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=["doc_id", "item_id", "similarity", "start_word", "n_words", "n_windows"])
    return match


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = 40,
                      block_items: int = 20_000) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item: a map per
    block of items, without a shuffle."""
    def keeper(index: Items):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes(clean_word)
            for b in batches:
                good = [not t or not index.match(_words(t, hashes)) for t in utf8_lists(b, "text")]
                yield b.filter(pa.array(good, pa.bool_()))
        return keep

    for index in _indexes(benchmark, similarity, radius, block_items):
        docs = map_texts(docs, keeper(index), docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` against all of ``benchmark``."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
