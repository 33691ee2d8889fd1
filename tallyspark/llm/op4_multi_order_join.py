"""Operator 4, n-gram Jaccard self-join with multiple-global-order filtering.

Documents with equal shingle sets are one class from the start. Two classes
link when ``100 * intersection >= percent * union``; the result is each
document's set size and the smallest id that links reach.

1. Index. A map hashes every document's shingles (48 bits) and deals them,
   once per class and task, into buckets. A bucket counts in how many classes
   a shingle stands; shingles of one class only can be in no intersection and
   end here. The others go, with their frequency, to their class's group.
   A class whose shared shingles don't reach ``percent`` of its set can link
   with nothing and ends as well.
2. Orders. A global order of all shingles puts the prefix of a set at its
   ``n - ceil(percent * n) + 1`` first; two sets that link share one of them,
   under any order. Three orders are used, all with the unshared shingles
   first: by exact frequency step, by power of two of the frequency, and by
   hash, each with hashes of its own in between. Candidates meet in the first
   order's prefix (with the length and position bounds), and must also share
   prefix shingles under the second and the third, before the sets are
   intersected.
3. For components links are needed only up to connection, so candidates come
   in two rounds.
   First every list of a prefix shingle is cut into pieces of about 256
   classes by its frequency, and a class meets the piece's first (least
   unshared shingles) and its neighbour. After the components of those links,
   lists that hold several components are joined with themselves across
   components only. Every pair that could link two components is verified;
   pairs inside one needn't be.
4. :func:`near_links` is the whole join: every pair of classes that link, and
   the number of links of each row. There the pieces of a list meet all its
   other pieces, a pair of pieces being one key of an equi-join, and all
   candidates within the bounds are verified. Its cost grows with the links.

For components no list is emitted as all its pairs, copies and near copies cost a few
candidates each, and joins on hot shingles are plain equi-joins that adaptive
execution splits.

Defined cases: null and wordless texts have no shingles, link with nothing
and are their own component; fewer words than a shingle are one shingle;
A-Z are lower-cased, nothing else; a null id has its class's component if
the class has an id, else null; repeated rows and ids are members each;
texts are read whole; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .components import components
from .tables import (WordHashes, bucket_count, bucket_of, mix64, planes, from_planes, map_texts, runs, sequence_hash, table,
                     text_blocks, utf8_lists, window_hashes, written)

BLOCK_BYTES = 8 << 20
PIECE = 256
LOW, HIGH = np.uint64(16), np.uint64(48)
BLOBS = "bucket int, sets binary, sizes binary, counts binary, low binary, high binary, codes binary"
_FIELDS = ["bucket", "sets", "sizes", "counts", "low", "high", "codes"]
_SCHEMA = pa.schema([("bucket", pa.int32()), *((f, pa.binary()) for f in _FIELDS[1:])])
SIGNED = "doc_id long, set_id long, n_shingles long"
CLASSES = ("set_id long, n long, alone long, shingles array<long>, first array<long>, codes array<int>, "
           "second array<long>, third array<long>")
_CLASSES = pa.schema([("set_id", pa.int64()), ("n", pa.int64()), ("alone", pa.int64()), ("shingles", pa.list_(pa.int64())),
                      ("first", pa.list_(pa.int64())), ("codes", pa.list_(pa.int32())), ("second", pa.list_(pa.int64())),
                      ("third", pa.list_(pa.int64()))])


def shingle_set(text: bytes, k: int, words: WordHashes) -> np.ndarray:
    """Distinct shingle hashes (48 bits, ascending) of a text."""
    h = words.of(text.lower().split())
    if not len(h):
        return np.empty(0, np.uint64)
    return np.unique((window_hashes(h, k) if len(h) >= k else sequence_hash(h)) >> LOW)


def set_id_of(shingles: np.ndarray) -> int:
    h = xxhash.xxh64_intdigest(shingles.tobytes())
    return h - (1 << 64) if h >> 63 else h


def _sign(k: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            sets = [shingle_set(t, k, words) for t in utf8_lists(b, "text")]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([set_id_of(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64())], names=["doc_id", "set_id", "n_shingles"])
    return sign


def _rows_by(to: np.ndarray, sets: np.ndarray, sizes: np.ndarray, shingles: np.ndarray, codes: np.ndarray | None):
    """Rows of BLOBS per value of ``to``; entries of a set adjacent."""
    order = np.lexsort((sets, to)) if codes is not None else np.argsort(to, kind="stable")
    to, sets, sizes, shingles = to[order], sets[order], sizes[order], shingles[order]
    codes = codes[order] if codes is not None else None
    cut = runs(to)
    for a, b in zip(cut, [*cut[1:], len(to)]):
        s, x = sets[a:b], shingles[a:b]
        first = runs(s)
        counts = np.diff(np.append(first, b - a)).astype(np.uint32)
        yield (int(to[a]), planes(s[first]), planes(sizes[a:b][first]), planes(counts), planes(x.astype(np.uint32)),
               planes((x >> np.uint64(32)).astype(np.uint16)), codes[a:b].tobytes() if codes is not None else b"")


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _read(rows: list[dict]):
    """(sets, sizes, shingles, codes), one entry per shingle of a set."""
    parts = []
    for r in rows:
        counts = from_planes(r["counts"], np.uint32)
        x = from_planes(r["low"], np.uint32).astype(np.uint64) | (from_planes(r["high"], np.uint16).astype(np.uint64) << np.uint64(32))
        parts.append((np.repeat(from_planes(r["sets"], np.int64), counts), np.repeat(from_planes(r["sizes"], np.uint32), counts),
                      x, np.frombuffer(r["codes"], np.uint8)))
    return [np.concatenate(p) for p in zip(*parts)]


def _deal(k: int, buckets: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordHashes(), set()
        for _, texts in text_blocks(batches, BLOCK_BYTES):
            sets, ids = [], []
            for t in texts:
                s = shingle_set(t, k, words)
                if len(s) and (i := set_id_of(s)) not in seen:
                    seen.add(i)
                    sets.append(s)
                    ids.append(i)
            if not sets:
                continue
            n = np.array([len(s) for s in sets])
            x = np.concatenate(sets)
            rows = list(_rows_by(bucket_of(x << LOW, buckets), np.repeat(np.array(ids, np.int64), n),
                                 np.repeat(n.astype(np.uint32), n), x, None))
            for i in range(0, len(rows), 64):
                yield _batch(rows[i:i + 64])
    return deal


def _share(buckets: int):
    """In a bucket: the shingles of two classes or more, with their
    frequency in steps of an eighth of a power of two, to the classes' groups."""
    def share(rows: pa.Table) -> pa.Table:
        sets, sizes, x, _ = _read(rows.to_pylist())
        order = np.argsort(x)
        cut = runs(x[order])
        times = np.diff(np.append(cut, len(x)))
        order = order[np.repeat(times > 1, times)]
        order = order[np.lexsort((sets[order], x[order]))]
        s, y = sets[order], x[order]
        keep = np.concatenate([[True], (s[1:] != s[:-1]) | (y[1:] != y[:-1])]) if len(s) else np.empty(0, bool)
        order, s, y = order[keep], s[keep], y[keep]  # a class that several tasks have sent counts once
        cut = runs(y)
        times = np.diff(np.append(cut, len(y)))
        codes = np.repeat(np.minimum(255, np.floor(8 * np.log2(np.maximum(times, 1)))).astype(np.uint8), times)
        many = np.repeat(times > 1, times)
        order, s, y, codes = order[many], s[many], y[many], codes[many]
        out = list(_rows_by(bucket_of(mix64(s.view(np.uint64)), buckets), s, sizes[order], y, codes)) if len(s) else []
        return pa.Table.from_batches([_batch(out)] if out else [], schema=_SCHEMA)
    return share


def _least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def _order(percent: int):
    """In a group of classes: drops those that can't link, and puts the
    shared shingles of the others in the three orders, cut to the prefix."""
    def order(rows: pa.Table) -> pa.Table:
        sets, sizes, x, codes = _read(rows.to_pylist())
        by = np.lexsort((x, sets))
        sets, sizes, x, codes = sets[by], sizes[by], x[by], codes[by]
        cut = runs(sets)
        shared = np.diff(np.append(cut, len(sets)))
        out = []
        for a, m in zip(cut.tolist(), shared.tolist()):
            n = int(sizes[a])
            need = -(-n * percent // 100)
            if m < need:
                continue
            mine, code = x[a:a + m], codes[a:a + m]
            prefix = n - need + 1 - (n - m)  # shared shingles in the prefix, behind the n - m unshared
            one = np.lexsort((mix64(mine + np.uint64(101)), code))[:prefix]
            two = np.lexsort((mix64(mine + np.uint64(202)), code >> 3))[:prefix]
            three = np.argsort(mix64(mine + np.uint64(303)))[:prefix]
            signed = mine.astype(np.int64)
            out.append((int(sets[a]), n, n - m, signed.tolist(), signed[one].tolist(), code[one].tolist(),
                        signed[two].tolist(), signed[three].tolist()))
        if not out:
            return _CLASSES.empty_table()
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _CLASSES)], schema=_CLASSES)
    return order


def _verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a < b) that share prefix shingles under the second and
    third order as well, and whose sets link."""
    sets = classes.select("set_id", "n", "shingles", "second", "third")
    both = pairs
    for side in ("a", "b"):
        both = both.join(sets.select(*[F.col(c).alias(f"{side}_{c}") for c in sets.columns]),
                         F.col(side) == F.col(f"{side}_set_id"))
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return (both.filter(F.arrays_overlap("a_second", "b_second") & F.arrays_overlap("a_third", "b_third"))
            .filter((100 + percent) * common >= percent * (F.col("a_n") + F.col("b_n")))
            .select("a", "b"))


def _pair(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _prepared(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their classes, the classes that may link, and the lists
    of their prefix shingles."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(map_texts(docs, _sign(k), SIGNED), "shingle-sets")
    buckets = bucket_count(docs)
    classes = written(
        map_texts(docs, _deal(k, buckets), BLOBS).groupBy("bucket").applyInArrow(_share(buckets), BLOBS)
        .groupBy("bucket").applyInArrow(_order(percent), CLASSES), "shingle-classes")

    lists = classes.select("set_id", "n", "alone", F.explode(F.arrays_zip("first", "codes")).alias("p"), "first").select(
        "set_id", "n", "alone", F.col("p.first").alias("shingle"), F.col("p.codes").alias("code"),
        (F.col("alone") + F.array_position("first", F.col("p.first")) - 1).alias("place"))
    return signed, classes, lists


def _in_pieces(lists: DataFrame) -> DataFrame:
    """The lists, each cut into pieces of about PIECE classes by its frequency."""
    pieces = F.ceil(F.pow(F.lit(2.0), (F.col("code") + 1) / 8) / PIECE).cast("long")
    return lists.withColumn("pieces", pieces).withColumn("piece", F.pmod(F.xxhash64("set_id"), F.col("pieces")))


def _may_link(percent: int):
    """Length and position bounds of the list rows ``x`` and ``y``."""
    least = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    return ((100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
            & (F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) >= least)
            & (F.least(F.col("x.n") - F.col("x.alone"), F.col("y.n") - F.col("y.alone")) >= least))


def _class_links(classes: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Every pair (a < b) of classes that link. Each piece of a list meets
    itself and every other piece of the list under a key of their own."""
    cut = written(_in_pieces(lists).select("set_id", "n", "alone", "shingle", "place", "pieces", "piece"), "pieces")
    met = (cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
           .withColumn("low", F.least("piece", "other")).withColumn("high", F.greatest("piece", "other")))
    x, y = met.filter("piece = low").alias("x"), met.filter("piece = high").alias("y")
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.low") == F.col("y.low"))
                   & (F.col("x.high") == F.col("y.high"))
                   & ((F.col("x.low") < F.col("x.high")) | (F.col("x.set_id") < F.col("y.set_id")))
                   & _may_link(percent)).select(*_pair(F.col("x.set_id"), F.col("y.set_id"))).distinct()
    return written(_verified(written(pairs, "candidates"), classes, percent), "links")


def near_links(docs: DataFrame, k: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """The whole join: ``a, b, a_rows, b_rows`` per pair (a < b) of linked
    classes of different shingle sets, with the rows of ``docs`` in each (it
    stands for a_rows * b_rows links); and ``doc_id, set_id, n_links`` for
    every row: the other rows of its class and all rows of the linked ones."""
    signed, classes, lists = _prepared(docs, k, percent)
    links = _class_links(classes, lists, percent)
    sizes = written(signed.filter("set_id is not null").groupBy("set_id").agg(F.count("*").alias("rows")), "class-sizes")
    for side in ("a", "b"):
        links = links.join(sizes.select(F.col("set_id").alias(side), F.col("rows").alias(f"{side}_rows")), side)
    links = written(links.select("a", "b", "a_rows", "b_rows"), "sized-links")
    others = (links.select(F.col("a").alias("set_id"), F.col("b_rows").alias("others"))
              .unionAll(links.select(F.col("b").alias("set_id"), F.col("a_rows").alias("others")))
              .groupBy("set_id").agg(F.sum("others").alias("others")))
    counts = written(sizes.join(others, "set_id", "left").select(
        F.col("set_id").alias("_set"), (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "link-counts")
    return links, signed.join(counts, F.col("set_id") == F.col("_set"), "left").select(
        "doc_id", "set_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    signed, classes, lists = _prepared(docs, k, percent)

    # First round: pieces of the lists.
    piece = W.partitionBy("shingle", "piece").orderBy("alone", "n", "set_id")
    met = (_in_pieces(lists)
           .withColumn("head", F.first("set_id").over(piece)).withColumn("before", F.lag("set_id").over(piece)))
    heads = (met.filter("pieces > 1").groupBy("shingle", "piece").agg(F.min(F.struct("alone", "n", "set_id")).alias("h")))
    chain = W.partitionBy("shingle").orderBy("h")
    linked = heads.select(F.col("h.set_id").alias("x"), F.lag("h.set_id").over(chain).alias("y"),
                          F.first("h.set_id").over(chain).alias("z"))
    pairs = (met.select(*_pair("set_id", "head")).unionAll(met.select(*_pair("set_id", "before")))
             .unionAll(linked.select(*_pair("x", "y"))).unionAll(linked.select(*_pair("x", "z"))))
    pairs = written(pairs.filter("a < b").distinct(), "candidates")
    links = written(_verified(pairs, classes, percent), "links")
    known = components(links)

    # Second round: what may still connect two components.
    placed = written(lists.drop("code").join(known.withColumnRenamed("node", "set_id"), "set_id", "left")
                     .withColumn("root", F.coalesce("root", "set_id")), "lists")
    open_ = written(placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
                    .select("shingle"), "open-lists")
    still = placed.join(open_, "shingle", "left_semi")
    x, y = still.alias("x"), still.alias("y")
    across = (x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") < F.col("y.root")) & _may_link(percent))
              .select(*_pair(F.col("x.set_id"), F.col("y.set_id"))).distinct())
    more = written(_verified(written(across, "candidates"), classes, percent), "links")
    roots = components(links.unionAll(more))

    # The smallest document of each class, then of each component.
    least_doc = written(signed.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
                        .join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
                        .withColumn("root", F.coalesce("root", "set_id")), "set-roots")
    of_root = written(least_doc.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    of_set = written(least_doc.join(of_root, "root").select(F.col("set_id").alias("_set"), "component_id"), "set-components")
    return (signed.join(of_set, F.col("set_id") == F.col("_set"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def keep_smallest(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest
    id. Rows without an id stay; an id that stays keeps all its rows."""
    gone = written(near_components(docs, k, percent).filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(),
                   "near-copies")
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over every whole text of ``documents``: four words, 85 %."""
    return near_components(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, [w FOR w IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+') IF w <> ''] AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(words[p:p + 3], ' ') AS s
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 2, 2))) AS p FROM texts WHERE len(words) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
links AS (
  SELECT a.r AS x, b.r AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r
  JOIN sizes m ON m.r = a.r JOIN sizes n ON n.r = b.r
  GROUP BY a.r, b.r, m.n, n.n HAVING 185 * count(*) >= 85 * (m.n + n.n)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, least(t.doc_id, min(o.doc_id)) AS component_id
FROM texts t LEFT JOIN sizes s USING (r) LEFT JOIN reach ON reach.x = t.r LEFT JOIN texts o ON o.r = reach.y
GROUP BY t.r, t.doc_id, s.n
"""
