"""Operator 12, MinHash near-dedup by an inverted join of signature coordinates.

Documents with equal shingle sets are one class from the start. Every class
has ``COORDINATES`` MinHash values; each matches that of another class with
the Jaccard similarity of the two as probability. Two classes are candidates
if at least ``MATCHES`` of them match, and candidates link when the whole
sets have ``100 * intersection >= percent * union``.

1. Posting. A class is posted under each (coordinate, value). Values that one
   class only has can match nothing and end here; a class with fewer than
   ``MATCHES`` others is dropped.
2. Prefix. Two classes with that many matches share one of the rarest
   ``s - MATCHES + 1`` postings of either, ``s`` being its postings that are
   left. Only these prefixes make lists that are joined.
3. Skip merging. The long lists, outside the prefixes, are never merged: with
   every prefix posting goes the low byte of all the class's values, eight
   longs, in which the matches over all lists are counted at most once each and
   never missed. The join's condition counts them as two postings meet, so that only
   pairs above the threshold leave it. A first semi join, on counts over the low four bits
   alone, drops every class that has no candidate at all, which most classes haven't.
4. Rounds. Links are needed up to connection. In a round every class has
   proposals, of other components: the most central member of each of its lists (the one with
   the longest lists: the text that the others are copies of) and a neighbour.
   It keeps the best, which is verified; rounds go on while more than a tenth of
   the proposals link.
5. What the rounds left open, however much, is decided then. In the lists that
   still hold several components, the members that have a candidate in another component are
   found by semi joins, which make no pairs; they meet, by the largest component of their
   lists, in blocks of ``BLOCK`` by ``BLOCK`` whole sets, and every pair across components is compared.
   A list whose members are connected is joined no more, so that a group of
   near copies costs a few proposals each and no pairs.
6. Verification. The whole shingle sets are computed anew for the classes of
   candidates only, from one text of each.

With 64 coordinates and 32 matches a pair of similarity 0.8 is missed with
probability 2e-8 (none of higher similarity with more), one of 0.3 comes to
verification with 7e-4. Links are always exact.

Defined cases: null and wordless texts have no shingles, link with nothing
and are their own component; fewer words than a shingle are one shingle;
A-Z are lower-cased, nothing else; a null id has its class's component if
that has an id, else null, and is kept in the second case only; repeated rows
and ids are members each, and all rows of a kept id are kept; texts are read
whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .components import star_forest
from .op4_multi_order_join import set_id_of
from .tables import WordHashes, map_texts, sequence_hash, stepped as written, table, used_up, utf8_lists, window_hashes

COORDINATES = 64
MATCHES = 32
PIECE = 256
BLOCK = 128        # sets on either side of a block
BROADCAST_KEYS = 1_000_000  # 8 MB of longs
COLUMNS = 4096     # shingles of a block at a time
SEED = 12
BYTES = COORDINATES // 8
SIGNED = "doc_id long, text_key long, set_id long, n_shingles long, signature array<int>"


def shingles_of(text: bytes, k: int, words: WordHashes) -> np.ndarray:
    """Distinct 64-bit shingle hashes of a text, ascending."""
    h = words.of(text.lower().split())
    if not len(h):
        return np.empty(0, np.uint64)
    h = np.sort(window_hashes(h, k) if len(h) >= k else sequence_hash(h))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least value of each coordinate's own order of the shingles."""
    x, low = (shingles >> np.uint64(32)).astype(np.uint32), None
    for i in range(0, len(x), 2048):  # a block stays in the processor's cache
        y = x[i:i + 2048, None] * factors
        y ^= y >> np.uint32(16)
        y *= np.uint32(0x85EBCA6B)
        low = y.min(0) if low is None else np.minimum(low, y.min(0))
    return low


def _sign(k: int, seed: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        factors = np.random.default_rng(seed).integers(1 << 31, size=COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        for b in batches:
            sets, sizes, signs = [], [], []
            for t in utf8_lists(b, "text"):
                s = shingles_of(t, k, words)
                sizes.append(len(s))
                sets.append(set_id_of(s) if len(s) else None)
                signs.append(signature(s, factors).view(np.int32) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(signs, pa.list_(pa.int32()))],
                names=["doc_id", "text_key", "set_id", "n_shingles", "signature"])
    return sign


def _sets(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            found = [shingles_of(t, k, words) for t in utf8_lists(b, "text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_id_of(s) if len(s) else None for s in found], pa.int64()),
                 pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=["set_id", "shingles"])
    return sets


def _low_bytes() -> list[Column]:
    """The low bytes of all values, eight to a long."""
    out = []
    for j in range(BYTES):
        byte = [F.shiftleft((F.col("signature")[8 * j + i].bitwiseAND(255)).cast("long"), 8 * i) for i in range(8)]
        word = byte[0]
        for b in byte[1:]:
            word = word.bitwiseOR(b)
        out.append(word.alias(f"low{j}"))
    return out


LOW = [f"low{j}" for j in range(BYTES)]
_LAST_BITS = 0x0101010101010101
NIBBLES = [f"nibbles{j}" for j in range(BYTES // 2)]
_LOW_NIBBLES = 0x0F0F0F0F0F0F0F0F
_LAST_OF_NIBBLES = 0x1111111111111111


def _low_nibbles() -> list[Column]:
    """The low four bits of all values, sixteen to a long, from the low bytes."""
    half = [F.col(c).bitwiseAND(F.lit(_LOW_NIBBLES)) for c in LOW]
    return [half[j].bitwiseOR(F.shiftleft(half[j + len(NIBBLES)], 4)).alias(c) for j, c in enumerate(NIBBLES)]


def _nibble_matches(x: str, y: str) -> Column:
    """Equal nibbles: no fewer than ``_matches``."""
    total = F.lit(0)
    for c in NIBBLES:
        d = F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))
        for shift in (2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift))
        total = total + (16 - F.bit_count(d.bitwiseAND(F.lit(_LAST_OF_NIBBLES))))
    return total


def _matches(x: str, y: str) -> Column:
    """Equal bytes of the two sides' low bytes: no fewer than their equal values."""
    total = F.lit(0)
    for c in LOW:
        d = F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))
        for shift in (4, 2, 1):  # any bit of a byte reaches its last one, which no other byte's reach
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift))
        total = total + (8 - F.bit_count(d.bitwiseAND(F.lit(_LAST_BITS))))
    return total


def _may_link(x: str, y: str, percent: int, matches=_matches) -> Column:
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (matches(x, y) >= MATCHES)


def _lists(classes: DataFrame, percent: int) -> DataFrame:
    """The prefix postings of the classes that have a candidate: ``token, size`` (of the whole list),
    ``set_id, n``, the low bytes, and ``central``: the lengths of all its lists, as logarithms. Of
    a group of near copies the text that they are copies of is the most central."""
    value = F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    tokens = classes.select("set_id", F.posexplode("signature").alias("pos", "value")).select(
        "set_id", F.shiftleft(value, 6).bitwiseOR(F.col("pos").cast("long")).alias("token"))
    sizes = written(tokens.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1"), "posting-sizes")
    prefix = (tokens.join(sizes, "token").groupBy("set_id")
              .agg(F.sort_array(F.collect_list(F.struct("size", "token"))).alias("p"),
                   F.sum(F.log2("size")).alias("central"))
              .filter(F.size("p") >= MATCHES).select("set_id", "central", F.slice("p", 1, F.size("p") - MATCHES + 1).alias("p")))
    # A row per class: what its postings share is written, and dealt by class, once.
    prefixes = written(prefix.join(classes.select("set_id", "n", *_low_bytes()), "set_id"), "prefixes")
    used_up(sizes)
    # Most lists are chance meetings. A class without a candidate in any of its lists ends
    # here; the join makes no pairs, only members that have one.
    narrow = prefixes.select(F.explode("p.token").alias("token"), "set_id", "n", *_low_nibbles())
    met = ((F.col("x.token") == F.col("y.token")) & (F.col("x.set_id") != F.col("y.set_id"))
           & _may_link("x.", "y.", percent, _nibble_matches))
    partnered = written(narrow.alias("x").join(narrow.alias("y"), met, "left_semi").select("set_id").distinct(), "partnered")
    lists = written(prefixes.join(partnered, "set_id", "left_semi").select(F.explode("p").alias("p"), "set_id", "n", "central", *LOW)
                    .select("p.token", "p.size", "set_id", "n", "central", *LOW), "near-postings")
    used_up(prefixes, partnered)
    return lists


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, with the roots of their components) whose whole sets link."""
    both = pairs
    for side in ("a", "b"):
        both = both.join(sets.select(F.col("set_id").alias(side), F.col("shingles").alias(f"{side}_set")), side)
    common = F.size(F.array_intersect("a_set", "b_set"))
    return both.filter((100 + percent) * common >= percent * (F.size("a_set") + F.size("b_set"))).select(*PAIR)


def _shingle_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``set_id, shingles`` of the ``wanted`` classes, from one text of each."""
    keys = written(classes.join(wanted, "set_id", "left_semi").select("text_key"), "candidate-texts")
    # Few keys go to the texts; else every text is shuffled to meet them.
    few = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    texts = (docs.select(F.xxhash64("text").alias("text_key"), "text").join(few, "text_key", "left_semi")
             .dropDuplicates(["text_key"]).select("text"))
    # A class has one key, and a key one text: the sets needn't be dealt to drop repeats.
    return map_texts(texts, _sets(k), "set_id long, shingles array<long>").filter("set_id is not null")


PAIR = ["a", "b", "a_root", "b_root"]


def _pairs(x: str, y: str) -> list[Column]:
    first = F.col(f"{x}set_id") < F.col(f"{y}set_id")
    return [F.when(first, F.col(f"{i}{c}")).otherwise(F.col(f"{j}{c}")).alias(n)
            for n, i, j, c in (("a", x, y, "set_id"), ("b", y, x, "set_id"), ("a_root", x, y, "root"), ("b_root", y, x, "root"))]


def _joined(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` with the components that the links make of its components."""
    up = star_forest(links.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    return (placed.join(up.select(F.col("a").alias("root"), F.col("b").alias("up")), "root", "left")
            .withColumn("root", F.coalesce("up", "root")).drop("up"))


def _proposals(placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """For each class its best proposal: the most central member of one of its lists,
    or its neighbour in a piece of one, of another component."""
    me = F.struct("set_id", "n", "root", *LOW)
    # Only the lists where members of several components meet.
    hubs = written(placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                               F.max(F.struct("central", me.alias("y"))).alias("top"))
                   .filter("lo < hi").select("token", F.col("top.y").alias("hub")), "hubs")
    pieces = F.ceil(F.col("size") / PIECE).cast("long")
    by = W.partitionBy("token", "piece").orderBy("root", F.xxhash64(F.lit(turn), "set_id"))
    met = (placed.join(hubs, "token").withColumn("piece", F.pmod(F.xxhash64(F.lit(turn), "set_id"), pieces))
           .select(me.alias("x"), F.array("hub", F.lag(me).over(by)).alias("ys"))
           .select("x", F.explode("ys").alias("y")).filter("y is not null and x.root <> y.root"))
    met = met.filter(_may_link("x.", "y.", percent))
    best = met.groupBy(F.col("x.set_id").alias("x_set_id")).agg(
        F.max(F.struct(_matches("x.", "y.").alias("m"), F.col("y.set_id").alias("set_id"), F.col("y.root").alias("root"))).alias("y"),
        F.first("x.root").alias("x_root"))
    best = written(best.select("x_set_id", "x_root", F.col("y.set_id").alias("y_set_id"), F.col("y.root").alias("y_root"))
                   .select(*_pairs("x_", "y_")).distinct(), "candidates")
    used_up(hubs)
    return best


def _open_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """``bulk, set_id, root`` of the members of open lists that have a candidate in another
    component. Pairs are counted as their postings meet and leave no rows:
    a member is in or out with its first candidate."""
    counts = placed.groupBy("token", "root").agg(F.count("*").alias("count")).groupBy("token").agg(
        F.max(F.struct("count", "root")).alias("m"), F.count("*").alias("roots")).filter("roots > 1")
    bulk = written(counts.select("token", F.col("m.root").alias("bulk")), "largest-components")
    rows = written(placed.drop("central", "size").join(bulk, "token"), "open-postings")
    others = rows.filter("root <> bulk")
    met = (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & _may_link("x.", "y.", percent)
    # Of a pair at least one is outside the largest component.
    found = (others.alias("x").join(rows.alias("y"), met, "left_semi")
             .unionAll(rows.filter("root = bulk").alias("x").join(others.alias("y"), met, "left_semi")))
    members = written(found.select("bulk", "set_id", "root").distinct(), "candidate-members")
    used_up(rows, bulk)
    return members


def _links_in_block(percent: int):
    """Links between the components in a block of two sides' whole sets; of all that
    connect the same components one is enough."""
    def links(rows: pa.Table) -> pa.Table:
        side = rows["side"].to_numpy()
        root = rows["root"].to_numpy()
        sets = rows["shingles"].combine_chunks()
        if isinstance(sets, pa.ChunkedArray):
            sets = sets.chunk(0)
        starts = sets.offsets.to_numpy()
        values = sets.values.to_numpy()
        size = np.diff(starts)
        row = np.repeat(np.arange(len(size)), size)
        values = values[starts[0]:starts[-1]]
        shingle, column, times = np.unique(values, return_inverse=True, return_counts=True)
        keep = times[column] > 1
        row, column = row[keep], column[keep]
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        place = np.empty(len(size), np.int64)
        place[x], place[y] = np.arange(len(x)), np.arange(len(y))
        common = np.zeros((len(x), len(y)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        new = np.concatenate([[0], np.cumsum(column[1:] != column[:-1])]) if len(column) else column
        for low in range(0, int(new[-1]) + 1 if len(new) else 0, COLUMNS):
            a, b = np.searchsorted(new, [low, low + COLUMNS])
            r, c = row[a:b], new[a:b] - low
            left, right = np.zeros((len(x), COLUMNS), np.float32), np.zeros((len(y), COLUMNS), np.float32)
            on_x = side[r] == 0
            left[place[r[on_x]], c[on_x]] = 1
            right[place[r[~on_x]], c[~on_x]] = 1
            common += left @ right.T
        least = percent * (size[x][:, None] + size[y][None, :])
        i, j = np.nonzero(((100 + percent) * common >= least) & (root[x][:, None] != root[y][None, :]))
        found = np.unique(np.sort(np.stack([root[x][i], root[y][j]], 1), axis=1), axis=0) if len(i) else np.empty((0, 2), np.int64)
        return pa.table({"a_root": pa.array(found[:, 0], pa.int64()), "b_root": pa.array(found[:, 1], pa.int64())})
    return links


def _across(placed: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``a_root, b_root``: all links between components, exactly. The members that have a candidate
    meet by the largest component of their lists, block by block."""
    members = _open_pairs(placed, percent)
    sets = written(_shingle_sets(docs, classes, members.select("set_id").distinct(), k), "sets")
    full = members.join(members.groupBy("bulk").agg(
        F.ceil(F.count(F.when(F.col("root") != F.col("bulk"), 1)) / BLOCK).cast("int").alias("x_blocks"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("y_blocks")), "bulk").join(sets, "set_id")

    def dealt(side: int, rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("set_id"), F.col(f"{own}_blocks")).cast("int")
        return (rows.withColumn(f"{own}b", mine).withColumn(f"{other}b", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
                .select("bulk", "xb", "yb", F.lit(side).alias("side"), "root", "shingles"))
    both = dealt(0, full.filter("root <> bulk"), "x", "y").unionAll(dealt(1, full.filter("x_blocks > 0"), "y", "x"))
    return both.groupBy("bulk", "xb", "yb").applyInArrow(_links_in_block(percent), "a_root long, b_root long")


def _judged(docs: DataFrame, k: int, percent: int, seed: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id`` for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(map_texts(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), _sign(k, seed), SIGNED), "signatures")
    classes = written(signed.filter("set_id is not null").groupBy("set_id").agg(
        F.first("n_shingles").alias("n"), F.min("text_key").alias("text_key"), F.first("signature").alias("signature")), "classes")
    lists = _lists(classes, percent)

    def links_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        sets = written(_shingle_sets(docs, classes, wanted, k), "sets")
        links = written(_verified(pairs, sets, percent), "links")
        used_up(sets)
        return links

    last, placed, turn = lists, lists.withColumn("root", F.col("set_id")), 0
    fruitful = True
    while fruitful:
        proposed = _proposals(placed, turn, percent)
        found = links_of(proposed)
        placed, turn = written(_joined(placed, found), "placed"), turn + 1
        fruitful = 10 * found.count() > proposed.count()
        used_up(last, proposed, found)
        last = placed
    rest = written(_across(placed, docs, classes, k, percent), "links")
    roots = _joined(placed.select("set_id", "root").distinct(), rest)

    # The smallest document of each class, then of each component.
    least_doc = written(signed.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
                        .join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id")), "set-roots")
    used_up(classes, placed)
    of_root = written(least_doc.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    of_set = least_doc.join(of_root, "root").select(F.col("set_id").alias("_set"), "component_id")
    return (signed.drop("signature").join(of_set, F.col("set_id") == F.col("_set"), "left")
            .select("doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def near_components(docs: DataFrame, k: int = 2, percent: int = 80, seed: int = SEED) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    return _judged(docs, k, percent, seed).drop("text_key")


def keep_representatives(docs: DataFrame, k: int = 2, percent: int = 80) -> DataFrame:
    """``docs`` with the rows of the smallest id of each component; rows
    without an id stay where their component has none."""
    judged = _judged(docs, k, percent, SEED)
    gone = written(judged.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
                   .select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_key")).distinct(), "near-copies")
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.xxhash64("text") == F.col("_key")), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over every whole text of ``documents``: two words, 80 %."""
    return near_components(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, [w FOR w IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+') IF w <> ''] AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(words[p:p + 1], ' ') AS s
  FROM (SELECT r, words, unnest(range(1, greatest(len(words), 2))) AS p FROM texts WHERE len(words) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
-- A pair that links shares one of the n - ceil(0.8 n) + 1 rarest shingles of each side.
ranked AS (
  SELECT r, s, n, row_number() OVER (PARTITION BY r ORDER BY f, s) AS place
  FROM (SELECT r, s, count(*) OVER (PARTITION BY s) AS f FROM shingles) JOIN sizes USING (r)),
prefixes AS (SELECT r, s, n FROM ranked WHERE place <= n - ((80 * n + 99) // 100) + 1),
pairs AS (
  SELECT DISTINCT a.r AS x, b.r AS y FROM prefixes a JOIN prefixes b ON a.s = b.s AND a.r < b.r
  AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
linked AS (
  SELECT p.x, p.y FROM pairs p JOIN shingles a ON a.r = p.x JOIN shingles b ON b.r = p.y AND a.s = b.s
  JOIN sizes m ON m.r = p.x JOIN sizes n ON n.r = p.y
  GROUP BY p.x, p.y, m.n, n.n HAVING 180 * count(*) >= 80 * (m.n + n.n)),
links AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
parts AS (
  SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, least(t.doc_id, min(o.doc_id)) AS component_id
  FROM texts t LEFT JOIN sizes s USING (r) LEFT JOIN reach ON reach.x = t.r LEFT JOIN texts o ON o.r = reach.y
  GROUP BY t.r, t.doc_id, s.n)
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM parts
"""
