"""Operator 13, grouping of spelling variants by asymmetric q-chunks.

1. Words. A map counts the runs of letters of every whole text, word by word,
   and sends each different word with its count, once per about
   ``WORDS_HELD`` different words; counts are added by word.
2. Chunks and grams. Of two words one edit apart, the longer one (of equally
   long ones, either) is split into two disjoint chunks of half its length, at
   its start and at its end: one edit leaves a chunk whole, moved by one place at
   most. The other word contributes its positional grams of that length. Equal
   chunk and gram within a shift of one meet, and a candidate is verified at
   once, by its edit distance in code points. The shift is known: none for a chunk at the
   start, the difference of the lengths (none or one) for one at the end,
   whose place is therefore the same counted from the end. Grams of other
   places can meet nothing and aren't made, so a word yields at most six
   rows, however long it is.
3. Forms. A word's form is its near word of largest count, if that is at least
   ``dominance`` times its own. Counts grow by that factor along forms, so
   chains are short; roots are found by doubling the step.

A word that a third of all texts hold is one row after the map; equi-joins on frequent
chunks are split by adaptive execution.

The contract's words have a typing error put in: the run of a document whose
checksum with the document's id 31 divides loses a code point (``noise``). :func:`near_words` and
:func:`forms` take any table of words and counts.

Defined cases: null and empty texts have no words; a null id is the empty
string in the checksum; repeated rows and ids count as often as they stand;
a word without near words has a null form and is its own root; of equally
frequent near words the first in code-point order is the form; texts and
words are read whole, whatever their length; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import map_texts, table, written

LEAST_LENGTH = 7
LEAST_COUNT = 2
DOMINANCE = 10
NOISE = 31
WORDS_HELD = 100_000
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(run: str) -> str:
    """A-Z in lower case, nothing else."""
    return run.lower() if run.isascii() else run.translate(AZ)


def _count(noise: int | None, least_length: int):
    run = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                mine: Counter = Counter(run.findall(text.as_py() or ""))
                if not mine:
                    continue
                before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for raw, n in mine.items():
                    word = lowered(raw)
                    if noise and (h := zlib.crc32(word.encode(), before)) % noise == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= WORDS_HELD:
                    yield batch(counts)
                    counts.clear()
        if counts:
            yield batch(counts)
    return count


def word_counts(docs: DataFrame, noise: int | None = NOISE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the texts of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").filter("text is not null")
    return (map_texts(docs, _count(noise, least_length), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


def near_words(words: DataFrame) -> DataFrame:
    """``word, near``: every ordered pair of words of two code points or more
    (distinct in ``words``) exactly one insertion, deletion or replacement apart."""
    words = words.select("word", F.length("word").cast("int").alias("l"))
    start, end = 0, 1  # a place counts from the start or from the end of its word

    def parts(size):  # both ends of the word, as hashes
        return F.inline(F.array(F.struct(F.lit(start).alias("side"), F.xxhash64(F.substring("word", F.lit(1), size)).alias("h")),
                                F.struct(F.lit(end).alias("side"), F.xxhash64(F.substring("word", F.col("l") - size + 1, size)).alias("h"))))

    chunks = words.withColumn("q", F.expr("l div 2").cast("int")).select("word", "l", "q", parts(F.col("q")))
    # The chunks of a word of length l or l + 1 are so long.
    grams = (words.withColumn("q", F.explode(F.array_distinct(F.expr("array(int(l div 2), int((l + 1) div 2))"))))
             .select("word", "l", "q", parts(F.col("q"))))
    c, g = chunks.alias("c"), grams.alias("g")
    met = c.join(g, (F.col("c.q") == F.col("g.q")) & (F.col("c.side") == F.col("g.side")) & (F.col("c.h") == F.col("g.h"))
                 & ((F.col("c.l") == F.col("g.l") + 1) | ((F.col("c.l") == F.col("g.l")) & (F.col("c.word") < F.col("g.word"))))
                 & (F.levenshtein(F.col("c.word"), F.col("g.word"), 1) == 1))
    pairs = met.select(F.col("c.word").alias("a"), F.col("g.word").alias("b")).distinct()
    return pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
                                          F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("p")).select("p.word", "p.near")


def forms(words: DataFrame, near: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (word, n)."""
    with_counts = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = (with_counts.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("top"))
            .select("word", "n_near", F.col("top.near").alias("top"), (-F.col("top.minus")).alias("top_n")))
    ok = F.col("top_n") >= dominance * F.col("n")
    judged = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(ok, F.col("top")).alias("form"), F.when(ok, F.col("top_n")).alias("form_n")), "spelling-forms")

    hops = written(judged.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-hops")
    while True:  # each turn doubles the step; counts grow along it, so there is no way round
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if hops.join(ahead, "root", "left_semi").isEmpty():
            break
        hops = written(hops.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-hops")
    return judged.join(hops, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, noise: int | None = NOISE, dominance: int = DOMINANCE) -> DataFrame:
    words = written(word_counts(docs, noise), "spelling-words")
    return forms(words, written(near_words(words), "spelling-near"), dominance)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over every whole text of ``documents``."""
    return variants(table(spark, sf_dir, "documents"))


# The checksum is taken bit by bit (polynomial EDB88320) over the UTF-8 bytes of
# each different (document, word).
ORACLE_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT doc_id, w, n, list_transform(range(1, length(x), 2), lambda i: ('0x' || substring(x, i, 2))::BIGINT) AS b
  FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM runs)),
crc_table AS (SELECT list(v ORDER BY k) AS t FROM (
  SELECT k, list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k::BIGINT) AS v FROM range(0, 256) r(k))),
sums AS (
  SELECT doc_id, w, n, xor(list_reduce(b, lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295) AS h
  FROM bytes, crc_table),
spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substring(w, 1, h % length(w)) || substring(w, h % length(w) + 2) ELSE w END AS word, n FROM sums),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (
  SELECT word, length(word) AS l, i, substring(word, 1, i - 1) || substring(word, i + 1) AS cut
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.l = b.l AND a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.cut = b.word),
ranked AS (
  SELECT a.word, a.near, w.n, count(*) OVER (PARTITION BY a.word) AS n_near,
    row_number() OVER (PARTITION BY a.word ORDER BY w.n DESC, a.near) AS place
  FROM near a JOIN words w ON w.word = a.near),
judged AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN r.near END AS form,
    CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
ways(word, here, step) AS (
  SELECT word, word, 0 FROM judged
  UNION ALL SELECT ways.word, judged.form, step + 1 FROM ways JOIN judged ON judged.word = ways.here WHERE judged.form IS NOT NULL)
SELECT j.word, j.form, r.root, j.n, j.n_near, j.form_n
FROM judged j JOIN (SELECT word, arg_max(here, step) AS root FROM ways GROUP BY word) r USING (word)
"""
