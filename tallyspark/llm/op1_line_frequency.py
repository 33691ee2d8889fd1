"""Operator 1, quality rules by cross-document line frequency.

DataFrame expressions only. One pass over the texts computes the rule counts
and, per line, a hash of the normalised line and its words; that narrow table
is written. Lines are then counted in different documents per host (copies of
a whole document count once, so a copied document is not boilerplate), lines
above the limits are removed, and a document that keeps less than
``least_left`` of its words is rejected.

A line is above the limit if at least ``min_docs`` different documents of its
host have it, whatever the number of other documents there. A ``min_share`` of the host's
documents can be asked for besides; by default there is none. The host is the
column ``source``.

Words in repeated 3-word windows, within one row and without exploding it:
each window becomes one long, 40 bits of its hash above 24 bits of position;
in sorted order repeated windows are neighbours, which are compared word by
word (texts beyond 2^24 words use a struct of the whole hash and position).

Defined cases: a null text is empty and fails the base rules; a null source
is a host of its own; lines without words are no lines; repeated rows and ids
are judged each; the smallest counts decide ties by themselves; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import SPACES, table, words_of, written

POSITION_BITS = 24


def with_repeated_window_words(rows: DataFrame) -> DataFrame:
    """``rows`` (words, n_words) plus ``n_repeat_words``: words that lie in a
    3-word window found twice or more. The sorted keys are a column of their
    own, since the comparison with their neighbours reads them again."""
    words, n = F.col("words"), F.col("n_words")
    windows = F.when(n >= 3, F.sequence(F.lit(0), n.cast("int") - 3)).otherwise(F.array().cast("array<int>"))
    brief = n < (1 << POSITION_BITS)
    low = F.lit((1 << POSITION_BITS) - 1)

    def hashed(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def same(p: Column, q: Column) -> Column:
        return ((F.get(words, p) == F.get(words, q)) & (F.get(words, p + 1) == F.get(words, q + 1))
                & (F.get(words, p + 2) == F.get(words, q + 2)))

    def repeats(keys: Column, key, place) -> Column:
        def equal(x, y):
            return F.coalesce((key(x) == key(y)) & same(place(x), place(y)), F.lit(False))
        return F.transform(F.filter(keys, lambda x, i: equal(x, F.get(keys, i + 1)) | equal(x, F.get(keys, i - 1))), place)

    packed = F.sort_array(F.transform(windows, lambda i: hashed(i).bitwiseAND(F.lit(-1 << POSITION_BITS))
                                      .bitwiseOR(i.cast("long"))))
    wide = F.sort_array(F.transform(windows, lambda i: F.struct(hashed(i).alias("h"), i.alias("p"))))
    keyed = rows.withColumn("packed", F.when(brief, packed)).withColumn("wide", F.when(~brief, wide))
    found = keyed.withColumn("places", F.sort_array(F.coalesce(
        repeats(F.col("packed"), lambda x: F.shiftright(x, POSITION_BITS), lambda x: x.bitwiseAND(low).cast("int")),
        repeats(F.col("wide"), lambda x: x["h"], lambda x: x["p"]))))
    covered = F.aggregate(
        "places", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"])
    return found.withColumn("n_repeat_words", covered.cast("long")).drop("packed", "wide", "places")


def measure(docs: DataFrame) -> DataFrame:
    """Rule counts and line hashes of every row of ``docs`` (doc_id, text,
    source), one map."""
    text = F.coalesce(F.col("text"), F.lit(""))
    normal = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "0"), r"[\x20\x09\x0B-\x0D]+", " ")
    has_word = lambda line: F.btrim(line, F.lit(SPACES)) != ""
    counted = docs.select(
        "doc_id", F.col("source").alias("host"), text.alias("text"), words_of(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), has_word).alias("raw_lines"),
        F.filter(F.split(normal, "\n"), has_word).alias("lines"))
    counted = with_repeated_window_words(counted.withColumn("n_words", F.size("words").cast("long")))
    return counted.select(
        "doc_id", "host", F.xxhash64("text", F.lit(1)).alias("text_hash"), "n_words",
        F.char_length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform("lines", lambda x: F.struct(
            F.xxhash64(F.btrim(x)).alias("line"),
            F.size(F.split(F.btrim(x), " ")).alias("words"))).alias("lines"))


def judge(docs: DataFrame, min_docs: int = 10, min_share: float = 0.0, least_left: float = 0.3,
          least_words: int = 50) -> DataFrame:
    """``doc_id``, the rule counts, ``n_boilerplate_words`` (of removed
    lines), ``base_failed`` and ``kept`` for every row of ``docs``."""
    rows = written(measure(docs).withColumn("row", F.monotonically_increasing_id()), "line-hashes")
    lines = rows.select("row", "host", "text_hash", F.explode("lines").alias("l"))
    different = (lines.groupBy("host", F.col("l.line").alias("line"), "text_hash").agg(F.lit(1).alias("one"))
                 .groupBy("host", "line").agg(F.count("*").alias("n_docs")))
    frequent = different.filter(F.col("n_docs") >= min_docs)
    if min_share:
        hosts = (rows.groupBy("host", "text_hash").agg(F.lit(1).alias("one"))
                 .groupBy(F.col("host").alias("_h")).agg(F.count("*").alias("host_docs")))
        frequent = (frequent.join(hosts, F.col("host").eqNullSafe(F.col("_h")))
                    .filter(F.col("n_docs") >= min_share * F.col("host_docs")))
    frequent = frequent.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    removed = (lines.select("row", "host", "l.line", "l.words")
               .join(frequent, F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")), "left_semi")
               .groupBy("row").agg(F.sum("words").alias("n_boilerplate_words")))
    base_failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_boilerplate_words") < least_left * F.col("n_words")
    return (rows.drop("lines", "text_hash").join(removed, "row", "left")
            .withColumn("n_boilerplate_words", F.coalesce("n_boilerplate_words", F.lit(0)).cast("long"))
            .select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "n_boilerplate_words", base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over every whole text of ``documents``."""
    return judge(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text", "source"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words
  FROM documents),
windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1), (SELECT unnest([0, 1, 2]) AS k)
  GROUP BY r),
lines AS (
  SELECT r, source, text, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM (
    SELECT r, source, text, unnest(string_split(regexp_replace(regexp_replace(lower(text), '[0-9]+', '0', 'g'),
                                                               '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))) AS line
    FROM texts)),
solid AS (SELECT *, len(string_split(line, ' ')) AS n FROM lines WHERE line <> ''),
frequent AS (SELECT source, line FROM solid GROUP BY source, line HAVING count(DISTINCT text) >= 10),
gone AS (
  SELECT s.r, sum(s.n) AS n FROM solid s
  WHERE EXISTS (SELECT 1 FROM frequent f WHERE f.line = s.line AND f.source IS NOT DISTINCT FROM s.source) GROUP BY 1),
raw AS (
  SELECT r, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS x FROM texts),
counted AS (
  SELECT t.doc_id, t.source AS host, CAST(len(t.words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum([length(w) FOR w IN t.words]), 0) AS BIGINT) AS word_chars,
    CAST(length(t.text) - length(translate(t.text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(raw.x) - len(list_distinct(raw.x)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_boilerplate_words
  FROM texts t JOIN raw USING (r) LEFT JOIN covered c USING (r) LEFT JOIN gone g USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND NOT (n_words - n_boilerplate_words < 0.3 * n_words) AS kept FROM judged
"""
