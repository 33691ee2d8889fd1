"""Operator 2, mixing sources to target weights by Sainte-Lague apportionment.

DataFrame expressions only. The mix is made of equal blocks of ``block_words``
words:

1. Targets. Sources, by code point with null last, weigh 3, 1, 2, repeating,
   and share ``share`` times all words. No target exceeds ``cap`` times its
   source; the excess is shared again by weight. In order of cap per weight,
   prefix sums give the one water level at which the targets add up.
2. Apportionment. The mix has as many blocks as fit its words. They are given
   to the sources by highest quotient target / (2 s - 1), and again, within
   each source, to its shards by highest quotient size / (2 s - 1): integer
   quotas per shard. Rounding every vote gives all seats but a few; only the
   quotients next to that are listed and ranked (:func:`apportion`).
3. Selection. A shard's documents form one stream of words, cut into blocks.
   A quota beyond the whole stream takes it whole, once or twice; the rest is
   taken from blocks in a seeded order, the last one in part.

Shards are hashes of the document id, about ``shard_words`` words each, so a
source of any share of the rows is spread over as many shards as it needs,
and every window runs over one shard, or over one row per source or shard.

Defined cases: a null or wordless text has size 0 and is taken 0 times; a
null source is a source of its own; documents with equal ids share a place in
the order by size; repeated rows count each; other columns are ignored; an
empty table, or one without words, gives targets of 0 or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .tables import n_words_of, table, written


def _draw(seed: int, *columns: str) -> Column:
    """A seeded order: md5 of the values."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]))


def source_targets(sources: DataFrame, share: float = 1.5, cap: float = 2.0,
                   weights: tuple[float, ...] = (3.0, 1.0, 2.0)) -> DataFrame:
    """``sources`` (source, source_size) plus ``rank`` (1, 2, ...) and
    ``target``. One row per source."""
    every = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.col("rank") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    ranked = (sources.withColumn("rank", F.row_number().over(every))
              .withColumn("weight", weight)
              .withColumn("most", cap * F.col("source_size").cast("double")))
    level = W.orderBy(F.col("most") / F.col("weight"), "rank")
    whole = W.partitionBy()
    wet = (ranked
           .withColumn("all", share * F.sum("source_size").over(whole).cast("double"))
           .withColumn("below", F.coalesce(F.sum("most").over(level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("above", F.sum("weight").over(level.rowsBetween(W.currentRow, W.unboundedFollowing)))
           .withColumn("height", (F.col("all") - F.col("below")) / F.col("above"))
           .withColumn("open", F.col("height") <= F.col("most") / F.col("weight"))
           .withColumn("water", F.min(F.when(F.col("open"), F.struct(F.col("most") / F.col("weight"), "rank", "height")))
                       .over(whole)["height"]))
    return wet.select("source", "source_size", "rank",
                      F.least("most", F.coalesce(F.col("water") * F.col("weight"), F.col("most"))).alias("target"))


def apportion(rows: DataFrame, group: str, key: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Lague: (group, key, quota) for ``rows``, one per group and key,
    where the column ``seats`` holds the seats of the whole group. Equal
    quotients go to the smaller key.

    With v votes of V and n seats of N, rounding v N / V is the result of some
    divisor, at most parties / 2 seats off; seats beyond that one are found
    within (parties / 2 + 2) v / V + 1 places of a party's rounded number."""
    g = W.partitionBy(group)
    v = F.col(votes).cast("double")
    fair = F.when((F.col("_all") > 0) & (F.col(seats) > 0), v * F.col(seats) / F.nullif(F.col("_all"), F.lit(0.0)))
    start = (rows.select(group, key, v.alias("_v"), F.col(seats).cast("long").alias(seats))
             .withColumnRenamed("_v", votes)
             .withColumn("_all", F.sum(votes).over(g))
             .withColumn("_n", F.count("*").over(g))
             .withColumn("_first", F.coalesce(F.floor(fair + 0.5), F.lit(0)).cast("long"))
             .withColumn("_open", F.when(F.col("_all") > 0, F.col(seats) - F.sum("_first").over(g)).otherwise(F.lit(0))))
    reach = F.ceil(F.col(votes) / F.col("_all") * (F.col("_n") / 2 + 2)) + 1
    more = F.col("_open") > 0
    near = (start.filter(F.col("_open") != 0)
            .select(group, key, votes, "_first", "_open", F.explode(F.sequence(F.lit(1), reach.cast("int"))).alias("_k"))
            .withColumn("_seat", F.when(more, F.col("_first") + F.col("_k")).otherwise(F.col("_first") - F.col("_k") + 1))
            .filter(F.col("_seat") >= 1)
            .withColumn("_quotient", F.col(votes) / (2 * F.col("_seat") - 1)))
    sign = F.when(more, -1).otherwise(1)
    order = W.partitionBy(group).orderBy(sign * F.col("_quotient"), -sign * F.col(key), -sign * F.col("_seat"))
    change = (near.withColumn("_place", F.row_number().over(order))
              .filter(F.col("_place") <= F.abs("_open"))
              .groupBy(group, key).agg(F.sum(-sign).alias("_change")))
    return (start.join(change, [group, key], "left")
            .select(group, key, (F.col("_first") + F.coalesce("_change", F.lit(0))).alias("quota")))


def mix(docs: DataFrame, block_words: int = 32, shard_words: int = 1 << 19, seed: int = 11, share: float = 1.5,
        cap: float = 2.0, weights: tuple[float, ...] = (3.0, 1.0, 2.0)) -> DataFrame:
    """``doc_id, size, source, source_size, target, shard, taken`` for every
    row of ``docs`` (doc_id, text, source)."""
    sizes = written(docs.select("doc_id", "source", n_words_of(F.col("text")).alias("size")), "mix-sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    shards_of = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    sources = written(source_targets(totals, share, cap, weights).withColumn("shards", shards_of), "mix-sources")

    all_words = F.sum("target").over(W.partitionBy())
    by_source = apportion(sources.withColumn("blocks", F.floor(all_words / block_words + 0.5)).withColumn("mix", F.lit(0)),
                          "mix", "rank", "target", "blocks")

    drawn = F.conv(F.substring(_draw(seed, "doc_id"), 1, 8), 16, 10).cast("long")
    named = sources.select(F.col("source").alias("_s"), "source_size", "target", "rank", "shards")
    stream = W.partitionBy("rank", "shard").orderBy(F.col("doc_id").asc_nulls_last(), "size")
    placed = (sizes.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("shard", drawn % F.col("shards")).drop("shards")
              .withColumn("end", F.sum("size").over(stream.rowsBetween(W.unboundedPreceding, W.currentRow))))
    placed = written(placed, "mix-placed")

    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("words"))
    quotas = (apportion(shards.join(by_source.select("rank", F.col("quota").alias("blocks")), "rank"),
                        "rank", "shard", "words", "blocks")
              .join(shards, ["rank", "shard"])
              .filter(F.col("words") > 0)
              .withColumn("wanted", F.least(F.col("quota") * block_words, F.floor(cap * F.col("words"))))
              .select("rank", "shard", "words", F.expr("wanted div words").alias("passes"),
                      F.expr("wanted % words").alias("rest")))

    # A row of a shard becomes all its blocks: the shards are dealt out first, over a
    # number of tasks that adaptive execution doesn't lower for the few rows they still are.
    quotas = quotas.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "shard")
    shard = W.partitionBy("rank", "shard")
    length = F.least(F.lit(block_words), F.col("words") - F.col("block") * block_words)
    before = W.unboundedPreceding, -1
    blocks = (quotas.filter(F.col("rest") > 0)
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(words - 1) div {block_words}"))))
              .withColumn("length", length)
              .withColumn("gone", F.coalesce(F.sum("length").over(
                  shard.orderBy(_draw(seed, "rank", "shard", "block"), "block").rowsBetween(*before)), F.lit(0)))
              .withColumn("take", F.greatest(F.lit(0), F.least("length", F.col("rest") - F.col("gone"))))
              .withColumn("taken_before", F.coalesce(F.sum("take").over(
                  shard.orderBy("block").rowsBetween(*before)), F.lit(0)))
              .select("rank", "shard", "block", "take", "taken_before"))

    # Words taken from the start of the stream up to a place: one look-up for
    # a document's first word, one for its last.
    def upto(place: Column) -> Column:
        return F.coalesce(F.col("taken_before") + F.least("take", place - F.col("block") * block_words), F.lit(0))

    start, last = F.col("end") - F.col("size"), F.col("end") - 1
    keys = ["rank", "shard", "block"]
    to_start = (placed.withColumn("block", F.expr(f"(end - size) div {block_words}"))
                .join(blocks, keys, "left").withColumn("from_start", upto(start))
                .drop("block", "take", "taken_before"))
    both = (to_start.withColumn("block", F.expr(f"(end - 1) div {block_words}"))
            .join(blocks, keys, "left").withColumn("to_end", upto(last + 1))
            .join(quotas.select("rank", "shard", "passes"), ["rank", "shard"], "left"))
    taken = F.when(F.col("size") > 0, F.coalesce("passes", F.lit(0)) * F.col("size")
                   + F.col("to_end") - F.col("from_start")).otherwise(F.lit(0))
    return both.select("doc_id", "size", "source", "source_size", "target", "shard", taken.cast("long").alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text", "source")
    return mix(docs)


# Every quotient listed and ranked, where the operator ranks only those next to the rounded votes.
ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         len([w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> '']) AS size
  FROM documents),
totals AS (SELECT source, sum(size) AS source_size FROM docs GROUP BY 1),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
         2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS whole
  FROM totals),
levels AS (
  SELECT *, (whole - coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS height
  FROM ranked),
water AS (SELECT height FROM levels WHERE height <= most / weight ORDER BY most / weight, rank LIMIT 1),
targets AS (
  SELECT source, source_size, rank, least(most, coalesce((SELECT height FROM water) * weight, most)) AS target,
         CAST(greatest(1, ceil(source_size / 524288.0)) AS BIGINT) AS shards
  FROM ranked),
seats AS (SELECT CAST(floor(sum(target) / 32 + 0.5) AS BIGINT) AS n, count(*) AS parties FROM targets),
by_source AS (
  SELECT rank, count(*) AS blocks FROM (
    SELECT rank, row_number() OVER (ORDER BY target / (2 * s - 1) DESC, rank) AS place
    FROM (SELECT rank, target, unnest(range(1, CAST(target / 32 AS BIGINT) + (SELECT parties FROM seats) + 3)) AS s
          FROM targets WHERE target > 0))
  WHERE place <= (SELECT n FROM seats) GROUP BY 1),
placed AS (
  SELECT d.*, t.source_size, t.target, t.rank,
         ('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 8))::BIGINT % t.shards AS shard
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
streamed AS (
  SELECT *, sum(size) OVER (PARTITION BY rank, shard ORDER BY doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM placed),
shards AS (
  SELECT p.rank, p.shard, sum(p.size) AS words, count(*) OVER (PARTITION BY p.rank) AS parties
  FROM placed p GROUP BY 1, 2),
quotas AS (
  SELECT s.rank, s.shard, s.words, least(32 * count(q.s), 2 * s.words) AS wanted
  FROM shards s LEFT JOIN (
    SELECT x.*, row_number() OVER (PARTITION BY rank ORDER BY words / (2 * s - 1) DESC, shard) AS place, b.blocks
    FROM (SELECT *, unnest(range(1, CAST(2 * words / 32 AS BIGINT) + parties + 3)) AS s FROM shards WHERE words > 0) x
    JOIN by_source b USING (rank)) q ON q.rank = s.rank AND q.shard = s.shard AND q.place <= q.blocks
  GROUP BY 1, 2, 3),
blocks AS (
  SELECT rank, shard, block, least(32, words - 32 * block) AS length, wanted % words AS rest
  FROM (SELECT *, unnest(range(0, CAST(ceil(words / 32.0) AS BIGINT))) AS block FROM quotas WHERE words > 0)),
drawn AS (
  SELECT *, greatest(0, least(length, rest - coalesce(sum(length) OVER (
    PARTITION BY rank, shard ORDER BY md5('11:' || rank || ':' || shard || ':' || block), block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS take
  FROM blocks),
covered AS (
  SELECT s.r, sum(greatest(0, least(s.upto, 32 * d.block + d.take) - greatest(s.upto - s.size, 32 * d.block))) AS n
  FROM streamed s JOIN drawn d ON s.rank = d.rank AND s.shard = d.shard
    AND 32 * d.block < s.upto AND 32 * d.block + d.take > s.upto - s.size
  WHERE s.size > 0 GROUP BY 1)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, s.source, CAST(s.source_size AS BIGINT) AS source_size, s.target, s.shard,
       CAST(CASE WHEN s.size = 0 THEN 0 ELSE (q.wanted // q.words) * s.size + coalesce(c.n, 0) END AS BIGINT) AS taken
FROM streamed s JOIN quotas q USING (rank, shard) LEFT JOIN covered c USING (r)
"""
