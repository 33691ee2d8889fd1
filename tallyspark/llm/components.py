"""Connected components by alternating large and small stars, with written
rounds: joins and partial minima only. The minima are written before they are
joined, so both sides of a join have shuffles of their own and adaptive
execution can split the one that holds a node with very many neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is nobody's smaller end: the smaller ends are
    the smallest nodes of their components then, and the edges the result."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("root")))
    return not ends.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("root").alias("root")).filter(
        "ups > 1 or ups = 1 and root = 1").agg(F.count("*")).first()[0]


def star_forest(edges: DataFrame) -> DataFrame:
    """(a, b): the smallest node b that each node a of ``edges`` (a, b: long) reaches, for
    all nodes but those smallest ones."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), "edges")
    while not _is_star_forest(now):
        # Large star: the larger neighbours of a node go to the smallest of all.
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        # Small star: a node and its smaller neighbours go to the smallest of those.
        large = written(large, "edges")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select("a", F.col("m").alias("b"))).filter("a <> b"))
        now = written(small.distinct(), "edges")
    return now


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b:
    long) reaches, the roots included."""
    now = star_forest(edges)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
