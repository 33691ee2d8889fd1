"""Latest-version dedup (O1) and first-row-per-key.

``dedup_latest`` is the ``row_number() ... = 1`` pattern. Spark plans it with
a partial ``WindowGroupLimit`` before the shuffle, so a key with millions of
versions sends at most one row per map partition to the reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column],
                 rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (a total order should
    end in a tiebreak column so the result is deterministic)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` tuple.

    Written as an aggregate of ``min(struct(order..., rest...))`` so partial
    aggregation collapses each key map-side: a key holding a third of all rows
    costs one row per map partition in the shuffle. Rows with a NULL key are
    dropped (an equi-join never matches them).
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_first")
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(packed)
    return out.select(key, *[F.col("_first")[c].alias(c) for c in list(order) + rest])
