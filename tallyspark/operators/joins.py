"""Left join that spreads never-matching keys over the shuffle.

NULL keys (and keys that can never equal any right-side key, e.g. a text id
that is not a number when the right side is numeric) would all hash to one
reducer, or be read by a second scan if they were split off. They get a join
key of their own instead, which matches nothing and is spread by a hash of
the row; the result equals the plain left join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     eligible: Column, spread_by: str) -> DataFrame:
    """``left LEFT JOIN right ON left[left_key] = right[right_key]`` on text
    keys.

    ``eligible`` must be false only for left rows that cannot match any right
    row (NULL-safe: a NULL predicate counts as not eligible); no right key may
    begin with ``!``.
    """
    own = F.concat(F.lit("!"), F.xxhash64(spread_by).cast("string"))
    keyed = left.withColumn("_join_key", F.when(F.coalesce(eligible, F.lit(False)), F.col(left_key)).otherwise(own))
    return keyed.join(right, F.col("_join_key") == right[right_key], "left").drop("_join_key")
