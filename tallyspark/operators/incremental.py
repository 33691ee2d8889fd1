"""Incremental facts: the lookback window (O3) and the keyed merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators import versions
from tallyspark.session import fresh_path


def lookback_bound(target: DataFrame | None, ts_col: str, lookback: str, floor: str) -> Column:
    """``coalesce(max(target.ts_col) - lookback, floor)`` as a scalar column.

    The bound is read from the *target* fact (quirk D1: the reference reads a
    column the staging model does not have). On a first run (no target) the
    floor is used, which admits every row.
    """
    floor_col = F.lit(floor).cast("timestamp")
    if target is None:
        return floor_col
    mx = target.agg(F.max(ts_col).alias("_mx")).select(
        (F.col("_mx") - F.expr(lookback)).alias("_b"))
    # One-row scalar subquery: evaluated once, then a literal in the filter.
    return F.coalesce(mx.scalar(), floor_col)


def changed_since(updates: DataFrame, ts_col: str, bound: Column) -> DataFrame:
    """O3: rows with ``ts_col >= bound``."""
    return updates.where(F.col(ts_col) >= bound)


def merge_into(target: DataFrame | None, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Update-all / insert-all on ``key``; target rows not in ``updates``
    are kept; no deletes.

    Written as ``updates UNION (target ANTI JOIN updates ON key)``. The caller
    writes the result to a new version location (never over the path being
    read); with a merge-capable table format use ``MERGE INTO`` instead.
    """
    if target is None:
        return updates
    keys = list(key)
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return updates.unionByName(kept.select(*updates.columns))


def merge_partitions(path: str, updates: DataFrame, key: Sequence[str], part_col: str) -> versions.Version:
    """O4 on a versioned table (``operators.versions``) partitioned by
    ``part_col`` (NULL is a partition as any other): one new version, in which
    only the partitions that the merge touches have new folders.

    Touched = partitions of the updates, plus partitions where an updated key
    lives now (a key whose partition value changed leaves its old partition;
    one left without rows is in the new version no more). A merge that breaks
    off anywhere leaves the old version or the new one, and a rerun merges into that.
    """
    spark = updates.sparkSession
    keys, schema = list(key), updates.schema
    base = versions.current(spark, path)
    if base is None:
        return versions.replace(updates, path, part_col, None)
    # The delta (one lookback window: small in steady state) is computed once
    # and staged as a table; the checks and the write below all read it.
    staged = fresh_path(spark, "merge-updates")
    updates.write.parquet(staged)
    updates = spark.read.schema(schema).parquet(staged)
    upd_keys = updates.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same_key = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    value = versions.partition_value(part_col).alias("value")
    # Only the key and partition columns of the target are scanned here; one
    # row per partition value (coarse time buckets) reaches the driver.
    lives_in = versions.read(spark, path, schema, base).join(upd_keys, same_key, "left_semi").select(value)
    touched = {r.value for r in updates.select(value).unionByName(lives_in).distinct().collect()}
    if not touched:
        return base
    kept = versions.read(spark, path, schema, base, touched).join(upd_keys, same_key, "left_anti")
    return versions.replace(updates.unionByName(kept.select(*updates.columns)), path, part_col, base, touched)
