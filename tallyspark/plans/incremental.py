"""Incremental builds of the two facts (M12, M13 with O3 + O4).

The fact tables are versioned tables (``operators.versions``) partitioned by
the order's creation month. A run reads the target, takes the lookback bound
from it (``max(order_updated_at) - lookback``, quirk D1), rebuilds the rows of
orders changed since then and merges them on the unique key as one new
version. The first run writes the whole table.

Only the raw versions of orders that may have changed are parsed and
deduplicated (:func:`changed_versions`), so a run's work grows with what changed
and not with the history, of which it reads three narrow columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import versions
from tallyspark.operators.incremental import lookback_bound, merge_partitions
from tallyspark.params import Params
from tallyspark.plans import marts, staging
from tallyspark.session import fresh_path

PART_COL = "order_created_month"


def _with_part(df: DataFrame) -> DataFrame:
    return df.withColumn(PART_COL, F.date_format("order_created_at", "yyyy-MM"))


def changed_versions(raw_orders: DataFrame, bound: Column) -> DataFrame:
    """All raw versions of the orders whose latest one may be at or after ``bound``.

    An order's update time is its latest payload's, else the raw row's, else
    its creation time. Landing fills the raw row's from the payload's, so an order
    without a raw row that is at or after the bound, or has no time, can't have
    changed. The changed keys come from narrow columns and are written, so the
    planner knows their size: a small set is broadcast, a large one is joined by
    key. The payloads meet them before they are parsed.
    """
    spark = raw_orders.sparkSession
    keys = ["shop_domain", "order_id"]
    may = raw_orders.where(F.col("updated_at").isNull() | (F.col("updated_at") >= bound)).select(*keys).distinct()
    path = fresh_path(spark, "changed-keys")
    may.write.parquet(path)
    changed = spark.read.schema(may.schema).parquet(path).select(*[F.col(k).alias(f"_{k}") for k in keys])
    return raw_orders.join(changed, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi")


def _run(raw_orders: DataFrame, path: str, build, columns: list[str], key: str, params: Params) -> DataFrame:
    """A fact whose rows are ``build(raw orders, bound)``: the whole table at
    first, then the changed rows merged on ``key``."""
    spark = raw_orders.sparkSession
    full = _with_part(build(raw_orders, None))
    base = versions.current(spark, path)
    if base is None:
        new = versions.replace(full, path, PART_COL, None)
    else:
        target = versions.read(spark, path, full.schema, base)
        limit = lookback_bound(target, "order_updated_at", params.lookback, params.lookback_floor)
        # As a value: it is pushed into the scan of the raw table.
        micros = spark.range(1).select(F.unix_micros(limit).alias("b")).first().b
        bound = F.timestamp_micros(F.lit(micros))
        updates = _with_part(build(changed_versions(raw_orders, bound), bound))
        new = merge_partitions(path, updates, [key], PART_COL)
    return versions.read(spark, path, full.schema, new).select(*columns)


def run_fct_orders(spark: SparkSession, raw_orders: DataFrame, target_path: str,
                   params: Params | None = None) -> DataFrame:
    params = params or Params()
    return _run(raw_orders, target_path,
                lambda raw, bound: marts.fct_orders(staging.stg_orders(raw, params), params, bound=bound),
                marts.FCT_ORDER_COLUMNS, "order_id", params)


def run_fct_order_lines(spark: SparkSession, raw_orders: DataFrame, target_path: str,
                        params: Params | None = None) -> DataFrame:
    """The bound is read from the target's ``order_updated_at`` (the line
    fact carries its order's update time)."""
    params = params or Params()
    return _run(raw_orders, target_path, lambda raw, bound: marts.fct_order_lines(
                    staging.order_lines_wide(staging.stg_orders_parsed(raw, params)), params, bound=bound),
                marts.FCT_LINE_COLUMNS, "order_item_id", params)
