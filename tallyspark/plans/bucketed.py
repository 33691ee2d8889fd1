"""Orders and facts as bucketed catalog tables (S15 for J1, J2, M12, M13).

The staged orders and the two facts are written once, bucketed and sorted by
order id. What joins or groups by order id afterwards reads its side of the
shuffle from the table: the attribution join moves the purchases only, the facts move nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyspark.plans.build import WIDE_COLUMNS, Models
from tallyspark.session import fresh_path, shuffle_width

# Tables and their bucket key.
BUCKETED = {"stg_orders_parsed": "order_id", "fct_orders": "order_id", "fct_order_lines": "order_id"}


class BucketedModels(Models):
    """The model graph with the tables above in ``database``, written when first used.
    ``buckets``: as many as a join of that size should have tasks (default: those that a
    shuffle starts with, so that the other side of a join is dealt alike).
    ``lines``: whether the staged orders keep the text of their lines, which only the line fact reads."""

    def __init__(self, base: Models, database: str, root: str, buckets: int | None = None, lines: bool = True):
        super().__init__(base.spark, base.sf_dir, base.params, base.inputs)
        self.database, self.root = database, root
        self.buckets = buckets or shuffle_width(self.spark)
        self.dropped = WIDE_COLUMNS if lines else (*WIDE_COLUMNS, "_li")

    def _finish(self, name: str, df: DataFrame) -> DataFrame:
        key = BUCKETED.get(name)
        if key is None:
            return df
        # One file per bucket: the rows are dealt by the key as the buckets are.
        (df.drop(*self.dropped).repartition(self.buckets, key)
         .write.mode("overwrite").bucketBy(self.buckets, key).sortBy(key)
         .option("compression", "zstd").option("path", f"{self.root}/{name}").saveAsTable(f"{self.database}.{name}"))
        return self.spark.table(f"{self.database}.{name}")


def attribution_from_buckets(m: Models) -> DataFrame:
    """M11 over the bucketed orders. The database is dropped again; the result is
    a table of its own."""
    root = fresh_path(m.spark, "bucketed")
    database = "tally_" + root.rsplit("-", 1)[1]
    m.spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    try:
        result = BucketedModels(m, database, root, lines=False).order_attribution
        path = fresh_path(m.spark, "bucketed-attribution")  # the database's folder goes with it
        result.write.parquet(path)
        return m.spark.read.schema(result.schema).parquet(path)
    finally:
        m.spark.sql(f"DROP DATABASE {database} CASCADE")
