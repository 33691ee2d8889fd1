"""Wiring of the model graph (survey §1.5) over one set of inputs.

``Models`` builds each model once, lazily, as a DataFrame; nothing runs
until an action. When several marts are computed in one job, ``persist`` the
shared models (M1, M6, M10) or write them as tables -- staging and
intermediate models are views in the reference and would otherwise be
recomputed per mart.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.functions.money import money_sum
from tallyspark.params import Params
from tallyspark.plans import marts, reconcile, staging
from tallyspark.session import prepare, shared_dir, size_shuffles, steps
from tallyspark.sources import fixtures
from tallyspark.sources.schemas import GA_EVENTS_SCHEMA, raw_entity_schema
from tallyspark.sources.shards import read_shards

# Bump when a fixture rule changes (invalidates landed inputs).
FIXTURE_VERSION = "5"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _publish(spark: SparkSession, tmp: str, path: str) -> None:
    """Move a finished table directory into place unless one already exists
    there (a partial directory without ``_SUCCESS`` is replaced)."""
    jvm = spark._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(tmp), jvm.org.apache.hadoop.fs.Path(path)
    fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")):
        fs.delete(src, True)
        return
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(src, dst):
        fs.delete(src, True)


# Row groups of the landed inputs.
ROW_GROUP_BYTES = 32 << 20

RAW_TABLES = ("raw_orders", "raw_products", "raw_customers", "ga_events")
SOURCE_TABLES = ("customer", "events", "lineitem", "orders", "part")


def _source_files(spark: SparkSession, sf_dir: str) -> list[tuple[str, int]]:
    """Per source file what it is known by (path, length, modification time), and its length."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for t in SOURCE_TABLES:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        files = p.getFileSystem(conf).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            out.append((f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}", f.getLen()))
    return sorted(out)


class Inputs:
    """Raw inputs derived from a testdata directory.

    With ``landed=True`` (the default) each raw table is derived once and
    written under the shared folder -- the stand-in for the raw tables the
    landing job maintains -- and every model reads the written table. The
    event export is written partitioned by ``_table_suffix``, so the staging
    suffix floor prunes partitions. ``landed=False`` derives the inputs
    inline in every plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params, landed: bool | None = None):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params
        if landed is None:
            landed = os.environ.get("TALLYSPARK_INLINE_INPUTS", "") != "1"
        self.landed = landed

    @cached_property
    def _root(self) -> str:
        # Keyed on the source files themselves (path, length, modification
        # time): replaced files are derived anew.
        source = "|".join(said for said, _ in _source_files(self.spark, self.sf_dir))
        key = hashlib.sha1(f"{source}|{self.params.shop_domain}|{FIXTURE_VERSION}".encode()).hexdigest()[:16]
        return f"{shared_dir(self.spark).rstrip('/')}/tallyspark-inputs/{key}"

    def _landed(self, name: str, build, schema, partition_by: str | None = None) -> DataFrame:
        if not self.landed:
            return build()
        path = f"{self._root}/{name}"
        lock = self.__dict__.setdefault("_locks", {}).setdefault(name, threading.Lock())
        with lock:
            if not _exists(self.spark, f"{path}/_SUCCESS"):
                # Written under a unique name, then renamed into place: another
                # process landing the same input concurrently never sees a
                # half-written table, and the loser of the race drops its copy.
                tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
                # Payloads shrink some tenfold: small row groups, so that a task reads few of them.
                w = (build().write.mode("overwrite").option("compression", "zstd")
                     .option("parquet.block.size", ROW_GROUP_BYTES))
                if partition_by:
                    w = w.partitionBy(partition_by)
                with steps(self.spark):
                    w.parquet(tmp)
                _publish(self.spark, tmp, path)
        return self.spark.read.schema(schema).parquet(path)

    def land(self, names) -> None:
        """Derive and write the raw tables ``names`` now, side by side: the last
        tasks of one leave no core without work."""
        names = [name for name in RAW_TABLES if name in names]
        if self.landed and names:
            self._root  # once, before the threads
            with ThreadPoolExecutor(max_workers=len(names)) as pool:
                list(pool.map(lambda name: getattr(self, name).limit(0).collect(), names))

    def land_all(self) -> None:
        """Derive and write every raw input (and the order/product/customer
        API page files) now, so later queries only read them."""
        from tallyspark.plans.landing_jobs import api_snapshot
        self.land(RAW_TABLES)
        for entity, raw in (("order", self.raw_orders), ("product", self.raw_products),
                            ("customer", self.raw_customers)):
            self.pages_path(entity, lambda raw=raw: api_snapshot(raw))

    @cached_property
    def raw_orders(self) -> DataFrame:  # (cached_property is not thread-safe; land runs first)
        return self._landed("raw_orders", lambda: fixtures.raw_orders(self.spark, self.sf_dir, self.params),
                            raw_entity_schema("order"))

    @cached_property
    def raw_products(self) -> DataFrame:
        return self._landed("raw_products", lambda: fixtures.raw_products(self.spark, self.sf_dir, self.params),
                            raw_entity_schema("product"))

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self._landed("raw_customers",
                            lambda: fixtures.raw_customers(self.spark, self.sf_dir, self.params),
                            raw_entity_schema("customer"))

    def pages_path(self, entity: str, snapshot) -> str:
        """API page files for ``entity`` (landed once per inputs; see
        ``sources.landing.write_pages``)."""
        from tallyspark.sources.landing import write_pages
        path = f"{self._root}/pages_{entity}"
        if not self.landed:
            from tallyspark.session import fresh_path
            path = fresh_path(self.spark, f"pages-{entity}")
        lock = self.__dict__.setdefault("_locks", {}).setdefault(f"pages_{entity}", threading.Lock())
        with lock:
            if not _exists(self.spark, f"{path}/_SUCCESS"):
                tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
                write_pages(snapshot(), entity, tmp)
                _publish(self.spark, tmp, path)
        return path

    @cached_property
    def ga_events(self) -> DataFrame:
        if self.params.event_shards_root:
            return read_shards(self.spark, self.params.event_shards_root, self.params.event_suffix_floor, self.params.daily_shards_only)
        if not self.landed:
            return fixtures.ga_events(self.spark, self.sf_dir, self.params.event_suffix_floor)
        return self._landed("ga_events", lambda: fixtures.ga_events(self.spark, self.sf_dir, by_suffix=True),
                            GA_EVENTS_SCHEMA, partition_by="_table_suffix")


def model(fn):
    """A model of the graph: built once per ``Models`` and passed through
    ``Models._finish`` (identity, or write-and-read for materialised runs)."""
    name = fn.__name__

    def get(self) -> DataFrame:
        cache = self.__dict__.setdefault("_built", {})
        if name in cache:
            return cache[name]
        # One builder per model even when independent models are built from
        # several driver threads (a shared upstream is written once).
        lock = self.__dict__.setdefault("_locks", {}).setdefault(name, threading.Lock())
        with lock:
            if name not in cache:
                cache[name] = self._finish(name, fn(self))
        return cache[name]

    get.__name__ = name
    get.__doc__ = fn.__doc__
    return property(get)


def _present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of ``columns`` that ``df`` has: a lean table lacks the payload."""
    return df.select(*[c for c in columns if c in df.columns])


class Models:
    """The model graph over one set of inputs; every model is a lazy
    DataFrame until an action runs."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params | None = None,
                 inputs: Inputs | None = None):
        prepare(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.params = params or Params()
        self.inputs = inputs or Inputs(spark, sf_dir, self.params)
        if inputs is None:
            size_shuffles(spark, sum(length for _, length in _source_files(spark, sf_dir)))

    def _finish(self, name: str, df: DataFrame) -> DataFrame:
        return df

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every model as a session temp view (S14), so the models can
        be queried by name with ``spark.sql`` -- lazily, like the reference's
        staging and intermediate views."""
        names = []
        for name in MODEL_NAMES:
            getattr(self, name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    # staging ---------------------------------------------------------------
    @model
    def stg_orders_parsed(self) -> DataFrame:
        return staging.stg_orders_parsed(self.inputs.raw_orders, self.params)

    @model
    def stg_orders(self) -> DataFrame:
        return _present(self.stg_orders_parsed, staging.ORDER_COLUMNS)

    def order_lines_with(self, columns: list[str]) -> DataFrame:
        """M2 with ``columns`` alone. Where the lines have them as numbers, the
        text of the lines doesn't go through the order dedup."""
        narrow = staging.narrow_columns(columns)
        if narrow is None:
            return self.stg_order_line_items.select(*columns)
        return staging.narrow_order_lines(staging.stg_orders_parsed(self.inputs.raw_orders, self.params, narrow), columns)

    @cached_property
    def order_lines_wide(self) -> DataFrame:
        return staging.order_lines_wide(self.stg_orders_parsed)

    @model
    def stg_order_line_items(self) -> DataFrame:
        return self.order_lines_wide.select(*staging.LINE_COLUMNS)

    @model
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.inputs.raw_customers)

    @model
    def stg_products_parsed(self) -> DataFrame:
        return staging.stg_products_parsed(self.inputs.raw_products)

    @model
    def stg_products(self) -> DataFrame:
        return _present(self.stg_products_parsed, staging.PRODUCT_COLUMNS)

    @model
    def stg_product_variants(self) -> DataFrame:
        return staging.product_variants(self.stg_products_parsed)

    @model
    def stg_ga_events(self) -> DataFrame:
        return staging.stg_ga_events(self.inputs.ga_events, self.params)

    @model
    def stg_ga_sessions(self) -> DataFrame:
        return staging.stg_ga_sessions(self.stg_ga_events)

    @model
    def stg_ga_purchases(self) -> DataFrame:
        return staging.stg_ga_purchases(self.stg_ga_events)

    @model
    def stg_ga_items(self) -> DataFrame:
        return staging.stg_ga_items(self.stg_ga_events)

    # intermediate ----------------------------------------------------------
    @model
    def purchase_reconciliation(self) -> DataFrame:
        return reconcile.purchase_reconciliation(self.stg_ga_purchases, self.stg_orders)

    @model
    def order_attribution(self) -> DataFrame:
        return reconcile.order_attribution(self.fct_orders, self.stg_ga_purchases)

    # marts -----------------------------------------------------------------
    @model
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.stg_orders, self.params)

    @model
    def fct_order_lines(self) -> DataFrame:
        return marts.fct_order_lines(self.order_lines_wide, self.params)

    @model
    def fct_attributed_orders(self) -> DataFrame:
        return marts.fct_attributed_orders(self.order_attribution)

    @model
    def fct_channel_revenue(self) -> DataFrame:
        return marts.fct_channel_revenue(self.fct_attributed_orders)

    @model
    def fct_funnel(self) -> DataFrame:
        return marts.funnel_of_matched(self.stg_ga_sessions, self._matched_purchases)

    @property
    def _matched_purchases(self) -> DataFrame:
        return reconcile.matched_purchases(self.stg_ga_purchases, self.stg_orders)


class MaterializedModels(Models):
    """The graph run the way the reference materialises it: each model,
    when first used, is written as a table under ``root`` and read back, so
    its downstream models (and repeated readers such as the quality suite)
    scan the table instead of recomputing it. The written tables also cut
    lineage, so a lost executor costs one model's tasks, not the chain."""

    def __init__(self, base: Models, root: str, only: set[str] | None = None, lean: bool = False,
                 watch: dict[str, tuple[list[Column], Callable[[Observation], None]]] | None = None,
                 line_columns: list[str] | None = None, known: set[str] | None = None,
                 columns: dict[str, set[str]] | None = None):
        """``watch``: per written model, metrics to observe while it is written and who is told.
        ``line_columns``: the only columns of M2 that are asked for, where M1 is written for it; ``known``:
        those of which it is only asked whether there is a value. ``columns``: per written model, the only columns that its readers take."""
        super().__init__(base.spark, base.sf_dir, base.params, base.inputs)
        self.root = root
        self.only = set(MODEL_NAMES) if only is None else only
        self.base, self.lean, self.watch, self.line_columns, self.columns = base, lean, watch or {}, line_columns, columns or {}
        self.known = known or set()
        #: Per written model its rows and exact money sums, from the write itself.
        self.totals: dict[str, dict] = {}

    def _finish(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.only:
            return df
        path = f"{self.root}/{name}"
        if self.lean:
            df = df.drop(*WIDE_COLUMNS)
        if name in self.columns:
            df = df.select(*[c for c in df.columns if c in self.columns[name]])
        metrics, tell = self.watch.get(name, ([], None))
        totals = [F.count(F.lit(1)).alias("_rows"), *[money_sum(c).alias(f"_{c}") for c in TOTALS.get(name, []) if c in df.columns]]
        # On top of the write: its last stage, where a task that runs again counts once.
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        # overwrite: a rerun after a failure replaces a partial directory.
        with steps(self.spark):
            df.observe(seen, *totals, *metrics).write.mode("overwrite").option("compression", "zstd").parquet(path)
        values = seen.get
        self.totals[name] = {k[1:]: v for k, v in values.items() if k.startswith("_")}
        # Beside the table's files, under a name that readers of the table skip.
        files.write_json(self.spark, f"{path}/_totals.json", {k: str(v) if v is not None else None for k, v in self.totals[name].items()})
        if metrics:
            tell(seen)
        return self.spark.read.schema(df.schema).parquet(path)

    @model
    def stg_orders_parsed(self) -> DataFrame:
        return staging.stg_orders_parsed(self.inputs.raw_orders, self.params, self.line_columns, self.known)

    def order_lines_with(self, columns: list[str]) -> DataFrame:
        if self.line_columns is not None:
            return staging.narrow_order_lines(self.stg_orders_parsed, columns)
        if {"stg_orders_parsed", "stg_order_line_items"} & self.only:
            return self.stg_order_line_items.select(*columns)
        return super().order_lines_with(columns)

    @property
    def _matched_purchases(self) -> DataFrame:
        if "purchase_reconciliation" in self.only:
            return reconcile.matched_of(self.purchase_reconciliation)
        return Models._matched_purchases.__get__(self)

    @property
    def stg_ga_items(self) -> DataFrame:
        """From the unwritten events where the written ones have no items."""
        if self.lean and "stg_ga_events" in self.only:
            return self.base.stg_ga_items
        return Models.stg_ga_items.__get__(self)


# Money columns whose exact sums are kept beside a written model.
TOTALS = {
    "fct_orders": ["total_price"], "fct_attributed_orders": ["total_price"],
    "fct_channel_revenue": ["total_revenue", "attributed_revenue", "unattributed_revenue"],
}

# Columns that hold whole source records: left out of tables that are written
# only to be counted or summed.
WIDE_COLUMNS = ("payload_json", "items")

# The model graph by dependency level: models of one level only read raw
# inputs or models of earlier levels, so a level's models are independent.
MODEL_LEVELS = [
    ["stg_orders_parsed", "stg_products_parsed", "stg_ga_events", "stg_customers"],
    ["stg_orders", "stg_order_line_items", "stg_products", "stg_product_variants", "fct_order_lines"],
    ["stg_ga_sessions", "stg_ga_purchases", "stg_ga_items", "fct_orders"],
    ["purchase_reconciliation", "order_attribution"],
    ["fct_attributed_orders", "fct_funnel"],
    ["fct_channel_revenue"],
]
# Parsed once for two models each; written only where a job asks for it.
SHARED = ("stg_orders_parsed", "stg_products_parsed")
MODEL_NAMES = [n for level in MODEL_LEVELS for n in level if n not in SHARED]

# Direct upstream models of each model (raw inputs omitted).
MODEL_DEPS = {
    "stg_orders": ["stg_orders_parsed"], "stg_order_line_items": ["stg_orders_parsed"],
    "fct_order_lines": ["stg_orders_parsed"],
    "stg_products": ["stg_products_parsed"], "stg_product_variants": ["stg_products_parsed"],
    "stg_ga_sessions": ["stg_ga_events"], "stg_ga_purchases": ["stg_ga_events"],
    "stg_ga_items": ["stg_ga_events"], "fct_orders": ["stg_orders"],
    "purchase_reconciliation": ["stg_ga_purchases", "stg_orders"],
    "order_attribution": ["fct_orders", "stg_ga_purchases"],
    "fct_attributed_orders": ["order_attribution"],
    "fct_funnel": ["stg_ga_sessions", "purchase_reconciliation"],
    "fct_channel_revenue": ["fct_attributed_orders"],
}


# The raw table that a first model reads.
MODEL_RAW = {"stg_orders_parsed": "raw_orders", "stg_products_parsed": "raw_products",
             "stg_customers": "raw_customers", "stg_ga_events": "ga_events"}


def raw_tables_of(names) -> set[str]:
    """The raw tables that the models ``names`` are made of."""
    return {MODEL_RAW[n] for n in upstream_closure(names) if n in MODEL_RAW}


def upstream_closure(names) -> set[str]:
    """The models ``names`` read, directly or transitively, plus themselves."""
    seen: set[str] = set()
    todo = list(names)
    while todo:
        n = todo.pop()
        if n not in seen:
            seen.add(n)
            todo.extend(MODEL_DEPS.get(n, []))
    return seen


def build_all(models: Models, root: str, parallelism: int = 4) -> MaterializedModels:
    """Write every model once, level by level (each model reads its
    upstream's written table): the full run. Independent models of a level
    are submitted from ``parallelism`` driver threads, so their Spark jobs
    overlap on the cluster. Returns the graph over the written tables for
    readers such as the quality suite and reports."""
    models.inputs.land_all()
    mm = MaterializedModels(models, root)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for level in MODEL_LEVELS:
            list(pool.map(lambda n: getattr(mm, n), [n for n in level if n not in SHARED]))
    return mm


def with_written(models: Models, names, parallelism: int = 4, lean: bool = True,
                 columns: dict[str, set[str]] | None = None) -> Models:
    """``models`` with ``names`` written once to a fresh folder under the
    shared folder (independent ones concurrently, in dependency order); every
    other model is computed from those tables. Use when one job reads a shared
    upstream through several differently-pruned paths, which Spark would
    otherwise recompute (and re-shuffle) once per path. ``lean`` leaves the
    raw payloads (``WIDE_COLUMNS``) out of the written tables; ``columns``: see
    ``MaterializedModels``."""
    from tallyspark.session import fresh_path
    if isinstance(models, MaterializedModels) or not names:
        return models
    names = set(names)
    mm = MaterializedModels(models, fresh_path(models.spark, "written-models"), names, lean, columns=columns)
    models.inputs.land(raw_tables_of(names))
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for level in MODEL_LEVELS:
            list(pool.map(lambda n: getattr(mm, n), [n for n in level if n in names]))
    return mm
