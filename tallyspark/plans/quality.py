"""The declared quality suite: 99 generic tests (83 not_null, 11 unique,
4 accepted_values, 1 unique combination) and 9 singular failing-row tests.

Tests are declared as data below. A summary (:func:`audit`) counts them like this:

* Tests on single rows (not_null, and seven of the singular ones) are counted
  by ``DataFrame.observe`` while a model is written for its readers anyway, or,
  if nothing reads it, while the keys that its other tests need are written.
  The observation stands on top of the write, in its last stage, where a task
  that runs again counts once.
* Tests on groups (unique, unique combination, the funnel's grain) read those
  keys, of all models together: one shuffle on (test, key).
* Of accepted_values the rows outside the list are counted in the first way;
  only where there are any do their different values join that shuffle.

So no model is computed twice, and a model's rows are read again for its keys only.
A model is written with the columns that its tests and its readers take (``READS``), and all that was
written is deleted when it has been counted.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.plans.marts import CHANNEL_KEYS
from tallyspark.plans.staging import narrow_columns

E, W = "error", "warn"

# Declared not_null tests, (column, severity) per model.
NOT_NULL: dict[str, list[tuple[str, str]]] = {
    "stg_ga_events": [("event_key", E), ("event_date", E), ("event_timestamp", E), ("event_name", E),
                      ("user_pseudo_id", E), ("source_table_suffix", E)],
    "stg_ga_sessions": [("session_key", E), ("user_pseudo_id", E), ("ga_session_id", E),
                        ("session_start_at", E), ("session_end_at", E), ("event_count", E)],
    "stg_ga_purchases": [("event_key", E), ("event_date", E), ("event_timestamp", E),
                         ("user_pseudo_id", E), ("session_key", W), ("transaction_id", W),
                         ("purchase_revenue", W)],
    "stg_ga_items": [("event_key", E), ("event_date", E), ("event_timestamp", E), ("event_name", E),
                     ("user_pseudo_id", E), ("item_index", E), ("item_id", W), ("item_name", W)],
    "stg_orders": [("shop_domain", E), ("order_id", E), ("created_at", E), ("updated_at", E),
                   ("currency", E), ("total_price", E), ("ingested_at", E)],
    "stg_order_line_items": [("shop_domain", E), ("order_id", E), ("order_item_id", E),
                             ("product_id", W), ("quantity", E), ("unit_price", E)],
    "stg_customers": [("shop_domain", E), ("customer_id", E), ("ingested_at", E)],
    "stg_products": [("shop_domain", E), ("product_id", E), ("product_title", E), ("ingested_at", E)],
    "stg_product_variants": [("shop_domain", E), ("product_id", E), ("variant_id", E),
                             ("ingested_at", E)],
    "purchase_reconciliation": [("ga4_event_key", E), ("ga4_event_timestamp", E),
                                ("ga4_purchase_revenue", W), ("user_pseudo_id", E),
                                ("match_status", E)],
    "order_attribution": [("order_id", E), ("order_created_date", E), ("total_price", E),
                          ("attribution_model", E), ("is_attributed", E), ("attributed_source", E),
                          ("attributed_medium", E), ("attributed_campaign", E)],
    "fct_funnel": [("event_date", E), ("source", E), ("medium", E), ("campaign", E), ("sessions", E)],
    "fct_attributed_orders": [("order_id", E), ("order_created_date", E), ("total_price", E),
                              ("is_attributed", E), ("attributed_source", E),
                              ("attributed_medium", E), ("attributed_campaign", E)],
    "fct_channel_revenue": [("revenue_date", E), ("currency", E), ("attributed_source", E),
                            ("attributed_medium", E), ("attributed_campaign", E), ("orders", E),
                            ("total_revenue", E)],
}

# Declared unique tests.
UNIQUE: list[tuple[str, str, str]] = [
    ("stg_ga_events", "event_key", W),
    ("stg_ga_sessions", "session_key", E),
    ("stg_ga_purchases", "event_key", E),
    ("stg_orders", "order_id", E),
    ("stg_order_line_items", "order_item_id", E),
    ("stg_customers", "customer_id", E),
    ("stg_products", "product_id", E),
    ("stg_product_variants", "variant_id", E),
    ("purchase_reconciliation", "ga4_event_key", E),
    ("order_attribution", "order_id", E),
    ("fct_attributed_orders", "order_id", E),
]

# Declared accepted_values tests (model, column, values, severity, where).
ACCEPTED_VALUES: list[tuple[str, str, list[str], str, str | None]] = [
    ("stg_products", "status", ["active", "archived", "draft"], W, None),
    ("purchase_reconciliation", "match_status",
     ["matched", "missing_transaction_id", "not_set_transaction_id", "unmatched_transaction_id"], E, None),
    ("purchase_reconciliation", "match_type", ["order_id"], E, "match_type is not null"),
    ("order_attribution", "attribution_model", ["purchase_session"], E, None),
]

# Declared unique combination.
UNIQUE_COMBINATION: list[tuple[str, list[str], str]] = [("fct_channel_revenue", CHANNEL_KEYS, E)]


# ---------------------------------------------------------------------------
# Singular tests: each returns its failing rows.
# ---------------------------------------------------------------------------

FUNNEL_GRAIN = ["event_date", "source", "medium", "campaign"]
# Rates and metrics of the singular tests.
FUNNEL_RATES = ["session_to_view_item_rate", "session_to_purchase_rate"]
FUNNEL_STEPS = ["view_item_to_cart_rate", "cart_to_checkout_rate", "checkout_to_purchase_rate"]
FUNNEL_METRICS = ["sessions", "page_view_sessions", "view_item_sessions", "add_to_cart_sessions",
                  "checkout_sessions", "ga4_purchase_sessions", "matched_purchase_sessions",
                  "matched_orders", "shopify_revenue"]
ORDER_MONEY = ["subtotal_price", "total_tax", "total_discounts", "total_price"]


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


LINES = "stg_order_line_items"


@dataclass(frozen=True)
class FailingRows:
    """A singular test: the rows of ``model`` for which ``fails`` holds."""
    name: str
    model: str
    severity: str
    fails: Callable[[], Column]
    columns: list[str]

    def __call__(self, m) -> DataFrame:
        rows = m.order_lines_with(self.columns) if self.model == LINES else getattr(m, self.model)
        return rows.where(self.fails()).select(*self.columns)


# Purchases without a transaction id.
dq_purchase_missing_txn = FailingRows(
    "purchases_have_transaction_id", "stg_ga_purchases", W, lambda: F.col("transaction_id").isNull(),
    ["event_key", "event_date", "event_timestamp", "user_pseudo_id", "session_key", "transaction_id"])
# Two rates outside [0, 1]; a NULL rate is not a failure.
dq_funnel_rates = FailingRows(
    "funnel_rates_between_zero_and_one", "fct_funnel", E, lambda: _any(~F.col(c).between(0, 1) for c in FUNNEL_RATES),
    FUNNEL_GRAIN + FUNNEL_RATES)
# Step rates over 1 are legitimate when sessions enter mid-funnel.
dq_funnel_step_over_one = FailingRows(
    "funnel_step_rates_over_one", "fct_funnel", W, lambda: _any(F.col(c) > 1 for c in FUNNEL_STEPS), FUNNEL_GRAIN + FUNNEL_STEPS)
dq_funnel_non_negative = FailingRows(
    "funnel_metrics_are_non_negative", "fct_funnel", E, lambda: _any(F.col(c) < 0 for c in FUNNEL_METRICS),
    FUNNEL_GRAIN + FUNNEL_METRICS)
# Matched purchases whose revenue differs from the order's by more than 1.
dq_large_revenue_difference = FailingRows(
    "reconciliation_large_revenue_difference", "purchase_reconciliation", W,
    lambda: (F.col("match_status") == "matched") & (F.abs(F.coalesce("revenue_difference", F.lit(0.0))) > 1),
    ["ga4_event_key", "ga4_transaction_id", "shopify_order_id", "ga4_purchase_revenue", "shopify_total_price", "revenue_difference"])
# Purchases not matched to an order.
dq_unmatched_purchases = FailingRows(
    "reconciliation_unmatched_purchases", "purchase_reconciliation", W, lambda: F.col("match_status") != "matched",
    ["ga4_event_key", "ga4_event_timestamp", "ga4_transaction_id", "match_status"])
dq_line_quantity = FailingRows(
    "order_line_quantities_are_positive", "stg_order_line_items", E,
    lambda: (F.col("quantity") <= 0) | F.col("quantity").isNull(), ["order_id", "order_item_id", "quantity"])
dq_order_totals = FailingRows(
    "order_totals_are_non_negative", "stg_orders", E, lambda: _any(F.coalesce(c, F.lit(0.0)) < 0 for c in ORDER_MONEY),
    ["order_id"] + ORDER_MONEY)

SINGULAR_ROWS = [dq_purchase_missing_txn, dq_funnel_rates, dq_funnel_step_over_one, dq_funnel_non_negative,
                 dq_large_revenue_difference, dq_unmatched_purchases, dq_line_quantity, dq_order_totals]


def dq_funnel_grain(m) -> DataFrame:
    return (m.fct_funnel.groupBy(*FUNNEL_GRAIN).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def dq_duplicate_param_keys(m) -> DataFrame:
    """Events whose ``event_params`` repeat a key (D16: the warehouse's
    scalar subquery would fail on them; here the first value wins)."""
    ev = m.inputs.ga_events
    keys = F.transform("event_params", lambda p: p["key"])
    ev = ev.where(F.col("_table_suffix") >= F.lit(m.params.event_suffix_floor))
    return ev.where(F.size(keys) != F.size(F.array_distinct(keys))).select(
        "user_pseudo_id", "event_timestamp", "event_name", "_table_suffix")


SINGULAR = [*SINGULAR_ROWS, dq_funnel_grain]

# ---------------------------------------------------------------------------
# Summaries: (model, column_name, test, severity, failures, status) per test.
# ---------------------------------------------------------------------------

RESULT = "model string, column_name string, test string, severity string, failures long, status string"


@dataclass(frozen=True)
class Test:
    model: str
    column: str
    test: str
    severity: str
    #: A test on single rows: the rows that fail, or that may.
    fails: Callable[[], Column] | None = None
    #: A test on groups: the columns of the key.
    key: tuple[str, ...] = ()
    #: Failing groups: those of several rows, or (accepted_values) all.
    repeated: bool = True
    #: The key's rows (unique: those with a value).
    where: Callable[[], Column] | None = None
    #: The columns that ``fails`` reads, where it isn't ``column``.
    reads: tuple[str, ...] = ()

    def columns(self) -> list[str]:
        return list(self.reads or self.key or (self.column,))


def _not_null() -> list[Test]:
    return [Test(model, c, "not_null", sev, fails=lambda c=c: F.col(c).isNull())
            for model, cols in NOT_NULL.items() for c, sev in cols]


def _unique() -> list[Test]:
    return [Test(model, c, "unique", sev, key=(c,), where=lambda c=c: F.col(c).isNotNull()) for model, c, sev in UNIQUE]


def _accepted() -> list[Test]:
    def outside(c, values, where):
        bad = ~F.col(c).isin(list(values))
        return F.expr(where) & bad if where else bad
    return [Test(model, c, "accepted_values", sev, fails=lambda a=(c, vals, where): outside(*a), key=(c,), repeated=False,
                 where=lambda a=(c, vals, where): outside(*a))
            for model, c, vals, sev, where in ACCEPTED_VALUES]


def _combinations() -> list[Test]:
    return [Test(model, ",".join(cols), "unique_combination_of_columns", sev, key=tuple(cols)) for model, cols, sev in UNIQUE_COMBINATION]


def _singular() -> list[Test]:
    return [Test(t.model, "", t.name, t.severity, fails=t.fails, reads=tuple(t.columns)) for t in SINGULAR_ROWS] + [
        Test("fct_funnel", "", "funnel_unique_grain", E, key=tuple(FUNNEL_GRAIN))]


# Models that several others or a later test read: written for those readers.
# The parsed orders and products serve their lines and variants as well.
HUBS = {"stg_orders_parsed", "stg_products_parsed", "stg_ga_events", "stg_ga_sessions", "stg_ga_purchases",
        "purchase_reconciliation", "order_attribution"}
# A model whose rows are those of a written one: counted there.
ROWS_OF = {"stg_orders": "stg_orders_parsed", "stg_products": "stg_products_parsed", "fct_attributed_orders": "order_attribution"}


# What the models that are made of a written one read of it, beside its tested columns.
READS = {
    "stg_orders_parsed": {"shop_domain", "order_id", "customer_id", "created_at", "updated_at", "currency", "subtotal_price",
                          "total_discounts", "total_tax", "total_price", "_li", "_lines"},
    "stg_products_parsed": {"shop_domain", "product_id", "ingested_at", "_variants"},
    "stg_ga_events": {"event_key", "event_date", "event_timestamp", "event_name", "user_pseudo_id", "ga_session_id", "source",
                      "medium", "campaign", "currency", "transaction_id", "purchase_revenue"},
    "purchase_reconciliation": {"match_status", "session_key", "shopify_order_id", "shopify_total_price"},
    "order_attribution": {"order_id", *CHANNEL_KEYS[1:], "order_created_date", "customer_id", "is_attributed", "subtotal_price",
                          "total_discounts", "total_tax", "total_price"},
}


def _keys(df: DataFrame, tests: dict[int, Test]) -> DataFrame:
    """``test, key`` rows of the tests on groups of one model."""
    parts = []
    for i, t in tests.items():
        rows = df.where(t.where()) if t.where else df
        parts.append(rows.select(F.lit(i).alias("test"), F.array(*[F.col(c).cast("string") for c in t.key]).alias("key")))
    return reduce(DataFrame.unionAll, parts)


def audit(m, tests: list[Test], parallelism: int = 4) -> DataFrame:
    """One summary row per test. The models that ``tests`` need are written,
    once each and independent ones at a time; the result is one row per test."""
    from tallyspark.plans.build import MODEL_LEVELS, MaterializedModels, raw_tables_of, upstream_closure
    from tallyspark.session import fresh_path, steps
    spark = m.spark
    numbered = dict(enumerate(tests))
    built = isinstance(m, MaterializedModels)  # every model is a table already
    home = {i: t.model if built else ROWS_OF.get(t.model, t.model) for i, t in numbered.items()}
    hubs = set() if built else HUBS & upstream_closure(set(home.values()))
    rows, groups = defaultdict(dict), defaultdict(dict)
    for i, t in numbered.items():
        if t.fails:
            rows[home[i]][i] = t
        elif t.key:
            groups[home[i]][i] = t
    # What the tests of lines read: the order dedup carries no more of a line.
    line_columns = list(dict.fromkeys(c for t in tests if t.model == LINES for c in t.columns()))
    # Columns of lines that are only tested for a value.
    known = set(line_columns) - {c for t in tests if t.model == LINES and t.test != "not_null" for c in t.columns()}
    counts: dict[int, int] = {}
    folder = fresh_path(spark, "audit")
    keys: list[DataFrame] = []
    columns = {h: READS[h].union(*[t.columns() for t in [*rows[h].values(), *groups[h].values()]]) for h in hubs & READS.keys()}

    def metrics(name: str) -> list[Column]:
        return [F.count(F.when(t.fails(), 1)).alias(f"t{i}") for i, t in rows[name].items()]

    def counted(seen: Observation) -> None:
        counts.update({int(k[1:]): v for k, v in seen.get.items() if k.startswith("t")})

    if built:
        graph = m
    else:
        m.inputs.land(raw_tables_of(home.values()))
        graph = MaterializedModels(m, f"{folder}/models", hubs, lean=True,
                                   watch={h: (metrics(h), counted) for h in hubs if rows[h]},
                                   line_columns=narrow_columns(line_columns), known=known, columns=columns)

    def run(name: str) -> None:
        df = graph.order_lines_with(line_columns) if name == LINES else getattr(graph, name)
        if name in hubs:
            if groups[name]:
                keys.append(_keys(df, groups[name]))
        elif rows[name] or groups[name]:
            seen = Observation(f"audit-{name}-{folder[-12:]}") if rows[name] else None
            df = df.observe(seen, *metrics(name)) if seen else df
            if groups[name]:
                # Only what the tests on groups need is written.
                columns = sorted({c for t in groups[name].values() for c in t.key})
                kept = df.select(*columns)
                with steps(spark):
                    kept.write.option("compression", "zstd").parquet(f"{folder}/keys/{name}")
                keys.append(_keys(spark.read.schema(kept.schema).parquet(f"{folder}/keys/{name}"), groups[name]))
            else:
                with steps(spark):
                    df.write.format("noop").mode("overwrite").save()
            if seen:
                counted(seen)

    needed = set(home.values()) | hubs
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for level in MODEL_LEVELS:
            list(pool.map(run, [n for n in level if n in needed]))

    # Values outside an accepted list, where there are rows with any.
    keys += [_keys(getattr(graph, home[i]), {i: t}) for i, t in numbered.items() if t.fails and t.key and counts.get(i)]
    if keys:
        sizes = reduce(DataFrame.unionAll, keys).groupBy("test", "key").count()
        per_test = sizes.groupBy("test").agg(F.count_if(F.col("count") > 1).alias("repeated"), F.count(F.lit(1)).alias("groups"))
        found = {r.test: r for r in per_test.collect()}
        for i, t in numbered.items():
            if t.key:
                r = found.get(i)
                counts[i] = 0 if r is None else r.repeated if t.repeated else r.groups
    files.delete(spark, folder)  # counted: nothing reads the written models and keys any more
    return spark.createDataFrame(
        [(t.model, t.column, t.test, t.severity, counts.get(i, 0),
          "pass" if not counts.get(i, 0) else "warn" if t.severity == W else "fail") for i, t in numbered.items()], RESULT)


def dq_not_null(m) -> DataFrame:
    return audit(m, _not_null())


def dq_unique(m) -> DataFrame:
    return audit(m, _unique())


def dq_accepted_values(m) -> DataFrame:
    return audit(m, _accepted())


def dq_unique_combination(m) -> DataFrame:
    return audit(m, _combinations())


def dq_suite(m) -> DataFrame:
    """All 108 tests, one summary row each."""
    return audit(m, _not_null() + _unique() + _accepted() + _combinations() + _singular())
