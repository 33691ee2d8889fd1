"""The quality summaries: counted while models are written, against plain counts."""

import datetime as dt
import os
import shutil
from collections import Counter

from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.params import CHECK_PARAMS
from tallyspark.plans import marts, quality, reconcile, reports, staging
from tallyspark.plans.build import MaterializedModels, Models, build_all
from tallyspark.session import SHUFFLE_CLEANUP, fresh_path, shared_dir, steps


def _rows(df):
    return {(r.model, r.column_name, r.test): (r.severity, r.failures, r.status) for r in df.collect()}


def test_planted_failures_are_counted(spark, sf_small, monkeypatch):
    base = Models(spark, sf_small, CHECK_PARAMS)
    products = base.stg_products_parsed
    bad = (products.withColumn("status", F.when(F.col("product_id") % 3 == 0, F.concat(F.lit("odd"), F.col("product_id") % 2)).otherwise(F.col("status")))
           .withColumn("product_title", F.when(F.col("product_id") % 5 == 0, None).otherwise(F.col("product_title"))))
    bad = bad.unionAll(bad.where("product_id < 4")).unionAll(bad.where("product_id < 2"))
    rows = bad.select("product_id", "status", "product_title").collect()
    monkeypatch.setattr(staging, "stg_products_parsed", lambda raw: bad)
    m = Models(spark, sf_small, CHECK_PARAMS)
    got = _rows(quality.audit(m, [t for t in quality._not_null() + quality._unique() + quality._accepted() if t.model == "stg_products"]))
    assert got[("stg_products", "product_title", "not_null")] == ("error", sum(r.product_title is None for r in rows), "fail")
    assert got[("stg_products", "product_id", "unique")] == (
        "error", sum(n > 1 for n in Counter(r.product_id for r in rows).values()), "fail")
    outside = {r.status for r in rows} - {"active", "archived", "draft", None}
    assert got[("stg_products", "status", "accepted_values")] == ("warn", len(outside), "warn") and len(outside) >= 2
    assert got[("stg_products", "shop_domain", "not_null")] == ("error", 0, "pass")


def test_a_built_run_gives_the_same_summary(spark, sf_small):
    m = Models(spark, sf_small, CHECK_PARAMS)
    fresh = _rows(quality.dq_suite(m))
    built = build_all(Models(spark, sf_small, CHECK_PARAMS), fresh_path(spark, "t-built"))
    assert _rows(quality.dq_suite(built)) == fresh and len(fresh) == 108
    # The tie-outs of the run, from the totals of its writes.
    got = reports.tieouts_of_run(spark, built.root)
    for name, plain in (("tieout_revenue", reports.tieout_revenue(built.fct_channel_revenue, built.fct_orders)),
                        ("tieout_attribution_split", reports.tieout_attribution_split(built.fct_channel_revenue)),
                        ("tieout_layers", reports.tieout_layers(built.stg_orders, built.fct_orders, built.fct_attributed_orders))):
        assert got[name].first().asDict() == plain.first().asDict(), name


def test_published_marts_leave_no_database_behind(spark, sf_small):
    from tallyspark.plans.catalog import MARTS, published_marts
    before = {d.name for d in spark.catalog.listDatabases()}
    assert published_marts(Models(spark, sf_small, CHECK_PARAMS)).count() == len(MARTS)
    assert {d.name for d in spark.catalog.listDatabases()} == before
    published_marts(Models(spark, sf_small, CHECK_PARAMS), "tally_kept")
    assert spark.table("tally_kept.fct_orders").count() > 0
    spark.sql("DROP DATABASE tally_kept CASCADE")


def test_the_audit_leaves_the_failing_rows_queries_alone(spark, sf_small):
    m = Models(spark, sf_small, CHECK_PARAMS)
    suite = _rows(quality.audit(m, quality._singular()))
    for t in quality.SINGULAR_ROWS:
        assert suite[(t.model, "", t.name)][1] == t(m).count()
    assert suite[("fct_funnel", "", "funnel_unique_grain")][1] == quality.dq_funnel_grain(m).count()


def _attributed(spark, rows):
    """(order, customer, attributed, total, source)"""
    day = dt.date(2024, 1, 1)
    schema = ("order_id long, customer_id long, is_attributed boolean, total_price double, attributed_source string, order_created_date date, "
              "currency string, attributed_medium string, attributed_campaign string, subtotal_price double, total_discounts double, total_tax double")
    return spark.createDataFrame([(o, c, a, t, s, day, "USD", "m", "c", t, 0.0, 0.0) for o, c, a, t, s in rows], schema)


def test_channel_counts_are_exact_for_repeated_orders(spark):
    """Order ids of two shops: one order with two customers, one with two rows of a
    customer, an order both attributed and not, orders and customers without id."""
    rows = [(1, 7, True, 1.0, "a"), (1, 8, True, 2.0, "a"), (2, 7, True, 4.0, "a"), (2, 7, False, 8.0, "a"), (3, None, False, 16.0, "a"),
            (3, 9, True, 32.0, "a"), (None, 9, False, 64.0, "a"), (4, 7, False, 128.0, "b"), (1, 7, False, 256.0, "b"), (5, None, True, None, "a")]
    for parts in (1, 4):
        got = {r.attributed_source: r for r in marts.fct_channel_revenue(_attributed(spark, rows).repartition(parts)).collect()}
        for source in "ab":
            mine = [r for r in rows if r[4] == source]
            r = got[source]
            assert r.orders == len({x[0] for x in mine} - {None})
            assert r.customers == len({x[1] for x in mine} - {None})
            assert r.attributed_orders == len({x[0] for x in mine if x[2]} - {None})
            assert r.unattributed_orders == len({x[0] for x in mine if not x[2]} - {None})
            assert r.total_revenue == sum(x[3] or 0 for x in mine)
            assert r.attributed_revenue == sum(x[3] or 0 for x in mine if x[2])


def test_channel_and_funnel_plans(spark, sf_small):
    """No row is copied per distinct count; the first level of both groups under the order join's partitioning."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, most in (("fct_channel_revenue", 5), ("fct_funnel", 7)):
            plan = getattr(Models(spark, sf_small, CHECK_PARAMS), name)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
            assert "Expand" not in plan and plan.count("Exchange hashpartitioning") <= most, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_matched_purchases_are_those_of_the_reconciliation(spark, sf_small):
    m = Models(spark, sf_small, CHECK_PARAMS)
    odd = m.stg_ga_purchases.limit(0)
    base = m.stg_ga_purchases.where("transaction_id is not null").limit(1).collect()[0].asDict()
    ids = ["007", "-0", "-7", "+7", "7", "99999999999999999999", " 7", "7.0", None, "not_set"]
    odd = spark.createDataFrame([base | {"transaction_id": t, "event_key": f"k{i}", "session_key": "s"} for i, t in enumerate(ids)], odd.schema)
    p = m.stg_ga_purchases.unionAll(odd)
    a = reconcile.matched_of(reconcile.purchase_reconciliation(p, m.stg_orders)).collect()
    b = reconcile.matched_purchases(p, m.stg_orders).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and any(r.session_key == "s" for r in b)


def test_lines_as_numbers_are_the_lines_read_from_their_text(spark):
    """few columns of the lines go through the order dedup, not their text."""
    docs = ['{"line_items":[{"id":1,"quantity":"2","price":"1.5"},{"id":"2","quantity":"2.0"},null,7,"x",{"quantity":{"a":1}}]}',
            '{"line_items":[]}', '{"line_items":{"id":3}}', "{}", "not json", None,
            '{"line_items":[{"id":9,"quantity":"0","product_id":"abc","price":"n/a"}]}']
    rows = [("s", i // 2, None, dt.datetime(2002, 1, 1 + i), d, 1) for i, d in enumerate(docs * 2)] * 2
    raw = spark.createDataFrame(rows, "shop_domain string, order_id long, updated_at timestamp, ingested_at timestamp, payload_json string, batch_no long")
    columns = ["shop_domain", "order_id", *staging.NARROW_LINE]
    want = staging.stg_order_line_items(raw).select(*columns)
    parsed = staging.stg_orders_parsed(raw, None, staging.narrow_columns(columns))
    got = staging.narrow_order_lines(parsed, columns)
    assert Counter(got.collect()) == Counter(want.collect()) and want.count() > 6
    assert "_li" not in parsed.columns and staging.narrow_columns(["order_id", "sku"]) is None


def test_the_audit_writes_no_pages_and_no_text_of_lines(spark, tmp_path, monkeypatch):
    source = tmp_path / "source"
    shutil.copytree("/root/testdata/sf0.001", source)  # landed anew: known by path and time
    m = Models(spark, str(source), CHECK_PARAMS)
    written = []
    finish = MaterializedModels._finish
    monkeypatch.setattr(MaterializedModels, "_finish", lambda self, name, df: written.append((name, df.columns)) or finish(self, name, df))
    quality.dq_unique(m)
    assert "_li" not in dict(written)["stg_orders_parsed"]
    assert sorted(os.listdir(m.inputs._root)) == ["ga_events", "raw_customers", "raw_orders", "raw_products"]
    lines = [t for t in quality._not_null() if t.model == "stg_order_line_items"]
    other = Models(spark, str(shutil.copytree(source, tmp_path / "other")), CHECK_PARAMS)
    got = {r.column_name: r.failures for r in quality.audit(other, lines).collect()}
    assert os.listdir(other.inputs._root) == ["raw_orders"]
    text = m.stg_order_line_items
    assert got == {c: text.where(F.col(c).isNull()).count() for c in got}


def _written_schemas(monkeypatch):
    """Per model that the audit writes, the schema of the table."""
    written = {}
    finish = MaterializedModels._finish

    def seen(self, name, df):
        out = finish(self, name, df)
        if name in self.only:
            written[name] = out.schema
        return out
    monkeypatch.setattr(MaterializedModels, "_finish", seen)
    return written


def test_the_suite_writes_what_is_read_and_leaves_nothing(spark, sf_small, monkeypatch):
    """written models have the columns of their readers, and go when they have been counted."""
    written = _written_schemas(monkeypatch)
    before = set(files.names(spark, shared_dir(spark)))
    assert quality.dq_suite(Models(spark, sf_small, CHECK_PARAMS)).count() == 108
    assert "order_name" not in written["stg_orders_parsed"].names and "processed_at" not in written["stg_orders_parsed"].names
    assert "page_title" not in written["stg_ga_events"].names and "session_key" not in written["order_attribution"].names
    assert "shopify_order_name" not in written["purchase_reconciliation"].names
    assert not [n for n in files.names(spark, shared_dir(spark)) if n.startswith("audit-") and n not in before]


def test_steps_overlap_and_put_the_setting_back(spark):
    """a write's shuffle files go with it; models are written from several threads."""
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    outer, inner = steps(spark), steps(spark)
    outer.__enter__()
    inner.__enter__()
    outer.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    inner.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_not_null_of_lines_carries_whether_there_is_a_value(spark, sf_small, monkeypatch):
    """a number that is only tested for a value doesn't go through the order dedup."""
    written = _written_schemas(monkeypatch)
    m = Models(spark, sf_small, CHECK_PARAMS)
    got = _rows(quality.dq_not_null(m))
    fields = {f.name: f.dataType.simpleString() for f in written["stg_orders_parsed"]["_lines"].dataType.elementType.fields}
    assert set(fields.values()) == {"boolean"} and set(fields) == {"order_item_id", "product_id", "quantity", "unit_price"}
    text = m.stg_order_line_items
    for c in fields:
        assert got[("stg_order_line_items", c, "not_null")][1] == text.where(F.col(c).isNull()).count()
    quality.dq_suite(m)  # the suite tests ids for repeats and quantities for their sign
    fields = {f.name: f.dataType.simpleString() for f in written["stg_orders_parsed"]["_lines"].dataType.elementType.fields}
    assert fields["order_item_id"] == "bigint" and fields["quantity"] == "bigint" and fields["unit_price"] == "boolean"
