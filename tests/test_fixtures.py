"""The derived inputs against the branch sizes the fixture spec lists for
sf0.001 (FIXTURES.md §2.5), and the tie-out invariants (D-7..D-10)."""

import pytest
from pyspark.sql import functions as F

from tallyspark.params import CHECK_PARAMS
from tallyspark.plans import reports
from tallyspark.plans.build import Models


@pytest.fixture(scope="module")
def m(spark, sf_small):
    return Models(spark, sf_small, CHECK_PARAMS)


def test_event_branch_sizes(m):
    ev = m.stg_ga_events
    assert ev.count() == 870
    assert ev.where(F.col("ga_session_id").isNull()).count() == 43
    assert m.stg_ga_sessions.count() == 337
    assert ev.where(F.array_size("items") > 0).count() == 870 - 174
    assert m.stg_ga_items.count() == 1740
    assert m.stg_ga_purchases.count() == 179


def test_reconciliation_branch_sizes(m):
    got = {r.match_status: r["count"] for r in m.purchase_reconciliation.groupBy("match_status").count().collect()}
    assert got == {"matched": 79, "missing_transaction_id": 40, "not_set_transaction_id": 23,
                   "unmatched_transaction_id": 37}
    r = m.purchase_reconciliation
    assert r.where("ga4_transaction_id = '(not set)'").count() == 18
    matched = r.where("match_status = 'matched'")
    assert matched.where(F.abs(F.coalesce("revenue_difference", F.lit(0.0))) > 1).count() == 16
    assert matched.where(F.col("ga4_purchase_revenue").isNull()).count() == 17
    cur = {row.same_currency: row["count"] for row in matched.groupBy("same_currency").count().collect()}
    assert cur == {True: 56, False: 13, None: 10}
    assert matched.where(F.col("session_key").isNull()).count() == 6
    assert matched.where(F.col("source").isNull()).count() == 19
    per_order = matched.groupBy("shopify_order_id").agg(F.count(F.lit(1)).alias("n"),
                                                       F.count_distinct("session_key").alias("s"))
    assert per_order.count() == 62
    assert per_order.where("n > 1").count() == 8
    assert per_order.where("s > 1").count() == 7
    assert per_order.agg(F.max("n")).first()[0] == 11  # the hot order


def test_order_and_line_branch_sizes(m):
    raw = m.inputs.raw_orders
    assert m.stg_orders.count() == 1500
    v = {r.batch_no: r["count"] for r in raw.groupBy("batch_no").count().collect()}
    assert (v[2], v[3], v[4]) == (215, 116, 89)
    li = m.stg_order_line_items
    assert m.stg_orders.join(li, "order_id", "left_anti").count() == 27
    assert li.where("quantity = 0").count() == 58
    assert li.where("product_id IS NULL").count() == 148
    assert li.where("sku IS NULL").count() == 108
    assert li.where("line_title LIKE '[SALE] %'").count() == 596


def test_product_branch_sizes(m):
    p = m.stg_products
    assert p.join(m.stg_product_variants, "product_id", "left_anti").count() == 67
    assert p.where("status = 'unknown'").count() == 4
    assert m.stg_product_variants.count() == 199


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_tieouts_hold(spark, sf):
    m = Models(spark, sf, CHECK_PARAMS)
    assert reports.tieout_revenue(m.fct_channel_revenue, m.fct_orders).first().tied
    assert reports.tieout_attribution_split(m.fct_channel_revenue).first().tied
    assert reports.tieout_purchases(m.purchase_reconciliation).first().tied
    t = reports.tieout_layers(m.stg_orders, m.fct_orders, m.fct_attributed_orders).first()
    assert t.counts_tied and t.revenue_tied
