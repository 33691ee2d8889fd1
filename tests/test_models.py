"""Hand-made micro cases (FIXTURES.md §3), one per quirk, expected by hand."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tallyspark.params import Params
from tallyspark.plans import marts, reconcile, staging
from tallyspark.sources.schemas import GA_EVENTS_SCHEMA, raw_entity_schema

T0 = dt.datetime(2024, 1, 5, 12, 0, 0)


def raw_orders(spark, rows):
    """rows: (order_id, payload dict or text, ingested_at, raw_updated_at)"""
    data = [("shop-a", oid, upd, ing, p if isinstance(p, str) else json.dumps(p), 1)
            for oid, p, ing, upd in rows]
    return spark.createDataFrame(data, raw_entity_schema("order"))


def order_payload(oid, updated=None, status="paid", total="10.00", currency="USD", **extra):
    p = {"id": oid, "name": f"#{oid}", "order_number": str(oid), "customer_id": 1,
         "created_at": "2024-01-01T00:00:00Z", "financial_status": status, "currency": currency,
         "total_price": total}
    if updated:
        p["updated_at"] = updated
    p.update(extra)
    return p


def event(name, ts, user="u1", sid=1, txn=None, revenue=None, source=None, currency="USD", suffix="20240105"):
    params = [{"key": "ga_session_id", "value": {"string_value": None, "int_value": sid}}] if sid else []
    if source:
        params.append({"key": "source", "value": {"string_value": source, "int_value": None}})
    if currency:
        params.append({"key": "currency", "value": {"string_value": currency, "int_value": None}})
    us = int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    return {"event_name": name, "event_timestamp": us, "event_date": ts.strftime("%Y%m%d"),
            "user_pseudo_id": user, "event_params": params,
            "ecommerce": {"transaction_id": txn, "purchase_revenue": revenue} if name == "purchase" else None,
            "items": None, "_table_suffix": suffix}


def test_equal_updated_at_later_ingest_wins(spark):
    df = raw_orders(spark, [
        (1, order_payload(1, "2024-01-02T00:00:00Z", status="old"), dt.datetime(2024, 1, 2), None),
        (1, order_payload(1, "2024-01-02T00:00:00Z", status="new"), dt.datetime(2024, 1, 3), None)])
    assert [r.financial_status for r in staging.stg_orders(df).collect()] == ["new"]


def test_null_updated_at_loses_to_old_version(spark):
    df = raw_orders(spark, [
        (1, order_payload(1, "2023-01-01T00:00:00Z", status="old"), dt.datetime(2024, 1, 1), None),
        (1, order_payload(1, None, status="undated"), dt.datetime(2024, 1, 9), None)])
    assert [r.financial_status for r in staging.stg_orders(df).collect()] == ["old"]


def test_malformed_payload_keeps_row_with_null_fields(spark):
    df = raw_orders(spark, [(5, "{not json", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))])
    r = staging.stg_orders(df).first()
    assert r.order_id == 5 and r.order_name is None and r.total_price is None
    assert r.updated_at == dt.datetime(2024, 1, 1)  # falls back to the raw column


def test_line_items_shapes_without_rows(spark):
    shapes = [{"line_items": {"id": 1}}, {"line_items": None}, {}, {"line_items": []}]
    df = raw_orders(spark, [(i, order_payload(i, "2024-01-02T00:00:00Z", **s), dt.datetime(2024, 1, 1), None)
                            for i, s in enumerate(shapes)])
    assert staging.stg_order_line_items(df).count() == 0
    ok = raw_orders(spark, [(9, order_payload(9, "2024-01-02T00:00:00Z", line_items=[
        {"id": 1, "quantity": "2", "price": "1.50", "title": "[SALE] Hat", "sku": {"code": 1}}]),
        dt.datetime(2024, 1, 1), None)])
    r = staging.stg_order_line_items(ok).first()
    assert (r.quantity, r.unit_price, r.line_gross_sales, r.line_title, r.sku) == (2, 1.5, 3.0, "[SALE] Hat", None)


def _purchases(spark, events):
    ev = spark.createDataFrame(events, GA_EVENTS_SCHEMA)
    return staging.stg_ga_purchases(staging.stg_ga_events(ev, Params(event_suffix_floor="20240101")))


def test_transaction_id_whitespace_and_leading_zero(spark):
    orders = staging.stg_orders(raw_orders(spark, [
        (7, order_payload(7, "2024-01-02T00:00:00Z"), dt.datetime(2024, 1, 1), None)]))
    p = _purchases(spark, [event("purchase", T0, txn="\t7\n", revenue=10.0),
                           event("purchase", T0 + dt.timedelta(seconds=1), txn="007", revenue=10.0),
                           event("purchase", T0 + dt.timedelta(seconds=2), txn="(not set)", revenue=1.0),
                           event("purchase", T0 + dt.timedelta(seconds=3), txn="NOT_SET", revenue=1.0)])
    r = {x.ga4_transaction_id: x.match_status for x in reconcile.purchase_reconciliation(p, orders).collect()}
    assert r == {"7": "matched", "007": "unmatched_transaction_id",
                 "(not set)": "unmatched_transaction_id", "NOT_SET": "not_set_transaction_id"}


def test_tie_on_timestamp_is_broken_by_event_key(spark):
    fo = marts.fct_orders(staging.stg_orders(raw_orders(spark, [
        (3, order_payload(3, "2024-01-02T00:00:00Z"), dt.datetime(2024, 1, 1), None)])), Params())
    p = _purchases(spark, [event("purchase", T0, user="ub", txn="3", revenue=10.0, source="b"),
                           event("purchase", T0, user="ua", txn="3", revenue=10.0, source="a")])
    a = reconcile.order_attribution(fo, p).first()
    assert a.user_pseudo_id == "ua" and a.attributed_source == "a"


def test_matched_with_null_source_is_attributed_but_labelled_unattributed(spark):
    fo = marts.fct_orders(staging.stg_orders(raw_orders(spark, [
        (4, order_payload(4, "2024-01-02T00:00:00Z"), dt.datetime(2024, 1, 1), None)])), Params())
    p = _purchases(spark, [event("purchase", T0, txn="4", revenue=10.0, source=None)])
    a = reconcile.order_attribution(fo, p).first()
    assert a.is_attributed is True and a.attributed_source == "unattributed"


def test_attribution_forms_agree(spark, sf_small):
    from tallyspark.plans.build import Models
    m = Models(spark, sf_small)
    direct = reconcile.order_attribution(m.fct_orders, m.stg_ga_purchases)
    literal = reconcile.order_attribution_via_reconciliation(m.fct_orders, m.purchase_reconciliation)
    assert direct.select(*literal.columns).exceptAll(literal).count() == 0
    assert literal.exceptAll(direct.select(*literal.columns)).count() == 0


def test_one_order_two_purchases_same_session_doubles_revenue(spark):
    orders = staging.stg_orders(raw_orders(spark, [
        (8, order_payload(8, "2024-01-02T00:00:00Z", total="10.00"), dt.datetime(2024, 1, 1), None)]))
    evs = [event("page_view", T0 - dt.timedelta(minutes=1)),
           event("purchase", T0, txn="8", revenue=10.0),
           event("purchase", T0 + dt.timedelta(seconds=5), txn="8", revenue=10.0)]
    ev = staging.stg_ga_events(spark.createDataFrame(evs, GA_EVENTS_SCHEMA), Params(event_suffix_floor="20240101"))
    rec = reconcile.purchase_reconciliation(staging.stg_ga_purchases(ev), orders)
    f = marts.fct_funnel(staging.stg_ga_sessions(ev), rec).first()
    assert (f.sessions, f.matched_orders, f.shopify_revenue, f.matched_purchase_sessions) == (1, 1, 20.0, 1)


def test_suffix_floor_is_a_string_compare(spark):
    evs = [event("page_view", T0, suffix="intraday_20260401"), event("page_view", T0, suffix="20260401"),
           event("page_view", T0, suffix="20260331")]
    ev = spark.createDataFrame(evs, GA_EVENTS_SCHEMA)
    p = Params(event_suffix_floor="20260401")
    assert staging.stg_ga_events(ev, p).count() == 2
    assert staging.stg_ga_events(ev, p.with_(daily_shards_only=True)).count() == 1


def test_sessions_any_value_is_earliest_non_null_per_column(spark):
    evs = [event("page_view", T0, source=None), event("view_item", T0 + dt.timedelta(seconds=1), source="b"),
           event("add_to_cart", T0 + dt.timedelta(seconds=2), source="a")]
    ev = staging.stg_ga_events(spark.createDataFrame(evs, GA_EVENTS_SCHEMA), Params(event_suffix_floor="20240101"))
    s = staging.stg_ga_sessions(ev).first()
    assert s.source == "b" and s.event_count == 3 and s.add_to_cart_count == 1


def test_hot_transaction_id_is_handled_without_loss(spark):
    """One id carrying most purchases: every row is reconciled and the first
    purchase wins the attribution (partial aggregation collapses the key)."""
    fo = marts.fct_orders(staging.stg_orders(raw_orders(spark, [
        (1, order_payload(1, "2024-01-02T00:00:00Z"), dt.datetime(2024, 1, 1), None)])), Params())
    evs = [event("purchase", T0 + dt.timedelta(seconds=i), user=f"u{i}", txn="1", revenue=10.0,
                 source=f"s{i}") for i in range(2000)]
    p = _purchases(spark, evs)
    a = reconcile.order_attribution(fo, p).first()
    assert a.attributed_source == "s0"
    rec = reconcile.purchase_reconciliation(p, staging.stg_orders(raw_orders(spark, [
        (1, order_payload(1, "2024-01-02T00:00:00Z"), dt.datetime(2024, 1, 1), None)])))
    assert rec.where("match_status = 'matched'").count() == 2000


def test_build_all_writes_every_model_and_suite_reads_it(spark, sf_small):
    from tallyspark.plans.build import MODEL_NAMES, Models, build_all
    from tallyspark.plans.quality import dq_suite
    from tallyspark.session import fresh_path
    m = Models(spark, sf_small)
    mm = build_all(m, fresh_path(spark, "t-build"))
    assert all(f"{mm.root}/{n}" in mm.__dict__["_built"][n].inputFiles()[0] for n in MODEL_NAMES)
    a = {(r.model, r.column_name, r.test): r.failures for r in dq_suite(mm).collect()}
    b = {(r.model, r.column_name, r.test): r.failures for r in dq_suite(m).collect()}
    assert a == b and len(a) == 108


def test_hot_order_with_many_versions_dedups_exactly(spark):
    """One order landed 3000 times (a third of the table in the extreme):
    the latest version wins; the partial WindowGroupLimit keeps the shuffle
    to one row per map partition."""
    rows = [(1, order_payload(1, f"2024-01-{1 + i % 28:02d}T00:00:00Z", status=f"s{i}"),
             dt.datetime(2024, 2, 1) + dt.timedelta(seconds=i), None) for i in range(3000)]
    rows += [(2, order_payload(2, "2024-01-01T00:00:00Z"), dt.datetime(2024, 2, 1), None)]
    out = staging.stg_orders(raw_orders(spark, rows).repartition(8))
    got = {r.order_id: r.financial_status for r in out.collect()}
    # latest updated_at is day 28 (i % 28 == 27); among those the last ingested wins
    assert got == {1: f"s{max(i for i in range(3000) if i % 28 == 27)}", 2: "paid"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_session_aggregates_exactly(spark):
    evs = [event("page_view" if i % 2 else "view_item", T0 + dt.timedelta(seconds=i), source=None if i < 5 else "s")
           for i in range(3000)]
    evs += [event("page_view", T0, user="u2", sid=7, source="x")]
    ev = staging.stg_ga_events(spark.createDataFrame(evs, GA_EVENTS_SCHEMA).repartition(8),
                               Params(event_suffix_floor="20240101"))
    s = {r.session_key: (r.event_count, r.page_view_count, r.source) for r in staging.stg_ga_sessions(ev).collect()}
    assert s == {"u1-1": (3000, 1500, "s"), "u2-7": (1, 1, "x")}


def test_hot_transaction_id_is_split_by_adaptive_skew_join(spark):
    """With the order side too large to broadcast, a transaction id holding
    most purchases makes one skewed shuffle partition; AQE splits it (the
    final plan shows a skew join) and every row is still reconciled."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        orders = staging.stg_orders(raw_orders(spark, [
            (i, order_payload(i, "2024-01-02T00:00:00Z"), dt.datetime(2024, 1, 1), None) for i in range(200)]))
        evs = [event("purchase", T0 + dt.timedelta(seconds=i), user=f"u{i}", txn="7" if i % 10 else str(i % 200),
                     revenue=10.0) for i in range(4000)]
        rec = reconcile.purchase_reconciliation(_purchases(spark, evs), orders)
        rows = rec.collect()  # runs rec's own query execution -> final adaptive plan
        final = rec._jdf.queryExecution().executedPlan().toString()
        assert sum(r.match_status == "matched" for r in rows) == 4000
        assert "skew=true" in final or "isSkewJoin=true" in final, final[:3000]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_models_as_sql_views(spark, sf_small):
    from tallyspark.plans.build import MODEL_NAMES, Models
    m = Models(spark, sf_small)
    assert m.register_views("t_") == ["t_" + n for n in MODEL_NAMES]
    total = spark.sql("SELECT sum(total_revenue) AS t FROM t_fct_channel_revenue").first().t
    direct = m.fct_orders.agg({"total_price": "sum"}).first()[0]
    assert abs(total - direct) < 0.01


def test_declared_tests_are_all_there():
    """The declarations counted by hand, apart from the engine's own lists."""
    from collections import Counter

    from tallyspark.plans import quality as q
    assert sum(map(len, q.NOT_NULL.values())) == 83
    assert Counter(s for cols in q.NOT_NULL.values() for _, s in cols).keys() <= {"error", "warn"}
    assert len(q.UNIQUE) == 11 and [m for m, _, s in q.UNIQUE if s == "warn"] == ["stg_ga_events"]
    assert [(m, c, len(v), s) for m, c, v, s, _ in q.ACCEPTED_VALUES] == [
        ("stg_products", "status", 3, "warn"), ("purchase_reconciliation", "match_status", 4, "error"),
        ("purchase_reconciliation", "match_type", 1, "error"), ("order_attribution", "attribution_model", 1, "error")]
    assert [(m, len(c), s) for m, c, s in q.UNIQUE_COMBINATION] == [("fct_channel_revenue", 5, "error")]
    assert len(q.SINGULAR) == 9


def test_exact_ties_are_decided_alike_in_any_order(spark):
    from tallyspark.sources.schemas import raw_entity_schema
    now = dt.datetime(2024, 1, 1)
    rows = [("shop-a", 1, None, now, json.dumps(order_payload(1, "2024-01-02T00:00:00Z", note=i)), 1) for i in range(6)]
    picked = {staging.stg_orders(spark.createDataFrame(rows[::step], raw_entity_schema("order")).repartition(n), Params()).first().payload_json
              for step in (1, -1) for n in (1, 3, 5)}
    assert len(picked) == 1


def test_reconciliation_scans_the_events_once(spark, sf_small):
    from tallyspark.params import CHECK_PARAMS
    from tallyspark.plans.build import Models
    plan = Models(spark, sf_small, CHECK_PARAMS).purchase_reconciliation._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ga_events") <= 2 and plan.count("FileScan") == 2  # events and orders


def test_incremental_orders_are_deduplicated_once(spark, sf_small):
    """The changed orders are filtered where they stand: one window, one key
    shuffle and one scan of the raw orders."""
    from tallyspark.params import CHECK_PARAMS
    from tallyspark.plans.build import Models
    m = Models(spark, sf_small, CHECK_PARAMS)
    bound = F.lit("1998-01-01").cast("timestamp")
    for df in (marts.fct_orders(m.stg_orders, CHECK_PARAMS, bound=bound),
               marts.fct_order_lines(m.order_lines_wide, CHECK_PARAMS, bound=bound)):
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        nodes = [line.strip(" +-:*()0123456789").split(" ")[0].split("(")[0] for line in plan.splitlines()]
        assert nodes.count("Window") == 1 and nodes.count("Exchange") == 1 and nodes.count("FileScan") == 1, nodes
