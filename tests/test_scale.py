"""What a task holds or writes doesn't grow with the tables."""

import json
import os
import shutil
import threading

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyspark import files
from tallyspark.params import CHECK_PARAMS
from tallyspark.plans import landing_jobs, marts
from tallyspark.plans.bucketed import BucketedModels
from tallyspark.plans.build import Inputs, Models
from tallyspark.plans.catalog import ensure_namespace, publish, published_marts
from tallyspark.session import fresh_path, prepare, shared_dir, shuffle_width, size_shuffles
from tallyspark.sources import fixtures, landing

WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_lines_are_sorted_once_and_without_their_json(spark, sf_small):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(fixtures.raw_orders(spark, sf_small, CHECK_PARAMS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ObjectHashAggregate" not in plan
    # Lines and parts by part, lines and orders by order.
    assert sum(line.strip(" :+-").startswith("Sort ") for line in plan.splitlines()) == 4, plan


def test_lines_of_an_order_keep_their_order_and_repeats(spark, tmp_path):
    schema = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
              "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz")
    rows = [(1, 5, 1, 2, 2.0, 10.0, 0.0), (1, 5, 1, 1, 1.0, 7.0, 0.0), (1, 5, 1, 1, 1.0, 7.0, 0.0),
            (1, 5, 1, None, 1.0, 9.0, 0.0), (None, 5, 1, 1, 1.0, 3.0, 0.0), (2, None, 1, 1, 1.0, 4.0, 0.0)]
    spark.createDataFrame([(*r, None) for r in rows], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(5, "part five")], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT k AS o_orderkey, 1L AS o_custkey, 'F' AS o_orderstatus, 10.0D AS o_totalprice, timestamp_ntz'1995-01-01' AS o_orderdate "
              "FROM VALUES (1L), (2L), (3L), (4L), (CAST(NULL AS LONG)) t(k)").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.order_id: json.loads(r.payload_json).get("line_items") for r in fixtures.raw_orders(spark, str(tmp_path)).collect() if r.batch_no == 1}
    assert [li["price"] for li in got[1]] == ["9.0", "7.0", "7.0", "5.0"] and [li["id"] for li in got[1]] == [1001, 1002, 1003, 1004]
    assert [li.get("title") for li in got[2]] == [None]
    assert got[3] is None and got[4] == [] and got[None] is None


def test_events_come_ordered_for_the_write_by_suffix(spark, sf_small, tmp_path):
    df = fixtures.ga_events(spark, sf_small, by_suffix=True)
    assert "_table_suffix" in df._jdf.queryExecution().optimizedPlan().outputOrdering().toString()
    assert not df.schema["_table_suffix"].nullable  # else the write sorts again
    # Events without a time keep no suffix.
    spark.sql("SELECT 1L AS event_id, CAST(NULL AS timestamp_ntz) AS ts, 2L AS user_id, 'view' AS event_type, 1.0D AS value").write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet(f"{sf_small}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    out = f"{tmp_path}/landed"
    fixtures.ga_events(spark, str(tmp_path), by_suffix=True).write.partitionBy("_table_suffix").parquet(out)
    row = spark.read.schema(df.schema).parquet(out).first()
    assert row["_table_suffix"] is None and row["event_date"] is None and row["user_pseudo_id"] == "u2"


def test_shuffles_start_with_partitions_for_the_source(spark):
    before = spark.conf.get(WIDTH, None)
    try:
        spark.conf.unset(WIDTH)
        small = shuffle_width(spark)
        size_shuffles(spark, 1 << 20)
        assert shuffle_width(spark) == small
        size_shuffles(spark, 6 << 30)
        assert shuffle_width(spark) == 768
        size_shuffles(spark, 1 << 30)
        assert shuffle_width(spark) == 768
    finally:
        spark.conf.set(WIDTH, before) if before else spark.conf.unset(WIDTH)


def test_a_session_with_defaults_gets_smaller_task_shares(spark):
    key, others = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k) for k in (key, others)}
    try:
        for k in before:
            spark.conf.unset(k)
        prepare(spark)
        assert (spark.conf.get(key), spark.conf.get(others)) == ("8m", "32m")
        spark.conf.set(key, "16m")  # somebody's choice stays
        prepare(spark)
        assert spark.conf.get(key) == "16m"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_page_files_are_bounded_and_compressed(spark, monkeypatch):
    monkeypatch.setattr(landing, "RECORDS_PER_FILE", 500)
    root = fresh_path(spark, "t-page-files")
    texts = [json.dumps({"id": i}, separators=(",", ":")) for i in range(2100)]
    recs = spark.createDataFrame([(t,) for t in [*texts, None]], "payload_json string").coalesce(1)
    landing.write_pages(recs, "order", root)
    parts = [n for n in files.names(spark, root) if n.startswith("part-")]
    assert len(parts) == 5 and all(n.endswith(".gz") for n in parts)
    got = [r.payload_json for r in landing.unwrap_pages(landing.read_pages(spark, root)).collect()]
    assert sorted(got) == sorted(texts)
    landing.write_pages(recs, "order", root, mode="append")
    assert landing.unwrap_pages(landing.read_pages(spark, root)).count() == 2 * 2100


def test_micro_batches_of_many_page_files(spark, sf_small, monkeypatch):
    monkeypatch.setattr(landing, "RECORDS_PER_FILE", 100)
    monkeypatch.setattr(landing, "API_PAGE_SIZE", 100)
    monkeypatch.setattr(landing.write_pages, "__defaults__", (100, "overwrite"))
    m = Models(spark, sf_small, CHECK_PARAMS, Inputs(spark, sf_small, CHECK_PARAMS, landed=False))
    got = landing_jobs.stream_in_batches(m)
    batches = {os.path.basename(os.path.dirname(f)) for f in got.select("order_id").inputFiles()}
    assert 6 <= len(batches) < 12, batches
    assert got.count() == m.inputs.raw_orders.where("batch_no = 1").count()
    assert got.select("last_updated_at").distinct().count() == 1


def test_pages_of_a_scenario_go_once_they_have_landed(spark, sf_small):
    m = Models(spark, sf_small, CHECK_PARAMS)
    for job, left in ((landing_jobs.stream_new_checkpoint, ("landing-new-checkpoint-", "/pages")), (landing_jobs.second_snapshot, ("pages-second-", ""))):
        before = set(files.names(spark, shared_dir(spark)))
        assert job(m).count() > m.inputs.raw_orders.where("batch_no = 1").count() * 0.9
        new = [n for n in files.names(spark, shared_dir(spark)) if n not in before]
        assert not any(files.exists(spark, f"{shared_dir(spark)}/{n}{left[1]}") for n in new if n.startswith(left[0])), new
        assert not any(n.startswith("pages-later-") for n in new)


def test_staged_buckets_without_lines(spark, sf_small):
    root = fresh_path(spark, "t-lean-buckets")
    spark.sql(f"CREATE DATABASE tally_lean LOCATION '{root}'")
    try:
        b = BucketedModels(Models(spark, sf_small, CHECK_PARAMS), "tally_lean", root, lines=False)
        assert b.order_attribution.count() == 1500
        staged = spark.table("tally_lean.stg_orders_parsed")
        assert "_li" not in staged.columns and staged.count() == 1500
    finally:
        spark.sql("DROP DATABASE tally_lean CASCADE")


def test_marts_are_published_from_shared_tables(spark, sf_small):
    root = fresh_path(spark, "t-publish")
    before = set(files.names(spark, shared_dir(spark)))
    ensure_namespace(spark, "tally_shared", root)
    try:
        publish(Models(spark, sf_small, CHECK_PARAMS), "tally_shared", root)
        written = [n for n in files.names(spark, shared_dir(spark)) if n.startswith("written-models-") and n not in before]
        assert len(written) == 1
        assert {"stg_orders", "stg_ga_purchases", "order_attribution"} <= set(files.names(spark, f"{shared_dir(spark)}/{written[0]}"))
        assert "payload_json" in spark.table("stg_orders").columns and spark.table("tally_shared.fct_orders").count() == 1500
    finally:
        spark.sql("DROP DATABASE tally_shared CASCADE")


def test_lines_are_written_as_json_once_and_in_generated_code(spark, sf_small, tmp_path):
    """no function of an array's elements and no parse builds the lines, and versions share their text."""
    plan = fixtures.raw_orders(spark, sf_small, CHECK_PARAMS)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "parse_json" not in plan
    schema = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
              "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz")
    # Line ids 53 * 89 = 4717 and 53 * 1000: an object as sku, without a part none.
    rows = [(4, 5, 1, n, 1.0, 7.0, 0.5) for n in range(1, 718)] + [(52, None, 1, n, 3.0, 7.0, 0.1) for n in range(1, 1001)] + [(7, 10, 1, 1, None, 7.0, None)]
    spark.createDataFrame([(*r, None) for r in rows], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(5, 'a "b" \\ {c} é\n'), (10, None)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT k AS o_orderkey, 1L AS o_custkey, s AS o_orderstatus, t AS o_totalprice, timestamp_ntz'1995-01-01' AS o_orderdate "
              "FROM VALUES (4L, 'F', 10.0D), (7L, 'F', 10.0D), (52L, 'F', 10.0D), (CAST(NULL AS LONG), NULL, CAST(NULL AS DOUBLE)) t(k, s, t)").write.parquet(f"{tmp_path}/orders.parquet")
    text = {(r.order_id, r.batch_no): r.payload_json for r in fixtures.raw_orders(spark, str(tmp_path)).collect()}
    lines = {k: json.loads(v).get("line_items") for k, v in text.items()}
    assert lines[4, 1][716] == {"id": 4717, "product_id": 5, "variant_id": 51, "title": 'a "b" \\ {c} é\n', "sku": {"code": 5},
                                "quantity": "0" if 4717 % 97 == 0 else "2.0", "price": "7.0", "total_discount": "3.5"}
    assert lines[4, 1][0]["sku"] == "SKU-5" and len(lines[4, 1]) == 717
    assert lines[52, 1][999] == {"id": 53000, "quantity": "3", "price": "2.33", "total_discount": "0.7"}
    assert text[7, 1].endswith(',"line_items":[{"id":7001,"product_id":10,"variant_id":101,"sku":"SKU-10"}]}') and lines[7, 2] == lines[7, 1]
    assert lines[None, 1] is None and json.loads(text[None, 1])["currency"] == "USD"


def test_the_coverage_lands_its_two_inputs_side_by_side(spark, tmp_path, monkeypatch):
    """the second landing waits for the first, so that neither goes on without the other."""
    source = str(shutil.copytree("/root/testdata/sf0.001", tmp_path / "source"))  # landed anew: known by path and time
    both = threading.Barrier(2, timeout=60)
    for name in ("raw_orders", "ga_events"):
        monkeypatch.setattr(fixtures, name, lambda *a, build=getattr(fixtures, name), **kw: both.wait() >= 0 and build(*a, **kw))
    got = entry.queries()["attribution_coverage"](spark, source).collect()
    assert got == entry.queries()["attribution_coverage"](spark, "/root/testdata/sf0.001").collect() and got[0].orders == 1500


def test_marts_are_published_compressed_from_the_columns_they_read(spark, sf_small):
    """the written order hub has no column that no mart reads, the marts are zstd, and a passing
    database leaves no files."""
    root = fresh_path(spark, "t-publish-lean")
    before = set(files.names(spark, shared_dir(spark)))
    ensure_namespace(spark, "tally_lean_marts", root)
    try:
        publish(Models(spark, sf_small, CHECK_PARAMS), "tally_lean_marts", root)
        new = [n for n in files.names(spark, shared_dir(spark)) if n.startswith("written-models-") and n not in before]
        hub = spark.read.parquet(f"{shared_dir(spark)}/{new[0]}/stg_orders")
        assert "processed_at" not in hub.columns and "order_name" in hub.columns and hub.count() == 1500
        assert all(n.endswith(".zstd.parquet") for n in files.names(spark, f"{root}/fct_order_lines") if n.startswith("part-"))
        assert spark.table("tally_lean_marts.fct_attributed_orders").columns == marts.FCT_ATTRIBUTED_COLUMNS
        assert spark.table("tally_lean_marts.fct_orders").columns == marts.FCT_ORDER_COLUMNS
    finally:
        spark.sql("DROP DATABASE tally_lean_marts CASCADE")
    before = set(files.names(spark, shared_dir(spark)))
    assert published_marts(Models(spark, sf_small, CHECK_PARAMS)).count() == 5
    assert not [n for n in files.names(spark, shared_dir(spark)) if n.startswith("catalog-") and n not in before]
