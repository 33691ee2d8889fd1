"""Daily event shards: found by name, pruned before they are opened, of any layout."""

import pytest
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.params import CHECK_PARAMS
from tallyspark.plans.build import Models
from tallyspark.plans.landing_jobs import write_shards
from tallyspark.session import fresh_path
from tallyspark.sources.shards import find_shards, read_shards


@pytest.fixture(scope="module")
def root(spark, sf_small):
    path = fresh_path(spark, "t-shards")
    write_shards(Models(spark, sf_small, CHECK_PARAMS).inputs.ga_events, path)
    return path


def test_shards_before_the_floor_are_not_opened(spark, root):
    everything = find_shards(spark, root, "")
    assert len(everything) > 25 and "intraday_20240130" in everything
    late = read_shards(spark, root, "20240125")
    assert {f.rsplit("/", 2)[-2] for f in late.inputFiles()} == {f"events_{s}" for s in ("20240125", "20240126", "20240127", "20240128", "20240129", "intraday_20240130")}
    assert set(find_shards(spark, root, "20240125", daily_only=True)) == {f"202401{d}" for d in range(25, 30)}
    # A broken shard of old times disturbs nobody.
    old = f"{root}/events_20200101"
    files.write_json(spark, f"{old}/part-0.parquet", "not parquet")
    assert read_shards(spark, root, "20240125").count() == late.count()
    files.delete(spark, old)


def test_layouts_meet_in_one_schema(spark, root):
    ev = read_shards(spark, root, "20240101")
    assert "platform" not in ev.columns
    by_day = {r._table_suffix: r for r in ev.groupBy("_table_suffix").agg(F.count("*").alias("n"), F.count("items").alias("with_items")).collect()}
    assert all(r.with_items == 0 for s, r in by_day.items() if s < "20240115") and by_day["20240116"].with_items > 0


def test_a_nested_field_that_a_shard_lacks(spark):
    path = fresh_path(spark, "t-shards-nested")
    spark.createDataFrame([("purchase", 1, ("T1",))], "event_name string, event_timestamp long, ecommerce struct<transaction_id:string>").write.parquet(f"{path}/events_20240101")
    row = read_shards(spark, path, "2024").first()
    assert row.ecommerce.transaction_id == "T1" and row.ecommerce.purchase_revenue is None and row.event_params is None and row._table_suffix == "20240101"
    assert read_shards(spark, path, "2025").collect() == [] and read_shards(spark, f"{path}/none", "2024").collect() == []


def test_the_graph_runs_on_shards(spark, sf_small, root):
    whole = Models(spark, sf_small, CHECK_PARAMS)
    sharded = Models(spark, sf_small, CHECK_PARAMS.with_(event_shards_root=root))
    assert sorted(map(tuple, sharded.stg_ga_purchases.collect()), key=str) == sorted(map(tuple, whole.stg_ga_purchases.collect()), key=str)
