"""Bucketed orders and facts: equal results, and no shuffle of the orders."""

from tallyspark.params import CHECK_PARAMS
from tallyspark.plans.bucketed import BucketedModels, attribution_from_buckets
from tallyspark.plans.build import Models
from tallyspark.session import fresh_path


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_orders_are_not_shuffled_again(spark, sf_small):
    plain = Models(spark, sf_small, CHECK_PARAMS)
    root = fresh_path(spark, "t-bucketed")
    spark.sql(f"CREATE DATABASE tally_buckets LOCATION '{root}'")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = BucketedModels(plain, "tally_buckets", root)
        joined = m.order_attribution
        # The purchases, by the order they name; nothing on the order side.
        assert len(_exchanges(joined)) == 1 and "_named" in _exchanges(joined)[0], _exchanges(joined)
        assert _exchanges(m.fct_orders) == [] and _exchanges(m.fct_order_lines) == []
        # The first level of the channel counts keeps the buckets as well.
        assert len(_exchanges(m.fct_channel_revenue)) == 3
        for name in ("fct_orders", "fct_order_lines", "order_attribution", "fct_channel_revenue"):
            assert sorted(map(tuple, getattr(m, name).collect()), key=str) == sorted(map(tuple, getattr(plain, name).collect()), key=str), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE tally_buckets CASCADE")


def test_the_database_goes_and_the_result_stays(spark, sf_small):
    before = {d.name for d in spark.catalog.listDatabases()}
    m = Models(spark, sf_small, CHECK_PARAMS)
    assert attribution_from_buckets(m).count() == m.fct_orders.count()
    assert {d.name for d in spark.catalog.listDatabases()} == before
