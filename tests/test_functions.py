"""JSON scalar / safe-cast parity cases (D7, D8) and the event-param lookup."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark.functions.casts import safe_bigint, safe_double, safe_timestamp
from tallyspark.functions.events import event_param
from tallyspark.functions.json import parse_fields, scalar_text
from tallyspark.sources.schemas import GA_EVENTS_SCHEMA


def test_json_value_objects_and_arrays_are_null(spark):
    docs = ['{"t": "[SALE] Hat", "o": {"a": 1}, "a": [1], "s": "{\\"x\\": 1}", "n": null}', "not json"]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    p = parse_fields("doc", ["t", "o", "a", "s", "n"])
    rows = df.select(*[scalar_text(p, F.col("doc"), k).alias(k) for k in "toasn"]).collect()
    assert rows[0].asDict() == {"t": "[SALE] Hat", "o": None, "a": None, "s": '{"x": 1}', "n": None}
    assert rows[1].asDict() == dict.fromkeys("toasn")


def test_safe_casts_reject_lenient_spark_forms(spark):
    df = spark.createDataFrame([("2026",), ("10:00",), ("1.5d",), ("12.0",), ("7",), ("n/a",),
                                ("2024-01-05T10:00:00Z",), ("-3.5e2",)], "s string")
    rows = df.select("s", safe_bigint("s").alias("i"), safe_double("s").alias("d"),
                     safe_timestamp("s").alias("t")).collect()
    got = {r.s: (r.i, r.d, r.t) for r in rows}
    assert got["2026"][2] is None and got["10:00"][2] is None
    assert got["1.5d"][1] is None
    assert got["12.0"][0] is None and got["12.0"][1] == 12.0
    assert got["7"][0] == 7
    assert got["n/a"] == (None, None, None)
    assert got["2024-01-05T10:00:00Z"][2] == dt.datetime(2024, 1, 5, 10, 0)
    assert got["-3.5e2"][1] == -350.0


def test_event_param_first_match_and_missing(spark):
    row = {"event_name": "x", "event_timestamp": 1, "event_date": "20240105", "user_pseudo_id": "u",
           "event_params": [{"key": "source", "value": {"string_value": "a", "int_value": None}},
                            {"key": "source", "value": {"string_value": "b", "int_value": None}}],
           "ecommerce": None, "items": None, "_table_suffix": "20240105"}
    df = spark.createDataFrame([row], GA_EVENTS_SCHEMA)
    r = df.select(event_param("source", "string").alias("s"),
                  event_param("ga_session_id", "int").alias("g")).first()
    assert r.s == "a" and r.g is None


def test_duplicate_param_keys_are_reported(spark):
    from types import SimpleNamespace

    from tallyspark.params import Params
    from tallyspark.plans.quality import dq_duplicate_param_keys
    p = {"key": "source", "value": {"string_value": "a", "int_value": None}}
    rows = [{"event_name": "x", "event_timestamp": i, "event_date": "20240105", "user_pseudo_id": "u",
             "event_params": [p, p] if i == 1 else [p], "ecommerce": None, "items": None,
             "_table_suffix": "20240105"} for i in (1, 2)]
    m = SimpleNamespace(inputs=SimpleNamespace(ga_events=spark.createDataFrame(rows, GA_EVENTS_SCHEMA)),
                        params=Params(event_suffix_floor="20240101"))
    assert [r.event_timestamp for r in dq_duplicate_param_keys(m).collect()] == [1]


def test_money_sums_keep_small_and_large_amounts(spark):
    from pyspark.sql import functions as F

    from tallyspark.functions.money import money_sum
    rows = spark.range(1000).select(F.lit(0.004).alias("x"), F.lit(1e17).alias("y"))
    r = rows.agg(money_sum("x").cast("double").alias("x"), money_sum("y").cast("double").alias("y")).first()
    assert (r.x, r.y) == (4.0, 1e20)
