"""Property test: ``parse_fields`` + ``scalar_text`` against a Python model
of warehouse ``JSON_VALUE`` (scalars as text, NULL for null/object/array)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.functions.json import parse_fields, scalar_text

KEYS = ["a", "b", "c", "d"]
text = st.one_of(st.text(max_size=12), st.sampled_from(["[SALE] Hat", "{x}", "[", "{\"k\": 1}", "", " "]))
scalar = st.one_of(text, st.integers(min_value=-10**15, max_value=10**15), st.booleans(), st.none())
nested = st.recursive(scalar, lambda kids: st.one_of(st.lists(kids, max_size=3),
                                                     st.dictionaries(st.text(max_size=3), kids, max_size=3)),
                      max_leaves=5)
doc = st.dictionaries(st.sampled_from(KEYS), nested, max_size=4)


def expected(d: dict, k: str):
    if k not in d:
        return None
    v = d[k]
    if v is None or isinstance(v, (dict, list)):
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(doc, min_size=1, max_size=40))
def test_scalar_text_matches_json_value(spark, docs):
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "i int, doc string")
    p = parse_fields("doc", KEYS)
    got = {r.i: r for r in df.select("i", *[scalar_text(p, F.col("doc"), k).alias(k) for k in KEYS]).collect()}
    for i, d in enumerate(docs):
        for k in KEYS:
            assert got[i][k] == expected(d, k), (d, k, got[i][k])
