"""Versioned tables and the merge on them: whatever step a run breaks off at,
readers see the old table or the new one, and a rerun completes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyspark import files
from tallyspark.operators import versions
from tallyspark.operators.incremental import merge_partitions
from tallyspark.session import fresh_path

SCHEMA = "k long, v string, p string"


def table(spark, rows):
    path = fresh_path(spark, "t-versions")
    versions.replace(spark.createDataFrame(rows, SCHEMA), path, "p", None)
    return path


def rows(spark, path):
    return sorted((tuple(r) for r in versions.read(spark, path, spark.createDataFrame([], SCHEMA).schema,
                                                   versions.current(spark, path)).collect()), key=str)


def merge(spark, path, updates):
    merge_partitions(path, spark.createDataFrame(updates, SCHEMA), ["k"], "p")
    return rows(spark, path)


def test_merge_rewrites_touched_partitions_alone(spark):
    path = table(spark, [(1, "a", "2024-01"), (2, "a", "2024-01"), (3, "a", "2024-02"), (4, "a", "2024-03"), (6, "a", "2023-12")])
    before = versions.current(spark, path)
    # key 1 in place; key 3 moves from 2024-02 to 2024-03; key 5 is new
    assert merge(spark, path, [(1, "b", "2024-01"), (3, "b", "2024-03"), (5, "b", "2024-04")]) == [
        (1, "b", "2024-01"), (2, "a", "2024-01"), (3, "b", "2024-03"), (4, "a", "2024-03"), (5, "b", "2024-04"), (6, "a", "2023-12")]
    after = versions.current(spark, path)
    assert set(after.folders) == {"2023-12", "2024-01", "2024-03", "2024-04"} and after.number == before.number + 1
    assert after.folders["2023-12"] == before.folders["2023-12"] and after.folders["2024-01"] != before.folders["2024-01"]


def test_null_empty_and_odd_partition_values(spark):
    odd = "a/b =%:é"
    path = table(spark, [(1, "a", None), (2, "a", ""), (3, "a", odd), (None, "a", "x"), (5, None, "y")])
    assert rows(spark, path) == sorted([(1, "a", None), (2, "a", ""), (3, "a", odd), (None, "a", "x"), (5, None, "y")], key=str)
    got = merge(spark, path, [(2, "b", odd), (None, "b", None), (5, "b", "y")])
    assert got == sorted([(1, "a", None), (2, "b", odd), (3, "a", odd), (None, "b", None), (5, "b", "y")], key=str)
    assert set(versions.current(spark, path).folders) == {None, odd, "y"}
    assert merge(spark, path, []) == got


def test_empty_table_and_first_merge(spark):
    path = table(spark, [])
    assert rows(spark, path) == [] and versions.current(spark, path).folders == {}
    assert merge(spark, path, [(1, "a", "x")]) == [(1, "a", "x")]
    new = fresh_path(spark, "t-versions")
    assert versions.current(spark, new) is None and merge(spark, new, [(1, "a", None)]) == [(1, "a", None)]


OLD = [(1, "a", "m1"), (2, "a", "m1"), (3, "a", "m2"), (4, "a", "m3")]
UPDATES = [(1, "b", "m1"), (3, "b", "m1"), (9, "b", "m4")]
NEW = [(1, "b", "m1"), (2, "a", "m1"), (3, "b", "m1"), (4, "a", "m3"), (9, "b", "m4")]


@pytest.mark.parametrize("step", ["data written", "version beside its place", "renamed", "old versions dropped", "first folder deleted"])
def test_a_merge_that_breaks_off(spark, monkeypatch, step):
    path = table(spark, OLD)
    for _ in range(versions.KEEP):  # old versions and folders that a merge deletes
        merge(spark, path, [(4, "a", "m3")])

    def stop(*args, **kw):
        raise RuntimeError("lost driver")

    def after(function):
        def run(*args, **kw):
            function(*args, **kw)
            stop()
        return run

    with monkeypatch.context() as m:
        if step == "data written":
            m.setattr(files, "write_json", stop)
        elif step == "version beside its place":
            m.setattr(files, "rename", stop)
        elif step == "renamed":
            m.setattr(files, "rename", after(files.rename))
        elif step == "old versions dropped":
            m.setattr(files, "delete", after(files.delete))
        else:
            calls = []
            real = files.delete
            m.setattr(files, "delete", lambda s, p: (real(s, p), stop() if "/data/" in p else calls.append(p)))
        with pytest.raises(RuntimeError, match="lost driver"):
            merge(spark, path, UPDATES)
    assert rows(spark, path) in (OLD, NEW)
    assert rows(spark, path) == (OLD if step in ("data written", "version beside its place") else NEW)
    assert merge(spark, path, UPDATES) == NEW
    # Nothing of the broken run is left behind for long.
    for _ in range(versions.KEEP + 1):
        merge(spark, path, UPDATES)
    named = {f.rsplit("/", 1)[0] for n in versions.versions(spark, path) for f in versions._load(spark, path, n).folders.values()}
    assert {f"data/{n}" for n in files.names(spark, f"{path}/data")} == named
    assert len(versions.versions(spark, path)) == versions.KEEP


def test_readers_of_the_version_before_go_on(spark):
    path = table(spark, OLD)
    schema = spark.createDataFrame([], SCHEMA).schema
    before = versions.read(spark, path, schema, versions.current(spark, path))
    merge(spark, path, UPDATES)
    assert sorted(tuple(r) for r in before.collect()) == OLD


def test_a_taken_version_number_is_an_error(spark):
    path = table(spark, OLD)
    base = versions.current(spark, path)
    merge(spark, path, UPDATES)
    with pytest.raises(FileExistsError):
        versions.replace(spark.createDataFrame(OLD, SCHEMA), path, "p", base)
    assert rows(spark, path) == NEW


# ------------------------------------------------------------- incremental facts

def _raw(spark, orders):
    """(order id, payload's updated_at, raw updated_at, created_at, ingested day, status)"""
    from tallyspark.sources.schemas import raw_entity_schema
    t = lambda d: f"2024-{d}T00:00:00Z"
    data = [("shop-a", i, dt.datetime.fromisoformat(t(r)[:-1]) if r else None, dt.datetime(2024, 1, day), json.dumps(
        {"id": i, "created_at": t(c), "financial_status": st, "currency": "USD", "total_price": "1.00"} | ({"updated_at": t(u)} if u else {})), 1)
        for i, u, r, c, day, st in orders]
    return spark.createDataFrame(data, raw_entity_schema("order"))


FIRST = [(1, "01-10", "01-10", "01-01", 1, "paid"), (2, "01-05", "01-05", "01-01", 1, "paid"), (3, None, None, "01-02", 1, "paid"),
         (4, "01-03", "01-03", "01-01", 1, "paid"), (5, "01-04", "01-04", "01-01", 1, "paid")]
LATER = [(2, "01-20", "01-20", "01-01", 2, "refunded"),  # changed
         (3, None, None, "01-15", 2, "moved"),            # no update time: by its creation
         (4, None, "01-19", "01-01", 2, "stale"),         # a payload without time loses to one with
         (6, "01-21", "01-21", "01-21", 2, "new")]


def test_incremental_run_equals_the_full_one(spark):
    from tallyspark.plans import marts, staging
    from tallyspark.plans.incremental import run_fct_orders
    from tallyspark.params import Params
    p = Params(transform_batch_no="t")
    path = fresh_path(spark, "t-fact")
    run_fct_orders(spark, _raw(spark, FIRST), path, p)
    everything = _raw(spark, FIRST + LATER)
    got = {r.order_id: r.financial_status for r in run_fct_orders(spark, everything, path, p).collect()}
    full = {r.order_id: r.financial_status for r in marts.fct_orders(staging.stg_orders(everything, p), p).collect()}
    assert got == full == {1: "paid", 2: "refunded", 3: "moved", 4: "paid", 5: "paid", 6: "new"}


def test_only_changed_orders_are_parsed(spark):
    from tallyspark.plans.incremental import changed_versions
    history = [(i, "01-05", "01-05", "01-01", 1, "paid") for i in range(100, 400)]
    raw = _raw(spark, FIRST + history + LATER)
    met = changed_versions(raw, F.lit(dt.datetime(2024, 1, 9)))
    assert {r.order_id for r in met.collect()} == {1, 2, 3, 4, 6}
    # Every version of those, the old ones too, and nothing of the history.
    assert met.count() == 8
