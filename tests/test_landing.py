"""Landing checkpoint semantics, reruns, the file stream and incremental merges."""

import datetime as dt
import json

from pyspark.sql import functions as F


from tallyspark.operators.incremental import lookback_bound, merge_into
from tallyspark.params import Params
from tallyspark.plans import marts, staging
from tallyspark.session import fresh_path
from tallyspark.sources import landing
from tallyspark.streaming.landing_stream import land_stream

CKPT = dt.datetime(2024, 1, 10, 0, 0, 0)


def records(spark, items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "payload_json string")


def test_checkpoint_boundary_cases(spark):
    recs = records(spark, [
        {"id": 1, "updated_at": "2024-01-10T00:00:00Z"},          # exactly at checkpoint: dropped
        {"id": 2, "updated_at": "2024-01-10T00:00:00.000001Z"},   # 1 us later: kept
        {"id": 3},                                                # no updated_at: kept
    ])
    state = landing.state_of(spark, [("order", CKPT)])
    kept = landing.incremental_filter(landing.raw_rows(recs, "order", "shop-a", 1), state, "order")
    assert sorted(r.order_id for r in kept.collect()) == [2, 3]
    wm = landing.high_watermark(kept, "order").first()
    assert wm.last_updated_at == dt.datetime(2024, 1, 10, 0, 0, 0, 1)


def test_batch_without_updated_at_leaves_checkpoint(spark):
    recs = records(spark, [{"id": 3}])
    state = landing.state_of(spark, [("order", CKPT)])
    kept = landing.incremental_filter(landing.raw_rows(recs, "order", "shop-a", 1), state, "order")
    new = landing.merge_state(state, landing.high_watermark(kept, "order")).collect()
    assert [(r.source, r.last_updated_at) for r in new] == [("order", CKPT)]


def test_empty_batch_leaves_state(spark):
    state = landing.state_of(spark, [("order", CKPT), ("product", None)])
    kept = landing.raw_rows(spark.createDataFrame([], "payload_json string"), "order", "shop-a", 1)
    new = landing.merge_state(state, landing.high_watermark(kept, "order")).orderBy("source").collect()
    assert [(r.source, r.last_updated_at) for r in new] == [("order", CKPT), ("product", None)]


def test_pages_first_key_and_rerun(spark):
    root = fresh_path(spark, "t-landing")
    pages = spark.createDataFrame([('{"orders": [{"id": 1, "updated_at": "2024-01-11T00:00:00Z"}, '
                                    '{"id": 2}], "next": "x"}',)], "value string")
    recs = landing.unwrap_pages(pages)
    assert recs.count() == 2
    for b in (1, 2):
        landing.land_batch(spark, recs, "order", f"{root}/raw", f"{root}/state", "shop-a", b)
    raw = landing.read_raw(spark, "order", f"{root}/raw")
    # second run: only the record without updated_at is appended again
    assert sorted((r.order_id, r.batch_no) for r in raw.collect()) == [(1, 1), (2, 1), (2, 2)]
    st = landing.read_state(spark, f"{root}/state").first()
    assert st.last_updated_at == dt.datetime(2024, 1, 11)


def test_stream_rerun_lands_nothing(spark):
    root = fresh_path(spark, "t-stream")
    pages_dir = f"{root}/pages"
    spark.createDataFrame([('{"orders": [{"id": 1, "updated_at": "2024-01-11T00:00:00Z"}]}',)],
                          "value string").write.text(pages_dir)
    for _ in range(2):
        land_stream(spark, pages_dir, "order", f"{root}/raw", f"{root}/state", f"{root}/ckpt", "shop-a")
    assert landing.read_raw(spark, "order", f"{root}/raw").count() == 1


def _orders(spark, rows):
    from tallyspark.sources.schemas import raw_entity_schema
    data = [("shop-a", oid, None, dt.datetime(2024, 1, 1),
             json.dumps({"id": oid, "created_at": "2024-01-01T00:00:00Z", "updated_at": upd,
                         "financial_status": st, "currency": "USD", "total_price": "1.00"}), 1)
            for oid, upd, st in rows]
    return spark.createDataFrame(data, raw_entity_schema("order"))


def test_lookback_remerges_23h_but_not_25h(spark):
    p = Params(transform_batch_no="t")
    target = marts.fct_orders(staging.stg_orders(_orders(spark, [
        (1, "2024-01-10T00:00:00Z", "paid"), (2, "2024-01-09T01:00:00Z", "paid"),
        (3, "2024-01-08T23:00:00Z", "paid")])), p)
    # order 2 changed 23h before the target max, order 3 changed 25h before
    changed = staging.stg_orders(_orders(spark, [
        (1, "2024-01-10T00:00:00Z", "paid"), (2, "2024-01-09T01:00:00Z", "refunded"),
        (3, "2024-01-08T23:00:00Z", "refunded")]))
    bound = lookback_bound(target, "order_updated_at", p.lookback, p.lookback_floor)
    merged = merge_into(target, marts.fct_orders(changed, p, bound=bound), ["order_id"])
    got = {r.order_id: r.financial_status for r in merged.collect()}
    assert got == {1: "paid", 2: "refunded", 3: "paid"}


def test_first_run_bound_is_floor(spark):
    p = Params()
    b = spark.range(1).select(lookback_bound(None, "x", p.lookback, p.lookback_floor).alias("b")).first().b
    assert b == dt.datetime(1900, 1, 1)


def test_pages_are_bounded_even_with_repeated_ids(spark):
    root = fresh_path(spark, "t-pages")
    recs = records(spark, [{"id": 1, "n": i} for i in range(1200)]).repartition(3)
    landing.write_pages(recs, "order", root, page_size=250)
    pages = landing.read_pages(spark, root)
    sizes = [r.n for r in pages.select(F.size(F.from_json("value", "map<string,array<string>>")["orders"]).alias("n")).collect()]
    assert sum(sizes) == 1200 and max(sizes) <= 250
    assert landing.unwrap_pages(pages).count() == 1200


def test_unreadable_page_is_an_error(spark):
    import pytest
    good = '{"orders": [{"id": 1}]}'
    for bad in ['{"orders": [{"id": 2}', '{"orders": {"id": 2}}', "nonsense", "{}"]:
        pages = spark.createDataFrame([(good,), (bad,)], "value string")
        with pytest.raises(Exception, match="unreadable page"):
            landing.unwrap_pages(pages).collect()
    quiet = spark.createDataFrame([(good,), ("  ",), ('{"orders": []}',)], "value string")
    assert landing.unwrap_pages(quiet).count() == 1


def test_pages_of_several_lines(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"orders": [{"id": 1}, {"id": 2}]}, indent=2))
    assert landing.unwrap_pages(landing.read_pages(spark, str(tmp_path), whole_files=True)).count() == 2
    root = fresh_path(spark, "t-whole")
    land_stream(spark, str(tmp_path), "order", f"{root}/raw", f"{root}/state", f"{root}/ckpt", "shop-a", whole_files=True)
    assert landing.read_raw(spark, "order", f"{root}/raw").count() == 2


def _page_file(directory, name, ids_and_days):
    directory.mkdir(exist_ok=True)
    (directory / name).write_text(json.dumps(
        {"orders": [{"id": i, "updated_at": f"2024-01-{d:02d}T00:00:00Z"} for i, d in ids_and_days]}) + "\n")


def test_stream_in_micro_batches_loses_nothing(spark, tmp_path):
    pages, root = tmp_path / "pages", fresh_path(spark, "t-micro")
    _page_file(pages, "a.json", [(1, 20), (2, 25)])  # the newest records come first
    _page_file(pages, "b.json", [(3, 12), (4, 11)])

    def run():
        land_stream(spark, str(pages), "order", f"{root}/raw", f"{root}/state", f"{root}/ckpt", "shop-a", max_files_per_trigger=1)
        return sorted(r.order_id for r in landing.read_raw(spark, "order", f"{root}/raw").collect())

    assert run() == [1, 2, 3, 4]
    assert landing.read_state(spark, f"{root}/state").first().last_updated_at == dt.datetime(2024, 1, 25)
    _page_file(pages, "c.json", [(5, 26), (6, 24)])  # the next run has the first run's bound
    assert run() == [1, 2, 3, 4, 5]


def _ids(spark, root):
    return sorted(r.order_id for r in landing.read_raw(spark, "order", f"{root}/raw").collect())


def test_a_new_checkpoint_at_the_same_path_adds(spark, tmp_path):
    import shutil
    pages, root, ckpt = tmp_path / "pages", fresh_path(spark, "t-new-ckpt"), tmp_path / "ckpt"
    _page_file(pages, "a.json", [(1, 11), (2, 12)])

    def run():
        land_stream(spark, str(pages), "order", f"{root}/raw", f"{root}/state", str(ckpt), "shop-a")
        return _ids(spark, root)

    assert run() == [1, 2]
    shutil.rmtree(ckpt)
    _page_file(pages, "b.json", [(3, 13)])
    assert run() == [1, 2, 3]  # the pages read again are at or before the checkpoint of the source
    assert run() == [1, 2, 3]
    assert landing.read_state(spark, f"{root}/state").first().last_updated_at == dt.datetime(2024, 1, 13)


def _entity_rows(spark, ids):
    return lambda batch_no: landing.kept_rows(records(spark, [{"id": i, "updated_at": f"2024-01-{i:02d}T00:00:00Z"} for i in ids]),
                                              landing.empty_state(spark), "order", "shop-a", batch_no)


def _ledger(spark, stream="one", root=None):
    from tallyspark.sources.ledger import Ledger
    root = root or fresh_path(spark, "t-ledger")
    landing.ensure_raw_table(spark, "order", f"{root}/raw")
    return root, Ledger(spark, f"{root}/raw", stream)


def test_a_replayed_epoch_lands_once_and_streams_stay_apart(spark):
    root, one = _ledger(spark)
    first = one.land(0, _entity_rows(spark, [1, 2]))
    assert one.land(0, _entity_rows(spark, [1, 2])) == first and first["rows"] == 2
    one.land(1, _entity_rows(spark, [3]))
    _ledger(spark, "two", root)[1].land(0, _entity_rows(spark, [4]))
    assert _ids(spark, root) == [1, 2, 3, 4]
    assert landing.read_raw(spark, "order", f"{root}/raw").select("batch_no").distinct().count() == 3


def test_empty_epoch_and_records_without_time(spark):
    root, one = _ledger(spark)
    e = one.land(0, _entity_rows(spark, []))
    assert (e["rows"], e["watermark"]) == (0, None)
    e = one.land(1, lambda n: landing.kept_rows(records(spark, [{"id": 9}]), landing.empty_state(spark), "order", "shop-a", n))
    assert (e["rows"], e["watermark"]) == (1, None) and _ids(spark, root) == [9]
    assert [x["epoch"] for x in one.uncommitted()] == [0, 1]
    one.commit(1)
    one.commit(3)
    assert one.uncommitted() == [] and one._committed() == 3


def test_a_batch_that_breaks_off_at_any_step(spark, monkeypatch):
    import pytest
    from tallyspark import files

    def stop(*a, **kw):
        raise RuntimeError("lost driver")

    def only(real, part, late=False):
        def run(s, path, *rest):
            if part in path or (rest and isinstance(rest[0], str) and part in rest[0]):
                if late:
                    real(s, path, *rest)
                stop()
            return real(s, path, *rest)
        return run

    for name, part, late in (("write_json", "_ledger/", False), ("write_json", "_ledger/", True), ("write_json", "_batch.json", False),
                             ("write_json", "_batch.json", True), ("rename", "batch_no=", False), ("rename", "batch_no=", True)):
        root, one = _ledger(spark)
        one.land(0, _entity_rows(spark, [1]))
        with monkeypatch.context() as m:
            m.setattr(files, name, only(getattr(files, name), part, late))
            with pytest.raises(RuntimeError, match="lost driver"):
                one.land(1, _entity_rows(spark, [2, 3]))
        assert _ids(spark, root) in ([1], [1, 2, 3])  # never a part of the batch
        one.land(1, _entity_rows(spark, [2, 3]))
        assert _ids(spark, root) == [1, 2, 3], (name, part, late)


def test_a_number_that_another_landing_took(spark):
    from tallyspark import files
    root, one = _ledger(spark)
    files.write_json(spark, f"{one.folder}/000000000000.json", {"batch_no": 7})
    landing.land_batch(spark, records(spark, [{"id": 5}]), "order", f"{root}/raw", f"{root}/state", "shop-a", 7)
    assert one.land(0, _entity_rows(spark, [1]))["batch_no"] != 7
    assert _ids(spark, root) == [1, 5]


def test_watermark_of_a_run_that_broke_off_before_its_commit(spark, tmp_path, monkeypatch):
    import pytest
    from tallyspark.streaming import landing_stream
    pages, root = tmp_path / "pages", fresh_path(spark, "t-late")
    _page_file(pages, "a.json", [(1, 20)])

    def run():
        land_stream(spark, str(pages), "order", f"{root}/raw", f"{root}/state", f"{root}/ckpt", "shop-a")

    def stop(*a):
        raise RuntimeError("lost driver")
    with monkeypatch.context() as m:
        m.setattr(landing_stream, "commit_watermark", stop)
        with pytest.raises(RuntimeError):
            run()
    assert landing.read_state(spark, f"{root}/state").collect() == []
    run()  # no new page, but the landed epoch counts
    assert landing.read_state(spark, f"{root}/state").first().last_updated_at == dt.datetime(2024, 1, 20)
    assert _ids(spark, root) == [1]


def _merge(spark, target, updates):
    from tallyspark.operators import incremental, versions
    schema = "k long, v string, p string"
    path = fresh_path(spark, "t-null-merge")
    df = spark.createDataFrame(target, schema)
    versions.replace(df, path, "p", None)
    incremental.merge_partitions(path, spark.createDataFrame(updates, schema), ["k"], "p")
    return sorted((tuple(r) for r in versions.read(spark, path, df.schema, versions.current(spark, path)).collect()), key=str)


def test_merge_keeps_and_moves_rows_of_the_null_partition(spark):
    target = [(1, "a", None), (2, "a", None), (3, "a", "2024-01")]
    assert _merge(spark, target, [(1, "b", None)]) == sorted([(1, "b", None), (2, "a", None), (3, "a", "2024-01")], key=str)
    assert _merge(spark, target, [(1, "b", "2024-01")]) == sorted([(1, "b", "2024-01"), (2, "a", None), (3, "a", "2024-01")], key=str)
    assert _merge(spark, target[:1] + target[2:], [(1, "b", "2024-01")]) == [(1, "b", "2024-01"), (3, "a", "2024-01")]
    assert _merge(spark, target, [(3, "b", None)]) == sorted([(1, "a", None), (2, "a", None), (3, "b", None)], key=str)


def test_unparseable_creation_time_survives_the_incremental_fact(spark):
    from tallyspark.plans.incremental import run_fct_orders
    from tallyspark.sources.schemas import raw_entity_schema

    def raw(rows):
        return spark.createDataFrame([("shop-a", i, None, dt.datetime(2024, 1, d), json.dumps(
            {"id": i, "created_at": c, "updated_at": u, "financial_status": st, "currency": "USD", "total_price": "1.00"}), 1)
            for i, c, u, st, d in rows], raw_entity_schema("order"))

    path = fresh_path(spark, "t-null-fact")
    first = [(1, "n/a", "2024-01-10T00:00:00Z", "paid", 1), (2, "n/a", "2024-01-10T00:00:00Z", "paid", 1),
             (3, "2024-01-01T00:00:00Z", "2024-01-10T00:00:00Z", "paid", 1)]
    run_fct_orders(spark, raw(first), path)
    later = first + [(2, "n/a", "2024-01-20T00:00:00Z", "refunded", 2)]
    got = {r.order_id: r.financial_status for r in run_fct_orders(spark, raw(later), path).collect()}
    assert got == {1: "paid", 2: "refunded", 3: "paid"}


def test_replaced_source_files_change_the_answer(spark, tmp_path, sf_small):
    import os
    import shutil
    from tallyspark.params import CHECK_PARAMS
    from tallyspark.plans.build import Models
    sf = str(tmp_path / "sf")
    shutil.copytree(sf_small, sf)
    for d, _, names in os.walk(sf):
        for n in [d, *(f"{d}/{x}" for x in names)]:
            os.chmod(n, 0o755)
    before = Models(spark, sf, CHECK_PARAMS).stg_orders.count()
    few = spark.read.parquet(f"{sf_small}/orders.parquet").limit(before // 3)
    few.toPandas().to_parquet(f"{sf}/orders.parquet", coerce_timestamps="us")
    assert Models(spark, sf, CHECK_PARAMS).stg_orders.count() == before // 3


def test_cli_land_batch(spark, tmp_path):
    from tallyspark.__main__ import main
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "p.json").write_text('{"orders": [{"id": 5, "updated_at": "2024-01-11T00:00:00Z"}]}\n')
    root = fresh_path(spark, "t-cli")
    assert main(["land", "--root", root, "--pages", f"order={pages}", "--batch-no", "1"]) == 0
    assert landing.read_raw(spark, "order", f"{root}/raw_orders").count() == 1


def test_incremental_fact_from_empty_first_run(spark):
    from tallyspark.plans.incremental import run_fct_orders
    from tallyspark.sources.schemas import raw_entity_schema
    path = fresh_path(spark, "t-empty-fact")
    empty = spark.createDataFrame([], raw_entity_schema("order"))
    assert run_fct_orders(spark, empty, path).count() == 0
    later = _orders(spark, [(1, "2024-01-10T00:00:00Z", "paid")])
    got = run_fct_orders(spark, later, path).collect()
    assert [(r.order_id, r.financial_status) for r in got] == [(1, "paid")]


ODD_PAGES = ['{"orders":[{"id":1,"x":1.10,"y":1e400,"z":"a\\/\\u00e9"},7,"x",null,[1,2]],"next":"abc"}', '{"orders":[{"id":1}],"next":null}',
             '{"orders":[]}', '{"orders":[1],"orders":[2]}', '  {"orders": [ {"id": 1 , "li":[ 1 ,2]} ]}', '{"orders":"[1,2]"}',
             '{"a":["x"],"b":{"c":1}}', '{"orders":[{"id":1}],"n":5,"m":[2]}', '{"":[1]}', '{"orders":[1e400, 1.10, NaN]}',
             '{"orders":[{"v":1.0E5,"k":0.1e-10,"t":true}]}', '{"orders":[" [1", "{", "\\"hi\\""]}']
UNREADABLE_PAGES = ['{"count":5,"orders":[{"id":1}]}', '{"orders":null,"b":[1]}', '{"orders":"","b":[1]}', '{"orders":{"a":1},"b":[1]}',
                    '{"orders":[{"id":1},{"id":2}', '[{"orders":[1]}]', '{}', 'null', '{"a":"s","b":7,"orders":[1]}', '{"orders":[1,]}', " "]


def test_pages_are_parsed_once_and_yield_what_steps_yield(spark):
    """one parse, and no look at every character, for a page of arrays."""
    import pytest
    pages = spark.createDataFrame([(t,) for t in [*ODD_PAGES, "", " \t\r\n ", None]], "value string")
    first = F.get(F.map_values(F.from_json("value", "map<string,string>")), 0)
    by_steps = spark.createDataFrame([(t,) for t in ODD_PAGES], "value string").select(first.alias("f")).select(F.explode(F.from_json("f", "array<string>")))
    got = landing.unwrap_pages(pages)
    assert sorted(map(str, got.collect())) == sorted(str(r).replace("Row(col=", "Row(payload_json=") for r in by_steps.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and "MapType(StringType,ArrayType(StringType" in plan
    for text in UNREADABLE_PAGES:
        with pytest.raises(Exception, match="unreadable page"):
            landing.unwrap_pages(spark.createDataFrame([(text,)], "value string")).collect()


def test_pages_are_successive_records_over_batches(spark):
    """pages are put together by columns, over the borders of record batches, without missing records."""
    key, root = "spark.sql.execution.arrow.maxRecordsPerBatch", fresh_path(spark, "t-pages-batches")
    before = spark.conf.get(key)
    texts = [json.dumps({"id": i, "t": 'é "q" \\ ,]'}, ensure_ascii=False) if i % 6 else None for i in range(100)]
    try:
        spark.conf.set(key, "7")
        landing.write_pages(spark.createDataFrame([(t,) for t in texts], "payload_json string").coalesce(1), "order", root, page_size=10)
    finally:
        spark.conf.set(key, before)
    pages = [r.value for r in landing.read_pages(spark, root).collect()]
    known = [t for t in texts if t is not None]
    assert sorted(pages) == sorted('{"orders": [' + ",".join(known[i:i + 10]) + "]}" for i in range(0, len(known), 10))
