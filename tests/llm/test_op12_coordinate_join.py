import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import components as stars
from tallyspark.llm import op12_coordinate_join as op
from tallyspark.llm.tables import table
from test_op4_multi_order_join import brute


def ours(df, k=2, percent=80):
    return sorted((tuple(r) for r in op.near_components(df, k, percent).collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 2, 80)
    got = op.query(spark, sf_small).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def edited(rnd, words, most):
    w = words[:]
    for _ in range(rnd.randint(0, most)):
        w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10 ** 6)}"
    return w


def test_chains_and_big_groups(spark, monkeypatch):
    """Near copies around bases, chains whose ends don't link, copies, a
    passage shared by all, two bases that are similar but don't link; small pieces."""
    monkeypatch.setattr(op, "PIECE", 8)
    rnd = random.Random(12)
    passage = [f"common{i}" for i in range(12)]
    base = [f"b{i}" for i in range(80)]
    rows = [edited(rnd, base, 5) for _ in range(70)]
    cousin = base[:68] + [f"c{i}" for i in range(12)]  # about 0.73 from the base
    rows += [edited(rnd, cousin, 1) for _ in range(30)]
    for c in range(4):
        w = [f"chain{c}x{i}" for i in range(60)]
        for step in range(9):
            w = w[2:] + [f"chain{c}y{step}", f"chain{c}z{step}"]
            rows.append(list(w))
    rows += [[f"own{i}x{j}" for j in range(rnd.randint(1, 60))] + passage for i in range(40)]
    rows += [list(rows[3])] * 25 + [passage] * 3
    ids = rnd.sample(range(1000), len(rows))
    data = [(i, " ".join(w)) for i, w in zip(ids, rows)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    assert ours(df) == brute(data, 2, 80)


def test_documents_of_shared_passages_make_few_candidates(spark, monkeypatch):
    """Documents of the same passages meet in lists, but hardly any pair leaves the join."""
    rnd = random.Random(5)
    passages = [[f"p{i}w{j}" for j in range(20)] for i in range(30)]
    rows = [(i, " ".join(w for p in rnd.sample(passages, 5) for w in p)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    plain = op.written

    def noted(frame, name):
        out = plain(frame, name)
        if name == "candidates":
            seen.append(out.count())
        return out
    monkeypatch.setattr(op, "written", noted)
    assert ours(df) == brute(rows, 2, 80)
    assert sum(seen) < 300 * 299 // 2 // 20, seen


def test_awkward_documents(awkward, no_docs, spark):
    assert ours(no_docs) == []
    extra = [(None, "a b c d"), (None, "a b c d"), (40, "x y z"), (None, "x y z"), (40, "other words here"), (20, "X Y\tz"), (30, None)]
    df = awkward.select("doc_id", "text").unionAll(spark.createDataFrame(extra, "doc_id long, text string"))
    df = df.withColumns({"n": F.lit(1), "token": F.lit("t"), "set_id": F.lit(0), "root": F.lit(1), "kept": F.lit(None).cast("int"), "a": F.lit("a")})
    rows = [(r.doc_id, r.text) for r in df.collect()]
    expected = brute(rows, 2, 80)
    assert ours(df, 2, 80) == expected
    kept = [(r.doc_id, r.text) for r in op.keep_representatives(df).collect()]
    gone = [(None, "x y z"), (40, "x y z"), (7, rows[8][1])]
    assert sorted(kept, key=str) == sorted((r for r in rows if r not in gone), key=str)


@pytest.mark.parametrize("share", [0.3, 0.5, 0.8, 0.95])
def test_matches_follow_the_similarity(share):
    """Coordinates match with the Jaccard similarity as probability, each on its own."""
    rnd = np.random.default_rng(1)
    factors = rnd.integers(1 << 31, size=op.COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    found = []
    for _ in range(400):
        n = 100
        x = rnd.integers(0, 1 << 63, size=2 * n, dtype=np.uint64)
        both = round(2 * n * share / (1 + share))
        a, b = x[:n], np.concatenate([x[:both], x[n:2 * n - both]])
        found.append((op.signature(a, factors) == op.signature(b, factors)).sum())
    exact = both / (2 * n - both)
    assert abs(np.mean(found) / op.COORDINATES - exact) < 0.012
    assert np.var(found) < 1.5 * op.COORDINATES * exact * (1 - exact)


def test_low_bytes_count_equal_values(spark):
    rnd = np.random.default_rng(2)
    a = rnd.integers(-2 ** 31, 2 ** 31, size=(50, 64))
    b = np.where(rnd.random((50, 64)) < np.linspace(0, 1, 50)[:, None], a, a ^ 1)
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(a, b)], "x array<int>, y array<int>")
    sides = [df.select(F.monotonically_increasing_id().alias("i"), F.col(c).alias("signature")).select("i", *op._low_bytes()) for c in "xy"]
    got = (sides[0].select("i", F.struct(*op.LOW).alias("x")).join(sides[1].select("i", F.struct(*op.LOW).alias("y")), "i")
           .select(op._matches("x.", "y.").alias("m")).collect())
    assert sorted(r.m for r in got) == sorted((a == b).sum(1).tolist())


def test_low_nibbles_count_no_fewer_matches_than_low_bytes(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(-2**31, 2**31, (60, op.COORDINATES))
    y = np.where(rng.random(x.shape) < rng.random((60, 1)), x, rng.integers(-2**31, 2**31, x.shape))
    df = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y))], "i int, x array<int>, y array<int>")
    sides = []
    for c in "xy":
        low = df.select("i", F.col(c).alias("signature")).select("i", *op._low_bytes())
        sides.append(low.select("i", F.struct(*op.LOW, *op._low_nibbles()).alias(c)))
    got = {r.i: (r.b, r.n) for r in sides[0].join(sides[1], "i").select(
        "i", op._matches("x.", "y.").alias("b"), op._nibble_matches("x.", "y.").alias("n")).collect()}
    assert [got[i] for i in range(60)] == [(int(((a ^ b) & 255 == 0).sum()), int(((a ^ b) & 15 == 0).sum())) for a, b in zip(x, y)]


def test_steps_leave_no_shuffle_files_and_used_tables_no_files(spark, monkeypatch):
    from tallyspark.llm import tables
    texts = [f"a b c d e f g h i j k l m {i // 2} o p q r s t u v w x y z" for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    kept, cleaned = [], []
    monkeypatch.setattr(tables, "fresh_path", lambda s, n, of=tables.fresh_path: kept.append(of(s, n)) or kept[-1])
    monkeypatch.setattr(tables, "_read", lambda df, p, of=tables._read: cleaned.append(spark.conf.get(tables.SHUFFLE_CLEANUP)) or of(df, p))
    before = spark.conf.get(tables.SHUFFLE_CLEANUP, "false")
    got = {r.doc_id: r.component_id for r in op.near_components(docs).collect()}
    assert len(got) == 40 and got[1] == got[0]
    assert set(cleaned) >= {"true"} and spark.conf.get(tables.SHUFFLE_CLEANUP) == before
    left = {p.rsplit("/llm-", 1)[1].rsplit("-", 1)[0] for p in kept if os.path.exists(p.removeprefix("file:"))}
    assert not left & {"posting-sizes", "prefixes", "partnered", "near-postings", "hubs", "candidates", "placed", "classes", "open-postings"}


def test_links_that_form_stars_are_written_once(spark, monkeypatch):
    """Every step costs a task per shuffle partition, however small: none only finds that nothing changes."""
    names, plain = [], stars.written
    monkeypatch.setattr(stars, "written", lambda df, name: names.append(name) or plain(df, name))

    def found(edges):
        names.clear()
        return sorted(tuple(r) for r in stars.components(spark.createDataFrame(edges, "a long, b long")).collect()), len(names)
    assert found([(9, 2), (2, 5), (2, 9), (7, 2), (4, 3), (6, 6)]) == ([(2, 2), (3, 3), (4, 3), (5, 2), (7, 2), (9, 2)], 1)
    assert found([(1, 3), (5, 3)]) == ([(1, 1), (3, 1), (5, 1)], 5)  # one round
    assert found([]) == ([], 1)
    chain, steps = found([(i, i + 1) for i in range(20)])
    assert chain == [(i, 0) for i in range(21)] and steps < 30


def test_near_copies_take_few_steps(spark, monkeypatch):
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join(edited(rnd, base, 4))) for i in range(60)] + [(60 + i, f"alone{i} x{i} y{i}") for i in range(20)]
    names = []
    for module in (op, stars):
        monkeypatch.setattr(module, "written", lambda df, name, plain=module.written: names.append(name) or plain(df, name))
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, 2, 80)
    assert len(names) < 48, names  # 54 when every search for components ended with a round that changed nothing
