import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import op11_jacobi_davidson as op
from tallyspark.llm.tables import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Contract over (vec_id, vector): a dense eigendecomposition."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in good]
    fit = sorted({v for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array(s) / n
    c = np.array(fit, float) - mean
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    dev = [sum((n * a - b) ** 2 for a, b in zip(v, s)) for _, v in x]
    white = (np.array([v for _, v in x], float) - mean) @ u / np.sqrt(e)
    return n, [i for i, _ in x], dev, white, e / (c * c).sum(1).mean()


def check(df):
    got = df.collect()
    n, ids, dev, white, explained = brute([(r.vec_id, r.embedding) for r in check.source.collect()])
    assert {r.n for r in got} == {n}
    assert sorted((r.vec_id, r.component, r.deviation) for r in got) == sorted((i, c + 1, d) for i, d in zip(ids, dev) for c in range(4))
    assert all(r.identity_error <= 1e-10 for r in got)
    mine = {}
    for r in got:
        mine.setdefault(r.component, []).append((r.vec_id, r.whitened))
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
    for c, pairs in mine.items():
        a = np.array([w for _, w in sorted(pairs)])
        b = np.array([w for _, w in sorted(zip(ids, white[:, c - 1]))])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_whole_table_matches_a_dense_decomposition(spark, sf_small):
    check.source = table(spark, sf_small, "embeddings")
    check(op.query(spark, sf_small))


def test_partial_sums_in_groups(spark, sf_small, monkeypatch):
    monkeypatch.setattr(op, "FAN_IN", 2)
    monkeypatch.setattr(op, "BLOCK_ROWS", 37)
    check.source = table(spark, sf_small, "embeddings").repartition(7)
    check(op.whitened_rows(check.source))


def test_copies_count_once_and_bad_rows_go(spark):
    rnd = np.random.default_rng(3)
    scale = np.array([5, 3, 2, 1, 0.5, 0.25, 0.1])
    rows = [(i, (rnd.standard_normal(7) * scale).tolist(), 0) for i in range(120)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(90)]  # a hot vector
    rows += [(5, rows[5][1], None), (None, rows[7][1], 2)]
    good = spark.createDataFrame(rows, SCHEMA)
    bad = spark.createDataFrame([(2000, None, 1), (2001, [None] + [1.0] * 6, 1), (2002, [math.nan] * 7, 1), (2003, [math.inf] + [0.0] * 6, 1),
                                 (2004, [], 1), (2005, [1.0, 2.0], 1)], SCHEMA)
    got = op.whitened_rows(good.unionAll(bad)).collect()
    n, ids, dev, white, _ = brute([(r[0], r[1]) for r in good.collect()])
    assert n == 120 and {r.n for r in got} == {120} and len(got) == 4 * len(rows)
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1 and r.vec_id is not None) == sorted(
        (i, d) for i, d in zip(ids, dev) if i is not None)
    assert len([r for r in got if r.vec_id is None]) == 4
    hot = {round(r.whitened, 12) for r in got if r.component == 1 and (r.vec_id or 0) in {5, *range(1000, 1090)}}
    assert len(hot) == 1


def test_empty_few_dimensions_and_no_variance(spark):
    none = op.whitened_rows(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and none.columns == op.whitened_rows(spark.createDataFrame([(1, [1.0], 0)], SCHEMA)).columns
    same = op.whitened_rows(spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(3)], SCHEMA)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same) == [
        (i, c, 1, 0, None, None, None) for i in range(3) for c in (1, 2, 3)]
    line = op.whitened_rows(spark.createDataFrame([(i, [float(i), 0.0], 0) for i in range(4)], SCHEMA)).orderBy("vec_id", "component").collect()
    assert [r.explained for r in line][:2] == pytest.approx([1, 0]) and [r.whitened for r in line if r.component == 2] == [None] * 4
    assert abs(line[0].whitened) == pytest.approx(1.5 / math.sqrt(1.25)) and line[0].identity_error < 1e-12


def test_grid_ends_and_exact_deviations(spark):
    assert op.on_grid(np.array([0.999, -0.001, -0.0, 1e300, -1e300]), 256.0).tolist() == [255, -1, 0, 2 ** 63 - 1, -2 ** 63]
    x = np.array([[2 ** 40, 1], [5, -2 ** 40]])
    assert op.deviations(x, 3, [7, 7]) == [None, None]
    assert op.deviations(np.array([[2 ** 31, 1]]), 1, [0, 0]) == [2 ** 62 + 1]
    assert op.deviations(np.array([[2, 1], [0, 0]]), 2, [2, 1]) == [5, 5]
    packed = op._pack(np.array([[1, -2], [1 << 20, 0], [1 << 40, 3]]))
    assert [len(p) for p in packed] == [4, 8, 16] and op._unpack(packed, 2).tolist() == [[1, -2], [1 << 20, 0], [1 << 40, 3]]


@pytest.mark.parametrize("kind", ["random", "decay", "ties", "low rank", "close"])
def test_solver_alone(kind):
    """Dimension far above the search space, so that restarts, corrections and locking have work."""
    rnd, d = np.random.default_rng(8), 300
    q = np.linalg.qr(rnd.standard_normal((d, d)))[0]
    e = {"random": rnd.random(d) * 10, "decay": 100 * 0.7 ** np.arange(d), "ties": np.r_[[5.0] * 6, np.ones(d - 6)],
         "low rank": np.r_[[3.0, 2.0], np.zeros(d - 2)], "close": 1 + 1e-6 * rnd.random(d)}[kind]
    m = (q * e) @ q.T
    p = op.jacobi_davidson(lambda b: m @ b, d, 4, spare=2, inner=8, largest=30)
    top = np.sort(e)[::-1][:4]
    assert np.abs(p.values - top).max() <= 1e-12 * top[0]
    assert np.abs(m @ p.vectors - p.vectors * p.values).max() <= 1e-12 * top[0]
    assert np.abs(p.vectors.T @ p.vectors - np.eye(4)).max() < 1e-12


def test_extra_columns_with_clashing_names(spark):
    rows = spark.createDataFrame([(i, [float(i), float(i * i), 1.0, 2.0], 0) for i in range(6)], SCHEMA)
    extra = rows.withColumns({"x": F.lit("a"), "component": F.lit(7), "n": F.lit(None).cast("int"), "deviation": F.lit(1.5), "_x": F.lit(0)})
    assert sorted(op.whitened_rows(extra).select("vec_id", "component", "deviation").collect()) == sorted(
        op.whitened_rows(rows).select("vec_id", "component", "deviation").collect())
