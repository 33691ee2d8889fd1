import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import op7_gam_quality as op
from tallyspark.llm.tables import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op.query(spark, sf).collect()}
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    test = [(r.quality, rows[r.doc_id]) for r in table(spark, sf, "labels").collect() if rows[r.doc_id].held_out]
    assert np.mean([y == r.predicted for y, r in test]) > 0.95
    assert np.mean([r.predicted for y, r in test if y == 1]) > 0.97


def test_the_score_is_a_sum_of_tables():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(3000, len(op.FEATURES)))
    y = ((x[:, 0] * x[:, 1] > 0) | (x[:, 2] > 1)).astype(float)
    m = op.fit(x, y)
    assert (1, 0) in m.pairs  # the interaction is found
    assert np.mean((m.score(x) > 0.5) == y) > 0.9
    z = m.intercept + sum(t[np.searchsorted(c, x[7, j], side="right")] for j, (c, t) in enumerate(zip(m.cuts, m.tables)))
    z += sum(t[np.searchsorted(m.pair_cuts[a], x[7, a], side="right"), np.searchsorted(m.pair_cuts[b], x[7, b], side="right")]
             for (a, b), t in zip(m.pairs, m.pair_tables))
    assert abs(m.score(x)[7] - 1 / (1 + np.exp(-z))) < 1e-12


def test_features_are_bounded_and_zero_without_words():
    assert set(op.features_of(b"")) == set(op.features_of(b" \n\t")) == {0.0}
    for t in (b"a", b"a a a a", "é ü ß".encode(), b"x" * 100_000, b"*** ### | A!", b"\xf0\x9f\x98\x80 " * 9):
        f = op.features_of(t)
        assert len(f) == len(op.FEATURES) and np.isfinite(f).all()


def test_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, None, 0), (9, 0, 0), (None, 1, 0), (77, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = op.featurise(awkward.withColumn("x", F.lit("clash")))
    model = op.train(rows, labels)
    assert op.score_rows(rows, model).count() == awkward.count()
    assert op.keep_good(awkward, model, 0.0).count() == awkward.count()
    empty = op.train(op.featurise(no_docs), labels)
    assert op.score_rows(op.featurise(no_docs), empty).count() == 0
    assert all(abs(r.score - 0.5) < 1e-9 for r in op.score_rows(rows, empty).collect())
    same = op.train_on_texts(awkward, labels)
    assert same.intercept == model.intercept and all((a == b).all() for a, b in zip(same.tables, model.tables))


def test_trigrams_of_very_many_different_words():
    """Repeated words, no repeated trigram, and then a repeated passage."""
    words = [b"%x" % i for i in range(2_000_001)]
    at = op.FEATURES.index("repeated_trigrams")
    assert op.features_of(b" ".join(words + words[::-1][:500_000]))[at] == 0.0
    again = op.features_of(b" ".join(words + words[:500_000]))[at]
    assert abs(again - 499_998 / 2_499_999) < 1e-12
