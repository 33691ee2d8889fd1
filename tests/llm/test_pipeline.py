"""The pipeline against a version in plain Python, stage by stage."""

import re

import numpy as np
from pyspark.sql import functions as F
from test_op2_sainte_lague_mix import check as check_mix
from test_op4_multi_order_join import brute as brute_components
from test_op8_simhash_decontam import brute as brute_contamination
from test_op9_dfa_secrets import KEY

import corpus_pipeline as cp
from tallyspark.llm import op7_gam_quality as quality
from tallyspark.llm.tables import table

SECRETS = [("assign", KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6), ("access", "AKIA[A-Z0-9]+", 0, 20),
           ("hex", "[0-9a-f]+", 0, 24), ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40), ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
           ("google", "AIza[A-Za-z0-9_-]+", 0, 39), ("stripe", "[sr]k_live_[A-Za-z0-9]+", 0, 24),
           ("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
           ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27)]


def masked(text):
    if text is None:
        return None
    spans = sorted(((m.start(), -m.end(), kind) for kind, rule, group, least in SECRETS for m in re.finditer(rule, text)
                    if len(m[group]) >= least))
    out, at = "", 0
    for start, end, kind in spans:
        if -end > at:
            out += text[at:max(at, start)] + (f"[{kind}]" if start >= at else "")
            at = -end
    return out + text[at:]


def test_stages_match_plain_python(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = docs.collect()
    after = {}
    for name, stage in cp.STAGES:
        docs = cp.written(stage(spark, docs, sf_small), f"test-{name.replace(' ', '-')}")
        after[name] = docs
        if name != "source mix":
            assert docs.schema == table(spark, sf_small, "documents").schema

    model = quality.train_on_texts(table(spark, sf_small, "documents"), table(spark, sf_small, "labels"))
    score = model.score(np.array([quality.features_of((r.text or "").encode()) for r in rows], np.float32).astype(float))
    rows = [r for r, s in zip(rows, score) if s >= 0.3]
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in after["quality classifier"].collect())

    stays = {i for i, _, c in brute_components([(r.doc_id, r.text) for r in rows], 5, 80) if i == c}
    rows = [r for r in rows if r.doc_id in stays]
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in after["n-gram Jaccard join"].collect())

    bad = {d for d, _ in brute_contamination([(r.doc_id, r.text) for r in rows],
                                             [(r.item_id, r.text) for r in table(spark, sf_small, "benchmark").collect()])}
    rows = [r for r in rows if r.doc_id not in bad]
    assert bad and sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in after["benchmark decontamination"].collect())

    want = {r.doc_id: masked(r.text) for r in rows}
    got = {r.doc_id: r for r in after["secret scan"].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text is not None)

    mixed = after["source mix"].collect()
    assert sorted(r.doc_id for r in mixed) == sorted(want)
    check_mix(mixed)


def test_awkward_documents_pass_every_stage(spark, awkward, no_docs, write):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "two three four five six seven")], "item_id long, text string")
    sf = write(documents=awkward.withColumn("set_id", F.lit("clash")), labels=labels, benchmark=items)
    assert cp.run(spark, sf).count() > 0
    docs = no_docs
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_registered():
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is cp.run
    assert [name for name, _ in cp.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination",
                                               "secret scan", "source mix"]
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in entry.queries()) == 1
