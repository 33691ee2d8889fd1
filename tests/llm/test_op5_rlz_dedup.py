import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import op5_rlz_dedup as op
from tallyspark.llm.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k=13):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        if i is not None:
            for p in range(len(w) - k + 1):
                run = tuple(w[p:p + k])
                least[run] = min(i, least.get(run, i))
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for p in range(len(w) - k + 1):
                if least[tuple(w[p:p + k])] < i:
                    gone.update(range(p, p + k))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def ours(df, **kw):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in op.parse_against_smaller(df, **kw).collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    assert ours(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_documents(awkward, no_docs):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert ours(awkward.withColumn("bucket", F.lit("clash"))) == brute(rows)
    assert ours(awkward, k=3) == brute(rows, 3)
    assert ours(no_docs) == []


def test_shared_passages_in_many_documents(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_BYTES", 400)  # many blocks: equal runs meet in the buckets too
    a = " ".join(f"p{i}" for i in range(20))
    rows = [(i * 7 % 101, f"own{i} {a if i % 3 else ''} x{i} " + " ".join(f"q{j}" for j in range(i % 17))) for i in range(101)]
    rows += [(500, None), (None, a), (7, "seven " + a), (7, "again " + a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ours(df.repartition(5)) == brute(rows)
    assert ours(df.repartition(3), k=4) == brute(rows, 4)


def test_factors_are_greedy_and_at_least_k_words():
    assert op.factorise(np.array([5, 6, 7, 40]), 13) == [(5, 15), (40, 13)]
    assert op.factorise(np.array([0, 13]), 13) == [(0, 26)]
    assert op.factorise(np.array([0, 14]), 13) == [(0, 13), (14, 13)]
