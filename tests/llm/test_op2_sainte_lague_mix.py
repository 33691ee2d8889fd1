import heapq
from collections import defaultdict

from pyspark.sql import functions as F

from tallyspark.llm import op2_sainte_lague_mix as op
from tallyspark.llm.tables import table


def targets(sizes, share=1.5, cap=2.0, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > cap * sizes[s]}
        if not full:
            return out | {s: unit * weight[s] for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def seats(votes, n):
    """Sainte-Lague one seat at a time; ties to the smaller key."""
    got = dict.fromkeys(votes, 0)
    heap = [(-v, k) for k, v in votes.items()]
    heapq.heapify(heap)
    for _ in range(n):
        _, k = heapq.heappop(heap)
        got[k] += 1
        heapq.heappush(heap, (-votes[k] / (2 * got[k] + 1), k))
    return got


def test_apportion_matches_seat_by_seat(spark):
    import random
    rnd = random.Random(5)
    cases, rows = [], []
    for g in range(40):
        votes = {k: float(rnd.choice([rnd.randint(1, 50), rnd.randint(1, 5000), 7])) for k in range(rnd.randint(1, 30))}
        n = rnd.choice([0, 1, 5, 100, 997])
        cases.append((votes, n))
        rows += [(g, k, v, n) for k, v in votes.items()]
    df = spark.createDataFrame(rows, "g int, k long, v double, n long")
    got = defaultdict(dict)
    for r in op.apportion(df, "g", "k", "v", "n").collect():
        got[r.g][r.k] = r.quota
    for g, (votes, n) in enumerate(cases):
        assert got[g] == seats(votes, n), (g, votes, n)


def check(rows, share=1.5):
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = targets(size, share)
    for s in size:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= 64, s
    assert all(r.source_size == size[r.source] for r in rows)


def test_every_source_comes_near_its_target(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = op.mix(docs).collect()
    assert len(rows) == docs.count()
    check(rows)
    again = op.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_many_shards_and_a_hot_source(spark, sf_small):
    docs = table(spark, sf_small, "documents").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(F.col("source")))
    check(op.mix(docs, shard_words=3000).collect())


def test_awkward_documents(awkward, no_docs):
    rows = op.mix(awkward).collect()
    assert len(rows) == awkward.count()
    check(rows)
    assert {r.size for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert op.mix(no_docs).count() == 0


def test_no_words_at_all(awkward):
    rows = op.mix(awkward.filter("doc_id in (2, 3, 4)")).collect()
    assert len(rows) == 3 and {r.taken for r in rows} == {0} and {r.target for r in rows} == {0.0}
