import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tallyspark.llm import op8_simhash_decontam as op
from tallyspark.llm.tables import table


def words(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [w for w in (re.sub(r"[\W_]+", "", x.lower()) for x in found) if w]


def shingles(w, size):
    return [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]


def brute(docs, items, similarity=0.8):
    """(doc, item) -> best similarity, by every window of every document."""
    held = []
    for i, t in items:
        w = words(t)
        if w:
            size = min(5, len(w))
            held.append((i, len(w), size, Counter(shingles(w, size))))
    df = Counter(s for _, _, _, c in held for s in c)
    weight = {s: 1 + math.log(len(held) / n) for s, n in df.items()}
    default = 1 + math.log(max(1, len(held)))
    out = {}
    for d, t in docs:
        w = words(t)
        for i, n, size, c in held:
            sh = shingles(w, size)
            for a in range(len(sh) - (n - size)):
                x = Counter(sh[a:a + n - size + 1])
                if not x.keys() & c.keys():
                    continue
                keys = x.keys() | c.keys()
                v = (sum(weight.get(s, default) * min(x[s], c[s]) for s in keys)
                     / sum(weight.get(s, default) * max(x[s], c[s]) for s in keys))
                if v >= similarity:
                    out[d, i] = max(v, out.get((d, i), 0))
    return out


def ours(docs, items, **kw):
    return {(r.doc_id, r.item_id): r.similarity for r in op.find_contamination(docs, items, **kw).collect()}


def same(a, b):
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_whole_table_matches_brute_force(spark, sf_small):
    docs, items = table(spark, sf_small, "documents"), table(spark, sf_small, "benchmark")
    got = ours(docs, items)
    assert got
    same(got, brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]))


def test_edited_passages(spark):
    rnd = random.Random(2)
    items = [(i, " ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.choice([2, 4, 5, 6, 20, 40, 60])))) for i in range(40)]
    docs = []
    for d in range(60):
        w = items[d % 40][1].split()
        for _ in range(d % 4):
            w[rnd.randrange(len(w))] = rnd.choice(["edit", "Edit!", "w1"])
        docs.append((d, " ".join([f"W{rnd.randrange(60)}," for _ in range(30)] + [x.upper() + "." for x in w] + ["tail"] * 5)))
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    same(ours(a, b), want)
    blocks = ours(a, b, block_items=7)  # weights are the block's own: found all the same where the texts are equal
    assert {k for k, v in want.items() if v > 0.999} <= blocks.keys()


def brute_shorter(docs, items, similarity=0.8):
    """brute() and, for documents shorter than an item, their whole text as the one window."""
    out = brute(docs, items, similarity)
    short = [(d, t, i, x) for d, t in docs for i, x in items if min(5, len(words(x))) <= len(words(t)) < len(words(x))]
    held = [Counter(shingles(words(x), min(5, len(words(x))))) for _, x in items if words(x)]
    df = Counter(s for c in held for s in c)
    for d, t, i, x in short:
        size = min(5, len(words(x)))
        a, b = Counter(shingles(words(t), size)), Counter(shingles(words(x), size))
        weight = {s: 1 + math.log(len(held) / df.get(s, 1)) for s in a.keys() | b.keys()}
        v = sum(w * min(a[s], b[s]) for s, w in weight.items()) / sum(w * max(a[s], b[s]) for s, w in weight.items())
        if v >= similarity:
            out[d, i] = max(v, out.get((d, i), 0))
    return out


def test_documents_shorter_than_the_item(spark):
    rnd = random.Random(5)
    items = [(i, " ".join(f"w{rnd.randrange(50)}" for _ in range(n))) for i, n in enumerate([39, 39, 20, 8, 6, 5, 60])]
    docs = []
    for i, t in items:
        w = t.split()
        for k in (0, 1, 2, 3, 6):
            docs += [(len(docs), " ".join(w[k:])), (len(docs) + 1, " ".join(w[:len(w) - k]))]
        docs += [(len(docs), " ".join(w[1:-1])), (len(docs) + 1, " ".join(w[:9] + w[10:])), (len(docs) + 2, "w1")]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute_shorter(docs, items)
    assert len(want) > len(brute(docs, items)) and want[2, 0] >= 0.8  # item 0 less its first word
    same(ours(a, b), want)
    gone = {d for d, _ in want}
    assert {r.doc_id for r in op.drop_contaminated(a, b).collect()} == {d for d, _ in docs} - gone


def test_results_do_not_depend_on_the_blocks(spark):
    """Passages shared by items of different blocks, in the items and in the edits of the documents."""
    rnd = random.Random(8)
    shared = [[f"s{k}x{j}" for j in range(9)] for k in range(4)]
    items = [(i, " ".join([f"i{i}x{j}" for j in range(rnd.choice([60, 70]))] + shared[i % 4])) for i in range(36)]
    items += [(100, None), (101, " . "), (102, "s0x0 s0x1 s0x2"), (103, items[0][1])]
    docs = []
    for d in range(72):
        w = items[d % 36][1].split()
        at = rnd.randrange(50)
        if d % 3:
            w[at:at + d % 8] = rnd.choice(shared)[:d % 8]
        docs.append((d, " ".join(w if d % 5 else shared[d % 4] + w + shared[1])))
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    one = {(r.doc_id, r.item_id): r for r in op.find_contamination(a, b).collect()}
    assert any(r.similarity < 0.95 for r in one.values())
    for block_items in (7, 20):
        blocks = {(r.doc_id, r.item_id): r for r in op.find_contamination(a, b, block_items=block_items).collect()}
        same({k: r.similarity for k, r in blocks.items()}, {k: r.similarity for k, r in one.items()})
        assert all((r.start_word, r.n_windows) == (one[k].start_word, one[k].n_windows) for k, r in blocks.items())
    same({k: r.similarity for k, r in one.items()}, brute_shorter(docs, items))


def test_multi_index_returns_all_within_the_radius():
    import numpy as np
    rnd = np.random.default_rng(3)
    near = op._near_bytes(40 // op.BLOCKS)
    a = rnd.integers(0, 256, (300, 16), dtype=np.uint8)
    for flips in (0, 5, 20, 40):
        b = np.unpackbits(a, axis=1)
        for row in b:
            row[rnd.choice(128, flips, replace=False)] ^= 1
        b = np.packbits(b, axis=1)
        assert near[a, b].any(axis=1).all()


def test_contaminated_documents_go(spark, awkward, no_docs):
    items = spark.createDataFrame([(1, "two three four five six seven eight"), (2, None), (3, "  "), (None, "same same same same same same")],
                                  "item_id long, text string")
    kept = op.drop_contaminated(awkward, items)
    assert kept.schema == awkward.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["2", "3", "4", "None", "5", "6", "7", "8", "10"])
    assert op.drop_contaminated(awkward, items, block_items=1).count() == kept.count()
    assert op.drop_contaminated(awkward, items.limit(0)).count() == awkward.count()
    assert op.find_contamination(no_docs, items).count() == 0
    assert op.find_contamination(awkward.withColumn("item_id", F.lit("clash")), items).count() == 3
