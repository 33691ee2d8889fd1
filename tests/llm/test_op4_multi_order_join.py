import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from tallyspark.llm import op4_multi_order_join as op
from tallyspark.llm.components import components
from tallyspark.llm.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def ours(df, k=4, percent=85):
    return sorted((tuple(r) for r in op.near_components(df, k, percent).collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ours(docs) == brute(rows, 4, 85)
    assert ours(docs, 5, 80) == brute(rows, 5, 80)


def test_chains_and_big_groups(spark, monkeypatch):
    """A group of near copies around one base, chains whose ends don't link,
    copies, and a passage shared by all; small pieces, so that both rounds
    and the chain of heads have work."""
    monkeypatch.setattr(op, "PIECE", 8)
    rnd = random.Random(4)
    passage = [f"common{i}" for i in range(12)]
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(60):
        w = base[:]
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(80)] = f"edit{rnd.randrange(10 ** 6)}"
        rows.append(w)
    for c in range(5):
        w = [f"chain{c}x{i}" for i in range(60)]
        for step in range(9):
            w = w[1:] + [f"chain{c}y{step}"]
            rows.append(list(w))
    rows += [[f"own{i}x{j}" for j in range(rnd.randint(1, 60))] + passage for i in range(40)]
    rows += [list(rows[3])] * 25 + [passage] * 3
    ids = rnd.sample(range(1000), len(rows))
    data = [(i, " ".join(w)) for i, w in zip(ids, rows)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    for k, percent in ((4, 85), (5, 80), (3, 60)):
        assert ours(df, k, percent) == brute(data, k, percent), (k, percent)


def test_awkward_documents(awkward, no_docs):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert ours(awkward.withColumn("n", F.lit(1)).withColumn("set_id", F.lit("clash"))) == brute(rows, 4, 85)
    assert ours(no_docs) == []
    assert op.keep_smallest(no_docs).count() == 0


def test_one_document_of_each_group_stays(awkward):
    kept = op.keep_smallest(awkward)
    assert kept.schema == awkward.schema
    # 7 is 6 and one word more.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "1", "2", "3", "4", "None", "5", "6", "8", "9", "10"])


def test_all_links_inside_a_component(spark, awkward, monkeypatch):
    """Near copies of one base, copies, chains and a shared passage: every link
    between different texts is returned, and each row has its number of links."""
    monkeypatch.setattr(op, "PIECE", 8)
    rnd = random.Random(6)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(50):
        w = base[:]
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(80)] = f"edit{rnd.randrange(10 ** 6)}"
        rows.append(" ".join(w))
    rows += [rows[3]] * 5 + [None, "", "few words", "few words"]
    rows += [" ".join(f"chain{j}" for j in range(i, i + 60)) for i in range(6)]
    rows += [" ".join([f"own{i}x{j}" for j in range(9)] + base[:12]) for i in range(9)]
    data = list(enumerate(rows)) + [(None, rows[5])]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    for k, percent in ((4, 85), (3, 60)):
        sets = [shingles(t, k) for _, t in data]
        n, between = [0] * len(data), 0
        for i, j in combinations(range(len(data)), 2):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                n[i] += 1
                n[j] += 1
                between += a != b
        links, counts = op.near_links(df, k, percent)
        found = links.collect()
        assert sorted(((r.doc_id, r.n_links) for r in counts.collect()), key=str) == sorted(
            ((d, x) for (d, _), x in zip(data, n)), key=str)
        assert sum(r.a_rows * r.b_rows for r in found) == between
        assert all(r.a < r.b for r in found) and len({(r.a, r.b) for r in found}) == len(found)
    links, counts = op.near_links(awkward)
    assert {r.doc_id: r.n_links for r in counts.collect()}[1] == 1 and links.count() == 1


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert got[n] == min(seen)
    assert set(got) == set(near)
