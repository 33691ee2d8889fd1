import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tallyspark.llm import op13_spelling_variants as op
from tallyspark.llm.tables import table

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    """Contract: words and counts of (doc_id, text) rows, run by run."""
    out = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                out[w] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def judged(words, dominance=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top and words[top] >= dominance * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def ours(df):
    return sorted(tuple(r) for r in df.collect())


def test_random_words_of_few_letters(spark):
    """Many near words, two-byte letters, all lengths from one on."""
    rnd = random.Random(13)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 9))): rnd.choice([1, 2, 15, 200, 2000]) for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    near = op.near_words(df)
    assert sorted(tuple(r) for r in near.collect()) == sorted((a, b) for a in words for b in words if one_edit(a, b))
    assert ours(op.forms(df, near)) == judged(words)
    assert ours(op.forms(df, near, dominance=2)) == judged(words, 2)


def test_chains_ties_and_very_long_words(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(50_000))
    words = {"abcdefgh": 10_000_000, "abcdefg": 900_000, "abcdef": 80_000, "abcde": 7_000, "abcd": 600, "abc": 50, "ab": 4,
             "kitchen": 3, "kitchan": 30, "kitchin": 30, long: 50, long[:30_000] + "ü" + long[30_001:]: 2, long[1:]: 2, long + "ab": 2}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r[0]: r for r in ours(op.forms(df, op.near_words(df)))}
    assert list(got.values()) == judged(words)
    assert got["ab"][2] == "abcdefgh" and got["kitchen"][1] == "kitchan" and got[long[1:]][1] == long


def test_awkward_documents(spark, awkward, no_docs):
    assert ours(op.variants(no_docs)) == []
    assert ours(op.variants(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string"))) == []
    texts = ["Straße Übergröße ÜBERGRÖSSE naïveté naïvete", "internal INTERNAL intarnal internals×÷", "no letters 12345 __", "ABCDEFGhijk-abcdefghijk",
             "colourful " * 40 + "colorful colorfull"]
    rows = [(i % 9 if i % 4 else None, texts[i % len(texts)]) for i in range(400)] + [(r.doc_id, r.text) for r in awkward.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = judged(counted(rows))
    assert len(expected) > 8 and ours(op.variants(df)) == expected
    extra = df.withColumns({"word": F.lit("x"), "n": F.lit(1), "near": F.lit(2), "l": F.lit(3), "q": F.lit("q"), "root": F.lit(None).cast("int")})
    assert ours(op.variants(extra)) == expected


def test_counts_sent_in_parts(spark, monkeypatch):
    monkeypatch.setattr(op, "WORDS_HELD", 3)
    rows = [(i, " ".join(f"{c}{c}lettered" for c in "abcdefgh"[: i % 9])) for i in range(90)]
    assert ours(op.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == judged(counted(rows))


def test_without_noise(spark):
    df = spark.createDataFrame([(i, "Receive receive RECIEVE") for i in range(62)], "doc_id long, text string")
    assert ours(op.word_counts(df, noise=None)) == [("receive", 124), ("recieve", 62)]


def test_whole_table_matches_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    words = counted([(r.doc_id, r.text) for r in docs.collect()])
    got = ours(op.query(spark, sf_small))
    assert [r[0] for r in got] == sorted(words) and {r[0]: r[3] for r in got} == words
    # Near words by their common cuts, as all pairs are too many here.
    cuts = {}
    for w in words:
        for i in range(len(w)):
            cuts.setdefault((len(w), i, w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for (_, _, cut), group in cuts.items():
        for w in group:
            near[w] |= group - {w}
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    assert {r[0]: r[4] for r in got} == {w: len(v) for w, v in near.items()}
