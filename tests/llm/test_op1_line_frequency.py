import re
from collections import Counter, defaultdict

from tallyspark.llm import op1_line_frequency as op
from tallyspark.llm.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(tri)
    covered = {i + k for i, t in enumerate(tri) if n[t] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def boilerplate(rows, min_docs, min_share):
    """Removed words per row, by brute force over (source, text)."""
    def lines(text):
        norm = re.sub(r"[\x20\x09\x0B-\x0D]+", " ", re.sub("[0-9]+", "0", (text or "").lower()))
        return [x.strip(" \t\n\x0b\f\r") for x in norm.split("\n") if WORD.search(x)]
    docs, hosts = defaultdict(set), defaultdict(set)
    for source, text in rows:
        hosts[source].add(text or "")
        for x in lines(text):
            docs[source, x].add(text or "")
    return [sum(len(WORD.findall(x)) for x in lines(t)
                if len(docs[s, x]) >= min_docs and len(docs[s, x]) >= min_share * len(hosts[s])) for s, t in rows]


def check(docs, rows, **limits):
    got = sorted((tuple(r) for r in op.judge(docs, **limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_boilerplate_words",
        "base_failed", "kept").collect()), key=str)
    removed = boilerplate([(r["source"], r["text"]) for r in rows], limits.get("min_docs", 10), limits.get("min_share", 0))
    want = []
    for r, gone in zip(rows, removed):
        b = base(r["text"])
        failed = b[0] < limits.get("least_words", 50) or 100 * b[4] > 50 * b[0]
        depleted = b[0] - gone < limits.get("least_left", 0.3) * b[0]
        want.append((r["doc_id"], *b, gone, failed, not failed and not depleted))
    assert got == sorted(want, key=str)


def test_whole_table_matches_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    check(docs, docs.collect(), min_docs=3)


def test_awkward_documents(awkward, no_docs):
    check(awkward, awkward.collect(), min_docs=2, least_words=1)
    assert op.judge(no_docs).count() == 0


def test_boilerplate_depletes_but_copies_do_not(spark):
    menu = "home news contact about imprint\n" * 3
    rows = [(i, menu + f"only line number {chr(97 + i)}", "en", "h", 1) for i in range(20)]
    rows += [(100 + i, "a copied article that is long enough to be judged on its own", "en", "h", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.kept for r in op.judge(docs, least_words=5, least_left=0.5).collect()}
    # The menu repeats inside the text, so the base rule rejects it as well; the copies stay.
    assert not any(kept[i] for i in range(20)) and all(kept[100 + i] for i in range(30))


def test_extra_columns_with_clashing_names(awkward):
    from pyspark.sql import functions as F
    extra = awkward.withColumn("lines", F.lit(1)).withColumn("row", F.lit("x")).withColumn("host", F.lit(None).cast("string"))
    assert op.judge(extra).count() == awkward.count()


def test_long_texts_use_the_wide_keys(awkward, monkeypatch):
    monkeypatch.setattr(op, "POSITION_BITS", 10)
    check(awkward, awkward.collect())
