import random
import re

from tallyspark.llm import op9_dfa_secrets as op
from tallyspark.llm.tables import table

KEY = "(?:{})".format("|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                                for w in ["password", "passwd", "secret", "token", "api_?key"]))
BASE = {"assign": (re.compile(KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile("[0-9a-f]+"), 0, 24)}


def brute(text):
    found = [(m.start(), m.end(), k) for k, (r, g, n) in BASE.items() for m in r.finditer(text) if len(m[g]) >= n]
    return sorted(found, key=lambda x: (x[0], list(BASE).index(x[2])))


def ours(texts, **kw):
    return [[s for s in x if s[2] in BASE] for x in op.find_spans([t.encode() for t in texts], **kw)]


def test_random_texts_match_the_regular_expressions():
    rnd = random.Random(3)
    parts = ["token", "secret", "api_key", "apikey", "PassWord", "passwd", '"', "'", " ", ":", "=", "abc", "é", "0123456789abcdef",
             "AKIA", "ABCDEFGHIJKLMNOP1", "\n", "/", "-", "deadbeefdeadbeef", "€x", "z", "eyJ", "gh", "p_", "\0", "AIza", "k"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["", "x" * 20_000 + "token=abcdefgh", "a" * 9000, "secret=token:abcdef123", "token==abcdef", "api_key = 'a b'"]
    want = [brute(t) for t in texts]
    assert ours(texts) == want
    assert ours(texts, block_bytes=100) == want


def test_a_match_over_many_lanes():
    text = "é " + "f" * (3 * op.LANE) + " token=" + "Q" * (2 * op.LANE)
    assert ours([text]) == [brute(text)]


def test_more_rules():
    text = "ghp_" + "Z" * 36 + " xoxb-123456789012 sk_live_" + "Z" * 16 + " eyJhbGci.eyJzdWIi.abcdefghijkl -----BEGIN RSA PRIVATE KEY-----"
    assert [s[2] for s in op.find_spans([text.encode()])[0]] == ["github", "slack", "stripe", "jwt", "pem"]


def test_automaton_is_minimal_and_small():
    dfa = op.combined(op.RULES)
    assert len(dfa.mask) < 1000
    again = {}
    for s in range(len(dfa.mask)):  # no two states with equal moves and accepts
        assert again.setdefault((int(dfa.mask[s]), dfa.step[256 * s:256 * s + 256].tobytes()), s) == s


def test_whole_table(spark, sf_small):
    rows = {r.doc_id: r for r in op.query(spark, sf_small).collect()}
    docs = table(spark, sf_small, "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = brute(d.text or "")
        r = rows[d.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[2] == k for s in want) for k in BASE)
        assert [x for x in r.spans.split(",") if x.split(":")[0] in BASE] == [f"{k}:{a}:{b}" for a, b, k in want]


def test_masking_keeps_rows_and_removes_spans(awkward, spark):
    one = spark.createDataFrame([(50, "my token=abcdefgh end", "en", "a", 21), (51, None, None, None, None)], awkward.schema)
    out = {r.doc_id: r for r in op.mask_secrets(one).collect()}
    assert out[50].text == "my [assign] end" and out[50].n_chars == 15 and out[51].text is None
    assert op.mask_secrets(awkward).count() == awkward.count()
    assert op.mask_secrets(awkward).schema == awkward.schema


def test_awkward_documents(awkward, no_docs, write, spark):
    assert op.query(spark, write(documents=awkward)).count() == awkward.count()
    assert op.scan_secrets(no_docs).count() == 0


def test_heads_without_a_match_take_linear_time():
    import time
    text = b"eyJ" * 350_000
    began = time.time()
    assert op.find_spans([text]) == [[]]
    took = time.time() - began
    assert took < 12, took
    # Runs that fall in with a failed one, then a match behind them.
    mixed = b"eyJ" * 50 + b" eyJabc.eyJdef " + b"eyJ" * 20 + b".eyJhbGciOiJIUzI1NiJ9.c2lnbmF0dXJlc2lnbmF0dXJl" + b" -----BEGIN " * 9 + b"-----BEGIN RSA PRIVATE KEY-----"
    want = [(m.start(), m.end(), k) for k, r in (("jwt", rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
                                                 ("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----")) for m in re.finditer(r, mixed)]
    assert op.find_spans([mixed], op.MORE_RULES)[0] == sorted(want)
