"""Operator 9, secret scan by one combined deterministic automaton.

The rules are small regex trees over bytes, each split into a head, which
every match begins with, and a tail of loops. The heads are compiled together:
Thompson NFA, subset construction over byte classes, and minimisation by
partition refinement into one transition array; a state's accept mask tells
which rules' heads end there. (Tails left in would multiply the states of all
rules whose loops can run at once: 22,000 states instead of a few hundred.) The automaton is searched unanchored in a single pass
over the bytes of a block of texts. The pass runs in lock step over lanes of
the block (a lane that began in the wrong state is run again from the right
one, so lanes change nothing in the result).

Spans are then read off around the accepts only: the reversed automaton of
the rule's head finds the leftmost start, the forward automaton of the whole
rule the longest end.
A found match is consumed; it is dropped afterwards if it is shorter than the
rule's least length (leftmost, non-overlapping, then drop).

A head whose tail fails is remembered with the states of that run, so the
time is linear in the text also where heads follow one another without a match.

Every rule is made of ASCII classes, without newline and NUL, so bytes of
UTF-8 texts can be scanned and NUL can stand between texts. The earliest
accept of a rule must belong to its leftmost match, which holds where no
match can begin inside the part of another that precedes its first accept.

Defined cases: a null text is empty; empty texts have no spans; texts are
scanned whole whatever their length; repeated rows are scanned each; other
columns pass through ``scan_secrets`` untouched (a clash with an output name
is an error there, the query selects its two columns); an empty table gives
an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import map_texts, slices, table, utf8_lists

# ------------------------------------------------------------------ regex trees


def chars(s: str):
    return ("set", frozenset(s.encode()))


def lit(s: str):
    return seq(*[chars(c) for c in s])


def either_case(s: str):
    return seq(*[chars(c.lower() + c.upper()) for c in s])


def seq(*xs):
    return ("seq", xs)


def alt(*xs):
    return ("alt", xs)


def opt(x):
    return ("alt", (x, ("seq", ())))


def star(x):
    return ("star", x)


def plus(x):
    return seq(x, star(x))


def times(x, n: int):
    return seq(*[x] * n)


def backwards(x):
    if x[0] == "seq":
        return ("seq", tuple(backwards(y) for y in reversed(x[1])))
    if x[0] == "alt":
        return ("alt", tuple(backwards(y) for y in x[1]))
    return ("star", backwards(x[1])) if x[0] == "star" else x


# ---------------------------------------------------------------------- compiler

@dataclass
class Automaton:
    """``step[256 * state + byte]`` is 256 * the next state. Accepting states
    are numbered last (from ``accepts_from``); state 0 is the start. In an
    anchored automaton ``dead`` is the state that nothing leaves, or -1."""
    step: np.ndarray
    mask: np.ndarray
    accepts_from: int
    dead: int


def compile_rules(trees: list, search: bool) -> Automaton:
    eps: list[list[int]] = []
    arcs: list[list[tuple[frozenset, int]]] = []

    def state() -> int:
        eps.append([])
        arcs.append([])
        return len(eps) - 1

    def build(x, a: int) -> int:
        """Adds x after state a; returns its end."""
        if x[0] == "set":
            b = state()
            arcs[a].append((x[1], b))
            return b
        if x[0] == "seq":
            for y in x[1]:
                a = build(y, a)
            return a
        if x[0] == "alt":
            ends = []
            for y in x[1]:
                s = state()
                eps[a].append(s)
                ends.append(build(y, s))
            b = state()
            for e in ends:
                eps[e].append(b)
            return b
        s = state()
        eps[a].append(s)
        e = build(x[1], s)
        b = state()
        eps[s].append(b)
        eps[e].append(s)
        return b

    root = state()
    accept: dict[int, int] = {}
    for i, t in enumerate(trees):
        s = state()
        eps[root].append(s)
        accept[build(t, s)] = 1 << i

    # Bytes that no rule tells apart share a class.
    sets = list({cs for out in arcs for cs, _ in out})
    signature = [tuple(b in cs for cs in sets) for b in range(256)]
    kinds = {k: i for i, k in enumerate(dict.fromkeys(signature))}
    of_byte = np.array([kinds[k] for k in signature])
    members = [next(b for b in range(256) if of_byte[b] == k) for k in range(len(kinds))]

    @functools.cache
    def closure(s: int) -> frozenset:
        seen, todo = {s}, [s]
        while todo:
            for y in eps[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return frozenset(seen)

    first = closure(root)
    ids, todo, table_ = {first: 0}, [first], []
    while todo:
        here = todo.pop(0)
        row = []
        for b in members:
            to = set(first) if search else set()
            for s in here:
                for cs, e in arcs[s]:
                    if b in cs:
                        to |= closure(e)
            key = frozenset(to)
            if key not in ids:
                ids[key] = len(ids)
                todo.append(key)
            row.append(ids[key])
        table_.append(row)
    masks = np.array([sum({accept.get(s, 0) for s in key}) for key in ids])
    move = np.array(table_)

    # Minimise: refine the partition by accept mask until it is stable.
    block = np.unique(masks, return_inverse=True)[1]
    while True:
        rows = np.column_stack([block, block[move]])
        finer = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    n = block.max() + 1
    pick = np.array([np.flatnonzero(block == k)[0] for k in range(n)])
    order = np.argsort((masks[pick] != 0) * 2 + (pick != 0), kind="stable")  # the start first, accepting states last
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    move, masks = at[block[move[pick[order]]]], masks[pick[order]]
    loops = [s for s in range(n) if masks[s] == 0 and (move[s] == s).all()]
    return Automaton((move[:, of_byte] * 256).astype(np.int32).ravel(), masks,
                     int((masks == 0).sum()), -1 if search or not loops else loops[0])


# ------------------------------------------------------------------------- rules

@dataclass(frozen=True)
class Rule:
    kind: str
    head: tuple
    tail: tuple
    least: int          # least length of the counted part
    counted_from: str = ""   # the counted part begins behind this byte set, else the whole match counts

    @property
    def tree(self) -> tuple:
        return seq(self.head, self.tail)


ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
VALUE = chars(ALNUM + "+/_.=-")
QUOTE = opt(chars("\"'"))
KEYWORD = alt(either_case("password"), either_case("passwd"), either_case("secret"), either_case("token"),
              seq(either_case("api"), opt(chars("_")), either_case("key")))
HEX = chars("0123456789abcdef")

UPPER = chars("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
URL64 = chars(ALNUM + "_-")

BASE_RULES = (
    Rule("assign", seq(KEYWORD, QUOTE, star(chars(" ")), chars(":="), star(chars(" ")), QUOTE, VALUE), star(VALUE), 6, ":="),
    Rule("access", lit("AKIA"), plus(UPPER), 20),
    # A run of 24 or more, whole: the same as runs of any length less the short ones.
    Rule("hex", times(HEX, 24), star(HEX), 24),
)
MORE_RULES = (
    Rule("github", seq(lit("gh"), chars("pousr"), lit("_")), plus(chars(ALNUM)), 40),
    Rule("slack", seq(lit("xox"), chars("abprs"), lit("-")), plus(chars(ALNUM + "-")), 15),
    Rule("google", lit("AIza"), plus(URL64), 39),
    Rule("stripe", seq(alt(lit("sk"), lit("rk")), lit("_live_")), plus(chars(ALNUM)), 24),
    Rule("jwt", lit("eyJ"), seq(plus(URL64), lit("."), plus(URL64), lit("."), plus(URL64)), 30),
    Rule("pem", lit("-----BEGIN "), seq(star(chars("ABCDEFGHIJKLMNOPQRSTUVWXYZ ")), lit("PRIVATE KEY-----")), 27),
)
RULES = BASE_RULES + MORE_RULES


@functools.cache
def combined(rules: tuple[Rule, ...]) -> Automaton:
    return compile_rules([r.head for r in rules], search=True)


@functools.cache
def single(rule: Rule) -> tuple[Automaton, Automaton]:
    return compile_rules([rule.tree], search=False), compile_rules([backwards(rule.head)], search=False)


# -------------------------------------------------------------------------- scan

LANE = 4096


def scan_block(data: np.ndarray, dfa: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``data`` at which a rule accepts, ascending, and the masks."""
    n = len(data)
    lanes = max(1, -(-n // LANE))
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[:n] = data
    columns = np.ascontiguousarray(padded.reshape(lanes, LANE).T).astype(np.int32)
    least = dfa.accepts_from * 256

    def run(which: np.ndarray, s: np.ndarray):
        cols = columns if len(which) == lanes else columns[:, which]
        hits = []
        for i in range(LANE):
            s = dfa.step[s + cols[i]]
            on = s >= least
            if on.any():
                k = np.flatnonzero(on)
                hits.append((which[k] * LANE + i, s[k]))
        at = np.concatenate([h[0] for h in hits]) if hits else np.empty(0, np.int64)
        st = np.concatenate([h[1] for h in hits]) if hits else np.empty(0, np.int32)
        return s, at, st

    every = np.arange(lanes)
    starts = np.zeros(lanes, np.int32)
    ends, at, st = run(every, starts)
    while True:
        right = np.concatenate([[0], ends[:-1]]).astype(np.int32)
        again = np.flatnonzero(right != starts)
        if not len(again):
            break
        keep = ~np.isin(at // LANE, again)
        e, at2, st2 = run(again, right[again])
        ends[again], starts[again] = e, right[again]
        at, st = np.concatenate([at[keep], at2]), np.concatenate([st[keep], st2])
    order = np.argsort(at, kind="stable")
    return at[order], dfa.mask[st[order] // 256]


def _longest(step, dfa: Automaton, data: bytes, positions, failed: array | None = None) -> int:
    """Last of the positions at which the anchored automaton accepts, or -1.
    ``failed`` has the state, by position, of runs that accepted nothing from
    there on: a run that meets one of them ends."""
    s, found = 0, -1
    dead, accepts = dfa.dead * 256, dfa.accepts_from * 256
    for p in positions:
        s = step[s + data[p]]
        if s == dead or failed is not None and failed[p] == s:
            break
        if s >= accepts:
            found = p
    return found


def _note_failure(step, dfa: Automaton, data: bytes, start: int, failed: array) -> None:
    """The states of a run from ``start`` that accepts nothing, up to where a noted one goes on."""
    s, dead = 0, dfa.dead * 256
    for p in range(start, len(data)):
        s = step[s + data[p]]
        if s == dead or failed[p] == s:
            break
        failed[p] = s


@functools.cache
def _lists(rule: Rule):
    ahead, back = single(rule)
    return ahead.step.tolist(), ahead, back.step.tolist(), back


def spans_of(data: bytes, hits: dict[int, list[int]], rules: tuple[Rule, ...]) -> list[tuple[int, int, int]]:
    """(start, end, rule) in bytes, from the accept positions of each rule."""
    out = []
    for k, ends in hits.items():
        rule = rules[k]
        step, ahead, step_back, back = _lists(rule)
        done, failed = 0, None
        for e in ends:
            if e < done:
                continue
            start = _longest(step_back, back, data, range(e, done - 1, -1))
            if start < 0:
                continue  # its start lies in a match already consumed
            end = _longest(step, ahead, data, range(start, len(data)), failed) + 1
            if not end:
                # Tails are loops: the runs of later heads fall in with this one, and aren't
                # run to its end again, so a text of heads alone takes linear time.
                if failed is None:
                    failed = array("i", [-1]) * len(data)
                _note_failure(step, ahead, data, start, failed)
                continue
            done = end
            counted = end - start
            if rule.counted_from:
                p = start
                while data[p] not in rule.counted_from.encode():
                    p += 1
                p += 1
                while data[p] == 32:
                    p += 1
                if data[p] in b"\"'":
                    p += 1
                counted = end - p
            if counted >= rule.least:
                out.append((start, end, k))
    return sorted(out, key=lambda x: (x[0], x[2]))


def find_spans(texts: list[bytes], rules: tuple[Rule, ...] = RULES, block_bytes: int = 8 << 20):
    """Per text, the spans (start, end, kind) in code points, by start and
    then by the order of the rules."""
    dfa = combined(rules)
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for a, b in slices(texts, block_bytes):
        data = np.frombuffer(b"\0".join(texts[a:b]) + b"\0", np.uint8)
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts[a:b]])
        at, masks = scan_block(data, dfa)
        if not len(at):
            continue
        doc = np.searchsorted(bounds, at, side="right") - 1
        for i in np.unique(doc):
            mine = doc == i if len(at) < 4096 else slice(*np.searchsorted(doc, [i, i + 1]))
            hits: dict[int, list[int]] = defaultdict(list)
            for p, m in zip((at[mine] - bounds[i]).tolist(), masks[mine].tolist()):
                while m:
                    low = m & -m
                    hits[low.bit_length() - 1].append(p)
                    m ^= low
            text = texts[a + i]
            spans = spans_of(text, hits, rules)
            if spans:
                raw = np.frombuffer(text, np.uint8)
                points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                out[a + i] = [(int(points[s]), int(points[e]), rules[k].kind) for s, e, k in spans]
    return out


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])


def scan_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` plus ``secret_spans``: array of (start, end, kind), code points,
    end exclusive. A map over the rows: no shuffle."""
    if "secret_spans" in docs.columns:
        raise ValueError("the input has a column secret_spans")
    schema = StructType(docs.schema.fields + StructType.fromDDL(
        "secret_spans array<struct<start:long,end:long,kind:string>>").fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = find_spans(utf8_lists(b, text), rules)
            spans = pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in found], pa.list_(SPAN))
            yield pa.RecordBatch.from_arrays([*b.columns, spans], names=[*b.schema.names, "secret_spans"])

    return map_texts(docs, scan, schema)


def _mask(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    if not spans:
        return text
    parts, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if end <= at:
            continue
        parts += [text[at:max(at, start)], f"[{kind}]" if start >= at else ""]
        at = end
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, and
    ``n_chars`` (if there) counted anew; the rows and other columns stay."""
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index("text")
            found = find_spans(utf8_lists(b, "text"), rules)
            new = [_mask(t, s) for t, s in zip(b.column(i).to_pylist(), found)]
            columns = list(b.columns)
            columns[i] = pa.array(new, b.column(i).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    out = map_texts(docs, mask, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


DIGEST = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base = [r.kind for r in BASE_RULES]
    order = {r.kind: i for i, r in enumerate(RULES)}
    for b in batches:
        rows = []
        for i, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            listed = sorted(((s["start"], order[s["kind"]], s["end"], s["kind"]) for s in spans))
            said = [(k, f"{k}:{s}:{e}") for s, _, e, k in listed]
            own = ",".join(x for k, x in said if k in base)
            rows.append((i, *(sum(k == y for k, _ in said) for y in base),
                         hashlib.sha256(own.encode()).hexdigest(), ",".join(x for _, x in said), len(said)))
        if rows:
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                                                    "spans", "n_spans"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return scan_secrets(docs).select("doc_id", "secret_spans").mapInArrow(_digest, DIGEST)
