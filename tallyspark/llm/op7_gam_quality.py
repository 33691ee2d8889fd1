"""Operator 7, quality classifier: a generalised additive model with pairwise
interactions.

Features are computed in one map over the whole texts. Each is cut into
quantile bins. Boosting goes round the features cyclically: every step fits
one shallow tree (three cuts) to the current gradients of one feature's bins
and adds a small part of it to that feature's lookup table, so the model
stays additive. Then the pairs of features with the most residual gain get
tables over a coarse grid, boosted cyclically with trees of two levels (a cut
of one feature, then of the other on either side). A score is the logistic of
the intercept plus one table entry per feature and pair: vectorised bin
look-ups and additions in a map over the feature rows.

Only the training rows are collected, a seeded sample of at most
``max_rows`` labelled documents; scoring covers every row.

Defined cases: a null or empty text has all features 0 and gets that score;
null or repeated ids are scored row by row; rows of the labels with a null
label are not used; contradicting labels of a document both count; with no
or one-sided labels the score is the smoothed share of label 1; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import map_texts, mix64, table, utf8_lists, window_hashes, written

FEATURES = ("log_words", "mean_word", "long_words", "symbols", "marked_words", "upper", "digits", "punctuation",
            "non_ascii", "distinct", "top_word", "echo", "repeated_trigrams", "line_words", "repeated_lines",
            "bars", "shouts", "capital_words")
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", np.uint8)


def features_of(text: bytes) -> tuple[float, ...]:
    """The features of a text, each bounded and 0 for an empty one."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = int(counts.sum())
    chars = size - int(counts[0x80:0xC0].sum())
    solid = max(1, chars - int(counts[9:14].sum() + counts[32]))
    lengths = np.fromiter(map(len, words), np.int64, n)
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    top = int(np.bincount(codes).max())
    echo = float((codes[1:] == codes[:-1]).mean()) if n > 1 else 0.0
    repeated = 0.0
    if n > 2:
        tri = window_hashes(mix64(codes.view(np.uint64)), 3)
        repeated = 1.0 - len(np.unique(tri)) / len(tri)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    ends = np.fromiter((w[-1] for w in words), np.uint8, n)
    heads = np.fromiter((w[0] for w in words), np.uint8, n)
    return (
        float(np.log1p(n)), float(min(solid / n, 50.0)), float((lengths > 24).mean()),
        float(counts[_SYMBOLS].sum() / solid), float(np.isin(ends, _SYMBOLS).mean()),
        float(counts[65:91].sum() / solid), float(counts[48:58].sum() / solid),
        float(counts[_PUNCTUATION].sum() / solid), float(counts[0xC0:].sum() / solid),
        len(seen) / n, top / n, echo, repeated,
        float(min(n / max(1, len(lines)), 1000.0)), 1.0 - len(set(lines)) / max(1, len(lines)),
        float(counts[124] / n), float(counts[33] / n), float(((heads >= 65) & (heads <= 90)).mean()))


FEATURE_ROWS = "doc_id long, x array<float>"


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [features_of(t) for t in utf8_lists(b, "text")]
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(x, pa.list_(pa.float32()))],
                                         names=["doc_id", "x"])


def featurise(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features of every row's whole text."""
    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _featurise, FEATURE_ROWS)


# ------------------------------------------------------------------------- model

@dataclass
class Gam:
    intercept: float
    cuts: list[np.ndarray]                       # bin edges of each feature
    tables: list[np.ndarray]                     # a value per bin
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)    # coarse edges of each feature
    pair_tables: list[np.ndarray] = field(default_factory=list)  # a grid per pair

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for j, (c, t) in enumerate(zip(self.cuts, self.tables)):
            z += t[np.searchsorted(c, x[:, j], side="right")]
        coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.pair_cuts)]
        for (a, b), t in zip(self.pairs, self.pair_tables):
            z += t[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-z))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)


def _best_cut(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[float, int]:
    """Gain and place (bins up to it go left) of the best cut of a row of bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - g.sum() ** 2 / (h.sum() + lam)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, lam: float, cuts: int = 3) -> np.ndarray:
    """A value per bin: a tree grown by best gain with so many cuts."""
    leaves = [(0, len(g))]
    for _ in range(cuts):
        found = [(*_best_cut(g[a:b], h[a:b], lam), a, b) for a, b in leaves]
        gain, k, a, b = max(found, key=lambda f: f[0])
        if gain <= 1e-9:
            break
        leaves.remove((a, b))
        leaves += [(a, a + k), (a + k, b)]
    out = np.empty(len(g))
    for a, b in leaves:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + lam)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[float, np.ndarray]:
    """Gain and values of a tree of two levels over a grid: the best cut along
    one axis, then the best cut along the other on either side."""
    best = (-1.0, np.zeros_like(g))
    for axis in (0, 1):
        gg, hh = (g, h) if axis == 0 else (g.T, h.T)
        for k in range(1, len(gg)):
            out, gain = np.empty_like(gg), 0.0
            for rows in (slice(0, k), slice(k, None)):
                gs, hs = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                _, c = _best_cut(gs, hs, lam)
                for cols in (slice(0, c), slice(c, None)):
                    a, b = gs[cols].sum(), hs[cols].sum() + lam
                    out[rows, cols] = -a / b
                    gain += a * a / b
            if gain > best[0]:
                best = (gain, out if axis == 0 else out.T.copy())
    return best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, rounds: int = 120, rate: float = 0.15, lam: float = 5.0,
        pair_bins: int = 8, n_pairs: int = 6, pair_rounds: int = 20) -> Gam:
    """Cyclic boosting on the training rows (logistic loss)."""
    ones = float(y.sum())
    base = (ones + 1) / (len(y) + 2)
    cuts = [_edges(x[:, j], bins) for j in range(len(FEATURES))]
    model = Gam(float(np.log(base / (1 - base))), cuts, [np.zeros(len(c) + 1) for c in cuts])
    if ones in (0.0, float(len(y))):
        return model
    place = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j, at in enumerate(place):
            g, h = slopes()
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(at, g, size), np.bincount(at, h, size), lam)
            model.tables[j] += step
            z += step[at]
    model.pair_cuts = [_edges(x[:, j], pair_bins) for j in range(len(FEATURES))]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]
    sizes = [len(c) + 1 for c in model.pair_cuts]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * sizes[b] + coarse[b], v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    g, h = slopes()
    ranked = sorted(((_grid_tree(grid(a, b, g), grid(a, b, h), lam)[0], a, b)
                     for a in range(len(sizes)) for b in range(a) if sizes[a] > 1 and sizes[b] > 1), reverse=True)
    model.pairs = [(a, b) for _, a, b in ranked[:n_pairs]]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            step = rate * _grid_tree(grid(a, b, g), grid(a, b, h), lam)[1]
            model.pair_tables[k] += step
            z += step[coarse[a], coarse[b]]
    return model


def held_out(doc_id) -> F.Column:
    """The test fold: crc32 of the id's decimal text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sampled(labels: DataFrame, max_rows: int = 20_000, seed: int = 7) -> DataFrame:
    """(doc_id, y): a seeded sample of at most ``max_rows`` labels outside the
    test fold, so small that it may be broadcast."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    return (known.filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
            .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "y").limit(max_rows))


def train(rows: DataFrame, labels: DataFrame, max_rows: int = 20_000, seed: int = 7) -> Gam:
    """Fits the model on at most ``max_rows`` labelled rows of ``rows``
    (doc_id, x)."""
    got = (rows.join(F.broadcast(sampled(labels, max_rows, seed)), "doc_id")
           .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "y").limit(max_rows).select("x", "y").toArrow())
    x = np.array(got["x"].to_pylist(), np.float32).astype(np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array(got["y"].to_pylist(), np.float64))


def train_on_texts(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, seed: int = 7) -> Gam:
    """The same model, where only the sampled documents need features."""
    ids = F.broadcast(sampled(labels, max_rows, seed).select("doc_id").distinct())
    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    return train(featurise(few), labels, max_rows, seed)


def _features_array(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index(column))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FEATURES))


def score_rows(rows: DataFrame, model: Gam) -> DataFrame:
    """(doc_id, score) for every feature row."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_features_array(b, "x")))],
                                             names=["doc_id", "score"])
    return rows.mapInArrow(score, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Gam, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows scored below the threshold: one map."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features_of(t) for t in utf8_lists(b, "text")], np.float32).astype(np.float64)
            good = model.score(x.reshape(-1, len(FEATURES))) >= threshold
            yield b.filter(pa.array(good, pa.bool_()))
    return map_texts(docs, keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every row of ``documents`` scored."""
    rows = written(featurise(table(spark, sf_dir, "documents")), "quality-features")
    model = train(rows, table(spark, sf_dir, "labels"))
    return score_rows(rows, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
