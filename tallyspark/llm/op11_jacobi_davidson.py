"""Operator 11, embedding whitening with a matrix-free Jacobi-Davidson solver.

1. Fit list. Every usable vector is put on the integer grid ``floor(step * c)``
   and packed (two, four or eight bytes an entry, whatever its own largest entry
   needs). Equal packed vectors collapse in the map tasks and then by key, so a
   vector that a third of all rows hold counts once and meets in no task. The
   distinct vectors are written in blocks of ``BLOCK_ROWS``.
2. Products. The covariance is never formed. ``V @ B`` for a few columns ``B``
   is one map over the blocks: centre the rows, multiply by ``B``, multiply
   back by the centred rows. A task sends one partial sum of the size of ``B``;
   partial sums of more than ``FAN_IN`` tasks are added up in groups by other
   tasks before the driver adds the rest, so what it holds is bounded by the
   dimension and not by the rows.
3. Solver (:func:`jacobi_davidson`). Rayleigh-Ritz in a search space gives the
   wanted pairs. The correction equation of each open pair, projected against
   all of them and the locked ones, is solved loosely by MINRES; all pairs
   share one distributed product per MINRES step. Corrections extend the
   space; at its largest size it is restarted from its best Ritz vectors.
   A pair is locked, in order from the top, once its residual is at double
   precision; the work ends when all are.
4. Whitening is a map over the rows with the few components.

Sums and squared deviations are exact integers. Equal eigenvalues give any
orthonormal basis of their space, the same for all rows.

Defined cases: rows whose vector is null, or has null or non-finite entries,
are left out, as are vectors of another dimension than the most frequent one
(of equally frequent ones the larger) and empty vectors; a null ``vec_id`` is
kept; repeated rows each have their results but count once in the fit; entries
beyond the grid of 64-bit integers take its end; a deviation beyond 64 bits
is null; fewer than k dimensions give as many components; a component
without variance has a null ``whitened`` and explains 0 (null if nothing
varies), and the identity error is then over the other components (null if
there are none); other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import map_texts, table, written

STEP = 256.0        # grid of the contract
COMPONENTS = 4
BLOCK_ROWS = 4096
FAN_IN = 256        # partial sums that the driver adds up itself
EPS = np.finfo(np.float64).eps
LIMIT = (1 << 63) - 1


# ------------------------------------------------------------------- fit list

def on_grid(values: np.ndarray, step: float) -> np.ndarray:
    """floor(step * value) as 64-bit integers; beyond them, their end."""
    y = np.floor(values * step)
    top = y >= 2.0 ** 63
    return np.where(top, LIMIT, np.where(top, 0, np.maximum(y, -2.0 ** 63)).astype(np.int64))


def _pack(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of int16, int32 and int64 that holds it, so
    that equal vectors have equal bytes."""
    out: list = [b""] * len(x)
    low, high = x.min(1), x.max(1)
    left = np.ones(len(x), bool)
    for kind in (np.int16, np.int32, np.int64):
        fits = left & (low >= np.iinfo(kind).min) & (high <= np.iinfo(kind).max)
        left &= ~fits
        rows = np.flatnonzero(fits)
        data, size = x[rows].astype(kind).tobytes(), x.shape[1] * np.dtype(kind).itemsize
        for i, r in enumerate(rows.tolist()):
            out[r] = data[i * size:(i + 1) * size]
    return out


def _unpack(rows: list[bytes], d: int) -> np.ndarray:
    x = np.empty((len(rows), d), np.int64)
    sizes = np.array([len(r) // d for r in rows])
    for kind in (np.int16, np.int32, np.int64):
        at = np.flatnonzero(sizes == np.dtype(kind).itemsize)
        if len(at):
            x[at] = np.frombuffer(b"".join([rows[i] for i in at.tolist()]), kind).reshape(len(at), d)
    return x


def _usable(vector) -> F.Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def on_grid_rows(vectors: DataFrame, column: str, step: float, d: int, keep: list[str]) -> DataFrame:
    """``keep`` and ``x``, the packed grid vector, of every usable row of dimension ``d``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                flat = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
                x = _pack(on_grid(flat.reshape(b.num_rows, d), step))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(x, pa.binary())], names=[*keep, "x"])

    rows = vectors.select(*keep, F.col(column).cast("array<double>").alias("_vector"))
    rows = rows.filter(_usable(F.col("_vector")) & (F.size("_vector") == d))
    schema = [f"`{n}` {t}" for n, t in rows.dtypes[:-1]]
    return map_texts(rows, pack, ", ".join([*schema, "x binary"]))


def dimension(vectors: DataFrame, column: str) -> int | None:
    """The most frequent dimension of the usable vectors."""
    v = F.col(column).cast("array<double>")
    top = (vectors.filter(_usable(v)).groupBy(F.size(v).alias("d")).count()
           .orderBy(F.desc("count"), F.desc("d")).first())
    return top.d if top else None


def _blocks(d: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            x = _unpack(rows, d)
            bound = max(int(x.max()), -int(x.min()) - 1)
            kind = np.int16 if bound < 1 << 15 else np.int32 if bound < 1 << 31 else np.int64
            # Sums of the high and low halves: neither can overflow in a block.
            halves = np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)])
            return pa.RecordBatch.from_arrays(
                [pa.array([len(rows)], pa.int64()), pa.array([x.astype(kind).tobytes()], pa.binary()),
                 pa.array([halves.ravel().tolist()], pa.list_(pa.int64()))], names=["n", "x", "sums"])

        rows: list[bytes] = []
        for b in batches:
            rows += b.column(0).to_pylist()
            while len(rows) >= BLOCK_ROWS:
                yield out(rows[:BLOCK_ROWS])
                rows = rows[BLOCK_ROWS:]
        if rows:
            yield out(rows)
    return blocks


def _summed(df: DataFrame, function: Callable, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over the blocks (n, x) of ``function(x as integers)``, an array of
    ``shape``; partial sums are added in a fixed order."""
    d = shape[0]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = np.zeros(shape)
        for b in batches:
            for n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total += function(np.frombuffer(x, f"<i{len(x) // (n * d)}").reshape(n, d))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                          pa.array([total.tobytes()], pa.binary())], names=["part", "total"])

    parts = df.select("n", "x").mapInArrow(partial, "part int, total binary")
    tasks = df.rdd.getNumPartitions()
    if tasks > FAN_IN:
        def add(rows: pa.Table) -> pa.Table:
            by_part = sorted(zip(rows["part"].to_pylist(), rows["total"].to_pylist()))
            total = np.sum([np.frombuffer(t) for _, t in by_part], axis=0)
            return pa.table({"part": pa.array([by_part[0][0]], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})
        groups = -(-tasks // FAN_IN)
        parts = parts.groupBy(F.expr(f"part % {max(groups, FAN_IN)}")).applyInArrow(add, "part int, total binary")
    rows = sorted((r.part, bytes(r.total)) for r in parts.collect())
    return np.sum([np.frombuffer(t).reshape(shape) for _, t in rows], axis=0) if rows else np.zeros(shape)


class FitList:
    """The distinct grid vectors, in written blocks, with their exact sums."""

    def __init__(self, packed: DataFrame, d: int):
        self.d = d
        self.blocks = written(map_texts(packed.select("x").distinct(), _blocks(d), "n long, x binary, sums array<long>"), "whiten-fit")
        # Exact sums over all blocks: entry by entry, as decimals.
        sums = (self.blocks.select("n", F.posexplode("sums").alias("j", "s")).groupBy("j")
                .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
        self.n = int(sums[0].n) if sums else 0
        halves = {r.j: int(r.s) for r in sums}
        self.sums = [(halves[j] << 32) + halves[d + j] for j in range(d)] if sums else []
        self.mean = np.array([s / self.n for s in self.sums]) if sums else np.zeros(d)

    def product(self, b: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``b``: one pass over the blocks."""
        mean = self.mean

        def part(x):
            c = x - mean
            return c.T @ (c @ b)
        return _summed(self.blocks, part, b.shape) / self.n

    def trace(self) -> float:
        mean = self.mean
        return float(_summed(self.blocks, lambda x: ((x - mean) ** 2).sum(0), (self.d,)).sum()) / self.n

    def whitened_covariance(self, w: np.ndarray) -> np.ndarray:
        """Covariance of the fit list's whitened values, centred before multiplying."""
        mean, k, d = self.mean, w.shape[1], self.d

        def total(x):
            return np.pad(((x - mean) @ w).sum(0), (0, d - k))
        centre = _summed(self.blocks, total, (d,))[:k] / self.n

        def squares(x):
            y = (x - mean) @ w - centre
            return np.pad(y.T @ y, ((0, d - k), (0, 0)))
        return _summed(self.blocks, squares, (d, k))[:k] / self.n


# --------------------------------------------------------------------- solver

def _orthonormal(t: np.ndarray, *spaces: np.ndarray) -> np.ndarray:
    """Columns of ``t`` made orthonormal to the spaces and to each other;
    those that lie in them are dropped."""
    out: list[np.ndarray] = []
    for v in t.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            for s in spaces:
                v = v - s @ (s.T @ v)
            for o in out:
                v = v - o * (o @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        else:
            out.append(v)
    return np.array(out).T if out else np.empty((len(t), 0))


def _minres(product: Callable, theta: np.ndarray, x: np.ndarray, r: np.ndarray, steps: int, cut: float) -> np.ndarray:
    """Solutions t of (I - XX') (V - theta) (I - XX') t = -r, a column for
    each theta, by MINRES with one shared product a step; columns end once
    their residual fell by ``cut``."""
    def outside(y):
        y = y - x @ (x.T @ y)
        return y - x @ (x.T @ y)

    m = r.shape[1]
    v = outside(-r)
    beta = np.linalg.norm(v, axis=0)
    first = np.where(beta > 0, beta, 1)
    eta, old, t = beta.copy(), np.zeros_like(v), np.zeros_like(v)
    v = v / first
    w1, w0 = np.zeros_like(v), np.zeros_like(v)
    c0 = c1 = np.ones(m)
    s0 = s1 = np.zeros(m)
    beta = np.zeros(m)
    live = eta > 0
    for _ in range(steps):
        y = np.zeros_like(v)
        y[:, live] = product(v[:, live])
        y = outside(y - theta * v) - beta * old
        alpha = (v * y).sum(0)
        y = y - alpha * v
        after = np.linalg.norm(y, axis=0)
        # The new column of the tridiagonal matrix through the last two rotations and a new one.
        delta = c1 * alpha - c0 * s1 * beta
        rho2 = s1 * alpha + c0 * c1 * beta
        rho3 = s0 * beta
        rho1 = np.hypot(delta, after)
        live = live & (rho1 > 0)
        safe = np.where(rho1 > 0, rho1, 1)
        c0, c1, s0, s1 = c1, np.where(rho1 > 0, delta / safe, 1), s1, np.where(rho1 > 0, after / safe, 0)
        w = (v - rho3 * w0 - rho2 * w1) / safe
        t = t + np.where(live, c1 * eta, 0) * w
        w0, w1 = w1, w
        eta = -s1 * eta
        live = live & (np.abs(eta) > cut * first) & (after > EPS * np.abs(theta))
        if not live.any():
            break
        old, v, beta = v, y / np.where(after > 0, after, 1), after
    return outside(t)


@dataclass
class Pairs:
    values: np.ndarray     # falling
    vectors: np.ndarray    # unit columns
    residuals: np.ndarray
    products: int          # passes over the data


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 11,
                    spare: int = 12, inner: int = 3, largest: int | None = None, max_outer: int = 300) -> Pairs:
    """The ``k`` largest eigenpairs of a symmetric positive semidefinite
    operator of dimension ``d`` that is known by its products only.

    ``spare`` further Ritz pairs are corrected along with the wanted ones, as a
    pass over the data costs about the same for a few more columns."""
    passes = 0

    def times(b):
        nonlocal passes
        passes += 1
        return product(b)

    k = min(k, d)
    block = min(d, k + spare)
    largest = min(d, largest or 6 * block)
    rnd = np.random.default_rng(seed)
    q = _orthonormal(rnd.standard_normal((d, block)))
    aq = times(q)
    x, values, errors, best, stuck = np.empty((d, 0)), [], [], np.inf, 0
    for outer in range(max_outer):
        theta, s = np.linalg.eigh((h := q.T @ aq, (h + h.T) / 2)[1])
        theta, s = theta[::-1], s[:, ::-1]
        q, aq = q @ s, aq @ s
        scale = max([*values, theta[0], 0]) if len(theta) else 1
        goal = max(64, d) * EPS * scale
        r = aq - q * theta
        size = np.linalg.norm(r, axis=0)
        done = 0
        while len(values) + done < k and done < len(theta) and size[done] <= goal:
            done += 1
        if done:
            # Locked pairs leave the search space; what remains is orthogonal to them.
            x = np.hstack([x, q[:, :done]])
            values += theta[:done].tolist()
            errors += size[:done].tolist()
            q, aq, theta, r, size = q[:, done:], aq[:, done:], theta[done:], r[:, done:], size[done:]
            best, stuck = np.inf, 0
        if len(values) == k:
            break
        want = min(block - len(values), q.shape[1])
        worst = size[:k - len(values)].max() if want else np.inf
        stuck = 0 if worst < 0.5 * best else stuck + 1
        best = min(best, worst)
        if stuck >= 6 and want:
            # Rounding has gathered in the kept products: start from fresh ones of the best vectors.
            q = _orthonormal(q[:, :max(block, want)], x)
            aq, best, stuck = times(q), np.inf, 0
            aq = aq - x @ (x.T @ aq)
            continue
        if q.shape[1] + want > largest - len(values) and q.shape[1] > block:
            q, aq = q[:, :block], aq[:, :block]
            theta, r = theta[:block], r[:, :block]
        known = np.hstack([x, q[:, :want]])
        t = _minres(times, theta[:want], known, r[:, :want], inner, max(1e-3, 0.5 ** (outer + 1))) if want else np.empty((d, 0))
        new = _orthonormal(t, x, q)
        if not new.shape[1]:
            new = _orthonormal(r[:, :want], x, q)
        if not new.shape[1]:
            new = _orthonormal(rnd.standard_normal((d, 1)), x, q)
        if not new.shape[1]:
            raise RuntimeError("the search space is whole and its residuals are above double precision")
        an = times(new)
        an = an - x @ (x.T @ an)
        q, aq = np.hstack([q, new]), np.hstack([aq, an])
    else:
        raise RuntimeError(f"no convergence in {max_outer} steps: residuals {size[:want]}")
    order = np.argsort(-np.array(values), kind="stable")
    return Pairs(np.array(values)[order], x[:, order], np.array(errors)[order], passes)


# ------------------------------------------------------------------ operators

@dataclass
class Whitening:
    """A fitted transformation: exact sums, and per component its direction
    (a column), eigenvalue and share of the trace."""
    step: float
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: list[float | None]
    identity_error: float | None
    products: int

    @property
    def d(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def has_variance(self) -> np.ndarray:
        return self.values > max(64, self.d) * EPS * max([*self.values, 0])

    @property
    def directions(self) -> np.ndarray:
        """Components over the roots of their eigenvalues; 0 without variance."""
        ok = self.has_variance
        return np.where(ok, self.components / np.sqrt(np.where(ok, self.values, 1)), 0)


def fit_whitening(vectors: DataFrame, column: str = "embedding", k: int = COMPONENTS, step: float = STEP) -> Whitening | None:
    """Fits ``k`` components on the distinct grid vectors of ``column``; null if
    there is no usable vector."""
    d = dimension(vectors, column)
    if d is None:
        return None
    fit = FitList(on_grid_rows(vectors, column, step, d, []), d)
    trace = fit.trace()
    pairs = jacobi_davidson(fit.product, d, k)
    model = Whitening(step, fit.n, fit.sums, pairs.vectors, pairs.values,
                      [float(max(e, 0) / trace) if trace > 0 else None for e in pairs.values], None, pairs.products)
    ok = model.has_variance
    if ok.any():
        cov = fit.whitened_covariance(model.directions[:, ok])
        model.identity_error = float(np.abs(cov - np.eye(int(ok.sum()))).max())
    return model


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2 per row, exact; null beyond 64 bits."""
    bound = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums))
    if bound * bound * len(sums) <= LIMIT:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [e if e <= LIMIT else None for e in exact]


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``keep``, ``deviation`` and ``whitened`` (an array, a value per component) for every usable row."""
    mean, w, ok, d, n, sums = model.mean, model.directions, model.has_variance.tolist(), model.d, model.n, model.sums

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _unpack(b.column(b.num_columns - 1).to_pylist(), d)
            y = ((x - mean) @ w).tolist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(deviations(x, n, sums), pa.int64()),
                 pa.array([[v if o else None for v, o in zip(row, ok)] for row in y], pa.list_(pa.float64()))],
                names=[*b.schema.names[:-1], "deviation", "whitened"])

    rows = on_grid_rows(vectors, column, model.step, d, list(keep))
    schema = [f"`{c}` {t}" for c, t in rows.dtypes[:-1]]
    return map_texts(rows, score, ", ".join([*schema, "deviation long", "whitened array<double>"]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``embeddings``: a row per vector and component."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return whitened_rows(vectors)


def whitened_rows(vectors: DataFrame) -> DataFrame:
    model = fit_whitening(vectors)
    if model is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(e).cast("double") for e in model.explained])
    return (whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("j", "whitened"))
            .select("vec_id", (F.col("j") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    shares[F.col("j")].alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error")))
