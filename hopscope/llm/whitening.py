"""Whitening of vectors: leading eigenvectors of their covariance by Chebyshev-filtered subspace iteration.

Entries become whole numbers ``x = floor(64 c) + 1000000``. The covariance V
is never formed: a *pass* multiplies it with a block of columns, each task adding
``Xcᵀ(Xc Q)`` over its own centred rows, and the sums of tasks are added up in
two steps. Only matrices of (dimension x block) reach the driver, whose size
doesn't depend on the number of rows.

A block wider than the wanted components starts at random. A few Lanczos passes bound the
spectrum from below; the smallest Ritz value of the block bounds the unwanted
part from above. On that interval the Chebyshev recurrence
``T_{j+1} = 2 t(V) T_j - T_{j-1}``, one pass a degree, stays within 1, while it
grows outside, so it damps the unwanted spectrum. Then come QR and Rayleigh-Ritz,
until every wanted pair is certified by its residual ``|Vq - eq|``, relative to
the largest eigenvalue; certified leading columns are locked. If a bound proves wrong, the interval is taken from 0.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are
dropped; where lengths differ, the most frequent one counts (ties: the longer) and
rows of others are dropped. Repeated rows and keys count and are returned as
often as they occur. No row left, or all rows equal, gives an empty result; so do
directions without any spread (eigenvalue below 1e-12 of the largest): fewer
components are returned then. Equal eigenvalues: any orthonormal basis of
their space. A sum of squares that exceeds a long gives a null ``deviation``; entries beyond
1e13 raise. Extra columns are carried as asked, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from hopscope.sources.staging import stage

COMPONENTS = 32
SPARE = 16  # columns of the block beyond the wanted ones
DEGREE = 16
LANCZOS = 10
TOLERANCE = 1e-13
ROUNDS = 40
FLAT = 1e-12
SCALE, SHIFT = 64, 1_000_000
_LARGEST = 1e13
_AHEAD = 1e8
_ROWS = 2048  # vectors in one stored block
_SEED = 13


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: np.ndarray  # exact, of x
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # columns
    trace: float
    identity_error: float
    residual: float  # greatest of the certified pairs, relative to the largest eigenvalue
    passes: int

    @property
    def dims(self) -> int:
        return len(self.sums)


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, not empty and finite throughout."""
    bad = F.exists(F.col("v"), lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    own = F.struct(F.lit(1).alias("none"), *(vectors[f"`{c}`"] for c in vectors.columns)).alias("own")
    rows = vectors.select(own, vectors[f"`{vector}`"].cast("array<double>").alias("v"))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(~bad)


def whole(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The vectors of a batch as whole numbers."""
    lists = batch.column("v")
    c = np.asarray(lists.flatten(), dtype=np.float64).reshape(-1, dims)
    if len(c) and np.abs(c).max() > _LARGEST:
        raise ValueError(f"an entry beyond {_LARGEST:g} can't be summed exactly")
    return np.floor(c * SCALE).astype(np.int64) + SHIFT


def _packed(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(batch, dims)
            blocks = [x[i : i + _ROWS].tobytes() for i in range(0, len(x), _ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["x"])

    return run


class Passes:
    """Sums over stored blocks of vectors."""

    def __init__(self, packed: DataFrame, dims: int):
        self.packed, self.dims, self.count = packed, dims, 0
        self.parts = packed.rdd.getNumPartitions()
        self.n, self.sums = 0, np.zeros(dims, np.int64)

    def total(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], dtype=np.float64) -> np.ndarray:
        """``part`` of each block, added up: in each task, then by about the root of their number, then here."""
        dims = self.dims

        def added(blobs):
            out = np.zeros(shape, dtype)
            for blob in blobs:
                out += blob
            return pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sum"])

        def first(batches):
            blocks = (np.frombuffer(b.as_buffer(), np.int64).reshape(-1, dims) for batch in batches for b in batch.column("x"))
            yield added(part(x) for x in blocks)

        def again(batches):
            yield added(np.frombuffer(b.as_buffer(), dtype).reshape(shape) for batch in batches for b in batch.column("sum"))

        self.count += 1
        sums = self.packed.mapInArrow(first, "sum binary")
        if self.parts > 16:
            sums = sums.repartition(math.isqrt(self.parts)).mapInArrow(again, "sum binary")
        out = np.zeros(shape, dtype)
        for row in sums.collect():
            out += np.frombuffer(row["sum"], dtype).reshape(shape)
        return out

    def centre(self) -> None:
        """Number of rows and exact sums of each dimension."""
        made = self.total(lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), (self.dims + 1,), np.int64)
        self.n, self.sums = int(made[0]), made[1:]

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        n, sums = self.n, self.sums
        return lambda x: (x * n - sums) / n

    def times(self, block: np.ndarray) -> np.ndarray:
        """The covariance times ``block``, without the covariance."""
        centred = self.centred()

        def part(x):
            c = centred(x)
            return c.T @ (c @ block)

        return self.total(part, block.shape) / self.n

    def trace(self) -> float:
        centred = self.centred()
        return float(self.total(lambda x: np.array([np.square(centred(x)).sum()]), (1,))[0]) / self.n

    def spread(self, project: np.ndarray) -> np.ndarray:
        """Covariance of the rows after ``project``: their means are taken off before multiplying."""
        centred, r = self.centred(), project.shape[1]

        def part(x):
            w = centred(x) @ project
            return np.concatenate([w.T @ w, w.sum(axis=0)[None]])

        made = self.total(part, (r + 1, r)) / self.n
        return made[:r] - np.outer(made[r], made[r])


def lower_bound(passes: Passes, steps: int) -> float:
    """A number that the spectrum is very likely above: the least Ritz value of a Lanczos run, less its last residual."""
    rng = np.random.default_rng(_SEED + 1)
    q = rng.standard_normal(passes.dims)
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, passes.dims)):
        w = passes.times(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        for _ in range(2):
            w -= np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-10 * max(alpha):
            beta[-1] = 0.0
            break
        basis.append(w / beta[-1])
    k = len(alpha)
    ritz = np.linalg.eigvalsh(np.diag(alpha) + np.diag(beta[: k - 1], 1) + np.diag(beta[: k - 1], -1))
    return max(0.0, float(ritz[0] - beta[-1]))


def growth(value: float, low: float, high: float) -> float:
    """Factor a degree by which the filter on [low, high] enlarges an eigenvalue above it."""
    at = max(1.0, (2 * value - high - low) / (high - low))
    return at + math.sqrt(at * at - 1)


def chebyshev(
    passes: Passes, block: np.ndarray, locked: np.ndarray, low: float, high: float, top: float, degree: int
) -> np.ndarray:
    """A filter of the given degree on ``block``, without ``locked`` columns: at most 1 on [low, high], divided by its size at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2

    def shifted(x):
        made = passes.times(x) - middle * x
        return made - locked @ (locked.T @ made)

    first = ratio = half / (top - middle)
    before, now = block, shifted(block) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - ratio)
        before, now = now, shifted(now) * (2 * after / half) - before * (ratio * after)
        ratio = after
    return now


def leading(passes: Passes, wanted: int, spare: int = SPARE, degree: int = DEGREE, tolerance: float = TOLERANCE):
    """(eigenvalues, vectors, greatest relative residual) of the ``wanted`` largest pairs, certified."""
    d = passes.dims
    m = min(d, wanted + spare)
    low = lower_bound(passes, LANCZOS) if m < d else 0.0
    block = np.linalg.qr(np.random.default_rng(_SEED).standard_normal((d, m)))[0]
    best = np.inf
    for _ in range(ROUNDS):
        product = passes.times(block)
        ritz = block.T @ product
        theta, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        top = theta[0]
        if top <= 0:
            return np.zeros(0), np.zeros((d, 0)), 0.0
        off = np.linalg.norm(product - block * theta, axis=0)[:wanted] / top
        worst = float(off.max())
        # Rounding in the passes ends what more rounds can gain.
        if worst <= tolerance or (worst <= 100 * tolerance and worst > best / 2):
            return theta[:wanted], block[:, :wanted], worst
        best = min(best, worst)
        high = float(theta[-1])
        if low >= high:
            low = 0.0
        if high - low <= 1e-9 * top:  # hardly any unwanted spectrum to damp: plain iteration
            block = np.linalg.qr(product)[0]
            continue
        # Converged leading columns stay as they are. The largest of the others may outgrow the
        # least wanted one only so far that the block keeps its digits.
        lock = int(np.argmax(off > tolerance))
        ahead = growth(theta[lock], low, high) / growth(theta[wanted - 1], low, high)
        steps = min(degree, max(2, int(math.log(_AHEAD) / math.log(ahead)))) if ahead > 1 else degree
        made = chebyshev(passes, block[:, lock:], block[:, :lock], low, high, float(theta[lock]), steps)
        block = np.linalg.qr(np.concatenate([block[:, :lock], made], axis=1))[0]
    raise RuntimeError(f"no certified eigenvectors after {ROUNDS} rounds; residual {best:g}")


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, **options) -> Whitening | None:
    """Fit over all usable rows; None where none has any spread."""
    rows = usable(vectors, vector)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None
    dims = lengths[0]["d"]
    packed = stage(rows.filter(F.size("v") == dims).select("v").mapInArrow(_packed(dims), "x binary"), "vectors")
    passes = Passes(packed, dims)
    passes.centre()
    trace = passes.trace()
    if trace <= 0:
        return None
    values, found, residual = leading(passes, min(components, dims), **options)
    there = values > FLAT * values[0]
    values, found = values[there], found[:, there]
    error = float(np.abs(passes.spread(found / np.sqrt(values)) - np.eye(len(values))).max())
    return Whitening(passes.n, passes.sums, values, found, trace, error, residual, passes.count)


def _deviations(off: np.ndarray) -> pa.Array:
    """Sums of squares, exact; null where one exceeds a long."""
    if not len(off) or float(np.abs(off).max()) < math.sqrt(2**62 / off.shape[1]):
        return pa.array(np.square(off).sum(axis=1), pa.int64())
    sums = (sum(int(e) * int(e) for e in row) for row in off)
    return pa.array([s if s < 2**63 else None for s in sums], pa.int64())


def whiten(vectors: DataFrame, model: Whitening, vector: str = "embedding", carry: list[str] | None = None) -> DataFrame:
    """The carried columns of usable rows with ``deviation`` and ``whitened``, array<double> by component."""
    names = [c for c in (vectors.columns if carry is None else carry) if c not in ("deviation", "whitened")]
    dims, n, sums = model.dims, model.n, model.sums
    project = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off = whole(batch, dims) * n - sums
            made = (off / n) @ project
            ends = np.arange(0, made.size + 1, made.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("own"), _deviations(off), lists], names=["own", "deviation", "whitened"])

    own = F.struct(F.col("own.none").alias("none"), *(F.col("own")[c].alias(c) for c in names)).alias("own")
    rows = usable(vectors, vector).filter(F.size("v") == dims).select(own, "v")
    schema = StructType([*rows.select("own").schema.fields]).add("deviation", "long").add("whitened", ArrayType(DoubleType()))
    made = rows.mapInArrow(run, schema)
    return made.select(*(F.col("own")[c].alias(c) for c in names), "deviation", "whitened")


def by_component(whitened: DataFrame, model: Whitening) -> DataFrame:
    """One row for each row and component, with the figures of the fit."""
    explained = F.array(*(F.lit(float(v)) for v in model.values / model.trace))
    names = [c for c in whitened.columns if c != "whitened"]
    return whitened.select(
        *(f"`{c}`" for c in names), F.posexplode("whitened").alias("place", "whitened"), F.lit(model.n).cast("long").alias("n")
    ).select(
        *(f"`{c}`" for c in names),
        (F.col("place") + 1).alias("component"),
        "n",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
