"""Embedding whitening from the exact characteristic polynomial of the integer scatter.

1. Every entry c becomes the integer floor(64 c) + 1000000. Tasks add up the vectors'
   integer sums and products exactly; with n vectors and sums S, n * (sum of x x') - S S' is n^2
   times the covariance and an integer matrix.
2. Its characteristic polynomial is computed modulo many primes, a few to a task, by
   reduction to Hessenberg form, and put together by Chinese remaindering.
3. The largest roots are isolated to 128 bits (``charpoly.largest_roots``).
4. Their unit eigenvectors come from inverse iteration on the matrix less the root, a root to a task.
5. Rows are projected; a pass over all of them measures how far the covariance is from the identity.

Only sums, d x d matrices and the components reach the driver, and partial sums are merged in
MERGERS tasks before they do. Steps 2 to 4 depend on d alone, with some d^4 word operations.

Defined results: rows whose vector is null, empty, or holds a null, NaN or infinite entry take no
part. Vectors of another length than most (ties: the longer) take no part. Entries beyond
2^62 in size after scaling count as 2^62. Components with eigenvalue 0 cannot be whitened and give no rows, so one vector
or equal vectors give none. Equal eigenvalues get an orthonormal basis of their space. A
``deviation`` beyond a long is null. Repeated rows count, and give rows, each; a null id is carried
through; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.llm import charpoly

SCALE, OFFSET = 64, 1_000_000      # fixed by the contract
COMPONENTS = 32
MERGERS = 16
_PRIMES_PER_TASK = 8
_LIMIT = float(2**62)
_ROWS = 1 << 12                    # vectors handled at once


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer vectors (without the offset) of the usable rows, by length of the vectors.

    The columns of ``batch`` are the id and the vector.
    """
    for at in range(0, len(batch), _ROWS):
        ids, lists = batch.column(0).slice(at, _ROWS), batch.column(1).slice(at, _ROWS)
        lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        bad = np.append(0, np.cumsum(~np.isfinite(flat)))
        whole = (lengths > 0) & (bad[starts + lengths] == bad[starts])
        for d in np.unique(lengths[whole]):
            rows = np.flatnonzero(whole & (lengths == d))
            with np.errstate(over="ignore"):
                y = np.clip(np.floor(SCALE * flat[starts[rows, None] + np.arange(d)]), -_LIMIT, _LIMIT).astype(np.int64)
            yield ids.take(pa.array(rows)), y


def exact_gram(y: np.ndarray) -> np.ndarray:
    """y' y in Python integers; each product of doubles below is exact, as its sums stay under 2^53."""
    top = max(1, int(np.abs(y).max(initial=0)))
    if top * top * len(y) < 2**53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    limbs, rest = [], y
    while np.abs(rest).max() >= 1 << 20:
        low = (rest & ((1 << 20) - 1)).astype(float)
        limbs.append(low)
        rest = rest >> 20
    limbs.append(rest.astype(float))
    total = np.zeros((y.shape[1],) * 2, object)
    for i, a in enumerate(limbs):
        for k, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << 20 * (i + k)
    return total


def _merged(parts: DataFrame, merge: Callable[[list], object], start: Callable[[], object]) -> object:
    """Fold the JSON rows of ``parts`` in MERGERS tasks, then their few results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = start()
        for b in batches:
            for row in b.column(0):
                total = merge(total, json.loads(row.as_py()))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(total)])], ["part"])

    total = start()
    for row in parts.repartition(MERGERS).mapInArrow(run, "part string").collect():
        total = merge(total, json.loads(row.part))
    return total


def _add_scatter(total: dict, part: dict) -> dict:
    for d, (n, sums, gram) in part.items():
        old = total.get(d)
        total[d] = [n, sums, gram] if old is None else [
            old[0] + n, [a + b for a, b in zip(old[1], sums)], [a + b for a, b in zip(old[2], gram)]]
    return total


def scatter(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray] | None:
    """(n, sums, products) of the (id, vector) rows, exact, without the offset; None without a usable vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for b in batches:
            for _, y in _vectors(b):
                d = y.shape[1]
                n, sums, gram = total.get(d, (0, 0, 0))
                total[d] = n + len(y), sums + y.astype(object).sum(axis=0), gram + exact_gram(y)
        part = {str(d): [n, list(sums), list(gram[np.triu_indices(d)])] for d, (n, sums, gram) in total.items()}
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(part)])], ["part"])

    total = _merged(rows.mapInArrow(run, "part string"), _add_scatter, dict)
    if not total:
        return None
    d = max(total, key=lambda k: (total[k][0], int(k)))
    n, sums, upper = total[d]
    gram = np.zeros((int(d),) * 2, object)
    gram[np.triu_indices(int(d))] = upper
    gram = np.triu(gram) + np.triu(gram, 1).T
    return n, np.array(sums, object), gram


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(x - matrix), constant term first; Spark deals the primes to tasks."""
    primes = charpoly.enough_primes(matrix)
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = b.column(0).to_pylist()
            for i in range(0, len(some), _PRIMES_PER_TASK):
                few = some[i:i + _PRIMES_PER_TASK]
                found = charpoly.modular_polynomials(shared.value, few)
                yield pa.RecordBatch.from_arrays([pa.array(few, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))],
                                                 ["prime", "residues"])

    dealt = spark.createDataFrame([(q,) for q in primes], "prime bigint").repartition(-(-len(primes) // _PRIMES_PER_TASK))
    got = dealt.mapInArrow(run, "prime bigint, residues array<bigint>").collect()
    return charpoly.remaindered(np.array([r.residues for r in got], object), [r.prime for r in got])


def components(spark: SparkSession, matrix: np.ndarray, count: int = COMPONENTS) -> list[tuple[Fraction, np.ndarray]]:
    """(eigenvalue, unit eigenvector) of the ``count`` largest positive eigenvalues, falling."""
    roots = charpoly.largest_roots(characteristic_polynomial(spark, matrix), count)
    if not roots:
        return []
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, num, den, m in zip(*(c.to_pylist() for c in b.columns)):
                v = charpoly.null_vectors(shared.value, Fraction(int(num), int(den)), m)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([v.tolist()], pa.list_(pa.list_(pa.float64())))],
                                                 ["k", "vectors"])

    dealt = spark.createDataFrame([(k, str(r.numerator), str(r.denominator), m) for k, (r, m) in enumerate(roots)],
                                  "k bigint, num string, den string, m bigint").repartition(len(roots))
    found = {r.k: r.vectors for r in dealt.mapInArrow(run, "k bigint, vectors array<array<double>>").collect()}
    return [(roots[k][0], np.array(v)) for k in range(len(roots)) for v in found[k]][:count]


class Whitener:
    """The fitted projection: eigenvalues and components of n^2 times the covariance."""

    def __init__(self, n: int, sums: np.ndarray, trace: int, found: list[tuple[Fraction, np.ndarray]]):
        self.n, self.sums = n, sums
        values = [value for value, _ in found]
        self.explained = np.array([float(v / trace) for v in values])
        self.scales = np.array([float(v / n**2) for v in values]) ** 0.5
        self.axes = np.array([v for _, v in found])

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit integers where they fit, else Python's."""
        top = self.n * int(np.abs(y).max(initial=0)) + max(abs(int(s)) for s in self.sums)
        if top * top * len(self.sums) < 2**63:
            return self.n * y - self.sums.astype(np.int64)
        return self.n * y.astype(object) - self.sums

    def whiten(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(float) / self.n) @ self.axes.T / self.scales


def fit(rows: DataFrame, count: int = COMPONENTS) -> Whitener | None:
    """Fit on all usable (id, vector) rows; None where no component has a positive eigenvalue."""
    found = scatter(rows)
    if found is None:
        return None
    n, sums, gram = found
    matrix = n * gram - np.outer(sums, sums)
    trace = int(sum(matrix[i, i] for i in range(len(matrix))))
    if trace == 0:
        return None
    return Whitener(n, sums, trace, components(rows.sparkSession, matrix, count))


def _add_moments(total: list, part: list) -> list:
    """Merge (n, mean, centred products) of two parts."""
    if not total or not part:
        return total or part
    (n, mean, products), (m, other, more) = ((x[0], np.array(x[1]), np.array(x[2])) for x in (total, part))
    step = other - mean
    products = products + more + np.outer(step, step) * (n * m / (n + m))
    return [n + m, (mean + step * (m / (n + m))).tolist(), products.tolist()]


def identity_error(rows: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance (divisor n) less the identity."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list = []
        for b in batches:
            for _, y in _vectors(b):
                if y.shape[1] == len(shared.value.sums):
                    w = shared.value.whiten(shared.value.deviations(y))
                    mean = w.mean(axis=0)
                    total = _add_moments(total, [len(w), mean.tolist(), ((w - mean).T @ (w - mean)).tolist()])
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(total)])], ["part"])

    n, _, products = _merged(rows.mapInArrow(run, "part string"), _add_moments, list)
    return float(np.abs(np.array(products) / n - np.eye(len(products))).max())


def whiten(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per usable vector and component."""
    rows = table.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    model = fit(rows, count)
    kind = rows.schema["vec_id"].dataType.simpleString()
    made = f"vec_id {kind}, component int, deviation bigint, whitened double, explained double"
    order = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None:
        none = rows.sparkSession.createDataFrame([], made)
        return none.select("*", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("identity_error")).select(*order)
    error = identity_error(rows, model)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.axes)
        for b in batches:
            for ids, y in _vectors(b):
                if y.shape[1] != len(m.sums):
                    continue
                z = m.deviations(y)
                squares = [v if v < 2**63 else None for v in (z * z).sum(axis=1).tolist()]
                each = np.repeat(np.arange(len(y)), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                     pa.array(squares, pa.int64()).take(pa.array(each)), pa.array(m.whiten(z).ravel()),
                     pa.array(np.tile(m.explained, len(y)))],
                    ["vec_id", "component", "deviation", "whitened", "explained"])

    return rows.mapInArrow(run, made).select(
        "*", F.lit(model.n).cast("long").alias("n"), F.lit(error).alias("identity_error")).select(*order)
