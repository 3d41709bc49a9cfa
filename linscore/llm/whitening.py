"""Whitening of vectors on their leading principal components, found by FEAST contour integration.

Entries become integers ``floor(64 * entry) + 1000000``. The fit list holds each distinct integer vector once; its sums are
exact integers, and its covariance (divisor n) is summed per task from entries centred before they are multiplied.

The components are eigenvectors of that covariance. Sylvester's law of inertia (signs in an LDL' factorisation of the
matrix minus a shift) counts the eigenvalues above any shift, so bisection finds disjoint intervals that hold all wanted ones, few in
each. Every interval is a task of its own: complex shifted solves at the nodes of a contour around it project a random
block onto its eigenspace, Rayleigh-Ritz extracts the pairs, and this repeats until they are exact. An interval must
give as many as inertia counts in it, so that none is missed; a last Rayleigh-Ritz over all of them makes them orthonormal.

Vectors of one length are whitened among themselves; a matrix of that length squared is all that the driver holds.

Defined cases: a vector that is null, empty or holds null or non-finite entries is left out, and so is one with an entry whose integer
reaches 2**53, as no double tells such integers apart. Repeated rows and ids give rows of their own and count once in the fit
list. A component without variance has a null ``whitened`` and ``explained`` 0 (null if nothing varies at all). ``deviation`` is null
where it exceeds a long. An empty table gives no rows; extra columns are ignored. Equal eigenvalues leave open which
orthonormal vectors of their space are taken.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store
from .vectors import matrices

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
LARGEST = float(1 << 53)
NODES = 8
PER_INTERVAL = 6
ROUNDS = 30
ADDERS = 8


# ---- counting and finding eigenvalues ---------------------------------------------------------


def inertia(matrix: np.ndarray) -> tuple[int, int]:
    """Number of positive and of negative eigenvalues of a symmetric matrix.

    LDL' with pivots of one or two rows, the largest entry left deciding which; a block of two is taken only where it is indefinite.
    """
    a = matrix.copy()
    positive = negative = 0
    bound = (1 + np.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        at = int(diagonal.argmax())
        apart = np.abs(a)
        np.fill_diagonal(apart, -1.0)
        row, column = np.unravel_index(int(apart.argmax()), a.shape)
        if max(diagonal[at], apart[row, column]) == 0.0:
            break
        if diagonal[at] >= bound * apart[row, column]:
            pivot = a[at, at]
            positive, negative = positive + (pivot > 0), negative + (pivot < 0)
            rest = np.delete(np.arange(len(a)), at)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, at], a[at, rest]) / pivot
        else:
            positive, negative = positive + 1, negative + 1
            pair, rest = [row, column], np.delete(np.arange(len(a)), [row, column])
            across = a[np.ix_(rest, pair)]
            a = a[np.ix_(rest, rest)] - across @ np.linalg.solve(a[np.ix_(pair, pair)], across.T)
    return int(positive), int(negative)


def above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues larger than ``shift``."""
    return inertia(matrix - shift * np.eye(len(matrix)))[0]


def eigenvalue_intervals(matrix: np.ndarray, wanted: int, most: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """Disjoint intervals ``(low, high, count)`` from the top that hold at least the ``wanted`` largest eigenvalues.

    An interval has at most ``most`` of them, unless they lie too close together for any shift to part them. Each count is
    the difference of two inertia counts.
    """
    top = float(np.abs(matrix).sum(axis=1).max()) * 1.01
    floor = top * 1e-13
    wanted = min(wanted, above(matrix, floor))
    if not wanted:
        return []
    found: list[tuple[float, float, int]] = []
    # of the parts still open the topmost is looked at first: (low, high, eigenvalues above low, above high)
    open_ = [(floor, top, above(matrix, floor), 0)]
    while open_ and sum(count for *_, count in found) < wanted:
        low, high, over_low, over_high = open_.pop()
        count = over_low - over_high
        if not count:
            continue
        close = high - low <= 1e-9 * high
        if close or (count <= most and (high - low <= 0.5 * high or over_low <= wanted)):
            found.append((low, high, count))
            continue
        middle = _quiet_shift(matrix, low, high)
        over = above(matrix, middle)
        open_ += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return found


def _quiet_shift(matrix: np.ndarray, low: float, high: float) -> float:
    """A shift near the middle with no eigenvalue right beside it, if one of a few has none."""
    width = high - low
    for part in (0.5, 0.43, 0.57, 0.36, 0.64):
        shift = low + part * width
        if above(matrix, shift - 1e-4 * width) == above(matrix, shift + 1e-4 * width):
            break
    return shift


def contour_eigenpairs(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All ``count`` eigenpairs between ``low`` and ``high``: values rising, vectors as columns."""
    size = len(matrix)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi * (nodes + 1) / 2
    centre, radius = (low + high) / 2, (high - low) / 2
    points = centre + radius * np.exp(1j * angles)
    rng = np.random.default_rng(size)
    width = min(size, count + count // 2 + 4)
    block = rng.standard_normal((size, width))
    scale = np.abs(matrix).max()
    best, kept = np.inf, None
    for _ in range(ROUNDS):
        projected = np.zeros((size, block.shape[1]))
        for point, angle, weight in zip(points, angles, weights):
            solved = np.linalg.solve(point * np.eye(size) - matrix, block.astype(complex))
            projected += (radius * weight / 2 * np.exp(1j * angle) * solved).real
        basis, _ = np.linalg.qr(projected)
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ turned
        off = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        inside = np.flatnonzero((values > low) & (values <= high))
        exact = inside[off[inside] <= 1e-11 * scale * np.sqrt(size)]
        if len(exact) == count:
            worst = off[exact].max()
            if worst < best:
                kept = values[exact], vectors[:, exact]
            if worst >= best * 0.5:
                break
            best = worst
        if len(inside) >= count and block.shape[1] < size and len(exact) < count:
            vectors = np.concatenate([vectors, rng.standard_normal((size, min(4, size - vectors.shape[1])))], axis=1)
        block = vectors
    if kept is None:
        raise ArithmeticError(f"{count} eigenvalues are counted between {low} and {high}, but not all were found")
    return kept


def orthonormal_pairs(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz over vectors of all intervals: values falling, orthonormal columns."""
    basis, _ = np.linalg.qr(vectors)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1], (basis @ turned)[:, ::-1]


# ---- sums over the fit list -------------------------------------------------------------------


def _split_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of columns of integers below 2**53 as two parts that no batch can overflow."""
    return (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)


def _sums(batches):
    """Count and exact sums of a task's vectors, by length."""
    total: dict[int, list] = {}
    for batch in batches:
        for rows, x in matrices(batch.column(0)):
            high, low = _split_sums(x)
            sums = [(h << 26) + v for h, v in zip(high.tolist(), low.tolist())]
            known = total.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            known[0] += len(rows)
            known[1] = [a + b for a, b in zip(known[1], sums)]
    # as text: sums of many large entries are longer than a long
    found = [(size, n, " ".join(map(str, sums))) for size, (n, sums) in total.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["size", "n", "sums"]
    )


def _sums_added(batches):
    total: dict[int, list] = {}
    for batch in batches:
        for size, n, sums in zip(*(c.to_pylist() for c in batch.columns)):
            known = total.setdefault(size, [0, [0] * size])
            known[0] += n
            known[1] = [a + int(b) for a, b in zip(known[1], sums.split(" "))]
    found = [(size, n, " ".join(map(str, sums))) for size, (n, sums) in total.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["size", "n", "sums"]
    )


@dataclass
class Whitening:
    """What whitens vectors of one length: count, exact sums, components as columns, eigenvalues, trace, and the error measured."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float = 0.0
    error: float = 0.0

    def __post_init__(self):
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n`` with one rounding: the whole part of the mean goes as integers."""
        return (x - self.base) - self.rest / self.n

    def projected(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of ``(n * x - S)**2``, exact; None beyond a long."""
        y = x - self.base
        widest = float(np.abs(y).max(initial=0) + 1) * self.n
        if widest**2 * x.shape[1] < 2.0**62:
            return ((y * self.n - self.rest) ** 2).sum(axis=1).tolist()
        rest = self.rest.tolist()
        exact = (sum((v * self.n - r) ** 2 for v, r in zip(row, rest)) for row in y.tolist())
        return [v if v < 1 << 63 else None for v in exact]


def _products(models: dict[int, Whitening], values):
    """Per length the sum of products of ``values(model, x)``, and its own sum as a last row."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                v = values(models[x.shape[1]], x)
                sums = np.concatenate([v.T @ v, v.sum(axis=0)[None, :]])
                total[x.shape[1]] = total.get(x.shape[1], 0) + sums
        yield _sized(total)

    return run


def _sized(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"size": pa.array(list(total), pa.int64()), "sums": pa.array([v.tobytes() for v in total.values()], pa.binary())}
    )


def _products_added(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
            total[size] = total.get(size, 0) + np.frombuffer(sums.as_py())
    yield _sized(total)


def _summed_products(fit: DataFrame, models: dict[int, Whitening], values) -> dict[int, np.ndarray]:
    kind = "size bigint, sums binary"
    parts = fit.mapInArrow(_products(models, values), kind).repartition(ADDERS).mapInArrow(_products_added, kind)
    total: dict[int, np.ndarray] = {}
    for row in parts.collect():  # a matrix per length and adder
        total[row["size"]] = total.get(row["size"], 0) + np.frombuffer(row["sums"])
    return {size: sums.reshape(-1, _width(sums)) for size, sums in total.items()}


def _width(sums: np.ndarray) -> int:
    """w of the w * (w + 1) numbers in ``sums``."""
    return int((np.sqrt(4 * sums.size + 1) - 1) / 2 + 0.5)


def _components_of(fit: DataFrame, covariances: dict[int, np.ndarray], wanted: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Leading eigenpairs of each matrix; every interval's contour is a task."""
    spark = fit.sparkSession
    intervals = [
        (size, *interval)
        for size, matrix in covariances.items()
        for interval in eigenvalue_intervals(matrix, min(wanted, size))
    ]
    found: dict[int, list[np.ndarray]] = {size: [] for size in covariances}
    if intervals:
        shared = spark.sparkContext.broadcast(covariances)

        def solve(batches):
            for batch in batches:
                for size, low, high, count in zip(*(c.to_pylist() for c in batch.columns)):
                    _, vectors = contour_eigenpairs(shared.value[size], low, high, count)
                    yield _sized({size: vectors})

        table = spark.createDataFrame(intervals, "size bigint, low double, high double, count int")
        solved = table.repartition(min(len(intervals), 1_000)).mapInArrow(solve, "size bigint, sums binary")
        for row in solved.collect():  # some more than the wanted components
            found[row["size"]].append(np.frombuffer(row["sums"]).reshape(row["size"], -1))
        shared.destroy()
    pairs = {}
    for size, matrix in covariances.items():
        k = min(wanted, size)
        values, vectors = np.zeros(k), np.full((size, k), np.nan)
        if found[size]:
            v, u = orthonormal_pairs(matrix, np.concatenate(found[size], axis=1))
            values[: len(v)], vectors[:, : len(v)] = v[:k], u[:, :k]
        pairs[size] = values, vectors
    return pairs


def fitted(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each length of vector; ``fit`` has distinct vectors ``x`` (array of longs)."""
    kind = "size bigint, n bigint, sums string"
    added = fit.mapInArrow(_sums, kind).repartition(ADDERS).mapInArrow(_sums_added, kind).collect()  # a row per length and adder
    models: dict[int, Whitening] = {}
    for size in {r["size"] for r in added}:
        rows = [(r["n"], [int(s) for s in r["sums"].split(" ")]) for r in added if r["size"] == size]
        sums = [sum(column) for column in zip(*(s for _, s in rows))]
        models[size] = Whitening(sum(n for n, _ in rows), sums, np.zeros((size, 0)), np.zeros(0))
    if not models:
        return models
    products = _summed_products(fit, models, Whitening.centred)
    covariances = {}
    for size, model in models.items():
        matrix = products[size][:-1] / model.n
        covariances[size] = (matrix + matrix.T) / 2
        model.trace = float(np.trace(covariances[size]))
    for size, (values, vectors) in _components_of(fit, covariances, components).items():
        models[size].values, models[size].components = values, vectors
    for size, sums in _summed_products(fit, models, Whitening.projected).items():
        n = models[size].n
        mean = sums[-1] / n
        off = np.abs(sums[:-1] / n - np.outer(mean, mean) - np.eye(len(mean)))
        models[size].error = float(np.nanmax(off)) if np.isfinite(off).any() else 0.0
    return models


def integer_vectors(vectors: DataFrame, ident: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, x``: usable vectors as integers."""
    entry = F.col(column)
    number = lambda c: F.floor(c.cast("double") * SCALE)
    good = F.forall(
        entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit((LARGEST - SHIFT) / SCALE))
    )
    return vectors.where(F.coalesce(good & (F.size(entry) > 0), F.lit(False))).select(
        F.col(ident).cast("bigint").alias("vec_id"), F.transform(entry, lambda c: number(c) + F.lit(SHIFT)).cast("array<bigint>").alias("x")
    )


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    store = Store(vectors.sparkSession, "whitening")
    rows = store.write("rows", integer_vectors(vectors))
    models = fitted(store.write("fit", rows.select("x").distinct()), components)
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            for at, x in matrices(batch.column(1)):
                model = shared.value[x.shape[1]]
                k, count = len(model.values), len(at)
                each = lambda value, kind: pa.array(np.tile(value, count), kind)
                flat = model.projected(x).ravel()
                share = np.divide(model.values, model.trace, where=model.trace > 0, out=np.full(k, np.nan))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(at, k))),
                        each(np.arange(1, k + 1), pa.int32()),
                        pa.array(np.full(count * k, model.n)),
                        pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(count), k))),
                        pa.array(flat, mask=~np.isfinite(flat)),
                        pa.array(np.tile(share, count), mask=np.tile(np.isnan(share), count)),
                        pa.array(np.full(count * k, model.error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(
        run,
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    )
