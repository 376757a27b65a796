"""Embedding whitening by spectrum slicing: inertia counts of LDL^T factors of the
shifted covariance isolate each leading eigenvalue, Rayleigh quotient iteration
finds it, and the counts certify its number. The covariance is exact: Spark sums
integer products of centred integers, the driver sees size x size numbers."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, slices, store

#: Factor of the integer grid, and the number of leading components.
SCALE, COMPONENTS = 256, 4
#: Largest integer component.
LIMIT = 1 << 40
#: Rows handled at once in a Python worker.
ROWS = 4096
_ALPHA = (1 + 17 ** 0.5) / 8


# --- spectrum slicing of a symmetric matrix ---------------------------------

def above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``: by Sylvester's law the positive
    pivots of LDL^T of the shifted matrix, with complete (1x1 or 2x2) pivoting."""
    m = a - shift * np.eye(len(a))
    count = 0
    while len(m):
        d, off = np.abs(np.diag(m)), np.abs(m - np.diag(np.diag(m)))
        r = int(d.argmax())
        p, q = divmod(int(off.argmax()), len(m))
        if not max(d[r], off[p, q]):
            break
        if d[r] >= _ALPHA * off[p, q]:
            block = [r]
            count += int(m[r, r] > 0)
        else:  # such a 2x2 pivot has one eigenvalue of either sign
            block = [p, q]
            count += 1
        rest = np.setdiff1d(np.arange(len(m)), block)
        side = m[np.ix_(rest, block)]
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(m[np.ix_(block, block)], side.T)
        m = (m + m.T) / 2
    return count


def isolate(a: np.ndarray, number: int, low: float, high: float, tiny: float) -> tuple[float, float, bool]:
    """(low, high] that holds the eigenvalue with that number (1: largest), and
    whether it holds no other: bisection on the counts, down to ``tiny``."""
    over, under = 0, len(a)
    while not (over == number - 1 and under == number) and high - low > tiny:
        mid = (low + high) / 2
        c = above(a, mid)
        if c >= number:
            low, under = mid, c
        else:
            high, over = mid, c
    return low, high, over == number - 1 and under == number


def leading(a: np.ndarray, components: int) -> list[tuple[float, np.ndarray]]:
    """The ``components`` largest positive eigenvalues with unit eigenvectors, in
    falling order. An eigenvalue that is zero to rounding, or below, ends the list.
    Equal eigenvalues get orthogonal vectors of their space."""
    size = len(a)
    scale = float(np.abs(a).sum(1).max()) if size else 0.0  # Gershgorin bound of the largest
    tiny = scale * size * np.finfo(float).eps
    found: list[tuple[float, np.ndarray]] = []
    for number in range(1, min(components, size) + 1):
        low, high, alone = isolate(a, number, -scale - tiny, scale + tiny, 2 * tiny)
        if high <= 4 * tiny:
            break
        while True:
            value, v, good = rayleigh(a, low, high, [x for _, x in found], tiny)
            ranked = not alone or above(a, value + 8 * tiny) < number <= above(a, value - 8 * tiny)
            if good and ranked or high - low <= 2 * tiny:
                break
            mid = (low + high) / 2  # it went to another eigenvalue: a narrower interval
            low, high = (mid, high) if above(a, mid) >= number else (low, mid)
        if value <= 4 * tiny:
            break
        if alone and not above(a, value + 8 * tiny) < number <= above(a, value - 8 * tiny):
            raise ArithmeticError(f"eigenvalue {number} is not certified by its inertia counts")
        found.append((value, v))
    return found


def rayleigh(a: np.ndarray, low: float, high: float, before: list[np.ndarray], tiny: float) -> tuple[float, np.ndarray, bool]:
    """Rayleigh quotient iteration from the middle of the interval, orthogonal to
    the vectors found before; good if it settled inside the interval."""
    size, shift = len(a), (low + high) / 2

    def unit(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for x in before:
                v = v - (x @ v) * x
        size = np.linalg.norm(v)
        return v / size if size else v

    def solved(shift: float, v: np.ndarray) -> np.ndarray:
        for nudge in (0.0, tiny, 2 * tiny):
            try:
                w = np.linalg.solve(a - (shift + nudge) * np.eye(size), v)
            except np.linalg.LinAlgError:
                continue  # exactly an eigenvalue: a shift beside it gives the vector
            if np.isfinite(w).all() and w.any():
                return w
        return v

    v = unit(np.random.default_rng(size).standard_normal(size))
    for _ in range(4):  # inverse iteration with a fixed shift turns v to the interval's eigenvector
        v = unit(solved(shift, v))
    value, least, best = float(v @ a @ v), np.inf, v
    for _ in range(30):
        v = unit(solved(value, v))
        value = float(v @ a @ v)
        rest = float(np.linalg.norm(a @ v - value * v))
        if rest >= least:
            break
        least, best = rest, v
    value = float(best @ a @ best)
    return value, best, low - 2 * tiny <= value <= high + 2 * tiny


# --- exact moments ----------------------------------------------------------

def _matrix(column: pa.Array, size: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)
    if len(x) and (x.max() > LIMIT or x.min() < -LIMIT):
        raise ValueError(f"a component is beyond {LIMIT}")
    return x


def _products(y: np.ndarray) -> np.ndarray:
    """Exact y'y as Python or NumPy integers: in floating point while all sums stay
    below 2**53, else by two halves of the bits, else in Python integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top * max(len(y), 1) < 1 << 53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64)
    o = y.astype(object)
    return o.T @ o


def sums(size: int):
    def run(batches):
        n, s = 0, np.zeros(size, object)
        for b in slices(batches, ROWS):
            x = _matrix(b.column("x"), size)
            n, s = n + len(x), s + x.sum(0)
        yield pa.record_batch([pa.array([*range(size), size], pa.int32()), _decimals([*s, n])], ["k", "s"])
    return run


def centred_products(size: int, centre: np.ndarray):
    """Sums and products of y = x - centre; centre is the mean, rounded, so that
    the products are those of centred numbers but for an exact remainder."""
    def run(batches):
        total = np.zeros((size + 1, size), object)
        for b in slices(batches, ROWS):
            y = _matrix(b.column("x"), size) - centre
            total[:size] += _products(y)
            total[size] += y.sum(0)
        yield pa.record_batch([pa.array(range((size + 1) * size), pa.int32()), _decimals(total.ravel())], ["k", "s"])
    return run


def _decimals(values) -> pa.Array:
    return pa.array([str(int(v)) for v in values], pa.string())


def _summed(parts: DataFrame) -> dict[int, int]:
    """The parts' exact totals, a bounded number of them."""
    return {r["k"]: int(r["s"]) for r in parts.groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}


def covariance(fit: DataFrame, size: int) -> tuple[int, list[int], np.ndarray]:
    """n, the exact sums, and the covariance (divisor n) rounded once, from exact
    integers: it doesn't depend on partitions or on the order of rows."""
    kind = "k int, s string"
    got = _summed(fit.mapInArrow(sums(size), kind))
    n = got.get(size, 0)
    s = [got.get(k, 0) for k in range(size)]
    if not n:
        return 0, s, np.zeros((size, size))
    centre = [(2 * v + n) // (2 * n) for v in s]
    got = _summed(fit.mapInArrow(centred_products(size, np.array(centre, np.int64)), kind))
    y = [got[size * size + k] for k in range(size)]
    v = np.array([[float(Fraction(n * got[i * size + j] - y[i] * y[j], n * n)) for j in range(size)] for i in range(size)])
    return n, s, v


# --- the operator -----------------------------------------------------------

def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n*x - S, exact."""
    safe = n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, s)) < 1 << 62
    return n * x - np.array(s, np.int64) if safe else n * x.astype(object) - np.array(s, object)


def _whitened(x: np.ndarray, n: int, s: list[int], vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (_centred(x, n, s).astype(float) / n) @ vectors / np.sqrt(values)


def whitened_products(size: int, n: int, s: list[int], vectors: np.ndarray, values: np.ndarray):
    def run(batches):
        k = len(values)
        total = np.zeros((k, k))
        for b in slices(batches, ROWS):
            w = _whitened(_matrix(b.column("x"), size), n, s, vectors, values)
            total += w.T @ w
        yield pa.record_batch([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], ["k", "s"])
    return run


def whiten_rows(size: int, n: int, s: list[int], vectors: np.ndarray, values: np.ndarray):
    def run(batches):
        k = len(values)
        for b in slices(batches, ROWS):
            x = _matrix(b.column("x"), size)
            w, d = _whitened(x, n, s, vectors, values), _centred(x, n, s)
            if d.dtype != object and float(np.abs(d).max(initial=0)) ** 2 * size < 2.0 ** 62:
                deviation = (d * d).sum(1).tolist()
            else:
                deviation = [v if v < 1 << 63 else None for v in (d.astype(object) ** 2).sum(1)]
            yield pa.record_batch([b.column("vec_id"), pa.array(deviation, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], ["vec_id", "deviation", "w"])
    return run


def grid(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, x): the rows without null or non-finite entries on the integer grid."""
    v = F.col(f"`{vec_col}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return (vectors.where(v.isNotNull() & finite)
            .select(F.col(f"`{id_col}`").alias("vec_id"), F.transform(v, lambda c: F.floor(c.cast("double") * scale)).alias("x")))


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of
    every remaining row and component, with the eigenvalues and (as columns) the
    eigenvectors.

    Rows whose vector is null or holds a null or non-finite entry go; so do
    vectors of another length than the commonest (ties: the longest), which have
    no covariance with the others, and empty ones. The fit list holds each distinct
    vector once. Null and repeated ids and repeated rows stay, row by row; other
    columns are ignored. A component without variance (to rounding) can't be
    whitened and gives no row: none at all for an empty table or one distinct
    vector. A deviation beyond a long is null; a component beyond ``LIMIT`` on the
    grid raises an error."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = store(grid(vectors, id_col, vec_col, scale), "grid")
    kind = rows.schema["vec_id"].dataType.simpleString()
    none = spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    lengths = rows.where(F.size("x") > 0).groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return none, np.zeros(0), np.zeros((0, 0))
    size = lengths["size"]
    rows = rows.where(F.size("x") == size)
    fit = store(rows.select("x").distinct(), "fit")  # equal vectors meet in the task first: a hot one moves once a task
    n, s, v = covariance(fit, size)
    found = leading(v, components)
    if not found:
        return none, np.zeros(0), np.zeros((size, 0))
    values, vecs = np.array([e for e, _ in found]), np.column_stack([x for _, x in found])
    error = fit.mapInArrow(whitened_products(size, n, s, vecs, values), "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    k = len(values)
    worst = max(abs(r["s"] / n - (r["k"] // k == r["k"] % k)) for r in error)
    explained = F.array(*(F.lit(float(e / np.trace(v))) for e in values))
    out = rows.mapInArrow(whiten_rows(size, n, s, vecs, values), f"vec_id {kind}, deviation long, w array<double>")
    out = out.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(explained, F.col("at")).alias("explained"), F.lit(float(worst)).alias("identity_error")), values, vecs
