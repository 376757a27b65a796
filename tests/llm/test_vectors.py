"""Centroid clustering and whitening of vectors against brute force."""

import hashlib
import math

import numpy as np
import pytest

from peerguard.llm import simplex_clusters as sc
from peerguard.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, x string, cluster string, n int, w int, _at int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "c", 2, 3, 4) for i, v in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def rows(spark):
    got = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()]
    z = [0.0] * 64
    dirty = [(9001, None), (9002, []), (9003, z[:63]), (9004, [*z[:63], None]), (9005, [*z[:63], float("nan")]), (9006, [*z[:63], float("-inf")]),
             (9007, z), (9007, z), (9008, got[0][1]), (None, got[1][1]), (None, None), (9010, [-1e-9, *z[1:]]), (9011, [100.0, *z[1:]])]
    hot = [(9100 + k, got[5][1]) for k in range(250)]  # a third of all rows are one vector
    return got + dirty + hot


def clean(rows, scale, size=64):
    return [(i, [math.floor(float(np.float32(c)) * scale) for c in v]) for i, v in rows
            if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]


def lloyd(rows, k=16, rounds=3):
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    at = [v for _, v in order[:k]]

    def best(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in at]
        return min(range(len(d)), key=lambda j: (d[j], j)), min(d)
    for _ in range(rounds):
        own = [best(v)[0] for _, v in rows]
        for j in range(len(at)):
            mine = [v for (_, v), o in zip(rows, own) if o == j]
            if mine:
                at[j] = [sum(c) // len(mine) for c in zip(*mine)]
    return [best(v) for _, v in rows], at


def check_clusters(spark, rows):
    kept = clean(rows, 64)
    want, at = lloyd(kept)
    inertia = sum(d for _, d in want)
    own = {j: sum(d for o, d in want if o == j) for j, _ in want}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    df, final = sc.simplex_clusters(table(spark, rows))
    got = [tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()]
    assert sorted(got, key=str) == sorted(((i, j, d, own[j], inertia, sha[j]) for (i, _), (j, d) in zip(kept, want)), key=str)
    assert final.tolist() == at


def test_clusters_equal_brute_force(spark, rows):
    check_clusters(spark, rows)


def test_clusters_of_few_and_equal_rows(spark):
    assert sc.simplex_clusters(table(spark, []))[0].count() == 0
    check_clusters(spark, [(1, [0.5] * 64), (1, [0.5] * 64), (1, [0.25] * 64), (2, [0.5] * 64), (None, [1.0] * 64)])
    with pytest.raises(Exception, match="would not fit"):
        sc.simplex_clusters(table(spark, [(1, [3e30] * 64)]))


def test_simplex_bounds_hold():
    """Lower and upper bounds enclose the exact distance; the nearest centroid is never filtered."""
    rng = np.random.default_rng(3)
    for spread, size in ((3, 64), (1000, 64), (1 << 26, 64), (50, 5)):
        pivots = rng.integers(-spread, spread + 1, (16, size))
        pivots[3], pivots[5] = pivots[2], pivots[0] + pivots[1]
        x, c = rng.integers(-spread, spread + 1, (400, size)), rng.integers(-spread, spread + 1, (12, size))
        x[:12] = c  # distance 0
        s = sc.Simplex(pivots)
        assert 2 <= len(s.pivots) <= 16
        a, t = s.apex(sc.squared(x, s.pivots)), s.apex(sc.squared(c, s.pivots))
        d2 = sc.squared(x, c).astype(float)
        low = ((a[:, None] - t) ** 2).sum(2)
        high = low + 4 * a[:, -1:] * t[:, -1]
        slack = s.slack * ((a ** 2).sum(1)[:, None] + (t ** 2).sum(1).max())
        assert (low <= d2 + slack).all() and (d2 <= high + slack).all()
        at, d, many = sc.nearest(s, x, a, c)
        assert (at == d2.argmin(1)).all() and (d == d2.min(1)).all()


def test_simplex_filters_centroids(spark):
    """Where clusters are apart the bounds leave few centroids to compare."""
    rng = np.random.default_rng(4)
    mid = rng.normal(size=(16, 64))
    rows = [(i, (mid[i % 16] + rng.normal(scale=0.02, size=64)).tolist()) for i in range(800)]
    df, _ = sc.simplex_clusters(table(spark, rows))
    assert df.agg({"compared": "avg"}).first()[0] < 4
    check_clusters(spark, rows)


# --- whitening ----------------------------------------------------------------

def test_slicing_finds_leading_eigenvalues():
    rng = np.random.default_rng(1)
    for values in (np.arange(1, 21.), np.r_[np.ones(5) * 7, np.arange(6.)], np.r_[5, 5 - 1e-9, 5 - 2e-9, rng.random(30)], np.r_[3.0, np.zeros(9)],
                   10.0 ** -np.arange(12), np.array([2.0]), np.zeros(4), np.r_[1e12, 1e-3, 1e-3, 0]):
        q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        true = np.sort(np.linalg.eigvalsh(a))[::-1]
        for shift in (*(true[:-1] + true[1:])[np.abs(np.diff(true)) > 1e-6 * true[0]] / 2, true[0] + 1, true[-1] - 1):
            assert wh.above(a, shift) == (true > shift).sum()
        found = wh.leading(a, 4)
        tiny = 1e-13 * max(true[0], 0) * len(true)
        assert len(found) == min(4, (true > 4 * len(a) * np.finfo(float).eps * np.abs(a).sum(1).max()).sum()), values
        for (e, v), t in zip(found, true):
            assert abs(e - t) <= tiny and np.linalg.norm(a @ v - e * v) <= 10 * tiny + 1e-300
        w = np.column_stack([v for _, v in found]) if found else np.zeros((len(a), 0))
        assert np.allclose(w.T @ w, np.eye(len(found)), atol=1e-7)


def check_whitening(spark, rows, size=64):
    kept = clean(rows, 256, size)
    fit = np.array(sorted({tuple(v) for _, v in kept}), dtype=object)
    n, s = len(fit), fit.sum(0)
    y = (n * fit - s).astype(float) / n
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    df, values, vecs = wh.whiten(table(spark, rows))
    assert np.allclose(values, e[:4], rtol=1e-12) and np.allclose(np.abs((vecs * q[:, :4]).sum(0)), 1, atol=1e-9)
    got = [(str(r.vec_id), r.component, r.deviation, round(abs(r.whitened), 8)) for r in df.collect()]
    want = []
    for i, x in kept:
        d = n * np.array(x, object) - s
        for k in range(4):
            total = int((d * d).sum())
            want.append((str(i), k + 1, total if total < 1 << 63 else None, round(abs(float((d / n).astype(float) @ q[:, k]) / math.sqrt(e[k])), 8)))
    want.sort(key=lambda w: (w[:2], w[2] or 0, w[3]))
    got.sort(key=lambda w: (w[:2], w[2] or 0, w[3]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-6)
    one = df.groupBy("component").agg({"explained": "max", "identity_error": "max", "n": "max"}).collect()
    assert {r["max(n)"] for r in one} == {n} and max(r["max(identity_error)"] for r in one) < 1e-9
    assert all(abs(r["max(explained)"] - e[r.component - 1] / e.sum()) < 1e-12 for r in one)


def test_whitening_equals_brute_force(spark, rows):
    check_whitening(spark, rows)


def test_whitening_of_large_numbers(spark):
    """Products beyond 53 bits stay exact; a deviation beyond a long is null."""
    rng = np.random.default_rng(8)
    x = rng.normal(scale=1e5, size=(60, 64)) * np.linspace(1, 2, 64)
    check_whitening(spark, [(i, v.tolist()) for i, v in enumerate(x)])


def test_whitening_without_variance(spark):
    assert wh.whiten(table(spark, []))[0].count() == 0
    assert wh.whiten(table(spark, [(1, None), (2, [])]))[0].count() == 0
    assert wh.whiten(table(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])]))[0].count() == 0
    df, values, _ = wh.whiten(table(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0]), (None, [0.0, 1.0]), (5, [1.0])]))
    assert len(values) == 1 and df.count() == 4  # one direction varies; another length goes
    assert [round(abs(r.whitened), 12) for r in df.collect()] == [1.0] * 4
