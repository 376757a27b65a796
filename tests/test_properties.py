"""Property checks on operators over the driver tables and random data."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from peerguard.operators import features as feat
from peerguard.operators import ml
from peerguard.operators.cumulative import exact_quantiles, running_totals
from peerguard.sources.adapters import claims_from_tpch


def test_features_keep_rows_and_ranges(spark):
    claims = feat.prepare_claims(claims_from_tpch(spark, SF001))
    n = claims.count()
    f = feat.compute_all_features(claims, prepared=True)
    s = f.agg(F.count(F.lit(1)).alias("n"), F.min("code_severity_percentile").alias("lo"),
              F.max("code_severity_percentile").alias("hi"), F.count_distinct("claim_id").alias("ids")).first()
    assert s.n == n == s.ids
    assert 0.0 <= s.lo <= s.hi <= 1.0


def test_running_totals_exact(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(size=5000).round(3)
    df = spark.createDataFrame([(float(v), 1) for v in vals], "x double, c long").groupBy("x").agg(F.sum("c").alias("c"))
    got = {r.x: r.c_cum for r in running_totals(df, "x", ["c"], window_rows=5, fan=16).collect()}
    u, cnt = np.unique(vals, return_counts=True)
    exp = dict(zip(u.tolist(), np.cumsum(cnt).tolist()))
    assert got == exp
    got_d = {r.x: r.c_cum for r in running_totals(df, "x", ["c"], descending=True, window_rows=5, fan=16).collect()}
    exp_d = dict(zip(u.tolist(), np.cumsum(cnt[::-1])[::-1].tolist()))
    assert got_d == exp_d


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    vals = rng.exponential(size=2001).round(4)
    df = spark.createDataFrame([(float(v), "a" if i % 3 else "b") for i, v in enumerate(vals)], "v double, g string")
    got = {r.q: r.value for r in exact_quantiles(df, "v", [0.25, 0.5, 0.9]).collect()}
    for q, v in got.items():
        assert abs(v - np.percentile(vals, q * 100)) < 1e-9
    grp = {(r.g, r.q): r.value for r in exact_quantiles(df, "v", [0.95], ["g"]).collect()}
    a = np.array([v for i, v in enumerate(vals) if i % 3])
    assert abs(grp[("a", 0.95)] - np.percentile(a, 95)) < 1e-9


def test_split_exact_and_disjoint(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("claim_id"),
                                  (F.col("id") % 37 == 0).cast("int").alias("label"))
    s = ml.stratified_split(df).cache()
    per = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    n1 = df.where("label = 1").count()
    assert per[(1, "test")] == round(0.2 * n1)
    assert per[(0, "test")] == round(0.2 * (5000 - n1))
    assert s.select("claim_id").distinct().count() == 5000
