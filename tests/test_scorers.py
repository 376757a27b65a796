"""Scorers in batch and stream, refreshed peers, progress, running visits, prefix scans."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerguard.operators import features as feat
from peerguard.operators import ml
from peerguard.operators import scoring as sc
from peerguard.operators.cumulative import exact_quantiles, running_totals
from peerguard.plans.stored import heuristic_plugin
from peerguard.schemas import FEATURE_COLS, PEER_STATS_COLUMNS
from peerguard.session import scratch_path, ship_package
from peerguard.sources import csv_files
from peerguard.streaming import audit as au
from peerguard.streaming import scoring as ss
from peerguard.streaming.progress import ProgressTable


@pytest.fixture(scope="module")
def requests(spark):
    rng = np.random.default_rng(2)
    rows = [(f"c{i}", f"b{i}", f"p{i % 9}", "s", "carrier", int(i % 7 == 0), *(float(x) for x in rng.normal(size=5).round(3) + (i % 7 == 0)), int(i % 2)) for i in range(600)]
    return spark.createDataFrame(rows, "claim_id string, beneficiary_id string, provider_id string, provider_specialty string, claim_type string, label int, "
                                 + ", ".join(f"{c} double" for c in FEATURE_COLS[:5]) + f", {FEATURE_COLS[5]} int").cache()


def no_peers(spark):
    return spark.createDataFrame([], ", ".join(f"{c} {'string' if i < 3 else 'int' if i == 3 else 'double'}" for i, c in enumerate(PEER_STATS_COLUMNS)))


def stream(spark, requests, scorer, **more):
    src, out = scratch_path(spark, "req"), scratch_path(spark, "out")
    requests.drop("label").write.json(src)
    ss.run_scoring_stream(spark, src, no_peers(spark), out, scratch_path(spark, "ev"), scratch_path(spark, "ck"), 0.5, scorer=scorer, **more)
    return ss.read_scores(spark, out)


def test_streamed_model_scores_equal_batch(spark, requests):
    model = ml.train_gbt(requests, max_iter=5)
    path = scratch_path(spark, "model")
    model.write().save(path)
    scorer = sc.saved_scorer(spark, path)
    assert scorer.model_loaded and not sc.saved_scorer(spark, path + "-none").model_loaded
    want = {r.claim_id: (round(r.score, 6), r.flagged) for r in sc.score_with(sc.model_scorer(model), requests).collect()}
    rows = stream(spark, requests, scorer, files_per_batch=1).collect()
    got = {r.claim_id: (r.score, r.flagged) for r in rows}
    assert got == want and len({s for s, _ in got.values()}) > 5
    assert {r.message for r in rows} == {None}          # a loaded model has no notice
    holes = requests.withColumn(FEATURE_COLS[0], F.when(F.col("label") == 0, F.col(FEATURE_COLS[0])))
    scored = sc.score_with(sc.model_scorer(model), holes)
    assert scored.count() == 600 and scored.where(F.col(FEATURE_COLS[0]).isNull()).count() == holes.where(F.col(FEATURE_COLS[0]).isNull()).count()


def test_plugin_with_the_heuristic_formula(spark, requests):
    ship_package(spark)
    plug = sc.plugin_scorer(heuristic_plugin)
    want = {r.claim_id: round(r.score, 9) for r in sc.score_claims(requests).collect()}
    assert {r.claim_id: round(r.score, 9) for r in sc.score_with(plug, requests).collect()} == want
    assert {r.claim_id: r.score for r in stream(spark, requests, plug).collect()} == {k: round(v, 6) for k, v in want.items()}


def test_scores_keep_the_last_response(spark, requests):
    out = scratch_path(spark, "out")
    assert ss.read_scores(spark, out).count() == 0
    for shift in (0.0, 10.0):
        src = scratch_path(spark, "req")
        requests.drop("label").withColumn(FEATURE_COLS[0], F.lit(shift)).limit(20).write.json(src)
        ss.run_scoring_stream(spark, src, no_peers(spark), out, scratch_path(spark, "ev"), scratch_path(spark, "ck"))
    scores = ss.read_scores(spark, out)
    assert scores.count() == scores.select("claim_id").distinct().count() == 20
    assert scores.where("score = 1").count() == 20          # the second run's shift


def test_replaced_peer_table_serves_the_next_batch(spark, requests):
    peers = {"now": no_peers(spark)}
    src, out = scratch_path(spark, "req"), scratch_path(spark, "out")
    q = None
    try:
        for n, stats in ((1, None), (2, 7)):
            if stats:
                peers["now"] = requests.select("provider_specialty", "provider_id", "claim_type").distinct().select(
                    "*", F.lit(stats).alias("n_claims"), *[F.lit(0.0).alias(c) for c in PEER_STATS_COLUMNS[4:]])
            requests.drop("label").where(F.col("code_severity_outlier") == n - 1).write.mode("append").json(src)
            q = q or ss.run_scoring_stream(spark, src, lambda: peers["now"], out, scratch_path(spark, "ev"), scratch_path(spark, "ck"), available_now=False)
            q.processAllAvailable()
    finally:
        q.stop()
    got = ss.read_scores(spark, out).join(requests.select("claim_id", "code_severity_outlier"), "claim_id")
    assert got.where("code_severity_outlier = 0 and provider_peer_stats is null").count() == 300
    assert got.where("code_severity_outlier = 1 and provider_peer_stats.n_claims = 7").count() == 300


def test_progress_table_over_two_runs(spark):
    src = scratch_path(spark, "msg")
    good = json.dumps({"claim_id": "c", "provider_id": "p", "score": 0.5, "flag_date": "2024-01-02"})
    spark.createDataFrame([(good,), ("{no",)], "value string").write.text(src)
    progress = ProgressTable(spark, scratch_path(spark, "progress"))
    assert progress.read().count() == 0
    spark.streams.addListener(progress)
    try:
        for _ in range(2):
            progress.wait(au.run_audit_stream(spark, src, scratch_path(spark, "audit"), scratch_path(spark, "ck")))
    finally:
        spark.streams.removeListener(progress)
    got = progress.read().collect()
    assert sum(r.rows for r in got) == 4 and sum(r.rejects for r in got) == 2 and len({r.run for r in got}) == 2 and all(r.seconds > 0 for r in got)


# --- running visits and prefix scans --------------------------------------------------

def test_running_visits_with_a_hot_key_and_ties(spark):
    rows = [(f"c{i}", "hot" if i % 3 == 0 else f"b{i % 11}", "p", 2020, f"2020-01-{1 + i % 28:02d}") for i in range(900)] + [("n", "b", "p", None, None)]
    df = spark.createDataFrame(rows, "claim_id string, beneficiary_id string, provider_id string, claim_year int, d string").withColumn("claim_start_date", F.col("d").cast("date"))
    got = {r.claim_id: r.visit_count for r in feat.with_visits(df, running=True).collect()}
    for i, b, _, y, d in rows[::17]:
        want = sum(1 for r in rows if r[1] == b and r[3] == y and r[4] <= d)
        assert got[i] == want
    assert got["n"] is None                                   # no date: taken as one visit by the features


def test_running_totals_over_three_levels(spark):
    rng = np.random.default_rng(0)
    values = rng.permutation(5000).astype(float)
    values[:10] = np.arange(10) * 1e6 + 1e5                    # far apart
    df = spark.createDataFrame([(float(v), int(i % 5), i % 2) for i, v in enumerate(values)], "x double, n long, g int")
    for descending in (False, True):
        for groups in ([], ["g"]):
            got = {(r.g, r.x): r.n_cum for r in running_totals(df, "x", ["n"], descending, groups, window_rows=40, fan=4).collect()}
            for g in (0, 1):
                total = 0
                for r in sorted([(v, int(i % 5), i % 2) for i, v in enumerate(values) if not groups or i % 2 == g], reverse=descending):
                    total += r[1]
                    if r[2] == g:
                        assert got[(g, r[0])] == total
    assert running_totals(df.where("x < -1"), "x", ["n"]).count() == 0
    q = {r.q: r.value for r in exact_quantiles(df, "x", [0.0, 0.25, 0.5, 1.0]).collect()}
    assert q == {p: float(np.quantile(values, p)) for p in (0.0, 0.25, 0.5, 1.0)}


def test_split_over_two_levels_is_the_same(spark):
    df = spark.range(3000).select(F.concat(F.lit("c"), "id").alias("claim_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    one, two = (sorted(map(tuple, ml.stratified_split(df, window_rows=n).collect())) for n in (250_000, 5))
    assert one == two and sum(r[2] == "test" for r in one) == 600


# --- broken lines -----------------------------------------------------------------------

def test_broken_lines_are_set_apart(spark):
    path = scratch_path(spark, "csv")
    t = spark.createDataFrame([("1", "a", "b"), ("2", "c", "d"), ("3", "e", "f"), ("4", "g", None), ("5", 'say ""x""', "h")], "k string, a string, b string")
    line = F.expr("case k when '1' then '1,a' when '2' then '2,c,d,e' when '3' then '\"3,e,f' when '5' then '5,\"say \"\"x\"\", y\",h' else concat_ws(',', k, a, '') end")
    csv_files.write_raw_lines(t, line, path)
    raw = csv_files.read_text_csv(spark, path)
    assert sorted(r.line for r in csv_files.broken_lines(raw).collect()) == ['"3,e,f', "1,a", "2,c,d,e"]
    assert sorted((r.k, r.a, r.b) for r in csv_files.whole_lines(raw).collect()) == [("4", "g", None), ("5", 'say "x", y', "h")]
    assert raw.where(F.col(csv_files.CORRUPT).isNull()).select("k").count() == 2   # pruned columns see the same lines
