"""Registered queries over stored tables and changing streams: keyed merges,
bucketed reads, statistics kept by new claims, scorers in the stream, broken CSV
lines, running visits, progress."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import ingest as ing
from ..operators import scoring as sc
from ..operators import serving as sv
from ..operators.joins import write_table
from ..operators.moments import PeerStatsStore
from ..operators.profiles import build_beneficiary_profiles
from ..schemas import BENEFICIARY_FILE, CLAIM_FILES, HEURISTIC_WEIGHTS
from ..session import scratch_path, ship_package
from ..sources import adapters as ad
from ..sources import csv_files
from ..storage.bucketed import write_bucketed
from ..storage.versions import VersionedTable
from ..streaming import audit as au
from ..streaming import scoring as ss
from ..streaming.progress import ProgressTable
from . import batch
from . import oracle as O
from .catalog import (CHRONIC_CONDITIONS, DRIVER_HIGH_SEV_CUT, FEATURE_CHAIN, PEER_OUT, SERVING_LABELED, _audit_view, _claims,
                      _featured, _labeled, _peer_view, _peers_and_featured, _serving_claim_view, _write_messages, register, write_raw_csvs,
                      write_requests)
from .views import list_text, r6

# --- K7, X3: writes of two streams, in the order of their commits -------------------

INTERLEAVED_SQL = O.with_ctes(O.EVENT_ROWS) + """, won AS (
  SELECT flag_date, score, claim_id, driver_features,
         CASE WHEN CAST(claim_id AS BIGINT) % 3 = 0 THEN 'A2-' WHEN CAST(claim_id AS BIGINT) % 2 = 0 THEN 'B-' ELSE 'A1-' END || provider_id AS provider_id
  FROM audit)
""" + f"SELECT {O.AUDIT_OUT} FROM won"


@register("audit_stream_interleaved", INTERLEAVED_SQL)
def q_audit_stream_interleaved(spark, sf_dir):
    """Stream A writes all flags, stream B those with even ids again, and
    then A (same checkpoint, an older stream than B) those with ids divisible by
    three. The last write of a key wins, whichever stream made it."""
    m = ad.flag_messages_from_events(spark, sf_dir).select("value", "event_id")
    m = write_table(m, "messages")

    def part(rows, who):
        return rows.select(F.regexp_replace("value", '"provider_id":"', f'"provider_id":"{who}-').alias("value"))
    table, a, b = (scratch_path(spark, x) for x in ("audit_table", "messages_a", "messages_b"))
    ck_a, ck_b = scratch_path(spark, "ckpt_a"), scratch_path(spark, "ckpt_b")
    part(m, "A1").write.text(a)
    au.run_audit_stream(spark, a, table, ck_a)
    part(m.where("event_id % 2 = 0"), "B").write.text(b)
    au.run_audit_stream(spark, b, table, ck_b)
    part(m.where("event_id % 3 = 0"), "A2").write.mode("append").text(a)
    au.run_audit_stream(spark, a, table, ck_a)
    return _audit_view(au.read_audit_table(spark, table))


@register("audit_stream_progress", O.with_ctes(O.EVENT_ROWS) + """
SELECT CAST(2 * count(*) AS BIGINT) AS processed, CAST(2 * count(reject_reason) AS BIGINT) AS errors, CAST(2 AS BIGINT) AS runs FROM event_rows""")
def q_audit_stream_progress(spark, sf_dir):
    """Totals of the progress table that a listener keeps, over two runs."""
    src, table = _write_messages(spark, sf_dir), scratch_path(spark, "audit_table")
    progress = ProgressTable(spark, scratch_path(spark, "progress"))
    spark.streams.addListener(progress)
    try:
        for _ in range(2):
            progress.wait(au.run_audit_stream(spark, src, table, scratch_path(spark, "audit_ckpt")))
    finally:
        spark.streams.removeListener(progress)
    return progress.read().agg(F.sum("rows").cast("long").alias("processed"), F.sum("rejects").cast("long").alias("errors"),
                               F.count_distinct("run").alias("runs"))


# --- S6, S9, K3, K6: bucketed tables ---------------------------------------------------

@register("serving_claims_with_scores", SERVING_LABELED + f"""
SELECT claim_id, provider_id, label, round({O.SCORE_EXPR}, 6) AS score, {O.SCORE_EXPR} >= 0.5 AS flagged FROM labeled_s""")
def q_serving_claims_with_scores(spark, sf_dir):
    """Stored claims and stored scores, both in buckets of claim_id, join
    without an exchange."""
    labeled = _labeled(spark, sf_dir)
    claims = sv.write_claims_by_id(sv.claims_by_id(labeled))
    scores = write_bucketed(sc.score_claims(labeled, 0.5).select("claim_id", "score", "flagged"), "claim_id")
    return claims.join(scores, "claim_id").select("claim_id", "provider_id", "label", r6("score"), "flagged")


@register("serving_claim_point_read", SERVING_LABELED + f"""
SELECT {O.SERVING_CLAIM_OUT} FROM labeled_s WHERE claim_id = (SELECT max(claim_id) FROM labeled_s WHERE label = 1)""")
def q_serving_claim_point_read(spark, sf_dir):
    """One claim by its id (the largest positive one) from the stored table."""
    table = sv.write_claims_by_id(sv.claims_by_id(_labeled(spark, sf_dir)))
    asked = table.where("label = 1").agg(F.max("claim_id")).first()[0]
    return _serving_claim_view(sv.claim_by_id(table, asked))


TEXT_DATES_SQL = O.with_ctes(O.CLAIMS) + """
SELECT claim_id, strftime(claim_start_date, '%Y-%m-%d') AS claim_start_date,
       CASE WHEN length_of_stay_days % 3 = 0 THEN strftime(claim_end_date, '%Y-%m-%d') END AS claim_end_date FROM claims"""


@register("serving_text_dates", TEXT_DATES_SQL)
def q_serving_text_dates(spark, sf_dir):
    """Serving dates given as text: a date, a time stamp, other text (NULL)."""
    end, n = F.date_format("claim_end_date", "yyyy-MM-dd"), F.col("length_of_stay_days") % 3
    text = F.when(n == 0, end).when(n == 1, F.concat(F.lit("on "), end)).otherwise(F.date_format("claim_end_date", "yyyy-MM"))
    c = _claims(spark, sf_dir).withColumn("claim_end_date", text).withColumn("claim_start_date", F.date_format("claim_start_date", "yyyy-MM-dd HH:mm:ss"))
    extra = {k: F.lit(0.0) for k in ("reimbursement_zscore", "los_zscore", "visit_frequency_zscore", "code_severity_percentile", "high_severity_code_pct")}
    c = c.withColumns(extra | {"code_severity_outlier": F.lit(0), "label": F.lit(0), "label_reasons": F.array().cast("array<string>")})
    return sv.claims_by_id(c).select("claim_id", *[F.date_format(x, "yyyy-MM-dd").alias(x) for x in ("claim_start_date", "claim_end_date")])


# --- K5 with A2–A4: statistics kept by new claims alone --------------------------------

@register("provider_peer_stats_merged", O.with_ctes(O.CLAIMS, O.peer_stats()) + f"SELECT {PEER_OUT} FROM peer_stats")
def q_provider_peer_stats_merged(spark, sf_dir):
    """K5, A2–A4: three batches of claims applied one by one, one of them twice;
    their merged moments give the statistics of all claims."""
    claims, store = _claims(spark, sf_dir), PeerStatsStore(spark, scratch_path(spark, "peer_store"))
    part = F.pmod(F.xxhash64("claim_id"), F.lit(3))
    for k in (0, 1, 1, 2):
        store.update(claims.where(part == k), f"batch-{k}")
    return _peer_view(store.stats())


@register("provider_code_lookup", O.with_ctes(O.CLAIMS, O.codes()) + """
SELECT p.provider_id, c.code, CAST(count(o.code) AS BIGINT) AS n_occurrences
FROM (SELECT DISTINCT provider_id FROM claims) p CROSS JOIN (SELECT code FROM weights ORDER BY code LIMIT 3) c
LEFT JOIN code_occ o ON o.provider_id = p.provider_id AND o.code = c.code GROUP BY ALL""")
def q_provider_code_lookup(spark, sf_dir):
    """Each provider's counts of the first three codes, 0 where it never bills one."""
    claims = _claims(spark, sf_dir)
    counts = write_table(feat.provider_code_counts(claims), "code_counts")
    codes = [r.code for r in counts.select("code").distinct().orderBy("code").limit(3).collect()]
    pairs = counts.select("provider_id").distinct().select("provider_id", F.explode(F.array(*map(F.lit, codes))).alias("code"))
    return feat.compute_provider_code_frequency(counts, pairs)


@register("claim_severity_percentiles", FEATURE_CHAIN + "\nSELECT claim_id, round(code_severity_percentile, 6) AS code_severity_percentile FROM featured")
def q_claim_severity_percentiles(spark, sf_dir):
    """The severity of each claim by given code weights."""
    claims = _claims(spark, sf_dir)
    weights = write_table(feat.compute_code_reimbursement_weights(claims), "weights")
    return feat.compute_code_severity_percentile(claims, weights).select("claim_id", r6("code_severity_percentile"))


# --- D6, W1: visits up to the claim's date ------------------------------------------------

RUNNING_SQL = O.with_ctes(O.CLAIMS) + """
SELECT claim_id, count(*) OVER (PARTITION BY beneficiary_id, provider_id, claim_year ORDER BY claim_start_date
                                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS visits_ytd,
       count(*) OVER (PARTITION BY beneficiary_id, claim_year ORDER BY claim_start_date
                      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS visits_all FROM claims"""


@register("claims_running_ytd", RUNNING_SQL)
def q_claims_running_ytd(spark, sf_dir):
    """Visits of the year up to each claim's date, with the provider and (as
    with one provider for all) over all providers."""
    dated = ["beneficiary_id", "claim_start_date", "claim_year"]
    claims = _claims(spark, sf_dir, ["claim_id", "provider_id", *dated])
    own = feat.with_visits(claims, running=True, keep=dated, in_place=True).withColumnRenamed("visit_count", "visits_ytd")
    one = feat.with_visits(own.withColumn("provider_id", F.lit("all")), running=True, keep=["visits_ytd"]).withColumnRenamed("visit_count", "visits_all")
    return one.where("claim_id is not null")


# --- F4, X1, M5: scorers -----------------------------------------------------------------

def heuristic_plugin():
    """A scorer as it would come from outside: loaded once in a worker, called with
    a (rows, features) array."""
    weights, signed = np.array(list(HEURISTIC_WEIGHTS.values())) / np.array([1, 1, 1, 1, 100.0, 1]), 3

    def score(features):
        x = np.array(features, float)
        x[:, :signed] = np.abs(x[:, :signed])  # the z-scores
        return x @ weights
    return score


STREAM_SQL = FEATURE_CHAIN + "," + O.scored().strip("\n") + "\nSELECT s.claim_id, round(s.score, 6) AS score, s.flagged, s.threshold FROM scored s"


@register("scored_claims_plugin", FEATURE_CHAIN + "," + O.scored().strip("\n") +
          "\nSELECT s.claim_id, round(s.score, 6) AS score, s.flagged, s.threshold, d.driver_features FROM scored s JOIN drivers d USING (claim_id)")
def q_scored_claims_plugin(spark, sf_dir):
    """a plug-in scorer with the heuristic's formula gives the heuristic's scores."""
    ship_package(spark)
    scored = sc.score_with(sc.plugin_scorer(heuristic_plugin), _featured(spark, sf_dir), 0.5)
    return scored.select("claim_id", r6("score"), "flagged", "threshold", list_text("driver_features"))


@register("scoring_stream_plugin", STREAM_SQL)
def q_scoring_stream_plugin(spark, sf_dir):
    """The plug-in scorer inside the stream."""
    ship_package(spark)
    peers, f = _peers_and_featured(spark, sf_dir)
    out = scratch_path(spark, "score_out")
    ss.run_scoring_stream(spark, write_requests(f, scratch_path(spark, "score_requests")), peers, out, scratch_path(spark, "score_events"), scratch_path(spark, "score_ckpt"),
                          0.5, scorer=sc.plugin_scorer(heuristic_plugin))
    return ss.read_scores(spark, out, ["claim_id", "score", "flagged", "threshold"])


# --- S8, J9: the peer table of the moment --------------------------------------------------

@register("scoring_stream_refreshed_peers", FEATURE_CHAIN + """
SELECT c.claim_id, CAST(p.n_claims + CASE WHEN CAST(split_part(c.claim_id, '-', 1) AS BIGINT) % 2 = 0 THEN 0 ELSE 1000 END AS INTEGER) AS peer_n_claims
FROM featured c LEFT JOIN peer_stats p USING (provider_specialty, provider_id, claim_type)""")
def q_scoring_stream_refreshed_peers(spark, sf_dir):
    """A running stream scores the claims of even orders, the peer table is
    replaced, then those of odd orders: each batch has the table of its moment."""
    peers = VersionedTable(spark, scratch_path(spark, "peers"))
    first, f = _peers_and_featured(spark, sf_dir)
    f = write_table(f, "claims_featured")
    peers.publish(first)
    odd = F.split("claim_id", "-")[0].cast("long") % 2
    src, out = write_requests(f.where(odd == 0), scratch_path(spark, "score_requests")), scratch_path(spark, "score_out")
    q = ss.run_scoring_stream(spark, src, peers.read, out, scratch_path(spark, "score_events"), scratch_path(spark, "score_ckpt"), 0.5, available_now=False)
    try:
        q.processAllAvailable()
        peers.publish(first.withColumn("n_claims", F.col("n_claims") + 1000))
        write_requests(f.where(odd == 1), src)
        q.processAllAvailable()
    finally:
        q.stop()
    return ss.read_scores(spark, out, ["claim_id", F.col("provider_peer_stats.n_claims").alias("peer_n_claims")])


# --- P9, S1, S2: broken CSV lines ------------------------------------------------------------

@register("ingest_broken_lines", O.with_ctes(O.LINES) + """, seen AS (
  SELECT ctype AS file, CASE WHEN l_quantity <> 13 AND l_orderkey % 50 IN (7, 13, 29) THEN 'corrupt'
                             WHEN l_quantity IN (13, 17, 19) THEN 'dropped' WHEN l_quantity = 41 THEN 'malformed' ELSE 'accepted' END AS outcome FROM lines
  UNION ALL SELECT 'beneficiary', CASE WHEN c_custkey % 50 IN (7, 13, 29) THEN 'corrupt' ELSE 'accepted' END FROM customer)
SELECT file, outcome, count(*) AS n_rows FROM seen GROUP BY ALL""")
def q_ingest_broken_lines(spark, sf_dir):
    """Lines that lost or gained cells, or open a quote, are rejected
    under a reason of their own; whole lines are unharmed."""
    base = scratch_path(spark, "raw_csv")

    def write(df, name, key):
        csv_files.write_raw_lines(df, ad.broken_line(F.to_csv(F.struct(*df.columns)), key), f"{base}/{name}")
    for ctype, df in ad.raw_claims_from_tpch(spark, sf_dir).items():
        write(df, CLAIM_FILES[ctype][0], F.coalesce("CLM_ID", F.lit("0")))
    bene = ad.raw_beneficiaries_from_tpch(spark, sf_dir)
    write(bene, BENEFICIARY_FILE, F.substring("DESYNPUF_ID", 5, 20))
    claims = ing.reject_counts(ing.normalize_claims(csv_files.read_claim_files(spark, base))).select(F.col("claim_type").alias("file"), "outcome", "n_rows")
    raw = csv_files.read_beneficiaries(spark, base)
    none = spark.createDataFrame([], "beneficiary_id string, claim_year int")
    side = [(build_beneficiary_profiles(raw, none), "accepted"), (csv_files.broken_lines(raw), "corrupt")]
    for df, outcome in side:
        claims = claims.unionByName(df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("beneficiary").alias("file"), F.lit(outcome).alias("outcome"), "n_rows"))
    return claims


# --- S10: one day's queue; K1: files of a batch run read back -----------------------------------

@register("audit_queue_one_day", O.with_ctes(O.EVENT_ROWS) + """
SELECT strftime(flag_date, '%Y-%m-%d') AS flag_date, claim_id, round(score, 6) AS score, provider_id FROM audit
WHERE flag_date = (SELECT min(flag_date) FROM audit) ORDER BY score DESC, claim_id LIMIT 10""")
def q_audit_queue_one_day(spark, sf_dir):
    """The first day's ten highest flags; of the stored table that day's
    folder alone is read."""
    table = scratch_path(spark, "audit_table")
    au.run_audit_stream(spark, _write_messages(spark, sf_dir, resent=True), table, scratch_path(spark, "audit_ckpt"))
    day = str(au.read_audit_table(spark, table).agg(F.min("flag_date")).first()[0])
    top = sv.audit_queue(au.read_audit_table(spark, table, [day]), 10, day)
    return top.select(F.date_format("flag_date", "yyyy-MM-dd").alias("flag_date"), "claim_id", r6("score"), "provider_id")


def _batch_run(spark, sf_dir):
    return batch.build_dataset(spark, write_raw_csvs(spark, sf_dir), scratch_path(spark, "batch_out"), feat.FeatureParams(high_sev_cut=DRIVER_HIGH_SEV_CUT))


@register("batch_peer_stats_file", O.with_ctes(O.INGEST, O.INGEST_CLAIMS, O.peer_stats("claims")) + f"SELECT {PEER_OUT} FROM peer_stats")
def q_batch_peer_stats_file(spark, sf_dir):
    """K1: the peer statistics that a batch run over raw files wrote."""
    return _peer_view(spark.read.parquet(_batch_run(spark, sf_dir).peer_stats))


@register("batch_profiles_file", O.with_ctes(O.INGEST, O.INGEST_CLAIMS, O.beneficiaries(CHRONIC_CONDITIONS)) +
          "SELECT beneficiary_id, birth_year, chronic_conditions, claim_count_ytd FROM bene_profile")
def q_batch_profiles_file(spark, sf_dir):
    """K1: the beneficiary profiles that a batch run over raw files wrote."""
    p = spark.read.parquet(_batch_run(spark, sf_dir).profiles)
    return p.select("beneficiary_id", "birth_year", list_text("chronic_conditions"), "claim_count_ytd")


@register("batch_rejects_file", O.with_ctes(O.INGEST) +
          "SELECT claim_id, provider_id, claim_type, reject_reason FROM normalized WHERE reject_reason IS NOT NULL")
def q_batch_rejects_file(spark, sf_dir):
    """The rejects that a batch run over raw files wrote."""
    return spark.read.parquet(_batch_run(spark, sf_dir).rejects).select("claim_id", "provider_id", "claim_type", "reject_reason")
