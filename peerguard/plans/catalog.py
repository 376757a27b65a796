"""Registered queries: (spark, sf_dir) -> DataFrame, each with its oracle SQL.

Every query reads the driver tables (or data Spark derives from them) whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..schemas import CLAIM_COLUMNS
from ..sources.adapters import claim_lines, claims_of_versions, stale_lines, with_rewrites
from . import oracle as O
from .views import feature_view, r6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Driver data: provider high-severity shares lie in 0.09–0.11, so the reference
# cut of 0.3 never fires there; the labeled queries use 0.1.
DRIVER_HIGH_SEV_CUT = 0.1


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _claims(spark: SparkSession, sf_dir: str, columns: list[str] = CLAIM_COLUMNS) -> DataFrame:
    """Adapter claims with planted older versions, deduplicated on claim_id and
    written (D18). ``columns``: those that the query uses, where it doesn't use all."""
    return feat.prepare_claims(stale_lines(claim_lines(spark, sf_dir)), "l_orderkey", columns, claims_of_versions)


def _featured(spark: SparkSession, sf_dir: str, high_sev_cut: float = DRIVER_HIGH_SEV_CUT,
              baseline: str = "provider") -> DataFrame:
    params = feat.FeatureParams(baseline=baseline, high_sev_cut=high_sev_cut)
    return feat.compute_all_features(_claims(spark, sf_dir), params, prepared=True)


PEER_OUT = ("provider_specialty, provider_id, claim_type, n_claims, "
            + O.r6("avg_reimbursement", "reimbursement_stddev", "avg_length_of_stay", "los_stddev",
                   "avg_visit_freq_per_bene", "peer_avg_visit_freq", "peer_visit_freq_stddev"))


def _peer_view(df: DataFrame) -> DataFrame:
    return df.select("provider_specialty", "provider_id", "claim_type", "n_claims",
                     *[r6(c) for c in ("avg_reimbursement", "reimbursement_stddev", "avg_length_of_stay",
                                       "los_stddev", "avg_visit_freq_per_bene", "peer_avg_visit_freq",
                                       "peer_visit_freq_stddev")])


@register("provider_peer_stats",
          O.with_ctes(O.CLAIMS, O.peer_stats()) + f"SELECT {PEER_OUT} FROM peer_stats")
def q_provider_peer_stats(spark, sf_dir):
    """A2, A3, A4, A10, J2, J3 (D5 grain, D7 fill)."""
    return _peer_view(feat.compute_peer_group_stats(_claims(spark, sf_dir)))


@register("provider_peer_stats_peer_baseline",
          O.with_ctes(O.CLAIMS, O.peer_stats(baseline="peer_group")) + f"SELECT {PEER_OUT} FROM peer_stats")
def q_provider_peer_stats_peer_baseline(spark, sf_dir):
    """D4 option: amount/LOS mean and std of the specialty × type group."""
    return _peer_view(feat.compute_peer_group_stats(_claims(spark, sf_dir), "peer_group"))


@register("code_weights",
          O.with_ctes(O.CLAIMS, O.codes()) +
          "SELECT code, round(avg_reimbursement, 6) AS avg_reimbursement, n_occurrences FROM weights")
def q_code_weights(spark, sf_dir):
    """Per-code mean amount and occurrences (dx and px share one key space)."""
    w = feat.compute_code_reimbursement_weights(_claims(spark, sf_dir))
    return w.select("code", r6("avg_reimbursement"), "n_occurrences")


@register("code_severity",
          O.with_ctes(O.CLAIMS, O.codes()) +
          "SELECT code, round(severity, 6) AS severity, is_high_severity, "
          "round(p50, 6) AS p50, round(p90, 6) AS p90 FROM sev CROSS JOIN pcts")
def q_code_severity(spark, sf_dir):
    """A9 + P16 per code: exact p50/p90 of code means, clamped position, top decile."""
    w = feat.compute_code_reimbursement_weights(_claims(spark, sf_dir))
    from ..session import materialize
    w = materialize(w)
    p50, p90 = feat.code_percentiles(w)
    sev = feat.code_severity_table(w)
    return sev.select("code", r6("severity"), "is_high_severity",
                      F.round(p50, 6).alias("p50"), F.round(p90, 6).alias("p90"))


@register("provider_high_severity_share",
          O.with_ctes(O.CLAIMS, O.codes()) +
          "SELECT provider_id, round(high_severity_code_pct, 6) AS high_severity_code_pct FROM share")
def q_provider_high_severity_share(spark, sf_dir):
    """A5 (with A8 counts underneath): provider share of top-decile code uses."""
    from ..operators.joins import checked
    from ..session import materialize
    claims = _claims(spark, sf_dir)
    sev = checked(feat.code_severity_table(materialize(feat.compute_code_reimbursement_weights(claims))))
    return feat.provider_high_severity_share(claims, sev).select("provider_id", r6("high_severity_code_pct"))


@register("provider_code_counts",
          O.with_ctes(O.CLAIMS, O.codes()) +
          "SELECT provider_id, code, count(*) AS n_occurrences FROM code_occ GROUP BY provider_id, code")
def q_provider_code_counts(spark, sf_dir):
    """Occurrences per (provider, code)."""
    return feat.provider_code_counts(_claims(spark, sf_dir))


@register("claims_featured",
          O.feature_chain(DRIVER_HIGH_SEV_CUT) + f"SELECT {O.FEATURE_OUT} FROM featured")
def q_claims_featured(spark, sf_dir):
    """The six features per claim."""
    return feature_view(_featured(spark, sf_dir))


@register("claims_featured_reference_cut",
          O.feature_chain(0.3) + f"SELECT {O.FEATURE_OUT} FROM featured")
def q_claims_featured_reference_cut(spark, sf_dir):
    """Same features with the reference's 0.3 share cut (outlier never fires here)."""
    return feature_view(_featured(spark, sf_dir, high_sev_cut=0.3))


@register("claims_featured_peer_baseline",
          O.feature_chain(DRIVER_HIGH_SEV_CUT, "peer_group") + f"SELECT {O.FEATURE_OUT} FROM featured")
def q_claims_featured_peer_baseline(spark, sf_dir):
    """Z-scores against the specialty × claim-type group."""
    return feature_view(_featured(spark, sf_dir, baseline="peer_group"))


# --- labels -----------------------------------------------------------------
from ..operators import labels as lab  # noqa: E402
from ..operators.joins import write_step, write_table  # noqa: E402
from ..schemas import COARSE_GRID_K2, COARSE_GRID_K3, FEATURE_COLS, FINE_DELTAS, SIGNALS  # noqa: E402
from .views import list_text  # noqa: E402

LABEL_OUT = O.FEATURE_OUT + ", label_reasons, label"


def _label_view(df: DataFrame) -> DataFrame:
    return feature_view(df, list_text("label_reasons"), "label")


def featured_table(spark: SparkSession, sf_dir: str, high_sev_cut: float = DRIVER_HIGH_SEV_CUT,
                   columns: list[str] | None = None, claims: DataFrame | None = None) -> DataFrame:
    """Featured claims written once to the shared folder (K1), so calibration
    and labeling read it instead of recomputing the features. ``columns``: those
    that the query uses, where it doesn't use all."""
    params = feat.FeatureParams(high_sev_cut=high_sev_cut)
    if claims is None:
        read = feat.FEATURE_INPUT if columns else CLAIM_COLUMNS
        claims = _claims(spark, sf_dir, [c for c in CLAIM_COLUMNS if c in {*read, *(columns or [])}])
    f = feat.compute_all_features(claims, params, prepared=True)
    return write_table(f.select(*columns) if columns else f, "claims_featured")


FEATURE_CHAIN = O.feature_chain(DRIVER_HIGH_SEV_CUT)
CAL_ARGS = dict(ks=[2, 3], thresholds=lab.candidate_thresholds([2, 3]), coarse_k2=COARSE_GRID_K2,
                coarse_k3=COARSE_GRID_K3, deltas=FINE_DELTAS)


@register("claims_labeled_fixed",
          FEATURE_CHAIN + "," + O.labeled("2.5", "2").strip("\n") + f"\nSELECT {LABEL_OUT} FROM labeled")
def q_claims_labeled_fixed(spark, sf_dir):
    """P20/P21 at the default threshold 2.5 and two signals."""
    return _label_view(lab.inject_labels(_featured(spark, sf_dir), 2.5, 2))


@register("label_signal_counts",
          FEATURE_CHAIN + "," + O.labeled("2.5", "2").strip("\n") + """,
counts AS (
  SELECT count(*) AS n_claims,
         sum(CAST(reimbursement_zscore > 2.5 AS INTEGER)) AS reimbursement_zscore,
         sum(CAST(claim_type = 'inpatient' AND los_zscore > 2.5 AS INTEGER)) AS los_zscore,
         sum(CAST(visit_frequency_zscore > 2.5 AS INTEGER)) AS visit_frequency_zscore,
         sum(CAST(code_severity_outlier = 1 AS INTEGER)) AS code_severity_outlier,
         sum(label) AS positive_label FROM labeled)
SELECT metric, CAST(n AS BIGINT) AS n, round(CAST(n AS DOUBLE) / n_claims * 100, 6) AS pct FROM (
  SELECT 'reimbursement_zscore' AS metric, reimbursement_zscore AS n, n_claims FROM counts
  UNION ALL SELECT 'los_zscore', los_zscore, n_claims FROM counts
  UNION ALL SELECT 'visit_frequency_zscore', visit_frequency_zscore, n_claims FROM counts
  UNION ALL SELECT 'code_severity_outlier', code_severity_outlier, n_claims FROM counts
  UNION ALL SELECT 'positive_label', positive_label, n_claims FROM counts)""")
def q_label_signal_counts(spark, sf_dir):
    """Signal firing counts, positives and rate (threshold 2.5, k=2)."""
    sc = lab.signal_counts(lab.inject_labels(_featured(spark, sf_dir), 2.5, 2))
    return sc.select("metric", "n", r6("pct"))


@register("calibration_grid",
          FEATURE_CHAIN + "," + O.calibration(**CAL_ARGS).strip("\n") +
          "\nSELECT CAST(min_signals AS INTEGER) AS min_signals, threshold, CAST(n_positive AS BIGINT) AS n_positive, "
          "round(CAST(n_positive AS DOUBLE) / n_claims, 6) AS positive_rate, n_claims FROM grid")
def q_calibration_grid(spark, sf_dir):
    """A13 grid: positive rate for every (k, threshold) the search can visit,
    all from one aggregate over crit_k."""
    g = lab.calibration_grid(_featured(spark, sf_dir))
    return g.select("min_signals", "threshold", "n_positive", r6("positive_rate"), "n_claims")


CALIBRATED = FEATURE_CHAIN + "," + O.calibration(**CAL_ARGS).strip("\n") + "," + \
    O.labeled("ch.t", "ch.k", extra_from="CROSS JOIN chosen ch",
              extra_cols=" ch.t, ch.k, ch.in_band,").strip("\n")


@register("calibrated_threshold",
          CALIBRATED + """
SELECT CAST(any_value(t) AS DOUBLE) AS threshold, CAST(any_value(k) AS INTEGER) AS min_signals,
       any_value(in_band) AS in_band, count(*) AS n_claims, CAST(sum(label) AS BIGINT) AS n_positive,
       round(CAST(sum(label) AS DOUBLE) / count(*), 6) AS positive_rate,
       CAST(sum(CAST(reimbursement_zscore > t AS INTEGER)) AS BIGINT) AS n_reimbursement_zscore,
       CAST(sum(CAST(claim_type = 'inpatient' AND los_zscore > t AS INTEGER)) AS BIGINT) AS n_los_zscore,
       CAST(sum(CAST(visit_frequency_zscore > t AS INTEGER)) AS BIGINT) AS n_visit_frequency_zscore,
       CAST(sum(CAST(code_severity_outlier = 1 AS INTEGER)) AS BIGINT) AS n_code_severity_outlier
FROM labeled""")
def q_calibrated_threshold(spark, sf_dir):
    """A13 choice + K11 summary: threshold, k, band, rate and signal counts."""
    labeled, cal = lab.calibrate_threshold(featured_table(spark, sf_dir))
    s = lab.labeling_summary(labeled, cal)
    return s.select("threshold", "min_signals", "in_band", "n_claims", "n_positive", r6("positive_rate"),
                    *[f"n_{x}" for x in SIGNALS])


@register("claims_labeled", CALIBRATED + f"\nSELECT {LABEL_OUT} FROM labeled")
def q_claims_labeled(spark, sf_dir):
    """The flagship: features → one-pass calibration → labels at the choice."""
    labeled, _ = lab.calibrate_threshold(featured_table(spark, sf_dir))
    return _label_view(labeled)


@register("spot_check_sample",
          CALIBRATED + """
SELECT claim_id, provider_id, claim_type, round(reimbursement_zscore, 6) AS reimbursement_zscore,
       label_reasons, CASE WHEN n_signals >= 3 OR reimbursement_zscore > 3.0 THEN 'PLAUSIBLE'
            WHEN n_signals = 2 AND reimbursement_zscore > 2.5 THEN 'POSSIBLY' ELSE 'BORDERLINE' END AS assessment
FROM labeled WHERE label = 1 ORDER BY md5(claim_id), claim_id LIMIT 25""")
def q_spot_check_sample(spark, sf_dir):
    """T5 + P22: 25 positives by md5(claim_id), graded."""
    labeled, _ = lab.calibrate_threshold(featured_table(spark, sf_dir))
    s = lab.spot_check(labeled, 25)
    return s.select("claim_id", "provider_id", "claim_type", r6("reimbursement_zscore"),
                    list_text("label_reasons"), "assessment")


# --- ingest through raw CSV files ---------------------------------------------
from ..operators import ingest as ing  # noqa: E402
from ..operators.profiles import build_beneficiary_profiles  # noqa: E402
from ..schemas import CHRONIC_CONDITIONS  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import adapters as ad  # noqa: E402
from ..sources import csv_files  # noqa: E402
from ..schemas import BENEFICIARY_FILE, CLAIM_FILES  # noqa: E402


def write_raw_csvs(spark: SparkSession, sf_dir: str) -> str:
    """Derive the raw claim and beneficiary CSV files from the driver tables
    into a fresh folder under the shared checkpoint folder; returns it."""
    base = scratch_path(spark, "raw_csv")
    for ctype, df in ad.raw_claims_from_tpch(spark, sf_dir).items():
        csv_files.write_text_csv(df, f"{base}/{CLAIM_FILES[ctype][0]}")
    csv_files.write_text_csv(ad.raw_beneficiaries_from_tpch(spark, sf_dir), f"{base}/{BENEFICIARY_FILE}")
    return base


def _normalized_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = write_raw_csvs(spark, sf_dir)
    return ing.normalize_claims(csv_files.read_claim_files(spark, base))


def _ingest_view(df: DataFrame) -> DataFrame:
    return df.select("claim_id", "beneficiary_id", "provider_id", "provider_specialty", "claim_type",
                     F.date_format("claim_start_date", "yyyy-MM-dd").alias("claim_start_date"),
                     F.date_format("claim_end_date", "yyyy-MM-dd").alias("claim_end_date"), "claim_year",
                     "admit_diagnosis_cd", list_text("diagnosis_codes"), list_text("procedure_codes"),
                     r6("reimbursement_amt"), "length_of_stay_days")


@register("ingest_normalized_claims",
          O.with_ctes(O.INGEST) + f"SELECT {O.INGEST_OUT} FROM normalized WHERE reject_reason IS NULL")
def q_ingest_normalized_claims(spark, sf_dir):
    """S2 + P1–P8, P10, P36, J1, U1: raw CSVs (all text) → accepted claims."""
    return _ingest_view(ing.accepted(_normalized_from_csv(spark, sf_dir)))


@register("ingest_reject_counts",
          O.with_ctes(O.INGEST) +
          "SELECT claim_type, coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n_rows "
          "FROM normalized GROUP BY ALL")
def q_ingest_reject_counts(spark, sf_dir):
    """P9 + A18: accepted / dropped / malformed rows per claim type."""
    return ing.reject_counts(_normalized_from_csv(spark, sf_dir))


@register("ingest_rejected_rows",
          O.with_ctes(O.INGEST) +
          "SELECT claim_id, provider_id, claim_type, reject_reason FROM normalized WHERE reject_reason IS NOT NULL")
def q_ingest_rejected_rows(spark, sf_dir):
    """The explicit reject output with its reason."""
    return ing.rejected(_normalized_from_csv(spark, sf_dir)).select(
        "claim_id", "provider_id", "claim_type", "reject_reason")


@register("provider_specialty_map",
          O.with_ctes(O.LINES) + """,
spec_map AS (
  SELECT 'PRV' || CAST(l_suppkey AS VARCHAR) AS provider_id,
         arg_min(r_name, CASE WHEN l_quantity = 13 THEN '' ELSE cid END || '|' || r_name) AS mapped_specialty
  FROM lines WHERE ctype = 'carrier' AND l_quantity <> 17 AND l_linenumber <> 2 GROUP BY 1)
SELECT provider_id, mapped_specialty FROM spec_map""")
def q_provider_specialty_map(spark, sf_dir):
    """First non-blank specialty per provider from the carrier file."""
    base = write_raw_csvs(spark, sf_dir)
    return ing.provider_specialty_map(csv_files.read_claim_files(spark, base)["carrier"])


@register("beneficiary_profiles",
          O.with_ctes(O.CLAIMS, O.beneficiaries(CHRONIC_CONDITIONS)) +
          "SELECT beneficiary_id, birth_year, chronic_conditions, claim_count_ytd FROM bene_profile")
def q_beneficiary_profiles(spark, sf_dir):
    """S1 + P11, P12, A11, J8: profiles from the beneficiary CSV and claims."""
    base = write_raw_csvs(spark, sf_dir)
    bene = csv_files.read_beneficiaries(spark, base)
    claims = _claims(spark, sf_dir)
    p = build_beneficiary_profiles(bene, claims)
    return p.select("beneficiary_id", "birth_year", list_text("chronic_conditions"), "claim_count_ytd")


# --- scoring ------------------------------------------------------------------
from ..operators import metrics as met  # noqa: E402
from ..operators import ml  # noqa: E402
from ..operators import scoring as sc  # noqa: E402
from ..operators import serving as sv  # noqa: E402
from ..sources.tables import table  # noqa: E402
from ..streaming import audit as au  # noqa: E402
from ..streaming import scoring as ss  # noqa: E402
from ..streaming.scoring import FAST_GZIP  # noqa: E402

SCORED_OUT = ("s.claim_id, round(s.score, 6) AS score, s.flagged, s.threshold, d.driver_features, "
              "'Model not compiled; using heuristic score.' AS message")
SCORED_SQL = FEATURE_CHAIN + "," + O.scored().strip("\n") + \
    f"\nSELECT {SCORED_OUT} FROM scored s JOIN drivers d USING (claim_id)"


def _scored_view(df: DataFrame) -> DataFrame:
    return df.select("claim_id", r6("score"), "flagged", "threshold", list_text("driver_features"),
                     F.lit(sc.HEURISTIC_MESSAGE).alias("message"))


@register("scored_claims", SCORED_SQL)
def q_scored_claims(spark, sf_dir):
    """Heuristic score, clamp, flag at 0.5, top-3 drivers."""
    return _scored_view(sc.score_claims(_featured(spark, sf_dir), 0.5))


@register("scored_claims_peer_lookup",
          FEATURE_CHAIN + "," + O.scored().strip("\n") + """,
legacy AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY provider_specialty, provider_id
                                               ORDER BY claim_type DESC) AS rn FROM peer_stats) WHERE rn = 1)
SELECT s.claim_id, round(s.score, 6) AS score, s.flagged, l.claim_type AS peer_claim_type,
       CAST(l.n_claims AS INTEGER) AS peer_n_claims, round(l.avg_reimbursement, 6) AS peer_avg_reimbursement
FROM scored s LEFT JOIN legacy l USING (provider_specialty, provider_id)""")
def q_scored_claims_peer_lookup(spark, sf_dir):
    """Scores enriched with the provider's peer stats read by
    (specialty, provider), first row of the D11 one-row view."""
    c = _claims(spark, sf_dir)
    peer = write_table(sv.peer_stats_legacy_one_row(sv.peer_stats_table(feat.compute_peer_group_stats(c))), "peer_one_row")
    f = feat.compute_all_features(c, feat.FeatureParams(high_sev_cut=DRIVER_HIGH_SEV_CUT), prepared=True)
    s = sc.with_peer_stats(sc.score_claims(f, 0.5), peer, sc.PEER_KEY_LEGACY)
    return s.select("claim_id", r6("score"), "flagged",
                    F.col("provider_peer_stats.claim_type").alias("peer_claim_type"),
                    F.col("provider_peer_stats.n_claims").alias("peer_n_claims"),
                    F.round("provider_peer_stats.avg_reimbursement", 6).alias("peer_avg_reimbursement"))


#: The clock of the checked flag events, and the threshold that every scored claim is held to.
FLAG_DAY, FLAG_TIME, FLAG_AT = "2024-05-06", "2024-05-06 07:08:09.000010", 0.5
FLAG_CHAIN = FEATURE_CHAIN + "," + O.scored(threshold=str(FLAG_AT)).strip("\n")


def _flag_clock():
    return F.lit(FLAG_DAY).cast("date"), F.lit(FLAG_TIME).cast("timestamp_ntz").cast("timestamp")


@register("flag_event_messages", FLAG_CHAIN + f"""
SELECT s.claim_id, s.provider_id, round(s.score, 6) AS score, d.driver_features, '{FLAG_DAY}' AS flag_date,
       '{FLAG_TIME.replace(" ", "T")}Z' AS timestamp
FROM scored s JOIN drivers d USING (claim_id) WHERE s.flagged""")
def q_flag_event_messages(spark, sf_dir):
    """One JSON message per flagged claim, read back field by field."""
    ev = sc.flag_events(sc.score_claims(_featured(spark, sf_dir), FLAG_AT), *_flag_clock())
    m = F.from_json("value", "claim_id string, provider_id string, score double, "
                             "driver_features array<string>, flag_date string, timestamp string")
    return ev.select(m.alias("m")).select("m.claim_id", "m.provider_id", F.round("m.score", 6).alias("score"),
                                           F.array_join("m.driver_features", "|").alias("driver_features"),
                                           "m.flag_date", "m.timestamp")


# --- flag events → audit table (batch and stream) -------------------------------
def _audit_view(df: DataFrame) -> DataFrame:
    return df.select(F.date_format("flag_date", "yyyy-MM-dd").alias("flag_date"), r6("score"), "claim_id",
                     "provider_id", "driver_features")


AUDIT_SQL = O.with_ctes(O.EVENT_ROWS) + f"SELECT {O.AUDIT_OUT} FROM audit"
REJECT_SQL = O.with_ctes(O.EVENT_ROWS) + \
    "SELECT reject_reason, count(*) AS n_rows FROM event_rows WHERE reject_reason IS NOT NULL GROUP BY 1"


@register("flagged_claims_from_events", AUDIT_SQL)
def q_flagged_claims_from_events(spark, sf_dir):
    """X2 (batch form) + P27, P28, K7 key dedup: messages → audit rows."""
    rows = au.to_audit_rows(ad.with_resent(ad.flag_messages_from_events(spark, sf_dir))).where(F.col("reject_reason").isNull())
    return _audit_view(sv.last_write_wins(rows, au.AUDIT_KEY, [F.col("event_time").desc()]))


@register("flag_event_rejects", REJECT_SQL)
def q_flag_event_rejects(spark, sf_dir):
    """Rejected messages by reason (bad JSON, empty claim id)."""
    rows = au.to_audit_rows(ad.flag_messages_from_events(spark, sf_dir))
    return au.rejected_rows(rows).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def _write_messages(spark: SparkSession, sf_dir: str, resent: bool = False) -> str:
    src = scratch_path(spark, "flag_messages")
    messages = ad.flag_messages_from_events(spark, sf_dir)
    (ad.with_resent(messages) if resent else messages).select("value").write.mode("overwrite").text(src)
    return src


@register("audit_stream_table", AUDIT_SQL)
def q_audit_stream_table(spark, sf_dir):
    """X2/X3/K7 streaming: JSON-lines source → availableNow micro-batches →
    foreachBatch merge into day partitions."""
    src = _write_messages(spark, sf_dir, resent=True)
    table = scratch_path(spark, "audit_table")
    au.run_audit_stream(spark, src, table, scratch_path(spark, "audit_ckpt"))
    return _audit_view(au.read_audit_table(spark, table))


@register("audit_stream_replay", AUDIT_SQL)
def q_audit_stream_replay(spark, sf_dir):
    """The same input consumed twice (a replay with a fresh checkpoint)
    into the same table gives the same table."""
    src = _write_messages(spark, sf_dir, resent=True)
    table = scratch_path(spark, "audit_table")
    au.run_audit_stream(spark, src, table, scratch_path(spark, "audit_ckpt"))
    au.run_audit_stream(spark, src, table, scratch_path(spark, "audit_ckpt"))
    return _audit_view(au.read_audit_table(spark, table))


TWO_SOURCES_SQL = O.with_ctes(O.EVENT_ROWS) + """, two AS (
  SELECT flag_date, score, claim_id, driver_features,
         CASE WHEN right(claim_id, 1) IN ('0', '2', '4', '6', '8') THEN '2-' || provider_id ELSE provider_id END AS provider_id
  FROM audit)
""" + f"SELECT {O.AUDIT_OUT} FROM two"


@register("audit_stream_two_sources", TWO_SOURCES_SQL)
def q_audit_stream_two_sources(spark, sf_dir):
    """Two streams with a checkpoint of their own write one table. The
    first has all claims but those whose id ends in 4; the second those with an
    even last digit, under another provider. The table is the keyed union, in
    which the later write wins."""
    m = ad.flag_messages_from_events(spark, sf_dir).select("value", F.get_json_object("value", "$.claim_id").alias("id"))
    last = F.coalesce(F.substring("id", -1, 1), F.lit(""))
    again = F.regexp_replace("value", '"provider_id":"', '"provider_id":"2-')
    parts = [m.where(last != "4").select("value"), m.where(last.isin(*"02468")).select(again.alias("value"))]
    table = scratch_path(spark, "audit_table")
    for part in parts:
        src = scratch_path(spark, "flag_messages")
        part.write.text(src)
        au.run_audit_stream(spark, src, table, scratch_path(spark, "audit_ckpt"))
    return _audit_view(au.read_audit_table(spark, table))


@register("audit_stream_rejects", REJECT_SQL)
def q_audit_stream_rejects(spark, sf_dir):
    """X4 streaming: the reject output of the stream, by reason."""
    src = _write_messages(spark, sf_dir)
    table = scratch_path(spark, "audit_table")
    au.run_audit_stream(spark, src, table, scratch_path(spark, "audit_ckpt"))
    return au.read_audit_rejects(spark, table).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


@register("audit_queue_top10", O.with_ctes(O.EVENT_ROWS) + """
SELECT strftime(flag_date, '%Y-%m-%d') AS flag_date, rank, claim_id, round(score, 6) AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY flag_date ORDER BY score DESC, claim_id) AS INTEGER) AS rank
  FROM audit) WHERE rank <= 10""")
def q_audit_queue_top10(spark, sf_dir):
    """Each day's 10 highest-scored flags (score desc, claim id asc)."""
    rows = au.accepted_rows(au.to_audit_rows(ad.flag_messages_from_events(spark, sf_dir)))
    q = sv.audit_queue(sv.last_write_wins(rows, au.AUDIT_KEY, [F.col("provider_id")]), 10)
    return q.select(F.date_format("flag_date", "yyyy-MM-dd").alias("flag_date"), "rank", "claim_id", r6("score"))


# --- streaming scoring ---------------------------------------------------------
def _peers_and_featured(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The serving table of peer statistics, and the features by those statistics,
    from claims that are built once."""
    c = _claims(spark, sf_dir)
    peer = write_table(feat.compute_peer_group_stats(c), "peer_stats")
    params = feat.FeatureParams(high_sev_cut=DRIVER_HIGH_SEV_CUT)
    return write_table(sv.peer_stats_table(peer), "peer_table"), feat.compute_all_features(c, params, peer_stats=peer, prepared=True)


def write_requests(featured: DataFrame, path: str) -> str:
    """Score requests as compressed JSON-lines files under ``path``."""
    featured.drop("claim_end_date", "claim_year", "admit_diagnosis_cd") \
            .withColumn("claim_start_date", F.date_format("claim_start_date", "yyyy-MM-dd")) \
            .write.mode("append").option("compression", "gzip").option(*FAST_GZIP).json(path)
    return path


@register("scoring_stream_scores", SCORED_SQL.replace(
    f"\nSELECT {SCORED_OUT} FROM scored s JOIN drivers d USING (claim_id)",
    "\nSELECT s.claim_id, round(s.score, 6) AS score, s.flagged, s.threshold, "
    "'Model not compiled; using heuristic score.' AS message FROM scored s"))
def q_scoring_stream_scores(spark, sf_dir):
    """Claim requests as JSON files → streaming score → responses (K9)."""
    peer, f = _peers_and_featured(spark, sf_dir)
    req_dir = write_requests(f, scratch_path(spark, "score_requests"))
    out = scratch_path(spark, "score_out")
    ss.run_scoring_stream(spark, req_dir, peer, out, scratch_path(spark, "score_events"),
                          scratch_path(spark, "score_ckpt"), 0.5)
    return ss.read_scores(spark, out, ["claim_id", "score", "flagged", "threshold", "message"])


@register("scoring_request_rejects", """
SELECT reject_reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN event_id % 7 = 0 THEN 'bad_reimbursement_zscore' WHEN event_id % 7 = 1 THEN 'missing_provider_id'
              WHEN event_id % 7 = 2 THEN 'bad_json' WHEN event_id % 7 = 3 THEN 'bad_length_of_stay_days' END AS reject_reason
  FROM events) WHERE reject_reason IS NOT NULL GROUP BY 1""")
def q_scoring_request_rejects(spark, sf_dir):
    """Requests with a wrongly typed number, without a required field or
    that aren't JSON are rejected with the reason; the rest is scored."""
    e = table(spark, sf_dir, "events").select("event_id", F.pmod("event_id", F.lit(7)).alias("r"))
    ids = [F.lit(f'{c}-').alias(c) for c in ("beneficiary_id", "provider_specialty", "claim_type")]
    body = F.struct(F.col("event_id").cast("string").alias("claim_id"), *ids, F.when(F.col("r") != 1, F.lit("p")).alias("provider_id"),
                    F.when(F.col("r") == 0, "abc").otherwise("1.5").alias("reimbursement_zscore"), F.when(F.col("r") == 3, "2x").otherwise("2").alias("length_of_stay_days"))
    src = scratch_path(spark, "score_requests")
    e.select(F.when(F.col("r") == 2, F.lit("{broken")).otherwise(F.to_json(body)).alias("value")).write.text(src)
    peer = write_table(sv.peer_stats_table(feat.compute_peer_group_stats(_claims(spark, sf_dir))), "peer_table")
    out = scratch_path(spark, "score_out")
    ss.run_scoring_stream(spark, src, peer, out, scratch_path(spark, "score_events"), scratch_path(spark, "score_ckpt"), 0.5)
    return ss.read_request_rejects(spark, out).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


# --- serving tables and read paths ----------------------------------------------
SERVING_LABELED = CALIBRATED.rstrip() + ",\nlabeled_s AS (SELECT *, " + O.reasons_json("t") + \
    " AS label_reasons_json FROM labeled)"


def _labeled(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, claims: DataFrame | None = None) -> DataFrame:
    labeled, _ = lab.calibrate_threshold(featured_table(spark, sf_dir, columns=columns, claims=claims))
    return labeled


def _serving_claim_view(df: DataFrame) -> DataFrame:
    return df.select("claim_id", "provider_id", F.date_format("claim_start_date", "yyyy-MM-dd").alias("claim_start_date"),
                     F.date_format("claim_end_date", "yyyy-MM-dd").alias("claim_end_date"), "beneficiary_id",
                     "provider_specialty", "claim_type", "admit_diagnosis_cd", "diagnosis_codes", "procedure_codes",
                     r6("reimbursement_amt"), "length_of_stay_days", r6("reimbursement_zscore"),
                     r6("visit_frequency_zscore"), "code_severity_outlier", "label", "label_reasons")


@register("serving_claims_by_id", SERVING_LABELED + f"\nSELECT {O.SERVING_CLAIM_OUT} FROM labeled_s")
def q_serving_claims_by_id(spark, sf_dir):
    """K3 + W3 + P23–P26: id-keyed serving rows, written in buckets of claim_id,
    read back; of the planted versions of a claim one stays."""
    return _serving_claim_view(sv.write_claims_by_id(sv.claims_by_id(with_rewrites(_labeled(spark, sf_dir)))))


@register("serving_claims_by_provider_range", SERVING_LABELED + f"""
SELECT provider_id, strftime(claim_start_date, '%Y-%m-%d') AS claim_start_date, claim_id,
       round(reimbursement_amt, 6) AS reimbursement_amt, label
FROM labeled_s WHERE claim_start_date BETWEEN DATE '1995-01-01' AND DATE '1998-12-31'""")
def q_serving_claims_by_provider_range(spark, sf_dir):
    """K4 + S7 + T1: provider/date-clustered table; every provider's claims in
    a date range, ordered by (provider, date, claim). The range predicate is
    pushed to the Parquet scan."""
    path = scratch_path(spark, "claims_by_provider")
    sv.write_claims_by_provider(sv.claims_by_provider(with_rewrites(_labeled(spark, sf_dir))), path)
    r = sv.provider_claims_between(spark.read.parquet(path), "1995-01-01", "1998-12-31")
    return r.select("provider_id", F.date_format("claim_start_date", "yyyy-MM-dd").alias("claim_start_date"),
                    "claim_id", r6("reimbursement_amt"), "label")


PEER_SERVING_OUT = ("provider_specialty, provider_id, claim_type, CAST(n_claims AS INTEGER) AS n_claims, "
                    + O.r6("avg_reimbursement", "reimbursement_stddev", "avg_length_of_stay", "los_stddev",
                           "avg_visit_freq_per_bene", "peer_avg_visit_freq", "peer_visit_freq_stddev"))


@register("serving_peer_stats", O.with_ctes(O.CLAIMS, O.peer_stats()) + f"SELECT {PEER_SERVING_OUT} FROM peer_stats")
def q_serving_peer_stats(spark, sf_dir):
    """K5 (D11): peer stats keyed by (specialty, provider, claim_type)."""
    t = sv.peer_stats_table(feat.compute_peer_group_stats(_claims(spark, sf_dir)))
    return _peer_view(t)


@register("serving_peer_stats_legacy_one_row", O.with_ctes(O.CLAIMS, O.peer_stats()) + f"""
SELECT {PEER_SERVING_OUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY provider_specialty, provider_id ORDER BY claim_type DESC) AS rn
  FROM peer_stats) WHERE rn = 1""")
def q_serving_peer_stats_legacy_one_row(spark, sf_dir):
    """D11 legacy view: one row per (specialty, provider), last claim_type wins."""
    t = sv.peer_stats_table(feat.compute_peer_group_stats(_claims(spark, sf_dir)))
    return _peer_view(sv.peer_stats_legacy_one_row(t))


@register("serving_beneficiary_profile",
          O.with_ctes(O.CLAIMS, O.beneficiaries(CHRONIC_CONDITIONS)) +
          "SELECT beneficiary_id, birth_year, '[' || concat_ws(',', list_transform("
          "string_split(nullif(chronic_conditions, ''), '|'), lambda x: '\"' || x || '\"')) || ']' "
          "AS chronic_conditions, claim_count_ytd FROM bene_profile")
def q_serving_beneficiary_profile(spark, sf_dir):
    """K6: beneficiary rows with conditions as JSON text, written in buckets of
    beneficiary_id, read back."""
    bene = ad.raw_beneficiaries_from_tpch(spark, sf_dir)
    p = build_beneficiary_profiles(bene, _claims(spark, sf_dir))
    return sv.write_beneficiaries(sv.beneficiary_table(p))


@register("lookup_positive_claims_by_id", SERVING_LABELED +
          f"\nSELECT {O.SERVING_CLAIM_OUT} FROM labeled_s WHERE label = 1")
def q_lookup_positive_claims_by_id(spark, sf_dir):
    """S6 as batched point reads: the stored id-keyed table probed with every
    positive claim id (left semi join)."""
    labeled = _labeled(spark, sf_dir)
    table = sv.write_claims_by_id(sv.claims_by_id(labeled))
    return _serving_claim_view(sv.lookup_claims(table, labeled.where(F.col("label") == 1)))


@register("lookup_beneficiaries_of_positives",
          SERVING_LABELED.rstrip() + "," + O.beneficiaries(CHRONIC_CONDITIONS).strip("\n") +
          "\nSELECT beneficiary_id, birth_year, claim_count_ytd FROM bene_profile "
          "WHERE beneficiary_id IN (SELECT beneficiary_id FROM labeled_s WHERE label = 1)")
def q_lookup_beneficiaries_of_positives(spark, sf_dir):
    """Rows of the stored beneficiary table for the beneficiaries of positive
    claims."""
    claims = _claims(spark, sf_dir)
    labeled = _labeled(spark, sf_dir, ["beneficiary_id", "claim_type", *FEATURE_COLS], claims)
    bene = ad.raw_beneficiaries_from_tpch(spark, sf_dir)
    p = sv.write_beneficiaries(sv.beneficiary_table(build_beneficiary_profiles(bene, claims)))
    return sv.lookup_beneficiaries(p, labeled.where(F.col("label") == 1)).select(
        "beneficiary_id", "birth_year", "claim_count_ytd")


# --- evaluation: split, curves, metrics --------------------------------------------
EVAL_SQL = CALIBRATED.rstrip() + "," + O.evaluation("labeled").strip("\n")


#: What the split, the scores and the model read of a claim.
MODEL_COLUMNS = ["claim_id", "claim_type", *FEATURE_COLS]


def _eval_split(spark: SparkSession, sf_dir: str, labeled: DataFrame | None = None) -> DataFrame:
    """Calibrated labels + heuristic score (rounded to 6 places) + M1 split."""
    labeled = labeled if labeled is not None else _labeled(spark, sf_dir, MODEL_COLUMNS)
    s = sc.score_claims(labeled).select("claim_id", "label", F.round("score", 6).alias("score"))
    return write_table(ml.stratified_split(s), "eval_split")


def _test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eval_split(spark, sf_dir).where(F.col("split") == "test").select("label", "score")


@register("stratified_split_counts", EVAL_SQL + """
SELECT split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive, round(avg(label), 6) AS positive_rate
FROM split GROUP BY split
UNION ALL SELECT 'all', count(*), CAST(sum(label) AS BIGINT), round(avg(label), 6) FROM split""")
def q_stratified_split_counts(spark, sf_dir):
    """M1/W5 + A25: exact per-label 80/20 split by md5(claim_id)."""
    return ml.split_counts(_eval_split(spark, sf_dir)).select("split", "n_rows", "n_positive", r6("positive_rate"))


@register("stratified_split_members", EVAL_SQL + "\nSELECT claim_id, label, split FROM split")
def q_stratified_split_members(spark, sf_dir):
    """M1: which claims are in the test set."""
    return _eval_split(spark, sf_dir).select("claim_id", "label", "split")


@register("pr_curve", EVAL_SQL + """
SELECT threshold, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr
UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT), 1.0, 0.0""")
def q_pr_curve(spark, sf_dir):
    """PR curve points on the test split (exact distributed prefix sums)."""
    return met.pr_curve(_test(spark, sf_dir)).select("threshold", "tp", "fp", r6("precision"), r6("recall"))


@register("roc_curve", EVAL_SQL + """
SELECT threshold, round(coalesce(CAST(fp AS DOUBLE) / nullif(N, 0), 0.0), 6) AS fpr,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0.0), 6) AS tpr FROM cum CROSS JOIN tot
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def q_roc_curve(spark, sf_dir):
    """M8: ROC curve points on the test split."""
    return met.roc_curve(_test(spark, sf_dir)).select("threshold", r6("fpr"), r6("tpr"))


@register("average_precision", EVAL_SQL + """
SELECT round(sum(CAST(pos AS DOUBLE) / P * (CAST(tp AS DOUBLE) / (tp + fp))), 6) AS average_precision
FROM cum CROSS JOIN tot""")
def q_average_precision(spark, sf_dir):
    """Average precision (step-wise sum)."""
    return met.average_precision(_test(spark, sf_dir)).select(r6("average_precision"))


@register("roc_auc", EVAL_SQL + """
SELECT round(sum(pos * (N - fp + neg * 0.5)) / (any_value(P) * any_value(N)), 6) AS roc_auc FROM cum CROSS JOIN tot""")
def q_roc_auc(spark, sf_dir):
    """ROC-AUC by rank sum with half credit for ties."""
    return met.roc_auc(_test(spark, sf_dir)).select(r6("roc_auc"))


@register("threshold_for_recall", EVAL_SQL + """
SELECT p.threshold, round(p.precision, 6) AS precision, round(p.recall, 6) AS recall
FROM pr p JOIN chosen_thr c ON p.threshold = c.threshold""")
def q_threshold_for_recall(spark, sf_dir):
    """Highest precision with recall ≥ 0.9, ties to the lowest threshold."""
    t = met.choose_threshold_for_recall(met.pr_curve(_test(spark, sf_dir)), 0.9)
    return t.select("threshold", r6("precision"), r6("recall"))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = _test(spark, sf_dir)
    from ..session import materialize
    test = materialize(test)
    thr = met.choose_threshold_for_recall(met.pr_curve(test), 0.9).select("threshold").scalar()
    return test.withColumn("threshold", thr).withColumn("prediction", sc.predict_label(F.col("score"), thr))


@register("confusion_and_metrics", EVAL_SQL + """
SELECT tn, fp, fn, tp, threshold, round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6) AS accuracy,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 6) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 6) AS recall,
       round(coalesce(2 * coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0)
                        * coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0)
                      / nullif(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0)
                               + coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 0), 0.0), 6) AS f1
FROM cm""")
def q_confusion_and_metrics(spark, sf_dir):
    """P35 + A19 + A20: predictions at the tuned threshold, confusion matrix,
    accuracy / precision / recall / F1."""
    p = _predictions(spark, sf_dir)
    m = met.binary_metrics(p)
    thr = p.select(F.max("threshold")).scalar()
    return m.select("tn", "fp", "fn", "tp", thr.alias("threshold"), r6("accuracy"), r6("precision"),
                    r6("recall"), r6("f1"))


@register("classification_report", EVAL_SQL + """,
prf AS (
  SELECT coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0.0) AS p0,
         coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0) AS r0,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS p1,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS r1,
         tn + fp AS s0, tp + fn AS s1, tp + tn + fp + fn AS tot, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS acc
  FROM cm),
prf2 AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0.0) AS f0,
                   coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0.0) AS f1 FROM prf)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM prf2
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM prf2
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot FROM prf2
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / tot, (r0 * s0 + r1 * s1) / tot, (f0 * s0 + f1 * s1) / tot, tot
            FROM prf2
  UNION ALL SELECT 'accuracy', acc, acc, acc, tot FROM prf2)""")
def q_classification_report(spark, sf_dir):
    """Per-class report with macro and weighted averages."""
    r = met.classification_report(_predictions(spark, sf_dir))
    return r.select("class", r6("precision"), r6("recall"), r6("f1"), F.col("support").cast("long").alias("support"))


@register("no_skill_rate", EVAL_SQL + "\nSELECT round(avg(label), 6) AS no_skill_rate FROM test")
def q_no_skill_rate(spark, sf_dir):
    """M8: the no-skill precision line of the PR plot."""
    return met.no_skill_rate(_test(spark, sf_dir)).select(r6("no_skill_rate"))


# --- summaries ---------------------------------------------------------------------
from ..operators import summaries as sm  # noqa: E402


@register("claims_per_type", O.with_ctes(O.CLAIMS) +
          "SELECT claim_type, count(*) AS n_rows FROM claims GROUP BY claim_type")
def q_claims_per_type(spark, sf_dir):
    """Claims per type."""
    return sm.category_counts(_claims(spark, sf_dir), "claim_type", None)


@register("top_specialties", O.with_ctes(O.CLAIMS) +
          "SELECT provider_specialty, count(*) AS n_rows FROM claims GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def q_top_specialties(spark, sf_dir):
    """The ten most frequent specialties (a top-k report)."""
    return sm.category_counts(_claims(spark, sf_dir), "provider_specialty", 10)


@register("describe_reimbursement", O.with_ctes(O.CLAIMS) + """
SELECT count(reimbursement_amt) AS count, round(avg(reimbursement_amt), 6) AS mean,
       round(stddev_samp(reimbursement_amt), 6) AS std, round(min(reimbursement_amt), 6) AS min,
       round(quantile_cont(reimbursement_amt, 0.25), 6) AS p25, round(quantile_cont(reimbursement_amt, 0.5), 6) AS p50,
       round(quantile_cont(reimbursement_amt, 0.75), 6) AS p75, round(max(reimbursement_amt), 6) AS max
FROM claims""")
def q_describe_reimbursement(spark, sf_dir):
    """describe() of the amount with exact quartiles."""
    d = sm.describe_amount(_claims(spark, sf_dir))
    return d.select("count", *[r6(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("feature_summary", FEATURE_CHAIN + """,
long AS (
  SELECT unnest(['reimbursement_zscore', 'los_zscore', 'visit_frequency_zscore', 'code_severity_percentile']) AS feature,
         unnest([reimbursement_zscore, los_zscore, visit_frequency_zscore, CAST(code_severity_percentile AS DOUBLE)])
           AS value
  FROM featured)
SELECT feature, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(quantile_cont(value, 0.95), 6) AS p95 FROM long GROUP BY feature""")
def q_feature_summary(spark, sf_dir):
    """Mean, std and p95 of the four z/percentile features."""
    features = write_table(_featured(spark, sf_dir).select(*FEATURE_COLS[:4]), "features")
    return sm.feature_summary(features).select("feature", r6("mean"), r6("std"), r6("p95"))


@register("distinct_counts", O.with_ctes(O.CLAIMS, O.codes()) + """
SELECT (SELECT count(DISTINCT provider_specialty) FROM claims) AS n_specialties,
       (SELECT count(DISTINCT provider_id) FROM claims) AS n_providers,
       (SELECT count(DISTINCT code) FROM code_occ) AS n_codes""")
def q_distinct_counts(spark, sf_dir):
    """Distinct specialties, providers and codes."""
    return sm.distinct_counts(_claims(spark, sf_dir))


# --- model (rows-only: no SQL oracle for a fitted GBT) ---------------------------------
@register("gbt_model_report")
def q_gbt_model_report(spark, sf_dir):
    """Boosted trees (200 rounds, rate 0.1, depth 5, balanced class
    weights) on the resampled train split; the run's tables are written for the
    test split and read back: metrics and permutation importances (10 repeats)."""
    s = write_step(ml.stratified_split(_labeled(spark, sf_dir, MODEL_COLUMNS)), "split")
    model = ml.train_on_resampled(s.where(F.col("split") == "train"))
    path = scratch_path(spark, "model_run")
    ml.write_model_run(model, s.where(F.col("split") == "test"), path)
    return ml.read_model_run(spark, path).select("kind", "name", "value", "rank")


# --- end-to-end batch plan and stream-to-stream flow ---------------------------------
from . import batch  # noqa: E402

BATCH_SQL = O.with_ctes(O.INGEST, O.INGEST_CLAIMS, O.peer_stats("claims"), O.codes("claims"),
                        O.featured("claims", DRIVER_HIGH_SEV_CUT)).rstrip() + "," + \
    O.calibration(**CAL_ARGS).strip("\n") + "," + \
    O.labeled("ch.t", "ch.k", extra_from="CROSS JOIN chosen ch", extra_cols=" ch.t, ch.k, ch.in_band,").strip("\n") + \
    f"\nSELECT {LABEL_OUT} FROM labeled"


@register("batch_build_and_label", BATCH_SQL)
def q_batch_build_and_label(spark, sf_dir):
    """K1 + K2 end to end: raw CSVs → normalized (rejects split off) →
    features, peer stats, profiles written → calibrated labels written; the
    labeled table is read back."""
    base = write_raw_csvs(spark, sf_dir)
    out = scratch_path(spark, "batch_out")
    built = batch.build_dataset(spark, base, out, feat.FeatureParams(high_sev_cut=DRIVER_HIGH_SEV_CUT))
    batch.label_claims(spark, built.featured, f"{out}/claims_labeled.parquet")
    return _label_view(spark.read.parquet(f"{out}/claims_labeled.parquet"))


@register("scoring_to_audit_stream", FLAG_CHAIN + f"""
SELECT '{FLAG_DAY}' AS flag_date, round(s.score, 6) AS score, s.claim_id, s.provider_id,
       '["' || replace(d.driver_features, '|', '","') || '"]' AS driver_features
FROM scored s JOIN drivers d USING (claim_id) WHERE s.flagged""")
def q_scoring_to_audit_stream(spark, sf_dir):
    """X1 → K8 → X2: the scoring stream publishes flag events into a folder,
    the audit stream consumes that folder into the audit table."""
    peer, f = _peers_and_featured(spark, sf_dir)
    req_dir = write_requests(f, scratch_path(spark, "score_requests"))
    events = scratch_path(spark, "flag_events")
    ss.run_scoring_stream(spark, req_dir, peer, scratch_path(spark, "score_out"), events,
                          scratch_path(spark, "score_ckpt"), FLAG_AT, *_flag_clock())
    table = scratch_path(spark, "audit_table")
    au.run_audit_stream(spark, events, table, scratch_path(spark, "audit_ckpt"),
                        options={"recursiveFileLookup": "true"})
    return _audit_view(au.read_audit_table(spark, table))


@register("audit_stream_batch_counts", O.with_ctes(O.EVENT_ROWS) + """
SELECT CAST(count(*) AS BIGINT) AS processed,
       CAST(sum(CASE WHEN reject_reason IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS errors
FROM event_rows""")
def q_audit_stream_batch_counts(spark, sf_dir):
    """Processed and error totals of the audit stream, from the per-batch
    counts the sink records."""
    src = _write_messages(spark, sf_dir)
    table = scratch_path(spark, "audit_table")
    au.run_audit_stream(spark, src, table, scratch_path(spark, "audit_ckpt"))
    c = au.read_audit_counts(spark, table)
    return c.agg(F.sum("processed").cast("long").alias("processed"), F.sum("errors").cast("long").alias("errors"))


@register("smote_enn_resample")
def q_smote_enn_resample(spark, sf_dir):
    """M2 + M3: SMOTE of the training minority to parity (5 neighbours), then
    ENN cleaning (3 neighbours, all classes) with the exact distributed kNN;
    rows per (stage, label)."""
    from ..operators import resample
    s = write_step(ml.stratified_split(_labeled(spark, sf_dir, MODEL_COLUMNS)), "split")
    train = s.where(F.col("split") == "train")
    sm_df = write_step(resample.smote(train), "smote")
    cleaned = resample.enn(sm_df)
    stage = lambda df, name: df.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(F.lit(name).alias("stage"), "label", "n_rows")
    return stage(train, "train").unionByName(stage(sm_df, "smote")).unionByName(stage(cleaned, "smote_enn"))


@register("scored_with_stored_threshold", EVAL_SQL + """,
sc_all AS (SELECT claim_id, """ + O.SCORE_EXPR + """ AS score FROM labeled)
SELECT s.claim_id, round(s.score, 6) AS score, s.score >= c.threshold AS flagged, c.threshold
FROM sc_all s CROSS JOIN chosen_thr c""")
def q_scored_with_stored_threshold(spark, sf_dir):
    """P34 + K10 + T6: the recall-tuned threshold is written as text (the
    model's threshold file), read back with the 0.5 fallback, and used to
    flag every labeled claim."""
    labeled = _labeled(spark, sf_dir, MODEL_COLUMNS)
    test = _eval_split(spark, sf_dir, labeled).where(F.col("split") == "test").select("label", "score")
    thr = met.choose_threshold_for_recall(met.pr_curve(test), 0.9).select("threshold").first()["threshold"]
    path = scratch_path(spark, "threshold_txt")
    sc.write_threshold(spark, thr, path)
    scored = sc.score_claims(labeled, sc.read_threshold(spark, path))
    return scored.select("claim_id", r6("score"), "flagged", "threshold")


from . import stored  # noqa: E402, F401  (queries over stored tables and changing streams)
