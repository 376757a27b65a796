"""DuckDB SQL that computes the same results as the registered Spark queries.

Written independently of the Spark code paths, as the correctness oracle: the
driver runs each string against the same Parquet tables (pre-registered views)
and compares rows, schema and values. Doubles are rounded to 6 places, dates
and lists are rendered as text on both sides.
"""

from __future__ import annotations

# --- claims adapter (FIXTURES.md B1) -----------------------------------------
CLAIMS = """
claims_raw AS (
  SELECT
    concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
              CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR)) AS claim_id,
    'BENE' || CAST(o.o_custkey AS VARCHAR) AS beneficiary_id,
    'PRV' || CAST(l.l_suppkey AS VARCHAR) AS provider_id,
    r.r_name AS provider_specialty,
    CASE l.l_returnflag WHEN 'A' THEN 'inpatient' WHEN 'N' THEN 'outpatient'
                        WHEN 'R' THEN 'carrier' END AS claim_type,
    CAST(o.o_orderdate AS DATE) AS claim_start_date,
    CAST(l.l_shipdate AS DATE) AS claim_end_date,
    CAST(year(o.o_orderdate) AS INTEGER) AS claim_year,
    p.p_brand AS admit_diagnosis_cd,
    [p.p_brand, p.p_type] AS diagnosis_codes,
    CASE WHEN l.l_linenumber = 1 THEN CAST([] AS VARCHAR[])
         ELSE ['Q' || CAST(CAST(floor(l.l_quantity / 10) AS BIGINT) AS VARCHAR),
               'D' || CAST(CAST(round(l.l_discount * 100) AS BIGINT) AS VARCHAR)]
    END AS procedure_codes,
    CAST((CAST(round(l.l_extendedprice * 100) AS BIGINT) * CAST(round(l.l_discount * 100) AS BIGINT) + 50)
         // 100 AS DOUBLE) / 100.0 AS reimbursement_amt,
    CAST(CASE WHEN l.l_returnflag = 'A'
              THEN greatest(0, date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)))
              ELSE 0 END AS INTEGER) AS length_of_stay_days
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
claims AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY
      claim_start_date DESC NULLS LAST, claim_end_date DESC NULLS LAST, reimbursement_amt DESC NULLS LAST,
      length_of_stay_days DESC NULLS LAST, beneficiary_id ASC NULLS LAST, provider_id ASC NULLS LAST,
      claim_type ASC NULLS LAST, provider_specialty ASC NULLS LAST) AS rn
    FROM claims_raw) WHERE rn = 1
)"""


def _std(c: str) -> str:
    return f"CASE WHEN max({c}) = min({c}) THEN 0.0 ELSE stddev_samp({c}) END"


def peer_stats(src: str = "claims", baseline: str = "provider") -> str:
    """CTEs ending in ``peer_stats`` (one row per specialty, type, provider)."""
    if baseline == "provider":
        pstats = f"""
pstats AS (
  SELECT provider_specialty, claim_type, provider_id, count(claim_id) AS n_claims,
         avg(reimbursement_amt) AS avg_reimbursement, {_std('reimbursement_amt')} AS reimbursement_stddev,
         avg(length_of_stay_days) AS avg_length_of_stay, {_std('length_of_stay_days')} AS los_stddev
  FROM {src} GROUP BY provider_specialty, claim_type, provider_id)"""
    else:
        pstats = f"""
pgrp AS (
  SELECT provider_specialty, claim_type,
         avg(reimbursement_amt) AS avg_reimbursement, {_std('reimbursement_amt')} AS reimbursement_stddev,
         avg(length_of_stay_days) AS avg_length_of_stay, {_std('length_of_stay_days')} AS los_stddev
  FROM {src} GROUP BY provider_specialty, claim_type),
pcnt AS (
  SELECT provider_specialty, claim_type, provider_id, count(claim_id) AS n_claims
  FROM {src} GROUP BY provider_specialty, claim_type, provider_id),
pstats AS (
  SELECT pcnt.*, pgrp.avg_reimbursement, pgrp.reimbursement_stddev, pgrp.avg_length_of_stay, pgrp.los_stddev
  FROM pcnt JOIN pgrp USING (provider_specialty, claim_type))"""
    return f"""
visits AS (
  SELECT beneficiary_id, provider_id, claim_year, count(*) AS visit_count
  FROM {src} GROUP BY beneficiary_id, provider_id, claim_year),
pvf AS (
  SELECT provider_id, avg(visit_count) AS avg_visit_freq_per_bene FROM visits GROUP BY provider_id),{pstats},
s1 AS (SELECT pstats.*, pvf.avg_visit_freq_per_bene FROM pstats LEFT JOIN pvf USING (provider_id)),
peer AS (
  SELECT provider_specialty, claim_type, avg(avg_visit_freq_per_bene) AS peer_avg_visit_freq,
         {_std('avg_visit_freq_per_bene')} AS peer_visit_freq_stddev
  FROM s1 GROUP BY provider_specialty, claim_type),
s2 AS (SELECT s1.*, peer.peer_avg_visit_freq, peer.peer_visit_freq_stddev
       FROM s1 JOIN peer USING (provider_specialty, claim_type)),
meds AS (
  SELECT median(nullif(reimbursement_stddev, 0)) AS m_r, median(nullif(los_stddev, 0)) AS m_l,
         median(nullif(peer_visit_freq_stddev, 0)) AS m_v FROM s2),
peer_stats AS (
  SELECT provider_specialty, provider_id, claim_type, n_claims, avg_reimbursement,
         coalesce(nullif(reimbursement_stddev, 0), m_r) AS reimbursement_stddev,
         avg_length_of_stay, coalesce(nullif(los_stddev, 0), m_l) AS los_stddev,
         avg_visit_freq_per_bene, peer_avg_visit_freq,
         coalesce(nullif(peer_visit_freq_stddev, 0), m_v) AS peer_visit_freq_stddev
  FROM s2 CROSS JOIN meds)"""


def codes(src: str = "claims") -> str:
    """CTEs: code occurrences, weights, percentiles, severity, claim severity,
    provider high-severity share."""
    return f"""
code_occ0 AS (
  SELECT claim_id, provider_id, reimbursement_amt,
         unnest(list_concat(coalesce(diagnosis_codes, CAST([] AS VARCHAR[])),
                            coalesce(procedure_codes, CAST([] AS VARCHAR[])))) AS code
  FROM {src}),
code_occ AS (SELECT * FROM code_occ0 WHERE code IS NOT NULL AND trim(code) <> ''),
weights AS (
  SELECT code, avg(reimbursement_amt) AS avg_reimbursement, count(*) AS n_occurrences
  FROM code_occ GROUP BY code),
pcts AS (
  SELECT quantile_cont(avg_reimbursement, 0.5) AS p50, quantile_cont(avg_reimbursement, 0.9) AS p90
  FROM weights),
sev AS (
  SELECT w.code, w.avg_reimbursement,
         CASE WHEN p90 > p50 THEN least(1.0, greatest(0.0, (w.avg_reimbursement - p50) / (p90 - p50)))
              ELSE 0.5 END AS severity,
         w.avg_reimbursement >= p90 AS is_high_severity
  FROM weights w CROSS JOIN pcts),
claim_sev AS (
  SELECT o.claim_id, max(s.severity) AS sev FROM code_occ o JOIN sev s USING (code) GROUP BY o.claim_id),
share AS (
  SELECT o.provider_id,
         CAST(sum(CASE WHEN s.is_high_severity THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS high_severity_code_pct
  FROM code_occ o LEFT JOIN sev s USING (code) GROUP BY o.provider_id)"""


def featured(src: str = "claims", high_sev_cut: float = 0.3, severity_cut: float = 0.9) -> str:
    """CTE ``featured``: claim columns + the six features. Needs peer_stats(),
    codes() and visits (from peer_stats) before it."""
    return f"""
featured0 AS (
  SELECT c.*,
    coalesce((c.reimbursement_amt - ps.avg_reimbursement) / ps.reimbursement_stddev, 0.0) AS reimbursement_zscore,
    CASE WHEN c.claim_type = 'inpatient'
         THEN coalesce((c.length_of_stay_days - ps.avg_length_of_stay) / ps.los_stddev, 0.0)
         ELSE 0.0 END AS los_zscore,
    coalesce((coalesce(v.visit_count, 1) - ps.peer_avg_visit_freq) / ps.peer_visit_freq_stddev, 0.0)
      AS visit_frequency_zscore,
    coalesce(cs.sev, 0.0) AS code_severity_percentile,
    coalesce(sh.high_severity_code_pct, 0.0) AS high_severity_code_pct
  FROM {src} c
  LEFT JOIN peer_stats ps USING (provider_specialty, claim_type, provider_id)
  LEFT JOIN visits v USING (beneficiary_id, provider_id, claim_year)
  LEFT JOIN claim_sev cs USING (claim_id)
  LEFT JOIN share sh USING (provider_id)),
featured AS (
  SELECT *, CAST(code_severity_percentile >= {severity_cut} AND high_severity_code_pct > {high_sev_cut}
                 AS INTEGER) AS code_severity_outlier
  FROM featured0)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


def feature_chain(high_sev_cut: float = 0.3, baseline: str = "provider") -> str:
    return with_ctes(CLAIMS, peer_stats("claims", baseline), codes("claims"), featured("claims", high_sev_cut))


R6 = "round({c}, 6) AS {c}"


def r6(*cols: str) -> str:
    return ", ".join(R6.format(c=c) for c in cols)


FEATURE_OUT = ("claim_id, beneficiary_id, provider_id, provider_specialty, claim_type, "
               "strftime(claim_start_date, '%Y-%m-%d') AS claim_start_date, claim_year, "
               "array_to_string(diagnosis_codes, '|') AS diagnosis_codes, "
               "array_to_string(procedure_codes, '|') AS procedure_codes, "
               "round(reimbursement_amt, 6) AS reimbursement_amt, length_of_stay_days, "
               + r6("reimbursement_zscore", "los_zscore", "visit_frequency_zscore",
                    "code_severity_percentile", "high_severity_code_pct") + ", code_severity_outlier")


# --- labels ------------------------------------------------------------------
def _sig_sum(t: str) -> str:
    return (f"(CAST(reimbursement_zscore > {t} AS INTEGER)"
            f" + CAST(claim_type = 'inpatient' AND los_zscore > {t} AS INTEGER)"
            f" + CAST(visit_frequency_zscore > {t} AS INTEGER)"
            f" + CAST(code_severity_outlier = 1 AS INTEGER))")


def _reasons(t: str) -> str:
    return (f"concat_ws('|', CASE WHEN reimbursement_zscore > {t} THEN 'reimbursement_zscore' END,"
            f" CASE WHEN claim_type = 'inpatient' AND los_zscore > {t} THEN 'los_zscore' END,"
            f" CASE WHEN visit_frequency_zscore > {t} THEN 'visit_frequency_zscore' END,"
            f" CASE WHEN code_severity_outlier = 1 THEN 'code_severity_outlier' END)")


def labeled(t: str = "2.5", k: str = "2", src: str = "featured", extra_from: str = "",
            extra_cols: str = "") -> str:
    """CTE ``labeled``: featured + label_reasons (text, '|') + n_signals + label.
    ``t``/``k`` may be literals or columns of ``extra_from``."""
    return f"""
labeled AS (
  SELECT f.*,{extra_cols} {_reasons(t)} AS label_reasons, {_sig_sum(t)} AS n_signals,
         CAST({_sig_sum(t)} >= {k} AS INTEGER) AS label
  FROM {src} f {extra_from})"""


def calibration(ks: list[int], thresholds: list[float], coarse_k2: list[float], coarse_k3: list[float],
                deltas: list[float], min_signals: int = 2, target: float = 0.025, lo: float = 0.02,
                hi: float = 0.03, fine_min: float = 1.5) -> str:
    """CTEs ``grid`` (brute force rates for every candidate) and ``chosen``
    (the sequential search rule written as set logic)."""
    cand = ", ".join(f"({k}, CAST({t!r} AS DOUBLE), {round(t * 100)})" for k in ks for t in thresholds)
    seq = ", ".join([f"(1, {i}, {min_signals}, CAST({t!r} AS DOUBLE), {round(t * 100)})"
                     for i, t in enumerate(coarse_k2)]
                    + [f"(2, {i}, 3, CAST({t!r} AS DOUBLE), {round(t * 100)})" for i, t in enumerate(coarse_k3)])
    dl = ", ".join(f"({i}, {round(d * 100)})" for i, d in enumerate(deltas))
    return f"""
cand AS (SELECT * FROM (VALUES {cand}) AS g(min_signals, threshold, tc)),
grid AS (
  SELECT g.min_signals, g.threshold, g.tc,
         sum(CASE WHEN {_sig_sum('g.threshold')} >= g.min_signals THEN 1 ELSE 0 END) AS n_positive,
         count(*) AS n_claims
  FROM featured CROSS JOIN cand g GROUP BY g.min_signals, g.threshold, g.tc),
seq AS (SELECT * FROM (VALUES {seq}) AS s(phase, ord, k, t, tc)),
g1 AS (SELECT s.phase, s.ord, s.k, s.t, s.tc, CAST(gr.n_positive AS DOUBLE) / gr.n_claims AS r
       FROM seq s JOIN grid gr ON gr.min_signals = s.k AND gr.tc = s.tc),
hit1 AS (SELECT * FROM g1 WHERE phase = 1 AND r BETWEEN {lo} AND {hi} ORDER BY ord LIMIT 1),
best1 AS (SELECT * FROM g1 WHERE phase = 1 ORDER BY abs(r - {target}), ord LIMIT 1),
go2 AS (SELECT r > {hi} AS go FROM best1),
hit2 AS (SELECT * FROM g1 WHERE phase = 2 AND (SELECT go FROM go2) AND r BETWEEN {lo} AND {hi}
         ORDER BY ord LIMIT 1),
best AS (SELECT * FROM g1 WHERE phase = 1 OR (phase = 2 AND (SELECT go FROM go2))
         ORDER BY abs(r - {target}), phase, ord LIMIT 1),
deltas AS (SELECT * FROM (VALUES {dl}) AS d(ord, dc)),
fine AS (SELECT d.ord, b.tc + d.dc AS tc, b.k FROM best b CROSS JOIN deltas d),
hit3 AS (SELECT gr.threshold AS t, f.k, CAST(gr.n_positive AS DOUBLE) / gr.n_claims AS r
         FROM fine f JOIN grid gr ON gr.min_signals = f.k AND gr.tc = f.tc
         WHERE f.tc >= {round(fine_min * 100)}
           AND CAST(gr.n_positive AS DOUBLE) / gr.n_claims BETWEEN {lo} AND {hi}
         ORDER BY f.ord LIMIT 1),
chosen AS (
  SELECT * FROM (
    SELECT 1 AS pri, t, k, r, true AS in_band FROM hit1
    UNION ALL SELECT 2, t, k, r, true FROM hit2
    UNION ALL SELECT 3, t, k, r, true FROM hit3
    UNION ALL SELECT 4, t, k, r, false FROM best) ORDER BY pri LIMIT 1)"""


# --- raw-file ingest (FIXTURES.md B2 dirt rules) ------------------------------
LINES = """
lines AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, r.r_name, p.p_brand, p.p_type,
         CAST(o.o_orderdate AS DATE) AS d_start, CAST(l.l_shipdate AS DATE) AS d_end,
         concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                   CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR)) AS cid,
         CASE l.l_returnflag WHEN 'A' THEN 'inpatient' WHEN 'N' THEN 'outpatient'
                             WHEN 'R' THEN 'carrier' END AS ctype,
         CAST((CAST(round(l.l_extendedprice * 100) AS BIGINT) * CAST(round(l.l_discount * 100) AS BIGINT) + 50)
              // 100 AS DOUBLE) / 100.0 AS amt
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

INGEST = LINES + """,
spec_map AS (
  SELECT 'PRV' || CAST(l_suppkey AS VARCHAR) AS provider_id,
         arg_min(r_name, CASE WHEN l_quantity = 13 THEN '' ELSE cid END || '|' || r_name) AS mapped_specialty
  FROM lines WHERE ctype = 'carrier' AND l_quantity <> 17 AND l_linenumber <> 2
  GROUP BY 1),
norm AS (
  SELECT
    CASE WHEN l_quantity = 13 THEN NULL ELSE cid END AS claim_id,
    CASE WHEN l_quantity = 19 THEN NULL ELSE 'BENE' || CAST(o_custkey AS VARCHAR) END AS beneficiary_id,
    CASE WHEN l_quantity = 17 THEN NULL ELSE 'PRV' || CAST(l_suppkey AS VARCHAR) END AS provider_id,
    ctype AS claim_type,
    CASE WHEN l_quantity = 41 THEN NULL
         WHEN l_quantity = 37 THEN CAST(date_trunc('month', d_start) AS DATE) ELSE d_start END AS claim_start_date,
    d_end AS claim_end_date,
    p_brand AS admit_diagnosis_cd,
    p_brand || '|' || p_type AS diagnosis_codes,
    CASE WHEN l_linenumber = 1 THEN ''
         ELSE 'Q' || CAST(CAST(floor(l_quantity / 10) AS BIGINT) AS VARCHAR) || '|D'
              || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END AS procedure_codes,
    CASE WHEN l_quantity IN (29, 31) THEN 0.0 ELSE amt END AS reimbursement_amt,
    CASE WHEN ctype <> 'inpatient' THEN 0
         WHEN l_linenumber = 3 THEN greatest(0, date_diff('day',
              CASE WHEN l_quantity = 37 THEN CAST(date_trunc('month', d_start) AS DATE) ELSE d_start END, d_end))
         ELSE greatest(0, date_diff('day', d_start, d_end)) END AS length_of_stay_days,
    CASE WHEN ctype = 'carrier' AND l_linenumber <> 2 THEN r_name END AS own_specialty,
    CASE WHEN l_quantity IN (13, 17, 19) THEN 'dropped' WHEN l_quantity = 41 THEN 'malformed' END AS reject_reason,
    [p_brand, p_type] AS dx_list,
    CASE WHEN l_linenumber = 1 THEN CAST([] AS VARCHAR[])
         ELSE ['Q' || CAST(CAST(floor(l_quantity / 10) AS BIGINT) AS VARCHAR),
               'D' || CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR)] END AS px_list
  FROM lines),
normalized AS (
  SELECT norm.*, coalesce(own_specialty, m.mapped_specialty, 'Unknown') AS provider_specialty
  FROM norm LEFT JOIN spec_map m USING (provider_id))"""

INGEST_OUT = ("claim_id, beneficiary_id, provider_id, provider_specialty, claim_type, "
              "strftime(claim_start_date, '%Y-%m-%d') AS claim_start_date, "
              "strftime(claim_end_date, '%Y-%m-%d') AS claim_end_date, "
              "CAST(year(claim_start_date) AS INTEGER) AS claim_year, admit_diagnosis_cd, diagnosis_codes, "
              "procedure_codes, round(reimbursement_amt, 6) AS reimbursement_amt, "
              "CAST(length_of_stay_days AS INTEGER) AS length_of_stay_days")


def beneficiaries(conditions: list[str]) -> str:
    """CTE ``bene`` with the adapter's rules, and ``bene_profile`` (needs claims)."""
    rules = ["c_mktsegment = 'AUTOMOBILE'", "c_acctbal < 0", "c_mktsegment = 'BUILDING'",
             "c_mktsegment = 'FURNITURE'", "c_mktsegment = 'HOUSEHOLD'", "c_mktsegment = 'MACHINERY'",
             "c_acctbal > 5000", "c_acctbal < 1000", "c_nationkey < 5", "c_nationkey > 20"]
    by_name = dict(zip(conditions, rules))
    parts = ", ".join(f"CASE WHEN {by_name[n]} THEN '{n}' END" for n in sorted(conditions))
    return f"""
bene AS (
  SELECT 'BENE' || CAST(c_custkey AS VARCHAR) AS beneficiary_id,
         CASE WHEN c_acctbal < 0 AND c_mktsegment = 'MACHINERY' THEN 1940
              ELSE CAST(1930 + c_custkey % 41 AS INTEGER) END AS birth_year,
         concat_ws('|', {parts}) AS chronic_conditions
  FROM customer),
per_year AS (SELECT beneficiary_id, claim_year, count(*) AS n FROM claims GROUP BY 1, 2),
latest AS (SELECT beneficiary_id, arg_max(n, claim_year) AS claim_count_ytd FROM per_year GROUP BY 1),
bene_profile AS (
  SELECT b.beneficiary_id, b.birth_year, b.chronic_conditions,
         CAST(coalesce(l.claim_count_ytd, 0) AS INTEGER) AS claim_count_ytd
  FROM bene b LEFT JOIN latest l USING (beneficiary_id))"""


# --- scoring -----------------------------------------------------------------
DISPLAY = ["'Reimbursement z-score'", "'Length-of-stay z-score'", "'Visit-frequency z-score'",
           "'Code severity percentile'", "'High-severity code %'", "'Code severity outlier'"]
SCORE_EXPR = ("greatest(0.0, least(1.0, abs(reimbursement_zscore) * 0.3 + abs(los_zscore) * 0.2"
              " + abs(visit_frequency_zscore) * 0.2 + code_severity_percentile * 0.15"
              " + high_severity_code_pct / 100.0 * 0.1 + CAST(code_severity_outlier AS DOUBLE) * 0.05))")


def scored(src: str = "featured", threshold: str = "0.5") -> str:
    return f"""
scored AS (
  SELECT s.*, s.score >= {threshold} AS flagged, CAST({threshold} AS DOUBLE) AS threshold
  FROM (SELECT f.*, {SCORE_EXPR} AS score FROM {src} f) s),
drivers AS (
  SELECT claim_id, string_agg(name, '|' ORDER BY v DESC, p) AS driver_features FROM (
    SELECT claim_id, name, v, p, row_number() OVER (PARTITION BY claim_id ORDER BY v DESC, p) AS rn FROM (
      SELECT claim_id,
             unnest([abs(reimbursement_zscore), abs(los_zscore), abs(visit_frequency_zscore),
                     CAST(code_severity_percentile AS DOUBLE), high_severity_code_pct / 100.0,
                     CAST(code_severity_outlier AS DOUBLE)]) AS v,
             unnest([{", ".join(DISPLAY)}]) AS name,
             unnest([0, 1, 2, 3, 4, 5]) AS p
      FROM scored)) WHERE rn <= 3 GROUP BY claim_id)"""


# --- flag events from the events table (FIXTURES.md B2) ------------------------
EVENT_ROWS = """
event_rows AS (
  SELECT CASE WHEN event_type = 'view' AND value < 5 THEN current_date ELSE CAST(ts AS DATE) END AS flag_date,
         least(1.0, value / 200) AS score,
         CASE WHEN event_type = 'signup' AND value < 5 THEN '' ELSE CAST(event_id AS VARCHAR) END AS claim_id,
         CAST(user_id AS VARCHAR) AS provider_id,
         '["' || event_type || '"]' AS driver_features,
         CASE WHEN event_type = 'error' AND value < 5 THEN 'bad_json'
              WHEN event_type = 'signup' AND value < 5 THEN 'empty_claim_id' END AS reject_reason
  FROM events),
audit AS (
  SELECT flag_date, score, claim_id, any_value(provider_id) AS provider_id,
         any_value(driver_features) AS driver_features
  FROM event_rows WHERE reject_reason IS NULL GROUP BY flag_date, score, claim_id)"""

AUDIT_OUT = ("strftime(flag_date, '%Y-%m-%d') AS flag_date, round(score, 6) AS score, claim_id, provider_id, "
             "driver_features")


# --- evaluation split and curves -------------------------------------------------
def evaluation(src: str = "labeled", test_size: float = 0.2) -> str:
    return f"""
ev AS (SELECT claim_id, label, round({SCORE_EXPR}, 6) AS score FROM {src}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(claim_id), claim_id) AS rk,
         count(*) OVER (PARTITION BY label) AS nl FROM ev),
split AS (SELECT *, CASE WHEN rk <= round(nl * {test_size}) THEN 'test' ELSE 'train' END AS split FROM ranked),
test AS (SELECT label, score FROM split WHERE split = 'test'),
cnt AS (SELECT score AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM test GROUP BY score),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM cnt),
cum AS (
  SELECT threshold, pos, neg,
         sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM cnt),
pr AS (
  SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
         coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 1.0) AS recall
  FROM cum CROSS JOIN tot),
chosen_thr AS (
  SELECT threshold FROM (
    SELECT threshold, 0 AS pri, precision FROM pr WHERE recall >= 0.9
    UNION ALL SELECT min(threshold), 1, NULL FROM pr)
  ORDER BY pri, precision DESC, threshold LIMIT 1),
pred AS (SELECT t.label, CAST(t.score >= c.threshold AS INTEGER) AS prediction, c.threshold
         FROM test t CROSS JOIN chosen_thr c),
cm AS (
  SELECT CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         any_value(threshold) AS threshold
  FROM pred)"""


def reasons_json(t: str = "t") -> str:
    return (f"'[' || concat_ws(',', CASE WHEN reimbursement_zscore > {t} THEN '\"reimbursement_zscore\"' END,"
            f" CASE WHEN claim_type = 'inpatient' AND los_zscore > {t} THEN '\"los_zscore\"' END,"
            f" CASE WHEN visit_frequency_zscore > {t} THEN '\"visit_frequency_zscore\"' END,"
            f" CASE WHEN code_severity_outlier = 1 THEN '\"code_severity_outlier\"' END) || ']'")


SERVING_CLAIM_OUT = (
    "claim_id, provider_id, strftime(claim_start_date, '%Y-%m-%d') AS claim_start_date, "
    "strftime(claim_end_date, '%Y-%m-%d') AS claim_end_date, beneficiary_id, provider_specialty, claim_type, "
    "admit_diagnosis_cd, CAST(to_json(diagnosis_codes) AS VARCHAR) AS diagnosis_codes, "
    "CAST(to_json(procedure_codes) AS VARCHAR) AS procedure_codes, round(reimbursement_amt, 6) AS reimbursement_amt, "
    "length_of_stay_days, round(reimbursement_zscore, 6) AS reimbursement_zscore, "
    "round(visit_frequency_zscore, 6) AS visit_frequency_zscore, code_severity_outlier, label, "
    "label_reasons_json AS label_reasons")


# accepted ingest rows as claims (list-typed codes), deduplicated like CLAIMS
INGEST_CLAIMS = """
claims_ing_raw AS (
  SELECT claim_id, beneficiary_id, provider_id, provider_specialty, claim_type, claim_start_date, claim_end_date,
         CAST(year(claim_start_date) AS INTEGER) AS claim_year, admit_diagnosis_cd,
         dx_list AS diagnosis_codes, px_list AS procedure_codes, reimbursement_amt,
         CAST(length_of_stay_days AS INTEGER) AS length_of_stay_days
  FROM normalized WHERE reject_reason IS NULL),
claims AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY
      claim_start_date DESC NULLS LAST, claim_end_date DESC NULLS LAST, reimbursement_amt DESC NULLS LAST,
      length_of_stay_days DESC NULLS LAST, beneficiary_id ASC NULLS LAST, provider_id ASC NULLS LAST,
      claim_type ASC NULLS LAST, provider_specialty ASC NULLS LAST) AS rn
    FROM claims_ing_raw) WHERE rn = 1)"""
