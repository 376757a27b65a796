"""Schemas, column lists and display names.

Fixed values below must equal the reference's for right results; they are
stated plainly, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

CLAIM_FILES = {
    "inpatient": ("inpatient_claims.csv", "CLM_PMT_AMT"),
    "outpatient": ("outpatient_claims.csv", "CLM_PMT_AMT"),
    "carrier": ("carrier_claims.csv", "LINE_NCH_PMT_AMT"),
}
BENEFICIARY_FILE = "beneficiary.csv"
SPECIALTY_COLUMN = "PRVDR_SPCLTY"
DIAGNOSIS_PREFIX, N_DIAGNOSIS_COLS = "ICD9_DGNS_CD", 10
PROCEDURE_PREFIX, N_PROCEDURE_COLS = "ICD9_PRCDR_CD", 6
HCPCS_PREFIX, N_HCPCS_COLS = "HCPCS_CD", 3
DEFAULT_BIRTH_YEAR = 1940
UNKNOWN_SPECIALTY = "Unknown"

# --- fixed values: chronic-condition flags of the beneficiary file ----------
CHRONIC_CONDITIONS = ["Diabetes", "Hypertension", "HeartFailure", "IschemicHeart", "COPD",
                      "Depression", "Arthritis", "KidneyDisease", "Cancer", "Stroke"]

# --- fixed values: model features, in the model's column order --------------
FEATURE_COLS = ["reimbursement_zscore", "los_zscore", "visit_frequency_zscore",
                "code_severity_percentile", "high_severity_code_pct", "code_severity_outlier"]

# --- fixed values: display names of the features in driver lists ------------
FEATURE_DISPLAY_NAMES = {
    "reimbursement_zscore": "Reimbursement z-score",
    "los_zscore": "Length-of-stay z-score",
    "visit_frequency_zscore": "Visit-frequency z-score",
    "code_severity_percentile": "Code severity percentile",
    "high_severity_code_pct": "High-severity code %",
    "code_severity_outlier": "Code severity outlier",
}

# --- fixed values: label signals, in the order reasons are listed -----------
SIGNALS = ["reimbursement_zscore", "los_zscore", "visit_frequency_zscore", "code_severity_outlier"]

# --- fixed values: heuristic score weights, in feature order ----------------
HEURISTIC_WEIGHTS = {"reimbursement_zscore": 0.3, "los_zscore": 0.2, "visit_frequency_zscore": 0.2,
                     "code_severity_percentile": 0.15, "high_severity_code_pct": 0.1,
                     "code_severity_outlier": 0.05}
DEFAULT_THRESHOLD = 0.5

# --- fixed values: calibration grids ---------------------------------------
COARSE_GRID_K2 = [2.0, 2.1, 2.2, 2.3, 2.4, 2.5, 2.6, 2.7, 2.8, 2.9, 3.0,
                  3.1, 3.2, 3.3, 3.4, 3.5, 3.6, 3.7, 3.8, 3.9, 4.0]
COARSE_GRID_K3 = [2.0, 2.1, 2.2, 2.3, 2.4, 2.5, 2.6, 2.7, 2.8, 2.9, 3.0,
                  3.1, 3.2, 3.3, 3.4, 3.5]
FINE_DELTAS = [-0.3, -0.25, -0.2, -0.15, -0.1, -0.05, 0.0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3]
FINE_MIN_THRESHOLD = 1.5

CLAIMS_SCHEMA = T.StructType([
    T.StructField("claim_id", T.StringType()),
    T.StructField("beneficiary_id", T.StringType()),
    T.StructField("provider_id", T.StringType()),
    T.StructField("provider_specialty", T.StringType()),
    T.StructField("claim_type", T.StringType()),
    T.StructField("claim_start_date", T.DateType()),
    T.StructField("claim_end_date", T.DateType()),
    T.StructField("claim_year", T.IntegerType()),
    T.StructField("admit_diagnosis_cd", T.StringType()),
    T.StructField("diagnosis_codes", T.ArrayType(T.StringType())),
    T.StructField("procedure_codes", T.ArrayType(T.StringType())),
    T.StructField("reimbursement_amt", T.DoubleType()),
    T.StructField("length_of_stay_days", T.IntegerType()),
])
CLAIM_COLUMNS = [f.name for f in CLAIMS_SCHEMA.fields]

# Scoring request: required ids, then defaults (null date, 0 numbers, empty lists).
REQUEST_SCHEMA = T.StructType([
    T.StructField("claim_id", T.StringType()),
    T.StructField("beneficiary_id", T.StringType()),
    T.StructField("provider_id", T.StringType()),
    T.StructField("provider_specialty", T.StringType()),
    T.StructField("claim_type", T.StringType()),
    T.StructField("claim_start_date", T.StringType()),
    T.StructField("reimbursement_amt", T.DoubleType()),
    T.StructField("length_of_stay_days", T.IntegerType()),
    T.StructField("reimbursement_zscore", T.DoubleType()),
    T.StructField("los_zscore", T.DoubleType()),
    T.StructField("visit_frequency_zscore", T.DoubleType()),
    T.StructField("code_severity_percentile", T.DoubleType()),
    T.StructField("high_severity_code_pct", T.DoubleType()),
    T.StructField("code_severity_outlier", T.IntegerType()),
    T.StructField("diagnosis_codes", T.ArrayType(T.StringType())),
    T.StructField("procedure_codes", T.ArrayType(T.StringType())),
])
REQUIRED_REQUEST_FIELDS = ["claim_id", "beneficiary_id", "provider_id", "provider_specialty", "claim_type"]

PEER_STATS_COLUMNS = ["provider_specialty", "provider_id", "claim_type", "n_claims",
                      "avg_reimbursement", "reimbursement_stddev", "avg_length_of_stay", "los_stddev",
                      "avg_visit_freq_per_bene", "peer_avg_visit_freq", "peer_visit_freq_stddev"]


def all_string_schema(columns: list[str]) -> T.StructType:
    """Raw files are read with every column as text (no inference)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
