"""Output projections for checked results: doubles rounded to 6 places, dates
and string lists rendered as text (the same rendering the oracle SQL uses)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def r6(c: str) -> Column:
    return F.round(F.col(c), 6).alias(c)


def date_text(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


def list_text(c: str, sep: str = "|") -> Column:
    return F.array_join(F.col(c), sep).alias(c)


def feature_view(df: DataFrame, *extra: Column | str) -> DataFrame:
    return df.select(
        "claim_id", "beneficiary_id", "provider_id", "provider_specialty", "claim_type",
        date_text("claim_start_date"), "claim_year", list_text("diagnosis_codes"),
        list_text("procedure_codes"), r6("reimbursement_amt"), "length_of_stay_days",
        r6("reimbursement_zscore"), r6("los_zscore"), r6("visit_frequency_zscore"),
        r6("code_severity_percentile"), r6("high_severity_code_pct"), "code_severity_outlier", *extra)
