"""Beneficiary profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..schemas import DEFAULT_BIRTH_YEAR
from ..sources.csv_files import whole_lines


def latest_year_claim_counts(claims: DataFrame) -> DataFrame:
    """Claims per (beneficiary, year), then the count of the latest year."""
    per_year = claims.groupBy("beneficiary_id", "claim_year").agg(F.count(F.lit(1)).alias("n"))
    return per_year.groupBy("beneficiary_id").agg(F.max_by("n", "claim_year").alias("claim_count_ytd"))


def build_beneficiary_profiles(bene_raw: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per beneficiary-file row: id, birth year (default 1940),
    sorted chronic-condition names, latest-year claim count (0 when none). Broken
    lines of the file are left out (csv_files.broken_lines has them)."""
    bene_raw = whole_lines(bene_raw)
    flags = [c for c in bene_raw.columns if c.startswith("SP_")]
    prof = bene_raw.select(
        F.col("DESYNPUF_ID").cast("string").alias("beneficiary_id"),
        P.birth_year("BENE_BIRTH_DT", DEFAULT_BIRTH_YEAR).alias("birth_year"),
        P.chronic_conditions(flags).alias("chronic_conditions"))
    counts = latest_year_claim_counts(claims)
    return (prof.join(counts, "beneficiary_id", "left")
            .withColumn("claim_count_ytd", F.coalesce(F.col("claim_count_ytd"), F.lit(0)).cast("int")))
