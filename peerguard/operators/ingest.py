"""Raw claim files → one normalized claims table, with explicit rejects.

Covers date/code/amount/LOS/specialty parsing (P1–P10, P36), the provider →
specialty map (A1, J1), the union of claim types (U1) and reject accounting
(P9, A18). Everything is column expressions; no Python row loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..schemas import (CLAIM_COLUMNS, CLAIM_FILES, DIAGNOSIS_PREFIX, HCPCS_PREFIX, N_DIAGNOSIS_COLS,
                       N_HCPCS_COLS, N_PROCEDURE_COLS, PROCEDURE_PREFIX, SPECIALTY_COLUMN,
                       UNKNOWN_SPECIALTY)
from ..sources.csv_files import CORRUPT, whole_lines
from .joins import write_table


def _col(df: DataFrame, name: str) -> Column:
    """A raw column, or NULL text when the file lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def provider_specialty_map(carrier_raw: DataFrame) -> DataFrame:
    """A1: one specialty per provider from the carrier file. Spark has no file
    order, so the stated rule is: the non-blank specialty of the provider's
    smallest claim id (then smallest specialty)."""
    prov = P.blank_to_null(_col(carrier_raw, "PRVDR_NUM"))
    spec = P.blank_to_null(_col(carrier_raw, SPECIALTY_COLUMN))
    key = F.concat(F.coalesce(F.trim(_col(carrier_raw, "CLM_ID")), F.lit("")), F.lit("|"), spec)
    return (whole_lines(carrier_raw).select(prov.alias("provider_id"), spec.alias("specialty"), key.alias("k"))
            .where(F.col("provider_id").isNotNull() & F.col("specialty").isNotNull())
            .groupBy("provider_id")
            .agg(F.min_by("specialty", "k").alias("mapped_specialty")))


def normalize_claim_file(raw: DataFrame, claim_type: str) -> DataFrame:
    """One raw file → common schema plus ``reject_reason`` (NULL when kept)
    and the raw own-specialty text (resolved after the map join)."""
    amount_col = CLAIM_FILES[claim_type][1]
    claim_id = P.blank_to_null(_col(raw, "CLM_ID"))
    bene = P.blank_to_null(_col(raw, "DESYNPUF_ID"))
    prov = P.blank_to_null(_col(raw, "PRVDR_NUM"))
    start = P.parse_compact_date(_col(raw, "CLM_FROM_DT"))
    end = P.parse_compact_date(_col(raw, "CLM_THRU_DT"))
    dx_cols = [c for c in P.numbered(DIAGNOSIS_PREFIX, N_DIAGNOSIS_COLS) if c in raw.columns]
    if claim_type == "carrier":
        px_cols = [c for c in P.numbered(HCPCS_PREFIX, N_HCPCS_COLS) if c in raw.columns]
    else:
        px_cols = [c for c in P.numbered(PROCEDURE_PREFIX, N_PROCEDURE_COLS) if c in raw.columns]
    empty = F.array().cast("array<string>")
    dx = P.collect_codes(dx_cols) if dx_cols else empty
    px = P.collect_codes(px_cols) if px_cols else empty
    broken = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    reason = (F.when(broken.isNotNull(), F.lit("corrupt"))  # its cells may stand in the wrong columns
               .when(claim_id.isNull(), F.lit("dropped"))
               .when(bene.isNull() | prov.isNull(), F.lit("dropped"))
               .when(start.isNull(), F.lit("malformed")))
    ctype = F.lit(claim_type)
    return raw.select(
        claim_id.alias("claim_id"),
        bene.alias("beneficiary_id"),
        prov.alias("provider_id"),
        _col(raw, SPECIALTY_COLUMN).alias("_own_specialty"),
        ctype.alias("claim_type"),
        start.alias("claim_start_date"),
        end.alias("claim_end_date"),
        F.year(start).cast("int").alias("claim_year"),
        P.principal_diagnosis(dx).alias("admit_diagnosis_cd"),
        dx.alias("diagnosis_codes"),
        px.alias("procedure_codes"),
        P.parse_amount(_col(raw, amount_col)).alias("reimbursement_amt"),
        P.length_of_stay(ctype, _col(raw, "_LOS"), start, end).cast("int").alias("length_of_stay_days"),
        reason.alias("reject_reason"),
    )


def normalize_claims(raw_files: dict[str, DataFrame]) -> DataFrame:
    """All claim files → one frame of every input row with ``reject_reason``
    (NULL = accepted). Use :func:`accepted` / :func:`rejected` to split."""
    parts = [normalize_claim_file(df, ctype) for ctype, df in raw_files.items()]
    if not parts:
        raise ValueError("no claim files")
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    if "carrier" in raw_files:
        # provider grain: written, so that its size is known to the join
        spec_map = write_table(provider_specialty_map(raw_files["carrier"]), "specialty_map")
        union = union.join(spec_map, "provider_id", "left")
        mapped = F.col("mapped_specialty")
    else:
        mapped = F.lit(None).cast("string")
    return union.withColumn("provider_specialty",
                            P.resolve_specialty(F.col("_own_specialty"), mapped, UNKNOWN_SPECIALTY)) \
                .select(*CLAIM_COLUMNS, "reject_reason")


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col("reject_reason").isNull()).select(*CLAIM_COLUMNS)


def rejected(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col("reject_reason").isNotNull())


def reject_counts(normalized: DataFrame) -> DataFrame:
    """Rows per (claim_type, outcome) with outcome accepted/dropped/malformed/corrupt."""
    return (normalized.groupBy("claim_type",
                               F.coalesce(F.col("reject_reason"), F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


# Dedup order for claims sharing an id: latest, largest first, then by ids.
DEDUP_DESC = ["claim_start_date", "claim_end_date", "reimbursement_amt", "length_of_stay_days"]
DEDUP_ASC = ["beneficiary_id", "provider_id", "claim_type", "provider_specialty"]


def dedup_order() -> list[Column]:
    return ([F.col(c).desc_nulls_last() for c in DEDUP_DESC]
            + [F.col(c).asc_nulls_last() for c in DEDUP_ASC])


def dedup_claims(claims: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per key with the stated order. ``row_number() = 1`` lets
    Spark insert a partial per-partition limit before the shuffle."""
    key = key or ["claim_id"]
    w = Window.partitionBy(*key).orderBy(*dedup_order())
    return claims.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
