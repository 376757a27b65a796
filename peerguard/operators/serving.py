"""Serving tables and their read paths.

The reference keeps five wide-row tables keyed for point and range reads.
Here each is a Parquet table laid out for the same access path:
  * claims_by_id        — in buckets of claim_id: a point read opens one file,
                          joins by id need no exchange;
  * claims_by_provider  — range-partitioned and sorted by (provider, date,
                          claim): a hot provider spreads over several files
                          instead of one skewed writer task;
  * provider_peer_stats — keyed (specialty, provider, claim_type) (D11);
  * beneficiary_profile — in buckets of beneficiary_id;
  * flagged_claims      — day partitions, sorted by score desc (storage/keyed.py).
"Last write wins" is an explicit ``row_number() = 1`` with a stated order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.safe import list_json, safe_date, safe_float, safe_int, text_or_empty
from ..schemas import PEER_STATS_COLUMNS
from ..storage.bucketed import read_id, read_ids, write_bucketed


#: Key and order of claims_by_provider.
PROVIDER_ORDER = ["provider_id", "claim_start_date", "claim_id"]


def last_write_wins(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``. The ``row_number() = 1``
    filter lets Spark apply a partial per-partition limit before the shuffle,
    so a heavily repeated key does not travel whole."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _claim_values(df: DataFrame) -> list[Column]:
    return [
        text_or_empty("beneficiary_id").alias("beneficiary_id"),
        text_or_empty("provider_specialty").alias("provider_specialty"),
        text_or_empty("claim_type").alias("claim_type"),
        safe_date("claim_end_date").alias("claim_end_date"),
        text_or_empty("admit_diagnosis_cd").alias("admit_diagnosis_cd"),
        list_json("diagnosis_codes").alias("diagnosis_codes"),
        list_json("procedure_codes").alias("procedure_codes"),
        safe_float("reimbursement_amt").alias("reimbursement_amt"),
        safe_int("length_of_stay_days").alias("length_of_stay_days"),
        safe_float("reimbursement_zscore").alias("reimbursement_zscore"),
        safe_float("los_zscore").alias("los_zscore"),
        safe_float("visit_frequency_zscore").alias("visit_frequency_zscore"),
        safe_float("code_severity_percentile").alias("code_severity_percentile"),
        safe_float("high_severity_code_pct").alias("high_severity_code_pct"),
        safe_int("code_severity_outlier").alias("code_severity_outlier"),
        safe_int("label").alias("label"),
        list_json("label_reasons").alias("label_reasons"),
    ]


# Which duplicate survives: the reference's store keeps the last write; Spark
# has no write order, so the stated rule is the highest score-relevant values.
def _claim_order() -> list[Column]:
    return [F.col("claim_start_date").desc_nulls_last(), F.col("reimbursement_amt").desc_nulls_last(),
            F.col("label").desc_nulls_last(), F.col("provider_id").asc_nulls_last()]


def claims_by_id(labeled: DataFrame) -> DataFrame:
    """K3: serving rows keyed by claim_id (lists as JSON text, safe numbers)."""
    rows = labeled.select(text_or_empty("claim_id").alias("claim_id"),
                          text_or_empty("provider_id").alias("provider_id"),
                          safe_date("claim_start_date").alias("claim_start_date"),
                          safe_int("claim_year").alias("claim_year"), *_claim_values(labeled))
    return last_write_wins(rows, ["claim_id"], _claim_order())


def claims_by_provider(labeled: DataFrame, n_files: int | None = None) -> DataFrame:
    """K4: the same rows keyed by (provider_id, claim_start_date, claim_id). They are
    dealt out once, by ranges of the key: the rows of one key share a range, where the
    last is chosen, and the ranges are the files to be written."""
    rows = labeled.select(text_or_empty("provider_id").alias("provider_id"),
                          safe_date("claim_start_date").alias("claim_start_date"),
                          text_or_empty("claim_id").alias("claim_id"), *_claim_values(labeled))
    dealt = rows.repartitionByRange(n_files, *PROVIDER_ORDER) if n_files else rows.repartitionByRange(*PROVIDER_ORDER)
    return last_write_wins(dealt, PROVIDER_ORDER, _claim_order())


def peer_stats_table(peer: DataFrame) -> DataFrame:
    """K5 (D11): keyed by (specialty, provider, claim_type); numbers coerced."""
    rows = peer.select(
        text_or_empty("provider_specialty").alias("provider_specialty"),
        text_or_empty("provider_id").alias("provider_id"),
        text_or_empty("claim_type").alias("claim_type"),
        safe_int("n_claims").alias("n_claims"),
        *[safe_float(c).alias(c) for c in PEER_STATS_COLUMNS[4:]])
    return last_write_wins(rows, ["provider_specialty", "provider_id", "claim_type"],
                           [F.col("n_claims").desc()])


def peer_stats_legacy_one_row(table: DataFrame) -> DataFrame:
    """D11 legacy view: one row per (specialty, provider) as the reference's
    store leaves it — the lexicographically last claim_type wins."""
    return last_write_wins(table, ["provider_specialty", "provider_id"], [F.col("claim_type").desc()])


def beneficiary_table(profiles: DataFrame) -> DataFrame:
    """K6: id, birth year, conditions as JSON text, latest-year claim count."""
    rows = profiles.select(text_or_empty("beneficiary_id").alias("beneficiary_id"),
                           safe_int("birth_year").alias("birth_year"),
                           list_json("chronic_conditions").alias("chronic_conditions"),
                           safe_int("claim_count_ytd").alias("claim_count_ytd"))
    return last_write_wins(rows, ["beneficiary_id"], [F.col("claim_count_ytd").desc()])


# --- sinks: table layouts ------------------------------------------------------

def write_claims_by_id(table: DataFrame, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """K3's table in buckets of claim_id (storage/bucketed.py)."""
    return write_bucketed(table, "claim_id", buckets, path)


def write_beneficiaries(table: DataFrame, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """K6's table in buckets of beneficiary_id."""
    return write_bucketed(table, "beneficiary_id", buckets, path)


def write_claims_by_provider(table: DataFrame, path: str) -> None:
    """The table of :func:`claims_by_provider`, each of its ranges sorted in a file."""
    table.sortWithinPartitions(*PROVIDER_ORDER).write.mode("overwrite").parquet(path)


# --- read paths ------------------------------------------------------------------

def claim_by_id(claims_table: DataFrame, claim_id: str) -> DataFrame:
    """The claim's row, read from the one bucket that can hold it."""
    return read_id(claims_table, "claim_id", claim_id)


def lookup_claims(claims_table: DataFrame, requests: DataFrame) -> DataFrame:
    """S6 as a batch of point reads: the requested claim ids (a frame with a
    ``claim_id`` column) against the id-keyed table (left semi join)."""
    return read_ids(claims_table, "claim_id", requests)


def provider_claims_between(by_provider: DataFrame, start: str, end: str,
                            provider_id: str | None = None) -> DataFrame:
    """A provider's claims in a date range, ordered by date then id.
    With no provider given, every provider's range (globally ordered)."""
    cond = F.col("claim_start_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if provider_id is not None:
        cond = cond & (F.col("provider_id") == provider_id)
    return by_provider.where(cond).orderBy("provider_id", "claim_start_date", "claim_id")


def lookup_beneficiaries(bene_table: DataFrame, requests: DataFrame) -> DataFrame:
    """Beneficiary rows for the requested ids."""
    return read_ids(bene_table, "beneficiary_id", requests)


def audit_queue(flagged: DataFrame, n: int = 10, flag_date: str | None = None) -> DataFrame:
    """A day's flags by score desc, claim_id asc, first n. Without a
    date, the top n of every day (per-group top-k with a partial limit
    before the shuffle, so a busy day never moves whole)."""
    order = [F.col("score").desc(), F.col("claim_id").asc()]
    if flag_date is not None:
        return flagged.where(F.col("flag_date") == F.lit(flag_date).cast("date")).orderBy(*order).limit(n)
    w = Window.partitionBy("flag_date").orderBy(*order)
    return flagged.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
