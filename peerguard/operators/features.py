"""Peer-group statistics and per-claim outlier features.

Plan shape:
  * claims C are deduplicated on claim_id (D18) and written once, in buckets of
    their place (provider and a part of its beneficiaries), as a Parquet table in the
    shared folder; every later job scans only its columns, and claims aren't moved
    again: their codes, visits and provider statistics are all found in the bucket;
  * provider / peer-group / code aggregates are partial (map-side)
    aggregations, so a hot provider or code never lands whole in one task;
    they are small (provider or code grain) and written; whether one is
    broadcast is left to Spark, by its bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CLAIM_COLUMNS, FEATURE_COLS, PEER_STATS_COLUMNS
from .cumulative import exact_quantiles
from .ingest import dedup_claims
from .joins import Small, checked, in_parallel, write_table
from ..storage.bucketed import write_bucketed

PEER_KEY = ["provider_specialty", "claim_type"]
PROVIDER_KEY = ["provider_specialty", "claim_type", "provider_id"]
VISIT_KEY = ["beneficiary_id", "provider_id", "claim_year"]
#: Column of prepared claims that names their bucket, and the parts that a provider's
#: claims are dealt to by their beneficiary, so that a hot provider fills several.
PLACE, PARTS = "_place", 8
#: What the features are made of.
FEATURE_INPUT = ["claim_id", *PROVIDER_KEY, "beneficiary_id", "claim_year", "diagnosis_codes", "procedure_codes",
                 "reimbursement_amt", "length_of_stay_days"]
STD_COLS = ["reimbursement_stddev", "los_stddev", "peer_visit_freq_stddev"]


@dataclass(frozen=True)
class FeatureParams:
    """``baseline``: "provider" (z against the provider's own claims, the
    code's behaviour) or "peer_group" (against the specialty × claim-type
    group, the documented formula). Cuts of the code-severity outlier flag.
    ``running_ytd``: a claim's visits are counted up to its date, not over the
    whole year (D6)."""
    baseline: str = "provider"
    severity_cut: float = 0.9
    high_sev_cut: float = 0.3
    running_ytd: bool = False


def _std(c: str) -> Column:
    """Sample std; a constant group is exactly 0 (decided by min = max, not by
    the floating-point result)."""
    return F.when(F.max(c) == F.min(c), F.lit(0.0)).otherwise(F.stddev_samp(c))


def _place(part: Column) -> Column:
    return F.xxhash64("provider_id", part)


def _placed(claims: DataFrame, key: list[str]) -> list[str]:
    """``key``, and the place of prepared claims, which follows from it: their rows
    needn't be moved."""
    return [PLACE, *key] if PLACE in claims.columns else key


def visit_counts(claims: DataFrame) -> DataFrame:
    """Claims per (beneficiary, provider, year) — the full-year count."""
    return claims.groupBy(*_placed(claims, VISIT_KEY)).agg(F.count(F.lit(1)).alias("visit_count")).select(*VISIT_KEY, "visit_count")


def running_visits(claims: DataFrame) -> DataFrame:
    """D6 option: claims of the (beneficiary, provider, year) up to each date, ties
    of a date included. Claims are counted by date first, so that a window holds
    the dates of one year, 366 at most, however many claims a key has."""
    per_date = claims.groupBy(*VISIT_KEY, "claim_start_date").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*VISIT_KEY).orderBy("claim_start_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return per_date.select(*VISIT_KEY, "claim_start_date", F.sum("n").over(w).alias("visit_count"))


def with_visits(claims: DataFrame, running: bool = False, keep: list[str] | None = None, in_place: bool = False) -> DataFrame:
    """(claim_id, visit_count) of each claim with its visits: of the whole year (the
    default) or up to the claim's date; beside the columns ``keep``. ``in_place``:
    prepared claims, under their own provider, whose visits are all found in their bucket."""
    keep = keep or []
    key = [*VISIT_KEY, "claim_start_date"] if running else VISIT_KEY
    if in_place:
        whole = reduce(and_, [F.col(k).isNotNull() for k in key])
        w = Window.partitionBy(PLACE, *VISIT_KEY)
        if running:
            w = w.orderBy("claim_start_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return claims.select("claim_id", *keep, F.when(whole, F.count(F.lit(1)).over(w)).alias("visit_count"))
    claims = claims.drop(PLACE)  # callers may have given the claims another provider
    visits = running_visits(claims) if running else visit_counts(claims)
    return claims.select("claim_id", *keep, *key).join(visits, key, "left").select("claim_id", *keep, "visit_count")


def provider_visit_frequency(visits: DataFrame) -> DataFrame:
    """A3 (D5 grain): one row per provider, mean over all its (beneficiary,
    year) visit counts."""
    return visits.groupBy("provider_id").agg(F.avg("visit_count").alias("avg_visit_freq_per_bene"))


def provider_stats(claims: DataFrame, baseline: str = "provider") -> DataFrame:
    """A2: count, mean/std of amount and LOS per (specialty, type, provider).
    With ``baseline="peer_group"`` the mean/std columns hold the group's values."""
    aggs = [F.avg("reimbursement_amt").alias("avg_reimbursement"),
            _std("reimbursement_amt").alias("reimbursement_stddev"),
            F.avg("length_of_stay_days").alias("avg_length_of_stay"),
            _std("length_of_stay_days").alias("los_stddev")]
    n = F.count("claim_id").alias("n_claims")
    if baseline == "provider":
        return claims.groupBy(*PROVIDER_KEY).agg(n, *aggs)
    if baseline == "peer_group":
        counts = claims.groupBy(*PROVIDER_KEY).agg(n)
        group = claims.groupBy(*PEER_KEY).agg(*aggs)
        return counts.join(group, PEER_KEY)
    raise ValueError(f"unknown baseline {baseline!r}")


def fill_std_with_median(stats: DataFrame, cols: list[str] = STD_COLS) -> DataFrame:
    """A zero or missing std takes the median of that column's non-zero
    values over all provider rows (exact; one distributed pass for all columns)."""
    long = stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.when(F.col(c) != 0, F.col(c)).alias("std")) for c in cols])).alias("x"))
    found = {r["name"]: r["value"] for r in exact_quantiles(long.select("x.name", "x.std").where("std is not null"), "std", [0.5], ["name"]).collect()}
    out = stats
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.when(F.col(c) != 0, F.col(c)), F.lit(found.get(c)).cast("double")))
    return out


def compute_peer_group_stats(claims: DataFrame, baseline: str = "provider") -> DataFrame:
    """Provider stats ⟕ provider visit frequency ⋈ peer-group visit
    mean/std, then the median fill. One row per (specialty, type, provider)."""
    return finish_peer_stats(provider_stats(claims, baseline), provider_visit_frequency(visit_counts(claims)))


def finish_peer_stats(provider: DataFrame, frequency: DataFrame) -> DataFrame:
    """Provider statistics and visit frequencies -> the peer statistics table."""
    stats = provider.join(frequency, "provider_id", "left")
    peer = stats.groupBy(*PEER_KEY).agg(
        F.avg("avg_visit_freq_per_bene").alias("peer_avg_visit_freq"),
        _std("avg_visit_freq_per_bene").alias("peer_visit_freq_stddev"))
    # provider grain: written once, so the medians and the fill read it
    # instead of re-running the aggregation chain
    base = write_table(stats.join(peer, PEER_KEY), "provider_stats")
    return fill_std_with_median(base).select(*PEER_STATS_COLUMNS)


def code_occurrences(claims: DataFrame, keep: list[str]) -> DataFrame:
    """Diagnosis and procedure codes of each claim in one key space; repeats
    count; blank codes never occur."""
    empty = F.array().cast("array<string>")
    codes = F.concat(F.coalesce("diagnosis_codes", empty), F.coalesce("procedure_codes", empty))
    return (claims.select(*keep, F.explode(codes).alias("code"))
            .where(F.col("code").isNotNull() & (F.trim("code") != "")))


def compute_code_reimbursement_weights(claims: DataFrame) -> DataFrame:
    """Per code, mean claim amount and number of occurrences."""
    return (code_occurrences(claims, ["reimbursement_amt"]).groupBy("code")
            .agg(F.avg("reimbursement_amt").alias("avg_reimbursement"),
                 F.count(F.lit(1)).alias("n_occurrences")))


def code_percentiles(weights: DataFrame) -> tuple[Column, Column]:
    """Exact p50/p90 (linear interpolation) of the unweighted code means,
    as scalar subqueries. The input is code grain (bounded by the code
    vocabulary), so the single merge task stays small."""
    p50 = weights.select(F.percentile("avg_reimbursement", F.lit(0.5))).scalar()
    p90 = weights.select(F.percentile("avg_reimbursement", F.lit(0.9))).scalar()
    return p50, p90


def code_severity_table(weights: DataFrame) -> DataFrame:
    """P16 per code: min–max position of the code mean between p50 and p90,
    clamped to [0, 1] (0.5 when p90 ≤ p50), and the top-decile flag (A5)."""
    p50, p90 = code_percentiles(weights)
    avg = F.col("avg_reimbursement")
    pct = F.when(p90 > p50, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (avg - p50) / (p90 - p50)))) \
           .otherwise(F.lit(0.5))
    return weights.select("code", "avg_reimbursement", pct.alias("severity"),
                          (avg >= p90).alias("is_high_severity"))


def provider_code_counts(claims: DataFrame) -> DataFrame:
    """Occurrences per (provider, code)."""
    return code_occurrences(claims, ["provider_id"]).groupBy("provider_id", "code") \
        .agg(F.count(F.lit(1)).alias("n_occurrences"))


def compute_provider_code_frequency(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """A8 lookup: how often each asked provider bills the code; 0 where never.
    ``counts`` is :func:`provider_code_counts`, ``pairs`` has provider_id and code."""
    asked = pairs.select("provider_id", "code").distinct()
    return asked.join(counts, ["provider_id", "code"], "left").select("provider_id", "code", F.coalesce("n_occurrences", F.lit(0)).alias("n_occurrences"))


def compute_code_severity_percentile(claims: DataFrame, weights: DataFrame) -> DataFrame:
    """(claim_id, code_severity_percentile) of every claim for given code
    weights: the highest severity among its codes, 0 without a known code, 0.5
    where there are no weights at all."""
    sev = code_severity_table(weights).select("code", "severity")
    key = _placed(claims, ["claim_id"])
    best = code_occurrences(claims, key).join(sev, "code").groupBy(*key).agg(F.max("severity").alias("_sev"))
    none = F.when(weights.select(F.count(F.lit(1)) == 0).scalar(), F.lit(0.5)).otherwise(F.lit(0.0))
    return claims.select(*key).join(best, key, "left").select("claim_id", F.coalesce("_sev", none).alias("code_severity_percentile"))


def provider_high_severity_share(claims: DataFrame, severity: Small) -> DataFrame:
    """A5: share of a provider's code occurrences whose code mean ≥ p90."""
    sev = severity.df.select("code", "is_high_severity")
    occ = code_occurrences(claims, ["provider_id"]).join(sev, "code", "left")
    return occ.groupBy("provider_id").agg(
        (F.sum(F.when(F.col("is_high_severity"), 1).otherwise(0)) / F.count(F.lit(1)))
        .alias("high_severity_code_pct"))


def claim_code_severity(claims: DataFrame, severity: Small) -> DataFrame:
    """P16 per claim: max code severity. On prepared claims the exploded codes stay
    in their bucket and the aggregate needs no exchange."""
    sev = severity.df.select("code", "severity")
    key = _placed(claims, ["claim_id"])
    return (code_occurrences(claims, key).join(sev, "code")
            .groupBy(*key).agg(F.max("severity").alias("_sev")))


def prepare_claims(claims: DataFrame, group: str | None = None, columns: list[str] = CLAIM_COLUMNS,
                   build: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D18 dedup on claim_id, written as a Parquet table in the shared folder:
    lineage is cut, and every later job reads only the columns it needs
    (vectorized, pruned) instead of deserializing whole rows. The table's buckets are
    those of the claims' place. ``group``: a column that follows from claim_id; where
    a join has dealt the rows out by it, they aren't moved for the dedup.
    ``columns``: what is kept of a claim. ``build`` makes claims of the rows, beside
    columns that it doesn't know; the rows, being narrower, are moved in their place."""
    spark = claims.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # joins on more columns than the place are done in its buckets
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    if group:
        claims = claims.repartition(group)
    rows = claims.columns if build else columns
    whole = build(claims.select("*", *[F.col(c).alias(f"_r_{c}") for c in rows])) if build else claims.select(*CLAIM_COLUMNS, *([group] if group else []))
    one = dedup_claims(whole, [*([f"_r_{group}" if build else group] if group else []), "claim_id"])
    place = _place(F.pmod(F.xxhash64("beneficiary_id"), F.lit(PARTS)).cast("int")).alias(PLACE)
    dealt = one.select(*[F.col(f"_r_{c}").alias(c) if build else F.col(c) for c in rows], place).repartition(n, PLACE)
    return write_bucketed((build(dealt) if build else dealt).select(*columns, PLACE), PLACE, n, dealt=True)


def _at_each_place(df: DataFrame) -> DataFrame:
    """A row of a provider for each part of its claims."""
    parts = df.withColumn("_part", F.explode(F.array(*[F.lit(i) for i in range(PARTS)])))
    return parts.withColumn(PLACE, _place(F.col("_part"))).drop("_part")


def with_claim_scores(claims: DataFrame, peer: DataFrame, share: DataFrame) -> DataFrame:
    """P13, P14 and the year's visits on prepared claims: the z-scores of amount and
    stay, the group's visit mean and std, the provider's share and ``visit_count`` of
    every claim (null without a whole key or an id). Only the provider tables are
    moved, where they are too large for a broadcast."""
    named = F.col("claim_id").isNotNull()
    for k in VISIT_KEY:
        named &= F.col(k).isNotNull()
    visits = F.count(F.lit(1)).over(Window.partitionBy(PLACE, "provider_id", "beneficiary_id", "claim_year"))
    c = claims.withColumn("visit_count", F.when(named, visits))
    j = c.join(_at_each_place(share), [PLACE, "provider_id"], "left").join(_at_each_place(peer), [PLACE, *PROVIDER_KEY], "left")
    rz = F.try_divide(F.col("reimbursement_amt") - F.col("avg_reimbursement"), F.col("reimbursement_stddev"))
    lz = F.when(F.col("claim_type") == "inpatient", F.try_divide(F.col("length_of_stay_days") - F.col("avg_length_of_stay"), F.col("los_stddev")))
    return j.select(*claims.columns, F.coalesce(rz, F.lit(0.0)).alias("reimbursement_zscore"), F.coalesce(lz, F.lit(0.0)).alias("los_zscore"),
                    "visit_count", "peer_avg_visit_freq", "peer_visit_freq_stddev",
                    F.coalesce("high_severity_code_pct", F.lit(0.0)).alias("high_severity_code_pct"))


def compute_all_features(claims: DataFrame, params: FeatureParams = FeatureParams(),
                         peer_stats: DataFrame | None = None,
                         code_weights: DataFrame | None = None, prepared: bool = False) -> DataFrame:
    """Claims → claims + the six model features (P13–P19), one row per claim_id.

    ``peer_stats`` / ``code_weights`` may be passed in precomputed (reuse);
    ``prepared=True`` when ``claims`` already came from :func:`prepare_claims`."""
    c = claims if prepared else prepare_claims(claims)
    kept = [x for x in CLAIM_COLUMNS if x in c.columns]
    def severity_and_share():
        weights = checked(code_weights if code_weights is not None else compute_code_reimbursement_weights(c)).df
        sev_t = checked(code_severity_table(weights))
        return sev_t, checked(provider_high_severity_share(c, sev_t))

    peer, (severity, share) = in_parallel(
        lambda: checked(peer_stats if peer_stats is not None else compute_peer_group_stats(c, params.baseline)),
        severity_and_share)

    ps = peer.df.select(*PROVIDER_KEY, "avg_reimbursement", "reimbursement_stddev",
                        "avg_length_of_stay", "los_stddev", "peer_avg_visit_freq", "peer_visit_freq_stddev")
    sev = claim_code_severity(c, severity)
    j = with_claim_scores(c.join(sev, _placed(c, ["claim_id"]), "left"), ps, share.df)
    if params.running_ytd:
        j = j.drop("visit_count").join(with_visits(c, True), "claim_id", "left")
    vz = F.coalesce(F.try_divide(F.coalesce(F.col("visit_count"), F.lit(1)) - F.col("peer_avg_visit_freq"), F.col("peer_visit_freq_stddev")), F.lit(0.0))
    sev_pct = F.coalesce(F.col("_sev"), F.lit(0.5 if severity.rows == 0 else 0.0))
    feats = j.select(*kept, "reimbursement_zscore", "los_zscore", vz.alias("visit_frequency_zscore"),
                     sev_pct.alias("code_severity_percentile"), "high_severity_code_pct")
    outlier = ((F.col("code_severity_percentile") >= params.severity_cut)
               & (F.col("high_severity_code_pct") > params.high_sev_cut)).cast("int")
    return feats.withColumn("code_severity_outlier", outlier).select(*kept, *FEATURE_COLS)
