"""Run summaries (A14–A17, A25): category counts, amount description,
feature summary, distinct counts. All exact; quantiles use the distributed
exact quantile (no single-task percentile buffer over claim-grain values)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLS
from .cumulative import exact_quantiles


def category_counts(df: DataFrame, col: str, n: int | None = 10) -> DataFrame:
    """Rows per category, most frequent first (ties by category), top n."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.col("n_rows").desc(), F.col(col))
    return c.limit(n) if n else c


def describe_amount(claims: DataFrame, col: str = "reimbursement_amt") -> DataFrame:
    """Count, mean, std, min, 25%, 50%, 75%, max (exact quartiles)."""
    base = claims.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                      F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"))
    q = exact_quantiles(claims, col, [0.25, 0.5, 0.75])
    qs = q.agg(*[F.max(F.when(F.col("q") == x, F.col("value"))).alias(n)
                 for x, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return base.select("count", "mean", "std", "min", qs.select("p25").scalar().alias("p25"),
                       qs.select("p50").scalar().alias("p50"), qs.select("p75").scalar().alias("p75"), "max")


def feature_summary(featured: DataFrame, features: list[str] = FEATURE_COLS[:4], p: float = 0.95) -> DataFrame:
    """Per feature mean, std and the p-quantile (unpivot, group by feature)."""
    long = featured.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"),
                                                         F.col(f).cast("double").alias("value"))
                                               for f in features])).alias("x")).select("x.feature", "x.value")
    stats = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    q = exact_quantiles(long, "value", [p], group_cols=["feature"]).select("feature", F.col("value").alias("p95"))
    return stats.join(q, "feature")


def distinct_counts(claims: DataFrame) -> DataFrame:
    """Distinct specialties, providers and codes."""
    empty = F.array().cast("array<string>")
    codes = claims.select(F.explode(F.concat(F.coalesce("diagnosis_codes", empty),
                                             F.coalesce("procedure_codes", empty))).alias("code"))
    n_codes = codes.where(F.trim("code") != "").agg(F.count_distinct("code")).scalar()
    return claims.agg(F.count_distinct("provider_specialty").alias("n_specialties"),
                      F.count_distinct("provider_id").alias("n_providers"),
                      n_codes.alias("n_codes"))
