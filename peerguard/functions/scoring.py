"""Scoring expressions: heuristic score, clamp/flag, top driver features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLS, FEATURE_DISPLAY_NAMES, HEURISTIC_WEIGHTS


def heuristic_score(share_divisor: float = 100.0) -> Column:
    """Weighted sum of |z|-scores, severity, provider share (divided by 100 as in
    the published score) and outlier flag, summed left to right."""
    w = HEURISTIC_WEIGHTS
    return (F.abs(F.col("reimbursement_zscore")) * w["reimbursement_zscore"]
            + F.abs(F.col("los_zscore")) * w["los_zscore"]
            + F.abs(F.col("visit_frequency_zscore")) * w["visit_frequency_zscore"]
            + F.col("code_severity_percentile") * w["code_severity_percentile"]
            + F.col("high_severity_code_pct") / share_divisor * w["high_severity_code_pct"]
            + F.col("code_severity_outlier").cast("double") * w["code_severity_outlier"])


def clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def driver_values(share_divisor: float = 100.0) -> list[Column]:
    return [F.abs(F.col("reimbursement_zscore")), F.abs(F.col("los_zscore")),
            F.abs(F.col("visit_frequency_zscore")), F.col("code_severity_percentile").cast("double"),
            F.col("high_severity_code_pct") / share_divisor,
            F.col("code_severity_outlier").cast("double")]


def top_driver_features(n: int = 3, share_divisor: float = 100.0) -> Column:
    """Display names of the n largest feature contributions, descending, ties
    kept in feature order (a stable sort)."""
    items = [F.struct(v.alias("v"), F.lit(-i).alias("p"), F.lit(FEATURE_DISPLAY_NAMES[f]).alias("name"))
             for i, (f, v) in enumerate(zip(FEATURE_COLS, driver_values(share_divisor)))]
    ranked = F.sort_array(F.array(*items), asc=False)
    return F.slice(ranked, 1, n)["name"]
