"""Claim scoring.

The scorer is a Column expression (the heuristic, default and oracle-checkable)
or another :class:`Scorer`: a fitted ``pyspark.ml`` model, or a function from
outside that is loaded once in each Python worker.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import clamp01, heuristic_score, top_driver_features
from ..schemas import DEFAULT_THRESHOLD, FEATURE_COLS, PEER_STATS_COLUMNS

HEURISTIC_MESSAGE = "Model not compiled; using heuristic score."


def read_threshold(spark: SparkSession, path: str | None, default: float = DEFAULT_THRESHOLD) -> Column:
    """The decision threshold stored as text (first line), as a scalar
    subquery; a missing file or bad value gives the default."""
    from ..session import path_exists
    if not path or not path_exists(spark, path):
        return F.lit(float(default))
    t = spark.read.text(path).limit(1).select(
        F.coalesce(F.trim("value").try_cast("double"), F.lit(float(default))).alias("t"))
    return F.coalesce(t.scalar(), F.lit(float(default)))


def write_threshold(spark: SparkSession, value: float, path: str) -> None:
    spark.createDataFrame([(repr(float(value)),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def score_claims(claims: DataFrame, threshold: Column | float = DEFAULT_THRESHOLD,
                 share_divisor: float = 100.0, raw_score: Column | None = None) -> DataFrame:
    """Score (clamped to [0, 1]) and ``flagged = score >= threshold``
    on the unrounded score; P32 driver features for every row."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    raw = raw_score if raw_score is not None else heuristic_score(share_divisor)
    return (claims.withColumn("score", clamp01(raw))
            .withColumn("threshold", thr)
            .withColumn("flagged", F.col("score") >= F.col("threshold"))
            .withColumn("driver_features", top_driver_features(3, share_divisor)))


def predict_label(proba: Column, threshold: Column | float) -> Column:
    """Hard prediction ``proba >= threshold``."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (proba >= thr).cast("int")


PEER_KEY_FULL = ("provider_specialty", "provider_id", "claim_type")
PEER_KEY_LEGACY = ("provider_specialty", "provider_id")


def with_peer_stats(scored: DataFrame, peer_table: DataFrame, key: tuple[str, ...] = PEER_KEY_FULL) -> DataFrame:
    """Attach the provider's peer stats as a struct (NULL when absent).
    ``key`` is the table's full key, or (specialty, provider) against the
    one-row legacy view."""
    side = peer_table.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
                             F.struct(*PEER_STATS_COLUMNS).alias("provider_peer_stats"))
    cond = None
    for i, k in enumerate(key):
        c = scored[k] == side[f"_k{i}"]
        cond = c if cond is None else cond & c
    return scored.join(side, cond, "left").drop(*[f"_k{i}" for i in range(len(key))])


def score_responses(scored: DataFrame, model_loaded: bool = False) -> DataFrame:
    """K9: the response rows."""
    msg = F.lit(None).cast("string") if model_loaded else F.lit(HEURISTIC_MESSAGE)
    peer = F.col("provider_peer_stats") if "provider_peer_stats" in scored.columns else F.lit(None)
    return scored.select("claim_id", F.round("score", 6).alias("score"), "flagged", "threshold",
                         peer.alias("provider_peer_stats"), msg.alias("message"))


def flag_events(scored: DataFrame, flag_date: Column | None = None, ts: Column | None = None) -> DataFrame:
    """One JSON message per flagged claim. The clock columns default to
    the query's current date / UTC time and are parameters for tests."""
    fd = flag_date if flag_date is not None else F.current_date()
    now = ts if ts is not None else F.current_timestamp()
    f = scored.where(F.col("flagged"))
    body = F.struct(
        F.col("claim_id"), F.col("provider_id"), F.col("score"), F.col("driver_features"),
        F.date_format(fd, "yyyy-MM-dd").alias("flag_date"),
        F.concat(F.date_format(F.convert_timezone(None, F.lit("UTC"), now.cast("timestamp_ntz")),
                               "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("timestamp"))
    return f.select(F.col("claim_id").alias("key"), F.to_json(body).alias("value"))


@dataclass(frozen=True)
class Scorer:
    """what scores a claim. ``apply`` adds the unclamped score as ``raw_score``
    to a frame (batch or stream) that has the feature columns."""
    apply: Callable[[DataFrame], DataFrame]
    model_loaded: bool


def _filled(claims: DataFrame) -> DataFrame:
    """Feature columns without nulls (a missing feature is 0)."""
    return claims.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURE_COLS})


def heuristic_scorer(share_divisor: float = 100.0) -> Scorer:
    return Scorer(lambda claims: claims.withColumn("raw_score", heuristic_score(share_divisor)), False)


def model_scorer(model) -> Scorer:
    """A fitted pipeline, or the folder of a saved one, which is loaded once, on
    the driver; the trees travel with the tasks."""
    if isinstance(model, str):
        from pyspark.ml import PipelineModel
        model = PipelineModel.load(model)
    from .ml import predict_proba

    def apply(claims: DataFrame) -> DataFrame:
        own = claims.select("*", *[F.col(c).alias(f"_own_{c}") for c in FEATURE_COLS])
        scored = predict_proba(model, _filled(own)).withColumnRenamed("proba", "raw_score")
        return scored.withColumns({c: F.col(f"_own_{c}") for c in FEATURE_COLS}).drop(*[f"_own_{c}" for c in FEATURE_COLS])
    return Scorer(apply, True)


def plugin_scorer(load: Callable[[], Callable], batch_rows: int = 4096) -> Scorer:
    """A model from outside: ``load`` runs once in each Python worker and gives a
    function of a (rows, features) array that returns the rows' scores."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import DoubleType
    score = predict_batch_udf(load, return_type=DoubleType(), batch_size=batch_rows, input_tensor_shapes=[[len(FEATURE_COLS)]])
    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURE_COLS])
    return Scorer(lambda claims: claims.withColumn("raw_score", score(vector)), True)


def saved_scorer(spark: SparkSession, path: str | None) -> Scorer:
    """The saved model if there is one, else the heuristic."""
    from ..session import path_exists
    return model_scorer(path) if path and path_exists(spark, path) else heuristic_scorer()


def score_with(scorer: Scorer, claims: DataFrame, threshold: Column | float = DEFAULT_THRESHOLD) -> DataFrame:
    """The scoring contract (clamp, flag, drivers) with any scorer."""
    return score_claims(scorer.apply(claims), threshold, raw_score=F.col("raw_score")).drop("raw_score")
