"""Score a stream of claim requests with the heuristic, a saved model or a
plug-in (F4), enrich each micro-batch with the peer stats of the moment, and emit
responses and flag events (S5, K8, K9, J9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scoring import Scorer, flag_events, heuristic_scorer, score_responses, score_with, with_peer_stats
from ..operators.joins import temporary_table
from ..operators.serving import last_write_wins
from ..schemas import REQUEST_SCHEMA, REQUIRED_REQUEST_FIELDS
from .audit import flag_event_source
from .runs import read_folder, run_folder

NUMERIC_DEFAULTS = {"reimbursement_amt": 0.0, "length_of_stay_days": 0, "reimbursement_zscore": 0.0,
                    "los_zscore": 0.0, "visit_frequency_zscore": 0.0, "code_severity_percentile": 0.0,
                    "high_severity_code_pct": 0.0, "code_severity_outlier": 0}


def parse_requests(messages: DataFrame) -> DataFrame:
    """JSON text (column ``value``) -> the request's typed fields and
    ``parse_reason``: bad_json, or bad_<field> for the first field whose value
    isn't of its type (NULL = all are). A message is read with the fields' types; where
    that leaves anything open, its fields are read as text, so that a wrongly typed
    number is an error and not a missing value."""
    corrupt = T.StructField("_corrupt", T.StringType())
    read = lambda fields: F.from_json("value", T.StructType([*fields, corrupt]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    numbers = [f.name for f in REQUEST_SCHEMA.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    clean = F.col("t").isNotNull() & F.col("t._corrupt").isNull()
    for c in numbers:  # neither NaN nor infinite
        clean &= F.coalesce(F.abs(F.col(f"t.{c}")) < float("inf"), F.lit(True))
    text = [T.StructField(f.name, f.dataType if isinstance(f.dataType, T.ArrayType) else T.StringType()) for f in REQUEST_SCHEMA.fields]
    m = messages.select("value", read(REQUEST_SCHEMA.fields).alias("t")).select("value", "t", clean.alias("clean"))
    m = m.select("t", "clean", F.when(~F.col("clean"), read(text)).alias("m"))
    reason = F.when(F.col("clean"), F.lit(None)).when(F.col("m").isNull() | F.col("m._corrupt").isNotNull(), F.lit("bad_json"))
    cols = []
    for f in REQUEST_SCHEMA.fields:
        c = F.col(f"m.{f.name}")
        if not isinstance(f.dataType, (T.StringType, T.ArrayType)):
            typed = c.try_cast(f.dataType)
            if f.name in numbers:
                typed = F.nanvl(typed, F.lit(None).cast(f.dataType))
            reason = reason.when(c.isNotNull() & typed.isNull(), F.lit(f"bad_{f.name}"))
            c = typed
        cols.append(F.when(F.col("clean"), F.col(f"t.{f.name}")).otherwise(c).alias(f.name))
    return m.select(*cols, reason.alias("parse_reason"))


def validate_requests(requests: DataFrame) -> DataFrame:
    """Required ids present, defaults filled; ``reject_reason`` is the
    ``parse_reason`` (if the frame has one) or names the first missing required
    field (NULL = accepted)."""
    reason = None
    if "parse_reason" in requests.columns:
        reason = F.when(F.col("parse_reason").isNotNull(), F.col("parse_reason"))
    for f in REQUIRED_REQUEST_FIELDS:
        miss = F.col(f).isNull()
        reason = F.when(miss, F.lit(f"missing_{f}")) if reason is None else reason.when(miss, F.lit(f"missing_{f}"))
    cols = []
    for fld in REQUEST_SCHEMA.fields:
        c = F.col(fld.name)
        if fld.name in NUMERIC_DEFAULTS:
            c = F.coalesce(c, F.lit(NUMERIC_DEFAULTS[fld.name]).cast(fld.dataType))
        elif fld.name in ("diagnosis_codes", "procedure_codes"):
            c = F.coalesce(c, F.array().cast("array<string>"))
        cols.append(c.alias(fld.name))
    return requests.select(*cols, reason.alias("reject_reason"))


#: Messages are read once: less time for a few bytes more.
FAST_GZIP = ("zlib.compress.level", "BEST_SPEED")

#: What the sink's outputs read of a scored request.
SCORED_COLUMNS = ["claim_id", "provider_id", "provider_specialty", "claim_type", "score", "flagged", "threshold", "driver_features", "reject_reason"]


class ScoringSink:
    """foreachBatch target: responses and flag events per epoch folder.

    ``peers`` gives the peer table of the moment and is asked once a micro-batch
    (S8, J9): a table that was replaced meanwhile serves the next batch."""

    def __init__(self, out_dir: str, events_dir: str, flag_date: Column | None = None, ts: Column | None = None,
                 peers: Callable[[], DataFrame] | None = None, model_loaded: bool = False,
                 events_fmt: str = "text", events_options: dict[str, str] | None = None):
        self.out_dir, self.events_dir = out_dir.rstrip("/"), events_dir.rstrip("/")
        self.flag_date, self.ts, self.peers, self.model_loaded = flag_date, ts, peers, model_loaded
        self.events_fmt, self.events_options = events_fmt, events_options or {}

    def publish(self, events: DataFrame, at: str) -> None:
        """K8: the (key, value) messages to a folder of the epoch, or with another
        ``events_fmt`` to what its options name (``kafka``: a topic, at least once;
        not exercised here, as no connector is installed)."""
        if self.events_fmt == "text":
            events.select("value").write.mode("overwrite").option("compression", "gzip").option(*FAST_GZIP).text(f"{self.events_dir}/{at}")
        else:
            events.write.format(self.events_fmt).options(**self.events_options).mode("append").save()

    def write_batch(self, batch: DataFrame, epoch_id: int) -> None:
        """The batch is scored once, into a compressed table that lasts as long as
        the call and has the columns that the outputs read."""
        at = f"{run_folder(batch, f'{self.out_dir}/scores')}/batch_id={epoch_id}"
        with temporary_table(batch.select(*SCORED_COLUMNS), "scored_batch") as batch:
            good = batch.where(F.col("reject_reason").isNull())
            joined = with_peer_stats(good, self.peers()) if self.peers is not None else good
            score_responses(joined, self.model_loaded).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.out_dir}/scores/{at}")
            self.publish(flag_events(good, self.flag_date, self.ts), at)
            batch.where(F.col("reject_reason").isNotNull()).select("claim_id", "reject_reason") \
                .write.mode("overwrite").parquet(f"{self.out_dir}/rejects/{at}")


def run_scoring_stream(spark: SparkSession, requests_dir: str, peer_table: DataFrame | Callable[[], DataFrame], out_dir: str,
                       events_dir: str, checkpoint: str, threshold: Column | float = 0.5,
                       flag_date: Column | None = None, ts: Column | None = None,
                       available_now: bool = True, scorer: Scorer | None = None, files_per_batch: int | None = None,
                       fmt: str = "text", options: dict[str, str] | None = None,
                       events_fmt: str = "text", events_options: dict[str, str] | None = None):
    """X1 with any scorer (F4; the heuristic by default). ``peer_table`` is a frame
    or a function that gives the current one; ``fmt`` and ``options`` are those of
    the request source (S4's), ``events_fmt`` and its options of the events (K8)."""
    scorer = scorer or heuristic_scorer()
    options = dict(options or {}) | ({"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {})
    reqs = validate_requests(parse_requests(flag_event_source(spark, requests_dir, fmt, options)))
    scored = score_with(scorer, reqs, threshold).select(*SCORED_COLUMNS)  # what a batch doesn't read isn't worked out
    peers = peer_table if callable(peer_table) else lambda: peer_table
    sink = ScoringSink(out_dir, events_dir, flag_date, ts, peers, scorer.model_loaded, events_fmt, events_options)
    w = scored.writeStream.foreachBatch(sink.write_batch).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q


SCORES_SCHEMA = ("claim_id string, score double, flagged boolean, threshold double, provider_peer_stats struct<provider_specialty: string, "
                 "provider_id: string, claim_type: string, n_claims: int, avg_reimbursement: double, reimbursement_stddev: double, "
                 "avg_length_of_stay: double, los_stddev: double, avg_visit_freq_per_bene: double, peer_avg_visit_freq: double, "
                 "peer_visit_freq_stddev: double>, message string")


def read_scores(spark: SparkSession, out_dir: str, columns: list | None = None) -> DataFrame:
    """K9: the last response of each claim: of the latest run that scored it, and
    in it of the latest batch. Empty if nothing was scored. With ``columns``
    (claim_id among them), only those are moved and given."""
    rows = read_folder(spark, f"{out_dir.rstrip('/')}/scores", SCORES_SCHEMA)
    if columns:
        rows = rows.select(*columns, F.struct("run", "batch_id", "score").alias("_at"))
    else:
        rows = rows.withColumn("_at", F.struct("run", "batch_id", "score")).drop("run", "batch_id")
    return last_write_wins(rows, ["claim_id"], [F.col("_at").desc()]).drop("_at")


def read_request_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    return read_folder(spark, f"{out_dir.rstrip('/')}/rejects", "claim_id string, reject_reason string").drop("run", "batch_id")
