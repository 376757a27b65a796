"""Flag events → validated rows → idempotent audit table.

The same ``to_audit_rows`` transformation serves a batch frame or a stream.
The sink merges a micro-batch into the day partitions that it touches
(storage/keyed.py); the commit log puts the batches of all streams in the order
of their writes and knows the last batch of each run, so that a replay changes
nothing. Rejects and counts are folders of the run and epoch (runs.py), which a
replay rewrites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import temporary_table
from ..storage.keyed import KeyedTable
from .runs import read_folder, run_folder

# Message fields read as text so a bad score is a reject, not a silent NULL.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("claim_id", T.StringType()),
    T.StructField("provider_id", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("driver_features", T.StringType()),  # a list or a text
    T.StructField("flag_date", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])
AUDIT_KEY = ["flag_date", "score", "claim_id"]
AUDIT_COLUMNS = ["flag_date", "score", "claim_id", "provider_id", "driver_features"]


def to_audit_rows(messages: DataFrame, today: Column | None = None) -> DataFrame:
    """Parse JSON text (column ``value``) into audit rows plus ``reject_reason``
    (NULL = accepted): bad_json, bad_score, empty_claim_id. A missing or bad
    flag_date falls back to ``today`` (P27); a missing score is 0.0. One
    ``from_json`` per message; malformed text lands in the corrupt-record
    field instead of failing the stream."""
    today = today if today is not None else F.current_date()
    schema = T.StructType(RAW_EVENT_SCHEMA.fields + [T.StructField("_corrupt", T.StringType())])
    m = F.from_json(F.col("value"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = messages.select(F.col("value"), m.alias("m"))
    score_txt = F.col("m.score")
    score = F.nanvl(score_txt.try_cast("double"), F.lit(None).cast("double"))  # "NaN" is no score
    reason = (F.when(F.col("m").isNull() | F.col("m._corrupt").isNotNull(), F.lit("bad_json"))
               .when(score_txt.isNotNull() & score.isNull(), F.lit("bad_score"))
               .when(F.coalesce(F.col("m.claim_id"), F.lit("")) == "", F.lit("empty_claim_id")))
    return parsed.select(
        F.coalesce(F.try_to_date(F.col("m.flag_date"), "yyyy-MM-dd"), today).alias("flag_date"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
        F.col("m.claim_id").alias("claim_id"),
        F.coalesce(F.col("m.provider_id"), F.lit("")).alias("provider_id"),
        F.coalesce(F.to_json(F.from_json("m.driver_features", "array<string>")), F.col("m.driver_features"), F.lit("[]")).alias("driver_features"),
        F.col("m.timestamp").alias("event_time"),
        reason.alias("reject_reason"),
        F.col("value").alias("raw_value"))


def accepted_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNull()).select(*AUDIT_COLUMNS)


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNotNull()).select("reject_reason", "raw_value")


AUDIT_SCHEMA = "flag_date date, score double, claim_id string, provider_id string, driver_features string"


def audit_table(spark: SparkSession, path: str) -> KeyedTable:
    """K7: the audit table in day partitions, a row for each (flag_date, score,
    claim_id). Of a batch's messages with one key the last by their timestamp is
    kept (equal ones: by provider and drivers); a day is sorted by score."""
    return KeyedTable(spark, f"{path.rstrip('/')}/table", AUDIT_SCHEMA, "flag_date", AUDIT_KEY,
                      order=lambda: [F.col("event_time").desc_nulls_last(), F.col("provider_id"), F.col("driver_features")],
                      sort=lambda: [F.col("score").desc(), F.col("claim_id")])


class AuditTableSink:
    """K7 sink, the target of ``foreachBatch``: merges a batch into the days it
    touches and keeps its rejects and counts in folders of the run and epoch."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write_batch(self, batch: DataFrame, epoch_id: int) -> None:
        run = run_folder(batch, f"{self.path}/counts")
        # the messages are parsed once, into a compressed table that lasts as long as the call; the text of a good one isn't read again
        raw = F.when(F.col("reject_reason").isNotNull(), F.col("raw_value")).alias("raw_value")
        with temporary_table(batch.select(*AUDIT_COLUMNS, "event_time", "reject_reason", raw), "audit_batch") as batch:
            at = f"{run}/batch_id={epoch_id}"
            # Per-epoch totals, rewritten with the epoch on a replay; first, so that a replay finds its run
            batch.agg(F.count(F.lit(1)).alias("processed"),
                      F.coalesce(F.sum(F.col("reject_reason").isNotNull().cast("int")), F.lit(0)).alias("errors")) \
                 .write.mode("overwrite").parquet(f"{self.path}/counts/{at}")
            rejected_rows(batch).write.mode("overwrite").parquet(f"{self.path}/rejects/{at}")
            good = batch.where(F.col("reject_reason").isNull()).select(*AUDIT_COLUMNS, "event_time")
            audit_table(batch.sparkSession, self.path).merge(good, run, epoch_id)


def read_audit_table(spark: SparkSession, path: str, days: list | None = None) -> DataFrame:
    """The audit table: one row per (flag_date, score, claim_id), as the last
    commit left it. ``days`` reads those days' folders alone (S10). Empty if
    nothing was accepted."""
    return audit_table(spark, path).read(days)


def read_audit_rejects(spark: SparkSession, path: str) -> DataFrame:
    return read_folder(spark, f"{path.rstrip('/')}/rejects", "reject_reason string, raw_value string").drop("run")


def read_audit_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per-epoch processed/error totals."""
    return read_folder(spark, f"{path.rstrip('/')}/counts", "processed long, errors long")


def flag_event_source(spark: SparkSession, source: str, fmt: str = "text",
                      options: dict[str, str] | None = None) -> DataFrame:
    """A stream of JSON text messages in column ``value``. ``fmt="kafka"``
    reads a topic from the earliest offset (needs the Kafka connector on the
    classpath; not exercised here); otherwise a folder of JSON-lines files."""
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return r.load().select(F.col("value").cast("string").alias("value"))
    r = spark.readStream.format("text")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(source)


def run_audit_stream(spark: SparkSession, source: str, table_path: str, checkpoint: str,
                     fmt: str = "text", options: dict[str, str] | None = None,
                     today: Column | None = None, available_now: bool = True,
                     processing_time: str = "10 seconds"):
    """Consume flag events into the audit table. ``available_now``
    drains what is there and stops (tests, scheduled runs); otherwise a
    processing-time trigger polls until ``query.stop()``. Counts (A24) are
    observed per batch and visible in ``query.lastProgress``."""
    rows = to_audit_rows(flag_event_source(spark, source, fmt, options), today)
    rows = rows.observe("audit_counts", F.count(F.lit(1)).alias("processed"),
                        F.sum(F.col("reject_reason").isNotNull().cast("int")).alias("errors"))
    sink = AuditTableSink(table_path)
    w = rows.writeStream.foreachBatch(sink.write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
