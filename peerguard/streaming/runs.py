"""Folders of the stream sinks: one per run and micro-batch.

Epochs count from 0 with each new checkpoint, so a batch is named by its run as
well: the id that Spark stores in the checkpoint, behind the time at which the
sink first met it. A replay of an epoch finds its run's folder and rewrites it;
another stream, or one with a fresh checkpoint, gets folders of its own and
erases nothing."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []


def run_folder(batch: DataFrame, path: str) -> str:
    """``run=<first met, ms>-<query id>`` of the stream that calls foreachBatch;
    outside of a stream, the run is named "batch"."""
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    for name in sorted(_folders(spark, path)):
        if name.startswith("run=") and name.endswith(f"-{query}"):
            return name
    return f"run={int(time.time() * 1000):015d}-{query}"


def read_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of all runs and batches with their ``run`` and ``batch_id``; a side
    that nothing was written to is empty."""
    full = T.StructType.fromDDL(schema).add("run", T.StringType()).add("batch_id", T.LongType())
    if not any(x.startswith("run=") for x in _folders(spark, path)):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)
