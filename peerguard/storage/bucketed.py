"""Bucketed serving tables (K3, K6, S6, S9): rows are hashed into files by the key
that they are read by. A read of one id opens the one bucket that can hold it, and
tables with equal buckets join on the key without an exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows of a bucket: some hundred megabytes of claims.
BUCKET_ROWS = 1_000_000


def bucket_count(rows: int, per_bucket: int = BUCKET_ROWS) -> int:
    """Buckets by a known number of rows: a power of two, so that tables of different sizes have buckets of which one
    number divides the other and join without moving both."""
    n = 1
    while n * per_bucket < rows:
        n *= 2
    return max(n, 8)


def write_bucketed(df: DataFrame, key: str, buckets: int | None = None, path: str | None = None, name: str | None = None,
                   dealt: bool = False) -> DataFrame:
    """Write ``df`` in buckets of ``key``, sorted inside, as an external table of
    the session's catalog, and return the table. Rows are dealt out by the hash
    that names the bucket, so each bucket is one file (of one task). Without
    ``buckets`` there are as many as the session's shuffles have partitions: rows that a
    window or an aggregate by the key has dealt out aren't moved again, and joins keep
    the buckets. A key should be near unique: the rows of one value share a bucket.
    ``dealt``: the rows lie in such partitions, whatever their plan says."""
    spark = df.sparkSession
    name = name or f"peerguard_{uuid.uuid4().hex[:12]}"
    path = path or scratch_path(spark, name)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df if dealt else df.repartition(buckets, key)
    (rows.write.mode("overwrite").format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """A written table in another session: its catalog has to be told the buckets."""
    name = name or f"peerguard_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)


def read_id(table: DataFrame, key: str, value) -> DataFrame:
    """The rows of one id: one bucket, and in it the row groups whose range holds
    the value."""
    return table.where(F.col(key) == F.lit(value))


def read_ids(table: DataFrame, key: str, requests: DataFrame) -> DataFrame:
    """The rows of the requested ids. Only the requests are moved, to the buckets'
    layout or, where they are few bytes, to every task."""
    return table.join(requests.select(key).distinct(), key, "left_semi")
