"""Join and materialization helpers.

Joins carry no hint: adaptive execution broadcasts a side whose bytes, as
measured by then, are under Spark's threshold, and splits skewed partitions of
the others.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path

class Small:
    """A materialized table plus its exact row count."""

    def __init__(self, df: DataFrame, rows: int):
        self.df = df
        self.rows = rows


def checked(df: DataFrame) -> Small:
    """Write ``df`` to the shared folder; its exact row count is observed during
    that same job (no extra count pass). The files' size tells the joins to come
    whether the table can be broadcast, before anything is moved for them."""
    obs = Observation()
    m = write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), "small")
    return Small(m, int(obs.get["rows"]))


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage is cut and later scans get column pruning and pushdown."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_step(df: DataFrame, name: str) -> DataFrame:
    """:func:`write_table` at the end of a large step: the shuffle files of steps that
    nothing refers to any more are dropped at once, not when the driver's heap is full."""
    out = write_table(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


@contextmanager
def temporary_table(df: DataFrame, name: str):
    """``df`` written as by :func:`write_table`, and removed at the end of the block."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield df.sparkSession.read.parquet(path)
    finally:
        remove_path(df.sparkSession, path)


def in_parallel(*thunks):
    """Run independent actions (small materializations) from driver threads so
    their short stages overlap; Spark schedules concurrent jobs of one
    session side by side. Returns the results in order."""
    from concurrent.futures import ThreadPoolExecutor
    if len(thunks) == 1:
        return [thunks[0]()]
    with ThreadPoolExecutor(max_workers=len(thunks)) as ex:
        futs = [ex.submit(t) for t in thunks]
        return [f.result() for f in futs]
