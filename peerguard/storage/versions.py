"""A table that is replaced as a whole: readers ask for the version of the moment."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .commits import CommitLog, Conflict


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    def publish(self, df: DataFrame) -> int:
        """Write ``df`` as the next version; of two at once, the later commit is the
        current one. Older versions stay readable for queries that run on them."""
        folder = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{folder}")
        while True:
            number, _ = self.log.last()
            try:
                self.log.commit(number + 1, {"folder": folder})
                return number + 1
            except Conflict:
                continue

    def read(self) -> DataFrame:
        number, state = self.log.last()
        if not number:
            raise ValueError(f"{self.path}: nothing published yet")
        return self.spark.read.parquet(f"{self.path}/data/{state['folder']}")
