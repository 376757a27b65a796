"""A keyed table in partitions: an upsert reads, merges and rewrites only the
partitions that its rows touch, and a commit log orders the writes of all streams
and jobs (K7, X3).

Layout: ``data/c=<commit folder>/<partition>=<value>/*.parquet``, and the log's
last record, which names the folder of each partition value. A folder is never
changed after its commit; readers of an earlier record keep a whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commits import CommitLog, Conflict


class KeyedTable:
    """``schema``: the columns as DDL, ``partition`` among them; ``key``: the
    columns that name a row; ``order``: which of a batch's rows with one key is
    the last write (the first by this order; equal ones are the same to it)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, partition: str, key: list[str],
                 order: Callable[[], list[Column]], sort: Callable[[], list[Column]] | None = None, attempts: int = 20):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), T.StructType.fromDDL(schema)
        self.partition, self.key, self.order, self.attempts = partition, key, order, attempts
        self.sort = sort or (lambda: [F.col(k) for k in key])
        self.log = CommitLog(spark, f"{self.path}/log")

    # --- reading ---------------------------------------------------------------
    def _rows(self, parts: dict[str, str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rest = T.StructType([f for f in self.schema.fields if f.name != self.partition])
        at = T.StructType([*rest.fields, T.StructField("c", T.StringType()), T.StructField(self.partition, T.StringType())])
        paths = [f"{self.path}/data/c={c}/{self.partition}={value}" for value, c in parts.items()]
        rows = self.spark.read.schema(at).option("basePath", f"{self.path}/data").parquet(*paths)
        kind = self.schema[self.partition].dataType
        return rows.withColumn(self.partition, F.col(self.partition).cast(kind)).select(*self.schema.names)

    def read(self, values: list | None = None) -> DataFrame:
        """The table at its last commit; with ``values``, those partitions alone
        (no other folder is listed or read)."""
        _, state = self.log.last()
        parts = state.get("parts", {})
        if values is not None:
            parts = {v: parts[v] for v in map(str, values) if v in parts}
        return self._rows(parts)

    # --- writing ---------------------------------------------------------------
    def merge(self, batch: DataFrame, writer: str, batch_id: int) -> bool:
        """Upsert ``batch`` (a replay of the writer's last batch or an older one
        changes nothing and gives False). A batch's row replaces the table's row
        of its key, whichever stream wrote that; rows of other keys stay. The
        driver learns the batch's partition values, not its rows.

        If another writer commits meanwhile, the merge is made again when that
        one touched the same partitions, else only the commit is."""
        from ..operators.serving import last_write_wins
        rows = last_write_wins(batch.select(*self.schema.names, *[c for c in batch.columns if c not in self.schema.names]), self.key, self.order())
        rows = rows.select(*self.schema.names)
        seen = batch if self.partition in self.key else rows  # no partition loses all of its keys
        touched = [r[0] for r in seen.select(F.col(self.partition).cast("string")).distinct().collect()]
        folder, base = None, None
        for _ in range(self.attempts):
            number, state = self.log.last()
            if state.get("writers", {}).get(writer, -1) >= batch_id:
                return False
            parts = state.get("parts", {})
            now = {v: parts.get(v) for v in touched}
            if touched and (folder is None or now != base):
                folder, base = uuid.uuid4().hex, now
                self._write(rows, {v: c for v, c in now.items() if c}, folder)
            try:
                self.log.commit(number + 1, {"parts": parts | {v: folder for v in touched},
                                             "writers": state.get("writers", {}) | {writer: batch_id}})
                return True
            except Conflict:
                continue
        raise RuntimeError(f"{self.path}: no commit in {self.attempts} attempts")

    def _write(self, rows: DataFrame, old: dict[str, str], folder: str) -> None:
        """The touched partitions, merged. Partitions are ranges of (partition,
        sort), so a large one is several tasks and files."""
        if old:
            kept = self._rows(old).join(rows.select(*self.key), self.key, "left_anti")
            rows = kept.unionByName(rows)
        (rows.repartitionByRange(self.partition, *self.sort()).sortWithinPartitions(self.partition, *self.sort())
         .write.partitionBy(self.partition).parquet(f"{self.path}/data/c={folder}"))
