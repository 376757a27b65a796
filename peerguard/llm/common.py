"""Helpers shared by the operators: tables, shared-folder scratch, word hashes."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..session import ship_package as _ship_package
from ..sources.tables import table

__all__ = ["table", "store", "ship_package", "scratch_path", "WordHash", "mix", "shingles",
           "lower_words", "key64", "remainder", "slices", "U64", "tidy"]

U64 = np.uint64
WORDS = r"[^\x20\x09-\x0D]+"


#: Bytes of an Arrow batch, which a task holds in the JVM and in Python at once.
ARROW_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """The package to the workers, and Arrow batches of bounded bytes: by their
    number of rows alone (Spark's usual bound), whole texts make them large."""
    _ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, "64m").rstrip("bB").replace("m", "000000")) > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def store(df: DataFrame, name: str, codec: str = "snappy", group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back:
    lineage ends there, so a lost executor costs a re-read and not a recompute.
    ``group_bytes``: of a row group, which a writing task holds (Parquet's default: 128 MB)."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.option("compression", codec)
    (w.option("parquet.block.size", group_bytes) if group_bytes else w).parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()  # lets Spark's cleaner drop the shuffle files of finished steps
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m (the fold of a document). A null id is
    in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % m, F.lit(0))


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches, rows: int):
    """Smaller Arrow batches, which bound what Python holds at once."""
    for batch in batches:
        for s in range(0, batch.num_rows, rows):
            yield batch.slice(s, rows)


def tidy(run):
    """``run`` (a function of Arrow batches) that gives its memory back when a task
    ends: Spark keeps Python workers for later tasks, with all that they hold."""
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # no glibc
            ctypes.CDLL(None).malloc_trim(0)
    return wrapped


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (wrap-around arithmetic)."""
    h = h ^ (h >> U64(31))
    h = h * U64(0x9E3779B97F4A7C15)
    h = h ^ (h >> U64(29))
    h = h * U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


class WordHash(dict):
    """word bytes -> 64-bit hash; a memo that is emptied when it is full, so its
    size doesn't follow the vocabulary."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        v = self[w] = xxhash.xxh64_intdigest(w)
        return v

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8 (bytes.lower
    and bytes.split know ASCII letters and exactly these white-space bytes)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows of the word hashes, in order; fewer than k
    words make one shingle of the whole sequence."""
    if not len(h):
        return h
    if len(h) < k:
        w = U64(len(h))
        for x in h:
            w = w * U64(0xD6E8FEB86659FD93) + x
        return mix(np.array([w], U64))
    n = len(h) - k + 1
    w = np.full(n, k, U64)
    for i in range(k):
        w = w * U64(0xD6E8FEB86659FD93) + h[i:i + n]
    return mix(w)


def key64(a: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs."""
    return a.view(np.int64)


np.seterr(over="ignore")
