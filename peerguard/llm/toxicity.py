"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum over pairs <v_i, v_j>) over the distinct terms
of a text, so a pair of terms (an insult and a group) can count for more or less
than its two parts. Terms are lower-cased runs of letters and digits, hashed to
2**18 buckets. The machine is fitted on at most ``train_docs`` labelled
documents of the learning folds (those with the smallest hash of their id), on
the at most ``width`` buckets whose share among toxic and other documents
differs by more than ``Z`` standard errors; each document is scored whole."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, ship_package, store
from .decontaminate import tokens

BUCKETS, RANK, Z = 1 << 18, 4, 4.0
FOLDS = 5


def bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


class Machine:
    """Bias, weights and factors of the chosen buckets."""

    def __init__(self, buckets: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.slot = {int(b): i for i, b in enumerate(buckets)}
        self.bias, self.w, self.v = bias, w, v

    def score(self, slots: tuple[int, ...]) -> float:
        z = self.bias
        if slots:
            s = list(slots)
            x = self.v[s]
            z += self.w[s].sum() + 0.5 * float((x.sum(axis=0) ** 2).sum() - (x ** 2).sum())
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, float(z)))))


def fit(x: np.ndarray, y: np.ndarray, rank: int = RANK, rounds: int = 400, l2: float = 5e-5, rate: float = 0.05):
    """Bias, weights and factors by full-batch Adam on the logistic loss."""
    rng = np.random.default_rng(7)
    n, k = x.shape
    p = [np.array([math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))]), np.zeros(k), rng.normal(0, 0.05, (k, rank))]
    m, s = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for t in range(1, rounds + 1):
        xv = x @ p[2]
        z = p[0] + x @ p[1] + 0.5 * ((xv ** 2).sum(axis=1) - x @ (p[2] ** 2).sum(axis=1))
        e = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / n
        g = [np.array([e.sum()]), x.T @ e + l2 * p[1], x.T @ (e[:, None] * xv) - p[2] * (x.T @ e)[:, None] + l2 * p[2]]
        for a, b, m_, s_ in zip(p, g, m, s):
            m_ += 0.1 * (b - m_)
            s_ += 0.001 * (b * b - s_)
            a -= rate * (m_ / (1 - 0.9 ** t)) / (np.sqrt(s_ / (1 - 0.999 ** t)) + 1e-8)
    return float(p[0][0]), p[1], p[2]


def _buckets(batches):
    for batch in batches:
        found = [sorted({bucket(t) for t in set(tokens(x))}) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["y", "b"])


def train(docs: DataFrame, labels: DataFrame, train_docs: int = 20_000, width: int = 256) -> Machine:
    """Fits the machine. ``docs``: doc_id, text. Without a labelled row of each
    class the score is the share of toxic ones (smoothed) for every text."""
    learn = (labels.where("doc_id is not null and toxic in (0, 1)").where(remainder(F.col("doc_id"), FOLDS) != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs))
    rows = store(docs.join(F.broadcast(learn), "doc_id").select("y", "text").mapInArrow(_buckets, "y int, b array<int>"), "terms")
    size = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    n, pos = int(size[0]), int(size[1])
    if not pos or pos == n:
        return Machine(np.zeros(0, int), math.log((pos + 0.5) / (n - pos + 0.5)), np.zeros(0), np.zeros((0, RANK)))
    share = F.col("n") / n
    z = (F.col("pos") / pos - (F.col("n") - F.col("pos")) / (n - pos)) / F.sqrt(share * (1 - share) * (1 / pos + 1 / (n - pos)) + 1e-12)
    chosen = (rows.select("y", F.explode("b").alias("b")).groupBy("b").agg(F.count("*").alias("n"), F.sum("y").alias("pos"))
              .where("n >= 5").withColumn("z", F.abs(z)).where(F.col("z") > Z).orderBy(F.desc("z"), "b").limit(width).collect())
    buckets = np.array(sorted(r["b"] for r in chosen), "int64")
    sample = rows.select("y", F.array_intersect("b", F.array(*(F.lit(int(b)) for b in buckets)).cast("array<int>")).alias("b")).collect()
    x, y = np.zeros((n, len(buckets))), np.array([r["y"] for r in sample], float)
    for i, r in enumerate(sample):
        x[i, np.searchsorted(buckets, r["b"])] = 1
    return Machine(buckets, *fit(x, y))


def _score(shared):
    def run(batches):
        m: Machine = shared.value
        memo: dict[str, int] = {}
        scores: dict[tuple[int, ...], float] = {}
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                slots = set()
                for t in set(tokens(text)):
                    k = memo.get(t)
                    if k is None:
                        if len(memo) >= 400_000:
                            memo.clear()
                        k = memo[t] = m.slot.get(bucket(t), -1)
                    if k >= 0:
                        slots.add(k)
                key = tuple(sorted(slots))
                if key not in scores:
                    if len(scores) >= 100_000:
                        scores.clear()
                    scores[key] = m.score(key)
                out.append(scores[key])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row. Null and empty texts get
    the score of no term; a null id stays null and is in fold 0; equal rows are
    scored each; several labels of one document count as toxic if one is. Other
    columns are no input of a score."""
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    m = docs.sparkSession.sparkContext.broadcast(train(base, labels, train_docs))
    return (base.mapInArrow(_score(m), "doc_id long, score double")
            .select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
