"""Peer statistics kept up to date by new claims alone (K5 with A2–A4): the store
holds count, mean and sum of squared deviations (M2) of each provider key, which
merge by the pairwise formula, and the visit counts, which add up."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage.commits import CommitLog, Conflict
from .features import PROVIDER_KEY, VISIT_KEY, finish_peer_stats, provider_visit_frequency, visit_counts

#: measured column -> names of its mean and standard deviation
MEASURES = {"reimbursement_amt": ("avg_reimbursement", "reimbursement_stddev"), "length_of_stay_days": ("avg_length_of_stay", "los_stddev")}
#: Visit tables of single batches that are summed into one when so many are there.
COMPACT_AT = 16


def moments(claims: DataFrame) -> DataFrame:
    """(key, n_claims, and of each measure n, mean, m2, least, most)."""
    aggs = [F.count("claim_id").alias("n_claims")]
    for c in MEASURES:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}_n"), F.avg(x).alias(f"{c}_mean"), (F.var_pop(x) * F.count(x)).alias(f"{c}_m2"),
                 F.min(x).alias(f"{c}_least"), F.max(x).alias(f"{c}_most")]
    return claims.groupBy(*PROVIDER_KEY).agg(*aggs)


def merge_moments(a: DataFrame, b: DataFrame) -> DataFrame:
    """Key by key: n = na + nb, d = mean_b - mean_a, mean = mean_a + d nb / n,
    M2 = M2a + M2b + d^2 na nb / n. A key of one side stays as it is."""
    a, b = a.alias("a"), b.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in PROVIDER_KEY]
    here, there = F.col("a.n_claims").isNotNull(), F.col("b.n_claims").isNotNull()
    out = [F.when(here, F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in PROVIDER_KEY]
    out.append((F.coalesce("a.n_claims", F.lit(0)) + F.coalesce("b.n_claims", F.lit(0))).alias("n_claims"))

    for c in MEASURES:
        na, nb = F.coalesce(f"a.{c}_n", F.lit(0)), F.coalesce(f"b.{c}_n", F.lit(0))
        n, d = na + nb, F.col(f"b.{c}_mean") - F.col(f"a.{c}_mean")

        def merged(what: str, both: Column, c=c, na=na, nb=nb) -> Column:
            return F.when(nb == 0, F.col(f"a.{c}_{what}")).when(na == 0, F.col(f"b.{c}_{what}")).otherwise(both).alias(f"{c}_{what}")

        out += [n.alias(f"{c}_n"), merged("mean", F.col(f"a.{c}_mean") + d * nb / n),
                merged("m2", F.col(f"a.{c}_m2") + F.col(f"b.{c}_m2") + d * d * na * nb / n),
                merged("least", F.least(f"a.{c}_least", f"b.{c}_least")), merged("most", F.greatest(f"a.{c}_most", f"b.{c}_most"))]
    return a.join(b, on, "full").select(*out)


def stats_of_moments(m: DataFrame) -> DataFrame:
    """A2 from moments: means and sample deviations; 0 where least and most agree."""
    cols = []
    for c, (mean, std) in MEASURES.items():
        n = F.col(f"{c}_n")
        cols += [F.col(f"{c}_mean").alias(mean),
                 F.when(F.col(f"{c}_least") == F.col(f"{c}_most"), F.lit(0.0)).when(n > 1, F.sqrt(F.col(f"{c}_m2") / (n - 1))).alias(std)]
    return m.select(*PROVIDER_KEY, "n_claims", *cols)


class PeerStatsStore:
    """Moments and visit counts under ``path``. A batch of claims is applied once,
    by its id: a repeated id changes nothing. Each claim id belongs to one batch
    (deduplicate across batches before, as K3's table does)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def _read(self, *names: str) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.path}/{n}" for n in names))

    def update(self, claims: DataFrame, batch: str, attempts: int = 10) -> bool:
        """Apply new claims; reads them and the stored moments, no older claim."""
        fresh = visits = None
        for _ in range(attempts):
            number, state = self.log.last()
            if batch in state.get("batches", []):
                return False
            if fresh is None:
                fresh, visits = self._write(moments(claims), "batch"), self._write(visit_counts(claims), "visits")
            # keys of the batch that are stored nowhere yet, or merged with what is
            stored = state.get("moments")
            now = self._write(merge_moments(self._read(stored), self._read(fresh)), "moments") if stored else fresh
            names = [*state.get("visits", []), visits]
            if len(names) >= COMPACT_AT:
                names = [self._write(self._summed(names), "visits")]
            try:
                self.log.commit(number + 1, {"moments": now, "visits": names, "batches": [*state.get("batches", []), batch]})
                return True
            except Conflict:
                continue
        raise RuntimeError(f"{self.path}: no commit in {attempts} attempts")

    def _summed(self, names: list[str]) -> DataFrame:
        return self._read(*names).groupBy(*VISIT_KEY).agg(F.sum("visit_count").alias("visit_count"))

    def stats(self) -> DataFrame:
        """Peer statistics of all applied claims: the rows that
        ``compute_peer_group_stats`` gives over them."""
        _, state = self.log.last()
        if not state:
            raise ValueError(f"{self.path}: no batch applied yet")
        return finish_peer_stats(stats_of_moments(self._read(state["moments"])), provider_visit_frequency(self._summed(state["visits"])))
