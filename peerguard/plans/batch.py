"""End-to-end batch runs (K1, K2): raw files → featured claims, peer stats and
profiles; featured claims → calibrated labels. Outputs are Parquet tables:
claims partitioned by (claim_year, claim_type) for partition pruning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as feat
from ..operators import ingest as ing
from ..operators import labels as lab
from ..operators.profiles import build_beneficiary_profiles
from ..sources import csv_files


@dataclass
class BuildOutputs:
    featured: str
    peer_stats: str
    profiles: str
    rejects: str


def build_dataset(spark: SparkSession, cms_dir: str, out_dir: str,
                  params: feat.FeatureParams = feat.FeatureParams()) -> BuildOutputs:
    """Read raw CSVs, normalize with rejects, compute features, peer stats and
    profiles, and write them (K1)."""
    out = out_dir.rstrip("/")
    normalized = ing.normalize_claims(csv_files.read_claim_files(spark, cms_dir))
    ing.rejected(normalized).write.mode("overwrite").parquet(f"{out}/claim_rejects.parquet")
    claims = feat.prepare_claims(ing.accepted(normalized))
    peer = feat.compute_peer_group_stats(claims, params.baseline)
    peer_path = f"{out}/provider_peer_stats.parquet"
    peer.write.mode("overwrite").parquet(peer_path)
    featured = feat.compute_all_features(claims, params, peer_stats=spark.read.parquet(peer_path), prepared=True)
    featured.write.mode("overwrite").partitionBy("claim_year", "claim_type").parquet(f"{out}/claims_featured.parquet")
    bene = csv_files.read_beneficiaries(spark, cms_dir)
    build_beneficiary_profiles(bene, claims).write.mode("overwrite").parquet(f"{out}/beneficiary_profile.parquet")
    return BuildOutputs(f"{out}/claims_featured.parquet", peer_path, f"{out}/beneficiary_profile.parquet",
                        f"{out}/claim_rejects.parquet")


def label_claims(spark: SparkSession, featured_path: str, out_path: str, target_rate: float = 0.025):
    """Calibrate on the written featured claims, write labeled claims (K2) and
    the one-row labeling summary (K11) next to them."""
    featured = spark.read.parquet(featured_path)
    labeled, cal = lab.calibrate_threshold(featured, target_rate)
    labeled.write.mode("overwrite").partitionBy("claim_year", "claim_type").parquet(out_path)
    lab.labeling_summary(spark.read.parquet(out_path), cal, target_rate).write.mode("overwrite") \
       .parquet(out_path.rstrip("/") + "_summary")
    return cal
