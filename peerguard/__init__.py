"""peerguard — a Spark-native engine for pre-payment claims auditing.

Raw claim and beneficiary files are normalized with explicit rejects, peer-group
outlier features are computed, claims are labeled by a calibrated multi-signal
rule, scored in batch or in Structured Streaming, and flagged claims land in an
idempotent audit table. All work is DataFrame expressions planned by Catalyst.
"""

__version__ = "0.1.0"
