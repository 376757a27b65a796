"""Audit stream: rejects, replay safety, polling trigger."""

import json
import os

from pyspark.sql import functions as F

from peerguard.session import scratch_path
from peerguard.streaming import audit as au


def _messages():
    good = {"claim_id": "c1", "provider_id": "p1", "score": 0.9, "driver_features": ["a", "b"],
            "flag_date": "2024-01-02", "timestamp": "2024-01-02T00:00:00Z"}
    other = dict(good, claim_id="c2", score=0.8)
    same_claim_new_score = dict(good, score=0.95)
    return [json.dumps(good), json.dumps(good), json.dumps(other), json.dumps(same_claim_new_score),
            "{not json", json.dumps(dict(good, claim_id="")), json.dumps(dict(good, claim_id="c3", flag_date="x")),
            json.dumps(dict(good, claim_id="c4", score="high"))]


def _write(spark, lines):
    p = scratch_path(spark, "msgs")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(p)
    return p


def test_replay_gives_same_table(spark):
    src = _write(spark, _messages())
    table = scratch_path(spark, "audit")
    au.run_audit_stream(spark, src, table, scratch_path(spark, "ck"))
    first = sorted(tuple(r) for r in au.read_audit_table(spark, table).collect())
    au.run_audit_stream(spark, src, table, scratch_path(spark, "ck"))
    second = sorted(tuple(r) for r in au.read_audit_table(spark, table).collect())
    assert first == second
    keys = [(str(r[0]), r[1], r[2]) for r in first]
    assert ("2024-01-02", 0.9, "c1") in keys and ("2024-01-02", 0.95, "c1") in keys   # two scores → two rows
    assert len([k for k in keys if k[2] == "c1" and k[1] == 0.9]) == 1                 # same event twice → one
    rej = {r.reject_reason for r in au.read_audit_rejects(spark, table).collect()}
    assert rej == {"bad_json", "empty_claim_id", "bad_score"}
    c3 = [r for r in first if r[2] == "c3"]
    assert len(c3) == 1          # bad flag_date → today's date, still written


def test_polling_trigger_stops(spark):
    src = _write(spark, _messages()[:2])
    table = scratch_path(spark, "audit")
    q = au.run_audit_stream(spark, src, table, scratch_path(spark, "ck"), available_now=False,
                            processing_time="1 second")
    q.processAllAvailable()
    prog = q.lastProgress
    q.stop()
    assert not q.isActive
    assert au.read_audit_table(spark, table).count() == 1
    assert prog is not None


def test_second_stream_keeps_first_and_empty_sides_read(spark):
    one = {"claim_id": "a", "provider_id": "p", "score": 0.5, "driver_features": "plain text", "flag_date": "2024-01-02"}
    two = dict(one, claim_id="b", driver_features=["x"])
    table = scratch_path(spark, "audit")
    au.run_audit_stream(spark, _write(spark, [json.dumps(one)]), table, scratch_path(spark, "ck"))
    assert au.read_audit_rejects(spark, table).count() == 0            # a clean run
    au.run_audit_stream(spark, _write(spark, [json.dumps(two), json.dumps(dict(one, provider_id="q"))]), table, scratch_path(spark, "ck"))
    got = {r.claim_id: (r.provider_id, r.driver_features) for r in au.read_audit_table(spark, table).collect()}
    assert got == {"a": ("q", "plain text"), "b": ("p", '["x"]')}
    other = scratch_path(spark, "audit")
    au.run_audit_stream(spark, _write(spark, ["{broken", json.dumps(dict(one, score="NaN"))]), other, scratch_path(spark, "ck"))
    assert au.read_audit_table(spark, other).count() == 0              # nothing accepted
    assert {r.reject_reason for r in au.read_audit_rejects(spark, other).collect()} == {"bad_json", "bad_score"}


def test_same_checkpoint_rewrites_its_own_batches(spark):
    table, ck = scratch_path(spark, "audit"), scratch_path(spark, "ck")
    src = _write(spark, _messages()[:2])
    au.run_audit_stream(spark, src, table, ck)
    spark.createDataFrame([(_messages()[2],)], "value string").coalesce(1).write.mode("append").text(src)
    au.run_audit_stream(spark, src, table, ck)
    counts = au.read_audit_counts(spark, table).collect()
    assert len({r.run for r in counts}) == 1 and len({r.batch_id for r in counts}) == len(counts) == 2


def test_sinks_keep_no_copy_of_a_batch(spark, tmp_path):
    """Requests are compressed; a batch's table is gone when its outputs are there;
    scores can be read by some of their columns."""
    from peerguard.operators.joins import temporary_table
    from peerguard.plans.catalog import write_requests
    from peerguard.streaming import scoring as ss
    rows = spark.createDataFrame([{"claim_id": c, "beneficiary_id": "b", "provider_id": "p", "provider_specialty": "s", "claim_type": "carrier",
                                   "reimbursement_zscore": z} for c, z in (("a", 9.0), ("b", 0.1))])
    with temporary_table(rows, "some") as t:
        at = t.inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert os.path.exists(at) and t.count() == 2
    assert not os.path.exists(at)
    src = str(tmp_path / "req")
    write_requests(rows.withColumns({c: F.current_date() for c in ("claim_start_date", "claim_end_date")}), src)
    assert all(f.endswith((".gz", ".crc", "_SUCCESS")) for f in os.listdir(src))
    peers = spark.createDataFrame([], ss.T.StructType.fromDDL(ss.SCORES_SCHEMA)["provider_peer_stats"].dataType)
    ss.run_scoring_stream(spark, src, peers, str(tmp_path / "out"), str(tmp_path / "ev"), str(tmp_path / "ck"))
    assert {(r.claim_id, r.flagged) for r in ss.read_scores(spark, str(tmp_path / "out"), ["claim_id", "flagged"]).collect()} == {("a", True), ("b", False)}
    assert ss.read_scores(spark, str(tmp_path / "out")).columns[-1] == "message" and spark.read.text(str(tmp_path / "ev")).count() == 1
