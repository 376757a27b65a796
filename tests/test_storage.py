"""Stored tables: keyed merges, bucketed reads, versions, statistics kept up to date."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from peerguard.operators import features as feat
from peerguard.operators.moments import PeerStatsStore, merge_moments, moments
from peerguard.session import scratch_path
from peerguard.storage.bucketed import bucket_count, open_bucketed, read_id, read_ids, write_bucketed
from peerguard.storage.commits import CommitLog, Conflict
from peerguard.storage.keyed import KeyedTable
from peerguard.storage.versions import VersionedTable
from peerguard.streaming import audit as au


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def days_table(spark, path=None):
    return KeyedTable(spark, path or scratch_path(spark, "keyed"), "day date, k long, v string", "day", ["day", "k"], order=lambda: [F.col("v").desc()])


def batch(spark, *data):
    return spark.createDataFrame(data, "day string, k long, v string").withColumn("day", F.col("day").cast("date"))


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".parquet")}


def test_commit_log_takes_a_number_once(spark):
    log = CommitLog(spark, scratch_path(spark, "log"))
    assert log.last() == (0, {})
    log.commit(1, {"a": 1})
    with pytest.raises(Conflict):
        log.commit(1, {"a": 2})
    assert log.last() == (1, {"a": 1})


def test_merge_rewrites_touched_days_only(spark):
    t = days_table(spark)
    assert t.read().count() == 0
    assert t.merge(batch(spark, ("2024-01-01", 1, "a"), ("2024-01-02", 1, "b"), ("2024-01-02", 2, "c")), "one", 0)
    before = files(t.path)
    assert t.merge(batch(spark, ("2024-01-02", 2, "C"), ("2024-01-02", 3, "x"), ("2024-01-02", 3, "y")), "two", 0)
    after = files(t.path)
    assert all(after[f] == m for f, m in before.items())                       # nothing written is changed
    assert not any("day=2024-01-01" in f for f in set(after) - set(before))     # the untouched day has no new file
    got = [(str(d), k, v) for d, k, v in rows(t.read())]
    assert got == [("2024-01-01", 1, "a"), ("2024-01-02", 1, "b"), ("2024-01-02", 2, "C"), ("2024-01-02", 3, "y")]
    assert [r[2] for r in rows(t.read(["2024-01-01"]))] == ["a"] and t.read(["1999-01-01"]).count() == 0


def test_replay_changes_nothing_and_old_writer_may_win(spark):
    t = days_table(spark)
    first = batch(spark, ("2024-01-01", 1, "old"))
    t.merge(first, "a", 0)
    t.merge(batch(spark, ("2024-01-01", 1, "newer")), "b", 0)
    number = t.log.last()[0]
    assert not t.merge(first, "a", 0) and t.log.last()[0] == number              # a replay
    assert [r[2] for r in rows(t.read())] == ["newer"]
    t.merge(batch(spark, ("2024-01-01", 1, "last")), "a", 1)                     # the older writer writes last
    assert [r[2] for r in rows(t.read())] == ["last"]
    assert t.merge(batch(spark), "a", 2) and [r[2] for r in rows(t.read())] == ["last"]  # an empty batch is remembered


def test_concurrent_writers_lose_nothing(spark):
    path = scratch_path(spark, "keyed")
    errors = []

    def write(who):
        try:
            t = days_table(spark, path)
            for n in range(3):
                t.merge(batch(spark, ("2024-01-01", 10 * who + n, "s"), (f"2024-02-0{who}", n, "own")), f"w{who}", n)
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    threads = [threading.Thread(target=write, args=(w,)) for w in (1, 2, 3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = rows(days_table(spark, path).read().groupBy("day").count().select(F.col("day").cast("string"), "count"))
    assert got == [("2024-01-01", 9), ("2024-02-01", 3), ("2024-02-02", 3), ("2024-02-03", 3)]


def test_older_stream_that_writes_last_wins(spark):
    def message(provider, t):
        return json.dumps({"claim_id": "c", "provider_id": provider, "score": 0.9, "driver_features": ["a"], "flag_date": "2024-01-02", "timestamp": t})

    def put(path, text):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)
    table, a, b, ck = (scratch_path(spark, x) for x in ("audit", "a", "b", "ck"))
    for src, who, checkpoint in ((a, "A1", ck), (b, "B", scratch_path(spark, "ck")), (a, "A2", ck)):
        put(src, message(who, "2024-01-02T00:00:00Z"))
        au.run_audit_stream(spark, src, table, checkpoint)
        assert [r.provider_id for r in au.read_audit_table(spark, table).collect()] == [who]


def test_day_read_opens_that_day_only(spark):
    t = days_table(spark)
    t.merge(batch(spark, *[(f"2024-01-{d:02d}", k, "v") for d in range(1, 6) for k in range(4)]), "w", 0)
    assert {f.split("day=")[1][:10] for f in t.read(["2024-01-03"]).inputFiles()} == {"2024-01-03"}


# --- buckets ---------------------------------------------------------------------

@pytest.fixture
def shown_buckets(spark):
    """Spark leaves buckets out of a plan that has no join; files are skipped by them anyhow."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    yield
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_point_read_selects_one_bucket(spark, shown_buckets):
    df = spark.range(4000).select(F.concat(F.lit("c"), "id").alias("claim_id"), "id")
    t = write_bucketed(df, "claim_id", 16, path=(path := scratch_path(spark, "bucketed")))
    one = read_id(t, "claim_id", "c77")
    assert "SelectedBucketsCount: 1 out of 16" in plan(one) and rows(one) == [("c77", 77)]
    again = open_bucketed(spark, path, "claim_id string, id long", "claim_id", 16)
    assert "SelectedBucketsCount: 1 out of 16" in plan(read_id(again, "claim_id", "c5")) and again.count() == 4000


def test_bucketed_tables_join_without_exchange(spark):
    df = spark.range(4000).select(F.concat(F.lit("c"), "id").alias("claim_id"), "id")
    a, b = write_bucketed(df, "claim_id", 16), write_bucketed(df.withColumn("x", F.col("id") * 2), "claim_id", 16)
    joined = a.hint("merge").join(b, "claim_id")
    assert "Exchange" not in plan(joined) and joined.count() == 4000
    probe = read_ids(a.hint("merge"), "claim_id", df.where("id % 10 = 0"))
    assert probe.count() == 400


def test_stored_rows_move_once(spark):
    """The exchange of the dedup makes the buckets, and a lookup moves the asked ids alone."""
    from pyspark.sql import Window
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(4000).select(F.concat(F.lit("c"), F.col("id") % 3000).alias("claim_id"), F.col("id").cast("string").alias("payload"))
        one = df.withColumn("_rn", F.row_number().over(Window.partitionBy("claim_id").orderBy("payload"))).where("_rn = 1").drop("_rn")
        t = write_bucketed(one, "claim_id")
        got = read_ids(t, "claim_id", df.where("payload like '%7'"))
        assert not any("Exchange" in x and "payload" in x.split("Exchange")[1] for x in plan(got).splitlines() if "plan_id" in x)
        assert "Bucketed: true" in plan(got) and t.count() == 3000 and got.count() == 300
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_bucket_counts_divide_each_other():
    assert [bucket_count(n, 100) for n in (0, 100, 900, 1700)] == [8, 8, 16, 32]


def test_versions(spark):
    v = VersionedTable(spark, scratch_path(spark, "versions"))
    with pytest.raises(ValueError):
        v.read()
    v.publish(spark.range(3))
    old = v.read()
    v.publish(spark.range(5))
    assert old.count() == 3 and v.read().count() == 5


# --- moments ------------------------------------------------------------------------

def claims(spark):
    return feat.prepare_claims(spark.createDataFrame(
        [(f"c{i}", f"b{i % 7}", f"p{i % 5}", f"s{i % 2}", ("inpatient", "carrier")[i % 2], "2020-01-01", None, 2020, "d", ["d"], [],
          1e7 + i % 13 if i % 5 else 42.0, i % 9) for i in range(400)] + [("one", "b", "lonely", "s0", "carrier", "2020-01-01", None, 2020, "d", ["d"], [], 5.0, 1)],
        "claim_id string, beneficiary_id string, provider_id string, provider_specialty string, claim_type string, claim_start_date string, "
        "claim_end_date string, claim_year int, admit_diagnosis_cd string, diagnosis_codes array<string>, procedure_codes array<string>, "
        "reimbursement_amt double, length_of_stay_days int"))


def test_merged_moments_equal_a_full_pass(spark):
    c = claims(spark)
    half = F.pmod(F.hash("claim_id"), F.lit(2))
    merged = {r[:3]: r[3:] for r in map(tuple, merge_moments(moments(c.where(half == 0)), moments(c.where(half == 1))).collect())}
    whole = {r[:3]: r[3:] for r in map(tuple, moments(c).collect())}
    assert merged.keys() == whole.keys()
    for k, v in whole.items():
        assert v == pytest.approx(merged[k], rel=1e-9, abs=1e-6)


def test_store_applies_each_batch_once_and_compacts(spark, monkeypatch):
    monkeypatch.setattr("peerguard.operators.moments.COMPACT_AT", 3)
    c, store = claims(spark), PeerStatsStore(spark, scratch_path(spark, "store"))
    with pytest.raises(ValueError):
        store.stats()
    part = F.pmod(F.hash("claim_id"), F.lit(5))
    for k in range(5):
        assert store.update(c.where(part == k), f"b{k}")
        assert not store.update(c.where(part == k), f"b{k}")
    assert len(store.log.last()[1]["visits"]) < 3
    want = {(r.provider_specialty, r.provider_id, r.claim_type): tuple(r)[3:] for r in feat.compute_peer_group_stats(c).collect()}
    got = {(r.provider_specialty, r.provider_id, r.claim_type): tuple(r)[3:] for r in store.stats().collect()}
    assert want.keys() == got.keys()
    for k, v in want.items():
        assert [x is None for x in got[k]] == [x is None for x in v]
        assert [x or 0 for x in got[k]] == pytest.approx([x or 0 for x in v], rel=1e-9)


def test_update_reads_new_claims_only(spark):
    c, store = claims(spark), PeerStatsStore(spark, scratch_path(spark, "store"))
    part = F.pmod(F.hash("claim_id"), F.lit(2))
    paths = []
    for k in (0, 1):
        paths.append(scratch_path(spark, "half"))
        c.where(part == k).write.parquet(paths[-1])
    store.update(spark.read.parquet(paths[0]), "one")
    gone = paths[0].replace("file:", "")
    os.rename(gone, gone + "-away")                     # the older claims can't be read any more
    store.update(spark.read.parquet(paths[1]), "two")
    assert store.stats().agg(F.sum("n_claims")).first()[0] == c.count()


def test_scratch_can_be_closed(spark, monkeypatch):
    from peerguard import session
    monkeypatch.setattr(session, "_scratch_root", lambda s, root=session._scratch_root(spark): f"{root}-closed")
    path, own = session.scratch_path(spark, "x"), session.ensure_checkpoint_dir(spark) + "/kept"
    spark.range(3).write.parquet(path)
    spark.range(3).write.mode("overwrite").parquet(own)
    assert session.close_scratch(spark) and not session.path_exists(spark, path) and session.path_exists(spark, own)
