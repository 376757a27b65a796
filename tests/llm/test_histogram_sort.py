"""Histogram sort against a sequential model of its rule."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from peerguard.llm import histogram_sort as hs

SCHEMA = "doc_id long, text string, h string, d int, r int, shard string, slot int, size string, law int, at int, cell int, _place int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "h", 1, 2, "s", 3, "z", 4, 5, 6, 7) for i, t in rows], SCHEMA).repartition(5)


def digest(s):
    return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)


def model(rows, shards, tolerance):
    """(doc_id, size, crc, shard, slot) in the order of the keys."""
    keys = sorted((digest(t or ""), digest("" if i is None else str(i)), n, len((t or "").encode()) + 1, i, zlib.crc32((t or "").encode())) for n, (i, t) in enumerate(rows))
    total, cuts = sum(k[3] for k in keys), []
    for j in range(1, shards):
        for level in (1, 2, 3):
            below, spans = 0, []
            for k in keys:
                if spans and spans[-1][0] == k[:level]:
                    spans[-1][2] += k[3]
                    spans[-1][3] += 1
                else:
                    spans.append([k[:level], below, below + k[3], 1])
                below += k[3]
            _, low, high, many = next(x for x in spans if shards * x[1] <= j * total < shards * x[2])
            under, over = j * total - shards * low, shards * high - j * total
            if min(under, over) <= tolerance * total or many == 1:
                break
        cuts.append(low if under <= over else high)
    out, below, slots = [], 0, [0] * shards
    for _, _, _, size, i, crc in keys:
        s = sum(c <= below for c in cuts)
        out.append((i, size, crc, s, slots[s]))
        slots[s] += 1
        below += size
    return out


def check(spark, rows, shards=8, tolerance=hs.TOLERANCE):
    df = hs.histogram_sort(table(spark, rows), shards, tolerance)
    got = sorted([tuple(r) for r in df.select("doc_id", "size", "text_crc32", "shard", "slot").collect()], key=str)
    assert got == sorted(model(rows, shards, tolerance), key=str)
    assert df.where("law <> 'bytes' or grown_shard is not null").count() == 0
    return df


@pytest.fixture(scope="module")
def rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    return rows + [(900, None), (901, ""), (None, "é 水 x"), (None, None), (902, "y" * 200_000), (903, " \n"), (903, " \n"), (7, rows[3][1])]


def test_equals_the_model(spark, rows):
    for shards, tolerance in ((8, hs.TOLERANCE), (3, 0.05), (1, 0.0), (20, 0.0)):
        check(spark, rows, shards, tolerance)


def test_hot_groups_are_cut_by_id_and_by_row(spark):
    rest = [(i, f"text {i} " * (i % 9)) for i in range(300)]
    many = check(spark, rest + [(1000 + i, "the same text " * 4) for i in range(300)])  # half of all rows, different ids
    size = [r[0] for r in many.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(size) == 8 and max(size) - min(size) <= 200
    same = check(spark, rest + [(5, "the same row " * 5)] * 300)  # equal rows: only their numbers tell them apart
    size = [r[0] for r in same.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(size) == 8 and max(size) - min(size) <= 200


def test_equal_texts_share_a_shard(spark, rows):
    copies = rows + [(2000 + i, rows[i][1]) for i in range(150)]
    df = check(spark, copies, 8, 1.0)
    assert df.groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_small_tables(spark):
    assert hs.histogram_sort(table(spark, [])).count() == 0
    check(spark, [(1, None)])
    check(spark, [(1, "a"), (1, "a"), (2, "a")])


def test_written_shards(spark, rows, tmp_path):
    df = hs.histogram_sort(table(spark, rows))
    hs.write_shards(df, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out").select(*df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_no_python_and_one_exchange_of_rows(spark, rows):
    wide = hs.keyed(table(spark, rows), "doc_id", "text")
    plan = wide.repartitionByRange("h", "d", "r").sortWithinPartitions("h", "d", "r")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("rangepartitioning") == 1
