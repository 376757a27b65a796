"""Sharding by histogram sort, native: rows are ordered by a key of text and id,
splitters come from exact byte counts below candidate keys that are refined from
round to round, and one range exchange then moves every row to its shard. Only
DataFrame functions; the driver sees the cells of the open brackets."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

#: Shards, and the share of a shard's mean bytes by which a splitter may miss its
#: target so as not to part a group of equal texts.
SHARDS, TOLERANCE = 8, 0.002
#: Cells that a round counts in each open bracket: ten bits of the key a round.
CELLS = 1024
#: Key parts, each a number from 0 to 2**60 - 1 (h, d) or a row's number (r).
PARTS = ("h", "d", "r")


@dataclass(frozen=True)
class Bracket:
    """The keys that start with ``prefix`` and go on with low..high, and the bytes
    and rows of all smaller keys."""
    prefix: tuple
    low: int
    high: int
    below: int
    rows: int

    @property
    def part(self) -> str:
        return PARTS[len(self.prefix)]

    @property
    def step(self) -> int:
        return -(-(self.high - self.low + 1) // CELLS)

    def holds(self) -> Column:
        held = F.col(self.part).between(self.low, self.high)
        for name, value in zip(PARTS, self.prefix):
            held = held & (F.col(name) == value)
        return held


@dataclass(frozen=True)
class Splitter:
    """The first key of a shard; parts that it leaves out are below all others."""
    key: tuple
    below: int
    rows: int


def digest(c: Column) -> Column:
    """60 bits of the MD5 as a number."""
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 15), 16, 10).cast("long")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    i, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(i.alias("doc_id"), F.col(f"`{text_col}`").alias("text"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), digest(text).alias("h"),
                       digest(F.coalesce(i.cast("string"), F.lit(""))).alias("d"), F.monotonically_increasing_id().alias("r"))


def histogram(rows: DataFrame, open_: list[Bracket]) -> dict[Bracket, list]:
    """Exact bytes and rows of the CELLS cells of each bracket, in key order. Each
    task sums its own cells first, so that a task sends CELLS rows a bracket at most."""
    at, cell, part = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for k, b in enumerate(open_):
        at = F.when(b.holds(), F.lit(k)).otherwise(at)
    for k, b in enumerate(open_):
        part = F.when(F.col("at") == k, F.col(b.part)).otherwise(part)
        cell = F.when(F.col("at") == k, F.expr(f"({b.part} - {b.low}L) div {b.step}L")).otherwise(cell)
    counted = (rows.withColumn("at", at).where("at is not null").select("at", cell.alias("cell"), part.alias("part"), "size")
               .groupBy("at", "cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high")))
    found = {b: [] for b in open_}
    for x in sorted(counted.collect(), key=lambda x: (x["at"], x["cell"])):
        found[open_[x["at"]]].append(x)
    return found


def splitters(rows: DataFrame, shards: int, tolerance: float, parts: int) -> tuple[list[Splitter], int] | None:
    """The splitters and the number of rows; None if they need more than the
    first ``parts`` parts of the key.

    The target of a splitter lies in one group of equal texts, which the rounds
    close in on; the nearer end of the group is taken if it misses the target by
    ``tolerance`` of a shard's mean bytes or less. Otherwise the search goes on
    inside the group, by id and (for equal rows beyond the tolerance) by row, and
    takes the nearer end."""
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    last = rows.agg(F.max("r")).first()[0] or 0
    if not n:
        return [], 0
    done: dict[int, Splitter] = {}
    todo = {j: Bracket((), 0, (1 << 60) - 1, 0, 0) for j in range(1, shards)}
    while todo:
        found = histogram(rows, list(dict.fromkeys(todo.values())))
        for j, b in list(todo.items()):
            below, before = b.below, b.rows
            for x in found[b]:
                if shards * (below + x["bytes"]) > j * total:
                    break
                below, before = below + x["bytes"], before + x["n"]
            inner = replace(b, low=x["low"], high=x["high"], below=below, rows=before)
            if x["low"] < x["high"]:
                todo[j] = inner
                continue
            under, over = j * total - shards * below, shards * (below + x["bytes"]) - j * total
            level = len(b.prefix)
            if x["n"] == 1 or min(under, over) <= tolerance * total or level == 2:
                key = (*b.prefix, x["low"])
                done[j] = (Splitter(key, below, before) if under <= over else
                           Splitter((*b.prefix, x["low"] + 1), below + x["bytes"], before + x["n"]))
                del todo[j]
            elif level + 1 < parts:
                todo[j] = Bracket((*b.prefix, x["low"]), 0, (1 << 60) - 1 if level == 0 else last, below, before)
            else:
                return None
    return [done[j] for j in range(1, shards)], n


def reached(s: Splitter) -> Column:
    """Whether a row's key is the splitter's or larger."""
    said = F.lit(True)
    for name, value in reversed(list(zip(PARTS, s.key))):
        c = F.col(name)
        said = (c > value) | ((c == value) & said)
    return said


def histogram_sort(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, text) for every row:
    shards of near equal bytes, each a range of the key order, with slot the row's
    gapless place in its shard's order.

    Size is the text's UTF-8 bytes plus 1; a null text counts as an empty one and
    stays null in ``text``. Equal texts stand together and share a shard, unless
    parting them is what keeps the shards within ``tolerance`` (or one row's
    bytes); a group larger than a shard is thus cut by id, and equal rows by their
    number. Null ids are ids like others; repeated rows each keep a place; other
    columns are ignored. Fewer rows than shards leave shards empty; an empty
    table gives no row. ``shards`` is a matter of some hundreds at most: each
    splitter is a comparison a row."""
    wide = keyed(docs, id_col, text_col)
    narrow = store(wide.select("size", *PARTS), "keys")
    found = splitters(narrow, shards, tolerance, 2)
    if found is None:  # equal rows beyond the tolerance: their numbers decide, so those are kept
        wide = store(wide, "numbered")
        found = splitters(wide.select("size", *PARTS), shards, tolerance, 3)
    cuts, _ = found
    shard = sum((reached(s).cast("int") for s in cuts), F.lit(0))
    # the one exchange; AQE sizes its ranges, and a group of equal texts spans as many as it needs
    moved = wide.withColumn("shard", shard).repartitionByRange("shard", *PARTS).sortWithinPartitions("shard", *PARTS)
    at = F.monotonically_increasing_id()
    moved = store(moved.withColumn("_at", at).select("doc_id", "size", "text_crc32", "shard", "text", F.shiftright("_at", 33).alias("_range"),
                                                     F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), "shards")
    many = sorted((x["_range"], x["n"]) for x in moved.groupBy("_range").agg(F.count("*").alias("n")).collect())  # a row for each range
    before, starts = 0, []
    for k, n in many:
        starts.append((k, before))
        before += n
    start = docs.sparkSession.createDataFrame(starts, "_range long, _start long")
    first = F.element_at(F.array(*(F.lit(r).cast("long") for r in (0, *(s.rows for s in cuts)))), F.col("shard") + 1)
    return moved.join(start, "_range").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_start") + F.col("_place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "text")


def write_shards(placed: DataFrame, path: str) -> None:
    """The shards as Parquet folders ``shard=k``; each file holds a run of slots."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
