"""Benchmark decontamination: a BM25 inverted index of the test items, with a
posting list for each word, cut into blocks at the same item numbers in all lists.
Every passage of every document queries it (block-max WAND): the lists' block
maxima bound the score of all items of a block; the next block whose bound reaches
the threshold is the pivot, postings of the blocks before it are skipped. All items
above the threshold are retrieved, and question and answer overlap is verified.

An item's threshold is the BM25 score that a passage with ``pct`` percent of the
item's five-word shingles must reach, i.e. the item's score for itself less the
heaviest words that so many missing shingles can take along. Impacts are divided by
it, so that the threshold is 1 for all. Retrieval thus loses no item that the
verification would accept.

The index belongs to the benchmark, not to the corpus: it is cut into shards of a
fixed size (``SHARD_ITEMS`` items and ``SHARD_WORDS`` words), of which one at a time
is built, sent to the tasks, queried by all documents and dropped. Document
frequencies and the passages' length are those of the whole benchmark, so results
don't depend on the shards."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, slices, store, tidy

SHARD_ITEMS, SHARD_WORDS = 2_000, 400_000
BLOCK_ITEMS = 4
#: Cells (stride, block) whose bounds are held at once.
CELLS = 400_000
K1, B = 1.2, 0.75
_TOKEN = re.compile(r"[^\W_]+")
_END = re.compile(r"[.!?](?=\s)")


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased: case, punctuation and white
    space don't hide a passage."""
    return _TOKEN.findall(text.lower()) if text else []


def parts(text: str | None) -> tuple[list[str], list[str]]:
    """Question and answer of an item: cut after the last sentence end that
    leaves both a word, else at half its words."""
    text = text or ""
    for m in reversed(list(_END.finditer(text))):
        q, a = tokens(text[:m.end()]), tokens(text[m.end():])
        if q and a:
            return q, a
    w = tokens(text)
    return w[:(len(w) + 1) // 2], w[(len(w) + 1) // 2:]


def grams(w: list[str], k: int) -> set:
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


class Index:
    """One shard. ``of[t]:of[t + 1]`` are the blocks of word t's posting list, in
    order: block number, maximum, and where its postings (item, impact) begin."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n: int, mean: float, stride: int, pct: int, k: int):
        self.k, self.pct, self.stride = k, pct, stride
        self.items = [(i, w, *parts(t)) for i, t in items if (w := tokens(t))]
        # items with much the same words share blocks, so that block maxima stay low
        self.items.sort(key=lambda x: (min(x[1], key=lambda t: (df.get(t, 1), t)), x[0]))
        self.blocks = max(1, -(-len(self.items) // BLOCK_ITEMS))
        self.grams: list[set] = []
        lists: dict[str, list[tuple[int, float]]] = {}
        for j, (_, w, _, _) in enumerate(self.items):
            tf: dict[str, int] = {}
            for t in w:
                tf[t] = tf.get(t, 0) + 1
            s = {t: math.log(1 + (n - df.get(t, 1) + 0.5) / (df.get(t, 1) + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) / mean)) for t, f in tf.items()}
            g = grams(w, k)
            self.grams.append(g)
            missing = len(g) - -(-pct * len(g) // 100)
            lost = sum(sorted(s.values(), reverse=True)[:missing])
            need = max(1e-3, (sum(s.values()) - lost) * 0.9999 - 1e-3)
            for t, v in s.items():
                lists.setdefault(t, []).append((j, v / need))
        self.vocab = {t: i for i, t in enumerate(lists)}
        self.item = np.array([j for x in lists.values() for j, _ in x], np.int64)
        self.impact = np.array([v for x in lists.values() for _, v in x], float)
        word = np.repeat(np.arange(len(lists)), [len(x) for x in lists.values()])
        name = word * self.blocks + self.item // BLOCK_ITEMS  # sorted: by word, then block
        self.begin = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, np.int64)
        self.name = name[self.begin]
        self.block = self.name % self.blocks
        self.top = np.maximum.reduceat(self.impact, self.begin) if len(name) else np.zeros(0)
        self.of = np.searchsorted(self.name, np.arange(len(lists) + 1) * self.blocks)
        self.begin = np.append(self.begin, len(name))

    def strides(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The documents' strides, numbered through: (stride, word) of each word of
        the index, once a stride, in order; and each document's first stride."""
        first = np.concatenate([[0], np.cumsum([-(-len(x) // self.stride) for x in ids])]).astype(np.int64)
        none, v = len(self.vocab), max(1, len(self.vocab))
        names = [first[d] * v + (at // self.stride) * v + x[at] for d, x in enumerate(ids) if len(at := np.flatnonzero(x < none))]
        once = np.concatenate(names) if names else np.zeros(0, np.int64)
        once.sort()
        once = once[np.append(True, once[1:] != once[:-1])] if len(once) else once
        return once // v, once % v, first

    def pivots(self, stride: np.ndarray, word: np.ndarray, first: np.ndarray):
        """(passage, block) whose bound reaches the threshold. A passage is two
        strides of a document, named by the first; a document of one stride has one
        passage. Bounds are sums of block maxima over the passage's words."""
        total, step = int(first[-1]), max(1, CELLS // self.blocks)
        ends = np.zeros(total + 1, bool)
        ends[first[1:]] = True
        for lo in range(0, total, step):
            hi = min(total, lo + step + 1)  # one more than is decided: the second half of the last passage
            sel = slice(*np.searchsorted(stride, [lo, hi]))
            many = self.of[word[sel] + 1] - self.of[word[sel]]
            at = np.repeat(self.of[word[sel]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            cell = np.repeat((stride[sel] - lo) * self.blocks, many) + self.block[at]
            bound = np.bincount(cell, self.top[at], minlength=(hi - lo) * self.blocks).reshape(-1, self.blocks)
            own = min(total, lo + step) - lo
            more = np.zeros((own, self.blocks))
            inside = np.flatnonzero(~ends[lo + 1:lo + own + 1])  # another stride of the document follows
            more[inside] = bound[inside + 1] if len(inside) else 0
            p, b = np.nonzero(bound[:own] + more >= 1)
            yield from zip((p + lo).tolist(), b.tolist())

    def scored(self, words: np.ndarray, block: int) -> np.ndarray:
        """Items of the block that reach the threshold: only its postings are read."""
        name = words * self.blocks + block
        at = np.searchsorted(self.name, name)
        at = at[self.name[np.minimum(at, len(self.name) - 1)] == name]
        picked = np.concatenate([np.arange(self.begin[i], self.begin[i + 1]) for i in at])
        score = np.bincount(self.item[picked] - block * BLOCK_ITEMS, self.impact[picked], minlength=BLOCK_ITEMS)
        return np.flatnonzero(score >= 1) + block * BLOCK_ITEMS

    def verified(self, j: int, here: dict[int, set], passage: list[str], words: set) -> float:
        """The item's share of shingles in the passage, 0 if it doesn't count. An
        item of fewer than k words must stand there as a whole."""
        _, w, q, a = self.items[j]
        k = min(self.k, len(w))
        if k not in here:
            here[k] = grams(passage, k)
        both = len(self.grams[j] & here[k])
        if 100 * both < self.pct * len(self.grams[j]) or any(2 * sum(t in words for t in side) < len(side) for side in (q, a)):
            return 0.0
        return both / len(self.grams[j])

    def matches(self, texts: list[list[str]]) -> list[dict[int, float]]:
        """For each document (its words): item -> largest share of its shingles in
        one passage, for the verified items."""
        found: list[dict[int, float]] = [{} for _ in texts]
        if not self.items:
            return found
        get, none = self.vocab.get, len(self.vocab)
        stride, word, first = self.strides([np.fromiter((get(x, none) for x in t), np.int64, len(t)) for t in texts])
        last = None
        for p, b in self.pivots(stride, word, first):
            if p != last:
                last, doc = p, int(np.searchsorted(first, p, side="right")) - 1
                lo = (p - int(first[doc])) * self.stride
                passage = texts[doc][lo:lo + 2 * self.stride]
                terms = np.unique(word[slice(*np.searchsorted(stride, [p, min(p + 2, int(first[doc + 1]))]))])
                here, words = {}, set(passage)
            for j in self.scored(terms, b).tolist():
                share = self.verified(j, here, passage, words)
                if share:
                    item = self.items[j][0]
                    found[doc][item] = max(found[doc].get(item, 0.0), share)
        return found


def _scan(shared, whole: bool):
    """(doc_id, h, n_passages, item_ids, share) of every row, or of those with a hit."""
    def run(batches):
        index: Index = shared.value
        for batch in slices(batches, 200):
            texts = [tokens(t) for t in batch.column("text").to_pylist()]
            found = index.matches(texts)
            at = [i for i, m in enumerate(found) if whole or m]
            cols = [batch.column("doc_id").take(pa.array(at, pa.int64())), batch.column("h").take(pa.array(at, pa.int64())),
                    pa.array([max(0, -(-len(texts[i]) // index.stride) - 1) or int(bool(texts[i])) for i in at], pa.int64()),
                    pa.array([sorted(found[i]) for i in at], pa.list_(pa.int64())), pa.array([max(found[i].values(), default=0.0) for i in at], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "h", "n_passages", "item_ids", "share"])
    return run


def indexes(benchmark: DataFrame, pct: int, k: int):
    """The shards of the index, one after the other."""
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    rows = store(rows, "items")
    words = rows.select("item_id", F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), 1).alias("w"))
    n, chars, mean, longest = words.join(rows.select("item_id", "text"), "item_id").agg(
        F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0)), F.avg(F.size("w")), F.max(F.size("w"))).first()
    shards = max(1, -(-n // SHARD_ITEMS), -(-chars // (6 * SHARD_WORDS)))
    df = words.select(F.explode(F.array_distinct("w")).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    for shard in range(shards):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        items = [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]  # a shard's worth
        own = words.join(part.select("item_id").distinct(), "item_id", "left_semi").select(F.explode("w").alias("t")).distinct()
        # a passage is two strides, so that it holds any item whole
        yield Index(items, {r["t"]: r["df"] for r in df.join(own, "t", "left_semi").collect()}, n, mean or 1.0, max(8, longest or 0), pct, k)


def _found(docs: DataFrame, benchmark: DataFrame, pct: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, n_passages, item_ids, share) of every row; h: the text's hash."""
    spark = docs.sparkSession
    ship_package(spark)
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"), F.col(f"`{text_col}`").alias("text"))
    fields = "doc_id long, h long, n_passages long, item_ids array<bigint>, share double"
    out = more = None
    for shard in indexes(benchmark, pct, k):
        shared = spark.sparkContext.broadcast(shard)
        found = store(base.mapInArrow(tidy(_scan(shared, out is None)), fields), "found")
        shared.unpersist()
        if out is None:
            out = found
        else:
            more = found if more is None else more.unionByName(found)
    if more is not None:  # rows with one id and one text are equal, and so are their items
        more = more.groupBy(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).agg(F.flatten(F.collect_set("item_ids")).alias("_items"), F.max("share").alias("_share"))
        out = (out.join(more, out["doc_id"].eqNullSafe(F.col("_d")) & (out["h"] == F.col("_h")), "left")
               .withColumn("item_ids", F.when(F.col("_items").isNull(), F.col("item_ids")).otherwise(F.array_sort(F.array_union("item_ids", "_items"))))
               .withColumn("share", F.greatest("share", F.coalesce("_share", F.lit(0.0)))))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, pct: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_passages, item_ids, share, contaminated) of every row.

    contaminated: one passage holds at least ``pct`` percent of the distinct
    k-word shingles of an item (an item of fewer words as a whole) and half of the
    words of both its question and its answer. item_ids are the items found, in
    order; share is the largest share of shingles. Null and empty texts have no
    passage and are clean; a null id stays null; equal rows each give a row. Items
    without a word or an id match nothing; an empty benchmark leaves every document
    clean."""
    out = _found(docs, benchmark, pct, k, id_col, text_col)
    return out.select("doc_id", "n_passages", "item_ids", "share", (F.size("item_ids") > 0).alias("contaminated"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, pct: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are clean, with all their columns: each row is judged
    by its own text, whatever other rows share its id."""
    bad = _found(docs, benchmark, pct, k, id_col, text_col).where(F.size("item_ids") > 0).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h")).distinct()
    bad = store(bad, "contaminated")
    same = docs[f"`{id_col}`"].cast("long").eqNullSafe(bad["_d"]) & (F.xxhash64(docs[f"`{text_col}`"]) == bad["_h"])
    return docs.join(bad, same, "left_anti")
