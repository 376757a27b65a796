"""Packing by cutting-stock column generation.

Documents are tokenized once; a document longer than a sequence is cut into
whole sequences and a rest. The lengths of all pieces make a histogram of
``capacity / GRAIN`` bins, which is all that the driver gets. A linear program
over patterns (how many pieces of each bin fill one sequence) is solved by the
revised simplex method; a knapsack dynamic program prices new patterns with the
duals until none improves. Whole multiples of the patterns are kept; what the
rounding leaves (fewer pieces than bins times pieces a sequence) is filled
largest first. Then each piece gets a rank in its bin, and the rank says which
pattern, and which copy of it, it goes to."""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, store

CAPACITY, GRAIN, END_ID = 2048, 8, 1
_TAIL = ".,!?:;%&$*#|"
#: Words of ASCII and Western European letters, each one code point in any normal form of composed text.
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿŒœ]+")
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: byte -> the character that stands for it in a byte-level vocabulary.
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}


class Ids(dict):
    """chunk of a text (between blanks) -> its ids as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins over it, so a text's ids are
    those of its chunks one after the other. A lower-cased word (``_WORD``) is one
    unit of the tokenizer's model, given as the characters of its UTF-8 bytes, as is
    a run of punctuation after it; all else goes through the whole tokenizer. The
    memo is emptied when full."""

    def __init__(self, path: str, limit: int = 400_000):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer, self.limit, self.units = Tokenizer.from_file(path), limit, {}

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def unit(self, s: str, word: bool) -> bytes:
        v = self.units.get(s)
        if v is None:
            if len(self.units) >= self.limit:
                self.units.clear()
            if word:
                shown = s if s.isascii() else s.encode().decode("latin-1").translate(_BYTES)
                v = self.packed([x.id for x in self.tokenizer.model.tokenize(shown)])
            else:
                v = self.whole(s)
            self.units[s] = v
        return v

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        core = chunk.rstrip(_TAIL)
        if _WORD.fullmatch(core):
            v = self.unit(core.lower(), True) + (self.unit(chunk[len(core):], False) if len(core) < len(chunk) else b"")
        else:
            v = self.whole(chunk) if chunk else b""
        self[chunk] = v
        return v

    def of(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) if text else b""


@lru_cache(2)
def ids_of(path: str) -> Ids:
    return Ids(path)


def _pieces(path: str, capacity: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches):
        memo, end = ids_of(path), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = memo.of(text) + end
                n = len(b) // 4
                for s in range(0, n, capacity):
                    piece = b[4 * s:4 * (s + capacity)]
                    for x, y in zip(out, (doc, s, len(piece) // 4, zlib.crc32(piece), n)):
                        x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=names)
    return run


def best_pattern(sizes: np.ndarray, value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the counts of each size that fit into ``room`` and are
    worth most."""
    worth = np.zeros(room + 1)
    took = np.full(room + 1, -1)
    upto = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        worth[c] = worth[c - 1]
        if k := upto[c]:
            w = worth[c - sizes[:k]] + value[:k]
            j = int(w.argmax())
            if w[j] > worth[c] + 1e-12:
                worth[c], took[c] = w[j], j
    a, c = np.zeros(len(sizes), "int64"), room
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            a[took[c]] += 1
            c -= int(sizes[took[c]])
    return float(worth[room]), a


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = 5e-4) -> tuple[list[np.ndarray], np.ndarray]:
    """Patterns of a basis within one sequence or ``gap`` of the optimum, and
    how often (a fraction) each is used."""
    m = len(sizes)
    basis = [np.eye(m, dtype="int64")[i] * (room // int(sizes[i])) for i in range(m)]
    inverse = np.diag([1.0 / basis[i][i] for i in range(m)])
    x = (inverse * demand).sum(axis=1)  # plain sums: small matrices aren't worth BLAS threads
    # patterns are priced near the duals of the best lower bound so far (smoothing), which the volumes give at first
    centre = sizes / room
    bound = float((centre * demand).sum())
    for _ in range(40 * m + 100):
        total, duals = float(x.sum()), inverse.sum(axis=0)
        if total - bound <= max(1.0, gap * total):
            break
        for weight in (0.85, 0.0):
            prices = np.maximum(weight * centre + (1 - weight) * duals, 0)
            worth, a = best_pattern(sizes, prices, room)
            if (low := float((prices * demand).sum()) / max(worth, 1e-9)) > bound:
                bound, centre = low, prices / worth
            if (duals * a).sum() > 1 + 1e-7:
                break
        else:
            break
        d = (inverse * a).sum(axis=1)
        up = np.flatnonzero(d > 1e-9)
        if not len(up):
            break
        r = up[int(np.argmin(x[up] / d[up]))]
        step = x[r] / d[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
        basis[r] = a
    return basis, x


def plan(demand: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(pieces by bin, number of sequences) that take up the whole demand."""
    sizes = np.array(sorted(demand), "int64")
    left = np.array([demand[int(s)] for s in sizes], "int64")
    out = []
    if len(sizes):
        basis, x = column_generation(sizes, left.astype(float), room)
        for a, n in zip(basis, np.floor(x + 1e-6).astype("int64")):
            used = a > 0
            n = min(int(n), int((left[used] // a[used]).min()))
            if n:
                left = left - n * a
                out.append(({int(s): int(k) for s, k in zip(sizes, a) if k}, n))
    while left.any():
        a, free = np.zeros(len(sizes), "int64"), room
        for i in range(len(sizes) - 1, -1, -1):
            a[i] = min(left[i], free // sizes[i])
            free -= a[i] * sizes[i]
        n = int((left[a > 0] // a[a > 0]).min())
        left = left - n * a
        out.append(({int(s): int(k) for s, k in zip(sizes, a) if k}, n))
    return out


def _places(patterns):
    """rank in a bin -> sequence, from the bins' segments (a bounded table)."""
    starts: dict[int, list] = {}
    done: dict[int, int] = {}
    base = 0
    for pattern, n in patterns:
        for b, copies in pattern.items():
            starts.setdefault(b, []).append((done.get(b, 0), copies, base))
            done[b] = done.get(b, 0) + copies * n
        base += n
    table = {b: np.array(v, "int64").T for b, v in starts.items()}

    def run(batches):
        for batch in batches:
            bins, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("bin", "rank"))
            seq = np.zeros(len(bins), "int64")
            for b in np.unique(bins):
                at = np.flatnonzero(bins == b)
                first, copies, base = table[int(b)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                seq[at] = base[k] + (rank[at] - first[k]) // copies[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id"])
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each
    piece. A null or empty text is the end id alone. A null id stays null, equal
    rows are packed each; other columns are ignored; an empty table gives no
    row. ``tokenizer``: path of the vocabulary file, the public one by default."""
    spark = docs.sparkSession
    ship_package(spark)
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = store(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_pieces(tokenizer, capacity), fields)
                   .withColumn("bin", F.ceil(F.col("length") / GRAIN).cast("int")), "pieces")
    demand = {r["bin"]: r["n"] for r in pieces.groupBy("bin").agg(F.count("*").alias("n")).collect()}  # capacity / GRAIN bins
    patterns = plan(demand, capacity // GRAIN)
    # a bin that holds a third of all pieces is ranked in parts of about 1,000
    salts = max(1, -(-max(demand.values(), default=1) // 1000))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    before = (salted.groupBy("bin", "salt").agg(F.count("*").alias("n"))
              .select("bin", "salt", (F.sum("n").over(Window.partitionBy("bin").orderBy("salt")) - F.col("n")).alias("before")))
    own = F.row_number().over(Window.partitionBy("bin", "salt").orderBy("doc_id", "start", "ids_crc32"))
    ranked = (salted.withColumn("own", own).join(before, ["bin", "salt"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin", (F.col("own") - 1 + F.col("before")).alias("rank")))
    placed = ranked.mapInArrow(_places(patterns), fields + ", sequence_id long")
    at = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(at), F.lit(0)))
