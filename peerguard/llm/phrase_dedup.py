"""Suffix dedup by prefix-free parsing: every byte covered by a 100-byte string
that also starts earlier in the corpus is removed.

* Triggers. A rolling hash over 32 bytes; the smallest (leftmost at a tie) of
  each 69 neighbouring hashes is a trigger, so each 100-byte string holds one,
  and equal strings hold the same one at the same place. The triggers cut the
  texts into phrases.
* Dictionary. The strings whose first trigger is the one that ends a phrase make
  one entry: the phrase with its parse context, as far as 100 bytes reach. Equal
  entries are equal phrases followed by equal parse; rows sorted by (trigger,
  entry, document, place) give the order of all suffixes to a depth of 100
  bytes, entry by entry instead of byte by byte: for every entry but the first
  place where it stands, all its strings have been there before.
* Suffixes of entries. Different entries with the same trigger may still share
  some strings. Only those bring their bytes along, and their suffixes are
  compared one by one, in corpus order.

A trigger that a third of all documents hold is thinned before the shuffle (one
row for each entry and Arrow batch), and its list is streamed, never gathered.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, key64, mix, ship_package, slices, store

SPAN, ENTRY = 0, 1
_LUT = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))
_B = 0xE7037ED1A0B428DB
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse modulo 2**64, n of each."""
    if len(_powers[0]) < n:
        size = max(1 << 19, 1 << (n - 1).bit_length())
        for k, base in enumerate((_B, pow(_B, -1, 1 << 64))):
            p = np.full(size, base, U64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    q = np.empty(len(buf) + 1, U64)
    q[0] = 0
    np.cumsum(_LUT[buf] * powers(len(buf))[0], out=q[1:])
    return q


def sliding_min(v: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while size * 2 <= n:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:len(v) - (n - size)], v[n - size:]) if size < n else v


def entries(buf: np.ndarray, ends: np.ndarray, width: int, w: int):
    """(key, entry, lo, hi, trigger) of each entry in a buffer of whole texts;
    ends: for each byte the end of its text. lo..hi: the starts of its strings."""
    none = np.zeros(0, U64)
    if len(buf) < width:
        return none, none, *(np.zeros(0, "int64"),) * 3
    q = prefix_sums(buf)
    _, inv = powers(len(buf))
    h = mix((q[w:] - q[:-w]) * inv[:len(buf) - w + 1])
    low = sliding_min((h & U64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U64), width - w + 1)
    s = np.flatnonzero(np.arange(width, len(buf) + 1) <= ends[:len(low)])
    if not len(s):
        return none, none, *(np.zeros(0, "int64"),) * 3
    t = (low[s] & U64(0xFFFFFFFF)).astype("int64")
    first = np.ones(len(s), bool)
    first[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1] + 1)
    a = np.flatnonzero(first)
    lo, hi, t = s[a], s[np.append(a[1:], len(s)) - 1], t[a]
    entry = mix(((q[hi + width] - q[lo]) * inv[lo]) ^ mix(((t - lo) << 32 | (hi - lo)).astype(U64)))
    return h[t], entry, lo, hi, t


def chunks(ids, texts, size: int = 1 << 19):
    """Whole texts in id order, joined to buffers of about ``size`` bytes."""
    order = sorted((i, k) for k, i in enumerate(ids) if i is not None)
    part, n = [], 0
    for i, k in order:
        b = (texts[k] or "").encode("utf-8", "surrogatepass")
        part.append((i, b))
        n += len(b)
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


def _parse(width: int, w: int):
    schema = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("entry", pa.int64()), ("doc", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("off", pa.int32())])

    def run(batches):
        for batch in slices(batches, 2000):
            out: list[list] = [[] for _ in range(6)]
            for part in chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lens = np.array([len(b) for _, b in part])
                starts = np.cumsum(lens) - lens
                buf = np.frombuffer(b"".join(b for _, b in part), np.uint8)
                key, entry, lo, hi, t = entries(buf, np.repeat(starts + lens, lens), width, w)
                k = np.searchsorted(starts + lens, lo, side="right")
                ids = np.array([i for i, _ in part], "int64")
                for x, y in zip(out, (key64(key), key64(entry), ids[k], lo - starts[k], hi - lo, t - lo)):
                    x.append(y)
            if not out[0]:
                continue
            key, entry, doc, lo, n, off = (np.concatenate(x) for x in out)
            again = np.zeros(len(key), bool)  # an earlier row of this batch has the same entry
            by = np.argsort(mix(key.view(U64)) ^ entry.view(U64), kind="stable")
            if len(by):
                same = (key[by][1:] == key[by][:-1]) & (entry[by][1:] == entry[by][:-1])
                at = np.arange(len(by))
                lead = by[np.maximum.accumulate(np.where(np.append(True, ~same), at, 0))]
                again[by] = np.append(False, same) & ((doc[lead] != doc[by]) | (lo[lead] != lo[by]))
                same_row = np.zeros(len(by), bool)  # an equal row of a document that is there twice
                same_row[by] = np.append(False, same) & (doc[lead] == doc[by]) & (lo[lead] == lo[by])
                keep = ~again & ~same_row
                spans = merged(doc[again], lo[again], lo[again] + n[again])
                m = len(spans[0])
                cols = [np.append(np.full(int(keep.sum()), ENTRY), np.full(m, SPAN)).astype("int8"), np.append(key[keep], key64(mix(spans[0].astype(U64)))),
                        np.append(entry[keep], np.zeros(m, "int64")), np.append(doc[keep], spans[0]), np.append(lo[keep], spans[1]).astype("int32"),
                        np.append(n[keep], spans[2] - spans[1]).astype("int32"), np.append(off[keep], np.zeros(m, "int64")).astype("int32")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=schema)
    return run


def merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Ranges of starts, in any order, joined where they touch."""
    if not len(doc):
        return doc, lo, hi
    by = np.lexsort((lo, doc))
    doc, lo, hi = doc[by], lo[by], hi[by]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] + 1)
    a = np.flatnonzero(first)
    return doc[a], lo[a], np.maximum.reduceat(hi, a)


def _order(batches):
    """Streams the rows sorted by (key, entry, doc, lo). An entry that has been
    there before gives a span; the first row of an entry goes on if its trigger
    has another entry too."""
    held = None  # the first row of the last trigger, while it is its only entry
    last = None
    fields = ["kind", "key", "entry", "doc", "lo", "n", "off"]
    for batch in batches:
        c = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
        span = c[0] == SPAN
        passed = [x[span] for x in c]
        c = [x[~span] for x in c]
        out = [passed]
        if len(c[0]):
            kind, key, entry, doc, lo, n, off = c
            new_key = np.ones(len(key), bool)
            new_key[1:] = key[1:] != key[:-1]
            new = new_key.copy()
            new[1:] |= entry[1:] != entry[:-1]
            if last is not None and last[0] == key[0]:
                new_key[0] = False
                new[0] = last[1] != entry[0]
            at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            ldoc, llo = np.where(at >= 0, doc[at], last[2] if last else 0), np.where(at >= 0, lo[at], last[3] if last else 0)
            again = ~new & ((doc != ldoc) | (lo != llo))
            spans = [x[again] for x in c]
            spans[0] = np.full(int(again.sum()), SPAN, "int8")
            out.append(spans)
            r = np.flatnonzero(new)  # the first rows of entries
            if held is not None and len(r) and not new_key[0] and key[r[0]] == held[1]:
                out.append([np.array([x]) for x in held])
            elif held is not None and not len(r):
                last = (key[-1], entry[-1], ldoc[-1], llo[-1])
                yield _batch(out, fields)
                continue
            more = np.zeros(len(r), bool)
            more[:-1] = key[r][1:] == key[r][:-1]
            more |= ~new_key[r]
            out.append([x[r][more] for x in c])
            held = tuple(x[r[-1]] for x in c) if len(r) and not more[-1] else None
            last = (key[-1], entry[-1], ldoc[-1], llo[-1])
        yield _batch(out, fields)


def _batch(parts, fields):
    types = (pa.int8(), *(pa.int64(),) * 3, *(pa.int32(),) * 3)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[i] for p in parts]), t) for i, t in enumerate(types)], names=fields)


def _bytes(width: int):
    """The bytes of the entries, from the document's packed text."""
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for batch in slices(batches, 250):
            out: list[list] = [[] for _ in range(5)]
            for doc, blob, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                b = z.decompress(blob)
                for r in rows:
                    for x, y in zip(out, (r["key"], doc, r["lo"], r["off"], b[r["lo"]:r["lo"] + r["n"] + width])):
                        x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                                             names=["key", "doc", "lo", "off", "b"])
    return run


def _suffixes(width: int):
    """Streams the entries by (key, doc, lo) and compares their strings."""
    def run(batches):
        seen, seen_key = np.zeros(0, U64), None  # strings of the trigger that the batch before ended in
        for batch in slices(batches, 4000):
            if not batch.num_rows:
                continue
            key, doc, lo, off = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            texts = batch.column(4).to_pylist()
            lens = np.array([len(b) for b in texts])
            buf = np.frombuffer(b"".join(texts), np.uint8)
            q, inv = prefix_sums(buf), powers(len(buf))[1]
            start, n = np.cumsum(lens) - lens, lens - width + 1
            row = np.repeat(np.arange(len(lens)), n)
            j = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            p = start[row] + j
            place = (off[row] - j).astype("int64").astype(U64)
            name = mix(((q[p + width] - q[p]) * inv[p]) ^ mix(key[row].view(U64) * U64(131) + place))
            by = np.argsort(name, kind="stable")
            rep = np.zeros(len(name), bool)
            rep[by[1:]] = name[by][1:] == name[by][:-1]
            if seen_key == key[0] and len(seen):
                own = key[row] == seen_key
                rep[own] |= np.isin(name[own], seen)
            last = name[key[row] == key[-1]]
            seen = np.union1d(seen, last) if seen_key == key[-1] else np.unique(last)
            seen_key = key[-1]
            r = np.flatnonzero(rep)
            d, s = doc[row[r]], lo[row[r]].astype("int64") + j[r]
            d, a, b = merged(d, s, s)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(a.astype("int32")), pa.array((b - a).astype("int32"))], names=["doc", "lo", "n"])
    return run


def cut(text: bytes, spans, width: int) -> tuple[bytes, int, int]:
    """What is left of a text, the removed bytes and runs; spans: (first start,
    number of further starts) of repeated strings."""
    kept, end, runs, removed = [], 0, 0, 0
    for lo, n in sorted(spans):
        hi = min(lo + n + width, len(text))
        if lo > end or not runs:
            kept.append(text[end:lo])
            removed += hi - lo
            runs += 1
            end = hi
        elif hi > end:
            removed += hi - end
            end = hi
    kept.append(text[end:])
    return b"".join(kept), removed, runs


def _cut(width: int, with_text: bool):
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for batch in slices(batches, 500):
            ids = batch.column(0).to_pylist()
            out: list[list] = [[] for _ in range(5)]
            for blob, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                b = z.decompress(blob)
                left, removed, runs = cut(b, [(x["lo"], x["n"]) for x in spans or ()], width)
                for x, y in zip(out, (len(b), removed, runs, hashlib.sha256(left).hexdigest(), left if with_text else None)):
                    x.append(y)
            cols = [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols.append(pa.array(out[4], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _pack(batches):
    z = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, 1000):
        rows = [(i, z.compress((t or "").encode("utf-8", "surrogatepass"))) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if i is not None]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["doc", "z"])


def repeated_spans(docs: DataFrame, width: int = 100, w: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, lo, n): all strings of ``width`` bytes that start at lo..lo+n of the
    document also start earlier (smaller id, or earlier in the document)."""
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    fields = "kind byte, key long, entry long, doc long, lo int, n int, off int"
    rows = (base.where(F.octet_length("text") >= width).mapInArrow(_parse(width, w), fields)
            .repartition("key").sortWithinPartitions("key", "entry", "doc", "lo"))
    found = store(rows.mapInArrow(_order, fields), "entries")
    spans = found.where(f"kind = {SPAN}").select("doc", "lo", "n")
    wanted = found.where(f"kind = {ENTRY}").groupBy("doc").agg(F.collect_list(F.struct("key", "lo", "n", "off")).alias("rows"))
    # a document that is there twice must not bring its entries twice
    texts = base.mapInArrow(_pack, "doc long, z binary").join(wanted, "doc")
    more = (texts.select("doc", "z", "rows").mapInArrow(_bytes(width), "key long, doc long, lo int, off int, b binary")
            .repartition("key").sortWithinPartitions("key", "doc", "lo").mapInArrow(_distinct_rows, "key long, doc long, lo int, off int, b binary")
            .mapInArrow(_suffixes(width), "doc long, lo int, n int"))
    return spans.unionByName(more)


def _distinct_rows(batches):
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc, lo = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        keep = np.ones(len(key), bool)
        keep[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (lo[1:] != lo[:-1])
        keep[0] = last != (key[0], doc[0], lo[0])
        last = (key[-1], doc[-1], lo[-1])
        yield batch.filter(pa.array(keep))


def phrase_dedup(docs: DataFrame, width: int = 100, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row
    with an id. Texts are taken as UTF-8 bytes, null as empty; a text shorter
    than ``width`` loses nothing. Matches never cross documents and are judged
    on the input. Rows with a null id are left out (they have no place in the
    corpus order); equal rows of one document count as one document and each
    gets its result. Other columns are ignored."""
    spans = repeated_spans(docs, width, id_col=id_col, text_col=text_col)
    lists = spans.groupBy("doc").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))  # no longer than the document
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInArrow(_pack, "doc long, z binary")
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return base.join(lists, "doc", "left").select("doc", "z", "spans").mapInArrow(_cut(width, with_text), fields)
