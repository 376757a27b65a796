"""N-gram Jaccard join: documents link when the sets of their distinct 4-word
shingles have a Jaccard similarity of at least 0.85. A size-aware heavy-light
join.

* Light (small sets): all subsets of each size an overlap can need are
  enumerated. Sets that share a subset of size c overlap in c shingles or more,
  so the pair is decided by the two sizes alone, and within a list the smallest
  set links to every set that any member links to: linear output.
* Heavy (large sets): inverted lists of single shingles are scanned. In any one
  order of all shingles, two sets that link share t of the first
  s - ceil(0.85 s) + t of each, so a set stands in the lists of these alone (t: a
  tenth of the smaller set). The order has the shingles that a sample finds in many
  documents last; it decides the work, not the result. In a short list all pairs
  are counted; a pair is compared if its count, and what it can share in long
  lists, comes to t.
* The boundary is the largest size whose subsets cost less than its lists: rows,
  and comparisons at the rate at which the sample's documents share shingles
  (``boundary``). A small set that can reach a large one goes to both.

Equal sets are joined by a digest first. In long lists each document is compared
with the first document of the lists that it meets most often, once by size and
once by a hash. Long lists whose documents are not in one component by then make
families; each family meets in one task (a large one is dealt out by its open lists) with each set
sent once, and all pairs of different components are compared that share one of the
family's rarest shingles. The Jaccard test runs on the whole shingle sets."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WordHash, key64, lower_words, mix, ship_package, shingles, slices, store, tidy
from .components import components, joined

DIGEST, SUBSET, LIST, PAIR = 0, 1, 2, 3
#: Members of a list up to which it is short.
SHORT = 16
#: Of so many documents one is in the sample that orders the shingles; the shingles
#: that the order tells apart (those in most documents), and their least number.
SAMPLE, FREQUENT, OFTEN = 8, 200_000, 2
#: Cost of a comparison, in rows.
COMPARE = 8
#: Documents and shingles that a task takes of a family.
FAMILY_DOCS, FAMILY_SHINGLES, SCANNED = 2_000, 1_500_000, 1_000_000


def needed(a: int, b: int, pct: int) -> int:
    """Smallest overlap that links sets of these sizes."""
    return -(-pct * (a + b) // (100 + pct))


def partner_sizes(s: int, pct: int) -> range:
    return range(-(-pct * s // 100), 100 * s // pct + 1)


@lru_cache(None)
def subset_sizes(s: int, pct: int) -> tuple[int, ...]:
    """Sizes of the subsets that a set of s must enumerate to meet any partner."""
    return tuple(sorted({c for p in partner_sizes(s, pct) if (c := needed(s, p, pct)) <= min(s, p)}))


def shared_least(s):
    """t: how many of their first shingles two sets must share, the smaller of s."""
    return 1 + s // 10


def front(s: int, pct: int) -> int:
    """How many of a set's first shingles stand in lists."""
    return min(s, s - -(-pct * s // 100) + shared_least(s))


def boundary(pct: int, shared: float) -> int:
    """Largest size at which the enumerated subsets cost less than the lists.
    ``shared``: other documents in the list of an average shingle."""
    x = 0
    for s in range(1, 400):
        if sum(comb(s, c) for c in subset_sizes(s, pct)) > front(s, pct) * (1 + COMPARE * shared):
            break
        x = s
    return x


class Order:
    """The shingles that many documents hold, by how many; all others come first,
    in the order of their hashes."""

    def __init__(self, keys: np.ndarray, many: np.ndarray):
        at = np.argsort(keys)
        self.keys, self.many = keys[at], many[at]

    def first(self, sh: np.ndarray, n: int) -> np.ndarray:
        """The first n of a set's sorted shingles."""
        if not len(self.keys):
            return sh[:n]
        at = np.minimum(np.searchsorted(self.keys, sh), len(self.keys) - 1)
        often = self.keys[at] == sh
        rare = sh[~often][:n]
        if len(rare) == n:
            return rare
        rest = sh[often]
        return np.concatenate([rare, rest[np.lexsort((rest, self.many[at[often]]))][:n - len(rare)]])


def keys_of(sh: np.ndarray, pct: int, x: int, order: Order):
    """(kind, subset size, keys) of a document's sorted distinct shingles: subsets of
    a small set, lists of a large one (and of a small one that can reach a large)."""
    s, out = len(sh), []
    if s <= x:
        w = mix(sh + U64(0x51ED270B))
        total = w.sum(dtype=U64)
        for c in subset_sizes(s, pct):
            ks = np.array([total - sum((w[i] for i in left), U64(0)) for left in combinations(range(s), s - c)], U64)
            out.append((SUBSET, c, mix(ks ^ U64(c * 0x9E3779B1))))
    if s > x or 100 * s >= pct * (x + 1):
        out.append((LIST, 0, order.first(sh, front(s, pct))))
    return out


def doc_shingles(text, hashes: WordHash, k: int) -> np.ndarray:
    return np.unique(shingles(hashes.of(lower_words(text)), k))


def _often(k: int):
    """(shingle, n) of the shingles that several documents of a task hold, and one
    row (null, ...) with all shingles of the task."""
    def run(batches):
        hashes = WordHash(100_000)

        def counted(sets):
            h, n = np.unique(np.concatenate(sets), return_counts=True)
            more = n > 1
            return pa.RecordBatch.from_arrays([pa.array([*key64(h[more]).tolist(), None], pa.int64()), pa.array([*n[more].tolist(), int(n.sum())], pa.int64())],
                                              names=["key", "n"])

        sets, size = [], 0
        for batch in slices(batches, 500):
            for text in batch.column(0).to_pylist():
                sets.append(doc_shingles(text, hashes, k))
                size += len(sets[-1])
                if size >= 2_000_000:
                    yield counted(sets)
                    sets, size = [], 0
        if sets:
            yield counted(sets)
    return run


def ordered(base: DataFrame, k: int) -> tuple[Order, float]:
    """The order of the shingles, and how many other documents hold an average one,
    from every SAMPLE-th document (by a hash of its id)."""
    part = base.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0).select("text")
    n = store(part.mapInArrow(tidy(_often(k)), "key long, n long"), "shingles").groupBy("key").agg(F.sum("n").alias("n"))
    n = store(n, "shingles")
    total, = n.where("key is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()
    twice, = n.where("key is not null").agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1)), F.lit(0))).first()
    top = n.where(f"key is not null and n >= {OFTEN}").orderBy(F.desc("n"), "key").limit(FREQUENT).collect()
    keys = np.array([r["key"] for r in top], np.int64).view(U64)
    # heads of lists make pairs, not lists squared: what an average shingle shares counts up to one
    return Order(keys, np.array([r["n"] for r in top], np.int64)), min(1.0, SAMPLE * float(twice) / max(1, total))


def _rows(k: int, pct: int, x: int, shared):
    schema = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("c", pa.int32()), ("doc", pa.int64()), ("s", pa.int32())])

    def run(batches):
        hashes, order = WordHash(200_000), shared.value
        leaders: set[bytes] = set()  # equal sets in this partition: only one goes into the lists
        for batch in slices(batches, 500):
            cols: list[list] = [[] for _ in range(5)]

            def add(kind, keys, c, doc, s):
                n = len(keys)
                for col, y in zip(cols, (np.full(n, kind, "int8"), key64(keys), np.full(n, c, "int32"), np.full(n, doc, "int64"), np.full(n, s, "int32"))):
                    col.append(y)

            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sh = doc_shingles(text, hashes, k)
                d = xxhash.xxh3_128_digest(sh.tobytes())
                add(DIGEST, np.frombuffer(d[:8], U64), int.from_bytes(d[8:12], "little", signed=True), doc, len(sh))
                if not len(sh) or d in leaders:
                    continue
                if len(leaders) >= 50_000:
                    leaders.clear()
                leaders.add(d)
                for kind, c, ks in keys_of(sh, pct, x, order):
                    add(kind, ks, c, doc, len(sh))
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in cols], schema=schema)
    return run


def _lists(pct: int):
    """Streams the lists (rows sorted by kind, key, c, size, document) and puts
    out: each document with its digest; links that subsets decide; of short lists
    of shingles the pairs whose sizes may link, of long ones the members with the
    list's first."""
    names = ("kind", "key", "c", "doc", "s")

    def put(kind, key, c, a, doc, s):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((np.full(len(doc), kind), pa.int8()), (key, pa.int64()), (c, pa.int32()), (a, pa.int64()),
                                                                       (doc, pa.int64()), (s, pa.int32()))], names=["kind", "key", "c", "a", "doc", "s"])

    def run(batches):
        held = [np.zeros(0, np.int64)] * 5  # the last list, while it may go on
        long_ = None  # (kind, key, c, first, its size) of a list known to be long that may go on
        for batch in _and_end(batches):
            own = [np.zeros(0, np.int64)] * 5 if batch is None else [batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in names]
            kind, key, c, doc, s = (np.concatenate(x) for x in zip(held, own))
            n = len(kind)
            if not n:
                continue
            new = np.ones(n, bool)
            new[1:] = (kind[1:] != kind[:-1]) | (key[1:] != key[:-1]) | (c[1:] != c[:-1])
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, n))
            of = np.cumsum(new) - 1
            lead, ls = doc[begin][of], s[begin][of]
            many = size[of] > SHORT
            if long_ is not None and long_[:3] == (kind[0], key[0], c[0]):
                lead[of == 0], ls[of == 0], many[of == 0] = long_[3], long_[4], True
            done = np.ones(n, bool)
            if batch is not None:  # the last list may go on: wait, unless it is long
                last = of == of[-1]
                if many[-1]:
                    long_ = (kind[-1], key[-1], c[-1], lead[-1], ls[-1])
                    held = [np.zeros(0, np.int64)] * 5
                else:
                    done, held = ~last, [x[last] for x in (kind, key, c, doc, s)]
            one = done & (kind == DIGEST)
            yield put(DIGEST, key[one], c[one], lead[one], doc[one], s[one])
            one = done & (kind == SUBSET) & (lead != doc) & (c * (100 + pct) >= pct * (ls + s))
            yield put(SUBSET, key[one], c[one], lead[one], doc[one], s[one])
            one = done & (kind == LIST) & many
            yield put(LIST, key[one], c[one], lead[one], doc[one], s[one])
            short = np.flatnonzero(done & (kind == LIST) & ~many)
            for d in range(1, SHORT):
                x, y = short[:-d], short[d:]
                x, y = (z[(of[x] == of[y]) & (doc[x] != doc[y]) & (100 * s[x] >= pct * s[y])] for z in (x, y))  # sizes ascend in a list
                if not len(x):
                    continue
                yield put(PAIR, key[x], c[x], np.minimum(doc[x], doc[y]), np.maximum(doc[x], doc[y]), s[x])
    return run


def _and_end(batches):
    yield from batches
    yield None


def _packed(batches):
    z = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, 1000):
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([ids, pa.array([None if t is None else z.compress(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary())],
                                         names=["doc", "z"])


def _verify(k: int, pct: int):
    """Streams (a, salt, doc, z) with the list's own document first."""
    def run(batches):
        hashes, z = WordHash(200_000), zstandard.ZstdDecompressor()
        lead, own, last = None, [], None
        for batch in slices(batches, 1000):
            us, vs = [], []
            for a, salt, doc, blob in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "doc", "z"))):
                if (a, salt, doc, blob) == last:
                    continue
                last = (a, salt, doc, blob)
                x = unpacked(z, blob, hashes, k)
                if doc == a:  # a repeated id may have several texts
                    own = [*own, x] if lead == (a, salt) else [x]
                    lead = (a, salt)
                elif lead == (a, salt) and any(linked(x, y, pct) for y in own):
                    us.append(a)
                    vs.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
    return run


def unpacked(z, blob, hashes: WordHash, k: int) -> np.ndarray:
    return doc_shingles(None if blob is None else z.decompress(blob).decode("utf-8", "surrogatepass"), hashes, k)


def linked(x: np.ndarray, y: np.ndarray, pct: int) -> bool:
    if 100 * min(len(x), len(y)) < pct * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= pct * (len(x) + len(y) - both)


class Forest(dict):
    """Union-find over the members of one task."""

    def find(self, x):
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)
        return a != b


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers first[i], first[i] + 1, ... (many[i] of them) of all i, in a row."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))


def scan_family(docs: list[int], comps: list[int], sets: list[np.ndarray], pct: int):
    """Links between documents of different components, a spanning forest of them.

    In any order of the shingles, sets that link share t of their first s - ceil(pct s)
    + t shingles each. In the order that has the family's rare ones first, these have
    inverted lists; shared ones are counted, and pairs with t of them (a tenth of the
    smaller set) are compared, SCANNED shingles at once."""
    by = np.argsort([len(x) for x in sets], kind="stable")
    lens = np.array([len(sets[i]) for i in by])
    _, inv, df = np.unique(np.concatenate([sets[i] for i in by]), return_inverse=True, return_counts=True)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    rows = (np.repeat(np.arange(len(by)) << 32, lens) | rank[inv])
    rows.sort()
    owner, rows = (rows >> 32).astype(np.int32), (rows & 0xFFFFFFFF).astype(np.int32)
    del inv, rank
    begin = np.cumsum(lens) - lens
    t = np.maximum(1, lens // 10)
    front = np.arange(len(rows)) - begin[owner] < (lens + (-pct * lens) // 100 + t)[owner]
    front &= rows >= np.count_nonzero(df == 1)  # the rarest are in one set alone
    lists, listed = rows[front], owner[front]
    of = np.searchsorted(listed, np.arange(len(by) + 1))  # where a set's own entries begin
    order = np.argsort(lists, kind="stable")
    at = np.empty(len(order), np.int64)  # where an entry stands: each list has its sets in order
    at[order] = np.arange(len(order))
    start = np.searchsorted(lists[order], lists)
    listed = listed[order]
    least = np.searchsorted(lens, -((-pct * lens) // 100))  # the first set that is large enough
    cid = np.unique(np.asarray(comps, np.int64)[by], return_inverse=True)[1]
    own, out = np.zeros(len(df), bool), []
    for y in range(len(by)):
        e = slice(of[y], of[y + 1])
        before = listed[_ranges(start[e], at[e] - start[e])]
        shared = np.bincount(before, minlength=y)
        near = least[y] + np.flatnonzero((shared[least[y]:] >= t[least[y]:y]) & (cid[least[y]:y] != cid[y]))
        if not len(near):
            continue
        mine = rows[begin[y]:begin[y] + lens[y]]
        own[mine] = True
        for part in np.split(near, np.flatnonzero(np.diff(np.cumsum(lens[near]) // SCANNED)) + 1):
            part = part[cid[part] != cid[y]]
            if not len(part):
                continue
            both = np.add.reduceat(own[rows[_ranges(begin[part], lens[part])]], np.cumsum(lens[part]) - lens[part], dtype=np.int64)
            for x in part[100 * both >= pct * (lens[part] + lens[y] - both)].tolist():
                if cid[x] != cid[y]:
                    cid[cid == cid[x]] = cid[y]
                    out.append((docs[by[x]], docs[by[y]]))
        own[mine] = False
    return out


def _families(k: int, pct: int):
    """Links between the components of the documents of one (family, part)."""
    def run(batches):
        hashes, z = WordHash(200_000), zstandard.ZstdDecompressor()
        at, rows, last = None, ([], [], []), None

        def links(out):
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["u", "v"])

        for batch in slices(batches, 1000):
            out = []
            for key, part, doc, comp, blob in zip(*(batch.column(c).to_pylist() for c in ("family", "part", "doc", "comp", "z"))):
                if at != (key, part):
                    if len(rows[0]) > 1:
                        out += scan_family(rows[1], *rows[1:], pct)
                    at, rows = (key, part), ([], [], [])
                if last != (key, part, doc, blob):  # equal rows
                    for x, y in zip(rows, (doc, comp, unpacked(z, blob, hashes, k))):
                        x.append(y)
                last = (key, part, doc, blob)
            yield links(out)
        if len(rows[0]) > 1:
            yield links(scan_family(rows[1], *rows[1:], pct))
    return run


def verified(pairs: DataFrame, packed: DataFrame, k: int, pct: int) -> DataFrame:
    """The (a, doc) pairs that link. The pairs of one document ``a`` are split
    over several tasks where it has many; each task holds one set at a time."""
    salts = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / 2000).cast("int").alias("n"))
    members = pairs.join(salts, "a").select("a", "doc", F.pmod(F.xxhash64("doc"), F.col("n")).cast("int").alias("salt"))
    heads = salts.select("a", F.col("a").alias("doc"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"))
    rows = packed.join(members.unionByName(heads), "doc").select("a", "salt", "doc", "z")
    return (rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("doc") != F.col("a"), "doc")
            .mapInArrow(tidy(_verify(k, pct)), "u long, v long"))


def counted_pairs(lists: DataFrame, long_: DataFrame) -> DataFrame:
    """(a, doc): the pairs that share enough lists. Those that a pair may share in
    long lists (``long_``: doc, m) are no more than either has."""
    pairs = lists.where(f"kind = {PAIR}").groupBy("a", "doc").agg(F.count("*").alias("n"), F.min("s").alias("s"))  # s: the smaller size
    sides = (pairs.join(long_.select(F.col("doc").alias("a"), F.col("m").alias("_a")), "a", "left")
             .join(long_.select("doc", F.col("m").alias("_d")), "doc", "left"))
    least = F.least(F.coalesce("_a", F.lit(0)), F.coalesce("_d", F.lit(0)))
    return sides.where(F.col("n") + least >= 1 + F.floor(F.col("s") / 10)).select("a", "doc")


def long_members(lists: DataFrame, long_: DataFrame, pct: int) -> DataFrame:
    """(key, doc, s, a, b) of the long lists' documents that could link over long
    lists alone: those that stand in at least t of them (t for the smallest partner).
    A pair that also shares a short list is counted. a, b: the list's heads, its
    smallest set and the document with the least hash."""
    least = 1 + F.floor(F.ceil(F.col("s") * pct / 100) / 10)
    member = lists.where(f"kind = {LIST}").select("key", "doc", "s").join(long_.where(F.col("m") >= least).select("doc"), "doc", "left_semi")
    member = store(member, "members")
    heads = member.groupBy("key").agg(F.min(F.struct("s", "doc")).alias("a"), F.min(F.struct(F.xxhash64("doc").alias("h"), "doc")).alias("b"), F.count("*").alias("n"))
    return member.join(heads.where("n > 1").select("key", F.col("a.doc").alias("a"), F.col("b.doc").alias("b")), "key")


def best_heads(member: DataFrame) -> DataFrame:
    """(a, doc): of each document the head that it meets in most lists, one of
    either kind."""
    met = member.select("doc", F.explode(F.array(F.struct(F.lit(0).alias("kind"), "a"), F.struct(F.lit(1).alias("kind"), F.col("b").alias("a")))).alias("x"))
    met = met.select("doc", "x.kind", "x.a").where("a <> doc").groupBy("doc", "kind", "a").agg(F.count("*").alias("n"))
    best = met.groupBy("doc", "kind").agg(F.max(F.struct("n", (-F.col("a")).alias("na"))).alias("m")).select((-F.col("m.na")).alias("x"), "doc")
    return best.select(F.least("x", "doc").alias("a"), F.greatest("x", "doc").alias("doc")).distinct()


def open_links(member: DataFrame, comp: DataFrame, packed: DataFrame, k: int, pct: int) -> DataFrame | None:
    """Links between components, within lists that still hold several of them; None
    if none does."""
    named = member.join(comp.withColumnRenamed("node", "doc"), "doc", "left").select("key", "a", "doc", "s", F.coalesce("component", "doc").alias("comp"))
    several = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    rows = store(named.join(several, "key"), "open")
    if rows.isEmpty():
        return None
    family = components(rows.select("a", "doc").distinct())
    rows = rows.join(family.select(F.col("node").alias("doc"), F.col("component").alias("family")), "doc", "left").withColumn("family", F.coalesce("family", "doc"))
    sizes = rows.select("family", "doc", "s").distinct().groupBy("family").agg(F.count("*").alias("n"), F.sum("s").alias("s"))
    sizes = sizes.select("family", F.greatest(F.ceil(F.col("n") / FAMILY_DOCS), F.ceil(F.col("s") / FAMILY_SHINGLES)).cast("int").alias("parts"))
    rows = rows.drop("s").join(sizes, "family").select("family", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "doc", "comp").distinct()
    rows = packed.join(rows, "doc").select("family", "part", "doc", "comp", "z")
    return (rows.repartition("family", "part").sortWithinPartitions("family", "part", "doc").mapInArrow(tidy(_families(k, pct)), "u long, v long"))


def _count(k: int):
    def run(batches):
        hashes = WordHash(100_000)
        for batch in slices(batches, 500):
            n = [len(doc_shingles(t, hashes, k)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n_shingles"])
    return run


def ngram_jaccard_join(docs: DataFrame, k: int = 4, pct: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; documents link when
    100 * intersection >= pct * union of their distinct k-word shingles. A null
    or empty text has no shingle and links with nothing (component: itself). A row
    with a null id links with nothing and has no component (null). Repeated ids are
    one document: equal rows give one row, different texts a row each, and links of
    any of them count. Other columns are ignored; an empty table gives no row."""
    spark = docs.sparkSession
    ship_package(spark)
    every = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    base = every.where("doc is not null")
    order, rate = ordered(base, k)
    shared = spark.sparkContext.broadcast(order)  # FREQUENT shingles at most
    rows = base.mapInArrow(tidy(_rows(k, pct, boundary(pct, rate), shared)), "kind byte, key long, c int, doc long, s int")
    lists = store(rows.repartition("kind", "key").sortWithinPartitions("kind", "key", "c", "s", "doc")
                  .mapInArrow(tidy(_lists(pct)), "kind byte, key long, c int, a long, doc long, s int"), "lists")
    digests = lists.where(f"kind = {DIGEST}").select("doc", F.col("s").alias("n_shingles"), "key", "c").distinct()
    equal = digests.where("n_shingles > 0").groupBy("key", "c", "n_shingles").agg(F.min("doc").alias("a"))
    same = digests.where("n_shingles > 0").join(equal, ["key", "c", "n_shingles"]).where("a <> doc").select("a", "doc")
    sure = same.unionByName(lists.where(f"kind = {SUBSET}").select("a", "doc"))

    long_ = store(lists.where(f"kind = {LIST}").groupBy("doc", "s").agg(F.count("*").alias("m")), "long")
    member = store(long_members(lists, long_, pct), "long-members")
    packed = base.mapInArrow(tidy(_packed), "doc long, z binary")
    pairs = store(counted_pairs(lists, long_).unionByName(best_heads(member)).distinct(), "pairs")
    comp = components(sure.unionByName(verified(pairs, packed, k, pct).toDF("a", "doc")))
    links = open_links(member, comp, packed, k, pct)
    if links is not None:
        comp = joined(comp, links)
    out = (digests.select("doc", "n_shingles").join(comp, digests["doc"] == comp["node"], "left")
           .select(F.col("doc").alias("doc_id"), F.col("n_shingles").cast("long").alias("n_shingles"),
                   F.coalesce("component", "doc").alias("component_id")))
    none = every.where("doc is null").select("text").mapInArrow(tidy(_count(k)), "n_shingles long")
    return out.unionByName(none.select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id")))


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents whose id is the component id (the smallest of its group), and
    those without an id."""
    drop = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti")
