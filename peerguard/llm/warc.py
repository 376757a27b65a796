"""WARC: a deterministic sharded writer and its reader.

Records are sorted by (page_id, payload digest, url) and cut into shards at
fixed ids: quantiles of a sample that a hash of the id chooses, so that the
files depend on the rows alone and not on how Spark has dealt them. A shard is
written as files that roll over at ``roll_bytes`` of compressed size; each record
is a gzip member of its own with headers and digests made anew. Files are
written under temporary names; when the job has ended, those of the attempts
that Spark accepted are renamed by a second job, and the manifest (a Parquet
table of the files) is written last. Readers start from the manifest: a file
that isn't in it doesn't exist.

Of records with equal payloads the one with the largest page id is a response,
the others revisit it. Only the digests are grouped to find it, with partial
maxima; payloads move once, to their shard."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import default_parallelism, scratch_path, ship_package, store

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STAMP = "2000-01-01T00:00:00Z"  # no clock: equal rows give equal files


def _headers(pairs) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in pairs)


def clean(value: str | None) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def record(page_id, url, digest: str, payload: bytes | None, length: int, refers_to) -> bytes:
    """One record; payload None: a revisit, whose block is the HTTP head alone."""
    http = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", length)]) + b"\r\n"
    block = http + (payload or b"")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest}")
    head = [("WARC-Type", "revisit" if payload is None else "response"), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", STAMP)]
    if clean(url):
        head.append(("WARC-Target-URI", clean(url)))
    if page_id is not None:
        head.append(("X-Page-ID", page_id))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if payload is None:
        head.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            head.append(("X-Refers-To-Page-ID", refers_to))
    head += [("WARC-Block-Digest", "sha1:" + base32(hashlib.sha1(block).digest())), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + _headers(head) + b"\r\n" + block + b"\r\n\r\n"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without name or time."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def parse(data: bytes):
    """(headers, block) of each record in a file of gzip members; checks the
    block digest."""
    while data:
        d = zlib.decompressobj(31)
        rec = d.decompress(data) + d.flush()
        if not d.eof:
            raise ValueError("a record is cut off")
        data = d.unused_data
        head, _, rest = rec.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        h = dict(x.split(": ", 1) for x in lines[1:])
        block = rest[:int(h["Content-Length"])]
        if h["WARC-Block-Digest"] != "sha1:" + base32(hashlib.sha1(block).digest()):
            raise ValueError("a block doesn't match its digest")
        yield h, block


def _write(root: str, roll_bytes: int):
    names = ["shard", "part", "temp", "path", "records", "bytes", "sha256"]
    types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        from pyarrow import fs
        files, base = fs.FileSystem.from_uri(root)
        attempt = uuid.uuid4().hex
        files.create_dir(f"{base}/_temporary", recursive=True)
        shard = part = None
        out = None

        def close():
            out["stream"].close()
            row = [out["shard"], out["part"], out["temp"], f"{root}/shard-{out['shard']:06d}-{out['part']:05d}.warc.gz", out["records"], out["size"], out["sha"].hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

        for batch in batches:
            for s in range(0, batch.num_rows, 200):
                for s_, page, url, html, digest, length, refers, response in zip(*(c.to_pylist() for c in batch.slice(s, 200).columns)):
                    data = member(record(page, url, base32(bytes(digest)), (html or "").encode("utf-8", "surrogatepass") if response else None, length, refers))
                    if out is not None and (s_ != shard or out["size"] >= roll_bytes):
                        yield close()
                        part = part + 1 if s_ == shard else 0
                        out = None
                    if out is None:
                        part = 0 if s_ != shard else part
                        shard = s_
                        temp = f"_temporary/{attempt}-{shard:06d}-{part:05d}"
                        out = {"shard": shard, "part": part, "temp": f"{root}/{temp}", "stream": files.open_output_stream(f"{base}/{temp}"), "size": 0, "records": 0, "sha": hashlib.sha256()}
                    out["stream"].write(data)
                    out["sha"].update(data)
                    out["size"] += len(data)
                    out["records"] += 1
        if out is not None:
            yield close()
    return run


def _rename(batches):
    """Gives the accepted files their names; done again, it changes nothing."""
    from pyarrow import fs
    for batch in batches:
        for temp, path in zip(batch.column("temp").to_pylist(), batch.column("path").to_pylist()):
            files, a = fs.FileSystem.from_uri(temp)
            b = fs.FileSystem.from_uri(path)[1]
            if files.get_file_info(a).type != fs.FileType.NotFound:
                files.move(a, b)
            elif files.get_file_info(b).type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
        yield batch


def boundaries(pages: DataFrame, shards: int, sample: int = 20_000) -> list[int]:
    """First ids of all shards but the first: quantiles of the ids that have the
    smallest hashes (at most ``sample`` of them, the same for any layout)."""
    ids = [r[0] for r in pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample).collect()]
    ids.sort()
    return sorted({ids[len(ids) * k // shards] for k in range(1, shards)}) if ids else []


def write_warc(pages: DataFrame, root: str | None = None, shard_bytes: int = 256 << 20, roll_bytes: int = 8 << 20, shards: int | None = None) -> tuple[str, DataFrame]:
    """Writes the pages (page_id, url, html) as archives under ``root`` (a fresh
    folder in the shared checkpoint folder by default) and returns (root,
    manifest). ``shards``: by payload bytes, but two for each shuffle partition
    at least, unless given. Null html is an empty payload, a null url gives no
    target, a null page id sorts first and has no id header. Equal rows are
    written each. Other columns are ignored; no row gives an empty manifest."""
    spark = pages.sparkSession
    ship_package(spark)
    root = (root or scratch_path(spark, "warc")).rstrip("/")
    if root.startswith("/"):
        root = "file://" + root
    elif root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root[5:]
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    digest, length = F.unhex(F.sha1(html.cast("binary"))).alias("digest"), F.octet_length(html).cast("long").alias("length")
    narrow = store(base.select("page_id", "url", digest, length), "digests")
    total = narrow.agg(F.sum("length")).first()[0] or 0
    cuts = boundaries(narrow, shards or max(-(-total // shard_bytes), 2 * default_parallelism(spark)))
    order = F.struct(F.col("page_id").isNotNull().alias("i"), "page_id", F.col("url").isNotNull().alias("u"), "url")
    first = (narrow.groupBy("digest").agg(F.max(order).alias("o"), F.count("*").alias("n")).where("n > 1")
             .select("digest", F.col("o.page_id").alias("to"), F.col("o.url").alias("to_url")))
    # the pages that share a payload with another: which one is it that the record refers to
    shared = narrow.join(first, "digest").select("page_id", "url", "digest", "to", "to_url").distinct()
    info = shared.select("page_id", "url", F.lit(None).cast("string").alias("html"), "digest", F.lit(0).cast("long").alias("length"), F.lit(0).alias("kind"), "to", "to_url")
    rows = base.select("page_id", "url", "html", digest, length, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("to"), F.lit(None).cast("string").alias("to_url"))
    shard = _shard(cuts)
    both = rows.unionByName(info).withColumn("shard", shard)
    n = max(default_parallelism(spark), min(len(cuts) + 1, 4 * default_parallelism(spark)))
    keys = ("shard", "page_id", "digest", "url")
    sorted_ = both.repartitionByRange(n, "shard").sortWithinPartitions(*keys, "kind")
    ready = sorted_.mapInArrow(_mark, "shard int, page_id long, url string, html string, digest binary, length long, refers long, response boolean")
    files = store(ready.mapInArrow(_write(root, roll_bytes), "shard int, part int, temp string, path string, records long, bytes long, sha256 string"), "warc-files")
    kinds = "shard int, part int, temp string, path string, records long, bytes long, sha256 string"
    done = files.repartition("path").mapInArrow(_rename, kinds).drop("temp")
    done.write.parquet(f"{root}/manifest")
    return root, spark.read.parquet(f"{root}/manifest")


def _shard(cuts: list[int]):
    """The number of cuts at or below the id; found by halving the list."""
    def part(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("page_id") >= cuts[mid], part(mid + 1, hi)).otherwise(part(lo, mid))
    return part(0, len(cuts)).cast("int")


def _mark(batches):
    """Takes the info row that stands before the records of the same page and
    payload: one of equal rows alone is the response."""
    types = [("shard", pa.int32()), ("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("digest", pa.binary()), ("length", pa.int64()), ("refers", pa.int64()), ("response", pa.bool_())]
    info = None  # (page, url, digest), what it refers to, whether its response has been written
    for batch in batches:
        for s in range(0, batch.num_rows, 200):
            sub = batch.slice(s, 200)
            col = {n: sub.column(i).to_pylist() for i, n in enumerate(sub.schema.names)}
            out: list[list] = [[] for _ in types]
            for i in range(sub.num_rows):
                key = (col["page_id"][i], col["url"][i], col["digest"][i])
                if col["kind"][i] == 0:
                    info = [key, col["to"][i], (col["to"][i], col["to_url"][i]) != key[:2]]
                    continue
                refers, response = None, True
                if info is not None and info[0] == key:
                    if info[2]:
                        refers, response = info[1], False
                    info[2] = True
                for x, y in zip(out, (col["shard"][i], key[0], key[1], col["html"][i] if response else None, key[2], col["length"][i], refers, response)):
                    x.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(out, types)], names=[n for n, _ in types])


def _read(batches):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for content in batch.column(0):
            rows = []
            for h, block in parse(content.as_py()):
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                if h["WARC-Type"] == "response" and (len(payload) != length or base32(hashlib.sha1(payload).digest()) != digest):
                    raise ValueError("a payload doesn't match its digest")
                page, to = h.get("X-Page-ID"), h.get("X-Refers-To-Page-ID")
                rows.append((None if page is None else int(page), length, digest, h["WARC-Type"], None if to is None else int(to), h.get("WARC-Target-URI"),
                             payload if h["WARC-Type"] == "response" else None))
                if len(rows) >= 100:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)


def read_warc(root: str, manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url,
    payload) of each record in the manifest's files; digests are checked. A
    revisit has the length and digest of the payload that it refers to, and a
    null payload."""
    spark = manifest.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(root)
    # only files of the manifest count
    name = F.element_at(F.split("path", "/"), -1)
    known = manifest.select(name.alias("name"))
    return (files.select(name.alias("name"), "content").join(known, "name", "left_semi").select("content")
            .mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages, reads the archives back: (page_id, payload_bytes,
    payload_digest, record_type, refers_to) of each."""
    root, manifest = write_warc(pages)
    if manifest.isEmpty():
        return pages.sparkSession.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_warc(root, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
