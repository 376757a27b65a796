"""DuckDB SQL of the queries that SQL can express. The views are those of the
tables; results have the columns of the registered queries."""

from __future__ import annotations


def simplex_clusters(centroids: int = 16, rounds: int = 3) -> str:
    """Op 11: plain rounds over all pairs of a vector and a centroid."""
    parts = [f"""kept AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64 AND len(embedding) = 64),
cells AS (SELECT rid, unnest(range(64)) AS k, CAST(unnest(x) AS BIGINT) AS v FROM kept),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1 AS j, x FROM kept ORDER BY j LIMIT {centroids})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (
  SELECT rid, arg_min(j, d * {centroids} + j) AS j, min(d) AS d
  FROM (SELECT rid, j, CAST(list_inner_product(kept.x, kept.x) + list_inner_product(c.x, c.x) - 2 * list_inner_product(kept.x, c.x) AS BIGINT) AS d
        FROM kept CROSS JOIN c{i} c) GROUP BY rid)""")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT j, k, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN cells USING (rid) GROUP BY j, k),
c{i + 1} AS (
  SELECT c.j, coalesce(new.x, c.x) AS x FROM c{i} c LEFT JOIN
    (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY k) AS x FROM m{i} GROUP BY j) new ON c.j = new.j)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c.x, lambda v: CAST(v AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (rid) JOIN c{rounds} c ON a.j = c.j"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes, by its table (built from the polynomial)."""
    step = "lambda c, b: xor(c // 256, list_extract(crc_table, CAST(xor(c % 256, b) AS INTEGER) + 1))"
    nibble = "CAST(strpos('0123456789ABCDEF', substr(hx, {}, 1)) - 1 AS BIGINT)"
    byte = f"16 * {nibble.format('2 * i + 1')} + {nibble.format('2 * i + 2')}"
    data = f"list_transform(range(length(hx) // 2), lambda i: {byte})".replace("hx", f"hex(encode({text}))")
    return f"xor(list_reduce(list_prepend(4294967295, {data}), {step}), 4294967295)"


#: The table of CRC-32: eight halvings of each byte, with the polynomial where a bit falls out.
CRC_TABLE = ("SELECT list(c ORDER BY b) AS crc_table FROM (SELECT b, list_reduce(list_prepend(b, range(8)), "
             "lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM (SELECT unnest(range(256)) AS b))")


def histogram_sort(shards: int = 8, tolerance: float = 0.002) -> str:
    """Op 13: the rule of the splitters over running sums of all rows."""
    digest = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"
    return f"""WITH keyed AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t, strlen(coalesce(text, '')) + 1 AS size,
    {digest.format("coalesce(text, '')")} AS h, {digest.format("coalesce(CAST(doc_id AS VARCHAR), '')")} AS d FROM documents),
placed AS (
  SELECT *, CAST(sum(size) OVER (ORDER BY h, d, r ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS below, row_number() OVER (ORDER BY h, d, r) - 1 AS rank,
    CAST(sum(size) OVER () AS BIGINT) AS total FROM keyed),
spans AS (
  SELECT 1 AS level, h, min(below) AS low, CAST(max(below + size) AS BIGINT) AS high, count(*) AS n, any_value(total) AS total FROM placed GROUP BY h
  UNION ALL SELECT 2, h, min(below), CAST(max(below + size) AS BIGINT), count(*), any_value(total) FROM placed GROUP BY h, d
  UNION ALL SELECT 3, h, below, below + size, 1, total FROM placed),
cuts AS (
  SELECT j, arg_min(CASE WHEN j * total - {shards} * low <= {shards} * high - j * total THEN low ELSE high END, level) AS cut
  FROM spans, (SELECT unnest(range(1, {shards})) AS j)
  WHERE {shards} * low <= j * total AND j * total < {shards} * high
    AND (n = 1 OR least(j * total - {shards} * low, {shards} * high - j * total) <= {tolerance} * total) GROUP BY j),
sharded AS (SELECT *, (SELECT count(*) FROM cuts WHERE cut <= below) AS shard FROM placed),
crc AS ({CRC_TABLE})
SELECT doc_id, size, {crc32('t')} AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  rank - min(rank) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sharded, crc"""


def warc() -> str:
    """Op 2: digests and the response of each payload."""
    quintet = "CAST('0x' || substr(h, {}, 5) AS INTEGER)"
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({} // {}) % 32 AS INTEGER) + 1, 1)"
    digest = " || ".join(letter.format(quintet.format(5 * g + 1), 32 ** k) for g in range(8) for k in (3, 2, 1, 0))
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, payload, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS top FROM p)
SELECT page_id, strlen(payload) AS payload_bytes, {digest} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM d"""


def ngram_join(k: int = 4, pct: int = 85) -> str:
    """Op 3: all pairs that share a shingle, and what is reachable over the links."""
    return rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS x FROM s),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= {pct} * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n
  UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(other) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY n.doc_id, n.n"""


def phrase_dedup(width: int = 100) -> str:
    """Op 10: every string of ``width`` bytes of every document, in hexadecimal."""
    return f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
starts AS (SELECT doc_id, unnest(range(length(hx) // 2 - {width - 1})) AS i FROM d WHERE length(hx) >= {2 * width}),
named AS (SELECT doc_id, i, md5(substr(hx, 2 * i + 1, {2 * width})) AS name FROM starts JOIN d USING (doc_id)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY name ORDER BY doc_id, i) AS k FROM named) WHERE k > 1),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + {width} AS z FROM (
    SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
      SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {width} THEN 0 ELSE 1 END AS new FROM again))
  GROUP BY doc_id, run),
cuts AS (
  SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, string_agg(piece, '' ORDER BY a) AS head, max(z) AS z FROM (
    SELECT doc_id, a, z, substr(hx, 2 * coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1,
                                2 * (a - coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0))) AS piece FROM runs JOIN d USING (doc_id))
  GROUP BY doc_id)
SELECT d.doc_id, CAST(length(hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN c.doc_id IS NULL THEN hx ELSE head || substr(hx, 2 * z + 1) END)) AS kept_sha256
FROM d LEFT JOIN cuts c ON d.doc_id = c.doc_id"""


ORACLE: dict[str, str] = {
    "op2_warc": warc(),
    "op3_ngram_jaccard_join": ngram_join(),
    "op10_phrase_dedup": phrase_dedup(),
    "op11_simplex_clusters": simplex_clusters(),
    "op13_histogram_sort": histogram_sort(),
}
