"""HTML extraction: the main text of pages by differencing with the pages of the
nearest URLs.

A page is cut into lines (the text between two block tags), each with the place
it has in the page's structure. Lines of menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments, told by element,
role or class name, are left out. All pages are put in the order of host, URL path
and URL, and each is aligned with the NEAREST pages before and after it on its host
by the longest common subsequence of lines. Lines that most of the alignments share
belong to the site and are deleted (one neighbour alone may quote the page, or
have another template). A neighbour with the very same lines is a copy and says
nothing about the site.

What a page itself declares to be its article (``article`` or ``main``) is then
restored as a whole, since a line in it that a neighbour has too is text that two
articles share, and is all of its main text."""

from __future__ import annotations

import html as entities
import json
import re

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, slices, store

#: Pages on either side that a page is aligned with, and pages of a window of the order.
NEAREST, CHUNK = 5, 5_000

# HTML's elements by what they mean here.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "xmp", "iframe", "noembed", "noframes")
SKIP = ("nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "svg", "math", "object", "canvas", "audio", "video", "head")
BLOCK = ("address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html",
         "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
         "thead", "tr", "ul")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
ROLES = ("alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar")
NAMES = ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
         "cookie", "cookies", "disqus", "footer", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
         "notification", "pager", "pagination", "popup", "promo", "promotion", "related", "respond", "share", "sharing", "sidebar", "signup", "social",
         "sponsor", "sponsored", "sponsors", "subscribe", "toolbar", "widget")

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
_skip, _block, _void, _raw, _roles, _names = map(frozenset, (SKIP, BLOCK, VOID, RAW, ROLES, NAMES))
_ends = {t: re.compile(rf"</{t}\s*[^>]*(?:>|\Z)", re.I) for t in RAW}


def noise(tag: str, attrs: str, inside: bool) -> bool:
    """Whether an element is none of the main text. inside: it lies in the
    article, where a header is the article's own."""
    if tag in _skip or (tag == "header" and not inside):
        return True
    if "=" not in attrs and "hidden" not in attrs:
        return False
    a = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(attrs)}
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""):
        return True
    if a.get("role") in _roles:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return any(_names & set(_NAME.findall(x)) for x in (a.get("class", ""), a.get("id", "")))


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """(text, place) of the page's lines; place: 2 in an article, 1 in main, 0
    elsewhere in the body, -1 noise. References are decoded, white space within a
    line is one space."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int, int]] = []  # element, 1 if it is noise, its place
    parts: list[str] = []
    page = page or ""
    at, skip, place = 0, 0, 0

    def end_line():
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, -1 if skip else place))
            parts.clear()

    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                parts.append(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = m[2].lower()
        if tag in _block or tag in _raw or tag in _skip:
            end_line()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    end_line()
                    del stack[k:]
                    skip = sum(x[1] for x in stack)
                    place = max((x[2] for x in stack), default=0)
                    break
            continue
        if tag in _raw:
            e = _ends[tag].search(page, at)
            at = e.end() if e else len(page)
            continue
        if tag in _void or m[3].endswith("/"):
            continue
        if tag == "p" or tag == "li":  # an open one ends where the next begins
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    skip = sum(x[1] for x in stack)
                    break
                if stack[k][0] in ("ul", "ol", "div", "article", "main", "section", "td", "blockquote", "body"):
                    break
        bad = noise(tag, m[3], place > 0)
        mine = 2 if tag == "article" else 1 if tag == "main" or re.search(r"role\s*=\s*[\"']?main\b", m[3]) else 0
        if bad:
            end_line()
        stack.append((tag, int(bad), mine))
        skip += bad
        place = max(place, mine)
    end_line()
    return out


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Places in a of a longest common subsequence of a and b (equal ends first,
    then a row of lengths at a time)."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ha, hb = len(a), len(b)
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha, hb = ha - 1, hb - 1
    out = {*range(lo), *range(ha, len(a))}
    both = set(a[lo:ha]) & set(b[lo:hb])
    x = [i for i in range(lo, ha) if a[i] in both]
    y = [b[j] for j in range(lo, hb) if b[j] in both]
    table = [[0] * (len(y) + 1)]
    for i in x:
        row, up = [0], table[-1]
        for j, v in enumerate(y):
            row.append(up[j] + 1 if a[i] == v else max(up[j + 1], row[j]))
        table.append(row)
    i, j = len(x), len(y)
    while i and j:
        if a[x[i - 1]] == y[j - 1]:
            out.add(x[i - 1])
            i, j = i - 1, j - 1
        elif table[i - 1][j] >= table[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out


def line_hash(x: str) -> int:
    return xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63)


def site_lines(own: list[int], near: list[list[int]]) -> list[int]:
    """Places of the lines that most alignments with the near pages share."""
    near = [x for x in near if x != own]
    votes: dict[int, int] = {}
    for other in near:
        for k in common_lines(own, other):
            votes[k] = votes.get(k, 0) + 1
    return sorted(k for k, n in votes.items() if 2 * n > len(near))


def main_lines(lines: list[tuple[str, int]], drop: list[int], declared: bool = True) -> list[str]:
    """The main text's lines: those that aren't the site's, or with ``declared``,
    where the page has one, those of its article, else of its main part."""
    top = max((p for _, p in lines), default=0)
    if declared and top > 0:
        return [t for t, p in lines if p == top]
    gone = set(drop)
    return [t for k, (t, _) in enumerate(lines) if k not in gone]


def _lines(batches):
    """(page_id, url, r, lines, body): the lines that aren't noise with their places,
    packed, and their hashes."""
    z = zstandard.ZstdCompressor(level=12)
    for batch in slices(batches, 500):
        found = [[x for x in lines_of(x) if x[1] >= 0] for x in batch.column("html").to_pylist()]
        packed = [z.compress(json.dumps([[t for t, _ in f], [p for _, p in f]], ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass")) for f in found]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "r")), pa.array(packed, pa.binary()),
                                          pa.array([[line_hash(t) for t, _ in f] for f in found], pa.list_(pa.int64()))],
                                         names=["page_id", "url", "r", "lines", "body"])


def _site(batches):
    for b in slices(batches, 500):
        drop = [site_lines(own, near) for own, near in zip(b.column("body").to_pylist(), b.column("near").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("r"), pa.array(drop, pa.list_(pa.int32()))], names=["r", "drop"])


def _join(declared: bool):
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in slices(batches, 500):
            text = []
            for blob, drop in zip(b.column("lines").to_pylist(), b.column("drop").to_pylist()):
                lines, places = json.loads(z.decompress(blob).decode("utf-8", "surrogatepass"))
                text.append(" ".join(main_lines(list(zip(lines, places)), drop or [], declared)))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
    return run


def neighbours(rows: DataFrame, chunk: int = CHUNK, nearest: int = NEAREST) -> DataFrame:
    """(r, body, near) of the ``rows`` (host, path, url, page_id, r, body); near: the
    bodies of the ``nearest`` pages before and after in that order, as far as they
    are on the page's host.

    One range exchange puts all pages in order, so a host may span any number of
    ranges. With the ranges' sizes each page knows its place in the whole order;
    ``chunk`` places are a window, which also gets the pages that lie next to it."""
    order = ["host", "path", "url", "page_id", "r"]
    at = F.col("_at")
    laid = store(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
                 .select("r", "host", "body", F.shiftright(at, 33).alias("_range"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), "pages")
    starts, before = [], 0
    for r in sorted(laid.groupBy("_range").agg(F.count("*").alias("n")).collect()):  # a row for each range
        starts.append((r[0], before))
        before += r[1]
    start = rows.sparkSession.createDataFrame(starts, "_range long, _start long")
    placed = laid.join(start, "_range").withColumn("_place", F.col("_start") + F.col("_place")).drop("_range", "_start")
    own = F.floor(F.col("_place") / chunk)
    windows = F.array_distinct(F.transform(F.array(F.lit(0), F.lit(-nearest), F.lit(nearest)), lambda d: F.floor((F.col("_place") + d) / chunk)))
    dealt = placed.withColumn("_own", own).withColumn("_chunk", F.explode(windows))
    w, side = Window.partitionBy("_chunk").orderBy("_place"), F.struct("host", "body")
    dealt = dealt.withColumn("_b", F.collect_list(side).over(w.rowsBetween(-nearest, -1))).withColumn("_a", F.collect_list(side).over(w.rowsBetween(1, nearest)))
    near = F.transform(F.filter(F.concat("_b", "_a"), lambda x: x["host"] == F.col("host")), lambda x: x["body"])
    return dealt.where("_chunk = _own").select("r", "body", near.alias("near"))


def main_text(pages: DataFrame, declared: bool = True, chunk: int = CHUNK) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html).

    Null or empty html gives an empty text. A page whose URL is null or has no host
    has no neighbour. Ties in the order (equal URLs) go by page id; of repeated
    rows each gives a row, and they are copies of each other. Other columns are
    ignored; an empty table gives no row. ``declared=False`` leaves the verdict to
    the differencing alone."""
    ship_package(pages.sparkSession)
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("r", F.monotonically_increasing_id())
    rows = store(base.mapInArrow(_lines, "page_id long, url string, r long, lines binary, body array<bigint>"), "lines")  # r stays what it is
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_replace(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"(\.html?|/)$", "")
    placed = rows.select("page_id", "url", "r", "body", F.when(host != "", host).alias("host"), path.alias("path"))
    # written, so that its size tells Spark whether the packed lines can stay where they are
    drop = store(neighbours(placed, chunk).mapInArrow(_site, "r long, drop array<int>").where(F.size("drop") > 0), "site-lines")
    return (rows.select("page_id", "url", "r", "lines").join(drop, "r", "left").select("page_id", "url", "lines", "drop")
            .mapInArrow(_join(declared), "page_id long, url string, text string, n_chars long"))
