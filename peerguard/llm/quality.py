"""Quality rules, native: base rules on counts of words, symbols, repeated lines
and repeated word windows, and a hashed n-gram log-likelihood ratio between the
trusted target and the raw corpus. DataFrame and SQL functions only."""

from __future__ import annotations

from math import inf, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove_read
from .common import WORDS, store

#: Buckets of the hashed 1- and 2-grams: the size of both multinomials.
BUCKETS = 10_000
#: Documents with a mean log-likelihood ratio a gram below this quantile of the
#: target's own documents (each judged without its own counts) are rejected.
QUANTILE = 0.001
#: Row numbers of a block, a bit each: what Spark's bitmap functions hold.
BLOCK = 32_768
RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def tokenized(docs: DataFrame, id_col: str, text_col: str, whole: bool = False) -> DataFrame:
    """The one pass over the texts: (doc_id, the base counts, base_failed, _grams,
    _row) of every row, written as a table. _grams: the buckets of its words, then those of its word pairs (the last word
    has no follower and gives its own bucket again). _row: the row's number, which
    :func:`trusted_rows` marks it by. ``whole``: also _doc, the row itself.

    Each step is a projection whose columns the next one uses twice or more, which
    keeps Spark from putting a step's expressions inside the lambdas of the next."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keep = ["doc_id", "_doc"] if whole else ["doc_id"]
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")] if whole else []
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), *row, text.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select(*keep, F.regexp_extract_all("_text", F.lit(f"({WORDS})"), 1).alias("_words"), lines.alias("_lines"),
                 (F.length("_text") - F.length(F.regexp_replace("_text", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"))
    w, n = F.col("_words"), F.size("_words")
    d = d.select(*keep, "n_symbols", "_words", n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                 F.zip_with(w, F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b)).alias("_pairs"))
    # windows of three words, by the hash of a pair and its next word
    windows = F.when(n >= 3, F.zip_with(F.slice("_pairs", 1, n - 2), F.slice(w, 3, n), lambda a, b: F.xxhash64(a, b)))
    d = d.select(*keep, "n_symbols", "n_words", "word_chars", "n_dup_lines", "_words", "_pairs", windows.alias("_windows"))
    grams = F.concat(F.transform("_words", lambda x: bucket(F.xxhash64(x))), F.transform("_pairs", bucket))
    places = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select(*keep, "n_symbols", "n_words", "word_chars", "n_dup_lines", "_words", grams.alias("_grams"),
                 F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), places).alias("_places"))
    return store(d.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated_words(w, F.col("_places")).alias("n_repeat_words"), "_grams")
                 .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
                 .withColumn("_row", F.monotonically_increasing_id()), "tokenized", group_bytes=16 << 20)


def bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def repeated_words(w: Column, places: Column) -> Column:
    """Words in 3-word windows that the text has twice or more. ``places``: the
    windows' (hash, place), sorted, or null where no hash is there twice; equal
    neighbours are compared word by word."""
    def equal(i):
        a, b = F.get(places, i), F.get(places, i + 1)
        same = a["h"] == b["h"]
        for k in range(3):
            same = same & (F.get(w, a["i"] + k) == F.get(w, b["i"] + k))
        return same

    def covered(i):
        return F.array(*(F.get(places, i + d)["i"] + k for d in (0, 1) for k in range(3)))

    runs = F.filter(F.sequence(F.lit(0), F.size(places) - 2), equal)
    return F.when(places.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(F.flatten(F.transform(runs, covered))))).cast("long")


def target_ids(labels: DataFrame) -> DataFrame:
    """The ids of all trusted documents: the target multinomial and the threshold
    are fitted on every one of them."""
    return store(labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().withColumn("_t", F.lit(1)), "trusted")


def trusted_rows(tokens: DataFrame, trusted: DataFrame) -> DataFrame:
    """(_block, _bits): a bit for each of the BLOCK row numbers of a block, set where
    the row's document is trusted. Ids and row numbers alone are moved for it."""
    rows = tokens.select("doc_id", "_row").join(trusted, "doc_id")
    return store(rows.groupBy(block().alias("_block")).agg(F.bitmap_construct_agg(place()).alias("_bits")), "trusted-rows")


def block() -> Column:
    return F.floor(F.col("_row") / BLOCK)


def place() -> Column:
    return F.pmod("_row", F.lit(BLOCK))


def marked(tokens: DataFrame, rows: DataFrame) -> DataFrame:
    """(_grams, base_failed, _t) of every row, _t: 1 if its document is trusted. With
    a bit a document the blocks are few bytes, and the grams stay where they are."""
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place() / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (place() % 8).cast("int")).cast("int")
    return tokens.join(rows, block() == F.col("_block"), "left").select("_grams", "base_failed", F.coalesce(bit, F.lit(0)).alias("_t"))


def counts(tokens: DataFrame, rows: DataFrame) -> tuple[list[int], list[int]]:
    """Grams of each bucket in the target and in the corpus, add-one smoothed: each
    task sums its own first, and the result has BUCKETS numbers."""
    g = marked(tokens, rows).select(F.col("_t").alias("t"), F.explode("_grams").alias("b"))
    n = g.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("target")).collect()
    raw, target = [1] * BUCKETS, [1] * BUCKETS
    for x in n:
        raw[x["b"]] += x["raw"]
        target[x["b"]] += x["target"]
    return target, raw


def literal(values: list, kind: str) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def fitted_threshold(tokens: DataFrame, rows: DataFrame, target: list[int], raw: list[int]) -> float:
    """The QUANTILE of the ratios of the target's documents that pass the base
    rules. The target has counted these documents, no other one: each is judged
    by the target without its own grams, so that its ratio is like that of a
    clean document outside of the target. A target without such a document
    rejects none."""
    own = marked(tokens.where("not base_failed"), rows).where("_t = 1")
    d = own.select(F.sort_array("_grams").alias("_g"))
    g = F.col("_g")
    d = d.select("_g", F.filter(F.transform(g, lambda b, i: F.when((i == 0) | (b != F.get(g, i - 1)), i)), lambda i: i.isNotNull()).alias("_runs"))
    runs, n = F.col("_runs"), F.size("_g")
    t, r, all_t, all_r = literal(target, "long"), literal(raw, "long"), F.lit(sum(target)), F.lit(sum(raw))

    def part(i, k):
        b = F.get(g, i)
        many = F.coalesce(F.get(runs, k + 1), n) - i
        return many * (F.log((F.get(t, b) - many) / (all_t - n)) - F.log(F.get(r, b) / all_r))

    ratio = F.aggregate(F.transform(runs, part), F.lit(0.0), lambda a, x: a + x) / n
    at = d.agg(F.percentile_approx(ratio, QUANTILE, 100_000)).first()[0]
    return -inf if at is None else at


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, ratio) for every row of ``docs``.

    kept: the base rules hold and the mean log-likelihood ratio over the text's
    hashed 1- and 2-grams is ``threshold`` or more (by default the fitted one).
    Null and empty texts fail
    (no words). Repeated ids and equal rows are judged row by row. With no
    trusted document the target is flat, so ratios compare with a uniform
    multinomial, and the base rules alone decide. Other columns are ignored; an
    empty table gives no row."""
    return judged(tokenized(docs, id_col, text_col), labels, threshold).select("doc_id", *RULES, "kept", "ratio")


def quality_filter(docs: DataFrame, labels: DataFrame, threshold: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. The rows are
    written beside their grams, so the verdicts need not be sent to them; the kept
    ones are written alone, and the table with the grams is removed."""
    tokens = tokenized(docs, id_col, text_col, whole=True)
    kept = store(judged(tokens, labels, threshold).where("kept").select("_doc.*"), "kept", "zstd")
    remove_read(tokens)
    return kept


def judged(tokens: DataFrame, labels: DataFrame, threshold: float | None) -> DataFrame:
    """The tokenized table with ``ratio`` and ``kept``."""
    rows = trusted_rows(tokens, target_ids(labels))
    target, raw = counts(tokens, rows)
    if threshold is None:
        threshold = fitted_threshold(tokens, rows, target, raw)
    t, r = sum(target), sum(raw)
    table = literal([log(a / t) - log(b / r) for a, b in zip(target, raw)], "double")
    total = F.aggregate("_grams", F.lit(0.0), lambda a, b: a + F.get(table, b))
    d = tokens.withColumn("ratio", F.when(F.col("n_words") > 0, total / (2 * F.col("n_words"))))
    return d.withColumn("kept", ~F.col("base_failed") & (F.coalesce("ratio", F.lit(-inf)) >= threshold))
