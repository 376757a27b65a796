"""Language ID by a linear-chain conditional random field over words.

Each word has affix (1 to 3 letters at either end), character trigram and
lexicon (the word itself) features, hashed to 2**16 weights a language; the
transitions between the languages of neighbouring words are learned too. Chains
of up to 128 words are labelled by forward-backward, so that text which switches
language gets a posterior for each word; a document's language is the one with
the largest sum of posteriors, its score that share.

The field is fitted by stochastic gradient on a sample of about ``per_language``
documents of each language (10,000 in all at most), on all their words in chains;
every fourth chain ends in words of another language, from which switches are
learned."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, ship_package

WEIGHTS, CHAIN, FOLDS, HELD = 1 << 16, 128, 3, 1
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters (Unicode category L), lower-cased. The pattern also lets
    number signs like "½" through, which end a word."""
    out: list[str] = []
    for w in _WORD.findall(text.lower()) if text else ():
        if w.isalpha():
            out.append(w)
        else:
            out += "".join(c if c.isalpha() else " " for c in w).split()
    return out


def features(w: str) -> list[int]:
    """Hashed feature numbers of a word."""
    b = f"^{w}$"
    names = [f"p{w[:k]}" for k in (1, 2, 3)] + [f"s{w[-k:]}" for k in (1, 2, 3)] + [f"w{w}"] + [b[i:i + 3] for i in range(len(b) - 2)][:40]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) & (WEIGHTS - 1) for x in names]


class Field:
    """Labels, emission weights (WEIGHTS x labels) and transitions (from, to)."""

    def __init__(self, labels: list[str], weights: np.ndarray, moves: np.ndarray):
        self.labels, self.weights, self.moves = labels, weights, moves

    def emissions(self, words: list[str]) -> np.ndarray:
        f = [features(w) for w in words]
        n = np.array([len(x) for x in f])
        flat = np.fromiter((y for x in f for y in x), "int64", int(n.sum()))
        return np.add.reduceat(self.weights[flat], np.cumsum(n) - n, axis=0) if len(f) else np.zeros((0, len(self.labels)))


def forward_backward(e: np.ndarray, real: np.ndarray, moves: np.ndarray):
    """Posteriors (chains x time x labels) and the expected number of moves; e:
    emission scores, real: which positions are words (each chain starts at 0)."""
    c, t, k = e.shape
    p = np.exp(e - e.max(axis=2, keepdims=True))
    a = np.exp(moves)
    alpha, beta = np.empty_like(p), np.ones_like(p)
    alpha[:, 0] = p[:, 0] / p[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, t):
        x = (alpha[:, i - 1] @ a) * p[:, i]
        alpha[:, i] = x / x.sum(axis=1, keepdims=True)
    for i in range(t - 2, -1, -1):
        x = (beta[:, i + 1] * p[:, i + 1]) @ a.T
        x /= x.sum(axis=1, keepdims=True)
        beta[:, i] = np.where(real[:, i + 1, None], x, 1.0)
    g = alpha * beta
    g /= g.sum(axis=2, keepdims=True)
    g *= real[:, :, None]
    return g, alpha, beta, p


def moves_expected(alpha, beta, p, real, moves) -> np.ndarray:
    a = np.exp(moves)
    both = alpha[:, :-1, :, None] * a * (p[:, 1:] * beta[:, 1:])[:, :, None, :]
    both /= both.sum(axis=(2, 3), keepdims=True)
    return (both * real[:, 1:, None, None]).sum(axis=(0, 1))


def fit(chains: list[tuple[str, list[str]]], epochs: int = 2, l2: float = 1e-4, rate: float = 0.15) -> Field:
    """Fits a field to (language, words) chains."""
    labels = sorted({y for y, _ in chains})
    k = len(labels)
    at = {y: i for i, y in enumerate(labels)}
    data = []
    for i, (y, w) in enumerate(chains):
        z = [at[y]] * len(w)
        if i % 4 == 3:
            y2, w2 = chains[(i * 7919 + 1) % len(chains)]
            h, h2 = len(w) // 2, len(w2) // 2
            w, z = w[:h] + w2[h2:], z[:h] + [at[y2]] * (len(w2) - h2)
        if w:
            data.append((w[:CHAIN], z[:CHAIN]))
    f = Field(labels, np.zeros((WEIGHTS, k)), np.zeros((k, k)))
    if k < 2:
        return f
    gw, gm = np.full((WEIGHTS, k), 1e-6), np.full((k, k), 1e-6)
    order = np.random.default_rng(3)
    memo: dict[str, list[int]] = {}
    for _ in range(epochs):
        perm = order.permutation(len(data))
        for s in range(0, len(perm), 256):
            part = [data[i] for i in perm[s:s + 256]]
            vocab: dict[str, int] = {}
            t = max(len(w) for w, _ in part)
            ids, y, real = np.zeros((len(part), t), int), np.zeros((len(part), t), int), np.zeros((len(part), t), bool)
            for i, (w, z) in enumerate(part):
                ids[i, :len(w)] = [vocab.setdefault(x, len(vocab)) for x in w]
                y[i, :len(w)], real[i, :len(w)] = z, True
            feats = [memo.get(w) or memo.setdefault(w, features(w)) for w in vocab]
            n = np.array([len(x) for x in feats])
            flat = np.concatenate([np.array(x) for x in feats])
            e = np.add.reduceat(f.weights[flat], np.cumsum(n) - n, axis=0)
            g, alpha, beta, p = forward_backward(e[ids], real, f.moves)
            miss = (np.eye(k)[y] - g) * real[:, :, None]
            by_word = np.stack([np.bincount(ids[real], miss[:, :, j][real], len(vocab)) for j in range(k)], axis=1)
            spread = np.repeat(by_word, n, axis=0)
            grad = np.stack([np.bincount(flat, spread[:, j], WEIGHTS) for j in range(k)], axis=1) / len(part) - l2 * f.weights
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:, :-1][real[:, 1:]], y[:, 1:][real[:, 1:]]), 1)
            gmove = (seen - moves_expected(alpha, beta, p, real, f.moves)) / len(part) - l2 * f.moves
            gw += grad * grad
            gm += gmove * gmove
            f.weights += rate * grad / np.sqrt(gw)
            f.moves += rate * gmove / np.sqrt(gm)
    return f


def train(docs: DataFrame, lang_col: str, per_language: int) -> Field:
    """Fits on documents outside the held-out fold with a language and words."""
    ok = docs.where(F.col("doc_id").isNotNull() & F.col(lang_col).isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != HELD))
    sizes = {r[0]: r[1] for r in ok.groupBy(lang_col).agg(F.count("*")).collect()}  # one row a language
    each = min(per_language, 10_000 // max(1, len(sizes)))
    u = (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003)
    share = F.create_map(*(F.lit(x) for y, n in sizes.items() for x in (y, min(1.0, each / n)))) if sizes else None
    if share is None:
        return Field([], np.zeros((WEIGHTS, 0)), np.zeros((0, 0)))
    sample = ok.where(u < F.element_at(share, F.col(lang_col))).select(F.col(lang_col).alias("y"), "text", "doc_id").mapInArrow(_chains, "y string, doc_id long, w string")
    rows = sorted(sample.collect(), key=lambda r: (r["doc_id"], r["y"], r["w"]))  # the sampled documents' words
    return fit([(r["y"], r["w"].split(" ")) for r in rows])


def _chains(batches):
    """The whole texts as chains of CHAIN words."""
    for batch in batches:
        out = [[], [], []]
        for y, text, doc in zip(*(batch.column(i).to_pylist() for i in range(3))):
            w = words_of(text)
            for k in range(0, len(w), CHAIN):
                for x, v in zip(out, (y, doc, " ".join(w[k:k + CHAIN]))):
                    x.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], names=["y", "doc_id", "w"])


class Tagger:
    """Posteriors by language for the words of texts; keeps the emissions of
    words it has met (bounded)."""

    def __init__(self, field: Field, limit: int = 400_000):
        self.f, self.limit = field, limit
        self.memo: dict[str, int] = {}
        self.table = np.zeros((0, len(field.labels)), "float32")

    def ids(self, texts: list[list[str]]) -> np.ndarray:
        if len(self.memo) > self.limit:
            self.memo, self.table = {}, self.table[:0]
        fresh = {w for t in texts for w in t if w not in self.memo}
        if fresh:
            fresh = sorted(fresh)
            base = len(self.memo)
            self.memo.update((w, base + i) for i, w in enumerate(fresh))
            self.table = np.concatenate([self.table, self.f.emissions(fresh).astype("float32")])
        get = self.memo.__getitem__
        return np.fromiter((get(w) for t in texts for w in t), "int64", sum(map(len, texts)))

    def posteriors(self, texts: list[list[str]]) -> np.ndarray:
        """Posteriors of all words of the texts, one below the other."""
        k = len(self.f.labels)
        ids = self.ids(texts)
        if not len(ids):
            return np.zeros((0, k))
        lens = np.array([len(t) for t in texts])
        parts = -(-lens // CHAIN)
        text_at = np.cumsum(lens) - lens
        j = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(text_at, parts) + j * CHAIN
        size = np.minimum(np.repeat(lens, parts) - j * CHAIN, CHAIN)
        out = np.empty((len(ids), k), "float32")
        order = np.argsort(size, kind="stable")
        for s in range(0, len(order), 4096):
            c = order[s:s + 4096]
            t = int(size[c].max())
            pos = start[c][:, None] + np.arange(t)
            real = np.arange(t) < size[c][:, None]
            e = self.table[ids[np.where(real, pos, start[c][:, None])]]
            g = forward_backward(e, real, self.f.moves.astype("float32"))[0]
            out[pos[real]] = g[real]
        return out


def _predict(shared):
    def run(batches):
        tagger = Tagger(shared.value)
        k = len(tagger.f.labels)
        for big in batches:
            for s in range(0, big.num_rows, 1000):
                batch = big.slice(s, 1000)
                texts = [words_of(x) for x in batch.column(1).to_pylist()]
                lens = np.array([len(t) for t in texts])
                langs, scores = ["und"] * len(texts), np.zeros(len(texts))
                some = np.flatnonzero(lens)
                if k and len(some):
                    g = tagger.posteriors([texts[i] for i in some]).astype("float64")
                    total = np.add.reduceat(g, np.cumsum(lens[some]) - lens[some], axis=0) / lens[some][:, None]
                    best = total.argmax(axis=1)
                    for i, b, row in zip(some, best, total):
                        langs[i], scores[i] = tagger.f.labels[b], min(1.0, row[b])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])
    return run


def language_id(docs: DataFrame, per_language: int = 500, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from the whole text.
    Null texts and texts without a letter are ``und`` with score 0, and so is
    every text if no row has a language to learn from. A null id stays null and
    is in fold 0 but isn't learned from; equal rows give a row each; ties go to
    the language first in the alphabet. Other columns are no input."""
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    m = docs.sparkSession.sparkContext.broadcast(train(base, "lang", per_language))
    return (base.select("doc_id", "text").mapInArrow(_predict(m), "doc_id long, lang_pred string, score double")
            .select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "lang_pred", "score"))
