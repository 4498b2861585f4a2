"""Languages of words in mixed text by a linear-chain conditional random field.

A word's features are its first and last one to three bytes, its runs of three bytes and the word
itself, all hashed into one table of weights. Transitions between languages are learned too, from
sequences that are spliced from documents of several languages. Forward-backward gives each word
its distribution; a document's language is the one with the largest mean.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from postlens.llm import words as W

TABLE = 1 << 16
#: Training documents per language and in all, at most, taken in the order of a hash of doc_id.
TRAIN_PER_LANGUAGE = 300
TRAIN_ROWS = 3000
SALTS = 64
#: Words in a training piece, and pieces taken from a document (at its start, middle and end).
PIECE_WORDS = 30
#: Words that a chain labels, and words of context before and after that it sees besides.
CHAIN, MARGIN = 256, 24
UNKNOWN = "und"


def _letters() -> np.ndarray:
    table = W.byte_classes(joined=False)
    return np.where(table == W.LETTER, table, 0).astype(np.uint8)


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray):
    """(word, place in the table) of the features of each word, as two flat arrays."""
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint64)
    n = end - start
    words, codes = [np.arange(len(start))], [hashes * np.uint64(31)]
    with np.errstate(over="ignore"):
        def code(kind, places, size):
            value = np.full(len(places), np.uint64(kind * 7 + size))
            for j in range(size):
                value = value * np.uint64(259) + padded[places + j]
            return value
        for size in (1, 2, 3):
            some = np.flatnonzero(n >= size)
            words += [some, some]
            codes += [code(1, start[some], size), code(2, end[some] - size, size)]
        runs = np.maximum(n - 2, 0)
        of = np.repeat(np.arange(len(start)), runs)
        places = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
        words.append(of)
        codes.append(code(3, places, 3))
        place = W.mix(np.concatenate(codes)) >> np.uint64(48)
    return np.concatenate(words), place.astype(np.int64)


def emissions(data, start, end, hashes, weights: np.ndarray) -> np.ndarray:
    """Score of each language for each word; equal words are scored once."""
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    word, place = features(data, start[first], end[first], hashes[first])
    score = np.stack([np.bincount(word, column, len(first)) for column in weights[place].T], axis=1)
    return score[inverse]


def forward_backward(score: np.ndarray, length: np.ndarray, transitions: np.ndarray):
    """Distributions of the words of many chains, (steps, chains, languages), and the expected
    number of transitions. ``score`` beyond a chain's length is not read."""
    steps, chains, k = score.shape
    e = np.exp(score - score.max(axis=2, keepdims=True))
    a = np.exp(transitions - transitions.max())
    alpha, beta = np.zeros_like(e), np.ones_like(e)
    for t in range(steps):
        now = e[t] if t == 0 else (alpha[t - 1] @ a) * e[t]
        alpha[t] = now / now.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        back = (e[t + 1] * beta[t + 1]) @ a.T
        back /= back.sum(axis=1, keepdims=True)
        beta[t] = np.where((t + 1 < length)[:, None], back, 1.0)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    return gamma, alpha, beta, e, a


class Field:
    """Weights and transitions of a trained field."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.weights = np.zeros((TABLE, len(languages)))
        self.transitions = np.zeros((len(languages),) * 2)

    def train(self, pieces: list[tuple[str, int]], steps: int = 60, rate: float = 0.2):
        """Adam on the log-likelihood of sequences spliced from ``pieces`` (text, language)."""
        rng = np.random.default_rng(11)
        k = len(self.languages)
        order = rng.permutation(len(pieces))
        chains, at = [], 0
        while at < len(order):
            size = int(rng.integers(1, 4))
            chains.append([pieces[i] for i in order[at: at + size]])
            at += size
        reader = W.Reader(_letters())
        flat = [p for chain in chains for p in chain]
        w = reader.read(W.strings(pa.array([p[0] for p in flat], pa.string())))
        gold = np.repeat([p[1] for p in flat], w.count)
        sizes = np.repeat(np.arange(len(chains)), [len(c) for c in chains])
        length = np.bincount(sizes, w.count, len(chains)).astype(np.int64)
        some = np.flatnonzero(length)
        chain = np.repeat(np.searchsorted(some, sizes), w.count)
        length = length[some]
        step = np.arange(len(w)) - np.repeat(np.cumsum(length) - length, length)
        word, place = features(w.data, w.start, w.end, w.hash)
        target = np.eye(k)[gold]
        follows = np.flatnonzero(step[1:] > 0) + 1
        counted = np.zeros((k, k))
        np.add.at(counted, (gold[follows - 1], gold[follows]), 1)
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.weights, self.transitions)]
        inside = np.zeros((int(length.max()), len(length)), bool)
        inside[step, chain] = True
        for t in range(1, steps + 1):
            own = np.stack([np.bincount(word, c, len(w)) for c in self.weights[place].T], axis=1)
            score = np.zeros((inside.shape[0], inside.shape[1], k))
            score[step, chain] = own
            gamma, alpha, beta, e, a = forward_backward(score, length, self.transitions)
            pair = alpha[:-1, :, :, None] * a * (e[1:] * beta[1:])[:, :, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            expected = (pair * inside[1:, :, None, None]).sum(axis=(0, 1))
            error = (target - gamma[step, chain])[word]
            grads = [np.stack([np.bincount(place, error[:, i], TABLE) for i in range(k)], axis=1) / len(w) - 1e-6 * self.weights,
                     (counted - expected) / len(w) - 1e-6 * self.transitions]
            for p, g, m in zip((self.weights, self.transitions), grads, moments):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.99 * m[1] + 0.01 * g * g
                p += rate * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-9)
        self.weights = self.weights.astype(np.float32)
        return self

    def label(self, w: W.Words) -> np.ndarray:
        """Distribution over languages for each word of a block. Chains of CHAIN words see
        MARGIN more words of their document on either side."""
        k = len(self.languages)
        out = np.zeros((len(w), k))
        if not len(w):
            return out
        score = emissions(w.data, w.start, w.end, w.hash, self.weights)
        n = (w.count + CHAIN - 1) // CHAIN
        doc = np.repeat(np.arange(w.rows), n)
        part = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        core = w.first[doc] + part * CHAIN
        stop = np.minimum(core + CHAIN, w.first[doc + 1])
        begin, end = np.maximum(core - MARGIN, w.first[doc]), np.minimum(stop + MARGIN, w.first[doc + 1])
        order = np.argsort(end - begin, kind="stable")
        for lo in range(0, len(order), 512):
            own = order[lo: lo + 512]
            length = (end - begin)[own]
            at = begin[own] + np.arange(int(length.max()))[:, None]
            inside = np.arange(int(length.max()))[:, None] < length
            gamma = forward_backward(score[np.minimum(at, len(w) - 1)], length, self.transitions)[0]
            inside &= (at >= core[own]) & (at < stop[own])
            out[at[inside]] = gamma[inside]
        return out


def _pieces(batches):
    word = re.compile(r"[^\W\d_]+")
    for batch in batches:
        texts, langs = [], []
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            found = word.findall((text or "").lower())
            for at in sorted({0, max(0, len(found) // 2 - PIECE_WORDS // 2), max(0, len(found) - PIECE_WORDS)}):
                if found:
                    texts.append(" ".join(found[at: at + PIECE_WORDS]))
                    langs.append(lang)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(langs, pa.string())], names=["text", "lang"])


def fit(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, rows: int = TRAIN_ROWS) -> Field | None:
    """Field of the languages of ``docs`` (doc_id, text, lang), from a bounded sample.

    Rows with a null lang or a text without letters are not learned from; with none left there
    is no field and ``fit`` returns None. Of several rows with one id and language one is taken.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    ids = known.groupBy("doc_id", "lang").agg(F.min(F.xxhash64("text")).alias("own"))
    ids = ids.withColumn("salt", F.pmod(F.xxhash64("doc_id", "own"), F.lit(SALTS)))
    for group in (["lang", "salt"], ["lang"]):  # a frequent language is thinned out in many tasks first
        order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    ids = ids.orderBy("rank", "lang").limit(rows).drop("salt")
    # at most TRAIN_ROWS ids
    picked = known.select("doc_id", "text", "lang", F.xxhash64("text").alias("own")).join(
        F.broadcast(ids), ["doc_id", "lang", "own"]).select("doc_id", "text", "lang")
    pieces = picked.select("text", "lang").mapInArrow(_pieces, "text string, lang string").distinct().toPandas()
    if not len(pieces):
        return None
    pieces = pieces.sort_values(["lang", "text"])
    languages = sorted(set(pieces["lang"]))
    code = {x: i for i, x in enumerate(languages)}
    return Field(languages).train([(t, code[x]) for t, x in zip(pieces["text"], pieces["lang"])])


def _labeller(field):
    def run(batches):
        reader = W.Reader(_letters())
        for batch in batches:
            texts = W.strings(batch.column("text"))
            for lo, hi in W.blocks(texts):
                w = reader.read(W.folded(texts.slice(lo, hi - lo)))
                gamma = field.value.label(w)
                share = np.stack([np.bincount(w.doc, c, w.rows) for c in gamma.T], axis=1) / np.maximum(w.count, 1)[:, None]
                best = share.argmax(axis=1)
                has = (w.count > 0) & np.asarray(batch.column("has_letter").slice(lo, hi - lo).fill_null(False).to_numpy(False), bool)
                names = np.array(field.value.languages, object)[best]
                score = np.clip(share[np.arange(w.rows), best], 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.where(has, names, UNKNOWN).tolist(), pa.string()),
                     pa.array(np.where(has, score, 0.0)),
                     pa.array([dict(zip(field.value.languages, r)) if h else {} for r, h in zip(share.tolist(), has)],
                              pa.map_(pa.string(), pa.float64()))],
                    names=["doc_id", "lang_pred", "score", "shares"])
    return run


def predict(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, lang_pred, score, shares): language of each text, the mean probability of its words
    and that of every language, so a mixed text shows its parts.

    A null text or one without a letter is ``und`` with score 0; so is every text if there is
    no field. Equal shares go to the first language in alphabetical order. Repeated rows are labelled each time.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    if field is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.create_map().cast("map<string,double>").alias("shares"))
    shared = docs.sparkSession.sparkContext.broadcast(field)  # TABLE floats per language
    return docs.select("doc_id", "text", F.col("text").rlike(r"\p{L}").alias("has_letter")).mapInArrow(
        _labeller(shared), f"doc_id {kind}, lang_pred string, score double, shares map<string,double>")
