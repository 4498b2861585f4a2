"""Document fingerprints from spot signatures, and their likeness.

A spot signature is a common word (anchor) with the next content words after it. A text's
fingerprint is the set of its signatures; the start of the text is an anchor too, so every text
with a word has one. Likeness is the Jaccard similarity of two sets. Pairs are dealt into
partitions by the lengths of their sets, and a partition whose lengths rule out the least
likeness asked for is not compared. Nothing is ruled out by default.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from postlens.llm import words as W
from postlens.llm.frames import written

CHAIN = 3
#: Pairs whose set lengths rule out this likeness count as 0 without a comparison.
LEAST = 0.0
#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the a an is was are be been to of in on at by for from with as that this it and or not "
    "der die das den dem des ein eine einer und oder ist war nicht mit von zu im auf für als sich "
    "le la les un une des du de et ou est en dans par pour sur que qui ne pas au aux "
    "el los las una del y o es por para con se su al lo como no más"
).split()


class Spots:
    """Signature sets of blocks of texts."""

    def __init__(self, chain: int = CHAIN):
        self.reader, self.chain = W.Reader(W.byte_classes()), chain
        self.plain = W.Reader(W.byte_classes())
        anchors = self.reader.read(W.strings(pa.array([" ".join(dict.fromkeys(ANCHORS))])))
        self.anchors = np.unique(anchors.hash)

    def read(self, column: pa.Array) -> np.ndarray:
        """Sorted numbers without repeats: 12 bits of row, 52 bits of signature."""
        w = self.reader.read(W.folded(column))
        n = len(w)
        keys = []
        if n:
            at = np.minimum(np.searchsorted(self.anchors, w.hash), len(self.anchors) - 1)
            anchor = self.anchors[at] == w.hash
            content = np.flatnonzero(~anchor)
            before = np.cumsum(~anchor) - ~anchor
            some = np.flatnonzero(w.count)
            spot = np.concatenate([np.flatnonzero(anchor), w.first[some]])
            code = np.concatenate([w.hash[anchor], np.full(len(some), np.uint64(1))])
            first = before[spot] + np.concatenate([np.zeros(int(anchor.sum()), np.int64), np.zeros(len(some), np.int64)])
            with np.errstate(over="ignore"):
                for j in range(self.chain):
                    k = first + j
                    word = content[np.minimum(k, len(content) - 1)] if len(content) else np.zeros(len(spot), np.int64)
                    there = (k < len(content)) & (w.doc[word] == w.doc[spot])
                    code = W.mix(code * np.uint64(W.MULTIPLIER) + np.where(there, w.hash[word], np.uint64(0)))
            keys.append((w.doc[spot].astype(np.uint64) << np.uint64(52)) | (code >> np.uint64(12)))
        data, offsets = W.raw(column)
        bare = np.flatnonzero((w.count == 0) & (np.diff(offsets) > 0))
        if len(bare):  # texts of symbols only are their own signature
            h = self.plain.hashes(data.astype(np.uint64) + np.uint64(1), offsets[:-1][bare], offsets[1:][bare])
            keys.append((bare.astype(np.uint64) << np.uint64(52)) | (h >> np.uint64(12)))
        return np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def rows_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(52)).astype(np.int64)


def digests(keys: np.ndarray, rows: int) -> list[str]:
    """Name of each row's set: its length and a sum of its scrambled members."""
    doc = rows_of(keys)
    total = np.zeros(rows, np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(total, doc, W.mix((keys & np.uint64((1 << 52) - 1)) + np.uint64(1)))
    return [f"{n:x}-{t:016x}" for n, t in zip(np.bincount(doc, minlength=rows).tolist(), total.tolist())]


def likeness(a: np.ndarray, b: np.ndarray, rows: int, least: float = LEAST) -> np.ndarray:
    """Jaccard similarity of the sets of equal rows; two empty sets are equal."""
    n, m = np.bincount(rows_of(a), minlength=rows), np.bincount(rows_of(b), minlength=rows)
    low, high = np.minimum(n, m), np.maximum(n, m)
    open_ = low >= least * np.maximum(high, 1)
    part = np.where(open_ & (high > 0), np.floor(np.log2(np.maximum(low, 1))), -1).astype(np.int64)
    common = np.zeros(rows)
    for p in np.unique(part[part >= 0]):
        own = part == p
        both = np.intersect1d(a[own[rows_of(a)]], b[own[rows_of(b)]], assume_unique=True)
        common += np.bincount(rows_of(both), minlength=rows)
    return np.where(high == 0, 1.0, common / np.maximum(n + m - common, 1))


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter is replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


RESULT = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(spots: Spots, texts: list[str], nexts: list[str], least: float) -> list[pa.Array]:
    changed = [edited(a, b) for a, b in zip(texts, nexts)]
    n = len(texts)
    own, new, following = (spots.read(W.strings(pa.array(x, pa.string()))) for x in (texts, changed, nexts))
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array(digests(own, n), pa.string()), pa.array(digests(new, n), pa.string()),
        pa.array(likeness(own, new, n, least)), pa.array(likeness(own, following, n, least))]


_NAMES = [f.split()[0] for f in RESULT.split(", ")]


def _blocks(texts: list[str]):
    lo, size = 0, 0
    for hi, text in enumerate(texts):
        if hi > lo and (size + len(text) > W.BLOCK_BYTES // 2 or hi - lo >= W.BLOCK_ROWS // 2):
            yield lo, hi
            lo, size = hi, 0
        size += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def _neighbours(least: float, kind: pa.DataType | None = None):
    """Results of a sorted partition's rows but the last; its first and last row go on as they are."""
    def run(batches):
        spots, shard = Spots(), TaskContext.get().partitionId()

        def edge(which, ids, text):
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([which], pa.int32()), ids, pa.array([text], pa.string())] + none,
                names=["shard", "edge", "doc_id", "text"] + _NAMES)

        last_id = last = None
        for batch in batches:
            for lo, hi in W.blocks(W.strings(batch.column("text"))):
                ids = batch.column("doc_id").slice(lo, hi - lo)
                texts = [t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()]
                if last is None:
                    yield edge(1, ids.slice(0, 1), texts[0])
                else:
                    ids, texts = pa.concat_arrays([last_id, ids]), [last, *texts]
                n = len(texts) - 1
                for a, b in _blocks(texts[:n]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(b - a, shard)), pa.nulls(b - a, pa.int32()), ids.slice(a, b - a), pa.nulls(b - a, pa.string())]
                        + _compare(spots, texts[a:b], texts[a + 1: b + 1], least),
                        names=["shard", "edge", "doc_id", "text"] + _NAMES)
                last_id, last = ids.slice(n, 1), texts[n]
        if last is not None:
            yield edge(2, last_id, last)
    return run


def _pairs(least: float):
    def run(batches):
        spots = Spots()
        for batch in batches:
            texts, nexts = ([t or "" for t in batch.column(c).to_pylist()] for c in ("text", "next_text"))
            for a, b in _blocks(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a)] + _compare(spots, texts[a:b], nexts[a:b], least),
                    names=["doc_id"] + _NAMES)
    return run


def signatures(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """(doc_id, signatures): the sorted set of 52-bit spot signatures of each text."""
    def run(batches):
        spots = Spots(chain)
        for batch in batches:
            texts = W.strings(batch.column("text"))
            for lo, hi in W.blocks(texts):
                keys = spots.read(texts.slice(lo, hi - lo))
                cut = np.searchsorted(rows_of(keys), np.arange(hi - lo + 1))
                members = pa.array((keys & np.uint64((1 << 52) - 1)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), members)],
                    names=["doc_id", "signatures"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, signatures array<bigint>")


def fingerprints(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Fingerprint of each text and of its edited text, and how like they and the next text are.

    The next text is that of the next row in ascending doc_id, for the last row the first one's;
    rows with one id are ordered by a hash of their text, a null id comes first. Null is the empty
    text; empty texts have the empty set and are alike 1 to each other, 0 to others. A text
    of symbols alone is one signature. A table of one row is its own next. Texts are shuffled
    once; only the first and last text of each partition are written and joined.
    """
    spark = docs.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tie = F.xxhash64("text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    out = written(rows.mapInArrow(_neighbours(least), f"shard bigint, edge int, doc_id {kind}, text string, {RESULT}"))
    first, last = out.where("edge = 1").select("shard", F.col("text").alias("next_text")), out.where("edge = 2")
    # one number per partition meets in this window; texts are joined afterwards
    order = Window.orderBy("shard")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = first.select("shard").select(
        "shard", F.coalesce(F.lead("shard").over(order), F.min("shard").over(whole)).alias("next"))
    ends = last.select("shard", "doc_id", "text").join(follows, "shard").join(
        first.withColumnRenamed("shard", "next"), "next").select("doc_id", "text", "next_text")
    ends = ends.mapInArrow(_pairs(least), f"doc_id {kind}, {RESULT}")
    return out.where("edge IS NULL").select("doc_id", *_NAMES).unionByName(ends)
