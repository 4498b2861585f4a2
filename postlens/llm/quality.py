"""Quality scores: random-indexing word vectors, pooled per document, under a small network.

Each word has a sparse ternary index vector that follows from its hash, and a slot in a table of
fixed size. A word's vector is the sum of the index vectors of its neighbours in all documents,
as integers, so the sum does not depend on the order of the rows. A document is the mean and the
spread of its words' vectors. A network of two layers, trained in numpy on a bounded sample of
labelled rows, gives a logit; a temperature fitted on rows kept aside calibrates it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from postlens.llm import words as W
from postlens.llm.frames import fresh

SLOTS = 1 << 15
DIM = 32
SPAN = 2
HIDDEN = 32
#: Labelled rows that the network is fitted on, at most; taken in the order of a hash of doc_id.
TRAIN_ROWS = 20_000
THRESHOLD = 0.5


def _read(reader: W.Reader, column: pa.Array):
    """Words in their own case; digits and runs of symbols are words too."""
    w = reader.read(column)
    return w, (w.hash & np.uint64(SLOTS - 1)).astype(np.int64)


def _classes() -> np.ndarray:
    return W.byte_classes(symbols=True, joined=False)


def _contexts(batches):
    """Sum of neighbours' index vectors per slot, one row per slot that a task has seen."""
    reader = W.Reader(_classes())
    table = np.zeros(SLOTS * DIM, np.int64)
    count = np.zeros(SLOTS, np.int64)
    for batch in batches:
        texts = W.strings(batch.column(0))
        for lo, hi in W.blocks(texts):
            w, slot = _read(reader, texts.slice(lo, hi - lo))
            count += np.bincount(slot, minlength=SLOTS)
            for step in range(1, SPAN + 1):
                at = np.flatnonzero(w.doc[step:] == w.doc[:-step])
                for own, other in ((at, at + step), (at + step, at)):
                    h = w.hash[other]
                    for shift in (20, 40):
                        place = ((h >> np.uint64(shift)) % np.uint64(DIM)).astype(np.int64)
                        sign = 1 - 2 * ((h >> np.uint64(shift + 10)) & np.uint64(1)).astype(np.int64)
                        np.add.at(table, slot[own] * DIM + place, sign)
    seen = np.flatnonzero(count)
    table = table.reshape(SLOTS, DIM)[seen]
    if len(seen):
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(count[seen])] + [pa.array(np.ascontiguousarray(c)) for c in table.T],
            names=["slot", "n"] + [f"d{i}" for i in range(DIM)])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Table of unit vectors, SLOTS x DIM, over all words of all documents."""
    names = ["n"] + [f"d{i}" for i in range(DIM)]
    sums = docs.select("text").mapInArrow(
        _contexts, "slot bigint, " + ", ".join(f"{n} bigint" for n in names)
    ).groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toPandas()  # at most SLOTS rows
    table = np.zeros((SLOTS, DIM), np.float32)
    if len(sums):
        v = sums[names[1:]].to_numpy(np.float64)
        length = np.sqrt((v * v).sum(axis=1, keepdims=True))
        table[sums["slot"].to_numpy(np.int64)] = v / np.maximum(length, 1e-12)
    return table


def pooled(w: W.Words, slot: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors and the logarithm of their number, per row."""
    n = np.maximum(w.count, 1)[:, None]
    some = np.flatnonzero(w.count)
    mean = np.zeros((w.rows, DIM))
    square = np.zeros((w.rows, DIM))
    if len(some):
        v = table[slot]
        mean[some] = np.add.reduceat(v, w.first[some], axis=0, dtype=np.float64)
        square[some] = np.add.reduceat(v * v, w.first[some], axis=0, dtype=np.float64)
    mean, square = mean / n, square / n
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.hstack([mean, spread, np.log1p(w.count)[:, None]])


class Network:
    """Two layers with tanh between, trained by Adam on all rows at once."""

    def __init__(self, x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.02, decay: float = 1e-4):
        rng = np.random.default_rng(7)
        self.shift, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = (x - self.shift) / self.scale
        self.p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        first = [np.zeros_like(p) for p in self.p]
        second = [np.zeros_like(p) for p in self.p]
        for t in range(1, steps + 1):
            hidden = np.tanh(z @ self.p[0] + self.p[1])
            error = (sigmoid(hidden @ self.p[2] + self.p[3]) - y) / len(y)
            back = np.outer(error, self.p[2]) * (1 - hidden * hidden)
            for i, g in enumerate((z.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True))):
                g = g + decay * self.p[i] * (i % 2 == 0)
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                self.p[i] = self.p[i] - rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.shift) / self.scale
        return np.tanh(z @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def calibrate(self, x: np.ndarray, y: np.ndarray):
        """Temperature of the smallest log loss on rows that were not trained on."""
        logit = self.logit(x)
        grid = np.exp(np.linspace(np.log(0.2), np.log(10), 120))
        loss = [np.mean(np.logaddexp(0, logit / t) - y * logit / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x) / self.temperature)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Constant:
    """Stands in when the labels do not have both classes: their smoothed share of 1."""

    def __init__(self, y):
        self.share = (float(np.sum(y)) + 1) / (len(y) + 2)

    def probability(self, x):
        return np.full(len(x), self.share)


def _features(table, extra: list[str]):
    def run(batches):
        reader = W.Reader(_classes())
        for batch in batches:
            texts = W.strings(batch.column("text"))
            for lo, hi in W.blocks(texts):
                x = pooled(*_read(reader, texts.slice(lo, hi - lo)), table.value)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in extra] + [lists], names=extra + ["x"])
    return run


def _scores(table, model, names):
    def run(batches):
        reader = W.Reader(_classes())
        for batch in batches:
            texts = W.strings(batch.column("text"))
            for lo, hi in W.blocks(texts):
                x = pooled(*_read(reader, texts.slice(lo, hi - lo)), table.value)
                score = model.probability(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in batch.schema.names]
                    + [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    names=batch.schema.names + names)
    return run


class Classifier:
    """Word vectors and network, as ``fit`` returns them."""

    def __init__(self, spark, table: np.ndarray, model):
        self.table, self.model = spark.sparkContext.broadcast(table), model  # SLOTS x DIM floats, 4 MB

    def score(self, docs: DataFrame, keep: list[str], score: str = "score", predicted: str = "predicted") -> DataFrame:
        """(keep..., score, predicted) of every row; ``keep`` must contain text. A name that ``keep``
        has already gets underscores in front, so a caller that keeps unknown columns passes its own."""
        kept = docs.select(keep)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
        names = [fresh(kept, score), fresh(kept, predicted)]
        return kept.mapInArrow(_scores(self.table, self.model, names), f"{fields}, `{names[0]}` double, `{names[1]}` int")


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Classifier:
    """Classifier for label 1 of ``labels`` (doc_id, quality), with word vectors of all ``docs``.

    At most ``train_rows`` labelled ids are trained on, a fifth of them for the temperature.
    Null labels and labels without a document are left out; of several labels for one id the
    mean decides, 1 at a tie. Repeated documents count as often as they occur. Null text is the
    empty text, whose words' mean and spread are zero; it gets a score like any other. Without
    both classes every score is the smoothed share of label 1, 0.5 if there are no labels.
    """
    spark = docs.sparkSession
    table = word_vectors(docs)
    sample = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("y"))
    order = F.xxhash64("doc_id")
    sample = sample.orderBy(order, "doc_id").limit(train_rows)
    shared = spark.sparkContext.broadcast(table)
    # at most train_rows ids, a bound that does not depend on the data
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # ids of any type; whole numbers are set aside by their own value, others by a hash
    kind = docs.schema["doc_id"].dataType
    number = F.col("doc_id").cast("bigint") if isinstance(kind, T.IntegralType) else F.xxhash64("doc_id")
    known = known.select("doc_id", "text", "y", number.alias("number"))
    rows = known.mapInArrow(_features(shared, ["doc_id", "y", "number"]),
                            f"doc_id {kind.simpleString()}, y int, number bigint, x array<double>")
    rows = rows.groupBy("doc_id", "y", "number").agg(F.min("x").alias("x")).toPandas()
    y = rows["y"].to_numpy(np.float64)
    if len(set(y.tolist())) < 2:
        return Classifier(spark, table, Constant(y))
    rows = rows.sort_values("doc_id", ignore_index=True)
    x, y = np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(np.float64)
    aside = W.mix(rows["number"].to_numpy(np.int64).view(np.uint64)) % np.uint64(5) == 0
    if len(set(y[~aside].tolist())) < 2 or not aside.any():
        aside = np.zeros(len(y), bool)
    model = Network(x[~aside], y[~aside])
    if aside.any():
        model.calibrate(x[aside], y[aside])
    return Classifier(spark, table, model)
