"""Topic model (latent Dirichlet allocation) whose vocabulary is a table.

Online variational Bayes: each iteration reads a twentieth of the documents. The weight of a term in the topics
is ``start * lambda0(term) + level + seen``, where lambda0 is a hash of the term and ``seen`` a row of a
table for the terms of documents read so far. So neither the driver nor a task holds the vocabulary;
the driver has one number per topic.

Documents are dealt into pieces of bounded size. The distinct terms of a piece fetch their weights, so no row is made of a
term for each document that has it, and a task solves the documents of its piece side by side in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

from postlens.operators.blocks import cores_of
from postlens.operators.tokens import fenced
from postlens.session import cut, written

#: Share of the documents that an iteration reads, and how fast later ones count less.
BATCH = 0.05
OFFSET, DECAY = 1024.0, 0.51
#: Shape of the gamma distribution that a model starts from.
SHAPE = 100.0
MOST_ROUNDS = 200
#: Terms, with repeats, of the documents of one piece, and different terms of documents that are solved side by side.
PIECE_TERMS = 200_000
SIDE_BY_SIDE = 32_000


def digamma(x: np.ndarray) -> np.ndarray:
    x, out = np.array(x, "float64"), 0.0
    for _ in range(8):
        small = x < 8
        if not small.any():
            break
        out = out - np.where(small, 1 / x, 0.0)
        x = np.where(small, x + 1, x)
    f = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


def trigamma(x: np.ndarray) -> np.ndarray:
    x, out = np.array(x, "float64"), 0.0
    for _ in range(8):
        small = x < 8
        if not small.any():
            break
        out = out + np.where(small, 1 / (x * x), 0.0)
        x = np.where(small, x + 1, x)
    f = 1 / (x * x)
    return out + 1 / x + f / 2 + f / x * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f / 30)))


def lgamma(x: np.ndarray) -> np.ndarray:
    x, out = np.array(x, "float64"), 0.0
    for _ in range(8):
        small = x < 8
        if not small.any():
            break
        out = out - np.where(small, np.log(x), 0.0)
        x = np.where(small, x + 1, x)
    f = 1 / (x * x)
    return out + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - f * (1 / 360 - f * (1 / 1260 - f / 1680))) / x


def kept_rows(df: DataFrame, terms: str) -> DataFrame:
    """(doc, id, terms) of the rows that have a term; ``doc`` numbers rows, whose ids may repeat."""
    rows = fenced(df.select("id", terms)).where(F.size(terms) > 0)
    return cut(rows.select(F.monotonically_increasing_id().alias("doc"), "id", terms))


def vocabulary(rows: DataFrame, terms: str) -> DataFrame:
    """(term, idf) of every term, with idf = ln((N + 1) / (df + 1))."""
    n = rows.count()
    each = rows.select(F.explode(F.array_distinct(terms)).alias("term"))
    return written(each.groupBy("term").agg(F.ln((n + 1.0) / (F.count("*") + 1.0)).alias("idf")))


def in_pieces(rows: DataFrame, terms: str, share: float = 1.0) -> tuple[DataFrame, int]:
    """(rows with ``piece``, number of pieces) for a ``share`` of the rows."""
    n = rows.agg(F.coalesce(F.sum(F.size(terms)), F.lit(0))).first()[0]
    pieces = max(2 * cores_of(rows.sparkSession), int(np.ceil(share * n / PIECE_TERMS)))
    return rows.withColumn("piece", F.pmod(F.xxhash64("doc"), F.lit(pieces)).cast("int")), pieces


def terms_of_pieces(rows: DataFrame, terms: str, keys: list[str]) -> DataFrame:
    """(keys, term): the different terms of each piece."""
    return rows.select(*keys, F.explode(terms).alias("term")).distinct()


@dataclass
class Topics:
    """A fitted model: ``words`` (term, idf), ``seen`` (term, s0, s1, ...), and numbers per topic."""

    terms: str
    words: DataFrame
    k: int
    seed: int
    alpha: np.ndarray
    start: float = 1.0
    level: float = 0.0
    n_words: int = 0
    first: np.ndarray = field(default_factory=lambda: np.zeros(0))
    seen: DataFrame | None = None
    totals: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def columns(self) -> list[str]:
        return [f"s{t}" for t in range(self.k)]

    def _drawn(self, topic: int):
        """A gamma variable of mean 1 for each term, by the cube of a normal one that two hashes give."""
        def share(part):
            return (F.pmod(F.xxhash64(F.col("term"), F.lit(self.seed), F.lit(topic), F.lit(part)), F.lit(1 << 52)) + 0.5) / float(1 << 52)

        normal = F.sqrt(-2.0 * F.ln(share(0))) * F.cos(2 * np.pi * share(1))
        return F.pow(1 - 1 / (9 * SHAPE) + normal / (3 * np.sqrt(SHAPE)), F.lit(3.0))

    def weights(self, words: DataFrame | None = None) -> DataFrame:
        """(term, idf, l0, l1, ...): the weight in every topic of every term, or of those of ``words``, whose columns stay."""
        words = self.words if words is None else words
        rows = words if self.seen is None else words.join(self.seen, "term", "left")
        seen = [F.lit(0.0) if self.seen is None else F.coalesce(c, F.lit(0.0)) for c in self.columns()]
        return rows.select(*words.columns, *[
            (self.start * self._drawn(t) + self.level + seen[t]).alias(f"l{t}") for t in range(self.k)])

    def solved(self, docs: DataFrame, pieces: int, known: DataFrame, want: str) -> DataFrame:
        """What ``_inference`` returns for (piece, doc, id, terms) and the weights of each piece's terms."""
        run, schema = _inference(self.k, self.alpha, self.totals, self.terms, want)
        docs = docs.select("piece", "doc", "id", self.terms).repartition(pieces, "piece")
        known = known.select(F.col("piece").alias("piece"), "term", "idf", *[f"l{t}" for t in range(self.k)]).repartition(pieces, "piece")
        return docs.groupBy("piece").cogroup(known.groupBy("piece")).applyInArrow(run, schema)

    def documents(self, rows: DataFrame, want: str) -> DataFrame:
        docs, pieces = in_pieces(rows, self.terms)
        known = terms_of_pieces(docs.repartition(pieces, "piece"), self.terms, ["piece"]).join(self.weights(), "term")
        return self.solved(docs, pieces, known, want)

    def transform(self, rows: DataFrame) -> DataFrame:
        """(id, share): how much of each document is in each topic."""
        return self.documents(rows, "share")

    def describe(self, n: int) -> DataFrame:
        """(topic, topic_words, weights) of the ``n`` heaviest terms, weights as shares of the topic."""
        weights = cut(self.weights())
        out = None
        for t in range(self.k):
            top = weights.select("term", (F.col(f"l{t}") / float(self.totals[t])).alias("w")).orderBy(F.desc("w"), "term").limit(n)
            part = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("less"), "term"))).alias("e")).select(
                F.lit(t).alias("topic"), F.transform("e", lambda x: x["term"]).alias("topic_words"),
                F.transform("e", lambda x: -x["less"]).alias("weights"))
            out = part if out is None else out.unionByName(part)
        return out

    def log_perplexity(self, rows: DataFrame) -> float:
        """Variational bound of the held-out rows, negative and per unit of tf * idf."""
        k, eta, totals = self.k, 1.0 / self.k, self.totals
        bound, mass = self.documents(rows, "bound").agg(F.sum("bound"), F.sum("mass")).first()

        def topic_part(batches):
            import pyarrow as pa

            for batch in batches:
                x = np.stack([batch.column(f"l{t}").to_numpy() for t in range(k)])
                beta = digamma(x) - digamma(totals)[:, None]
                part = ((eta - x) * beta + lgamma(x) - lgamma(eta)).sum()
                yield pa.RecordBatch.from_arrays([pa.array([float(part)])], names=["x"])

        names = [f"l{t}" for t in range(k)]
        topics = self.weights().select(*names).mapInArrow(topic_part, "x double").agg(F.sum("x")).first()[0] or 0.0
        topics += float((lgamma(eta * self.n_words) - lgamma(totals)).sum())
        return -((bound or 0.0) + topics) / mass if mass else float("nan")


def _inference(k: int, alpha, totals, terms: str, want: str):
    """(function, schema): topic shares of the documents of a piece by turns of their topics and of their terms' topics.

    ``want``: the ``share`` per topic of a document, its part of the ``bound``, or the ``stats`` that a model is updated
    by: sums of each term, and the number of documents and the sums of their log shares in a row without a term.
    """
    below = digamma(totals)

    def solved(w, beta, ends):
        """(gamma, theta, norm) of documents whose different terms are ``w[ends[i]:ends[i + 1]]``; topics are rows.

        Each document stops by itself; those that have are left out once they are half of the terms.
        """
        n = len(ends) - 1
        gamma = np.ones((k, n))
        theta = np.exp(digamma(gamma) - digamma(gamma.sum(axis=0)))
        open_, entries, starts, size = np.arange(n), np.arange(len(w)), ends[:-1], np.diff(ends)
        b, v = beta, w
        norm = _norm(b, theta, size)
        moving = np.ones(n, bool)
        for _ in range(MOST_ROUNDS):
            share = v / norm
            last, at = gamma[:, open_], theta[:, open_]
            new = np.stack([t * np.add.reduceat(share * row, starts) for t, row in zip(at, b)]) + alpha[:, None]
            new = np.where(moving, new, last)
            at = np.where(moving, np.exp(digamma(new) - digamma(new.sum(axis=0))), at)
            gamma[:, open_], theta[:, open_] = new, at
            moving &= np.abs(new - last).mean(axis=0) > 1e-3
            if not moving.any():
                break
            if 2 * size[moving].sum() < len(entries):
                entries = entries[np.repeat(moving, size)]
                open_, size = open_[moving], size[moving]
                starts, moving = np.cumsum(size) - size, np.ones(len(size), bool)
                b, v, at = beta[:, entries], w[entries], theta[:, open_]
            norm = _norm(b, at, size)
        return gamma, theta, _norm(beta, theta, np.diff(ends))

    def run(docs, known):
        import pyarrow as pa
        import pyarrow.compute as pc

        known = known.sort_by("term")
        docs = docs.take(pc.sort_indices(docs.column("doc")))
        lists = docs.column(terms).combine_chunks()
        place = pc.index_in(lists.flatten(), value_set=known.column("term").combine_chunks())
        row = np.repeat(np.arange(len(docs)), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype("int64"))
        found = place.is_valid().to_numpy(zero_copy_only=False)
        width = max(1, len(known))
        pairs, tf = np.unique(row[found] * width + place.drop_null().to_numpy(), return_counts=True)
        doc, term = pairs // width, pairs % width
        w = tf * known.column("idf").to_numpy()[term]
        weights = np.stack([known.column(f"l{t}").to_numpy() for t in range(k)])
        beta = np.exp(digamma(weights) - below[:, None])[:, term]
        there, ends = np.unique(doc, return_index=True)
        ends = np.append(ends, len(doc))
        gamma, theta, norm = np.empty((k, len(there))), np.empty((k, len(there))), np.empty(len(doc))
        first = 0
        while first < len(there):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + SIDE_BY_SIDE, "right")) - 1)
            part = slice(ends[first], ends[last])
            gamma[:, first:last], theta[:, first:last], norm[part] = solved(
                w[part], np.ascontiguousarray(beta[:, part]), ends[first:last + 1] - ends[first])
            first = last
        total = gamma.sum(axis=0)
        ids = docs.column("id").combine_chunks().take(pa.array(there))
        if want == "share":
            cells = pa.ListArray.from_arrays(pa.array(np.arange(0, gamma.size + 1, k, dtype="int32")), pa.array((gamma / total).T.ravel()))
            return pa.table({"id": ids, "share": cells})
        expected = digamma(gamma) - digamma(total)
        if want == "bound":
            bound, mass = (np.add.reduceat(x, ends[:-1]) if len(there) else np.zeros(0) for x in (w * np.log(norm), w))
            bound = bound + ((alpha[:, None] - gamma) * expected + lgamma(gamma) - lgamma(alpha)[:, None]).sum(axis=0)
            return pa.table({"id": ids, "bound": bound + lgamma(alpha.sum()) - lgamma(total), "mass": mass})
        size = np.diff(ends)
        sums = [np.bincount(term, w / norm * beta[t] * np.repeat(theta[t], size), width)[:len(known)] for t in range(k)]
        names = known.column("term").combine_chunks()
        return pa.table({"term": pa.concat_arrays([names, pa.nulls(1, names.type)])} | {
            f"n{t}": np.append(sums[t], expected[t].sum()) for t in range(k)} | {
            "docs": np.append(np.zeros(len(known), "int64"), len(there))})

    schemas = {"share": "id long, share array<double>", "bound": "id long, bound double, mass double",
               "stats": "term string, " + ", ".join(f"n{t} double" for t in range(k)) + ", docs long"}
    return run, schemas[want]


def _norm(beta, theta, size):
    """Sum over the topics of the weights of each term times the share of its document."""
    out = np.full(beta.shape[1], 1e-100)
    for row, share in zip(beta, theta):
        out += row * np.repeat(share, size)
    return out


def fit(rows: DataFrame, terms: str, words: DataFrame, k: int, iterations: int, seed: int) -> Topics:
    """Model of ``k`` topics from (id, terms). Documents are drawn anew each iteration, each with the chance ``BATCH``."""
    model = Topics(terms, words, k, seed, np.full(k, 1.0 / k))
    facts = words.select(*[model._drawn(t).alias(f"g{t}") for t in range(k)]).agg(
        F.count("*"), *[F.coalesce(F.sum(f"g{t}"), F.lit(0.0)) for t in range(k)]).first()
    model.n_words, model.first = facts[0], np.array(facts[1:], "float64")
    model.totals = model.first.copy()
    eta = 1.0 / k
    # the documents of all iterations and their terms are fetched once
    drawn = [F.pmod(F.xxhash64("id", F.lit(seed), F.lit(step)), F.lit(1 << 30)) < int(BATCH * (1 << 30)) for step in range(1, iterations + 1)]
    steps = F.explode(F.filter(F.array(*[F.when(d, step + 1) for step, d in enumerate(drawn)]), lambda s: s.isNotNull()))
    docs, pieces = in_pieces(rows, terms, BATCH)
    docs = written(docs.select(steps.alias("step"), "piece", "doc", "id", terms), "step")
    asked = written(terms_of_pieces(docs, terms, ["step", "piece"]).join(words, "term"), "step")
    met = np.zeros(k)
    for step in range(1, iterations + 1):
        known = model.weights(asked.where(F.col("step") == step).drop("step"))
        new = cut(model.solved(docs.where(F.col("step") == step), pieces, known, "stats"))
        facts, sums = ([r or 0.0 for r in new.where(there).agg(F.sum("docs"), *[F.sum(f"n{t}") for t in range(k)]).first()]
                       for there in ("term IS NULL", "term IS NOT NULL"))
        if not facts[0]:
            continue
        rate = (OFFSET + step) ** -DECAY
        grown = new.where("term IS NOT NULL").select("term", *[(rate / BATCH * F.col(f"n{t}")).alias(f"s{t}") for t in range(k)])
        if model.seen is not None:
            grown = grown.unionByName(model.seen.select("term", *[((1 - rate) * F.col(c)).alias(c) for c in model.columns()]))
        model.seen = written(grown.groupBy("term").agg(*[F.sum(c).alias(c) for c in model.columns()]))
        model.start, model.level = model.start * (1 - rate), model.level * (1 - rate) + rate * eta
        met = (1 - rate) * met + rate / BATCH * np.array(sums[1:], "float64")
        model.totals = model.start * model.first + model.level * model.n_words + met
        model.alpha = _moved_alpha(model.alpha, facts[0], np.array(facts[1:], "float64") / facts[0], rate)
    return model


def _moved_alpha(alpha, n, expected, rate):
    """A Newton step of the documents' concentration towards their mean log shares."""
    if len(alpha) < 2:
        return alpha  # one topic: nothing to weigh
    slope = n * (digamma(alpha.sum()) - digamma(alpha) + expected)
    c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - rate * (slope - b) / q
    return moved if (moved > 0).all() else alpha
