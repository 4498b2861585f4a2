"""Topics of the documents of a piece, solved side by side, against one document after the other."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators import models, topics


def one_by_one(w, beta, alpha):
    """(gamma, theta, norm) of a single document."""
    gamma = np.ones(len(alpha))
    theta = np.exp(topics.digamma(gamma) - topics.digamma(gamma.sum()))
    norm = beta @ theta + 1e-100
    for _ in range(topics.MOST_ROUNDS):
        last = gamma
        gamma = theta * ((w / norm) @ beta) + alpha
        theta = np.exp(topics.digamma(gamma) - topics.digamma(gamma.sum()))
        norm = beta @ theta + 1e-100
        if np.abs(gamma - last).mean() <= 1e-3:
            break
    return gamma, theta, norm


@pytest.mark.parametrize("side_by_side", [1, 25, 32_000])
def test_documents_side_by_side_equal_single_ones(monkeypatch, side_by_side):
    import pyarrow as pa

    monkeypatch.setattr(topics, "SIDE_BY_SIDE", side_by_side)
    rnd, k, names = np.random.default_rng(1), 3, [f"w{i}" for i in range(40)]
    lists = [[names[i] for i in rnd.integers(40, size=n)] + ["unknown"] * (n % 2) for n in (1, 7, 0, 30, 80, 3, 12, 1)]
    alpha, totals, idf = np.array([0.2, 0.5, 0.3]), np.array([30.0, 50.0, 41.0]), rnd.random(40)
    weights = rnd.gamma(2, 1, (k, 40)) + 0.1
    docs = pa.table({"piece": [0] * 8, "doc": list(range(8)), "id": [9] * 8, "t": lists})
    known = pa.table({"term": names, "idf": idf} | {f"l{t}": weights[t] for t in range(k)})
    beta = np.exp(topics.digamma(weights) - topics.digamma(totals)[:, None]).T
    shares, bounds, sums, logs = [], [], np.zeros((k, 40)), np.zeros(k)
    for terms in lists:
        at, tf = np.unique([names.index(x) for x in terms if x != "unknown"], return_counts=True)
        if len(at):
            at = at.astype(int)
            w = tf * idf[at]
            gamma, theta, norm = one_by_one(w, beta[at], alpha)
            shares.append(gamma / gamma.sum())
            expected = topics.digamma(gamma) - topics.digamma(gamma.sum())
            bounds.append(((w * np.log(norm)).sum() + ((alpha - gamma) * expected + topics.lgamma(gamma) - topics.lgamma(alpha)).sum()
                           + topics.lgamma(alpha.sum()) - topics.lgamma(gamma.sum()), w.sum()))
            sums[:, at] += ((w / norm)[:, None] * beta[at] * theta).T
            logs += expected
    found = {want: topics._inference(k, alpha, totals, "t", want)[0](docs, known) for want in ("share", "bound", "stats")}
    assert np.allclose(found["share"].column("share").to_pylist(), shares, atol=1e-9)
    assert np.allclose(list(zip(found["bound"].column("bound").to_numpy(), found["bound"].column("mass").to_numpy())), bounds)
    stats = {r["term"]: r for r in found["stats"].to_pylist()}
    assert np.allclose([[stats[n][f"n{t}"] for n in names] for t in range(k)], sums)
    assert stats[None]["docs"] == len(shares) and np.allclose([stats[None][f"n{t}"] for t in range(k)], logs)


def test_pieces_are_bounded_and_do_not_matter(spark, monkeypatch):
    """More documents make more pieces, and a piece asks for a term once, whatever its documents have in common."""
    docs = [(i, [f"a{(i + j) % 5}" for j in range(3 + i % 4)] + [f"b{i % 7}"] * 2) for i in range(300)] + [(300, [None])]
    df = spark.createDataFrame(docs, "id long, t array<string>")

    def shares():
        _, model, rows = models.topics(df, "t", k=2, iterations=3)
        return {r.id: np.round(r.share, 9).tolist() for r in model.transform(rows).collect()}, rows

    whole, rows = shares()
    _, few = topics.in_pieces(rows, "t")
    monkeypatch.setattr(topics, "PIECE_TERMS", 20)
    dealt, many = topics.in_pieces(rows, "t")
    largest = dealt.groupBy("piece").agg(F.sum(F.size("t")).alias("n")).agg(F.max("n")).first()[0]
    asked = topics.terms_of_pieces(dealt, "t", ["piece"]).groupBy("piece", "term").count().agg(F.max("count")).first()[0]
    assert many > few and largest <= 5 * 20 and asked == 1
    assert shares()[0] == whole and len(whole) == 300
