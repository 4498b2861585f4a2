"""Secrets in texts: patterns, and a likelihood ratio of two character models. SQL functions only.

Base spans are assignments, access keys and hex runs. Their values are the labelled samples of
random strings, long words of letters those of ordinary identifiers. Both train a Markov model
over neighbouring characters; a long token outside the base spans is one more span if its
log-likelihood ratio is above a margin.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from postlens.llm.frames import written

#: Patterns and least lengths. A run that is too short for ``access`` or ``hex`` has no
#: part that is long enough, so their least length is in the pattern.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
#: Tokens that the models judge, and words that are samples of ordinary identifiers.
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = "[A-Za-z]{12,}"
#: Log-likelihood ratio, in nats, that a token has to exceed.
MARGIN = 12.0
SMOOTHING = 0.5
#: Weight of a character's own frequency in its probability after another one.
BACKOFF = 8.0
_LOW, _RANGE = ord("+"), ord("z") - ord("+") + 1
_ALPHABET = 66

_SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


def _spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Matches of ``pattern`` from left to right with their places in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    pieces = F.split(text, pattern, -1)
    lengths = F.transform(F.arrays_zip(matches.alias("m"), values.alias("v"), F.slice(pieces, 1, F.size(matches)).alias("p")),
                          lambda x: x)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).cast(_SPAN).alias("found"))
    found = F.aggregate(lengths, start, step, lambda acc: acc["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _steps(value: Column) -> Column:
    """Codes of neighbouring characters, for strings of the token alphabet."""
    codes = F.transform(F.slice(F.split(value, ""), 1, F.length(value)), lambda c: F.ascii(c) - _LOW)
    pairs = F.arrays_zip(F.slice(codes, 1, F.length(value) - 1).alias("a"), F.slice(codes, 2, F.length(value)).alias("b"))
    return F.transform(pairs, lambda p: p["a"] * _RANGE + p["b"])


def _clean(value: Column) -> Column:
    """The value without characters outside the token alphabet."""
    return F.regexp_replace(value, "[^A-Za-z0-9+/_=-]", "")


def train(random: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log-likelihood ratio of each step between characters, from samples (value) of both kinds.

    Steps are counted on the cluster; at most one count per kind and pair of characters comes back.
    Without samples of a kind its model is uniform.
    """
    both = random.select(_clean(F.col("value")).alias("value"), F.lit(1).alias("kind")).union(
        ordinary.select(_clean(F.col("value")), F.lit(0)))
    steps = both.where(F.length("value") > 1).select("kind", F.explode(_steps(F.col("value"))).alias("step"))
    counts = {(r["kind"], r["step"]): r["n"] for r in steps.groupBy("kind", "step").agg(F.count("*").alias("n")).collect()}
    before: dict[tuple[int, int], int] = {}
    after: dict[tuple[int, int], int] = {}
    total = {0: 0, 1: 0}
    for (kind, step), n in counts.items():
        first, second = divmod(step, _RANGE)
        before[kind, first] = before.get((kind, first), 0) + n
        after[kind, second] = after.get((kind, second), 0) + n
        total[kind] += n

    def log_p(kind, step):
        first, second = divmod(step, _RANGE)
        share = (after.get((kind, second), 0) + SMOOTHING) / (total[kind] + SMOOTHING * _ALPHABET)
        return math.log((counts.get((kind, step), 0) + BACKOFF * share) / (before.get((kind, first), 0) + BACKOFF))
    return [log_p(1, s) - log_p(0, s) for s in range(_RANGE * _RANGE)]


def ratio(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token under the two models."""
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    return F.aggregate(_steps(value), F.lit(0.0), lambda total, s: total + F.get(table, s))


def base(docs: DataFrame) -> DataFrame:
    """(doc_id, base, tokens): base spans by place, and tokens that overlap none of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(_spans(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    found = docs.select("doc_id", F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2)).alias("base"),
                        _spans(text, TOKEN, 3).alias("tokens"))
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return found.select("doc_id", "base", free.alias("tokens"))


def scan(docs: DataFrame, random: DataFrame | None = None, ordinary: DataFrame | None = None,
         margin: float = MARGIN) -> DataFrame:
    """(doc_id, base, extra): arrays of spans (kind, start, end, value) of each row, by start and kind.

    ``random`` and ``ordinary`` (value) are the labelled samples; by default the values of all
    base spans and all long words of ``docs``. Null is the empty text, which has no spans. Spans of
    different kinds may overlap; extra ones overlap no base span. Repeated rows are scanned each
    time; an empty table gives an empty one. Other columns are not read.
    """
    found = written(base(docs))
    if random is None:
        random = found.select(F.explode("base.value").alias("value"))
    if ordinary is None:
        long_words = F.regexp_extract_all(F.col("text"), F.lit(IDENTIFIER), F.lit(0))
        ordinary = docs.select(F.explode(long_words).alias("value"))
    model = train(random, ordinary)
    order = lambda spans: F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))))
    extra = F.filter("tokens", lambda t: ratio(t["value"], model) > margin)
    return found.select("doc_id", order(F.col("base")).alias("base"), order(extra).alias("extra"))


def digest(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
