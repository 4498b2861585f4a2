"""Rule files of any size against running every rule on every text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from postlens.operators import rules


@pytest.mark.parametrize("pattern, pieces", [
    ("abc", ["abc"]), ("ab?c", ["a"]), ("ab+cd", ["ab"]), ("x(ab|c)yz", ["yz"]), ("ab|cde", ["ab", "cde"]),
    ("[0-9]+", None), ("a|[bc]", None), (r"\d+ apples?", [" apple"]), (r"a\.b{2}", ["a."]), ("(?i)abc", None),
    ("[]x]yes", ["yes"]), (r"\x41bc", None), ("a{0,2}bcd", ["bcd"]), ("", None), ("(a|b)", None), (r"x\|y", ["x|y"]), ("ab*", ["a"]),
])
def test_required_pieces(pattern, pieces):
    assert rules.required(pattern) == pieces


def test_every_match_has_a_piece():
    rng = random.Random(4)
    for _ in range(3000):
        pattern = "".join(rng.choice(["a", "b", "ab", "c?", "[ab]", "(a|bc)", "|", "b*", "a+", ".", r"\.", "(ab)?", "c{2}", "[^a]"]) for _ in range(5))
        pieces = rules.required(pattern)
        text = "".join(rng.choice("abc.") for _ in range(12))
        if pieces is not None and re.search(pattern, text):
            assert any(p in m.group() for m in [re.search(pattern, text)] for p in pieces), pattern


def every_rule(texts, chosen):
    return sorted((i, label, n, m.group()) for i, t in texts if t is not None for p, label in chosen for n, m in enumerate(re.finditer(p, t)))


@pytest.mark.parametrize("chunk", [rules.CHUNK_CHARS, 300])
def test_equal_to_every_rule(spark, monkeypatch, chunk):
    monkeypatch.setattr(rules, "CHUNK_CHARS", chunk)
    rng = random.Random(2)
    words = ["moon", "to the", "hold", "stonk", "🚀", "a.b", "42"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(8))) for i in range(60)] + [(98, ""), (99, None)]
    chosen = [("moon", "m"), ("to the (moon|hold)", "t"), ("stonks?", "s"), (r"a\.b", "dot"), ("[0-9]+", "n"), ("🚀+", "r"), ("hold|stonk", "h"), ("moon", "m")]
    df = spark.createDataFrame([(i, t, 5) for i, t in texts], "id long, text string, label int")
    found = sorted(map(tuple, rules.matches(df, chosen).collect()))
    assert found == every_rule(texts, chosen)
    assert rules.matches(df, []).count() == 0


def test_twenty_thousand_rules(spark, tmp_path):
    lines = [f"word{i} [a-z]+~label{i % 7}" for i in range(20_000)]
    (tmp_path / "rules.txt").write_text("\n".join(lines) + "\n")
    table = rules.read_rules(spark, str(tmp_path / "rules.txt"))
    assert table.count() == 20_000
    texts = spark.range(3000).select("id", F.concat(F.lit("say word"), (F.col("id") * 7).cast("string"), F.lit(" abc then word19999 z")).alias("text"))
    found = {r.id: r.n for r in rules.matches(texts, table).groupBy("id").agg(F.count("*").alias("n")).collect()}
    # "word1 " is not in "word12 "
    assert found == {i: (1 if i * 7 < 20_000 else 0) + 1 for i in range(3000)}
