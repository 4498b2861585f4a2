"""Conversation repair against exhaustive search in plain Python, and its odd inputs."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from postlens.llm import conversations as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, copy string, digest string, audit int"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        what = zlib.crc32(name.encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        role = "user" if what == 4 else role
        out += [(conv, turn, role, text)] * (2 if what == 3 else 1)
    digest = lambda text: hashlib.sha256(text.encode()).digest()
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r[3])))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        if not re.search("[^\x20\x09-\x0d]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """(cost, audit, repaired) over all edits, with up to two insertions between rows."""
    @lru_cache(None)
    def best(i, made, inserted):
        options = []
        if i == len(rows) and GRAMMAR.fullmatch(made):
            options.append((0, "", ()))
        turns = [(r, name) for r, name in (("u", "user"), ("a", "assistant")) if viable(made + r)]
        if inserted < 2:
            for r, name in turns:
                cost, audit, edits = best(i, made + r, inserted + 1)
                options.append((5 + cost, "I" + audit, ((name, ""), *edits)))
        if i < len(rows):
            _, _, role, text = rows[i]
            extra = 5 if marks[i] == "truncated" else 0
            cost, audit, edits = best(i + 1, made, 0)
            options.append((2 + cost, "D" + audit, edits))
            if marks[i] in ("", "truncated"):
                if viable(made + (role[:1] or "-")):
                    cost, audit, edits = best(i + 1, made + role[:1], 0)
                    options.append((extra + cost, "K" + audit, ((role, text), *edits)))
                for r, name in turns:
                    cost, audit, edits = best(i + 1, made + r, 0)
                    options.append((1 + extra + cost, "R" + audit, ((name, text), *edits)))
        return min(options, default=(10**6, "", ()))

    return best(0, "", 0)


def viable(made):
    return any(GRAMMAR.fullmatch(made + rest) for rest in ("", "a", "ua"))


def expected(rows):
    found = []
    for conv in {r[0] for r in rows}:
        mine = damaged([r for r in rows if r[0] == conv])
        marks = faults(mine)
        cost, audit, repaired = cheapest(mine, marks)
        turns = [r[1] for r in mine if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        text = "\n".join(f"{role}:{text}" for role, text in repaired)
        found.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"),
            marks.count("duplicate"), marks.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, found))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "c", "d", 1) for r in rows], SCHEMA)


def check(spark, rows):
    found = C.repair(frame(spark, rows)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert sorted(str(tuple(r)) for r in found.collect()) == expected(rows)


def test_random_conversations(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(400):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut off", "  \t", "", None, "Why?\n", "é…", f"{rng.random()}."])
            rows.append((conv, turn + (turn > 2), role, text))
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "Hi."), (None, None, "assistant", "Hello."), (1, None, None, None), (1, None, "user", "A."),
        (1, 4, "user", "B."), (1, 4, "assistant", "C."), (1, 4, "assistant", "C."), (2, 0, "system", "S."),
        (3, 2, "user", "word " * 200_000 + "."), (3, 3, "assistant", "x" * 1_000_000), (4, 5, "user", " \x0b\x0c."),
    ]
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    check(spark, rows + [(dropped, 0, "user", "Gone.")])


def test_empty(spark):
    assert C.repair(frame(spark, [])).count() == 0


def test_shared_endings_are_worked_out_once():
    rng = random.Random(3)
    words = sorted("".join(rng.choice("AEIBFJDHL") for _ in range(rng.randint(0, 9))) for _ in range(2000))
    endings = C.Endings()
    found = {w: endings.repair(w) for w in words}
    assert endings.nodes == len({w[:k] for w in words for k in range(1, len(w) + 1)})
    assert all(C.Endings().repair(w) == found[w] for w in words[::17])
    assert len(endings.shapes) < 60


def test_one_very_long_conversation(spark):
    """A hundred thousand turns of one conversation: placed in several tasks, repaired as a whole."""
    n = 100_000
    rows = spark.range(n).select(
        F.lit(7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("turn "), F.col("id").cast("string"), F.lit(".")).alias("text"))
    plain = [(7, i, "assistant" if i % 2 else "user", f"turn {i}.") for i in range(n)]
    mine = damaged(plain)
    marks = faults(mine)
    letters = "".join(C.LETTERS["sua".index(r[2][0]) * 4 + ["", "truncated", "duplicate", "blank"].index(m)] for r, m in zip(mine, marks))
    found = C.repair(rows).collect()[0]
    assert (found.cost, found.audit) == C.Endings().repair(letters[::-1])
    assert (found.blank, found.duplicate) == (marks.count("blank"), marks.count("duplicate"))


@pytest.mark.parametrize("a, b, n", [("", "x", 0), ("abc", "abc", 3), ("abcd", "abxd", 2), ("a" * 5000 + "b", "a" * 5000 + "c", 5000)])
def test_common_beginning(a, b, n):
    assert C.common(a, b) == n
