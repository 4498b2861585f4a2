"""Labelled patterns in rule files of any size.

A pattern names pieces of plain text of which every match contains one. An automaton over the
pieces of all rules, a trie with failure links, reads each text once and tells the few rules that
can match it; only those are run, by Spark's own regex functions. Rules without such a piece are
run on every text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from postlens.operators.tokens import rows_of

#: Characters of patterns and labels that are sent to the tasks at once; more rules take more passes.
CHUNK_CHARS = 16 << 20
_SPECIAL = set(".^$*+?{}[]|()\\")
_LITERAL_ESCAPES = set(".^$*+?{}[]|()\\/-~#&\"'`!@%=:;<>, ")


def required(pattern: str) -> list[str] | None:
    """Pieces of plain text, one of which is in every match; None if there is nothing sure.

    The pattern is cut at its top-level bars, and the longest sure piece of each alternative is
    taken. Groups and classes end a piece, as do characters that may be missing or repeated.
    """
    if "(?" in pattern or "\\Q" in pattern:
        return None
    pieces, best, piece, depth, i = [], "", "", 0, 0
    while i <= len(pattern):
        c = pattern[i] if i < len(pattern) else "|"
        plain, step = None, 1
        if c == "\\" and i + 1 < len(pattern):
            step = 2
            if pattern[i + 1] in _LITERAL_ESCAPES:
                plain = pattern[i + 1]
            elif pattern[i + 1] in "xupPkcoN0123456789" or i + 2 > len(pattern):
                return None
        elif c == "[":
            end = _class_end(pattern, i)
            if end is None:
                return None
            step = end - i
        elif c == "{":
            step = pattern.find("}", i) - i + 1
            if step <= 0:
                return None
        elif c not in _SPECIAL:
            plain = c
        after = pattern[i + step] if i + step < len(pattern) else ""
        if depth == 0 and plain is not None and after not in ("?", "*", "{"):
            piece += plain
            if after == "+":
                best, piece = max(best, piece, key=len), ""
        else:
            best, piece = max(best, piece, key=len), ""
        if c == "(" and plain is None and step == 1:
            depth += 1
        elif c == ")" and plain is None:
            depth -= 1
        elif c == "|" and plain is None and step == 1 and depth == 0:
            if not best:
                return None
            pieces.append(best)
            best = ""
        i += step
    return pieces if depth == 0 else None


def _class_end(pattern: str, i: int) -> int | None:
    """Place after a character class; None for nested ones, which are not looked into."""
    j = i + 1
    if pattern[j:j + 1] == "^":
        j += 1
    if pattern[j:j + 1] == "]":
        j += 1
    while j < len(pattern):
        if pattern[j] == "\\":
            j += 1
        elif pattern[j] == "[":
            return None
        elif pattern[j] == "]":
            return j + 1
        j += 1
    return None


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """(pattern, label) of the ``regex~label`` lines of files of any size; the label is after the last tilde."""
    lines = spark.read.text(path).where(F.col("value").contains("~"))
    return lines.select(
        F.regexp_extract("value", "^(.*)~([^~]*)$", 1).alias("pattern"), F.regexp_extract("value", "^(.*)~([^~]*)$", 2).alias("label"))


def _chunks(rules):
    """Lists of rules of bounded size."""
    chunk, size = [], 0
    for pattern, label in rules:
        chunk.append((pattern, label))
        size += len(pattern) + len(label) + 16
        if size > CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def matches(df: DataFrame, rules, key: str = "id", text: str = "text") -> DataFrame:
    """(key, label, match_no, match) of every rule in every text of (key, text).

    ``rules`` is a list of (pattern, label) or a table of them. Matches of a rule are numbered from 0
    in each text; rules with the same label are numbered each for itself. Null texts match nothing.
    """
    listed = ((r.pattern, r.label) for r in rules.toLocalIterator()) if isinstance(rules, DataFrame) else iter(rules)
    out = None
    for chunk in _chunks(listed):
        part = _candidates(df.select(key, text), chunk, key, text)
        found = F.regexp_extract_all(F.col(text), F.col("pattern"), F.lit(0))
        rows = rows_of(part.select(key, "label", found.alias("found")), "found", [key, "label"], "match_no", "match")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        schema = T.StructType([df.schema[key], T.StructField("label", T.StringType()),
                               T.StructField("match_no", T.IntegerType()), T.StructField("match", T.StringType())])
        return df.sparkSession.createDataFrame([], schema)
    return out


def _candidates(df: DataFrame, chunk: list, key: str, text: str) -> DataFrame:
    """(key, text, pattern, label): the rules of a chunk that a text has to be searched for."""
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.StringType()) for n in ("pattern", "label")]])
    shared = df.sparkSession.sparkContext.broadcast(chunk)  # at most CHUNK_CHARS and one rule more

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        rules = shared.value
        automaton, always, by_piece = ahocorasick.Automaton(), [], {}
        for n, (pattern, _) in enumerate(rules):
            pieces = required(pattern)
            if pieces is None:
                always.append(n)
            for piece in pieces or ():
                by_piece.setdefault(piece, []).append(n)
        for piece, numbers in by_piece.items():
            automaton.add_word(piece, numbers)
        if by_piece:
            automaton.make_automaton()
        for batch in batches:
            row, rule = [], []
            for i, value in enumerate(batch.column(text).to_pylist()):
                if value is None:
                    continue
                found = set(always)
                if by_piece:
                    for _, numbers in automaton.iter(value):
                        found.update(numbers)
                row += [i] * len(found)
                rule += sorted(found)
            picked = batch.take(pa.array(row, pa.int64()))
            more = [pa.array([rules[n][k] for n in rule], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*picked.columns, *more], names=[key, text, "pattern", "label"])

    return df.mapInArrow(run, schema)
