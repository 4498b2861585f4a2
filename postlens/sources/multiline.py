"""Quoted CSV with line breaks inside fields, read by many tasks per file.

Whether a line begins a record depends on the quotes before it: an even number means it does.
So the quotes of every split are counted, a running sum over the splits of a file tells how each
one begins, and then every task puts its own lines together. A record that crosses a split comes
out as fragments, at most two a split, which are joined at the end.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

HEAD, WHOLE, TAIL = 0, 1, 2
FRAGMENT = "file string, start long, crlf boolean, kind int, text string"


def lines_of(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, start, value): lines in the order of their file, with the first byte of their split.

    Only line feeds end a line, so carriage returns inside fields stay.
    """
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def openings(lines: DataFrame) -> dict[str, dict[int, tuple[bool, bool]]]:
    """For every split of every file, whether it begins inside a quoted field, and whether the
    file's lines end with a carriage return and a line feed, as its header does.

    One entry a split, which is a few bytes for each 128 MB of input.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    first = F.min_by(F.endswith("value", F.lit("\r")), "place")
    odd = lines.withColumn("place", F.monotonically_increasing_id()).groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"), first.alias("crlf"))
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = odd.select(
        "file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"), F.first("crlf").over(order).alias("crlf"))
    found = {}
    for r in inside.toLocalIterator():
        found.setdefault(r.file, {})[r.start] = r.inside, r.crlf
    return found


class Assembler:
    """Records of the lines of one task, split by split."""

    def __init__(self, inside: dict, whole: bool):
        self.inside, self.want_whole = inside, whole
        self.split, self.odd, self.begun, self.parts, self.out = None, 0, False, [], []

    def close(self):
        """End the split at hand. What is still open goes on in the next one, unless the quotes are balanced."""
        if self.parts:
            kind = HEAD if not self.begun else TAIL if self.odd else WHOLE
            self.emit(kind, "\n".join(self.parts))
        self.parts, self.begun = [], False

    def switch(self, split):
        self.close()
        inside, crlf = self.inside[split[0]][split[1]]
        self.split, self.odd = (*split, crlf), int(inside)

    def emit(self, kind, text):
        if (kind == WHOLE) == self.want_whole:
            self.out.append((*self.split, kind, text))

    def take(self, values):
        """Lines of the split at hand; returns the records that both begin and end among them."""
        import pyarrow as pa
        import pyarrow.compute as pc

        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        total = self.odd + np.cumsum(quotes)
        begins = np.flatnonzero((total - quotes) % 2 == 0)
        self.odd = int(total[-1] % 2)
        first = int(begins[0]) if len(begins) else len(values)
        self.parts += values[:first].to_pylist()
        if not len(begins):
            return None
        if self.parts:
            self.emit(WHOLE if self.begun else HEAD, "\n".join(self.parts))
        self.begun = True
        self.parts = values[int(begins[-1]):].to_pylist()
        if not self.want_whole:
            return None
        inner = values[first:int(begins[-1])].cast(pa.string())
        groups = pa.ListArray.from_arrays(pa.array(begins - first, pa.int32()), inner)
        return pc.binary_join(groups, "\n")


def _assembled(inside: dict, whole: bool):
    def run(batches):
        import pyarrow as pa

        one = Assembler(inside, whole)

        def rows(records=None):
            out, one.out = one.out, []
            columns = [[r[i] for r in out] for i in range(5)]
            if records is not None and len(records):
                split = one.split
                n = len(records)
                more = [[x] * n for x in (*split, WHOLE)] + [records.to_pylist()]
                columns = [c + m for c, m in zip(columns, more)]
            types = (pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["file", "start", "crlf", "kind", "text"])

        for batch in batches:
            if not len(batch):
                continue
            files, starts = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
            code = files.indices.to_numpy()
            cuts = np.flatnonzero((code[1:] != code[:-1]) | (starts[1:] != starts[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
                split = files.dictionary[int(code[lo])].as_py(), int(starts[lo])
                values = batch.column("value").slice(lo, hi - lo)
                if one.split is None or split != one.split[:2]:
                    one.switch(split)
                    if split[1] == 0:
                        values = values.slice(1)  # the header
                if len(values):
                    yield rows(one.take(values))
        one.close()
        yield rows()

    return run


def read_csv(
    spark: SparkSession, path: str, schema, sep: str = ",", keep_empty: bool = False, glob: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Quoted CSV with a header of one line, where quotes stand only around whole fields and are doubled inside them.

    Equal to ``readers.read_csv`` with ``multiline``, but a file is read by as many tasks as it has
    splits: once to count quotes, once for the fragments of records that cross splits, and once for
    the others. Empty lines between records are skipped. ``schema`` is a string or a type.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    lines = lines_of(spark, path, glob)
    inside = spark.sparkContext.broadcast(openings(lines))
    whole = lines.mapInArrow(_lazily(inside, True), FRAGMENT).select("crlf", "text")
    pieces = lines.mapInArrow(_lazily(inside, False), FRAGMENT)
    order = Window.partitionBy("file").orderBy("start", "kind")
    opened = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order)
    listed = F.array_sort(F.collect_list(F.struct("start", "kind", "text")))
    crossing = pieces.withColumn("record", opened).groupBy("file", "record").agg(
        F.first("crlf").alias("crlf"), F.array_join(F.transform(listed, lambda p: p["text"]), "\n").alias("text")).select("crlf", "text")
    records = whole.unionByName(crossing)
    # as in Spark's reader, line ends of the file's own kind are line feeds inside fields
    plain = F.regexp_replace(F.replace("text", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    text = F.when(F.col("crlf"), plain).otherwise(F.col("text"))
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if timestamp_format:
        options |= {"timestampNTZFormat": timestamp_format, "timestampFormat": timestamp_format}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv(text, fields, options)
    df = records.where(text != "").select(row.alias("row")).select("row.*")
    if keep_empty:
        df = df.fillna("", subset=[f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    return df


def _lazily(inside, whole: bool):
    def run(batches):
        yield from _assembled(inside.value, whole)(batches)
    return run
