"""Benchmark passages in documents, also with other numbers, names and units.

Texts become templates: lower-cased words, where a number in digits or words, a unit after a number
and a name are typed placeholders. There are three readings of a text: without names, with names inside
sentences, and with capitalised first words of sentences too, unless they are function words. Windows of templates are hash-joined between
documents and benchmark, with the values instead of the placeholders where placeholders are half of
a window or more, so that tables and sums are found as they are; matches that lie on one diagonal of (document, item) are an alignment.
It counts if its slots are consistent: equal benchmark values have equal document values and
different ones different. With ``partial``, as in the queries, an alignment that is not consistent as
a whole counts by its longest consistent run or by its verbatim windows. So a question asked with other figures is found, while a form letter
filled in another order is not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postlens.llm import words as W
from postlens.llm.frames import without_rows, written

WINDOW = 13
SHORTEST = 5
#: log2 of the bits of the filter that each task gets; its size does not depend on the data.
FILTER_BITS = 23
#: Units that count as such right after a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet mile miles meter meters metre metres kilometer "
    "kilometers mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "ml l liter liters litre litres gallon gallons cup cups percent degrees dollar dollars cent cents "
    "euro euros usd eur mph kmh hz khz mhz w kw kwh v j kj cal kcal"
).split()
#: Number words of English, German, French and Spanish, without those that mean another thing in one of them.
NUMBERS = {
    w: n for line in (
        "0 zero", "1 one", "2 two zwei deux dos", "3 three drei trois tres", "4 four vier quatre cuatro", "5 five fünf cinq cinco",
        "6 six sechs seis", "7 seven sieben siete", "8 eight acht huit ocho", "9 nine neun neuf nueve", "10 ten zehn dix diez",
        "11 eleven onze", "12 twelve zwölf douze doce", "13 thirteen dreizehn treize trece", "14 fourteen vierzehn quatorze catorce",
        "15 fifteen fünfzehn quinze quince", "16 sixteen sechzehn", "17 seventeen siebzehn", "18 eighteen achtzehn", "19 nineteen neunzehn",
        "20 twenty zwanzig vingt veinte", "30 thirty dreißig trente treinta", "40 forty vierzig quarante cuarenta",
        "50 fifty fünfzig cinquante cincuenta", "60 sixty sechzig soixante sesenta", "70 seventy siebzig setenta",
        "80 eighty achtzig ochenta", "90 ninety neunzig noventa", "100 hundred hundert cien", "1000 thousand tausend", "1000000 million")
    for n, *words in [line.split()] for w in words}
#: Words that start sentences and are no names, in the same languages.
FUNCTION_WORDS = (
    "the a an this that these those he she it we they you i his her its our their your my there here if in on at of for from to by with as "
    "and or but so not no yes then when where while what which who whose why how after before since until because although though however "
    "is are was were be do does did has have had can could would should may might must will shall each every all both some any many much "
    "more most another other one "
    "der die das den dem des ein eine einer er sie es wir ihr ich und oder aber wenn in im am auf an zu mit von für wie was wer wo nach "
    "le la les un une des du de il elle on nous vous ils elles je ce cette ces et ou mais si dans en sur pour par avec comment quand "
    "el los las una unos él ella nosotros ellos yo este esta y o pero si en con por para como cuando qué"
).split()
#: Readings of a text: names off, names inside sentences, names also at the start of sentences.
READINGS = (0, 1, 2)
_NUMBER, _UNIT, _NAME = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3))


class Templates:
    """Turns blocks of texts into canonical tokens."""

    def __init__(self):
        self.reader = W.Reader(W.byte_classes(joined=False))
        units = self.reader.read(W.strings(pa.array([" ".join(UNITS)])))
        self.units = np.sort(units.hash)
        hashes = lambda words: self.reader.read(W.strings(pa.array([" ".join(words)]))).hash
        spoken, digits = hashes(NUMBERS), hashes(NUMBERS.values())
        order = np.argsort(spoken)
        self.spoken, self.digits = spoken[order], digits[order]
        self.function = np.unique(hashes(FUNCTION_WORDS))
        self.stops = np.zeros(256, np.int64)
        self.stops[[ord(c) for c in ".!?:;\n\""]] = 1

    def read(self, column: pa.Array, reading: int, w: W.Words | None = None) -> dict[str, np.ndarray]:
        """Canonical tokens of a block: row, hash, slot (0 literal), value, start and end byte.
        Without names, they are ordinary words, for texts that are all in one case. ``w`` are the
        block's folded words, if they are there already."""
        data, _ = W.raw(column)
        w = self.reader.read(W.folded(column)) if w is None else w
        n = len(w)
        if n == 0:
            none = np.zeros(0, np.int64)
            return dict(doc=none, hash=none.astype(np.uint64), slot=none, value=none.astype(np.uint64),
                        start=none, end=none, first=np.zeros(w.rows + 1, np.int64))
        head = data[w.start]
        digit = (head >= ord("0")) & (head <= ord("9"))
        at = np.minimum(np.searchsorted(self.spoken, w.hash), len(self.spoken) - 1)
        spoken = self.spoken[at] == w.hash
        hashes = np.where(spoken, self.digits[at], w.hash)
        number = digit | spoken
        before = np.concatenate([[False], w.doc[1:] == w.doc[:-1]])
        gap = np.where(before, w.start - np.concatenate([[0], w.end[:-1]]), 99)
        between = data[np.maximum(w.start - 1, 0)]
        after = np.concatenate([[False], number[:-1]]) & before
        joined = digit & np.concatenate([[False], digit[:-1]]) & before & (gap == 1) & ((between == ord(".")) | (between == ord(",")))
        joined |= spoken & np.concatenate([[False], spoken[:-1]]) & before & (gap == 1) & ((between == ord(" ")) | (between == ord("-")))
        near = (gap == 0) | ((gap == 1) & (between == ord(" ")))
        at = np.minimum(np.searchsorted(self.units, w.hash), len(self.units) - 1)
        unit = ~number & after & near & (self.units[at] == w.hash)
        slot = np.where(number, 1, np.where(unit, 2, 0))
        drop = joined
        if reading:
            second = data[np.minimum(w.start + 1, len(data) - 1)]
            upper = (head >= ord("A")) & (head <= ord("Z")) & (second >= ord("a")) & (second <= ord("z")) | (
                (head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
            ends = np.concatenate([[0], np.cumsum(self.stops[data])])
            inner = before & (ends[w.start] == ends[np.concatenate([[0], w.end[:-1]])])
            if reading == 2:
                k = np.minimum(np.searchsorted(self.function, w.hash), len(self.function) - 1)
                inner |= self.function[k] != w.hash
            name = upper & inner & (w.end - w.start > 1) & (slot == 0)
            slot = np.where(name, 3, slot)
            more = name & np.concatenate([[False], name[:-1]]) & (gap == 1)
            drop = drop | more
        keep = np.flatnonzero(~drop)
        last = np.append(keep[1:], n) - 1
        value = hashes[keep]
        with np.errstate(over="ignore"):
            for k in np.flatnonzero(last > keep):  # numbers and names of several parts
                for j in range(keep[k] + 1, last[k] + 1):
                    value[k] = W.mix(value[k: k + 1] * np.uint64(W.MULTIPLIER) + hashes[j: j + 1])[0]
        slot = slot[keep]
        code = np.choose(slot, [value, _NUMBER, _UNIT, _NAME])
        doc = w.doc[keep]
        return dict(doc=doc, hash=code, slot=slot, value=value, start=w.start[keep], end=w.end[last],
                    first=np.searchsorted(doc, np.arange(w.rows + 1)))


def windows_of(t: dict, size: int):
    """(first token, hash) of the windows of ``size`` tokens. Those of which half or more are not
    literal are hashed with their values, so they only equal windows of the same values."""
    n = len(t["doc"])
    at = np.flatnonzero(t["first"][1:][t["doc"]] - np.arange(n) >= size) if n else np.zeros(0, np.int64)
    literal = np.concatenate([[0], np.cumsum(t["slot"] == 0)])
    valued = (literal[at + size] - literal[at]) * 2 <= size
    h = np.full(len(at), np.uint64(size))
    few = np.full(int(valued.sum()), ~np.uint64(size))
    with np.errstate(over="ignore"):
        for j in range(size):
            h = W.mix(h * np.uint64(W.MULTIPLIER) + t["hash"][at + j])
            few = W.mix(few * np.uint64(W.MULTIPLIER) + t["value"][at[valued] + j])
    h[valued] = few
    return at, h


def _slots(t, at, size):
    return [[int(v) for v in t["value"][i: i + size][t["slot"][i: i + size] > 0].view(np.int64)] for i in at]


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - FILTER_BITS)
    return h >> shift, W.mix(h) >> shift


_HITS = "row bigint, reading int, pos bigint, hash bigint, slots array<bigint>, start bigint, end bigint"


def _finder(sizes: list[int], field: np.ndarray | None, key: str, window: int):
    """Windows of each text; with ``field``, those whose two bits are set."""
    def run(batches):
        templates = Templates()
        for batch in batches:
            texts = W.strings(batch.column("text"))
            ids, rows = batch.column(key), batch.column("row")
            for lo, hi in W.blocks(texts):
                part = texts.slice(lo, hi - lo)
                data, offsets = W.raw(part)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                words = templates.reader.read(W.folded(part))
                for reading in READINGS:
                    t = templates.read(part, reading, words)
                    total = np.diff(t["first"])
                    for size in sizes:
                        at, h = windows_of(t, size)
                        if field is not None:
                            a, b = _bits(h)
                            hit = (field[a >> np.uint64(6)] >> (a & np.uint64(63))) & np.uint64(1) & (
                                field[b >> np.uint64(6)] >> (b & np.uint64(63)))
                            at, h = at[hit > 0], h[hit > 0]
                        elif size < window:  # a shorter benchmark item is one window of all its tokens
                            whole = total[t["doc"][at]] == size
                            at, h = at[whole], h[whole]
                        if not len(at):
                            continue
                        doc = t["doc"][at]
                        base = points[offsets[:-1]][doc]
                        take = pa.array(lo + doc)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(take), rows.take(take), pa.array(np.full(len(at), reading, np.int32)),
                             pa.array(at - t["first"][doc]), pa.array(h.view(np.int64)),
                             pa.array(_slots(t, at, size), pa.list_(pa.int64())),
                             pa.array(points[t["start"][at]] - base), pa.array(points[t["end"][at + size - 1]] - base)],
                            names=[key, "row", "reading", "pos", "hash", "slots", "start", "end"])
    return run


def _windows(df: DataFrame, key: str, sizes: list[int], window: int, field=None) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    return df.select(key, "text", F.xxhash64(key, "text").alias("row")).mapInArrow(
        _finder(sizes, field, key, window), f"{key} {kind}, {_HITS}")


def _field(windows: DataFrame) -> np.ndarray:
    """Bit field of the benchmark's windows: at most 2**(FILTER_BITS - 6) words, however many windows."""
    def positions(batches):
        for batch in batches:
            for p in _bits(np.asarray(batch.column("hash")).view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64))], names=["p"])
    bit = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(p & 63 AS INT))")
    words = windows.select("hash").mapInArrow(positions, "p bigint").groupBy(
        F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    field = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    field[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return field


def consistent(pairs) -> bool:
    """Whether (benchmark value, document value) pairs are one to one."""
    pairs = set(pairs)
    return len({b for b, _ in pairs}) == len(pairs) == len({d for _, d in pairs})


def best_run(windows: list, partial: bool):
    """(first, last, count, exact) of what counts of the windows of one diagonal, given as lists of
    pairs in the order of the item, or None: all of them if consistent; else, with ``partial``, the
    longest consistent run, or the windows of equal values if they are as many."""
    equal = [all(b == d for b, d in w) for w in windows]
    if consistent(p for w in windows for p in w):
        return 0, len(windows) - 1, len(windows), all(equal)
    if not partial:
        return None
    best, lo, count, there, back = (0, False, 0, 0), 0, {}, {}, {}
    for hi, pairs in enumerate(windows):
        while lo < hi and any(there.get(b, d) != d or back.get(d, b) != b for b, d in pairs):
            for pair in set(windows[lo]):
                count[pair] -= 1
                if not count[pair]:
                    del count[pair], there[pair[0]], back[pair[1]]
            lo += 1
        if not consistent(pairs):  # a window that clashes with itself is in no run
            for pair in list(count):
                del count[pair], there[pair[0]], back[pair[1]]
            lo = hi + 1
            continue
        for b, d in set(pairs):
            count[b, d] = count.get((b, d), 0) + 1
            there[b], back[d] = d, b
        best = max(best, (hi + 1 - lo, all(b == d for b, d in count), -lo, hi))
    same = [i for i, e in enumerate(equal) if e]
    if same and (len(same), True) >= best[:2]:
        return same[0], same[-1], len(same), True
    return (-best[2], best[3], best[0], best[1]) if best[0] else None


_RUNS = "windows bigint, exact boolean, start bigint, end bigint"


def _judge(partial: bool, names: list[str]):
    """What counts of each diagonal."""
    def run(batches):
        for batch in batches:
            take, out = [], []
            for i, met in enumerate(batch.column("met").to_pylist()):
                got = best_run([list(zip(m["item_slots"], m["slots"])) for m in met], partial)
                if got:
                    first, last, count, exact = got
                    take.append(i)
                    out.append((count, exact, met[first]["start"], met[last]["end"]))
            if take:
                at = pa.array(take)
                columns = list(zip(*out))
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n).take(at) for n in names] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=[*names, "windows", "exact", "start", "end"])
    return run


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, partial: bool = False) -> DataFrame:
    """(doc_id, row, item_id, windows, coverage, exact, start, end) of contaminated documents.

    One row per document text and benchmark item with a consistent alignment of at least one
    window: that with the most windows, then the first. Without ``partial`` an alignment has to be
    consistent as a whole; with it, its best consistent run counts. ``coverage`` is the share of the item's
    windows, ``exact`` says that all its slots have the benchmark's values, ``start`` and
    ``end`` are code points. ``row`` is the hash of id and text.

    Null and empty texts match nothing, on either side. Items of 5 tokens up to ``window`` are one window;
    shorter items are not searched for, since a few words are no evidence. Items with the same
    windows in all places count as one, under the smallest item_id. Repeated rows of ``docs``
    give one result row. Empty tables give an empty result; other columns are not read.
    """
    sizes = list(range(min(SHORTEST, window), window + 1))
    found = _windows(benchmark, "item_id", sizes, window)
    items = found.groupBy("item_id", "row").agg(
        F.array([F.count_if(F.col("reading") == r) for r in READINGS]).alias("n"),
        F.sum(F.xxhash64("reading", "pos", "hash", "slots").cast("decimal(38,0)")).alias("print"))
    items = items.groupBy("print", "n").agg(F.min(F.struct("item_id", "row")).alias("item")).select("item.*", "n")
    known = written(found.join(items, ["item_id", "row"]).drop("row").withColumnsRenamed(
        {"pos": "item_pos", "slots": "item_slots"}).drop("start", "end"))
    used = sorted(r["s"] for r in _sizes(known, benchmark, window).collect())
    hits = _windows(docs, "doc_id", used, window, _field(known))
    met = hits.join(known.dropDuplicates(["item_id", "reading", "item_pos", "hash"]), ["hash", "reading"])
    place = ["doc_id", "row", "item_id", "reading", F.col("pos") - F.col("item_pos")]
    runs = met.groupBy(*place[:-1], place[-1].alias("diagonal")).agg(
        F.max(F.col("n")[F.col("reading")]).alias("n"), F.array_sort(F.collect_set(F.struct("item_pos", "start", "end", "item_slots", "slots"))).alias("met"))
    names = ["doc_id", "row", "item_id", "n"]
    kinds = ", ".join(f"{n} {runs.schema[n].dataType.simpleString()}" for n in names)
    runs = runs.select(*names, "met").mapInArrow(_judge(partial, names), f"{kinds}, {_RUNS}")
    best = F.max(F.struct("windows", "exact", (-F.col("start")).alias("back"), "n", "end")).alias("best")
    return runs.groupBy("doc_id", "row", "item_id").agg(best).select(
        "doc_id", "row", "item_id", F.col("best.windows").alias("windows"),
        F.least(F.lit(1.0), F.col("best.windows") / F.greatest(F.lit(1), F.col("best.n"))).alias("coverage"), F.col("best.exact").alias("exact"),
        (-F.col("best.back")).alias("start"), F.col("best.end").alias("end"))


def _sizes(known: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """Window sizes that occur in the benchmark: at most ``window`` rows."""
    def run(batches):
        templates = Templates()
        for batch in batches:
            texts = W.strings(batch.column("text"))
            for lo, hi in W.blocks(texts):
                sizes = {min(int(n), window) for reading in READINGS
                         for n in np.diff(templates.read(texts.slice(lo, hi - lo), reading)["first"]) if n >= min(SHORTEST, window)}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(sizes), pa.int64())], names=["s"])
    return benchmark.select("text").mapInArrow(run, "s bigint").distinct()


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, partial: bool = False) -> DataFrame:
    """``docs`` without the rows that ``matches`` finds; all columns are kept."""
    gone = written(matches(docs, benchmark, window, partial).select("row").distinct())
    return without_rows(docs, gone, gone.count())
