"""Token ids in files of directly addressable codes.

The ids of a segment are cut into chunks of eight bits. Level 0 holds the low chunk of every id;
a bitmap says whether the id goes on, and the next level holds the next chunk of those that do.
A directory of the number of set bits before every 512th bit gives the place in the next level,
so the id at any position is read from one chunk per level, without decoding its neighbours.
Files are Parquet, uncompressed, one row per segment of whole documents.
"""

from __future__ import annotations

import sys
import types
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from postlens.llm import words as W
from postlens.session import shared_dir

END_ID = 1
#: Tokens after which a segment is closed; a longer document is a segment of its own.
SEGMENT_TOKENS = 1 << 17
ROW_GROUP_BYTES = 16 << 20
#: Words whose ids a task remembers, at most; beyond that it starts to remember anew.
REMEMBERED = 800_000
#: Bytes of texts that are encoded at once, which take about a hundred times as much memory.
BLOCK_BYTES = 1 << 18
RANK_BITS = 512


class Codes:
    """Directly addressable codes of one array of unsigned integers."""

    def __init__(self, levels: list[bytes], marks: list[bytes], ranks: list[bytes]):
        self.levels = [np.frombuffer(x, np.uint8) for x in levels]
        self.marks = [np.frombuffer(x, np.uint8) for x in marks]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    @staticmethod
    def parts(values: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
        levels, marks, ranks = [], [], []
        rest = values.astype(np.uint64)
        while True:
            levels.append((rest & np.uint64(0xFF)).astype(np.uint8).tobytes())
            more = rest > 0xFF
            marks.append(np.packbits(more, bitorder="little").tobytes())
            block = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64) if len(more) else []
            ranks.append(np.concatenate([[0], np.cumsum(block)[:-1]]).astype("<u4").tobytes() if len(more) else b"")
            rest = rest[more] >> np.uint64(8)
            if not len(rest):
                return levels, marks, ranks

    def __getitem__(self, at) -> np.ndarray:
        """The integers at the positions ``at``, in any order."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        out = np.zeros(len(at), np.uint64)
        going = np.arange(len(at))
        for k, level in enumerate(self.levels):
            out[going] |= level[at].astype(np.uint64) << np.uint64(8 * k)
            bit = (self.marks[k][at >> 3] >> (at & 7).astype(np.uint8)) & 1
            going, at = going[bit > 0], at[bit > 0]
            if not len(going):
                break
            at = self.rank(k, at)
        return out

    def rank(self, k: int, at: np.ndarray) -> np.ndarray:
        """Set bits of level ``k`` before each position: the directory, then at most 63 bytes."""
        block = at // RANK_BITS
        first = block * (RANK_BITS // 8)
        bytes_before = (at >> 3) - first
        window = first[:, None] + np.arange(RANK_BITS // 8)
        inside = np.arange(RANK_BITS // 8) < bytes_before[:, None]
        ones = _ONES[self.marks[k][np.minimum(window, len(self.marks[k]) - 1)]]
        tail = self.marks[k][at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)
        return self.ranks[k][block].astype(np.int64) + (ones * inside).sum(axis=1) + _ONES[tail]

    def all(self) -> np.ndarray:
        """Every integer in order; the levels are read once, front to back."""
        out = self.levels[0].astype(np.uint64)
        at = np.arange(len(out))
        for k in range(1, len(self.levels)):
            bits = np.unpackbits(self.marks[k - 1], count=len(at), bitorder="little")
            at = at[bits > 0]
            out[at] |= self.levels[k].astype(np.uint64) << np.uint64(8 * k)
        return out


_ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    """The values with room for ``size``; memory that is not used yet is not touched."""
    out = np.zeros(size, values.dtype)
    out[:len(values)] = values
    return out


#: A text that only a vocabulary of the known splitting and folding encodes as the encoder does.
PROBE = "Ab cD1,22-x_y  \u00c9\u00e9 don't (Z)\n\t9th; \u0130x. A\u0301"


class Encoder:
    """Ids of a ``tokenizers`` vocabulary that splits at white space, per distinct word.

    A text's ids are those of its pieces between white space. A piece of plain letters, digits
    and symbols is cut further, as the vocabulary's own splitting does; pieces with other
    characters go to the library whole. A vocabulary that splits or folds otherwise is refused.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        classes = np.full(256, W.SYMBOL, np.uint8)
        classes[[9, 10, 11, 12, 13, 32]] = 0
        for a, b in ((65, 90), (97, 122)):
            classes[a: b + 1] = W.LETTER
        classes[48:58] = W.DIGIT
        classes[0x80:] = W.LETTER
        self.reader = W.Reader(classes)
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        # two-byte characters that stay one letter when the library normalises them, by lead and last byte
        self.letters = np.zeros((256, 256), bool)
        for point in range(0xC0, 0x280):
            lead, last = chr(point).encode()
            self.letters[lead, last] = self._stays_letter(chr(point))
        self.forget()
        probe = W.strings(pa.array([PROBE]))
        if self.encode(probe)[0].tolist() != self.tokenizer.encode(PROBE, add_special_tokens=False).ids:
            raise ValueError(f"{path} does not split texts at white space, digits and symbols, or folds them otherwise")
        self.forget()

    def _stays_letter(self, character: str) -> bool:
        """False for such as the capital I with a dot, which becomes two characters of different kinds."""
        low = self.tokenizer.normalizer.normalize_str(character) if self.tokenizer.normalizer else character
        return len(low) == 1 and low.isalpha()

    def forget(self):
        # hashes of the known words in order, and the place of each in ``begin``
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 16, np.int64)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``known``, whether it is there) of each hash."""
        at = np.searchsorted(self.known, hashes)
        there = np.zeros(len(hashes), bool)
        inside = at < len(self.known)
        there[inside] = self.known[at[inside]] == hashes[inside]
        return at, there

    def _learn(self, new: list[tuple[int, str, bool]]):
        """Encode new words: plain ones all at once, since each is one piece with one end."""
        hashes, ids, lengths = [], [], []
        rest, odd = [x for x in new if not x[2]], [x for x in new if x[2]]
        if rest:
            found = self.tokenizer.encode(" ".join(x[1] for x in rest), add_special_tokens=False).ids
            stop = np.flatnonzero(self.ends[found]) + 1
            if len(stop) == len(rest) and stop[-1] == len(found):
                hashes += [x[0] for x in rest]
                ids += found
                lengths += np.diff(np.concatenate([[0], stop])).tolist()
            else:
                odd += rest
        for x, e in zip(odd, self.tokenizer.encode_batch([x[1] for x in odd], add_special_tokens=False) if odd else []):
            hashes.append(x[0])
            ids += e.ids
            lengths.append(len(e.ids))
        n, used = len(self.known), int(self.begin[len(self.known)])
        if n + len(hashes) + 1 > len(self.begin):
            self.begin = _grown(self.begin, 3 * (n + len(hashes) + 1) // 2)
        if used + len(ids) > len(self.ids):
            self.ids = _grown(self.ids, 3 * (used + len(ids)) // 2)
        self.ids[used: used + len(ids)] = ids
        self.begin[n + 1: n + 1 + len(hashes)] = used + np.cumsum(lengths)
        hashes = np.array(hashes, np.uint64)
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, at, hashes[order])
        self.place = np.insert(self.place, at, n + order)

    def _pieces(self, column: pa.Array):
        """(start, end, odd, hash, row) of the pieces that are looked up."""
        data, offsets = W.raw(column)
        n = len(data)
        kind = self.reader.classes[data]
        lead = (data >= 0xC3) & (data <= 0xC9)
        prior = np.concatenate([np.zeros(1, np.uint8), data[:-1]])
        tail = self.letters[prior, data]
        strange = ((data >= 0x80) & ~lead & ~tail) | (lead & ~np.concatenate([tail[1:], [False]])) | (data == 39) | (data == 60)
        blank = kind == 0
        edge = np.ones(n + 1, bool)
        edge[1:n] = blank[1:] != blank[:-1]
        edge[offsets] = True
        start = np.flatnonzero(edge[:n] & ~blank)
        end = np.flatnonzero(edge[1:] & ~blank) + 1
        total = np.concatenate([[0], np.cumsum(strange)])
        odd = total[end] > total[start]
        whole = np.zeros(n + 1, np.int8)
        whole[start[odd]] += 1
        whole[end[odd]] -= 1
        whole = np.cumsum(whole[:n]) > 0
        edge[1:n] |= (kind[1:] != kind[:-1]) & ~(whole[1:] & whole[:-1])
        edge[:n] |= (kind == W.DIGIT) & ~whole
        # a digit stands alone, also at its end; inside an odd piece only its outer edges count
        start = np.flatnonzero(edge[:n] & ~blank)
        end = np.flatnonzero(edge[1:] & ~blank) + 1
        text = np.where(whole, data, self.lower[data])
        hashes = self.reader.hashes(text.astype(np.uint64) + np.uint64(1), start, end)
        hashes = np.where(whole[start], W.mix(hashes ^ np.uint64(1)), hashes)
        return text, start, end, whole[start], hashes, np.searchsorted(offsets, start, "right") - 1

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, number of ids per row)."""
        text, start, end, odd, hashes, doc = self._pieces(column)
        if len(self.known) > REMEMBERED:
            self.forget()
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at, there = self._find(unique)
        if not there.all():
            self._learn([(int(unique[u]), text[start[first[u]]: end[first[u]]].tobytes().decode(), bool(odd[first[u]]))
                         for u in np.flatnonzero(~there)])
            at, _ = self._find(unique)
        place = self.place[at].astype(np.int64)
        begin, n = self.begin[place], self.begin[place + 1] - self.begin[place]
        begin, n = begin[inverse], n[inverse]
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.ids[at], np.bincount(doc, n, len(column)).astype(np.int64)


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, which keeps what it remembers from task to task."""
    memory = sys.modules.setdefault("postlens_worker_memory", types.ModuleType("postlens_worker_memory"))
    found = getattr(memory, "encoders", None)
    if found is None:
        found = memory.encoders = {}
    if path not in found:
        found[path] = Encoder(path)
    return found[path]


def text_blocks(batches):
    """(batch, first row, row after the last, texts) of blocks of rows; a large batch is not copied whole."""
    for batch in batches:
        for first in range(0, batch.num_rows, W.BLOCK_ROWS):
            texts = W.strings(batch.column("text").slice(first, W.BLOCK_ROWS))
            for lo, hi in W.blocks(texts, BLOCK_BYTES):
                yield batch, first + lo, first + hi, texts.slice(lo, hi - lo)


def _segments(path: str, end_id: int, size: int):
    def run(batches):
        coder = encoder(path)
        shard, part = TaskContext.get().partitionId(), 0
        ids, lengths, names = [], [], []

        def segment():
            values = np.concatenate(ids)
            levels, marks, ranks = Codes.parts(values)
            starts = np.cumsum(lengths) - lengths
            doc_ids = pa.concat_arrays(names)
            lists = lambda x, kind: pa.array([x], pa.list_(kind))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([part], pa.int64()), pa.array([len(values)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                 lists(starts, pa.int64()), lists(levels, pa.binary()), lists(marks, pa.binary()), lists(ranks, pa.binary())],
                names=["shard", "part", "n_tokens", "doc_ids", "starts", "levels", "marks", "ranks"])

        for batch, lo, hi, texts in text_blocks(batches):
            flat, count = coder.encode(texts)
            ends = np.cumsum(count)
            flat = np.insert(flat, ends, end_id)
            count = count + 1
            ends = np.cumsum(count)
            at = 0
            while at < hi - lo:
                base = ends[at] - count[at]
                room = max(0, size - sum(len(x) for x in ids))
                upto = max(int(np.searchsorted(ends, base + room, "right")), at + (not ids))
                if upto > at:
                    ids.append(flat[base: ends[upto - 1]])
                    lengths.extend(count[at:upto].tolist())
                    names.append(batch.column("doc_id").slice(lo + at, upto - at))
                    at = upto
                if at < hi - lo:
                    yield segment()
                    part += 1
                    ids, lengths, names = [], [], []
        if ids:
            yield segment()
    return run


def write(docs: DataFrame, vocabulary: str, folder: str | None = None, end_id: int = END_ID,
          ordered: bool = True, size: int = SEGMENT_TOKENS) -> str:
    """Write the ids of ``docs`` (doc_id, text) and return the folder.

    ``ordered`` sorts by doc_id, and by a hash of the text among equal ids; else rows stay in the
    order of their partitions. Null counts as the empty text, which has the end id alone. A
    null doc_id comes first. Repeated rows are written each time. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    rows = docs.select("doc_id", "text")
    if ordered:
        parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        tie = F.xxhash64("text")
        rows = rows.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = (f"shard bigint, part bigint, n_tokens bigint, doc_ids array<{kind}>, starts array<bigint>, "
              "levels array<binary>, marks array<binary>, ranks array<binary>")
    rows.mapInArrow(_segments(vocabulary, end_id, size), fields).write.option("compression", "none").option(
        "parquet.block.size", ROW_GROUP_BYTES).option("parquet.enable.dictionary", "false").parquet(folder)
    return folder


def codes(row) -> Codes:
    """Codes of one row of the files, for access to single tokens."""
    return Codes(row["levels"], row["marks"], row["ranks"])


def _documents(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            parts = [[x.as_py() for x in row[c].values] for c in ("levels", "marks", "ranks")]
            values = Codes(*parts).all().astype("<u4")
            starts = row["starts"].values.to_numpy()
            ends = np.append(starts[1:], len(values))
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(starts, ends)]
            n = len(starts)
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"].values, pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64()),
                 pa.array(np.full(n, row["shard"].as_py())), pa.array(np.full(n, row["part"].as_py()))],
                names=["doc_id", "inner", "n_tokens", "ids_crc32", "shard", "part"])


def bases(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, part, base): tokens before each segment. Only one sum per shard, that is per
    writing task, passes through a single window."""
    segments = spark.read.parquet(folder).select("shard", "part", "n_tokens")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inner = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.select("shard", "part", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)).alias("inside"))
    return segments.join(shards, "shard").select("shard", "part", (F.col("before") + F.col("inside")).alias("base"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    files = spark.read.parquet(folder)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    docs = files.drop("n_tokens").mapInArrow(
        _documents, f"doc_id {kind}, inner bigint, n_tokens bigint, ids_crc32 bigint, shard bigint, part bigint")
    return docs.join(bases(spark, folder), ["shard", "part"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
