"""Cheapest repair of conversations whose turns are lost, doubled, blank, cut or of the wrong role.

Each row becomes one letter of its role and fault, each conversation one signature. Read from
their ends and sorted, signatures with a common ending stand next to each other, so a task keeps
one path of an automaton in which endings are shared, and works out a node's costs once for all
conversations that end alike; only the path that two neighbouring tasks share is done twice. Costs of
a node are kept relative to the least, of which there are few, so a node is two numbers however
long the conversation is. Rows of one conversation are placed by a range partitioning and meet in
pieces of bounded size; texts stay out of all this, and are read again to hash the repaired ones.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F, types as T

from postlens.llm.frames import written
from postlens.operators.joins import lookup_join
from postlens.operators.ordering import with_position

OK, TRUNCATED, DUPLICATE, BLANK = range(4)
ROLES = "sua"
#: Letters of a signature: four faults for each of the roles s, u, a and any other.
LETTERS = "ABCDEFGHIJKLMNOP"
DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5
#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
PIECE_ROWS = 1 << 16
PREFIX = 64


# -- damage and faults ------------------------------------------------------------------------

def draw() -> Column:
    """What happens to a row: the checksum of its conversation and turn, modulo 20."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    return F.crc32(name.cast("binary")) % 20


def damaged(rows: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, text, copy): rows after damage; of a dropped one, a row with copy 0."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    what = F.col("_draw")
    text = F.coalesce("text", F.lit(" "))
    copies = F.when(what == 0, F.array(F.lit(0))).when(what == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", "role", "text").withColumn("_draw", draw()).select(
        key.alias("key"), "conv_id", "turn",
        F.when(what == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(what == 1, "").when(what == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"))


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the digest that orders rows of one turn and role and tells equal texts."""
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


ORDER = ["key", "turn", "role", "digest", "copy"]


def marked(rows: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, digest, copy, fault) without the text; duplicates are not known yet."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = F.when(blank, BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(OK)
    return keyed(rows).withColumn("fault", fault).drop("text")


def signatures(rows: DataFrame) -> DataFrame:
    """(key, conv_id, signature, gaps): one row per conversation of damaged rows.

    Rows of a turn are ordered by role, then by the digest of their text.
    """
    placed = with_position(marked(rows), ORDER, "place")
    present = placed.where("copy > 0")
    same = ["key", "role", "digest"]
    first = written(present.where(F.col("fault") != BLANK).groupBy(*same).agg(
        F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = lookup_join(placed, first, same, rows=first.count())
    fault = F.when((F.col("fault") != BLANK) & (F.col("place") > F.col("first")), DUPLICATE).otherwise(F.col("fault"))
    role = F.substring("role", 1, 1)
    number = F.coalesce(*[F.when(role == r, i) for i, r in enumerate(ROLES)], F.lit(len(ROLES)))
    letter = F.when(F.col("copy") == 0, "").otherwise(F.substring(F.lit(LETTERS), number * 4 + fault + 1, F.lit(1)))

    def in_order(at, what):
        listed = F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), what.alias("x"))))
        return F.array_join(F.transform(listed, lambda s: s["x"]), "")

    piece = F.floor(F.col("place") / PIECE_ROWS).alias("piece")
    pieces = joined.groupBy("key", piece).agg(
        F.first("conv_id", ignorenulls=True).alias("conv_id"), in_order("place", letter).alias("letters"))
    whole = pieces.groupBy("key").agg(
        F.first("conv_id", ignorenulls=True).alias("conv_id"), in_order("piece", F.col("letters")).alias("signature"))
    turns = present.groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    return whole.join(turns, "key", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)).cast("bigint"))


# -- the automaton of shared endings -----------------------------------------------------------

def after(state: int, role: str) -> int | None:
    """State after a turn of ``role``; None where the grammar does not allow it."""
    if role == "s":
        return SYSTEM if state == START else None
    if role == "u":
        return None if state == USER else USER
    if role == "a":
        return ASSISTANT if state == USER else None
    return None


def expected(state: int) -> str:
    """The only role besides a system turn that can come next."""
    return "a" if state == USER else "u"


class Endings:
    """Automaton over endings: costs-to-go and best edits of each node, along one sorted path.

    ``shapes`` are the relative costs of the four grammar states, and ``steps`` what a letter in
    front of a shape gives: the new shape, the cost added to all, and for each state its edits up
    to that letter and the state after it.
    """

    def __init__(self):
        self.shapes = [(0, 10, 5, 0)]
        self.number = {self.shapes[0]: 0}
        self.steps = {}
        self.last, self.path, self.base = "", [0], [0]
        self.moves, self.nodes, self.answer = [], 0, (0, "")

    def step(self, shape: int, letter: str):
        known = self.steps.get((shape, letter))
        if known is None:
            known = self.steps[shape, letter] = self._solve(self.shapes[shape], LETTERS.index(letter))
        return known

    def _solve(self, below, code):
        role, fault = (ROLES + " ")[code // 4], code % 4
        extra = CUT_OFF if fault == TRUNCATED else 0
        best = []
        for state in range(4):
            options = [(DELETE + below[state], "D", state)]
            if fault in (OK, TRUNCATED):
                kept = after(state, role)
                if kept is not None:
                    options.append((extra + below[kept], "K", kept))
                changed = after(state, expected(state))
                options.append((REROLE + extra + below[changed], "R", changed))
            best.append(min(options))
        # user and assistant turns inserted in front of a row alternate: a second one only goes back
        user = min(best[USER], (INSERT + best[ASSISTANT][0], "I" + best[ASSISTANT][1], best[ASSISTANT][2]))
        assistant = min(best[ASSISTANT], (INSERT + best[USER][0], "I" + best[USER][1], best[USER][2]))
        full = [None, None, user, assistant]
        for state in (START, SYSTEM):
            full[state] = min(best[state], (INSERT + user[0], "I" + user[1], user[2]))
        least = min(cost for cost, _, _ in full)
        shape = tuple(cost - least for cost, _, _ in full)
        if shape not in self.number:
            self.number[shape] = len(self.shapes)
            self.shapes.append(shape)
        return self.number[shape], least, [(edits, state) for _, edits, state in full]

    def repair(self, backwards: str):
        """(cost, audit) of a signature read from its end; calls come in sorted order."""
        if backwards == self.last and self.moves:
            return self.answer
        shared = common(backwards, self.last)
        del self.path[shared + 1:], self.base[shared + 1:], self.moves[shared:]
        for letter in backwards[shared:]:
            shape, added, moves = self.step(self.path[-1], letter)
            self.path.append(shape)
            self.base.append(self.base[-1] + added)
            self.moves.append(moves)
        self.nodes += len(backwards) - shared
        self.last = backwards
        state, audit = START, []
        for moves in reversed(self.moves):
            edits, state = moves[state]
            audit.append(edits)
        audit.append(("", "II", "I", "")[state])
        self.answer = self.base[-1] + self.shapes[self.path[-1]][START], "".join(audit)
        return self.answer


def common(a: str, b: str) -> int:
    """Length of the common beginning, by halving slices."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


_ROLE_OF = str.maketrans(LETTERS, "".join(r * 4 for r in "sua-"))
_FAULT_OF = str.maketrans(LETTERS, "0123" * 4)


def facts(signature: str):
    """Counts of blank, duplicate and truncated rows, and of neighbours the grammar does not allow."""
    faults, roles = signature.translate(_FAULT_OF), signature.translate(_ROLE_OF)
    legal = sum(roles.count(pair) for pair in ("su", "ua", "au"))
    return faults.count("3"), faults.count("2"), faults.count("1"), max(0, len(roles) - 1) - legal


def _repaired(batches):
    import pyarrow as pa

    endings = Endings()
    names = ("blank", "duplicate", "truncated", "illegal", "cost", "audit")
    types = (pa.int64(),) * 5 + (pa.string(),)
    for batch in batches:
        found = []
        for backwards in batch.column("backwards").to_pylist():
            found.append((*facts(backwards[::-1]), *endings.repair(backwards)))
        columns = [batch.column(c) for c in ("key", "conv_id", "gaps")]
        columns += [pa.array([f[i] for f in found], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "conv_id", "gaps", *names])


def audits(signed: DataFrame) -> DataFrame:
    """(key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of (key, conv_id, signature, gaps).

    Placement goes by the last letters and the key, so one very common signature is spread too.
    """
    spark = signed.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = T.StructType([f for f in signed.schema if f.name in ("key", "conv_id")])
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(name, "long")
    turned = signed.select("key", "conv_id", F.col("gaps").cast("long").alias("gaps"), F.reverse("signature").alias("backwards"))
    placed = turned.repartitionByRange(parts, F.substring("backwards", 1, PREFIX), "key")
    return placed.sortWithinPartitions("backwards", "key").mapInArrow(_repaired, schema.add("audit", "string"))


# -- repaired texts ---------------------------------------------------------------------------

class Writer:
    """Digest of one repaired conversation, fed row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.any = audit, 0, START, hashlib.sha256(), False

    def put(self, role: str, text: str):
        self.hash.update(("\n" if self.any else "").encode() + role.encode() + b":" + text.encode())
        self.any = True

    def turn(self) -> str:
        role = expected(self.state)
        self.state = after(self.state, role)
        return "assistant" if role == "a" else "user"

    def inserted(self):
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self.put(self.turn(), "")

    def row(self, role: str, text: str):
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = after(self.state, role[:1])
            self.put(role, text)
        elif edit == "R":
            self.put(self.turn(), text)

    def done(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


def _hashed(batches):
    """Rows come sorted by conversation, first its audit and then its rows in order."""
    import pyarrow as pa

    key, writer = None, None
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("key", "copy", "role", "text", "audit")]
        for k, copy, role, text, audit in zip(*columns):
            if copy is None:
                if writer is not None:
                    out.append((key, writer.done()))
                key, writer = k, Writer(audit)
            elif copy > 0:
                writer.row(role, text)
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], pa.string()) for i in range(2)], names=["key", "repaired_sha256"])
    if writer is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.string()) for x in (key, writer.done())], names=["key", "repaired_sha256"])


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(key, repaired_sha256): rows follow their audit through a task one by one.

    A digest is over one text in order, so all of a conversation passes one task; it is
    streamed from the sorted shuffle, of which no more than a batch is held.
    """
    texts = keyed(rows.where("copy > 0")).select(*ORDER, "text", F.lit(None).cast("string").alias("audit"))
    heads = found.select("key", *[F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in (*ORDER[1:], "text")], "audit")
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = heads.unionByName(texts).repartition(parts, "key")
    lead = F.col("copy").isNotNull()
    ordered = both.sortWithinPartitions("key", lead, *ORDER[1:])
    return ordered.select("key", "copy", "role", "text", "audit").mapInArrow(_hashed, "key string, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of (conv_id, turn, role, text), after the damage that its checksums give.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256). Null
    role or text is one space; a null turn comes first and counts for no gap; rows without a
    conv_id are one conversation. Rows of one turn are ordered by role, then by the SHA-256 of the text, and a
    repeated row is a duplicate of the one before. A conversation of which all rows are dropped has
    zeros, an empty audit and the digest of the empty text. Texts may be of any length, and a
    conversation may have any number of turns whose audit still fits one value. An empty table gives no rows; other columns are not read.
    """
    rows = damaged(conversations)
    found = written(audits(signatures(rows)))
    hashes = digests(rows, found)
    return found.join(hashes, "key").drop("key")
