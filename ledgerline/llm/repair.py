r"""Operator 11: conversation structure repair by run-length dynamic programming.

The turns of a conversation are symbols (role and fault).  Deleting, reroling
and inserting turns at the least cost such that the roles read
``(s?(ua)+)?`` is a shortest path over four grammar states; one symbol is a 4 x 4
transition over (min, +).  Equal consecutive symbols are one run, advanced
through cached binary powers of its transition, and the choices of a run are
unrolled by halving it, with the cost to go at each half from the same powers.

Conversations are cut into chunks of bounded size along one global order, so
no conversation needs to fit into a task: chunks pass on a vector of four
costs (from the end) and the state reached (from the start).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import spill

FAR = 1 << 60  # no way
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES = range(4)
#: State -> the role that a rerole or an insertion gives there, and the state after it.
GIVEN = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: (state, role initial) -> state, where the grammar takes the role.
TAKES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Cost to go after the last turn: only insertions are left.
ENDING = (0, 2 * INSERT, INSERT, 0)

#: Turns and bytes of text of a chunk.
CHUNK_TURNS, CHUNK_BYTES = 4096, 1 << 20

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _options(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after) of one turn; a symbol is a role initial (or '-') and a fault ('.', 'x', 't')."""
    role, fault = symbol
    out = [("D", DELETE, state)]
    if fault != "x":
        extra = TRUNCATED if fault == "t" else 0
        if (state, role) in TAKES:
            out.append(("K", extra, TAKES[state, role]))
        out.append(("R", REROLE + extra, GIVEN[state][1]))
    return out


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, min(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def _before(m: Matrix, after: Vector) -> Vector:
    """Costs to go before a transition, from those after it."""
    return tuple(min(FAR, min(m[i][j] + after[j] for j in STATES)) for i in STATES)


@lru_cache(maxsize=None)  # 15 symbols x the bits of a chunk's length
def power(symbol: str, bit: int) -> Matrix:
    """The min-plus transition of 2^bit equal turns, insertions before each included."""
    if bit:
        half = power(symbol, bit - 1)
        return _times(half, half)
    rows = []
    for state in STATES:
        best, at, paid = [FAR] * 4, state, 0
        for _ in range(3):  # no insertion, one, two: more only lead in a circle
            for _, cost, to in _options(symbol, at):
                best[to] = min(best[to], paid + cost)
            at, paid = GIVEN[at][1], paid + INSERT
        rows.append(tuple(best))
    return tuple(rows)


def _advance(symbol: str, n: int, after: Vector) -> Vector:
    """Costs to go before ``n`` equal turns."""
    bit = 0
    while n:
        if n & 1:
            after = _before(power(symbol, bit), after)
        n >>= 1
        bit += 1
    return after


@lru_cache(maxsize=1 << 14)
def _unroll(symbol: str, n: int, after: Vector, state: int) -> tuple[str, int]:
    """The least edit letters, of the cheapest ones, for ``n`` equal turns from ``state``; and the state after."""
    if n > 1:
        half = 1 << (n - 1).bit_length() - 1
        left, middle = _unroll(symbol, n - half, _level(_advance(symbol, half, after)), state)
        right, end = _unroll(symbol, half, after, middle)
        return left + right, end
    letters, need = "", _before(power(symbol, 0), after)
    while True:
        edits = {letter: (cost, to) for letter, cost, to in _options(symbol, state)}
        for letter in "DIKR":  # ASCII order
            if letter == "I" and need[state] == INSERT + need[GIVEN[state][1]]:
                break
            if letter in edits and need[state] == edits[letter][0] + after[edits[letter][1]]:
                return letters + letter, edits[letter][1]
        letters, state = letters + "I", GIVEN[state][1]


def _level(v: Vector) -> Vector:
    """A vector less its least cost: equal choices, few different vectors."""
    least = min(v)
    return tuple(min(FAR, x - least) for x in v)


def runs(symbols: list[str]) -> list[tuple[str, int]]:
    """Equal consecutive symbols as (symbol, length)."""
    out: list[tuple[str, int]] = []
    for s in symbols:
        if out and out[-1][0] == s:
            out[-1] = (s, out[-1][1] + 1)
        else:
            out.append((s, 1))
    return out


def edits(symbols: list[str], ending: Vector = ENDING, state: int = 0) -> tuple[str, int]:
    """The cheapest edits of the turns (of equal ones the ASCII-least letters), and the state after them.

    ``ending`` are the costs to go after these turns.
    """
    found = runs(symbols)
    afters, after = [], _level(ending)
    for symbol, n in reversed(found):
        afters.append(after)
        after = _level(_advance(symbol, n, after))
    letters = []
    for (symbol, n), after in zip(found, reversed(afters), strict=True):
        part, state = _unroll(symbol, n, after, state)
        letters.append(part)
    return "".join(letters), state


def tail(state: int) -> str:
    """The insertions that end a conversation."""
    letters = ""
    while ENDING[state]:
        letters, state = letters + "I", GIVEN[state][1]
    return letters


def fault_of(text: str, repeated: bool) -> str:
    """'' or the first fault of a turn: blank, duplicate or truncated."""
    stripped = text.rstrip(" \t\n\x0b\x0c\r")
    if not stripped:
        return "blank"
    return "duplicate" if repeated else "" if stripped[-1] in ".!?" else "truncated"


def symbol_of(role: str, fault: str) -> str:
    initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
    return initial + {"": ".", "truncated": "t"}.get(fault, "x")


#: One row per chunk of a conversation in global order.
CHUNKS = "conv_id long, part int, chunk int, turns array<long>, roles array<string>, texts array<string>, again array<boolean>"


def _chunks(most: int):
    """Cut rows in order (conv_id, turn, role, text) into chunks of at most ``most`` turns."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int32()), ("turns", pa.list_(pa.int64())),
                        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("again", pa.list_(pa.bool_()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, held, size, count, last = [], None, 0, 0, None
        for b in batches:
            for conv, part, turn, role, text, again in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if held is None or held["conv_id"] != conv or len(held["turns"]) >= most or size > CHUNK_BYTES:
                    if held is not None:
                        ready.append(held)
                        count += size
                        if len(ready) >= 2000 or count > CHUNK_BYTES:
                            yield pa.RecordBatch.from_pylist(ready, schema)
                            ready, count = [], 0
                    number = held["chunk"] + 1 if held is not None else 0
                    held, size = {"conv_id": conv, "part": part, "chunk": number, "turns": [], "roles": [], "texts": [], "again": []}, 0
                held["turns"].append(turn)
                held["roles"].append(role)
                held["texts"].append(text)
                # equal rows are neighbours: all but the first are repeated, whatever the turn
                held["again"].append(again or last == (conv, turn, role, text))
                last = (conv, turn, role, text)
                size += 3 * len(text) + 64
        if held is not None:
            ready.append(held)
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    return run


def _symbols(chunk: dict) -> tuple[list[str], list[str]]:
    faults = [fault_of(t, a) for t, a in zip(chunk["texts"], chunk["again"], strict=True)]
    return [symbol_of(r, f) for r, f in zip(chunk["roles"], faults, strict=True)], faults


_BATCH = ("conv_id", "part", "chunk", "turns", "roles", "texts", "again", "ending")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(0, b.num_rows, 64):
            yield from b.slice(i, 64).to_pylist()


ENDINGS = "conv_id long, part int, chunk int, ending array<long>"


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The transition of each chunk as one row of 16 costs."""
    for b in batches:
        flat = []
        for c in b.to_pylist():
            ends = []
            for j in STATES:  # column j: costs to go to state j
                after: Vector = tuple(0 if i == j else FAR for i in STATES)
                for symbol, n in reversed(runs(_symbols(c)[0])):
                    after = _advance(symbol, n, after)
                ends.append(after)
            flat.append([ends[j][i] for i in STATES for j in STATES])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(flat, pa.list_(pa.int64()))],
                                         ["conv_id", "part", "chunk", "costs"])


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs to go after each chunk, from matrices in reverse order."""
    conv, after = object(), ENDING
    for b in batches:
        out = []
        for c in b.to_pylist():
            if c["conv_id"] != conv:
                conv, after = c["conv_id"], ENDING
            out.append(list(after))
            m = c["costs"]
            after = _level(_before(tuple(tuple(m[4 * i : 4 * i + 4]) for i in STATES), after))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.list_(pa.int64()))],
                                         ["conv_id", "part", "chunk", "ending"])


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = ", ".join(["conv_id long", *[f"{c} long" for c in COUNTS], "audit string", "repaired_sha256 string", "n_repaired long"])


class _Repair:
    """The running repair of one conversation, chunk by chunk."""

    def __init__(self, conv: int | None):
        self.conv, self.state, self.letters, self.digest, self.n = conv, 0, [], hashlib.sha256(), 0
        self.counts, self.illegal, self.cost = {"": 0, "blank": 0, "duplicate": 0, "truncated": 0}, 0, 0
        self.low = self.high = self.role = None
        self.distinct = 0

    def _say(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.n else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.n += 1

    def _insert(self) -> None:
        role, self.state = GIVEN[self.state]
        self.cost += INSERT
        self._say(role, "")

    def add(self, chunk: dict) -> None:
        symbols, faults = _symbols(chunk)
        for turn, role, fault in zip(chunk["turns"], chunk["roles"], faults, strict=True):
            self.counts[fault] += 1
            if self.role is not None and self.role + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.role = role[:1]
            if turn is not None:
                self.distinct += self.high is None or turn != self.high
                self.low, self.high = turn if self.low is None else self.low, turn
        ending = tuple(chunk["ending"]) if chunk["ending"] is not None else ENDING
        letters, end = edits(symbols, ending, self.state)
        at = 0
        for letter in letters:
            if letter == "I":
                self._insert()
                continue
            role, text, symbol = chunk["roles"][at], chunk["texts"][at], symbols[at]
            at += 1
            cost, to = next((c, t) for x, c, t in _options(symbol, self.state) if x == letter)
            if letter != "D":
                self._say(GIVEN[self.state][0] if letter == "R" else role, text)
            self.cost += cost
            self.state = to
        assert self.state == end
        self.letters.append(letters)

    def result(self) -> dict:
        rest = tail(self.state)
        for _ in rest:
            self._insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.counts["blank"], "duplicate": self.counts["duplicate"],
                "truncated": self.counts["truncated"], "illegal": self.illegal, "cost": self.cost,
                "audit": "".join(self.letters) + rest, "repaired_sha256": self.digest.hexdigest(), "n_repaired": self.n}


_RESULT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string()),
                     ("n_repaired", pa.int64())])


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations whose chunks come in order."""
    ready, size, now = [], 0, None
    for c in _rows(batches):
        if now is None or now.conv != c["conv_id"]:
            if now is not None:
                ready.append(now.result())
                size += len(ready[-1]["audit"])
                if len(ready) >= 5000 or size > CHUNK_BYTES:
                    yield pa.RecordBatch.from_pylist(ready, _RESULT)
                    ready, size = [], 0
            now = _Repair(c["conv_id"])
        now.add(c)
    if now is not None:
        ready.append(now.result())
    if ready:
        yield pa.RecordBatch.from_pylist(ready, _RESULT)


def repair_conversations(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, text)``; see `RESULT`.

    Turns are taken in the order (turn with nulls first, role, text).  A null
    role or text is one blank.  Equal rows are turns of their own: all but the
    first are duplicates.  A role of another initial than s, u or a, an empty
    one too, can only be reroled or deleted.  Rows without a conv_id are one
    conversation; an empty table gives no rows; other columns are ignored.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("digest")
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0).cast("long")).alias("turn"))
    # where a conversation says something twice: the turn of its first time
    first = (rows.select("conv_id", "role", digest, order.alias("at")).groupBy("conv_id", "role", "digest")
             .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first"))
    marked = rows.select("*", digest, order.alias("at")).join(
        first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")), "left")
    marked = marked.select("conv_id", "turn", "role", "text", F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("again"),
                           F.substring("text", 1, 64).alias("_head"))
    # one order of all turns, dealt in ranges: a large conversation lies in many of them
    dealt = marked.repartitionByRange("conv_id", "turn", "role", "_head").sortWithinPartitions("conv_id", "turn", "role", "text")
    cut = dealt.select("conv_id", F.spark_partition_id().alias("part"), "turn", "role", "text", "again").mapInArrow(_chunks(chunk_turns), CHUNKS)
    chunks = spill(cut, "repair-chunks")
    spans = chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("_c"))
    spans = spill(spans, "repair-spans")  # conversations of several chunks: few, and each is large or lies on a border
    same = F.col("conv_id").eqNullSafe(F.col("_c"))
    none = F.lit(None).cast("array<long>").alias("ending")
    alone = chunks.join(spans, same, "left_anti").select("*", none)
    single = alone.select(*_BATCH).mapInArrow(_repairs, RESULT)
    parts = chunks.join(spans, same, "left_semi")
    backwards = (parts.mapInArrow(_matrices, "conv_id long, part int, chunk int, costs array<long>")
                 .repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("chunk")))
    endings = spill(backwards.mapInArrow(_endings, ENDINGS), "repair-endings").select(
        F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.col("chunk").alias("_k"), "ending")
    joined = parts.join(endings, same & (F.col("part") == F.col("_p")) & (F.col("chunk") == F.col("_k")))
    several = (joined.select(*_BATCH).repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk").mapInArrow(_repairs, RESULT))
    return single.unionByName(several)


def repair_all(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """As `repair_conversations`, with a row for each distinct conv_id of ``conversations``: one without turns has zeros and empty texts."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    found = ids.join(repair_conversations(turns), F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.select(F.col("_id").alias("conv_id"), *[zero(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"), zero("n_repaired"))


def damage(turns: DataFrame) -> DataFrame:
    """The rows of ``turns`` with planted faults, by crc32 of "conv_id:turn" modulo 20 (nulls: one blank)."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"),
                        (F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20).alias("_k")).where("_k != 0")
    rows = rows.withColumn("text", F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_k") == 3, 2).otherwise(1))).alias("_copy")
    return rows.select("*", copies).drop("_k", "_copy")
