"""Cheapest repair of conversations' turns by Four-Russians block tables.

A row is a symbol: it must go (blank or repeated), or it has a role's first letter and is truncated or not. A state is what has
been kept so far: nothing, ``s``, ``...u`` or ``...a``. The costs to the end from each state are a vector; normalised to
a minimum of 0 there are few, so the steps of every vector over every block of ``BLOCK`` symbols are precomputed.
A conversation is read from its end, block by block, by lookup; the vectors at block bounds are kept. Then each block is
expanded backwards from the vector at its end, and the smallest letter that keeps the cost is taken at every place, so
ties are decided as the letters say.

Rows are sorted by conversation and turn over range partitions, so a conversation with a third of all rows is spread over
many. A task turns its run of rows into pieces of ``PIECE_ROWS`` rows at most. A conversation that lies inside one
piece is repaired there. For the others (the first and last of a partition, and long ones)

1. rows seen in an earlier piece are found by counting digests of role and text,
2. each piece gives a min-plus matrix of 16 numbers: the cost from each state before it to each state after it,
3. these are composed from the last piece to the first, which gives the cost vector after each piece, and
4. pieces pass in order, each from the state that the one before ended in; one piece is in memory at a time.

Only step 4 and a digest over a whole conversation run in order, one task for a conversation.

Defined cases: in ``repair`` null roles and texts count as one space. Null turns come first and a null conversation is
one of its own. Rows of equal turn are ordered by role and text. A role without a first letter cannot be kept. A row with
``times`` 0 only says that the conversation exists.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm import tables

BLOCK = 4
PIECE_ROWS, PIECE_BYTES = 4096, 16 << 20
_BLANKS = r"[\x20\x09-\x0D]"
_NOTHING, _S, _U, _A = range(4)
#: The role that the pattern (s?(ua)+)? asks for next, and the state after it.
_NEXT_ROLE, _NEXT_STATE = ("user", "user", "assistant", "user"), (_U, _U, _A, _U)
_DELETE, _INSERT, _REROLE, _TRUNCATED = 2, 5, 1, 5
_INITIALS = "sua"
_GONE = 8  # symbols 0 to 3 are s, u, a and other letters; 4 to 7 the same, truncated
_SYMBOLS = 9
_FAR = 1 << 40  # more than any cost of a conversation
_END = (0, 10, 5, 0)  # costs after the last row: inserting what is missing


def _kept_state(state: int, symbol: int) -> int | None:
    """The state after keeping a row, if it can be kept."""
    initial = symbol % 4
    if symbol == _GONE or initial == 3:
        return None
    if _INITIALS[initial] == "s":
        return _S if state == _NOTHING else None
    return _NEXT_STATE[state] if _NEXT_ROLE[state][0] == _INITIALS[initial] else None


def _step(symbol: int, after: tuple[int, ...]) -> list[int]:
    """Costs from each state before a row, by the costs after it."""
    extra = _TRUNCATED if 4 <= symbol < _GONE else 0
    costs = []
    for state in range(4):
        options = [_DELETE + after[state]]
        if symbol != _GONE:
            options.append(_REROLE + extra + after[_NEXT_STATE[state]])
            if (kept := _kept_state(state, symbol)) is not None:
                options.append(extra + after[kept])
        costs.append(min(options))
    for _ in range(3):  # insertions before the row
        costs = [min(cost, _INSERT + costs[_NEXT_STATE[state]]) for state, cost in enumerate(costs)]
    return costs


def _normal(costs: list[int]) -> tuple[int, tuple[int, ...]]:
    least = min(costs)
    return least, tuple(cost - least if cost < _FAR else _FAR for cost in costs)


class _Tables:
    """Normalised cost vectors, their steps over one symbol, and over every block of symbols."""

    def __init__(self) -> None:
        units = [tuple(0 if i == state else _FAR for i in range(4)) for state in range(4)]
        self.vectors = [_END, *units]
        self.number = {vector: i for i, vector in enumerate(self.vectors)}
        steps, costs = [], []
        for vector in self.vectors:  # grows until it is closed
            made = [_normal(_step(symbol, vector)) for symbol in range(_SYMBOLS)]
            for _, normal in made:
                if normal not in self.number:
                    self.number[normal] = len(self.vectors)
                    self.vectors.append(normal)
            steps.append([self.number[normal] for _, normal in made])
            costs.append([least for least, _ in made])
        self.step, self.cost = np.array(steps).T, np.array(costs).T  # by symbol and vector
        block, paid = self.step, self.cost
        for _ in range(BLOCK - 1):  # one more symbol before the block
            paid = (paid[None, :, :] + self.cost[:, block]).reshape(-1, len(self.vectors))
            block = self.step[:, block].reshape(-1, len(self.vectors))
        self.block, self.paid = block, paid

    def number_of(self, vector: tuple[int, ...]) -> int:
        """Any vector that can come up after rows is known, as all begin with the end's or a unit vector."""
        return self.number[vector]

    def before(self, symbols: bytes, vector: int) -> tuple[int, list[int]]:
        """Total cost taken out of the vectors, and the vector at every block bound from the first row on."""
        total, bounds = 0, [vector]
        whole = len(symbols) - len(symbols) % BLOCK
        if tail := symbols[whole:]:
            for symbol in reversed(tail):
                total += int(self.cost[symbol, vector])
                vector = int(self.step[symbol, vector])
            bounds.append(vector)
        for at in range(whole - BLOCK, -1, -BLOCK):
            number = 0
            for symbol in symbols[at : at + BLOCK]:
                number = number * _SYMBOLS + symbol
            total += int(self.paid[number, vector])
            vector = int(self.block[number, vector])
            bounds.append(vector)
        return total, bounds[::-1]


@lru_cache(maxsize=1)
def block_tables() -> _Tables:
    return _Tables()


@lru_cache(maxsize=200_000)
def _expanded(symbols: bytes, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The letters of a block from a state, and the state after it."""
    costs = [list(after)]
    for symbol in reversed(symbols):
        costs.append(_step(symbol, tuple(costs[-1])))
    costs.reverse()
    letters = []
    for at, symbol in enumerate(symbols):
        extra = _TRUNCATED if 4 <= symbol < _GONE else 0
        while True:
            now, later = costs[at], costs[at + 1]
            kept = _kept_state(state, symbol)
            if now[state] == _DELETE + later[state]:
                letters.append("D")
                break
            if now[state] == _INSERT + now[_NEXT_STATE[state]]:
                letters.append("I")
                state = _NEXT_STATE[state]
                continue
            if kept is not None and now[state] == extra + later[kept]:
                letters.append("K")
                state = kept
                break
            letters.append("R")
            state = _NEXT_STATE[state]
            break
    return "".join(letters), state


def traced(symbols: bytes, after: tuple[int, ...], state: int, last: bool) -> tuple[str, int]:
    """The letters of the cheapest edits of a piece, smallest of several, and the state after it."""
    found = block_tables()
    least, normal = _normal(list(after))
    vectors = found.before(symbols, found.number_of(normal))[1] if normal in found.number else None
    out = []
    if vectors is None:
        text, state = _expanded.__wrapped__(symbols, after, state)
        out.append(text)
    else:
        for i, at in enumerate(range(0, len(symbols), BLOCK)):
            text, state = _expanded(symbols[at : at + BLOCK], found.vectors[vectors[i + 1]], state)
            out.append(text)
    while last and _END[state]:
        out.append("I")
        state = _NEXT_STATE[state]
    return "".join(out), state


def matrix(symbols: bytes) -> list[int]:
    """The cost from each state before a piece to each state after it, row by row."""
    found = block_tables()
    columns = []
    for state in range(4):
        total, bounds = found.before(symbols, 1 + state)
        columns.append([min(total + cost, _FAR) if cost < _FAR else _FAR for cost in found.vectors[bounds[0]]])
    return [columns[after][before] for before in range(4) for after in range(4)]


# Rows to pieces

_TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
_STATS = [T.StructField(name, T.LongType()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
#: ``whole``: the piece is its conversation. ``state`` is the one after the piece.
PIECE = [T.StructField("piece", T.LongType()), T.StructField("whole", T.BooleanType()), *_STATS, T.StructField("audit", T.StringType()), T.StructField("repaired", T.ArrayType(_TURN))]
_OPEN = [
    T.StructField("symbols", T.BinaryType()),
    T.StructField("roles", T.ArrayType(T.StringType())),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("seen", T.ArrayType(T.BinaryType())),
    T.StructField("turns", T.ArrayType(T.LongType())),
]


def _symbol(role: str, fault: int) -> int:
    """``fault`` 0 none, 1 blank, 2 truncated."""
    return _GONE if fault == 1 else "sua".find(role[:1]) % 4 + (4 if fault == 2 else 0) if role else (7 if fault == 2 else 3)


def _illegal(before: str | None, role: str) -> bool:
    return before is not None and before[:1] + role[:1] not in ("su", "ua", "au")


def _edited(letters: str, roles: list[str], texts: list[str], state: int) -> list[dict]:
    """The repaired rows."""
    out, at = [], 0
    for letter in letters:
        if letter == "D":
            at += 1
            continue
        if letter == "I":
            out.append({"role": _NEXT_ROLE[state], "text": ""})
            state = _NEXT_STATE[state]
            continue
        role = roles[at] if letter == "K" else _NEXT_ROLE[state]
        out.append({"role": role, "text": texts[at]})
        state = _S if letter == "K" and role[:1] == "s" else _NEXT_STATE[state]
        at += 1
    return out


def _cost(letters: str, symbols: bytes) -> int:
    """What the edits of a piece cost."""
    cost, at = 0, 0
    for letter in letters:
        cost += {"D": _DELETE, "I": _INSERT, "K": 0, "R": _REROLE}[letter]
        if letter != "I":
            cost += _TRUNCATED if letter != "D" and 4 <= symbols[at] < _GONE else 0
            at += 1
    return cost


class _Piece:
    """Rows of a conversation that come one after the other."""

    def __init__(self, conversation, first: bool) -> None:
        self.conversation, self.first = conversation, first
        self.symbols, self.roles, self.texts, self.turns, self.digests = bytearray(), [], [], [], []
        self.known: set[tuple[str, str]] = set()
        self.blank = self.duplicate = self.bytes = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        repeated = fault != 1 and (role, text) in self.known
        self.blank += fault == 1
        self.duplicate += repeated
        self.symbols.append(_GONE if repeated else _symbol(role, fault))
        if fault != 1:
            self.known.add((role, text))
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.bytes += len(text)

    @property
    def full(self) -> bool:
        return len(self.roles) >= PIECE_ROWS or self.bytes >= PIECE_BYTES

    def row(self, number: int, whole: bool) -> dict:
        row = {"conversation": self.conversation, "piece": number, "whole": whole}
        if whole:
            symbols = bytes(self.symbols)
            letters, _ = traced(symbols, _END, _NOTHING, True)
            turns = [turn for turn in self.turns if turn is not None]
            gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
            row |= {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": sum(4 <= s < _GONE for s in symbols)}
            row |= {"illegal": sum(_illegal(a, b) for a, b in zip(self.roles, self.roles[1:], strict=False)), "cost": _cost(letters, symbols)}
            return row | {"audit": letters, "repaired": _edited(letters, self.roles, self.texts, _NOTHING)}
        # Whatever may have been seen in an earlier piece is known by a digest.
        seen = [None if s == _GONE else hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest() for s, r, t in zip(self.symbols, self.roles, self.texts, strict=True)]
        return row | {"blank": self.blank, "duplicate": self.duplicate, "symbols": bytes(self.symbols), "roles": self.roles, "texts": self.texts, "seen": seen, "turns": self.turns}


def _cut(schema: pa.Schema):
    """Sorted rows of a partition to pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        piece, out, size = None, [], 0

        def packed(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            for conversation, turn, role, text, fault, times in zip(*[batch.column(name).to_pylist() for name in ("conversation", "turn", "role", "text", "fault", "times")], strict=True):
                if piece is None or piece.conversation != conversation:
                    if piece is not None:
                        out.append(piece.row(number, piece.first and number & 0xFFFFFFFF > 0))
                        size += piece.bytes
                        number += 1
                    piece = _Piece(conversation, True)
                for _ in range(times):
                    if piece.full:
                        out.append(piece.row(number, False))
                        size += piece.bytes
                        number += 1
                        piece = _Piece(conversation, False)
                    piece.add(turn, role, text, fault)
                if len(out) >= 1000 or size > PIECE_BYTES:
                    yield packed(out)
                    out, size = [], 0
        if piece is not None:
            out.append(piece.row(number, False))  # the next partition may go on with it
        if out:
            yield packed(out)

    return cut


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows of one conversation and turn next to each other over range partitions; equal rows are one with their number."""
    counted = rows.groupBy("conversation", "turn", "role", "text").agg(F.sum("times").alias("times"))
    # The bounds need no more of a text than its beginning.
    n = tables.parts(rows.sparkSession)
    dealt = counted.repartitionByRange(n, "conversation", "turn", F.substring("role", 1, 64), F.substring("text", 1, 64))
    stripped = F.regexp_replace("text", _BLANKS + r"+\z", "")
    fault = F.when(stripped == "", 1).when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), 2).otherwise(0)
    return dealt.sortWithinPartitions("conversation", "turn", "role", "text").select("conversation", "turn", "role", "text", fault.alias("fault"), "times")


def _joined_pieces(made: DataFrame, conversation: T.StructField) -> DataFrame:
    """The results of pieces that are not whole conversations."""
    parts = made.where("NOT whole")
    # 1. Of each role and text only the first row counts.
    seen = parts.select("conversation", "piece", F.posexplode("seen").alias("place", "digest")).where("digest IS NOT NULL")
    key = ["conversation", "digest"]
    earliest = seen.groupBy(*key).agg(F.min(F.struct("piece", "place")).alias("first"), F.count("*").alias("n")).where("n > 1").select(*key, "first")
    same = F.col("s.conversation").eqNullSafe(F.col("e.conversation")) & (F.col("s.digest") == F.col("e.digest"))
    later = seen.alias("s").join(earliest.alias("e"), same).where("s.piece > e.first.piece")
    again = later.groupBy(F.col("s.piece").alias("piece")).agg(F.collect_list("s.place").alias("again"))
    narrow = parts.select("conversation", "piece", "symbols").join(again, "piece", "left")

    # 2. and 3. Matrices, and the cost vector after each piece.
    def summary(symbols: bytes, again: list[int] | None) -> bytes:
        found = bytearray(symbols)
        for place in again or ():
            found[place] = _GONE
        return bytes(found)

    measured = T.StructType([conversation, T.StructField("piece", T.LongType()), T.StructField("repeated", T.LongType()), T.StructField("symbols", T.BinaryType()), T.StructField("matrix", T.ArrayType(T.LongType()))])
    measured_arrow = to_arrow_schema(measured)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                symbols = summary(row["symbols"], row["again"])
                rows.append({"conversation": row["conversation"], "piece": row["piece"], "repeated": len(row["again"] or ()), "symbols": symbols, "matrix": matrix(symbols)})
            yield pa.RecordBatch.from_pylist(rows, schema=measured_arrow)

    matrices = tables.written(narrow.select("conversation", "piece", "symbols", "again").mapInArrow(measure, measured))
    after = T.StructType([T.StructField("piece", T.LongType()), T.StructField("place", T.LongType()), T.StructField("last", T.BooleanType()), T.StructField("after", T.ArrayType(T.LongType()))])
    after_arrow = to_arrow_schema(after)

    def compose(rows: pa.Table) -> pa.Table:
        ordered = sorted(rows.to_pylist(), key=lambda row: row["piece"], reverse=True)
        costs, out = list(_END), []
        for i, row in enumerate(ordered):
            out.append({"piece": row["piece"], "place": len(ordered) - 1 - i, "last": i == 0, "after": list(costs)})
            steps = row["matrix"]
            costs = [min(steps[4 * before + end] + costs[end] for end in range(4)) for before in range(4)]
            least = min(costs)
            costs = [cost - least for cost in costs]
        return pa.Table.from_pylist(out, schema=after_arrow)

    bounds = matrices.select("conversation", "piece", "matrix").groupBy("conversation").applyInArrow(compose, after)
    # 4. In order, from state to state.
    known = bounds.join(matrices.select("piece", "repeated", "symbols"), "piece")
    passing = parts.drop("symbols", "seen", *[f.name for f in PIECE if f.name not in ("piece", "blank", "duplicate")]).join(known, "piece")
    n = tables.parts(made.sparkSession)
    passing = passing.repartition(n, "conversation").sortWithinPartitions("conversation", "piece")
    result = T.StructType([conversation, *PIECE])
    result_arrow = to_arrow_schema(result)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, role, seen, most = _NOTHING, None, False, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["place"] == 0:
                    state, role, most = _NOTHING, None, None
                letters, end = traced(row["symbols"], tuple(row["after"]), state, row["last"])
                gaps = 0
                for turn in row["turns"]:
                    if turn is not None:
                        gaps += 0 if most is None or turn == most else turn - most - 1
                        most = turn
                illegal = 0
                for own in row["roles"]:
                    illegal += _illegal(role, own)
                    role = own
                out = {"conversation": row["conversation"], "piece": row["piece"], "whole": row["place"] == 0 and row["last"], "gaps": gaps, "blank": row["blank"]}
                out |= {"duplicate": row["duplicate"] + row["repeated"], "truncated": sum(4 <= s < _GONE for s in row["symbols"]), "illegal": illegal}
                out |= {"cost": _cost(letters, row["symbols"]), "audit": letters, "repaired": _edited(letters, row["roles"], row["texts"], state)}
                state = end
                yield pa.RecordBatch.from_pylist([out], schema=result_arrow)

    return passing.mapInArrow(go, result)


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: str | None = None) -> DataFrame:
    """Pieces of repaired conversations in order of ``piece``: ``conversation``, ``piece``, ``whole`` and, of the piece,
    ``gaps, blank, duplicate, truncated, illegal, cost`` (they add up), ``audit`` and ``repaired`` rows (they join up).

    Nearly every conversation is one piece with ``whole``. ``times`` names a column that says how often a row stands.
    """
    given = rows.select(
        tables.exactly(rows, conversation).alias("conversation"),
        tables.exactly(rows, turn).cast("long").alias("turn"),
        F.coalesce(tables.exactly(rows, role), F.lit(" ")).alias("role"),
        F.coalesce(tables.exactly(rows, text), F.lit(" ")).alias("text"),
        (tables.exactly(rows, times) if times else F.lit(1)).cast("long").alias("times"),
    )
    kind = T.StructField("conversation", given.schema["conversation"].dataType)
    schema = T.StructType([kind, *PIECE, *_OPEN])
    made = tables.written(_ordered(given).mapInArrow(_cut(to_arrow_schema(schema)), schema))
    whole = made.where("whole").select("conversation", *[f.name for f in PIECE])
    return whole.unionByName(_joined_pieces(made, kind))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` with planted faults, and ``times`` each stands: 0 for a dropped row."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    text = F.when(kind == 0, "").otherwise(text)
    role = F.when(kind == 4, "user").otherwise(known("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))


def _digests(pieces: DataFrame) -> DataFrame:
    """``(conversation, digest)`` of conversations of several pieces; one piece is in memory at a time."""
    kind = pieces.schema["conversation"]
    schema = T.StructType([kind, T.StructField("digest", T.StringType())])
    arrow = to_arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, own, begun, some = None, None, False, False

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conversation": own, "digest": found.hexdigest()}], schema=arrow)

        for batch in batches:
            for conversation, rows in zip(batch.column("conversation").to_pylist(), batch.column("repaired"), strict=True):
                if not begun or conversation != own:
                    if begun:
                        yield ended()
                    found, own, begun, some = hashlib.sha256(), conversation, True, False
                for row in rows.as_py():
                    found.update(f"{chr(10) if some else ''}{row['role']}:{row['text']}".encode())
                    some = True
        if begun:
            yield ended()

    n = tables.parts(pieces.sparkSession)
    return pieces.select("conversation", "piece", "repaired").repartition(n, "conversation").sortWithinPartitions("conversation", "piece").select("conversation", "repaired").mapInArrow(digest, schema)


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = damaged(tables.table(spark, folder, "conversations", "conv_id", "turn", "role", "text"))
    pieces = tables.written(repair(rows, times="times"))
    names = [f.name for f in _STATS]
    joined = F.array_join(F.transform("repaired", lambda row: F.concat(row["role"], F.lit(":"), row["text"])), "\n")
    whole = pieces.where("whole").select("conversation", *names, "audit", F.sha2(joined, 256).alias("repaired_sha256"))
    several = pieces.where("NOT whole")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "")
    summed = several.groupBy("conversation").agg(*[F.sum(name).alias(name) for name in names], audit.alias("audit"))
    digests = _digests(several).select(F.col("conversation").alias("own"), F.col("digest").alias("repaired_sha256"))
    split = summed.join(digests, F.col("conversation").eqNullSafe(F.col("own"))).drop("own")
    return whole.unionByName(split).withColumnRenamed("conversation", "conv_id")
