"""Cheapest repair of a conversation's turn structure by Four-Russians block tables.

A conversation should read ``(s?(ua)+)?`` in its roles' initials. Turns are kept, given another role, deleted or put in,
each at a cost; the cost of everything behind a turn, by what the turn follows, is a vector over four states. Differences
within such a vector are bounded, so after taking off its least entry only a few vectors exist. Each turn is one of ten
symbols, and a table holds, for every vector and every block of three symbols, the vector in front of the block and what
was taken off. Conversations are worked from the end by one lookup a block. Edits are then read from the front: a block is
expanded backward from the vector behind it, and of the edits that lie on a cheapest way the first in the alphabet is
taken, so that ties fall the same way wherever blocks or chunks begin.

Turns are put in order by ranges of (conversation, turn), so a conversation of any length is spread over many tasks. A
conversation that lies inside one task is finished there. The others are cut into chunks; a chunk's table over all vectors
and states is enough to tell what lies behind and before each, and their edits are then found chunk by chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardrisk.session import materialise

# ---- fixed values: costs of edits, white space, ends of sentences --------------------------
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]
# --------------------------------------------------------------------------------------------

#: Turns and characters of one chunk.
CHUNK_TURNS, CHUNK_CHARS = 16_384, 4_000_000
#: Symbols of a block.
BLOCK = 3
#: Symbols: nothing, a turn that must go, then the four kinds of role, and these again for turns that are cut off.
NOTHING, GONE, KINDS = 0, 1, 4
SYMBOLS = 2 + 2 * KINDS
SYSTEM, USER, ASSISTANT, OTHER = range(KINDS)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: States: nothing yet, behind a system turn, behind a user turn, behind an assistant turn; and what each wants next.
STATES, START = 4, 0
WANTED = [2, 2, 3, 2]
ROLE_OF = {2: "user", 3: "assistant"}
AT_END = (0, 2 * INSERT, INSERT, 0)


def _kept(state: int, kind: int) -> int | None:
    """The state behind a turn that is kept, where it may be."""
    if kind == SYSTEM:
        return 1 if state == START else None
    return {USER: 2, ASSISTANT: 3}.get(kind) if WANTED[state] == {USER: 2, ASSISTANT: 3}.get(kind) else None


def _choices(symbol: int, state: int, behind: tuple) -> list[tuple[str, int, int]]:
    """(edit, whole cost, state behind) of the ways to treat a turn, in the order of the edits' letters."""
    found = [("D", DELETE + behind[state], state)]
    if symbol != GONE:
        kind, extra = (symbol - 2) % KINDS, CUT_OFF if symbol >= 2 + KINDS else 0
        if (to := _kept(state, kind)) is not None:
            found.append(("K", extra + behind[to], to))
        found.append(("R", REROLE + extra + behind[WANTED[state]], WANTED[state]))
    return found


def _before(symbol: int, behind: tuple) -> tuple:
    """Costs in front of a turn from those behind it; turns may be put in before it."""
    if symbol == NOTHING:
        return behind
    cost = [min(c for _, c, _ in _choices(symbol, q, behind)) for q in range(STATES)]
    for _ in range(2):
        cost = [min(cost[q], INSERT + cost[WANTED[q]]) for q in range(STATES)]
    return tuple(cost)


class Tables:
    """Transitions of normalised cost vectors for single symbols and for whole blocks."""

    def __init__(self):
        self.vectors, number = [AT_END], {AT_END: 0}
        after, taken = [], []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                cost = _before(symbol, vector)
                normal = tuple(c - min(cost) for c in cost)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((number[normal], min(cost)))
            after.append([n for n, _ in row])
            taken.append([t for _, t in row])
        self.count = len(self.vectors)
        self._next, self._taken = np.asarray(after), np.asarray(taken)
        ways = [[[self._way(v, s, q) for q in range(STATES)] for s in range(SYMBOLS)] for v in self.vectors]
        self._letters = [[[w[0] for w in of] for of in row] for row in ways]
        self._exit = np.asarray([[[w[1] for w in of] for of in row] for row in ways])

        blocks = np.arange(SYMBOLS**BLOCK)
        self._digits = [blocks // SYMBOLS ** (BLOCK - 1 - i) % SYMBOLS for i in range(BLOCK)]
        behind = np.repeat(np.arange(self.count)[:, None], len(blocks), 1)
        inner, off = [behind], np.zeros_like(behind)
        for symbols in reversed(self._digits):
            off = off + self._taken[inner[0], symbols]
            inner.insert(0, self._next[inner[0], symbols])
        self.block_next, self.block_taken = inner[0], off
        states = np.broadcast_to(np.arange(STATES), (*behind.shape, STATES))
        for at, symbols in zip(inner[1:], self._digits):
            states = self._exit[at[..., None], symbols[:, None], states]
        self.block_exit = states
        self._next_rows = self.block_next.tolist()
        self._taken_rows = self.block_taken.tolist()

    def _way(self, behind: tuple, symbol: int, state: int) -> tuple[str, int]:
        """The edits of one turn, those put in before it too, and the state behind: of equal costs the least letter."""
        if symbol == NOTHING:
            return "", state
        before, letters = _before(symbol, behind), ""
        while True:
            options = _choices(symbol, state, behind)
            options.insert(1, ("I", INSERT + before[WANTED[state]], WANTED[state]))
            letter, _, state = next(o for o in options if o[1] == before[state])
            letters += letter
            if letter != "I":
                return letters, state

    @lru_cache(maxsize=1 << 16)  # noqa: B019 - one instance per worker
    def expand(self, behind: int, block: int, state: int) -> tuple[str, int]:
        """The edits of a block and the state behind it; its inner vectors are found backward from the one behind."""
        symbols = [int(d[block]) for d in self._digits]
        inner = [behind]
        for symbol in reversed(symbols[1:]):
            inner.insert(0, int(self._next[inner[0], symbol]))
        letters = ""
        for symbol, vector in zip(symbols, inner):
            letters += self._letters[vector][symbol][state]
            state = int(self._exit[vector, symbol, state])
        return letters, state

    def blocks(self, symbols: bytes) -> list[int]:
        digits = np.frombuffer(symbols + bytes(-len(symbols) % BLOCK), np.uint8).reshape(-1, BLOCK).astype(np.int64)
        return (digits @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()

    def trace(self, symbols: bytes, behind: int, state: int) -> tuple[str, int, int, int]:
        """Edits, state behind, vector in front and what was taken off on the way, of a run of turns."""
        blocks, vectors, off = self.blocks(symbols), [behind], 0
        for block in reversed(blocks):
            off += self._taken_rows[vectors[-1]][block]
            vectors.append(self._next_rows[vectors[-1]][block])
        letters = []
        for i, block in enumerate(blocks):
            found, state = self.expand(vectors[len(blocks) - 1 - i], block, state)
            letters.append(found)
        return "".join(letters), state, vectors[-1], off

    def summary(self, symbols: bytes) -> tuple[list[int], list[int], list[int]]:
        """For every vector behind a run of turns: the vector in front, what was taken off, the state behind by that before."""
        blocks, vectors, off = self.blocks(symbols), [np.arange(self.count)], np.zeros(self.count, np.int64)
        for block in reversed(blocks):
            off = off + self.block_taken[vectors[-1], block]
            vectors.append(self.block_next[vectors[-1], block])
        states = np.broadcast_to(np.arange(STATES), (self.count, STATES))
        for i, block in enumerate(blocks):
            states = self.block_exit[vectors[len(blocks) - 1 - i][:, None], block, states]
        return vectors[-1].tolist(), off.tolist(), states.ravel().tolist()

    @staticmethod
    def ending(state: int) -> str:
        """Turns put in behind the last."""
        return "I" * (AT_END[state] // INSERT)


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def apply_edits(letters: str, roles: list[str], texts: list[str], state: int) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of each edit; a deleted turn has neither."""
    at = 0
    for letter in letters:
        if letter == "I":
            state = WANTED[state]
            yield "I", ROLE_OF[state], ""
            continue
        role, text = roles[at], texts[at]
        at += 1
        if letter == "D":
            yield "D", None, None
        elif letter == "R":
            state = WANTED[state]
            yield "R", ROLE_OF[state], text
        else:
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            yield "K", role, text


def _same(left: str, right: str, names: list[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def _rows(turns: DataFrame) -> DataFrame:
    """Distinct turns with their copies, whether any came before with their role and text, and their symbol."""
    space = F.lit(" ")
    plain = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
                         F.coalesce("text", space).alias("text"))
    keyed = plain.withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = keyed.groupBy("conv_id", "turn", "role", "digest").agg(F.count("*").alias("copies"), F.min("text").alias("text"))
    # A null turn comes first, as it does among values of a structure.
    firsts = keyed.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("least")).select(
        "conv_id", "role", "digest", F.col("least.turn").alias("turn"), F.lit(True).alias("first"))
    names = ["conv_id", "turn", "role", "digest"]
    marked = rows.alias("r").join(firsts.alias("f"), _same("r", "f", names), "left").select(
        "r.*", F.col("f.first").isNotNull().alias("first"))
    written = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    cut_off = ~F.substring(written, -1, 1).isin(ENDS)
    blank = written == ""
    symbol = F.when(blank | ~F.col("first"), GONE).otherwise(2 + kind + F.when(cut_off, KINDS).otherwise(0))
    return materialise(marked.select(*names, F.substring("text", 1, 128).alias("begin"), "text", "copies", "first",
                                     blank.alias("blank"), kind.cast("int").alias("kind"), symbol.cast("int").alias("symbol")))


class _Run:
    """Turns of a conversation gathered for one chunk."""

    def __init__(self, most_turns: int, most_chars: int):
        self.most_turns, self.most_chars = most_turns, most_chars
        self.symbols, self.roles, self.texts, self.kinds = bytearray(), [], [], []
        self.counts, self.turns, self.chars = [0, 0, 0], [], 0

    def add(self, turn, role, text, symbol, kind, fault) -> None:
        self.symbols.append(symbol)
        gone = symbol == GONE
        self.roles.append(None if gone else role)
        self.texts.append(None if gone else text)
        self.kinds.append(kind)
        self.chars += 0 if gone else len(text)
        if fault is not None:
            self.counts[fault] += 1
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def full(self) -> bool:
        return len(self.symbols) >= self.most_turns or self.chars >= self.most_chars

    def stats(self) -> dict:
        illegal = sum(pair not in LEGAL for pair in zip(self.kinds, self.kinds[1:]))
        return dict(zip(("blank", "duplicate", "truncated"), self.counts), illegal=illegal, first_kind=self.kinds[0],
                    last_kind=self.kinds[-1], least=self.turns[0] if self.turns else None,
                    most=self.turns[-1] if self.turns else None, distinct=len(self.turns))


def _kind_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


EDIT = "array<struct<edit: string, role: string, text: string>>"
STATS = ["blank", "duplicate", "truncated", "illegal", "first_kind", "last_kind", "least", "most", "distinct"]


def _chunks(rows: DataFrame, most_turns: int, most_chars: int) -> DataFrame:
    """One row per chunk, numbered in the order of turns; conversations that lie within a task have their edits."""
    order = ["conv_id", "turn", "role", "begin", "digest"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "turn", "role", "text", "copies", "first", "blank", "kind", "symbol")
    schema = T.StructType([T.StructField("conv_id", _kind_of(rows, "conv_id"))]).add("chunk", "long").add("split", "boolean")
    for name in ("cost", *STATS):
        schema = schema.add(name, "long")
    schema = schema.add("edits", T.DataType.fromDDL(EDIT)).add("symbols", "binary")
    for name, kind in (("roles", "string"), ("texts", "string"), ("before", "int"), ("taken", "int"), ("exits", "int")):
        schema = schema.add(name, T.DataType.fromDDL(f"array<{kind}>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        table, arrow = tables(), to_arrow_schema(schema)
        number = TaskContext.get().partitionId() << 32
        held: list[dict] = []

        def close(conv, gathered: _Run, split: bool) -> None:
            nonlocal number
            row = {"conv_id": conv, "chunk": number, "split": split, **gathered.stats()}
            number += 1
            symbols = bytes(gathered.symbols)
            if split:
                before, taken, exits = table.summary(symbols)
                row |= {"symbols": symbols, "roles": gathered.roles, "texts": gathered.texts, "before": before, "taken": taken, "exits": exits}
            else:
                letters, state, front, off = table.trace(symbols, 0, START)
                edits = apply_edits(letters + table.ending(state), gathered.roles, gathered.texts, START)
                row |= {"cost": off + table.vectors[front][START],
                        "edits": [{"edit": e, "role": r, "text": t} for e, r, t in edits]}
            held.append(row)

        gathered, conv, inside, cut, size = None, None, False, False, 0
        for batch in batches:
            for conv_id, turn, role, text, copies, first, blank, kind, symbol in zip(*[c.to_pylist() for c in batch.columns]):
                if gathered is None or conv_id != conv:
                    if gathered is not None:
                        close(conv, gathered, cut or not inside)
                        inside = True
                    gathered, conv, cut = _Run(most_turns, most_chars), conv_id, False
                for copy in range(copies):
                    if gathered.full():
                        close(conv, gathered, True)
                        gathered, cut = _Run(most_turns, most_chars), True
                    fault = 0 if blank else 1 if copy or not first else 2 if symbol >= 2 + KINDS else None
                    gathered.add(turn, role, text, GONE if copy else symbol, kind, fault)
                    if len(held) >= 64:
                        size = sum(len(r.get("symbols") or r["edits"]) for r in held)
                        if size >= CHUNK_TURNS or len(held) >= 2_000:
                            yield pa.RecordBatch.from_pylist(held, arrow)
                            held.clear()
        if gathered is not None:
            close(conv, gathered, True)
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)

    return ordered.mapInArrow(run, schema)


def _places(split: DataFrame) -> DataFrame:
    """chunk, the vector behind it, the state before it and, at a conversation's first chunk, the whole cost.

    A conversation has one small row here for each 16,384 of its turns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, group in groupby(rows, lambda row: row["conv_id"]):
            chunks = list(group)
            behind, off = [0], 0
            for row in reversed(chunks):
                off += row["taken"][behind[-1]]
                behind.append(row["before"][behind[-1]])
            front = behind.pop()
            state, found = START, []
            for i, (row, vector) in enumerate(zip(chunks, reversed(behind))):
                cost = None if i else off + table.vectors[front][START]
                found.append({"chunk": row["chunk"], "behind": vector, "state": state, "last": i == len(chunks) - 1, "whole_cost": cost})
                state = row["exits"][vector * STATES + state]
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema(
                [("chunk", pa.int64()), ("behind", pa.int32()), ("state", pa.int32()), ("last", pa.bool_()), ("whole_cost", pa.int64())]))

    slim = split.select("conv_id", "chunk", "before", "taken", "exits")
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        run, "chunk long, behind int, state int, last boolean, whole_cost long")


def repair(turns: DataFrame, most_turns: int = CHUNK_TURNS, most_chars: int = CHUNK_CHARS) -> DataFrame:
    """conv_id, chunk, split, cost, counts and edits (edit, role, text) of each conversation, in the order of chunk.

    Reads conv_id, turn, role and text; a null role or text is one space, a null id is a conversation like any other.
    Turns stand in the order of turn (nulls first), role, the first 128 characters of the text and its SHA-256. A turn is
    blank without a character that isn't white space, a duplicate where its role and text came before (a repeated row is
    one), else truncated where its last character that isn't white space ends no sentence. Blank and duplicate turns are
    deleted. A conversation whose turns are few and lie in one task is one row, another one row per chunk, of at most
    ``most_turns`` turns and about ``most_chars`` characters, with ``split`` set and its cost at the first. A table without
    rows gives none; other columns are not read.
    """
    chunks = materialise(_chunks(_rows(turns), most_turns, most_chars))
    split = chunks.filter("split")
    placed = split.drop("edits", "cost", "before", "taken", "exits").join(_places(split), "chunk")
    names = ["conv_id", "chunk", "split", "cost", *STATS]
    schema = T.StructType([f for f in chunks.schema if f.name in names] + [chunks.schema["edits"]])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        table, arrow = tables(), to_arrow_schema(schema)
        for batch in batches:
            for row in batch.to_pylist():
                letters, state, _, _ = table.trace(row["symbols"], row["behind"], row["state"])
                letters += table.ending(state) if row["last"] else ""
                edits = apply_edits(letters, row["roles"], row["texts"], row["state"])
                found = {n: row[n] for n in names if n != "cost"} | {"cost": row["whole_cost"] or 0}
                found["edits"] = [{"edit": e, "role": r, "text": t} for e, r, t in edits]
                yield pa.RecordBatch.from_pylist([found], arrow)

    return chunks.filter("not split").select(*names, "edits").unionByName(placed.mapInArrow(finish, schema))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, chunk, place in the chunk, edit, role and text; deleted turns are gone."""
    return repaired.select("conv_id", "chunk", F.posexplode("edits").alias("place", "of")).filter("of.edit <> 'D'").select(
        "conv_id", "chunk", "place", "of.*")


def digest(turns: DataFrame, repaired: DataFrame) -> DataFrame:
    """Per conversation of ``turns``: gaps, faults, illegal pairs, cost, audit and the repaired conversation's SHA-256.

    One that has no rows among the repaired has zeros, an empty audit and the hash of nothing. A split conversation's
    pieces pass through one task in their order, one at a time, since a SHA-256 can't be put together from parts.
    """
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kept = F.filter("edits", lambda e: e["edit"] != "D")
    lines = F.array_join(F.transform(kept, lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n")
    shown = repaired.select("conv_id", "chunk", "split", "cost", *STATS, F.size(kept).alias("kept"), lines.alias("lines"),
                            F.array_join(F.transform("edits", lambda e: e["edit"]), "").alias("audit"))
    # Turn numbers may lie further apart than a long can tell.
    span = F.col("most").cast("decimal(20,0)") - F.col("least") + 1 - F.col("distinct")
    most = F.lit((1 << 63) - 1).cast("decimal(20,0)")
    gaps = F.when(F.col("least").isNull(), F.lit(0).cast("long")).otherwise(F.least(span, most).cast("long"))
    whole = shown.filter("not split").select("conv_id", gaps.alias("gaps"), *columns[1:], "audit",
                                             F.sha2("lines", 256).alias("repaired_sha256"))
    schema = T.StructType([T.StructField("conv_id", _kind_of(repaired, "conv_id"))])
    for name in columns:
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string").add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        rows = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
        for conv, group in groupby(rows, lambda row: row["conv_id"]):
            sums, hashed, audit, written = dict.fromkeys(columns, 0), hashlib.sha256(), [], False
            least = most = last_kind = None
            distinct = 0
            for row in group:
                for name in columns[1:]:
                    sums[name] += row[name]
                if last_kind is not None:
                    sums["illegal"] += (last_kind, row["first_kind"]) not in LEGAL
                last_kind = row["last_kind"]
                if row["least"] is not None:
                    distinct += row["distinct"] - (most == row["least"])
                    least, most = row["least"] if least is None else least, row["most"]
                audit.append(row["audit"])
                if row["kept"]:
                    hashed.update((("\n" if written else "") + row["lines"]).encode())
                    written = True
            sums["gaps"] = 0 if least is None else min(most - least + 1 - distinct, (1 << 63) - 1)
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, **sums, "audit": "".join(audit), "repaired_sha256": hashed.hexdigest()}],
                                             to_arrow_schema(schema))

    joined = shown.filter("split").repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(run, schema)
    every = turns.select("conv_id").distinct().alias("c").join(
        whole.unionByName(joined).alias("r"), F.col("c.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    zero = F.lit(0).cast("long")
    return every.select("c.conv_id", *[F.coalesce(c, zero).alias(c) for c in columns],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
