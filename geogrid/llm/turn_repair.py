"""Repair of conversations at least cost, by block tables of normalised cost vectors (Four Russians).

The rows of a conversation, by turn, are a string over nine symbols (must go; or initial of the role, with
or without an end to its text). Edits turn the initials into ``(s?(ua)+)?``, an automaton of four states:
the costs still to come, one for each state, are a vector, and what is left of it when its least element is
taken off is one of few. The vector before any block of ``BLOCK`` symbols is looked up, given the vector after it.

One shuffle brings conversations together. Then two streams run over sorted rows: from the last row to the
first, which notes the vector at the right edge of each row's block, and from the first row to the last, which
expands each block backward from that edge and takes the first letter, in ASCII order, that keeps the cost
least. Equally cheap audits are never prefixes of each other (each holds one letter per row and each insertion
costs), so that choice gives the least string. Neither stream holds more than one block of rows, however long a
conversation is. The hash of a repaired conversation is a chain over its bytes, so one task reads it in order.

Null roles and texts are one space. Rows of one turn stand by role, text; nulls come first; a null ``conv_id`` is a
conversation of its own. Rows that are alike in all columns are copies, later ones duplicates. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geogrid.llm.session import bounded_batches

#: Symbols looked up at once.
BLOCK = 4
#: Costs of the edits and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. NEXT: where a user or assistant row leads, whichever fits.
NEXT, END = (2, 2, 3, 2), (0, 10, 5, 0)
#: By state, the role that fits.
FITS = ("user", "user", "assistant", "user")
INITIALS = {"s": 0, "u": 1, "a": 2}
SYMBOLS = 9
SPACES = r"\x20\x09-\x0D"


def _kept(state: int, initial: int) -> int | None:
    """The state after keeping a row of that initial (0 s, 1 u, 2 a, 3 other), if the pattern allows it."""
    if initial == 0:
        return 1 if state == 0 else None
    return NEXT[state] if initial in (1, 2) and (initial == 1) == (state != 2) else None


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits that use up a row of that symbol."""
    out = [("D", DELETE, state)]
    if symbol:
        initial, extra = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2)
        kept = _kept(state, initial)
        if kept is not None:
            out.append(("K", KEEP + extra, kept))
        out.append(("R", REROLE + extra, NEXT[state]))
    return out


def _before(vector: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to come before a row, from those after it."""
    costs = [min(c + vector[to] for _, c, to in _edits(symbol, q)) for q in range(4)]
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """The normalised vectors that occur, what one symbol and what a block of symbols make of each.

    ``block[v, code]``: code is the block's symbols as digits, its last symbol first.
    """

    def __init__(self, block: int = BLOCK):
        self.vectors, self.at, moves = [END], {END: 0}, []
        for v in self.vectors:
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(v, symbol)
                least = min(costs)
                norm = tuple(c - least for c in costs)
                if norm not in self.at:
                    self.at[norm] = len(self.vectors)
                    self.vectors.append(norm)
                row.append((self.at[norm], least))
            moves.append(row)
        self.size = block
        self.step = np.array([[m[0] for m in row] for row in moves], np.int32)
        self.added = np.array([[m[1] for m in row] for row in moves], np.int32)
        self.block = np.arange(len(self.vectors), dtype=np.int32)[:, None]
        for _ in range(block):
            self.block = self.step[self.block].reshape(len(self.vectors), -1)

    def letters(self, edge: int, symbols: list[int], state: int) -> tuple[list[str], int]:
        """The letters of a block, least in ASCII order among the cheapest, and the state after it."""
        after = [edge]
        for s in reversed(symbols):
            after.append(int(self.step[after[-1], s]))
        out = []
        for k, s in enumerate(symbols):
            here, then = self.vectors[after[len(symbols) - k]], self.vectors[after[len(symbols) - k - 1]]
            added = int(self.added[after[len(symbols) - k - 1], s])
            while True:
                options = sorted([*((x, c + then[to] - added, to) for x, c, to in _edits(s, state)), ("I", INSERT + here[NEXT[state]], NEXT[state])])
                letter, _, state = next(o for o in options if o[1] == here[state])
                out.append(letter)
                if letter != "I":
                    break
        return out, state


@cache
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, gone), damaged by crc32 of ``conv_id:turn`` modulo 20.

    0: the row goes (it stays as a mark of its conversation, ``gone``, without role and text), 1: empty text, 2: the text
    without ``.!?``, 3: twice, 4: role user.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind != 0, F.when(kind == 4, "user").otherwise(blank("role"))).alias("role"),
        F.when(kind != 0, text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form of ``damage``."""
    return conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(False).alias("gone"))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: each row's first of blank, duplicate, truncated, or null; and ``nth`` of its equals.

    All rows of a conversation end up in one partition.
    """
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn")))
    fault = (
        F.when(F.col("gone"), None)
        .when(~F.col("text").rlike(f"[^{SPACES}]"), "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.col("text").rlike(rf"[.!?][{SPACES}]*\z"), "truncated")
    )
    return rows.repartition("conv_id").withColumn("nth", nth).withColumn("fault", fault)


def _symbol(gone: bool, role: str, fault: str | None) -> int:
    if gone:
        return -1
    if fault in ("blank", "duplicate"):
        return 0
    return 1 + 2 * INITIALS.get(role[:1], 3) + (fault == "truncated")


_NONE = object()


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows from last to first, with their symbol, the vector at the right edge of their block and their place from it."""
    t, conv, edge, block = tables(), _NONE, 0, []
    for batch in batches:
        found = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "gone", "role", "fault"))
        for own, gone, role, fault in zip(*columns, strict=True):
            if own != conv:
                conv, edge, block = own, 0, []
            symbol = _symbol(gone, role, fault)
            if len(block) == t.size:
                edge, block = int(t.block[edge, int("".join(map(str, block)), SYMBOLS)]), []
            found.append((symbol, edge, len(block)))
            if symbol >= 0:
                block.append(symbol)
        more = np.array(found, np.int32).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(more[:, k]) for k in range(3))], [*batch.schema.names, "symbol", "edge", "place"])


class _Stream:
    """A conversation from its first row to its last."""

    def __init__(self, conv):
        self.conv, self.state, self.rows, self.last = conv, 0, [], None
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.turns, self.least, self.most = 0, None, None

    def add(self, turn, role, text, fault, symbol, edge, place) -> list[tuple[str, str | None, str | None]]:
        """Takes a row; the (edit, role, text) that are now settled. Deleted rows have neither role nor text."""
        if symbol < 0:
            return []
        if fault:
            self.count[fault] += 1
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.count["illegal"] += 1
        self.last = role[:1]
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.turns, self.most = self.turns + 1, turn
        self.rows.append((role, text, fault, symbol))
        if place:
            return []
        letters, after = tables().letters(edge, [r[3] for r in self.rows], self.state)
        out, rows = [], iter(self.rows)
        for x in letters:
            role, text, fault, _ = next(rows) if x != "I" else (None, "", None, None)
            if x != "D":
                self.count["cost"] += TRUNCATED * (fault == "truncated")
                new = 1 if x == "K" and self.state == 0 and role[:1] == "s" else NEXT[self.state]
                role = role if x == "K" else FITS[self.state]
                self.state = new
            self.count["cost"] += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[x]
            out.append((x, None, None) if x == "D" else (x, role, text))
        assert self.state == after
        self.rows = []
        return out

    def end(self) -> list[tuple[str, str, str]]:
        """The insertions that close the conversation."""
        out = []
        while END[self.state]:
            out.append(("I", FITS[self.state], ""))
            self.count["cost"] += INSERT
            self.state = NEXT[self.state]
        return out

    @property
    def gaps(self) -> int:
        return min(self.most - self.least + 1 - self.turns, 2**63 - 1) if self.turns else 0


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Stream, list, bool]]:
    """(conversation, edits settled by a row, whether it has ended) over rows from first to last."""
    one = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "symbol", "edge", "place"))
        for conv, *row in zip(*columns, strict=True):
            if one is None or conv != one.conv:
                if one is not None:
                    yield one, one.end(), True
                one = _Stream(conv)
            yield one, one.add(*row), False
    if one is not None:
        yield one, one.end(), True


def _audited(rows: DataFrame) -> DataFrame:
    """Rows of ``damage`` or ``undamaged``, each conversation together and from first to last, with block edges."""
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text", "nth")]
    back = [F.desc_nulls_last(c) for c in ("conv_id", "turn", "role", "text", "nth")]
    marked = faults(rows)
    known = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields)
    edges = bounded_batches(marked.sortWithinPartitions(*back), _edges, f"{known}, symbol int, edge int, place int")
    return edges.sortWithinPartitions(*order)


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def report(rows: DataFrame) -> DataFrame:
    """A row for each conversation of ``damage`` or ``undamaged``: counts of faults, cost, audit and hash of the repair.

    A conversation without rows has zeros, an empty audit and the hash of nothing; gaps stop at 2**63 - 1.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, audit, digest, empty = [], [], hashlib.sha256(), True
        for one, edits, over in _streams(batches):
            for letter, role, text in edits:
                audit.append(letter)
                if letter != "D":
                    digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                    empty = False
            if over:
                done.append((one.conv, one.gaps, *one.count.values(), "".join(audit), digest.hexdigest()))
                audit, digest, empty = [], hashlib.sha256(), True
                if len(done) == 1024:
                    yield _batch(done, schema)
                    done = []
        if done:
            yield _batch(done, schema)

    schema = _arrow(rows, REPORT)
    return bounded_batches(_audited(rows), run, f"conv_id {kind}, {REPORT}")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place from 0, edit, role, text)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = "place long, edit string, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place, held = [], 0, 0
        for one, edits, over in _streams(batches):
            for letter, role, text in edits:
                if letter != "D":
                    out.append((one.conv, place, letter, role, text))
                    place, held = place + 1, held + len(text)
            place = 0 if over else place
            if held > 1 << 20 or len(out) >= 1024:
                yield _batch(out, schema)
                out, held = [], 0
        if out:
            yield _batch(out, schema)

    schema = _arrow(rows, names)
    return bounded_batches(_audited(rows), run, f"conv_id {kind}, {names}")


def _arrow(rows: DataFrame, names: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([("conv_id", to_arrow_type(rows.schema["conv_id"].dataType)), *((n, kinds[k]) for n, k in (x.split() for x in names.split(", ")))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(itertools.zip_longest(*rows), schema, strict=True)], schema=schema)
