"""Conversation structure repair by weighted interval parsing (CYK).

A repaired conversation is an optional system turn and then pairs of a user's and an
assistant's turn: initials ``(s?(ua)+)?``. The nonterminals of the repair grammar, in
Chomsky normal form, are the pairs of states of that language's automaton:

* ``[p,r] -> [p,q] [q,r]`` for all states p, q, r;
* ``[p,p] -> row`` deletes the row, ``[p,q] -> row`` keeps it or gives it another role;
* ``[p,q] ->`` nothing inserts turns; its closure is taken into the cells of single rows
  on both sides, so that no longer span needs it.

A cell holds for each nonterminal the least (cost, audit) of its span, the audit being
the initials of its edits. Cells are combined bottom-up by span length. Equal costs of
one cell never have audits of which one begins the other (it would hold more
insertions), so the least audit of a span is made of least audits of its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlens.llm.common import same, written

#: Rows of a conversation that share one chart of all spans and all splits. Above them
#: spans double in length, each split once: any split of a span derives its cell.
WIDTH = 8
#: Rows of a conversation that one task parses.
BLOCK = 4096
#: Spans of row symbols whose cells a task remembers.
REMEMBERED = 200_000

STATES = range(4)
START, ACCEPTED = 0, (0, 3)
#: state and initial to the next state: nothing yet, after s, after u, after a
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

Cell = dict[tuple[int, int], tuple[int, str]]


def _least(cell: Cell, key: tuple[int, int], cost: int, audit: str) -> None:
    if key not in cell or (cost, audit) < cell[key]:
        cell[key] = cost, audit


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: every rule [p,r] -> [p,q] [q,r]."""
    out: Cell = {}
    for (p, q), (cost, audit) in left.items():
        for r in STATES:
            if (q, r) in right:
                more, rest = right[q, r]
                _least(out, (p, r), cost + more, audit + rest)
    return out


def _insertions() -> Cell:
    """The least insertions that lead from one state to another."""
    found: Cell = {(p, p): (0, "") for p in STATES}
    for (p, initial), q in MOVES.items():
        if initial in ROLES:
            found[p, q] = INSERT, "I"
    for _ in STATES:
        for key, best in join(found, found).items():
            _least(found, key, *best)
    return found


INSERTIONS = _insertions()


def row_cell(symbol: str) -> Cell:
    """The cell of one row, closed under insertions.

    ``d`` is a row that has to go; else the symbol is the role's initial (x: another
    one), in upper case where the row is truncated.
    """
    cell: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if symbol != "d":
        extra = TRUNCATED if symbol.isupper() else 0
        for (p, initial), q in MOVES.items():
            if initial in ROLES:
                _least(cell, (p, q), REROLE + extra, "R")
            if initial == symbol.lower():
                _least(cell, (p, q), extra, "K")
    return join(join(INSERTIONS, cell), INSERTIONS)


class Parser:
    """Cells of strings of row symbols; those of short spans are remembered."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.cells: dict[str, Cell] = {}

    def chart(self, symbols: str) -> Cell:
        """The cell of a span of up to ``width`` rows, by all shorter spans and all splits."""
        if len(self.cells) > REMEMBERED:
            self.cells.clear()
        for length in range(1, len(symbols) + 1):
            for start in range(len(symbols) - length + 1):
                span = symbols[start : start + length]
                if span in self.cells:
                    continue
                if length == 1:
                    self.cells[span] = row_cell(span)
                    continue
                best: Cell = {}
                for cut in range(1, length):
                    for key, found in join(self.cells[span[:cut]], self.cells[span[cut:]]).items():
                        _least(best, key, *found)
                self.cells[span] = best
        return self.cells[symbols]

    def parse(self, symbols: Iterator[str]) -> Cell:
        """The cell of a span of one row or more, whose symbols come one by one."""
        short = iter(lambda: "".join(islice(symbols, self.width)), "")
        return joined(self.chart(s) for s in short)


def joined(cells: Iterator[Cell]) -> Cell:
    """The cell of neighbouring spans: two of a level make one of the next."""
    levels: list[Cell | None] = []
    for cell in cells:
        at = 0
        while at < len(levels) and levels[at] is not None:
            cell, levels[at] = join(levels[at], cell), None
            at += 1
        levels[at : at + 1] = [cell]
    rest = [c for c in levels if c is not None]
    return reduce(lambda right, left: join(left, right), rest)


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the cheapest repair, of those the least audit."""
    return min(cell[START, end] for end in ACCEPTED if (START, end) in cell)


class Replay:
    """Carries out an audit on a conversation's rows, which come one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _new(self) -> str:
        initial = "a" if (self.state, "a") in MOVES else "u"
        self.state = MOVES[self.state, initial]
        return ROLES[initial]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._new(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = MOVES[self.state, role[0]]
            yield role, text
        elif edit == "R":
            yield self._new(), text


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """The rows of sorted batches by their first columns, one by one."""
    rows = chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns)) for batch in batches)
    return groupby(rows, key=lambda row: row[:keys])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, 1000)):
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in some], schema)


def _block_cells(kind: pa.DataType, width: int):
    """Arrow function of sorted rows (conv, block, symbol): the cell of each block."""
    entry = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    schema = pa.schema([("conv", kind), ("block", pa.int64()), ("cell", pa.list_(entry))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(width)
        return _batches(
            (
                (*key, [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in
                        parser.parse(r[2] for r in rows).items()])
                for key, rows in _groups(batches, 2)
            ),
            schema,
        )

    return parse


def _best_repairs(kind: pa.DataType):
    """Arrow function of sorted rows (conv, cell): cost and audit of each conversation."""
    schema = pa.schema([("conv", kind), ("cost", pa.int64()), ("audit", pa.string())])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = lambda rows: ({(e["p"], e["q"]): (e["cost"], e["audit"]) for e in r[1]} for r in rows)
        return _batches(
            ((*key, *cheapest(joined(cells(rows)))) for key, rows in _groups(batches, 1)), schema
        )

    return combine


def replayed(rows: Iterator[tuple]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) of rows (conv, audit, role, text), of which the first has the audit."""
    replay = Replay(next(rows)[1])
    for _, _, role, text in rows:
        yield from replay.row(role, text)
    yield from replay.inserted()


def _digest(turns: Iterator[tuple[str, str]]) -> str:
    digest = hashlib.sha256()
    for n, (role, text) in enumerate(turns):
        digest.update((("\n" if n else "") + f"{role}:{text}").encode())
    return digest.hexdigest()


def _repairing(kind: pa.DataType, hashed: bool):
    """Arrow function of sorted rows (conv, audit, role, text), the audit before its rows.

    Gives the repaired rows, or the SHA-256 of each conversation's, so that no
    conversation is held as a whole.
    """
    more = {"repaired_sha256": pa.string()} if hashed else {"place": pa.int64(), "role": pa.string(), "text": pa.string()}
    schema = pa.schema([("conv", kind), *more.items()])

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = ((key, replayed(rows)) for key, rows in _groups(batches, 1))
        if hashed:
            return _batches(((*key, _digest(turns)) for key, turns in done), schema)
        return _batches(((*key, n, *t) for key, turns in done for n, t in enumerate(turns, 1)), schema)

    return repair


def turns(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text`` of the rows; a null role or text is one space."""
    return rows.select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )


def marks(rows: DataFrame) -> DataFrame:
    """Each row's place in its conversation, first fault and symbol, without its text."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    whole = Window.partitionBy("conv").orderBy(*order)
    equal = Window.partitionBy("conv", "role", "text").orderBy("place")
    initial, before = F.substring("role", 1, 1), F.lag(F.substring("role", 1, 1)).over(whole)
    seen, text = F.row_number().over(equal) > 1, F.col("text")
    fault = (
        F.when(~F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), "blank")
        .when(seen, "duplicate")
        .when(~F.regexp_like(text, F.lit(r"[.!?][\x20\x09-\x0D]*\z")), "truncated")
    )
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    placed = rows.repartition("conv").select(
        "conv",
        "turn",
        "role",
        "text",
        F.row_number().over(whole).alias("place"),
        (before.isNotNull() & ~F.concat(before, initial).isin("su", "ua", "au")).alias("illegal"),
        (F.col("turn").isNotNull() & ~same(F.lag("turn").over(whole), F.col("turn"))).alias("opens"),
    )
    return placed.select("*", fault.alias("fault"), known.alias("known")).select(
        "conv",
        "turn",
        "place",
        "illegal",
        "opens",
        "fault",
        F.when(F.col("fault").isin("blank", "duplicate"), "d")
        .when(F.col("fault") == "truncated", F.upper("known"))
        .otherwise(F.col("known"))
        .alias("symbol"),
    )


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _replayed(rows: DataFrame, audits: DataFrame, hashed: bool) -> DataFrame:
    """The audits carried out on the rows, in each task by order of (conv, turn, role, text)."""
    heads = audits.select(
        "conv", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), "audit", F.lit(0).alias("kind"),
    )
    both = rows.withColumns({"audit": F.lit(None).cast("string"), "kind": F.lit(1)}).unionByName(heads)
    dealt = both.repartition("conv").sortWithinPartitions(
        "conv", "kind", F.col("turn").asc_nulls_first(), "role", "text"
    )
    name = rows.schema["conv"].dataType.simpleString()
    kind = f"conv {name}, " + ("repaired_sha256 string" if hashed else "place long, role string, text string")
    return dealt.select("conv", "audit", "role", "text").mapInArrow(
        _repairing(_arrow_type(rows, "conv"), hashed), kind
    )


def audits(rows: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """``conv``, its faults, and the ``cost`` and ``audit`` of its cheapest repair.

    ``rows`` are what ``turns`` gives. A conversation's rows are taken by turn (nulls
    first), then role and text; null ids are one conversation. A row's first fault
    counts: blank, duplicate (role and text seen earlier) or truncated. An empty role has
    no initial and can't be kept. Edits in the audit: Keep, Rerole, Delete, Insert; of
    equal costs the least audit in ASCII. Long conversations are parsed in blocks of
    ``block`` rows, dealt to tasks, whose cells are then joined. An empty table gives no
    rows.
    """
    marked = written(marks(rows), "repair-marks")
    n = lambda c: F.count(F.when(c, 1))
    faults = marked.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - n(F.col("opens")), F.lit(0)).cast("long").alias("gaps"),
        *[n(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        n(F.col("illegal")).alias("illegal"),
    )
    name, kind = rows.schema["conv"].dataType.simpleString(), _arrow_type(rows, "conv")
    symbols = marked.select("conv", F.floor((F.col("place") - 1) / block).alias("block"), "place", "symbol")
    cells = (
        symbols.repartition("conv", "block")
        .sortWithinPartitions("conv", "block", "place")
        .select("conv", "block", "symbol")
        .mapInArrow(
            _block_cells(kind, width),
            f"conv {name}, block long, cell array<struct<p: int, q: int, cost: long, audit: string>>",
        )
    )
    parsed = (
        cells.repartition("conv")
        .sortWithinPartitions("conv", "block")
        .select("conv", "cell")
        .mapInArrow(_best_repairs(kind), f"conv {name}, cost long, audit string")
        .withColumnRenamed("conv", "conv_")
    )
    return faults.join(parsed, same(F.col("conv"), F.col("conv_"))).drop("conv_")


def repair(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text``, places from 1.

    Inserted turns have an empty text. A conversation of which all rows are deleted has no
    row here. Other columns are not read. Ties, nulls and empty tables as in ``audits``.
    """
    taken = turns(rows, id_col, turn_col, role_col, text_col)
    found = written(audits(taken), "repair-audits")
    return _replayed(taken, found, hashed=False).withColumnRenamed("conv", "conv_id")


def report(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id``, faults, cost, audit and ``repaired_sha256``, one row for each conversation.

    The digest is of the repaired ``role:text``, joined by newlines. As SHA-256 is
    sequential, a conversation's rows pass through one task, in order and batch by
    batch; besides the audit, nothing that grows with a conversation is held.
    """
    taken = turns(rows, id_col, turn_col, role_col, text_col)
    found = written(audits(taken), "repair-audits")
    hashes = _replayed(taken, found, hashed=True).withColumnRenamed("conv", "conv_")
    return found.join(hashes, same(F.col("conv"), F.col("conv_"))).drop("conv_").withColumnRenamed("conv", "conv_id")


def damaged(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The rows with faults that the CRC-32 of ``id:turn`` decides; nulls are one space.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats
    the row and 4 makes it a user's.
    """
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (id_col, turn_col)]
    by = F.pmod(F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")), F.lit(20))
    text = F.coalesce(F.col(text_col), F.lit(" "))
    return rows.where(by != 0).select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(by == 4, "user").otherwise(F.coalesce(F.col(role_col), F.lit(" "))).alias("role"),
        F.when(by == 1, "")
        .when(by == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(by == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
