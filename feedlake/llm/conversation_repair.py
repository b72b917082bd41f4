"""Conversations brought to the grammar ``(system? (user assistant)+)?`` at least cost.

A conversation is its rows by turn.  Rows that are blank or repeat an earlier row are
deleted (3); others are kept (0), given the role user or assistant (2) or deleted (3), a row
that is left and breaks off adds 1, and an empty user or assistant row may be inserted
anywhere (2).  The audit is the string of edits, K, R, D and I, in order.

The rows are aligned to the grammar string of each feasible length by Wagner and Fischer's
table.  Strings of alternating roles have the same ends, so one table over the last r
symbols serves all lengths; Ukkonen's band keeps the cells that can lie below the cost of
an incumbent, a greedy repair, and is widened if no alignment lies within.  Of all lengths
of the least cost the audits are traced, least letter first, and compared.

Audits and tables are made in blocks of :data:`BLOCK` rows: a block is aligned from each
role that can come before it to each that can end it, and blocks are joined in order, the
cheapest and then the least audit for each role.  So a conversation of any length takes
memory for one block and the audits.  The rows of a conversation pass one task in order,
since a SHA-256 is a chain over its text; none are gathered there, and earlier equal rows
are found by a window dealt by their content.

Defined results: a null role or text is one blank, null turns come first, rows of one turn
go by role and text; a null ``conv_id`` is a conversation of its own; other columns are not
used; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import quoted

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
CUT_OFF = 1

BLOCK = 256

_NAMES = {"u": "user", "a": "assistant"}
_AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
_LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"

_FAR = 1 << 28

_RESULT = (
    "conv_id {conv_id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


# What an alignment sees of a row, a letter: the initial of its role (x for any other than
# s, u and a), in upper case if the row breaks off; d if it must go.
_GONE, _OTHER = "d", "x"


class Path(NamedTuple):
    cost: int
    audit: str


def _greedy(rows: str, state: str) -> int:
    """Cost of keeping or rerolling every row that need not go."""
    cost = COST[DELETE] * rows.count(_GONE)
    for row in rows.replace(_GONE, ""):
        if state == "" and row.lower() == "s":
            state = "s"
        else:
            state = _AFTER[state]
            cost += 0 if row.lower() == state else COST[REROLE]
        cost += CUT_OFF * row.isupper()
    return cost + (COST[INSERT] if state == "u" else 2 * COST[INSERT] if state == "s" else 0)


class _Table:
    """Least costs of aligning the rows from i on to the last r symbols of an alternating string.

    ``end`` is its last symbol.  Row i has the cells from ``low[i]`` on, those that a path
    of cost ``limit`` or less can pass.  After the last row of a block that others follow,
    nothing is inserted: that belongs to the next block.
    """

    def __init__(self, rows: str, end: str, last: bool, limit: int):
        self.rows, self.end = rows, end
        spare = limit - COST[DELETE] * rows.count(_GONE)
        fewer, more = max(spare, 0) // COST[DELETE], max(spare, 0) // COST[INSERT]
        index = np.arange(fewer + more + 1)
        slope = COST[INSERT] * index
        left = 0
        self.low = [0] * (len(rows) + 1)
        self.cells: list[list[int]] = [[]] * (len(rows) + 1)
        self.low[len(rows)] = -fewer
        r = index - fewer
        now = np.where(r == 0, 0, np.where((r > 0) & last, COST[INSERT] * r, _FAR))
        self.cells[len(rows)] = now.tolist()
        for i in range(len(rows) - 1, -1, -1):
            row = rows[i]
            if row == _GONE:
                now = now + COST[DELETE]
            else:
                left += 1
                r = index + left - fewer
                wrong = COST[REROLE] * (self._symbols(r) != row.lower())
                match = np.where(r >= 1, now + wrong + CUT_OFF * row.isupper(), _FAR)
                drop = np.append(now[1:], _FAR) + COST[DELETE]
                now = np.minimum(match, drop)
            now = np.minimum(np.minimum.accumulate(now - slope) + slope, _FAR)
            # No string has fewer symbols than none.
            now[: max(0, fewer - left)] = _FAR
            self.low[i] = left - fewer
            self.cells[i] = now.tolist()

    def _symbols(self, r: np.ndarray) -> np.ndarray:
        return np.where(r % 2 == 1, self.end, "a" if self.end == "u" else "u")

    def symbol(self, r: int) -> str:
        return self.end if r % 2 else _AFTER[self.end]

    def cost(self, i: int, r: int) -> int:
        at = r - self.low[i]
        return self.cells[i][at] if 0 <= at < len(self.cells[i]) and r >= 0 else _FAR

    def lengths(self, i: int) -> range:
        return range(max(self.low[i], 0), self.low[i] + len(self.cells[i]))

    def audit(self, i: int, r: int) -> str:
        """The ASCII-least cheapest audit from a cell: D before I before K before R."""
        out = []
        total = self.cost(i, r)
        while i < len(self.rows) or r:
            row = self.rows[i] if i < len(self.rows) else None
            if row is not None and self.cost(i + 1, r) + COST[DELETE] == total:
                out.append(DELETE)
                i, total = i + 1, total - COST[DELETE]
            elif r and self.cost(i, r - 1) + COST[INSERT] == total:
                out.append(INSERT)
                r, total = r - 1, total - COST[INSERT]
            else:
                edit = KEEP if row.lower() == self.symbol(r) else REROLE
                out.append(edit)
                i, r, total = i + 1, r - 1, total - COST[edit] - CUT_OFF * row.isupper()
        return "".join(out)


def _aligned_within(rows: str, start: str, last: bool, limit: int) -> dict[str, Path]:
    """Cheapest least audit for every role that can end the block, of those of cost ``limit`` or less."""
    n = len(rows)
    found: dict[str, Path] = {}

    def offer(state: str, cost: int, audit: str) -> None:
        if state not in found or Path(cost, audit) < found[state]:
            found[state] = Path(cost, audit)

    if not last or start in ("", "a"):
        offer(start, COST[DELETE] * n, DELETE * n)
    systems = [i for i, row in enumerate(rows) if start == "" and row.lower() == "s"]
    for i in systems if not last else ():
        offer("s", COST[DELETE] * (n - 1) + CUT_OFF * rows[i].isupper(), DELETE * i + KEEP + DELETE * (n - 1 - i))
    for end in "a" if last else "ua":
        table = _Table(rows, end, last, limit)
        # Feasible strings: those that begin with the role after ``start``, or with a kept system row.
        begins = [(0, 0, "", _AFTER[start])]
        begins += [(i + 1, COST[DELETE] * i + CUT_OFF * rows[i].isupper(), DELETE * i + KEEP, "u") for i in systems]
        ways = [
            (before + table.cost(i, r), i, r, audit)
            for i, before, audit, first in begins
            for r in table.lengths(i)
            if r and table.symbol(r) == first
        ]
        least = min((way[0] for way in ways), default=_FAR)
        if least < _FAR:
            for cost, i, r, audit in ways:
                if cost == least:
                    offer(end, cost, audit + table.audit(i, r))
    return found


@lru_cache(maxsize=20_000)
def aligned(rows: str, start: str, last: bool) -> dict[str, Path]:
    """Cheapest least audit of a block from the role ``start`` to each role that can end it.

    The last block of a conversation must end the grammar: with an assistant, or with
    nothing at all.
    """
    most = (COST[DELETE] + COST[INSERT]) * (len(rows) + 2)
    # A repair that ends with another role takes at most an insertion and a new role more.
    limit = _greedy(rows, start)
    if not last:
        limit += COST[INSERT] + COST[REROLE]
    while True:
        found = _aligned_within(rows, start, last, limit)
        wanted = {"a"} if last and start != "" else set() if last else {"u", "a"}
        fits = all(end in found and found[end].cost <= limit for end in wanted)
        if (fits and any(path.cost <= limit for path in found.values())) or limit >= most:
            return found
        limit *= 2


class _Fold(NamedTuple):
    """A repair of the blocks so far: its cost, its audits as a chain, and the digest of its text."""

    cost: int
    audits: tuple | None
    digest: object
    begun: bool


def _append(fold: _Fold, texts: list[tuple[str, str]], start: str, path: Path, total: int) -> _Fold:
    digest, begun, state = fold.digest.copy(), fold.begun, start
    rows = iter(texts)
    for edit in path.audit:
        if edit == INSERT:
            role, text = _NAMES[_AFTER[state]], ""
        else:
            role, text = next(rows)
            if edit == DELETE:
                continue
            if edit == REROLE:
                role = _NAMES[_AFTER[state]]
        state = role[:1]
        digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        begun = True
    return _Fold(total, (fold.audits, path.audit), digest, begun)


class _Conversation:
    """Takes rows in order, a block at a time."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.least, self.most, self.turn = 0, None, None, None
        self.before: str | None = None
        self.rows: list[str] = []
        self.texts: list[tuple[str, str]] = []
        self.folds = {"": _Fold(0, None, hashlib.sha256(), False)}
        self.order = {"": 0}

    def take(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if len(self.rows) == BLOCK:
            self._close(False)
        if turn is not None and turn != self.turn:
            self.turns, self.turn, self.most = self.turns + 1, turn, turn
            self.least = turn if self.least is None else self.least
        if self.before is not None and self.before + role[:1] not in _LEGAL:
            self.counts["illegal"] += 1
        self.before = role[:1]
        solid = text.rstrip(_BLANKS)
        fault = "blank" if not solid else "duplicate" if again else "" if solid[-1] in ".!?" else "truncated"
        if fault:
            self.counts[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else _OTHER
        gone = fault in ("blank", "duplicate")
        self.rows.append(_GONE if gone else initial.upper() if fault == "truncated" else initial)
        self.texts.append((role, text))

    def _close(self, last: bool) -> None:
        """Align the block from every role so far and keep the best repair for each role after it."""
        best: dict[str, tuple] = {}
        rows = "".join(self.rows)
        for start, fold in self.folds.items():
            for state, path in aligned(rows, start, last).items():
                # Repairs of the same rows are never the beginning of one another, so the
                # order of the audits so far decides before those of the block.
                way = (fold.cost + path.cost, self.order[start], path.audit)
                if state not in best or way < best[state][0]:
                    best[state] = (way, start, path)
        if last and best:
            state = min(best, key=lambda s: best[s][0])
            best = {state: best[state]}
        folds = {
            state: _append(self.folds[start], self.texts, start, path, way[0])
            for state, (way, start, path) in best.items()
        }
        ranks = sorted(best, key=lambda s: best[s][0][1:])
        self.folds, self.order = folds, {state: i for i, state in enumerate(ranks)}
        self.rows, self.texts = [], []

    def result(self) -> tuple:
        self._close(True)
        (fold,) = self.folds.values()
        audits, chain = [], fold.audits
        while chain is not None:
            chain, audit = chain
            audits.append(audit)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (
            self.conv_id, gaps, *self.counts.values(), fold.cost, "".join(reversed(audits)), fold.digest.hexdigest()
        )


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with planted faults: by the CRC-32 of ``conv_id:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it
    a user's.  ``copies`` says how often a row is there; dropped rows stay, with 0 copies,
    as their conversations do.
    """
    named = F.concat(_text("conv_id"), F.lit(":"), _text("turn"))
    kind = F.crc32(named.cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(_text("text"), "[.!?]", ""))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(_text("role")).alias("role"),
        text.otherwise(_text("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repaired(conversations: DataFrame, *, copies: str | None = None) -> DataFrame:
    """Faults, cost, audit and the digest of the repaired text of every conversation.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; ``copies`` names a
    column that says how many rows each stands for, none or several.
    """
    times = F.lit(1) if copies is None else F.coalesce(F.col(quoted(copies)).cast("int"), F.lit(1))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _text("role").alias("role"),
        _text("text").alias("text"),
        times.alias("copies"),
    )
    # Length of the role first: no two pairs of role and text are written alike.
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    equal = Window.partitionBy("conv_id", "content", F.col("copies") > 0).orderBy(F.col("turn").asc_nulls_first())
    marked = rows.withColumn("content", content).withColumn("again", F.row_number().over(equal) > 1).drop("content")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "again"]
    ordered = marked.repartition("conv_id").sortWithinPartitions(*order)
    schema = _RESULT.format(conv_id=conversations.schema["conv_id"].dataType.simpleString())
    names = [column.split()[0] for column in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for batch in batches:
            done = []
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "copies", "again"))
            for conv_id, turn, role, text, copies, again in zip(*columns):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv_id)
                for copy in range(copies):
                    now.take(turn, role, text, again or copy > 0)
            if done:
                yield _batch(done, batch.schema.field("conv_id").type)
        if now is not None:
            yield _batch([now.result()], batch.schema.field("conv_id").type)

    def _batch(done: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        kinds = [key, *[pa.int64()] * 6, pa.string(), pa.string()]
        arrays = [pa.array(list(column), kind) for column, kind in zip(zip(*done), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return ordered.mapInArrow(run, schema)
