"""Conversation structure repair by weighted CYK interval parsing.

Rows are edited so that their roles read ``(s?(ua)+)?`` by initials: an optional system turn, then
user and assistant in turn. Keeping a row costs nothing, giving it another role 3, deleting it 4,
inserting an empty user or assistant turn 3; a truncated row that isn't deleted costs 3 more;
blank and repeated rows must go.

The repair grammar is in Chomsky normal form. Its nonterminals are the words that an interval of rows
may become, named by first and last initial: none, u..u, u..a, a..u, a..a with user and assistant in
turn, and those that start with a system turn: s, s..u, s..a. A rule joins two that may follow one
another (u..a from u..u and a..a, and so on). A cell holds, for each nonterminal, the least (cost,
audit), the audit being the edits' initials (Keep, Rerole, Delete, Insert). Audits of equal cost are
never the start of one another (what one has more than the other could only be insertions, which
cost), so the least of a joint is made of the least of its parts. Each cell is closed under insertion:
it's joined with the inserted turns on either side until nothing gets cheaper.

Cells are filled bottom-up by span length. Blocks of ``BLOCK`` rows are parsed over all their intervals
and splits. Of longer conversations, neighbouring spans of equal length are joined as soon as both are
there: since the nonterminals name both ends, every word that two spans make together is the joint of
words that they make alone, and one split of the longer span is enough. So the work is linear in
the rows, and a logarithmic number of cells is held.

Rows stream by conversation in two passes, the first without texts to decide, the second with texts
to write the repaired rows; a conversation is never held whole. Its audit is one value, though, and the
digest of its repaired text is computed from front to back in one task.

Null roles and texts read as one space, as a null id or turn does in the key of the damage. Rows go by
turn (nulls first), and of one turn by role, the text's first 64 characters and its digest. Empty, very
long and repeated texts and rows are like any other. A null conversation is one like any other. An empty
table gives an empty result. Other columns are passed over.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import folded, staged

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 8

Best = tuple[int, str]  # cost, audit
Cell = dict[str, Best]

_ENDS = ("uu", "ua", "au", "aa")
#: nonterminal -> the pairs of nonterminals that it may be made of.
RULES: tuple[tuple[str, str, str], ...] = (
    ("", "", ""),
    *((x, x, "") for x in (*_ENDS, "s", "su", "sa")),
    *((x, "", x) for x in (*_ENDS, "s", "su", "sa")),
    *((x[0] + y[1], x, y) for x in _ENDS for y in _ENDS if x[1] != y[0]),
    *((f"s{y[1]}", "s", y) for y in ("uu", "ua")),
    *((f"s{y[1]}", x, y) for x in ("su", "sa") for y in _ENDS if x[1] != y[0]),
)
_BY_LEFT = {left: [(of, right) for of, x, right in RULES if x == left] for left in {r[1] for r in RULES}}


def joined(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """What two neighbouring spans make together, at least cost; the better of ``into`` and that."""
    made = {} if into is None else into
    for x, (cost, audit) in left.items():
        for of, y in _BY_LEFT[x]:
            other = right.get(y)
            if other is not None:
                total = cost + other[0]
                best = made.get(of)
                if best is None or total <= best[0]:
                    found = (total, audit + other[1])
                    if best is None or found < best:
                        made[of] = found
    return made


def _inserted() -> Cell:
    """The cell of no rows at all: nothing, or turns inserted."""
    cell: Cell = {"": (0, ""), "uu": (INSERT, "I"), "aa": (INSERT, "I")}
    while (more := joined(cell, cell, dict(cell))) != cell:
        cell = more
    return cell


NOTHING = _inserted()


def closed(cell: Cell) -> Cell:
    """The cell with turns inserted on either side, where that makes something new or cheaper."""
    while True:
        more = joined(cell, NOTHING, joined(NOTHING, cell, dict(cell)))
        if more == cell:
            return cell
        cell = more


@lru_cache(64)
def leaf(symbol: str) -> Cell:
    """The cell of one row. Its symbol is the role's initial (s, u, a; o for any other), upper-case if
    truncated, or x if it must be deleted.
    """
    cell: Cell = {"": (DELETE, "D")}
    if symbol != "x":
        extra, role = (TRUNCATED if symbol.isupper() else 0), symbol.lower()
        for to in "ua":
            cell[to + to] = (extra, "K") if role == to else (extra + REROLE, "R")
        if role == "s":
            cell["s"] = (extra, "K")
    return closed(cell)


@lru_cache(1 << 14)
def parsed(symbols: str) -> Cell:
    """The cell of a block of rows: all intervals by length, all splits of each."""
    n = len(symbols)
    chart = {(i, i + 1): leaf(symbols[i]) for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = {}
            for split in range(i + 1, i + length):
                joined(chart[i, split], chart[split, i + length], cell)
            chart[i, i + length] = closed(cell)
    return chart[0, n] if n else NOTHING


class Spans:
    """The cells of a growing row of symbols: spans of equal length are joined, as when counting."""

    def __init__(self) -> None:
        self.open, self.spans = [], []

    def add(self, symbol: str) -> None:
        self.open.append(symbol)
        if len(self.open) == BLOCK:
            self._block()

    def _block(self) -> None:
        cell, size = parsed("".join(self.open)), 1
        self.open = []
        while self.spans and self.spans[-1][0] == size:
            cell, size = closed(joined(self.spans.pop()[1], cell)), 2 * size
        self.spans.append((size, cell))

    def best(self) -> Best:
        """Cost and audit of the cheapest repair."""
        cells = [cell for _, cell in self.spans]
        if self.open or not cells:
            cells.append(parsed("".join(self.open)))
        cell = cells.pop()
        while cells:
            cell = closed(joined(cells.pop(), cell))
        return min(cell[x] for x in ("", "ua", "sa") if x in cell)


def best_repair(symbols: str) -> Best:
    """Cost and audit of the cheapest repair of rows given by their symbols."""
    spans = Spans()
    for symbol in symbols:
        spans.add(symbol)
    return spans.best()


def _space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and whether the row is there: rows damaged by a hash of their key."""
    key = F.concat(_space("conv_id"), F.lit(":"), _space("turn"))
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _space("role").alias("role"), _space("text").alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("damage"),
    )
    damage = F.col("damage")
    return rows.select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "")
        .when(damage == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (damage != 0).alias("there"),
        F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the shape of ``damaged``."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _space("role").alias("role"), _space("text").alias("text"),
        F.lit(True).alias("there"),
    )


class Faults:
    """Faults of one conversation and its cheapest repair, from rows without their texts."""

    def __init__(self, key: Any):
        self.key, self.spans, self.before, self.turns = key, Spans(), None, []
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, there: bool, turn: int | None, initial: str, blank: bool, cut: bool, again: bool) -> None:
        if not there:
            return
        if turn is not None and self.turns[1:] != [turn]:
            self.turns = [self.turns[0] if self.turns else turn, turn]
            self.distinct += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.blank += blank
        self.duplicate += again and not blank
        cut = cut and not blank and not again
        self.truncated += cut
        symbol = initial if initial in ("s", "u", "a") else "o"
        self.spans.add("x" if blank or again else symbol.upper() if cut else symbol)

    def result(self) -> tuple:
        cost, audit = self.spans.best()
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_ORDER = ("turn", "role", "head", "digest")


def _in_order(rows: DataFrame) -> DataFrame:
    """Adds what rows of one turn are ordered by."""
    return rows.withColumns({"head": F.left("text", F.lit(64)), "digest": F.unhex(F.md5(F.col("text").cast("binary")))})


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ending = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    narrow = (
        _in_order(rows)
        .withColumns({"ending": ending, "initial": F.left("role", F.lit(1))})
        .select(
            "conv_id", "there", *_ORDER, "initial",
            (F.col("ending") == "").alias("blank"),
            (~F.col("ending").isin(".", "!", "?")).alias("cut"),
        )
        .repartition("conv_id")
    )
    seen = Window.partitionBy("conv_id", "role", "digest", "there").orderBy(F.asc_nulls_first("turn"))
    marked = narrow.withColumn("again", F.row_number().over(seen) > 1)
    schema = f"conv_id {kind}, {', '.join(f'{name} long' for name in _FIGURES)}, audit string"
    order = [F.asc_nulls_first("turn"), *(F.asc(c) for c in _ORDER[1:])]
    values = ["there", "turn", "initial", "blank", "cut", "again"]
    return folded(marked, "conv_id", order, values, Faults, schema)


class Written:
    """The repaired rows of one conversation: first comes what was decided, then its rows."""

    def __init__(self, key: Any):
        self.key, self.at, self.last, self.digest, self.lines = key, 0, "", sha256(), 0

    def _write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1
        self.last = role[:1]

    def _due(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(self._due(), "")
            self.at += 1

    def add(self, decided: tuple | None, role: str, text: str) -> None:
        if decided is not None:
            self.figures, self.audit = [decided[name] for name in _FIGURES], decided["audit"]
            return
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._write(role if edit == "K" else self._due(), text)

    def result(self) -> tuple:
        self._insert()
        return (self.key, *self.figures, self.audit, self.digest.hexdigest())


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, faults, cost, audit and repaired_sha256, from the rows of ``damaged`` or ``undamaged``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    decided = staged(faults(rows), "repair-decisions")
    figures = F.struct(*_FIGURES, "audit")
    first = decided.select(
        "conv_id", figures.alias("decided"), F.lit(None).cast("long").alias("turn"),
        *(F.lit("").alias(c) for c in ("role", "text", "head")), F.lit(b"").alias("digest"),
    )
    there = _in_order(rows.where("there")).select("conv_id", F.lit(None).alias("decided"), "turn", "role", "text", "head", "digest")
    order = [F.col("decided").isNull(), F.asc_nulls_first("turn"), *(F.asc(c) for c in _ORDER[1:])]
    schema = f"conv_id {kind}, {', '.join(f'{name} long' for name in _FIGURES)}, audit string, repaired_sha256 string"
    return folded(first.unionByName(there), "conv_id", order, ["decided", "role", "text"], Written, schema)
