"""Chat formatting: layouts told apart by the fingerprint of their nested field paths.

Data sets keep conversations as a list of messages, as instruction and answer, as prompt and
completion or as one row for each turn. The nested field paths of a table, or of each JSON record,
are hashed; the hash selects a declarative mapping (``LAYOUTS``), which turns the record into
canonical turns of a role and a text. Only field names that some layout knows count, so extra
fields of any name change nothing; a mapping's optional fields may be missing.

``formatted`` writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Within roles and texts each
``<|`` gets a backslash between its two characters, and where there are backslashes already, one
more; so no control string is left in them and taking one backslash away gives the text back. Line
breaks and backslashes of a role are written as ``\\n`` and ``\\\\``. The loss mask is the span of the
text of each assistant turn, in code points of the turn's piece.

A conversation's pieces, in order, are its formatted text. They are read back one after another,
so a conversation of any length needs one piece at a time, though one task, as a digest of
all its text is computed from front to back.

Null roles and texts are empty. Turns go by their number (nulls first); turns of one number by
place in their record, role and text; repeated rows are turns of their own. A null conversation is
one like any other. Records without a mapping, and malformed JSON, have no turns; ``unmapped``
returns them. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from itertools import combinations
from typing import Any

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import folded

START, END = "<|im_start|>", "<|im_end|>"
ANSWERS = "assistant"


@dataclass(frozen=True)
class Said:
    """A turn made of fields of the record: those that are there, with a blank line between."""

    role: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Messages:
    """Turns that are the items of a list."""

    field: str
    role: str
    text: str


@dataclass(frozen=True)
class TurnRows:
    """The record is itself a turn of a conversation that has several."""

    order: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    name: str
    turns: tuple[Said, ...] | Messages | TurnRows
    optional: tuple[str, ...] = ()

    def paths(self) -> set[str]:
        """The nested field paths of the layout, optional ones included."""
        match self.turns:
            case Messages(field, role, text):
                return {field, f"{field}[]", f"{field}[].{role}", f"{field}[].{text}"}
            case TurnRows(order, role, text):
                return {order, role, text}
            case said:
                return {field for turn in said for field in turn.fields}


LAYOUTS = (
    Layout("turn rows", TurnRows("turn", "role", "text")),
    Layout("messages", Messages("messages", "role", "content")),
    Layout("conversation", Messages("conversation", "role", "content")),
    Layout("conversations", Messages("conversations", "from", "value")),
    Layout(
        "instruction",
        (Said("system", ("system",)), Said("user", ("instruction", "input")), Said(ANSWERS, ("output",))),
        ("system", "input"),
    ),
    Layout(
        "question",
        (Said("system", ("system_prompt",)), Said("user", ("question",)), Said(ANSWERS, ("response",))),
        ("system_prompt",),
    ),
    Layout("prompt and completion", (Said("user", ("prompt",)), Said(ANSWERS, ("completion",)))),
    Layout("prompt and response", (Said("user", ("prompt",)), Said(ANSWERS, ("response",)))),
)
#: Other names of roles in lists of messages.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: set[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)), 42)


def mappings(layouts: tuple[Layout, ...] = LAYOUTS) -> dict[int, Layout]:
    """Fingerprint -> layout, one for each choice of a layout's optional fields."""
    found: dict[int, Layout] = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for missing in combinations(layout.optional, n):
                found.setdefault(fingerprint(layout.paths() - set(missing)), layout)
    return found


def known_paths(layouts: tuple[Layout, ...] = LAYOUTS) -> set[str]:
    return set().union(*(layout.paths() for layout in layouts))


def schema_paths(kind: T.DataType, prefix: str = "") -> set[str]:
    """The nested field paths of a schema; ``[]`` stands for the items of a list."""
    if isinstance(kind, T.StructType):
        here = ((f"{prefix}.{f.name}" if prefix else f.name, f.dataType) for f in kind.fields)
        return set().union(*({path} | schema_paths(of, path) for path, of in here)) if kind.fields else set()
    if isinstance(kind, T.ArrayType):
        return {f"{prefix}[]"} | schema_paths(kind.elementType, f"{prefix}[]")
    return set()


def value_paths(value: Any, prefix: str = "") -> set[str]:
    """The nested field paths of one JSON value."""
    if isinstance(value, dict):
        here = ((f"{prefix}.{name}" if prefix else name, of) for name, of in value.items())
        return set().union(*({path} | value_paths(of, path) for path, of in here)) if value else set()
    if isinstance(value, list) and value:
        return set().union({f"{prefix}[]"}, *(value_paths(of, f"{prefix}[]") for of in value))
    return set()


def layout_of(table: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Layout | None:
    """The layout that the fields of a table select."""
    fields = T.StructType([f for f in table.schema.fields if f.name in {p.split("[")[0] for p in known_paths(layouts)}])
    return mappings(layouts).get(fingerprint(schema_paths(fields) & known_paths(layouts)))


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def _named(role: Column) -> Column:
    named = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    return F.coalesce(F.try_element_at(named, _text(role)), _text(role))


def _field(name: str) -> Column:
    return F.col(f"`{name}`")


def canonical(table: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """conv_id, turn, place, role, text: the canonical turns of a table of one layout."""
    layout = layout_of(table, layouts)
    if layout is None:
        raise ValueError(f"no layout has the fields of {table.columns}")
    conversation = _field(key).alias("conv_id")
    none = F.lit(0).cast("long")
    match layout.turns:
        case TurnRows(order, role, text):
            turn = _field(order).cast("long")
            return table.select(
                conversation, turn.alias("turn"), none.alias("place"), _text(_field(role)).alias("role"), _text(_field(text)).alias("text")
            )
        case Messages(field, role, text):
            items = table.select(conversation, F.posexplode(_field(field)).alias("place", "item"))
            return items.select(
                "conv_id", none.alias("turn"), F.col("place").cast("long").alias("place"),
                _named(F.col("item").getField(role)).alias("role"), _text(F.col("item").getField(text)).alias("text"),
            )
        case said:
            there = set(table.columns)

            def turn_of(place: int, turn: Said) -> Column:
                parts = [_field(f).cast("string") for f in turn.fields if f in there]
                # A question is there even if it's null; what is only optional isn't.
                shown = F.lit(True) if set(turn.fields) - set(layout.optional) else parts[0].isNotNull()
                text = F.concat_ws("\n\n", *(F.nullif(p, F.lit("")) for p in parts))
                fields = (F.lit(place).cast("long").alias("place"), F.lit(turn.role).alias("role"), text.alias("text"))
                return F.when(shown, F.struct(*fields))

            turns = [turn_of(i, t) for i, t in enumerate(said) if set(t.fields) & there]
            items = F.filter(F.array(*turns), lambda t: t.isNotNull())
            return table.select(conversation, none.alias("turn"), F.inline(items))


def _record_turns(record: Any, layout: Layout) -> list[tuple[int, str, str]]:
    """turn, role and text of a JSON record."""

    def plain(value: Any) -> str:
        return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)

    match layout.turns:
        case TurnRows(order, role, text):
            at = record[order]
            return [(at if isinstance(at, int) else None, plain(record[role]), plain(record[text]))]
        case Messages(field, role, text):
            items = [i if isinstance(i, dict) else {} for i in record[field]]
            return [(0, ROLES.get(plain(i.get(role)), plain(i.get(role))), plain(i.get(text))) for i in items]
        case said:
            found = []
            for turn in said:
                parts = [plain(record.get(f)) for f in turn.fields]
                if set(turn.fields) - set(layout.optional) or record.get(turn.fields[0]) is not None:
                    found.append((0, turn.role, "\n\n".join(p for p in parts if p)))
            return found


def _json_layouts(records: DataFrame, column: str, key: str, layouts: tuple[Layout, ...]) -> DataFrame:
    kind = records.schema[key].dataType.simpleString()
    schema = f"conv_id {kind}, record string, layout string, turns array<struct<turn:bigint,role:string,text:string>>"
    entry = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_print, known = mappings(layouts), known_paths(layouts)
        names = {path.split("[")[0] for path in known}
        for batch in batches:
            chosen, turns = [], []
            for text in batch.column(1).to_pylist():
                layout, found = None, []
                try:
                    record = json.loads(text) if text is not None else None
                except (ValueError, RecursionError):
                    record = None
                if isinstance(record, dict):
                    own = {name: of for name, of in record.items() if name in names}
                    layout = by_print.get(fingerprint(value_paths(own) & known))
                    found = _record_turns(record, layout) if layout else []
                chosen.append(layout and layout.name)
                turns.append([dict(zip(("turn", "role", "text"), t, strict=True)) for t in found])
            arrays = [*batch.columns, pa.array(chosen, pa.string()), pa.array(turns, entry)]
            yield pa.record_batch(arrays, ["conv_id", "record", "layout", "turns"])

    return records.select(_field(key).alias("conv_id"), _field(column).alias("record")).mapInArrow(over, schema)


def canonical_json(
    records: DataFrame, column: str, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """conv_id, turn, place, role, text of JSON records, each of a layout of its own."""
    found = _json_layouts(records, column, key, layouts)
    items = found.select("conv_id", F.posexplode("turns").alias("place", "item"))
    return items.select("conv_id", "item.turn", F.col("place").cast("long").alias("place"), "item.role", "item.text")


def unmapped(
    records: DataFrame, column: str, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """conv_id and record of the JSON records that no layout fits."""
    return _json_layouts(records, column, key, layouts).where("layout IS NULL").select("conv_id", "record")


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role_line(role: Column) -> Column:
    return F.replace(F.replace(_escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role(line: str) -> str:
    return _unescaped(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line))


def formatted(turns: DataFrame, answers: str = ANSWERS) -> DataFrame:
    """conv_id, turn, place, role, text and, of each turn, its piece of the formatted text with
    loss_from and loss_to, the span of the piece under the loss mask (null: none).
    """
    opening = F.concat(F.lit(START), _role_line(F.col("role")), F.lit("\n"))
    body = _escaped(F.col("text"))
    under = F.when(F.col("role") == answers, F.length(opening))
    return turns.select(
        "conv_id", "turn", "place", "role", "text",
        F.concat(opening, body, F.lit(f"{END}\n")).alias("piece"),
        under.alias("loss_from"),
        (under + F.length(body)).alias("loss_to"),
    )


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


class ReadBack:
    """Turns and loss texts, read from the pieces of one conversation as they come."""

    def __init__(self, key: Any):
        self.key, self.turns, self.chars, self.loss_chars, self.open = key, 0, 0, 0, ""
        self.said, self.loss = sha256(), sha256()

    def add(self, piece: str, loss_from: int | None, loss_to: int | None) -> None:
        self.chars += len(piece)
        if loss_from is not None:
            text = _unescaped(piece[loss_from:loss_to])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.open += piece
        while turn := _TURN.match(self.open):
            self.turns += 1
            self.said.update(f"{_role(turn[1])}\n{_unescaped(turn[2])}\n".encode())
            self.open = self.open[turn.end() :]

    def result(self) -> tuple:
        if self.open:
            raise ValueError(f"conversation {self.key} ends within a turn")
        return (self.key, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(pieces: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the pieces alone."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    order = [F.asc_nulls_first("turn"), F.asc("place"), F.asc("role"), F.asc("text")]
    return folded(pieces, "conv_id", order, ["piece", "loss_from", "loss_to"], ReadBack, schema)


def together(turns: list[DataFrame]) -> DataFrame:
    """Canonical turns of several tables."""
    return reduce(DataFrame.unionByName, turns)
