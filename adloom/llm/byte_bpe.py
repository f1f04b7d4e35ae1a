"""Byte-level BPE: encoding and decoding with the tokenizers library over Arrow batches.

Bytes are mapped to printable characters, as the library's byte-level models need it; each match of
the pattern is encoded by itself. A piece of text goes to the library once in each task as long as
a bounded store keeps its ids. Very long texts are cut
where a word ends and a blank follows, which no match of the pattern crosses.

Decoding maps ids to byte strings and joins those before anything is read as UTF-8, so a character
whose bytes lie in several tokens comes back whole. Offsets go from bytes to characters: a token
that holds part of a character covers that character.

A null or empty text has no ids and decodes to nothing; a null list of ids too. Repeated rows are
encoded each for itself; there are no ties, as ranks differ. An empty table gives an empty result. Ids outside the vocabulary raise an error. Other columns are passed over
unless named in ``kept``.
"""

from __future__ import annotations

import base64
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, models, pre_tokenizers

#: Distinct pieces a task remembers, characters encoded at once, tokens in one Arrow batch.
REMEMBERED, CHUNK, BATCH_TOKENS = 350_000, 1_000_000, 500_000


def byte_characters() -> list[str]:
    """The printable character of each byte: its own in Latin-1, or the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The merge that makes each token, in order: what is left of it under lower ranks."""
    merges = []
    for token in sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [ranks.get(a + b, len(ranks) * 2) for a, b in zip(parts, parts[1:], strict=False)]
            at = pairs.index(min(pairs))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        merges.append((parts[0], parts[1]))
    return merges


def plain_pattern(pattern: str) -> str:
    """The pattern with its Unicode classes written out, up to U+FFFF, as the library sees them.

    Python's own engine runs it faster than any that knows the classes by name. Letters newer than
    the library's tables are none here either: the library is asked about those that Python doesn't
    know yet.
    """
    library = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "isolated")
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    recent = "".join(c for c in text if unicodedata.category(c) == "Cn")
    known = {p for p, _ in library.pre_tokenize_str(recent) if len(p) == 1}
    classes = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = [
            ord(c)
            for c in regex.findall(name, text)
            if unicodedata.category(c) != "Cn" or c in known
        ]
        starts = [c for c, before in zip(members, [None, *members], strict=False) if before != c - 1]
        ends = [c for c, after in zip(members, [*members[1:], None], strict=True) if after != c + 1]
        classes[name] = "".join(rf"\u{a:04x}-\u{b:04x}" for a, b in zip(starts, ends, strict=True))

    def written(found: re.Match) -> str:
        part = found.group()
        if part.startswith("["):
            for name, ranges in classes.items():
                part = part.replace(name, ranges)
            return part
        return f"[^{classes[chr(92) + 's']}]" if part == r"\S" else f"[{classes[part]}]"

    return re.sub(r"\[\^?[^\]]*\]|\\p\{[LN]\}|\\[sS]", written, pattern)


class Codec(dict):
    """A vocabulary of ranks, ready to encode and decode; built once in each task.

    As a dict it holds the ids of the pieces met, as bytes.
    """

    def __init__(
        self, ranks: dict[bytes, int], merges: list[tuple[bytes, bytes]], pattern: str, plain: str
    ):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        shown = byte_characters()
        text = lambda token: "".join(shown[b] for b in token)
        self.tokenize = models.BPE(
            vocab={text(t): r for t, r in ranks.items()},
            merges=[(text(a), text(b)) for a, b in merges],
        ).tokenize
        self.shown = dict(enumerate(shown))
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.find = re.compile(plain).findall
        self.library = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.far = re.compile("[\U00010000-\U0010ffff]").search

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        shown = piece.encode().decode("latin-1").translate(self.shown)
        self[piece] = packed = np.array([t.id for t in self.tokenize(shown)], np.int32).tobytes()
        return packed

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern; texts with characters from beyond U+FFFF go to the library."""
        if not text.isascii() and self.far(text):
            return [piece for piece, _ in self.library.pre_tokenize_str(text)]
        return self.find(text)

    def encode(self, text: str) -> np.ndarray:
        ids = (b"".join(map(self.__getitem__, self.pieces(part))) for part in chunks(text))
        return np.frombuffer(b"".join(ids), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last, of each token."""
        ends = np.cumsum([len(self.bytes_of[i]) for i in ids.tolist()], dtype=np.int64)
        leads = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        character = np.cumsum(leads) - 1
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        return character[starts].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)


_CUT = re.compile("(?<=[!-~])(?= )")


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + size) if len(text) - at > size else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _lists(values: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0, *(len(v) for v in values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat, type=pa.int32()))


def encode(
    documents: DataFrame, path: str, pattern: str, kept: tuple[str, ...] = ("doc_id",), offsets=False
) -> DataFrame:
    """``kept`` and ids; with ``offsets`` also starts and ends, in characters."""
    ranks = read_ranks(path)
    merges, plain = merges_of(ranks), plain_pattern(pattern)
    names = [*kept, "ids", *(["starts", "ends"] if offsets else [])]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, merges, pattern, plain)
        for batch in batches:
            texts, first, held = batch.column("__text"), 0, 0
            columns: list[list[np.ndarray]] = [[], [], []]
            for at in range(batch.num_rows):
                text = texts[at].as_py() or ""
                ids = codec.encode(text)
                columns[0].append(ids)
                if offsets:
                    for column, found in zip(columns[1:], codec.offsets(text, ids), strict=True):
                        column.append(found)
                held += len(ids)
                if held >= BATCH_TOKENS or at == batch.num_rows - 1:
                    same = [batch.column(c).slice(first, at + 1 - first) for c in kept]
                    made = [_lists(c) for c in columns[: 3 if offsets else 1]]
                    yield pa.RecordBatch.from_arrays([*same, *made], names)
                    first, held, columns = at + 1, 0, [[], [], []]

    types = {f.name: f.dataType.simpleString() for f in documents.schema}
    schema = [f"`{c}` {types[c]}" for c in kept] + [f"{c} array<int>" for c in names[len(kept) :]]
    rows = documents.select(*kept, documents["text"].alias("__text"))
    return rows.mapInArrow(over, ", ".join(schema))


def decode(encoded: DataFrame, path: str, kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``kept``, ids and the decoded bytes; F.decode(bytes, 'UTF-8') is the text."""
    ranks = read_ranks(path)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {r: t for t, r in ranks.items()}
        for batch in batches:
            lists = batch.column("ids")
            ids, at = lists.values.to_numpy(), lists.offsets.to_numpy()
            decoded = [
                b"".join(map(table.__getitem__, ids[a:b].tolist()))
                for a, b in zip(at, at[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), lists, pa.array(decoded, pa.binary())],
                [*kept, "ids", "bytes"],
            )

    types = {f.name: f.dataType.simpleString() for f in encoded.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept)
    rows = encoded.select(*kept, "ids")
    return rows.mapInArrow(over, f"{schema}, ids array<int>, bytes binary")
