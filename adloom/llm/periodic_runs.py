"""Periodic runs of words by online dyadic square catching.

Words are appended one after another. When the words a*2^k .. (a+1)*2^k - 1 are complete, that block
gets a catcher of level k, which waits for squares of periods 2^k to 2^(k+1) - 1. Each appended word
advances, on each level, the comparison of the suffix of 2^k words with the one catcher that can be
waiting for it: that of the block before the one in which the suffix begins. Where they are equal,
the distance is the period of a new square; its words are compared on both sides for as long as
they repeat at that distance, and squares that touch merge into one run.

A run of period q that is at least four periods long holds a block of 2^k <= q words, complete, one
period before another suffix equal to it: so every such run is caught on its level. The suffixes
have a hash by doubling (two halves make a whole) to compare many of them in one array operation; a
square counts only once its words were compared, so a clash of hashes costs time and changes
nothing. What a run of a smaller period explains is passed over: there a distance that is a multiple
of that period makes no run of its own.

A run is a stretch of words with smallest period q, at least max(``LEAST``, ``POWERS`` * q) words
long, that no neighbouring word extends. Null, empty and blank texts have no words and no runs. Texts
are taken whole, whatever their length; a text is one value of one row, as documents are everywhere.
Repeated rows give equal rows; ties among the longest runs go to the least start, then the least
period. An empty table gives an empty result. Only doc_id and text are read, whatever else there is.
"""

from __future__ import annotations

from binascii import crc32
from collections.abc import Iterator
from hashlib import sha256
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST, POWERS = 6, 4
#: Odd factors of the doubling hash.
LOW, HIGH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Words whose squares are looked for together: many short texts, or one long one.
TOGETHER = 1 << 18

Run = tuple[int, int, int]


def _stretch(words: np.ndarray, start: int, period: int) -> tuple[int, int]:
    """The maximal [from, to) around a word repeated at this distance, by steps that double."""
    n = len(words) - period
    to, step = start, 64
    while to < n:
        differ = np.flatnonzero(words[to : min(n, to + step)] != words[to + period : min(n, to + step) + period])
        if differ.size:
            to += int(differ[0])
            break
        to, step = min(n, to + step), 2 * step
    at, step = start, 64
    while at > 0:
        low = max(0, at - step)
        differ = np.flatnonzero(words[low:at] != words[low + period : at + period])
        if differ.size:
            at = low + int(differ[-1]) + 1
            break
        at, step = low, 2 * step
    return at, to + period


class Catchers:
    """The squares of one sequence of words, level by level, and the runs they merge into.

    ``words`` are numbers; a number that occurs once, as between two texts, ends every run.
    """

    def __init__(self, words: np.ndarray, least: int = LEAST, powers: int = POWERS):
        self.words, self.least, self.powers = words, least, powers
        self.runs: list[Run] = []
        self.stretches: set[tuple[int, int]] = set()

    def caught(self, longest: int) -> list[Run]:
        """(start, length, period) of all runs; no text has more than ``longest`` words."""
        suffix = self.words.astype(np.uint64) * LOW + HIGH
        level = 0
        while self.powers << level <= max(longest, self.least) and len(suffix) > 1 << level:
            self._advance(suffix, level)
            half = 1 << level
            folded = suffix[:-half] * LOW + suffix[half:] * HIGH
            suffix = folded ^ (folded >> np.uint64(29))
            level += 1
        self.runs.sort(key=lambda run: (run[0], run[2]))
        return self.runs

    def _advance(self, suffix: np.ndarray, level: int) -> None:
        """Compare each suffix of 2^level words, by its first word, with its catcher."""
        size = 1 << level
        first = np.arange(size, len(suffix))
        block = (first >> level << level) - size
        met = np.flatnonzero(suffix[size:] == suffix[block])
        if met.size:
            self._merge(block[met], first[met] - block[met], size)

    def _merge(self, block: np.ndarray, period: np.ndarray, size: int) -> None:
        """New squares, as an occurrence and its distance, become runs or parts of known ones."""
        open_ = np.ones(len(block), bool)
        for start, length, smaller in self.runs:  # blocks ascend, so those within a run are neighbours
            low, high = np.searchsorted(block, (start, start + length))
            inside = block[low:high] + size + period[low:high] <= start + length
            # A block as long as the smaller period occurs again only at its multiples.
            open_[low:high] &= ~(inside & (period[low:high] % smaller == 0) & (smaller <= size))
        at = np.flatnonzero(open_)
        order = at[np.lexsort((block[at], period[at]))]
        last, end = 0, -1
        for start, q in zip(block[order].tolist(), period[order].tolist(), strict=True):
            if q == last and start + q < end:
                continue
            low, high = _stretch(self.words, start, q)
            last, end = q, high
            # A stretch that has a smaller period too was caught with that one before.
            if high - low >= max(self.least, self.powers * q) and (low, high) not in self.stretches:
                self.stretches.add((low, high))
                self.runs.append((low, high - low, q))


def periodic(n: int, key: bytes) -> np.ndarray | None:
    """Which original word each word becomes in a text that is made periodic; None: all stay."""
    h = crc32(key)
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without repetitions: of each run, the first period stays unless another run drops it."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def runs_of(texts: list[list[bytes]], least: int = LEAST, powers: int = POWERS) -> list[list[Run]]:
    """The runs of each text, given as its words; texts are searched side by side."""
    found: list[list[Run]] = []
    at = 0
    while at < len(texts):
        to, total = at, 0
        while to < len(texts) and (to == at or total + len(texts[to]) <= TOGETHER):
            total += len(texts[to])
            to += 1
        found.extend(_side_by_side(texts[at:to], least, powers))
        at = to
    return found


def _side_by_side(texts: list[list[bytes]], least: int, powers: int) -> list[list[Run]]:
    numbers: dict[bytes | int, int] = {}
    fresh = count()
    number = numbers.get
    line: list[int] = []
    starts = []
    for text in texts:
        starts.append(len(line))
        for word in text:
            known = number(word)
            if known is None:
                known = numbers[word] = next(fresh)
            line.append(known)
        line.append(next(fresh))  # between two texts: occurs once
    words = np.array(line, dtype=np.int64)
    found: list[list[Run]] = [[] for _ in texts]
    places = np.array(starts)
    for start, length, period in Catchers(words, least, powers).caught(max(map(len, texts), default=0)):
        text = int(np.searchsorted(places, start, "right")) - 1
        found[text].append((start - starts[text], length, period))
    return found


SCHEMA = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


def _summary(words: list[bytes], runs: list[Run]) -> tuple:
    written = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    text = b" ".join(collapsed(words, runs))
    best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=None)
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(words), len(runs), *figures, sha256(written.encode()).hexdigest(), sha256(text).hexdigest())


def detect(documents: DataFrame, seeded: bool = False, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_runs, the longest run and digests of all runs and of the collapsed text.

    With ``seeded``, texts are made periodic by their id first (a null id: the empty key), as in a
    test of the detector. With ``texts``, the runs themselves and the collapsed text come along.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {SCHEMA}"
    if texts:
        schema += ", runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                words = (text.as_py() or "").encode().split()  # bytes: the six ASCII spaces only
                at = periodic(len(words), key.encode()) if seeded else None
                lines.append(words if at is None else [words[i] for i in at.tolist()])
            runs = runs_of(lines)
            columns = list(zip(*map(_summary, lines, runs), strict=True)) if lines else [()] * 8
            arrays = [batch.column("doc_id")]
            arrays += [pa.array(c, pa.string() if i > 5 else pa.int64()) for i, c in enumerate(columns)]
            names = ["doc_id", *(f.split()[0] for f in SCHEMA.split(", "))]
            if texts:
                entry = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
                as_rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in of] for of in runs]
                arrays += [pa.array(as_rows, entry), pa.array([b" ".join(collapsed(w, r)).decode() for w, r in zip(lines, runs, strict=True)])]
                names += ["runs", "collapsed"]
            yield pa.record_batch(arrays, names)

    rows = documents.selectExpr("doc_id", "coalesce(cast(doc_id as string), '') as key", "text")
    return rows.mapInArrow(over, schema)
