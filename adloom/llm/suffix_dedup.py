"""Removal of repeated byte strings by suffix arrays.

Every byte that lies in a string of ``LENGTH`` bytes which also starts somewhere else goes; strings are
judged on the input, and none crosses a document's end. No task sees the whole corpus:

1. Texts are compared as wholes first, by SHA-256: of equal texts one stands for all. Where they are long
   enough, all their bytes go, as each string starts in every copy.
2. Each string of LENGTH bytes has an anchor, its 16-byte gram of the least hash (the first of
   equals). Equal strings have equal anchors in the same place. The starts of a text fall into runs
   that share an anchor, one for about 190 bytes. Grams that occur once are out.
3. A run's bytes are its segment. Segments of one gram meet in a task, equal ones as one row with a
   weight. Within a gram, equal strings are aligned: segments are cut into blocks counted from the
   anchor, and blocks are numbered. A suffix array of the block numbers (suffix_sort) brings together
   suffixes that share enough blocks for a string of LENGTH, whatever its offset in the first block.
   Among these neighbours the bytes to the left and right of the shared blocks are compared.
4. A gram with more different segments than ``TOGETHER`` isn't gathered: its strings are dealt out
   singly by their 128-bit digests and counted. Same result, more rows.
5. Starts that repeat become byte ranges of their documents.

A null text is empty. Texts under LENGTH bytes stay whole. Repeated rows are copies of each other.
Null and repeated ids are documents like any other. An empty table gives an empty result. Other
columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_or_empty
from .suffix_sort import suffix_array

LENGTH, GRAM, BLOCK = 400, 16, 40
#: Blocks that any string of LENGTH holds in full, wherever it starts.
SHARED = (LENGTH - BLOCK + 1) // BLOCK
REST = LENGTH - SHARED * BLOCK
#: Different segments of one gram that one task takes; segments sorted at once; starts at once.
TOGETHER, AT_ONCE, CHUNK = 20_000, 2_000, 1 << 20
_POSITION = np.uint64((1 << 21) - 1)


def _gram_hashes(data: bytes) -> np.ndarray:
    """A hash of each 16-byte gram, by doubling."""
    h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for apart, factor in ((1, 0xBF58476D1CE4E5B9), (2, 0x94D049BB133111EB), (4, 0xD6E8FEB86659FD93), (8, 0xA0761D6478BD642F)):
        h = h[:-apart] * np.uint64(factor) + h[apart:]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xE7037ED1A0B428DB)
    return h ^ (h >> np.uint64(32))


def runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of each run, its anchor's place, and its gram's hash."""
    parts = []
    for at in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        grams = _gram_hashes(data[at : at + CHUNK + LENGTH - 1])
        low = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        width, covered = LENGTH - GRAM + 1, 1
        while covered * 2 <= width:
            low = np.minimum(low[:-covered], low[covered:])
            covered *= 2
        if width > covered:
            low = np.minimum(low[: len(low) - (width - covered)], low[width - covered :])
        place = (low & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        parts.append((first + at, last + at, place[first] + at, grams[place[first]].view(np.int64)))
    if not parts:
        return (np.empty(0, np.int64),) * 4
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, data, n_bytes, digest, key (half of it), id_text (never null)."""
    return (
        documents.select("doc_id", F.encode(text_or_empty(), "UTF-8").alias("data"))
        .withColumn("digest", F.sha2("data", 256))
        .select(
            "doc_id",
            "data",
            F.octet_length("data").cast("long").alias("n_bytes"),
            "digest",
            F.unhex(F.substring("digest", 1, 32)).alias("key"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text"),
        )
    )


def _grams(texts: DataFrame) -> DataFrame:
    """key, gram, n: how often a gram is an anchor in a text."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, all_grams, all_counts = [], [], []
            for key, data in zip(batch.column("key"), batch.column("data"), strict=True):
                grams, counts = np.unique(runs(data.as_py())[3], return_counts=True)
                all_grams.append(grams)
                all_counts.append(counts)
                keys.append(len(grams))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(np.repeat(np.arange(len(keys)), keys))),
                    pa.array(np.concatenate(all_grams) if keys else [], pa.int64()),
                    pa.array(np.concatenate(all_counts) if keys else [], pa.int64()),
                ],
                ["key", "gram", "n"],
            )

    return texts.select("key", "data").mapInArrow(over, "key binary, gram long, n long")


def _segments(texts: DataFrame) -> DataFrame:
    """Segments of the given grams: key, gram, segment (digest), starts (of its runs), data, head
    (bytes before the first block) and weight.
    """
    kinds = [
        ("key", pa.binary()), ("gram", pa.int64()), ("segment", pa.binary()),
        ("starts", pa.list_(pa.int32())), ("data", pa.binary()), ("head", pa.int32()), ("weight", pa.int64()),
    ]

    def of(key: bytes, data: bytes, wanted: list[int], copies: int) -> Iterator[tuple]:
        first, last, place, gram = runs(data)
        found: dict[tuple, list[int]] = {}
        for i in np.flatnonzero(np.isin(gram, wanted)):
            part = data[first[i] : last[i] + LENGTH]
            head = int(place[i] - first[i]) % BLOCK
            name = blake2b(part, digest_size=15).digest() + bytes([head])
            found.setdefault((int(gram[i]), name, head), []).append(int(first[i]))
        for (g, name, head), starts in found.items():
            part_at = starts[0]
            size = int(last[np.searchsorted(first, part_at)]) + LENGTH
            yield key, g, name, starts, data[part_at:size], head, min(2, len(starts) * copies)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for key, data, grams, copies in zip(*(batch.column(c) for c in ("key", "data", "grams", "copies")), strict=True):
                own = list(of(key.as_py(), data.as_py(), grams.as_py(), copies.as_py()))
                rows += own
                held += sum(len(r[4]) for r in own)
                if held > 8_000_000:
                    yield _batch(rows, kinds)
                    rows, held = [], 0
            yield _batch(rows, kinds)

    schema = "key binary, gram long, segment binary, starts array<int>, data binary, head int, weight long"
    return texts.mapInArrow(over, schema)


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in kinds])


def repeated_starts(segments: list[tuple[bytes, int, int]]) -> list[np.ndarray]:
    """For segments (data, head, weight): which starts begin a string that occurs twice in all.

    A segment of weight two is repeated itself; it only serves the others here.
    """
    numbers: dict[bytes, int] = {}
    text: list[int] = []
    owner, place = [], []
    for s, (data, head, _) in enumerate(segments):
        for at in range(head, len(data) - BLOCK + 1, BLOCK):
            text.append(numbers.setdefault(data[at : at + BLOCK], len(numbers) + 2))
            owner.append(s)
            place.append(at)
        text.append(1)  # an end; nothing shared runs over it
        owner.append(s)
        place.append(-1)
    flags = [np.full(len(data) - LENGTH + 1, weight > 1) for data, _, weight in segments]
    if len(text) < SHARED:
        return flags
    order = np.array(suffix_array(text))
    windows = np.lib.stride_tricks.sliding_window_view(np.array(text + [1] * (SHARED - 1)), SHARED)[order]
    whole = (windows > 1).all(axis=1)
    same = np.zeros(len(order) + 1, bool)  # shares its blocks with the suffix before it
    same[1:-1] = (windows[1:] == windows[:-1]).all(axis=1) & whole[1:]
    edges = np.flatnonzero(np.diff(same.astype(np.int8)))
    for low, high in zip(edges[::2], edges[1::2], strict=True):
        members = []
        for i in order[low : high + 1]:
            data, _, weight = segments[owner[i]]
            at = place[i]
            end = at + SHARED * BLOCK
            members.append((owner[i], at, data[max(0, at - BLOCK + 1) : at], data[end : end + REST], weight))
        if all(m[4] > 1 for m in members):
            continue
        for d in range(BLOCK):
            seen: dict[bytes, list[tuple[int, int]]] = {}
            twice: set[bytes] = set()
            for s, at, left, right, weight in members:
                if d > len(left) or REST - d > len(right):
                    continue
                string = left[len(left) - d :] + right[: REST - d]
                if string in seen or weight > 1:
                    twice.add(string)
                seen.setdefault(string, []).append((s, at - d))
            for string in twice:
                for s, start in seen[string]:
                    flags[s][start] = True
    return flags


def _ranges(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return [{"low": int(a), "high": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]


_RANGES = "array<struct<low:int,high:int>>"


def _sorted_starts(segments: DataFrame) -> DataFrame:
    """gram, segment, ranges of repeated starts; the rows of a gram come one after the other."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [
            ("gram", pa.int64()), ("segment", pa.binary()),
            ("ranges", pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
        ]

        def done(held: list[tuple]) -> pa.RecordBatch:
            flags = repeated_starts([(data, head, weight) for _, _, data, head, weight in held])
            rows = [(h[0], h[1], _ranges(f)) for h, f in zip(held, flags, strict=True) if f.any()]
            return _batch(rows, kinds)

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "segment", "data", "head", "weight")), strict=True):
                if len(held) >= AT_ONCE and row[0] != held[-1][0]:
                    yield done(held)
                    held = []
                held.append(row)
        yield done(held)

    rows = segments.select("gram", "segment", "data", "head", "weight")
    together = rows.repartition("gram").sortWithinPartitions("gram")
    return together.mapInArrow(over, f"gram long, segment binary, ranges {_RANGES}")


def _counted_starts(segments: DataFrame) -> DataFrame:
    """The same for grams of very many segments: each string's digest goes its own way."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("gram", pa.int64()), ("segment", pa.binary()), ("start", pa.int32()), ("string", pa.binary()), ("weight", pa.int64())]
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("gram", "segment", "data", "weight")), strict=True):
                gram, segment, data, weight = (x.as_py() for x in row)
                starts = range(len(data) - LENGTH + 1)
                digests = (blake2b(data[i : i + LENGTH], digest_size=16).digest() for i in starts)
                yield _batch([(gram, segment, i, d, weight) for i, d in zip(starts, digests, strict=True)], kinds)

    strings = segments.select("gram", "segment", "data", "weight").mapInArrow(
        over, "gram long, segment binary, start int, string binary, weight long"
    )
    twice = strings.groupBy("string").agg(F.sum("weight").alias("w")).where("w > 1").select("string")
    starts = strings.join(twice, "string").groupBy("gram", "segment").agg(F.collect_list("start").alias("starts"))
    one = lambda i: F.struct(i.alias("low"), i.alias("high"))
    return starts.select("gram", "segment", F.transform("starts", one).alias("ranges"))


def repeats(documents: DataFrame, together: int = TOGETHER) -> tuple[DataFrame, DataFrame]:
    """(copies, ranges): key, n_bytes, copies of each text of LENGTH bytes or more; and
    key, ranges of repeated starts for texts that have them.
    """
    rows = keyed(documents)
    long = rows.where(F.col("n_bytes") >= LENGTH)
    grams = staged(_grams(long).groupBy("key", "gram").agg(F.max("n").alias("n")), "grams")
    repeated = (
        grams.groupBy("gram")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"), F.max("n").alias("n"))
        .where("low <> high OR n > 1")
        .select("gram")
    )
    wanted = grams.join(repeated, "gram").groupBy("key").agg(F.collect_list("gram").alias("grams"))
    copies = staged(
        long.groupBy("key").agg(F.count("*").alias("copies"), F.min("id_text").alias("id_text")), "copies"
    )
    chosen = copies.join(wanted, "key").select(
        F.col("key"), F.col("id_text"), "grams", F.least("copies", F.lit(2).cast("long")).alias("copies")
    )
    texts = (
        long.select("key", "id_text", "data")
        .join(chosen, ["key", "id_text"])
        .groupBy("key", "id_text")  # repeated rows of one id
        .agg(F.first("data").alias("data"), F.first("grams").alias("grams"), F.first("copies").alias("copies"))
        .select("key", "data", "grams", "copies")
    )
    found = staged(_segments(texts), "segments")
    segments = found.groupBy("gram", "segment").agg(
        F.first("data").alias("data"), F.first("head").alias("head"), F.sum("weight").alias("weight")
    )
    crowds = (
        found.groupBy("gram", "segment").agg(F.lit(1).alias("one"))
        .groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > together).select("gram")
    )
    crowds = staged(crowds, "crowds")
    usual = segments.join(crowds, "gram", "left_anti")
    starts = _sorted_starts(usual).union(_counted_starts(segments.join(crowds, "gram", "left_semi")))
    shifted = F.flatten(
        F.transform(
            "starts",
            lambda at: F.transform(
                "ranges",
                lambda r: F.struct((r.getField("low") + at).alias("low"), (r.getField("high") + at).alias("high")),
            ),
        )
    )
    ranges = (
        found.select("key", "gram", "segment", "starts")
        .join(starts, ["gram", "segment"])
        .select("key", F.explode(shifted).alias("range"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("range")).alias("ranges"))
    )
    return copies, staged(ranges, "ranges")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte runs (start, stop) that the strings of these starts cover, from sorted ranges."""
    spans: list[list[int]] = []
    for low, high in ranges:
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high + LENGTH)
        else:
            spans.append([low, high + LENGTH])
    return [tuple(s) for s in spans]


def deduplicated(documents: DataFrame, together: int = TOGETHER) -> DataFrame:
    """doc_id, n_bytes, spans (start, stop of removed runs), kept_sha256, kept (the remaining bytes) and
    text (the same as text: what is left of a character that was cut in two is U+FFFD).
    """
    copies, ranges = repeats(documents, together)
    partial = copies.where("copies = 1").join(ranges, "key").select("key", "ranges", F.lit(False).alias("all"))
    copied = copies.where("copies > 1").select("key", F.array().cast(_RANGES).alias("ranges"), F.lit(True).alias("all"))
    decided = partial.union(copied)
    spans_of = "array<struct<start:int,stop:int>>"

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            all_spans, digests, kepts = [], [], []
            for data, found, whole in zip(*(batch.column(c) for c in ("data", "ranges", "all")), strict=True):
                data = data.as_py()
                ranges = [(r["low"], r["high"]) for r in found.as_py() or ()]
                spans = [(0, len(data))] if whole.as_py() else merged(ranges)
                at, kept = 0, []
                for start, stop in spans:
                    kept.append(data[at:start])
                    at = stop
                kept = b"".join([*kept, data[at:]]) if spans else data
                all_spans.append([{"start": a, "stop": b} for a, b in spans])
                digests.append(sha256(kept).hexdigest())
                kepts.append(kept)
            texts = pa.array([kept.decode("utf-8", "replace") for kept in kepts], pa.string())
            arrays = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(all_spans, kind), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "spans", "kept_sha256", "kept", "text"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(kepts, pa.binary()), texts], names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = keyed(documents).select("doc_id", "n_bytes", "key", "data")
    return (
        rows.join(decided, "key", "left")
        .select("doc_id", "n_bytes", "data", "ranges", "all")
        .mapInArrow(over, f"doc_id {kind}, n_bytes long, spans {spans_of}, kept_sha256 string, kept binary, text string")
    )
