"""Near-copies by SimHash; candidates are found by pigeonring filtering.

Split 64 bits into a ring of m segments. If two fingerprints differ in at most d bits, some start
exists from which, for every length l, the first l segments differ in at most floor(l * d / m) bits.
The leading segments whose budget is nought form an exact key (24 bits for m = 8, d = 2), so
candidates meet by an equi-join on (start, key); the rest of the chain prunes them before the full
check of all bits.

A key that many distinct fingerprints share isn't paired out. There each fingerprint is written
with each one of its other bits flipped, and as it is: two that differ in at most two bits share
one of these forms, and any two that share one differ in at most two. Each form ties its members
to the least of them: as many rows as fingerprints times 41, no pairs, and the same components.

Very long texts are taken whole. Null and empty texts have fingerprint nought and are linked like any other. Repeated rows have equal
fingerprints. A component's id is its least doc_id; null ids are passed over, and a component
of none but null ids has a null id. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, staged
from .components import components

SHINGLE, SEED, DISTANCE, SEGMENTS = 3, 42, 2, 8
#: Keys of more distinct fingerprints are grouped by flipped forms and not paired.
PAIRED = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned integer."""
    words = (text or "").encode().lower().split()  # bytes: only ASCII letters and spaces count
    if not words:
        return 0
    parts = zip(*(words[i:] for i in range(min(shingle, len(words)))), strict=False)
    hashed = xxhash.xxh64_intdigest
    hashes = np.array([hashed(b" ".join(p), SEED) for p in parts], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text (it tells rows of one id apart) and the fingerprint, signed."""

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = (fingerprint(t.as_py(), shingle) for t in batch.column("text"))
            signed = np.fromiter(found, dtype=np.uint64, count=batch.num_rows).view(np.int64)
            known = [batch.column("doc_id"), batch.column("text_hash"), pa.array(signed)]
            return pa.record_batch(known, ["doc_id", "text_hash", "fp"])

        return apply

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_arrow(rows, make, f"doc_id {kind}, text_hash long, fp long")


def _ring(fp: Column, start: int, bits: int) -> Column:
    """The fingerprint turned so that the given segment comes first (highest)."""
    turn = start * bits
    if not turn:
        return fp
    return F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn))


def _leading(x: Column, segments: int, bits: int) -> Column:
    return F.shiftrightunsigned(x, 64 - segments * bits) if segments < 64 // bits else x


def budget(length: int, segments: int) -> int:
    return length * DISTANCE // segments


def _differ(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame, segments: int = SEGMENTS, paired_most: int = PAIRED) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp``: their components are those of all pairs
    at most two bits apart.
    """
    bits = 64 // segments
    if segments * bits != 64 or segments <= DISTANCE:
        raise ValueError("segments must divide 64, and be more than the distance")
    lead = max(n for n in range(segments) if budget(n, segments) == 0)
    keyed = prints.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("start"), _ring(F.col("fp"), i, bits).alias("ring"))
                    for i in range(segments)
                )
            )
        ).alias("x"),
    ).select("fp", "x.*", _leading(F.col("x.ring"), lead, bits).alias("key"))
    shared = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    # A key has as many rows here as distinct fingerprints; large ones are split by their forms.
    met = staged(keyed.join(shared, ["start", "key"]), "simhash-keys")
    few = met.where(F.col("n") <= paired_most).drop("n")
    other = few.select("start", "key", F.col("fp").alias("fp2"), F.col("ring").alias("ring2"))
    budgets = [(n, budget(n, segments)) for n in range(1, segments + 1)]
    chain = F.lit(True)
    for (n, now), (_, later) in pairwise(budgets):
        if now < later and n > lead:  # where the budget is about to rise, it's tightest
            chain &= _differ(_leading(F.col("ring"), n, bits), _leading(F.col("ring2"), n, bits)) <= now
    paired = (
        few.join(other, ["start", "key"])
        .where(F.col("fp") < F.col("fp2"))
        .where(chain)
        .where(_differ(F.col("fp"), F.col("fp2")) <= DISTANCE)
        .select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    )
    free = 64 - lead * bits
    flips = [F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(free))]
    many = met.where(F.col("n") > paired_most).select(
        "start", "fp", F.explode(F.array(*(F.col("ring").bitwiseXOR(f) for f in flips))).alias("form")
    )
    hub = many.groupBy("start", "form").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    starred = many.join(hub.drop("n"), ["start", "form"]).where("fp <> a").select("a", F.col("fp").alias("b"))
    return paired.union(starred).distinct()


def components_of(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp, root (a fingerprint that stands for the component), component_id."""
    prints = staged(fingerprints(documents), "simhash")
    known = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = components(links(known.select("fp")))
    of = known.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = of.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = of.select("fp", "root").join(ids, "root")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component: that with the least doc_id (of repeated ids, the least
    text); the columns stay as they are.
    """
    chosen = (
        components_of(documents)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(
            F.col("doc_id").alias("__id"),
            F.col("text_hash").alias("__hash"),
            F.col("root").alias("__root"),
        )
        .distinct()
    )
    row = F.struct(*(F.col(c) for c in documents.columns))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return (
        documents.join(chosen, same)
        .groupBy("__root")
        .agg(F.min_by(row, F.struct("text", F.xxhash64(row))).alias("__row"))
        .select("__row.*")
    )
