"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

Each source's documents are put in a random but fixed order (by a digest of seed, id, size and
text) and laid end to end; its words, run through up to three times, are cut into blocks of equal
size. Slot k of the mix has the point frac(k * golden ratio), which falls into one source's part of
the cumulative shares; a source's slots are ranked, and slot rank r takes its block r. As many slots
as blocks are dealt out; golden-ratio points miss each source's number of blocks by a few at most: slots
beyond a source's last block stay empty and blocks without a slot follow at the end.

Sources, by code point and null last, weigh ``WEIGHTS`` in turn. Each source's target is its share of
all words, three times its own words at most; what is cut off is shared again by weight.

A null or empty text has no words: it's never taken. A source without words has target 0. Repeated
rows are documents of their own, laid side by side. Null ids are documents like any other. An
empty table gives an empty result. Very long texts are counted whole. Columns other than doc_id, text and
source, of any name and type, are passed over by ``mix`` and kept as they are by ``repeated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged, text_or_empty

WEIGHTS = (5, 2, 1)
MOST = 3  # times a source, and so a document, may be run through
BLOCK_WORDS = 2048
SEED = "mix"
#: The golden ratio's fraction times 2^31, odd: products with slot numbers, modulo 2^31, are exact.
GOLDEN, POINTS = 1327217885, 1 << 31
#: Documents (or slots) that are ordered in one task, about: running sums go by parts of this size.
PART = 20_000
#: The same where whole rows, with their texts, move.
PART_OF_TEXTS = 1_000
#: More sources than this are joined and not broadcast.
BROADCAST_SOURCES = 100_000


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source, label (the source, never null), size in words, shuffle key."""
    key = F.concat_ws(
        "\x1f", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.md5(text_or_empty().cast("binary")),
    )
    return documents.select(
        "*",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("__label"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("__size"),
        F.md5(key.cast("binary")).alias("__key"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """label, source_size, source_docs, target: one row for each source, not for each document.

    Sources stop at ``MOST`` times their size in the order of that limit per weight. The words
    left over the weights left rise as long as the next source has to stop, and fall after that:
    their maximum is the level that every other source gets by its weight.
    """
    by_name = Window.orderBy(F.col("label") == "", "label")
    ratio = F.col("cap") / F.col("weight")
    before = Window.orderBy(ratio, "label").rowsBetween(
        Window.unboundedPreceding, -1
    )
    every = Window.partitionBy()
    return (
        sizes.groupBy(F.col("__label").alias("label"))
        .agg(F.sum("__size").alias("source_size"), F.count("*").alias("source_docs"))
        .withColumn("turn", (F.row_number().over(by_name) - 1) % len(weights))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("turn").cast("int") + 1))
        .withColumn("cap", MOST * F.col("source_size"))
        .withColumn("all_words", F.sum("source_size").over(every))
        .withColumn("all_weights", F.sum("weight").over(every))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "level",
            (F.col("all_words") - F.col("capped_before"))
            / (F.col("all_weights") - F.col("weights_before")),
        )
        .withColumn("final", F.max("level").over(every))
        .select(
            "label",
            "source_size",
            "source_docs",
            F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")).alias("target"),
        )
    )


def _ahead(parts: DataFrame, n: str) -> DataFrame:
    """Of each part of a label, the sum of the parts before it."""
    before = Window.partitionBy("label").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("label", "part", F.coalesce(F.sum(n).over(before), F.lit(0)).alias("ahead"))


def laid_out(sizes: DataFrame, totals: DataFrame, part: int = PART) -> DataFrame:
    """Adds start (the words of the source before the document, in shuffled order) and the
    source's figures. A source of any size is summed in parts, by the leading digits of the key.
    """
    lead = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
    parts = F.ceil(F.col("__source_docs") / part)
    split = sizes.join(totals, "__label").withColumn("__part", F.floor(lead * parts / F.lit(1 << 32)))
    sums = split.groupBy(F.col("__label").alias("label"), F.col("__part").alias("part")).agg(
        F.sum("__size").alias("n")
    )
    within = (
        Window.partitionBy("__label", "__part")
        .orderBy("__key", "__size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = _ahead(sums, "n").withColumnsRenamed({"label": "__label", "part": "__part", "ahead": "__ahead"})
    return (
        split.withColumn("__inside", F.coalesce(F.sum("__size").over(within), F.lit(0)))
        .join(ahead, ["__label", "__part"])
        .withColumn("__start", F.col("__ahead") + F.col("__inside"))
    )


def schedule(totals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """label, block, slot: which slot of the mix takes which block of a source.

    Slots are mapped to sources by an equi-join on equal bins of [0, 1): a large source spans
    many bins, and no bin holds more slots than another.
    """
    spark = totals.sparkSession
    shares = totals.select("label", F.ceil(F.col("limit") / block_words).alias("blocks")).where(
        "blocks > 0"
    )
    row = shares.agg(F.sum("blocks"), F.count("*")).first()
    slots, sources = row[0] or 0, row[1]
    bins = max(1024, 4 * sources)
    bin_of = lambda x: F.least(F.floor(x * (bins / POINTS)), F.lit(bins - 1))
    in_order = Window.orderBy("label").rowsBetween(Window.unboundedPreceding, 0)
    to = F.sum("blocks").over(in_order)
    point_of = lambda x: x * F.lit(POINTS / max(1, slots))
    ranges = shares.select(
        "label", point_of(to - F.col("blocks")).alias("from"), point_of(to).alias("to")
    ).withColumn("bin", F.explode(F.sequence(bin_of(F.col("from")), bin_of(F.col("to")))))
    dealt = (
        spark.range(slots)
        .select(F.col("id").alias("slot"), (F.col("id") % POINTS * GOLDEN % POINTS).alias("point"))
        .withColumn("bin", bin_of(F.col("point")))
        .join(ranges, "bin")
        .where((F.col("point") >= F.col("from")) & (F.col("point") < F.col("to")))
        .select("label", F.floor(F.col("slot") / PART).alias("part"), "slot")
    )
    ahead = _ahead(dealt.groupBy("label", "part").agg(F.count("*").alias("n")), "n")
    rank = F.row_number().over(Window.partitionBy("label", "part").orderBy("slot")) - 1
    return (
        dealt.withColumn("inside", rank)
        .join(ahead, ["label", "part"])
        .select("label", (F.col("ahead") + F.col("inside")).alias("block"), "slot")
    )


def _planned(
    documents: DataFrame, weights: tuple[int, ...], part: int = PART
) -> tuple[DataFrame, DataFrame]:
    """The totals of the sources (also limit, the words to take) and the documents laid out."""
    sizes = sized(documents)
    totals = staged(
        targets(sizes, weights).withColumn("limit", F.round("target").cast("long")), "mix-sources"
    )
    few = totals.count() <= BROADCAST_SOURCES
    named = totals.toDF(*(f"__{c}" for c in totals.columns))
    return totals, laid_out(sizes, F.broadcast(named) if few else named, part)


def _runs() -> Column:
    """In how many runs through its source a document's first word is taken."""
    more = F.floor((F.col("__limit") - F.col("__start") - 1) / F.col("__source_size")) + 1
    return F.when(F.col("__start") < F.col("__limit"), more).otherwise(0)


def mix(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The pieces of the mix: slot (null: after the last), doc_id, source, size, source_size,
    target, start, from_word and n_words of the piece. A document that isn't taken has one
    piece without words.
    """
    totals, documents = _planned(documents.select("doc_id", "text", "source"), weights)
    documents = staged(documents.drop("text"), "mix-documents")
    begin = F.col("__start") + F.col("run") * F.col("__source_size")
    end = F.least(begin + F.col("__size"), F.col("__limit"))
    known = [F.col("doc_id"), F.col("source"), *(F.col(f"__{c}").alias(c) for c in ("size", "source_size", "target", "start"))]
    taken = (
        documents.where((_runs() > 0) & (F.col("__size") > 0))
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), _runs() - 1)))
        .withColumns({"begin": begin, "end": end})
        .withColumn(
            "block",
            F.explode(F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))),
        )
        .withColumn("low", F.greatest(F.col("begin"), F.col("block") * block_words))
        .withColumn("n_words", F.least(F.col("end"), (F.col("block") + 1) * block_words) - F.col("low"))
        .withColumn("from_word", F.col("low") - F.col("begin"))
    )
    slots = schedule(totals, block_words).withColumnRenamed("label", "__label")
    untaken = documents.where((_runs() == 0) | (F.col("__size") == 0))
    return (
        taken.join(slots, ["__label", "block"], "left")
        .select("slot", *known, "from_word", "n_words")
        .union(
            untaken.select(
                F.lit(None).cast("long"), *known, F.lit(0).cast("long"), F.lit(0).cast("long")
            )
        )
    )


def taken_of(pieces: DataFrame) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken and first_slot, the first slot
    of the mix that takes words of it (null: none, or only blocks after the last slot).
    """
    known = ["doc_id", "source", "size", "source_size", "target", "start"]
    columns = ["doc_id", "size", "source_size", "target", "taken", "first_slot"]
    whole = pieces.where("n_words > 0").groupBy(*known).agg(
        F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot")
    )
    rest = pieces.where("n_words = 0").withColumns({"taken": F.col("n_words"), "first_slot": F.col("slot")})
    return whole.select(*columns).union(rest.select(*columns))


def repeated(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents as often as the mix takes their first word: whole documents, nought to three
    times each; the columns stay as they are.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("__row")
    _, laid = _planned(documents.select(row, "doc_id", "text", "source"), weights, PART_OF_TEXTS)
    return (
        laid.where((_runs() > 0) & (F.col("__size") > 0))
        .withColumn("__run", F.explode(F.sequence(F.lit(1).cast("long"), _runs())))
        .select("__row.*")
    )
