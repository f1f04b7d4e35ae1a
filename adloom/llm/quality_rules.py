"""Quality rules, lines first: each line is judged by its punctuation, as navigation and as
boilerplate; lines that fail are removed, and a document that loses too much of its text goes.

A line fails as noise or a table if marks and bars are frequent among its words; as navigation if separators
part it into short items without an end mark, or if it's one of ``MENU`` or more lines in a row of a few words
and no end mark; as boilerplate if it has one of the phrases. A heading alone is no menu.

Everything is a column expression over one row: no shuffle, no Python.

Null and empty texts have no words, so they fail the base rule; so does any text under 20 words.
Very long texts are judged whole, repeated rows each for itself. An empty table gives an empty result. Columns other
than the ones named are passed over by ``measure`` and kept as they are by ``clean``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, text_or_empty

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: A document may lose this share of the characters of its lines.
MAX_LOST = 0.5
#: Of a line's words, so many may come with a mark of noise or of a menu.
MAX_MARKS = 0.25

SYMBOLS = "[#*$%&|<>]"
#: Runs of symbols and repeated end marks; bars, which separate menus and tables, count one by one.
MARK = r"[#*$%&<>!?]{2}"
#: Between the items of a menu in one line; such items have a few words each, the line no end mark.
SEPARATOR = " [|>/·•»] "
ITEM_WORDS = 3
#: So many lines in a row, each of a few words and no end mark, are a menu with one item a line.
MENU = 5
ENDS = r"[.!?…:;,][\x20\x09-\x0D\x22')\]]*\z"
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "uses cookies", "use cookies", "enable javascript", "lorem ipsum",
    "sign in to continue", "log in to comment", "subscribe to our newsletter",
    "subscribe to the newsletter", "click here to", "powered by wordpress",
)


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _tail(array: str, skipped: int) -> Column:
    return F.slice(array, 1 + skipped, F.greatest(F.size(array) - skipped, F.lit(0)))


def _joined(array: str, apart: int) -> Column:
    """Hashes of elements so far apart, in pairs."""
    head = F.slice(array, 1, F.greatest(F.size(array) - apart, F.lit(0)))
    return F.zip_with(head, _tail(array, apart), lambda a, b: F.xxhash64(a, b))


def line_fails(line: Column, lower: Column) -> Column:
    """Whether a line, also given in lower case, is noise, navigation or boilerplate."""
    count = lambda c: F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))
    marks = F.regexp_count(line, F.lit(MARK)) + count("|")
    words, parts = count(" ") + 1, F.regexp_count(line, F.lit(SEPARATOR))
    marked = marks > words * MAX_MARKS
    menu = (parts >= 2) & (words - parts <= (parts + 1) * ITEM_WORDS) & ~line.rlike(ENDS)
    return reduce(lambda a, phrase: a | lower.contains(phrase), BOILERPLATE, marked | menu)


def _menu_marks(lines: str) -> Column:
    """One character for each line: n where it's one of ``MENU`` or more short ones in a row."""
    words = lambda line: F.regexp_count(line, F.lit(WORD))
    short = lambda line: (F.length(line) <= 60) & words(line).between(1, ITEM_WORDS) & ~line.rlike(ENDS)
    flags = F.array_join(F.transform(lines, lambda line: F.when(short(line), "s").otherwise("l")), "")
    # A line is in such a run if, for some n, n short lines come before it and the others after it.
    run = "|".join(f"(?<=s{{{n}}})s(?=s{{{MENU - 1 - n}}})" for n in range(MENU))
    return F.regexp_replace(flags, run, "n")


def _measured(documents: DataFrame, kept: list[str]) -> DataFrame:
    """``kept`` and a struct ``__quality`` of the measures and the cleaned text."""
    text = F.col("__text")
    at = lambda x, name: x.getField(name)
    done = [*kept, "__n_words", "__word_chars", "__n_symbols", "__line_chars", "__n_lines"]
    lines = [*done, "__n_dup_lines", "__n_good", "__clean"]
    rows = (
        documents.withColumn("__text", text_or_empty())
        .select(
            *kept,
            "__text",
            F.array_remove(F.split(text, f"{SPACE}+"), "").alias("__words"),
            F.split(text, "\n").alias("__lines"),
        )
        .select(
            *kept,
            _size(F.col("__words")).alias("__n_words"),
            F.length(F.array_join("__words", "")).cast("long").alias("__word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, f"{SYMBOLS}+", "")))
            .cast("long")
            .alias("__n_symbols"),
            (F.length(text) - F.size("__lines") + 1).alias("__line_chars"),
            _size(F.col("__lines")).alias("__n_lines"),
            F.filter("__lines", lambda line: line.rlike(WORD)).alias("__full"),
            F.array_compact(
                F.zip_with(
                    F.zip_with(
                        "__lines",
                        F.split(F.lower(text), "\n"),
                        lambda line, lower: F.when(~line_fails(line, lower), line),
                    ),
                    F.split(_menu_marks("__lines"), ""),
                    lambda line, mark: F.when(mark != "n", line),
                )
            ).alias("__good"),
            F.transform("__words", lambda w: F.xxhash64(w)).alias("__h1"),
        )
        .select(
            *done,
            (_size(F.col("__full")) - _size(F.array_distinct("__full"))).alias("__n_dup_lines"),
            _size(F.col("__good")).alias("__n_good"),
            F.array_join("__good", "\n").alias("__clean"),
            _joined("__h1", 1).alias("__h2"),
        )
        .select(*lines, _joined("__h2", 2).alias("__h4"))
        .select(*lines, _joined("__h4", 4).alias("__h8"))
        # Only texts in which some window occurs twice sort their windows.
        .select(
            *lines,
            F.when(
                F.size(F.array_distinct("__h8")) < F.size("__h8"),
                F.sort_array(
                    F.transform("__h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                ),
            ).alias("__sorted"),
        )
        .select(
            *lines,
            F.sort_array(
                F.array_distinct(
                    F.flatten(
                        F.array_compact(
                            F.zip_with(
                                "__sorted",
                                _tail("__sorted", 1),
                                lambda a, b: F.when(
                                    at(a, "h") == at(b, "h"), F.array(at(a, "i"), at(b, "i"))
                                ),
                            )
                        )
                    )
                )
            ).alias("__at"),
        )
        # A window adds the words up to the next one's start, its own eight at most.
        .select(
            *lines,
            F.coalesce(
                F.aggregate(
                    F.zip_with(
                        "__at",
                        _tail("__at", 1),
                        lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))),
                    ),
                    F.lit(0).cast("long"),
                    lambda total, n: total + n,
                ),
                F.lit(0).cast("long"),
            ).alias("__n_repeat"),
        )
    )
    failed = (F.col("__n_words") < MIN_WORDS) | (
        F.col("__n_repeat") * 100 > F.col("__n_words") * MAX_REPEATED_PERCENT
    )
    kept_chars = F.length("__clean") - F.greatest(F.col("__n_good") - 1, F.lit(0))
    loses = kept_chars < F.col("__line_chars") * (1 - MAX_LOST)
    return rows.select(
        *kept,
        F.struct(
            F.col("__n_words").alias("n_words"),
            F.col("__word_chars").alias("word_chars"),
            F.col("__n_symbols").alias("n_symbols"),
            F.col("__n_dup_lines").alias("n_dup_lines"),
            F.col("__n_repeat").alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & ~loses).alias("kept"),
            (F.col("__n_lines") - F.col("__n_good")).alias("n_removed_lines"),
            F.col("__clean").alias("clean_text"),
        ).alias("__quality"),
    )


def measure(documents: DataFrame) -> DataFrame:
    """doc_id, the measures, the verdict, the number of removed lines and the cleaned text."""
    return _measured(documents, ["doc_id"]).select("doc_id", "__quality.*")


def clean(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their failing lines removed; the columns stay as they are."""
    columns = documents.columns
    now = {"text": F.col("__quality.clean_text")}
    now["n_chars"] = F.length(now["text"]).cast("long")
    return (
        _measured(documents, columns)
        # The row's number keeps the optimizer from moving the filter, and all it is computed
        # from with it, below the steps that compute each thing once.
        .withColumn("__row", F.monotonically_increasing_id())
        .where(F.col("__quality.kept") & (F.col("__row") >= 0))
        .select(*(now[c].alias(c) if c in now else F.col(c) for c in columns))
    )
