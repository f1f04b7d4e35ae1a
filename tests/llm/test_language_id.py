import math
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from adloom.llm import language_id as li
from adloom.llm.common import table
from adloom.llm.queries import op10_language_id

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def segmentations(word, known, probability):
    """The sum over all segmentations, one by one."""
    if not word:
        return 1.0
    return sum(
        (probability[word[:k]] if word[:k] in known else li.UNKNOWN if k == 1 else 0.0)
        * segmentations(word[k:], known, probability)
        for k in range(1, min(li.LONGEST, len(word)) + 1)
    )


def test_forward_sums_all_segmentations():
    pieces = sorted([li.START, "a", "b", "ab", "ba", "aba", li.START + "a", "c"])
    rng = np.random.default_rng(1)
    table_ = np.vstack([rng.random((len(pieces), 2)), np.full(2, li.UNKNOWN), np.zeros(2)])
    model = li.Model(pieces, ["x", "y"], np.zeros(2), table_)
    scorer = li.Scorer(model)
    words = ["a", "ab", "abab", "cab", "zzz", "abcabcabca", "é"]
    scorer.add([words])
    for word in words:
        for lang in range(2):
            known = dict(zip(pieces, table_[:, lang], strict=False))
            want = math.log(segmentations(li.START + word, known, known))
            assert abs(scorer.scores[scorer.row[word], lang] - want) < 1e-9


def test_odd_rows(spark):
    rows = [
        (1, "the cat sat on the mat with the hat", "en", "s", 1),
        (2, "der Hund und die Katze auf der Wiese", "de", None, 1),
        (2, "der Hund und die Katze auf der Wiese", "de", None, 1),
        (None, "the dog and the cat", "en", None, None),
        (3, None, "de", "s", None), (4, "", None, None, 0), (5, "123 ½ !? _", "en", "s", 3),
        (6, "the " * 100_000, None, None, None), (7, "Ж" * 3000, None, None, None), (8, "日本語", None, None, None),
    ]
    frame = spark.createDataFrame(rows, DDL).withColumn("score", F.lit("x"))
    pieces = li.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = li.train(frame, pieces)
    got = li.predict(frame, model, "doc_id").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3, 4, 5, 6)] == ["en", "de", "und", "und", "und", "en"]
    assert by[4].score == 0 and by[7].lang_pred in ("en", "de")
    none = li.predict(frame, li.train(frame.limit(0), pieces), "doc_id").collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert li.predict(frame.limit(0), model, "doc_id").count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in table(spark, folder, "documents").collect()}
    rows = op10_language_id(spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert len(held) > 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_every_lower_case_piece_is_used():
    pieces = li.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert max(map(len, pieces)) == li.LONGEST == 16
    assert {li.START + w for w in ("people", "because", "before")} <= set(pieces)


def test_long_words_stay_whole():
    pieces = sorted([li.START, "a", "b", "ab", "bab", "abababababababab", li.START + "a"])
    rng = np.random.default_rng(2)
    table_ = np.vstack([rng.random((len(pieces), 2)) / 100, np.full(2, li.UNKNOWN), np.zeros(2)])
    table_[0, 1] = 1e-11
    scorer = li.Scorer(li.Model(pieces, ["x", "y"], np.zeros(2), table_))
    words = ["ab" * 30, "ab" * 31 + "c", "ab" * 33, "é" * 130 + "ba", "ab" * 700]
    assert li.words_of(" ".join(words)) == words
    scorer.add([words])
    for word in words:
        for lang in range(2):
            known = dict(zip(pieces, table_[:, lang], strict=False))
            text, logs = li.START + word, [0.0]
            for j in range(1, len(text) + 1):  # in logarithms, without stretches
                parts = [
                    logs[j - k] + math.log(known.get(text[j - k : j], li.UNKNOWN if k == 1 else 0.0))
                    for k in range(1, min(16, j) + 1)
                    if k == 1 or text[j - k : j] in known
                ]
                logs.append(np.logaddexp.reduce(parts))
            assert abs(scorer.scores[scorer.row[word], lang] - logs[-1]) < 1e-7
