import random

import public_tokenizers
import pytest

from adloom.llm import token_counts as tc
from adloom.llm.common import table
from adloom.llm.queries import op4_token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def greedy(word, pieces, longest):
    """Longest match first, piece by piece."""
    rest, first, n = tc.START + word, True, 0
    while rest:
        for k in range(min(longest, len(rest)), 0, -1):
            if rest[:k] in pieces and rest.startswith(tc.START) == first:
                break
        else:
            return None
        rest, first, n = rest[k:], False, n + 1
    return n


def test_small_vocabularies_against_plain_matching():
    rng = random.Random(5)
    for _ in range(300):
        pieces = {"".join(rng.choices("ab", k=rng.randint(1, 5))) for _ in range(rng.randint(1, 8))}
        pieces |= {tc.START + "".join(rng.choices("abc", k=rng.randint(0, 4))) for _ in range(rng.randint(0, 5))}
        automaton = tc.Automaton(pieces)
        for _ in range(60):
            word = "".join(rng.choices("aabbc", k=rng.randint(1, 14)))
            assert automaton.count(word) == greedy(word, pieces, 6), (pieces, word)


@pytest.fixture(scope="module")
def pieces():
    return tc.read_pieces(PATH)


def test_odd_rows(spark, pieces):
    long = "antidisestablishment" * 3000
    rows = [(1, None), (2, ""), (3, " \n\x0b "), (4, "two words"), (4, "two words"), (None, "日　本 ▁x"), (5, long)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words")
    got = {r.doc_id: tuple(r)[1:] for r in tc.count_tokens(frame, PATH).collect()}
    assert got[1] == got[2] == got[3] == (0, 0, 0)
    assert got[4][0] == 2 and got[5] == (1, greedy(long, set(pieces), 20), 0)
    assert got[None][0] == 2 and tc.count_tokens(frame.limit(0), PATH).count() == 0


def test_query_against_plain_matching(spark, pieces):
    folder = "/root/testdata/sf0.001"
    own, longest = set(pieces), max(map(len, pieces))
    got = {r.doc_id: tuple(r)[1:] for r in op4_token_counts(spark, folder).collect()}
    for r in table(spark, folder, "documents").collect():
        counts = [greedy(w.decode(), own, longest) for w in (r.text or "").encode().split()]
        want = (len(counts), sum(1 if n is None else n for n in counts), counts.count(None))
        assert got[r.doc_id] == want
