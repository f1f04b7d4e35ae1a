import hashlib

import public_tokenizers as tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from adloom.llm import byte_bpe
from adloom.llm.queries import op1_byte_level_bpe

PATH = tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)
ENCODING = tiktoken.Encoding(
    "own", pat_str=tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
TEXTS = [
    None, "", " ", "  \n\t ", "don't  stop", "It's 12345 and ½ of Ⅷ", "日本語のテキスト", "👩‍👩‍👧 family",
    "é é", "<|endoftext|>", "\x00\x1c\x85 a", "new letters ࢏'s ՘'s \U00010940's",
    "x" * 50_000, "word " * 60_000, "a   b" * 30_000, "1" * 20_000, "　" * 300 + "z",
]


@pytest.fixture(scope="module")
def codec():
    plain = byte_bpe.plain_pattern(tokenizers.PATTERN)
    return byte_bpe.Codec(RANKS, byte_bpe.merges_of(RANKS), tokenizers.PATTERN, plain)


def test_ids_as_the_other_library_has_them(codec, monkeypatch):
    monkeypatch.setattr(byte_bpe.chunks, "__defaults__", (1000,))
    for text in TEXTS:
        want = ENCODING.encode_ordinary(text or "")
        assert codec.encode(text or "").tolist() == want
        assert codec.decode(want) == (text or "").encode()


def test_pattern_splits_every_character_as_the_library_does(codec):
    for c in (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000):
        if c < "\u3100" or "\ua000" <= c <= "\uffff":
            text = f"a{c}'s {c} 1{c}"
            assert codec.pieces(text) == [p for p, _ in codec.library.pre_tokenize_str(text)]


def test_offsets_cover_split_characters(codec):
    for text in ("naïve 👩‍👧 日本", "plain words", "\U0001f9ff՘"):
        ids = codec.encode(text)
        starts, ends = codec.offsets(text, ids)
        ends_in_bytes, at = [], 0
        for i, start, end in zip(ids.tolist(), starts, ends, strict=True):
            own = RANKS_BACK[i]
            piece = text.encode()[at : at + len(own)]
            assert piece == own and piece in text[start:end].encode()
            at += len(own)
            ends_in_bytes.append(at)
        assert at == len(text.encode()) and ends[-1] == len(text)


RANKS_BACK = {r: t for t, r in RANKS.items()}


def test_odd_rows(spark):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(TEXTS)] + [(1, "again"), (1, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x"))
    coded = byte_bpe.encode(frame, PATH, tokenizers.PATTERN, offsets=True)
    back = byte_bpe.decode(coded, PATH).collect()
    assert sorted(r.bytes.decode() for r in back) == sorted(t or "" for _, t in rows)
    assert all(len(r.ids) == len(r.starts) == len(r.ends) for r in coded.collect())
    assert byte_bpe.encode(frame.limit(0), PATH, tokenizers.PATTERN).count() == 0


def test_query_against_the_other_library(spark):
    folder = "/root/testdata/sf0.001"
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r.doc_id: r for r in op1_byte_level_bpe(spark, folder).collect()}
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = ENCODING.encode_ordinary(row.text or "")
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == sha(" ".join(map(str, ids)).encode())
        assert got[row.doc_id].decoded_sha256 == sha((row.text or "").encode())
