import hashlib
import random

import pytest
from pyspark.sql import functions as F

from adloom.llm import suffix_dedup as sd
from adloom.llm.common import table
from adloom.llm.queries import op9_suffix_array_dedup


def brute(texts):
    """Per text: removed spans and what is left."""
    datas = [(t or "").encode() for t in texts]
    counts = {}
    for data in datas:
        for i in range(len(data) - sd.LENGTH + 1):
            s = hash(data[i : i + sd.LENGTH])
            counts[s] = counts.get(s, 0) + 1
    result = []
    for data in datas:
        gone = bytearray(len(data))
        for i in range(len(data) - sd.LENGTH + 1):
            if counts[hash(data[i : i + sd.LENGTH])] > 1:
                gone[i : i + sd.LENGTH] = b"\x01" * sd.LENGTH
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        result.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result


def odd_texts():
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choices("abcdefgh é\n", k=n))
    shared, base = noise(430), noise(3000)
    texts = [None, "", "a" * 399, "a" * 400, "a" * 5000, "ab" * 900, noise(399)]
    texts += [noise(rng.randint(0, 700)) + shared + noise(rng.randint(0, 700)) for _ in range(6)]
    texts += [noise(60) + shared[3:402] + noise(60), noise(9) + shared[1:403] + noise(90) + shared[7:420]]
    for _ in range(25):  # near-copies with a few changes each
        near = list(base)
        for _ in range(rng.randint(0, 6)):
            near[rng.randrange(len(near))] = rng.choice("xyzé")
        texts.append("".join(near))
    return texts + [base, base, texts[-1], "tail " + base[500:1200] + base[100:900]]


@pytest.mark.parametrize("together", [sd.TOGETHER, 3])
def test_odd_rows_against_brute_force(spark, together, monkeypatch):
    monkeypatch.setattr(sd, "AT_ONCE", 5)
    texts = odd_texts()
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "data": F.lit("x")})
    length = lambda r: sum(s.stop - s.start for s in r.spans)
    got = [(str(r.doc_id), r.n_bytes, length(r), len(r.spans), r.kept_sha256) for r in sd.deduplicated(frame, together).collect()]
    assert sorted(got) == sorted((str(i), *w) for (i, _), w in zip(rows, brute(texts), strict=True))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert sd.deduplicated(frame).count() == 0


def test_long_texts_in_chunks(monkeypatch):
    rng = random.Random(8)
    data = bytes(rng.choices(range(97, 105), k=5000))
    whole = sd.runs(data)
    monkeypatch.setattr(sd, "CHUNK", 700)
    cut = sd.runs(data)
    place = lambda r: [p for a, b, p in zip(*r[:3], strict=True) for _ in range(a, b + 1)]
    assert place(whole) == place(cut) and len(place(cut)) == 5000 - sd.LENGTH + 1


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted(table(spark, folder, "documents").collect(), key=lambda r: r.doc_id)
    found = sorted(map(tuple, op9_suffix_array_dedup(spark, folder).collect()))
    whole = [r for r in found if "\ufffd" not in r[5]]
    assert all(hashlib.sha256(r[5].encode()).hexdigest() == r[4] for r in whole) and len(whole) > 0.9 * len(found)
    got = [r[:5] for r in found]
    assert got == [(r.doc_id, *w) for r, w in zip(rows, brute([r.text for r in rows]), strict=True)]
