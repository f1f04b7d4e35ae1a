import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from adloom.llm import personal_data as pd
from adloom.llm.queries import op2_personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "a@b.c a.b@c.d@e.f x@y @z.z é@a.b a@b-.-c.", "a@b@c.de", "1.2.3.4.5.6.7.8.9 256.1.1.1 1.1.1.256 001.02.3.255",
    "1.2.3 .1.2.3.4. 1..2.3.4.5", "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111111111111",
    "+1 (974) 555-3436 +12 +1 2 3 4 5 6 7 8 9 0 +1 (555) 12 +1--------5 +4940123456789 ", "+1+12345678901 5",
    "call (974) 555-3436 now, or write to jo [at] example [dot] com; order 4111111111111112",
    "9" * 60_000, "a" * 60_000 + "@", "1." * 30_000, "@" * 20_000, "+1 " * 20_000,
]


def brute(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p[-9:]) <= 255 and len(p) < 99 for p in m.group().split(".")) if kind == "ip" else 0,
                "card": 14 <= len(digits) <= 19 and sum(
                    sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))
                ) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_base_spans_are_those_of_the_patterns():
    for text in TEXTS[:10]:
        assert pd.base_spans(text or "") == brute(text)
    for text in TEXTS[10:]:  # the plain patterns would take minutes here
        assert len(pd.base_spans(text)) == {"1": 7_500}.get(text[0] if "." in text else "", 0)


def test_loose_candidates_keep_clear_of_base_spans():
    text = TEXTS[9]
    found = pd.candidates(text)
    assert [text[s:e] for s, _, e, _ in found] == [
        "(974) 555-3436", "jo [at] example [dot] com", "4111111111111112",
    ]
    assert all(code % 2 == 0 for *_, code in found)


def test_codes_can_be_read_back():
    for kind in range(4):
        for ballot in np.ndindex(3, 3, 3, 3):
            code = pd.code_of(kind, ballot, 15, True)
            k, b, n = pd.features_of(np.array([code]))
            assert (k[0], tuple(b[0]), n[0], code % 2) == (kind, ballot, 2, 1)


def test_reliabilities_and_classifier_follow_the_votes():
    rng = np.random.default_rng(3)
    tally = {}
    for _ in range(20_000):
        truth = rng.random() < 0.5
        good = [2 if rng.random() < (0.9 if truth else 0.1) else 0 for _ in range(3)]
        code = pd.code_of(3, (*good, int(rng.integers(3))), 12, bool(rng.random() < 0.3))
        tally[code] = tally.get(code, 0) + 1
    codes = np.array(sorted(tally))
    model = pd.fit(codes, np.array([tally[c] for c in codes], float))
    good, noise = model.reliability[3, 0], model.reliability[3, 3]
    assert abs(good[1, 2] - 0.9) < 0.03 and abs(good[0, 2] - 0.1) < 0.03
    assert abs(noise[1, 2] - noise[0, 2]) < 0.05
    assert pd.code_of(3, (2, 2, 2, 1), 12, False) in model.accepted
    assert pd.code_of(3, (0, 0, 2, 1), 12, False) not in model.accepted
    assert pd.fit(np.array([], int), np.array([])).accepted == ()


def test_odd_rows_and_redaction(spark):
    rows = [(i if i % 4 else None, t, None, "s", 7) for i, t in enumerate(TEXTS)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame = frame.withColumn("spans", F.lit(1))
    found = pd.detect(frame)
    assert found.count() == len(rows) and pd.detect(frame.limit(0)).count() == 0
    clean = pd.redact(frame)
    assert clean.columns == frame.columns
    kept = [r.text for r in clean.collect()]
    assert sorted(t is None for t in kept)[-2:] == [True, True]
    assert any((t or "").startswith("<phone>") for t in kept)
    assert not any(pd.base_spans(t or "") for t in kept if len(t or "") < 1000)


def test_query_against_the_patterns(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op2_personal_data(spark, folder).collect():
        want = brute(texts[r.doc_id])
        written = [f"{pd.KINDS[k]}:{s}:{e}" for s, k, e in want]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in want) for n in range(4)]
        assert set(written) <= set(r.spans.split(",") if r.spans else [])
