import random

import pytest
import xxhash
from pyspark.sql import functions as F

from adloom.llm import simhash
from adloom.llm.components import components
from adloom.llm.queries import op8_simhash_pigeonring

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """Class representative by position, for fingerprints."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def sets(pairs):
    groups = {}
    for member, group in pairs:
        groups.setdefault(group, set()).add(member)
    return sorted(map(sorted, groups.values()))


def test_fingerprints():
    words = ["Ä", "the", "Tab", "x" * 5000, " em", "É", "0"]
    texts = [None, "", " \n", "one", "one two", "One\tTWO\x0bthree", "word " * 30_000]
    texts += [" ".join(random.Random(i).choices(words, k=i)) for i in range(1, 60)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_print(t)


@pytest.mark.parametrize("paired_most", [64, 2])
def test_links_find_every_pair(spark, paired_most):
    rng = random.Random(7)
    prints = {0, 1, 3, (1 << 64) - 1}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            changed = base
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                changed ^= 1 << bit
            prints.add(changed)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.links(frame, paired_most=paired_most)
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 for a, b in edges.collect())
    found = {r.node: r.root for r in components(edges).collect()}
    got = sets((p, found.get(p, p)) for p in signed)
    assert got == sets(zip(signed, brute_classes(prints), strict=True))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(100, 130)] + [(5, 5), (1, 0)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 130), 200]}
    assert {r.node: r.root for r in rows} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows_and_keeping_one(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (5, long, None, None, 1),
        (3, long, "en", "s", None),
        (3, long, "en", "s", None),
        (None, long, None, None, None),
        (9, None, None, None, 0),
        (7, "", None, None, 0),
        (7, "another text here", None, None, 0),
        (None, "of none but null ids", None, None, 0),
    ]
    frame = spark.createDataFrame(rows, DDL).withColumns({"fp": F.lit("x"), "root": F.lit(1)})
    found = simhash.components_of(frame).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == [
        ("3", "3"), ("3", "3"), ("5", "3"), ("7", "7"), ("7", "7"), ("9", "7"),
        ("None", "3"), ("None", "None"),
    ]
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((str(r.doc_id), r.text[:7]) for r in kept.collect()) == [
        ("3", "w0x0 w1"), ("7", ""), ("7", "another"), ("None", "of none"),
    ]
    assert simhash.components_of(frame.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op8_simhash_pigeonring(spark, folder).collect()}
    prints = [brute_print(r.text) for r in rows]
    classes = brute_classes(prints)
    least = {}
    for r, c in zip(rows, classes, strict=True):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert got == {r.doc_id: (f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, classes, strict=True)}
