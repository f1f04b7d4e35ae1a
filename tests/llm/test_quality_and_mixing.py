import pytest
from pyspark.sql import functions as F

from adloom.llm import mixing, quality_rules
from adloom.llm.oracle import ORACLE
from adloom.llm.queries import registered
from checks import compare

FOLDER = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    connection = compare.connect(FOLDER)
    assert compare.compare(spark, connection, FOLDER, name, registered()[name], ORACLE[name]) is None


def odd(spark):
    prose = "A calm line of plain words ends here. "
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t\n", "en", "a", 4),
        (4, " ".join(f"w{i}" for i in range(60_000)), "en", "b", None),
        (5, prose + " ".join(f"u{i}" for i in range(40)), "en", "a", None),
        (5, prose + " ".join(f"u{i}" for i in range(40)), "en", "a", None),
        (None, " ".join(f"v{i}" for i in range(30)), None, None, None),
        (6, "home | about | shop | help | news\n" * 9 + " ".join(f"x{i}" for i in range(15)), "en", "a", 1),
        (7, " ".join(f"y{i}" for i in range(60)) + "\nAll Rights Reserved.", "en", "\x00", 1),
        (8, "same old words in a row here now " * 12, "en", "é", 1),
    ]
    return spark.createDataFrame(rows, DDL).withColumns({"size": F.lit(1), "n_words": F.lit("x")})


def test_measures_of_odd_texts(spark):
    got = {(r.doc_id, r.n_words): r for r in quality_rules.measure(odd(spark)).collect()}
    assert got[1, 0].base_failed and got[2, 0].base_failed and got[3, 0].n_dup_lines == 0
    assert got[4, 60_000].kept and got[4, 60_000].n_repeat_words == 0
    assert not got[6, 96].kept and got[6, 96].n_dup_lines == 8 and got[6, 96].n_symbols == 36
    assert got[7, 63].kept and got[7, 63].n_removed_lines == 1
    assert got[8, 96].base_failed and got[8, 96].n_repeat_words == 96
    assert quality_rules.measure(odd(spark).limit(0)).count() == 0


def test_cleaning_keeps_columns_and_removes_lines(spark):
    frame = odd(spark)
    rows = quality_rules.clean(frame)
    assert rows.columns == frame.columns
    kept = rows.collect()
    assert sorted(str(r.doc_id) for r in kept) == ["4", "5", "5", "7", "None"]
    seven = next(r for r in kept if r.doc_id == 7)
    assert "Rights" not in seven.text and seven.n_chars == len(seven.text)


def mixed(spark, frame, **how):
    pieces = mixing.mix(frame, **how).collect()
    return pieces, mixing.taken_of(mixing.mix(frame, **how)).collect()


def test_mix_of_odd_rows(spark):
    frame = odd(spark)
    pieces, taken = mixed(spark, frame, block_words=7)
    assert len(taken) == frame.count()
    assert all(0 <= r.taken <= 3 * r.size for r in taken)
    assert [r.taken for r in taken if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    for target in {r.target for r in taken}:
        assert sum(r.taken for r in taken if r.target == target) == round(target)
    slots = [(r.slot, r.n_words) for r in pieces if r.slot is not None]
    totals = {}
    for slot, n in slots:
        totals[slot] = totals.get(slot, 0) + n
    assert max(totals.values()) <= 7
    assert mixing.taken_of(mixing.mix(frame.limit(0))).count() == 0
    assert mixing.repeated(frame).columns == frame.columns


def test_targets_share_what_is_cut_off(spark):
    rows = [(i, "w " * n, "en", s, 0) for i, (s, n) in enumerate([("a", 10), ("b", 500), ("c", 500), (None, 2)])]
    _, taken = mixed(spark, spark.createDataFrame(rows, DDL), block_words=5)
    # a (weight 5) and the null source (weight 5) stop at three times their size.
    assert {r.size: round(r.target, 6) for r in taken if r.size != 500} == {10: 30.0, 2: 6.0}
    assert sorted(r.target for r in taken if r.size == 500) == pytest.approx([976 / 3, 976 * 2 / 3])


def test_schedule_is_even_everywhere(spark):
    totals = spark.createDataFrame([("=a", 5000), ("=b", 2000), ("", 1000)], "label string, limit long")
    rows = sorted((r.slot, r.label, r.block) for r in mixing.schedule(totals, 10).collect())
    assert len(rows) == 800
    for label, share in (("=a", 5 / 8), ("=b", 2 / 8), ("", 1 / 8)):
        ranks = [r[2] for r in rows if r[1] == label]
        assert ranks == list(range(len(ranks)))
        seen = 0
        for slot, got, _ in rows:
            seen += got == label
            assert abs(seen - share * (slot + 1)) < 4


def test_menus_go_and_headings_stay(spark):
    prose = "\n".join(" ".join(f"w{i}{j}" for j in range(9)) + "." for i in range(6))
    texts = {
        "one line": ("Home > Shop > Garden tools > Spades\nNews / Sport / Weather\nA · B · C\n" + prose, 3),
        "one item a line": ("Home\nAbout us\nShop\nHelp\nNews today\nContact\n" + prose, 6),
        "four short lines": ("Home\nAbout us\nShop\nHelp\n" + prose, 0),
        "short sentences": ("Yes.\nNo!\nWhy?\nWell:\nFine.\nGood.\n" + prose, 0),
        "a heading": ("The title\n\n" + prose + "\n\nNext\nA calm line ends here.", 0),
        "slashes in prose": ("He wrote either / or in the long margin of every single page, and / or so it goes on and on\n" + prose, 0),
        "blank lines part": ("a b\nc\n\nd\ne f\n\ng\n" + prose, 0),
        "only a menu": ("\n".join(f"item {i}" for i in range(40)), 40),
        "returns": ("Home\r\nShop\r\nHelp\r\nNews\r\nMore\r\n" + prose, 5),
    }
    rows = [(i, text) for i, (text, _) in enumerate(texts.values())]
    got = {r.doc_id: r for r in quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {n: got[i].n_removed_lines for i, n in enumerate(texts)} == {n: gone for n, (_, gone) in texts.items()}
    assert [n for i, n in enumerate(texts) if not got[i].kept] == ["only a menu"]
    assert got[1].clean_text == prose


def test_the_schedule_decides_when_a_document_comes(spark, monkeypatch):
    rows = [(i, "w " * (5 + i % 40), "en", "abc"[i % 3], 0) for i in range(200)]
    frame = spark.createDataFrame(rows, DDL)
    slots = {r.doc_id: r.first_slot for r in mixed(spark, frame, block_words=20)[1]}
    assert len({s for s in slots.values() if s is not None}) > 50
    # Every start of the mix is near its shares: of the first documents, too.
    first = sorted((s, i) for i, s in slots.items() if s is not None)[:60]
    shares = [sum(i % 3 == n for _, i in first) / 60 for n in range(3)]
    assert shares == pytest.approx([5 / 8, 2 / 8, 1 / 8], abs=0.15)
    monkeypatch.setattr(mixing, "GOLDEN", 1_000_003)
    assert {r.doc_id: r.first_slot for r in mixed(spark, frame, block_words=20)[1]} != slots
