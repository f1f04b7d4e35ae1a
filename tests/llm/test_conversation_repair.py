import random
import re
from binascii import crc32
from hashlib import sha256
from itertools import product

import pytest

from adloom.llm import conversation_repair as repair
from adloom.llm.queries import op13_conversation_repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NONE = sha256(b"").hexdigest()


def exhaustive(symbols, inserts=2):
    """Cost and audit over all edits of a few rows, with up to ``inserts`` insertions in each gap."""
    best = None
    gaps = [("",), *[("u",), ("a",)], *([("u", "a"), ("a", "u")] if inserts > 1 else [])]
    choices = []
    for symbol in symbols:
        role, extra = symbol.lower(), 3 if symbol.isupper() else 0
        edits = [("D", "", 4)]
        if symbol != "x":
            edits += [("K", role, extra), ("R", "u", extra + 3), ("R", "a", extra + 3)]
        choices.append(edits)
    for edits in product(*choices):
        for between in product(gaps, repeat=len(symbols) + 1):
            roles, audit, cost = "", "", 0
            for i, gap in enumerate(between):
                put = "".join(gap)
                roles, audit, cost = roles + put, audit + "I" * len(put), cost + 3 * len(put)
                if i < len(edits):
                    edit, role, price = edits[i]
                    roles, audit, cost = roles + role, audit + edit, cost + price
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def by_states(symbols):
    """The same by going through the rows with the states of the pattern."""
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(states):
        for _ in range(4):
            for state, (cost, audit) in list(states.items()):
                for role in "ua":
                    to, found = follows.get((state, role)), (cost + 3, audit + "I")
                    if to and (to not in states or found < states[to]):
                        states[to] = found
        return states

    states = inserted({"": (0, "")})
    for symbol in symbols:
        after = {}
        for state, (cost, audit) in states.items():
            edits = [(state, cost + 4, "D")]
            if symbol != "x":
                extra, role = 3 if symbol.isupper() else 0, symbol.lower()
                edits += [(follows.get((state, role)), cost + extra, "K")]
                edits += [(follows.get((state, to)), cost + extra + 3, "R") for to in "ua"]
            for to, price, edit in edits:
                if to is not None and (to not in after or (price, audit + edit) < after[to]):
                    after[to] = price, audit + edit
        states = inserted(after)
    return min(states[s] for s in ("", "a") if s in states)


def test_the_least_edits_of_all():
    for n in range(3):
        for symbols in product("suaoUAx", repeat=n):
            assert repair.best_repair("".join(symbols)) == exhaustive(symbols)
    for symbols in ("sau", "aSu", "Uuu", "oxa", "ssu"):
        assert repair.best_repair(symbols) == exhaustive(symbols, inserts=1)


def test_long_conversations_by_states():
    chosen = random.Random(8)
    for length in [*range(60)] * 8 + [300, 1000]:
        symbols = "".join(chosen.choice("suaoSUAOx") if chosen.random() < 0.4 else "ua"[i % 2] for i in range(length))
        assert repair.best_repair(symbols) == by_states(symbols)


@pytest.mark.parametrize("block", [1, 3, 8, 40])
def test_blocks_do_not_matter(block, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", block)
    symbols = "suaauxuUaSoauuuaasuAxau" * 2
    assert repair.best_repair(symbols) == by_states(symbols)


def expected(rows):
    """conv_id -> what the query returns, from the given rows."""
    kept = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kept.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        damage = crc32(key.encode()) % 20
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        role = "user" if damage == 4 else role
        kept[conv] += [(turn, role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1)
    found = {}
    for conv, turns in kept.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        numbers = [t for t, _, _ in turns if t is not None]
        seen, symbols = set(), ""
        counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = None
            if not visible:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif visible[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbol = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol
        pairs = zip(turns, turns[1:])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
        cost, audit = by_states(symbols)
        lines, rest = [], iter(turns)
        for edit in audit:
            due = "assistant" if lines and lines[-1][0] == "u" else "user"
            if edit == "I":
                lines.append(f"{due}:")
                continue
            _, role, text = next(rest)
            if edit != "D":
                lines.append(f"{role if edit == 'K' else due}:{text}")
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        digest = sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return found


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = result(op13_conversation_repair(spark, SF))
    assert got == expected(rows)
    assert sum(1 for r in got.values() if set(r[6]) - {"K"}) > 5


def test_odd_rows(spark):
    words = ["Yes.", "No", "", " \n", "Why? ", None, "x" * 100_000, "Yes."]
    roles = ["user", "assistant", "system", "tool", "", None]
    chosen = random.Random(4)
    rows = [
        (chosen.choice((None, 1, 2, 3, *range(5, 30))), chosen.choice((None, *range(12))), chosen.choice(roles), chosen.choice(words))
        for _ in range(500)
    ]
    rows += rows[:40] + [(77, t, "user assistant".split()[t % 2], f"{t}.") for t in range(900)]
    chosen.shuffle(rows)
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, audit string, cost int").repartition(5)
    assert result(repair.repaired(repair.damaged(given))) == expected(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repaired(repair.damaged(empty)).count() == 0


def test_no_rows_left_and_rows_as_they_are(spark):
    gone = next((c, t) for c in range(1000) for t in (0,) if crc32(f"{c}:{t}".encode()) % 20 == 0)
    given = spark.createDataFrame([(*gone, "user", "Hello.")], SCHEMA)
    assert result(repair.repaired(repair.damaged(given))) == {gone[0]: (0, 0, 0, 0, 0, 0, "", NONE)}
    as_is = result(repair.repaired(repair.undamaged(given)))[gone[0]]
    assert as_is[5:7] == (3, "KI")
    assert as_is[7] == sha256(b"user:Hello.\nassistant:").hexdigest()
