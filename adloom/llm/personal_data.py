"""Personal data by weak supervision.

Patterns give base spans (email, ip, card, phone), which always stay, and looser candidates: addresses
with a written-out at sign, phone numbers without a country code, card numbers that fail their check
digit. Four labelers vote on each candidate: the strict pattern, a gazetteer (top-level domains,
calling codes, card issuers, reserved networks), the words before it, and what it touches.
Votes are counted by pattern of votes, which is a bounded table whatever the corpus holds;
expectation-maximisation on it estimates each labeler's reliability for each kind and the
probability of each pattern, and these train a logistic classifier of spans. It decides on the
candidates that are not base spans.

A null or empty text has no spans, an empty table gives an empty result. Very long texts are taken whole; the
context of a candidate is the 40 characters before it, and a written-out address has at most 64, 63 and 4
parts. Spans that start at the same place go by kind in the order of the kinds. Repeated rows are treated each for itself. Without candidates the
classifier adds nothing. Very long runs of digits or letters take linear time. ``redact`` keeps
all columns and replaces spans in ``text``; other operators pass over further columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context", "edges")
LENGTHS = (8, 14, 20)  # bounds of the classifier's length classes
ROUNDS = 60

DOMAINS = frozenset("com org net edu gov info io dev de fr es it uk eu us ca nl at ch be br mx".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 81 86 91".split())
HINTS = {
    "email": "mail e-mail email contact write kontakt correo courriel adresse address",
    "ip": "ip host server address login adresse servidor serveur from",
    "card": "card visa mastercard amex credit karte kreditkarte tarjeta carte payment",
    "phone": "phone call tel telephone mobile fax ring telefon teléfono téléphone anruf llamar",
}
COUNTER_HINTS = "order invoice isbn serial version token hash commit build part sku"
_hint = {k: re.compile(rf"\b(?:{'|'.join(w.split())})\b") for k, w in HINTS.items()}
_counter = re.compile(rf"\b(?:{'|'.join(COUNTER_HINTS.split())})\b")

_digit = re.compile("[0-9]")
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_spelt = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}){1,4}"
)
_national = re.compile(r"(?:\([0-9]{3}\)\x20?|\b[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign to the left as far as allowed, but not into the match before."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _local:
            start -= 1
        found = _domain.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        # An at sign is in neither part: nothing before it can start a later match.
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """In a dotted run of numbers, the matches are fours of them from the left."""
    for run in _dotted.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 3 or (len(p.lstrip("0")) == 3 and int(p) <= 255) for p in four):
                yield at, end
            at = end + 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    spans = [(s, 0, e) for s, e in _emails(text)]
    if _digit.search(text):
        spans += [(s, 1, e) for s, e in _addresses(text)]
        for m in _card.finditer(text):
            if m.end() - m.start() < 14:
                continue
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        for m in _phone.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that no base span and no candidate before them touches."""
    found = []
    if "at]" in text or "at)" in text:
        found += [(m.start(), 0, m.end()) for m in _spelt.finditer(text)]
    if _digit.search(text):
        found += [(m.start(), 3, m.end()) for m in _national.finditer(text)]
        for m in _card.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(_digits(m.group())) <= 19:
                found.append((m.start(), 2, m.end()))
    taken, free, at = sorted((s, e) for s, _, e in base), [], 0
    reached = 0
    for start, kind, end in sorted(found):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if start >= reached and (at == len(taken) or taken[at][0] >= end):
            free.append((start, kind, end))
            reached = end
    return free


def votes(text: str, start: int, kind: int, end: int, base: bool) -> tuple[int, int, int, int]:
    """Each labeler's vote: 0 against, 1 abstains, 2 for."""
    span = text[start:end]
    known = 1
    if kind == 0:
        known = 2 if span.rpartition(".")[2].lower() in DOMAINS else 1
    elif kind == 1:
        known = 0 if span.startswith(("0.", "127.", "255.")) else 1
    elif kind == 2:
        digits = _digits(span)
        known = 2 if digits[0] in "3456" and luhn(digits) else 0 if not luhn(digits) else 1
    elif span.startswith("+"):
        digits = _digits(span[:5])
        known = 2 if any(digits[:n] in CALLING_CODES for n in (1, 2)) else 1
    before = text[max(0, start - 40) : start].lower()
    hint = 2 if _hint[KINDS[kind]].search(before) else 0 if _counter.search(before) else 1
    glued = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return 2 if base else 1, known, hint, 0 if glued else 1


def code_of(kind: int, ballot: tuple[int, ...], length: int, base: bool) -> int:
    """Kind, votes, length class and whether it's a base span, as one number."""
    code = kind
    for v in ballot:
        code = code * 3 + v
    return (code * 4 + sum(length > b for b in LENGTHS)) * 2 + base


def features_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, votes (a column each) and length class."""
    length, code = codes // 2 % 4, codes // 8
    ballot = []
    for _ in LABELERS:
        ballot.append(code % 3)
        code = code // 3
    return code, np.stack(ballot[::-1], axis=1), length


def candidates(text: str | None) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, code) of the base spans and the candidates, sorted."""
    text = text or ""
    base = base_spans(text)
    spans = [(*s, True) for s in base] + [(*s, False) for s in loose_spans(text, base)]
    return [
        (s, k, e, code_of(k, votes(text, s, k, e, is_base), e - s, is_base))
        for s, k, e, is_base in sorted(spans)
    ]


@dataclass(frozen=True)
class Model:
    """reliability[kind, labeler, class, vote]; accepted: codes of the spans the classifier adds."""

    reliability: np.ndarray
    weights: np.ndarray
    accepted: tuple[int, ...]


def _design(kinds: np.ndarray, ballots: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    one_hot = lambda x, n: np.eye(n)[x]
    return np.hstack([one_hot(kinds, 4), *(one_hot(b, 3) for b in ballots.T), one_hot(lengths, 4)])


def fit(codes: np.ndarray, counts: np.ndarray) -> Model:
    """From how often each code occurs."""
    kinds, ballots, lengths = features_of(codes)
    prior = np.full(len(KINDS), 0.5)
    reliability = np.tile(np.array([[0.5, 0.3, 0.2], [0.1, 0.3, 0.6]]), (len(KINDS), len(LABELERS), 1, 1))
    belief = np.zeros(len(codes))
    for _ in range(ROUNDS):
        score = np.stack([np.log(1 - prior[kinds]), np.log(prior[kinds])], axis=1)
        for j in range(len(LABELERS)):
            score += np.log(reliability[kinds, j, :, ballots[:, j]])
        belief = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
        for k in range(len(KINDS)):
            own = kinds == k
            mass = np.stack([counts * (1 - belief), counts * belief])[:, own]
            prior[k] = (mass[1].sum() + 1) / (mass.sum() + 2)
            for j in range(len(LABELERS)):
                for v in range(3):
                    reliability[k, j, :, v] = mass[:, ballots[own, j] == v].sum(axis=1) + 1
            reliability[k] /= reliability[k].sum(axis=2, keepdims=True)
    x = _design(kinds, ballots, lengths)
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of the ridge logistic regression on soft labels
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (counts * (p - belief)) + w
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    added = codes[(x @ w > 0) & (codes % 2 == 0)]
    return Model(reliability, w, tuple(sorted(map(int, added))))


_SPANS = "array<struct<start:int,kind:int,stop:int,code:int>>"


def found(documents: DataFrame) -> DataFrame:
    """doc_id and the candidates of each document."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.struct([(n, pa.int32()) for n in ("start", "kind", "stop", "code")])
        for batch in batches:
            spans = [
                [dict(zip(("start", "kind", "stop", "code"), s, strict=True)) for s in candidates(t.as_py())]
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(fields))], ["doc_id", "spans"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(over, f"doc_id {kind}, spans {_SPANS}")


def fitted(spans: DataFrame) -> Model:
    """The counts of codes come to the driver: at most 4 * 3^4 * 4 * 2 rows, whatever the input."""
    rows = spans.select(F.explode("spans.code").alias("code")).groupBy("code").count().collect()
    rows.sort()
    return fit(np.array([r[0] for r in rows], int), np.array([r[1] for r in rows], float))


def detect(documents: DataFrame) -> DataFrame:
    """doc_id, base and all spans, each an array of structs (start, kind, stop, code)."""
    spans = staged(found(documents), "personal-data")
    accepted = F.array(*map(F.lit, fitted(spans).accepted)).cast("array<int>")
    is_base = lambda s: s.getField("code") % 2 == 1
    return spans.select(
        "doc_id",
        F.filter("spans", is_base).alias("base"),
        F.filter("spans", lambda s: is_base(s) | F.array_contains(accepted, s.getField("code"))).alias("all"),
    )


def written(spans: str | Column) -> Column:
    """kind:start:end, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(name, s.getField("kind")), s.getField("start"), s.getField("stop")),
        ),
        ",",
    )


def redact(documents: DataFrame) -> DataFrame:
    """The documents with each span replaced by its kind, as in <email>."""
    model = fitted(staged(found(documents), "personal-data"))
    accepted = frozenset(model.accepted)
    columns = documents.columns

    def clean(text: str | None) -> str | None:
        parts, at = [], 0
        for start, kind, end, code in candidates(text):
            if code % 2 or code in accepted:
                if start >= at:
                    parts += [text[at:start], f"<{KINDS[kind]}>"]
                at = max(at, end)
        return "".join([*parts, text[at:]]) if parts else text

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([clean(t.as_py()) for t in batch.column("text")], pa.string())
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", texts)

    now = documents.mapInArrow(over, documents.schema)
    count = {"n_chars": F.length("text").cast("long").alias("n_chars")}
    return now.select(*(count.get(c, F.col(c)) for c in columns))
