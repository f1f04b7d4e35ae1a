"""Language identification by unigrams of pieces, summed over all segmentations.

The pieces of a fixed public vocabulary get a probability in each language: how often they occur in
the words of its training texts, wherever they occur, over all pieces. A word's probability in a
language is the sum over all ways to cut it into pieces of the product of their probabilities,
which the forward algorithm gives in one run over the word; a text's is the product over its words.
All lower-case pieces of the vocabulary are used, and words of any length are whole: the run goes through
long ones in stretches, and only as many of its last sums are kept as a piece is long.

Words are runs of letters in lower case, with the vocabulary's mark of a word's start. A character
that is no piece counts as an unlikely piece of its own. Counting goes over all training texts in
Spark: words by language first, then pieces by language; what comes to the driver is one row for
each piece and language at most. Each task scores a distinct word once.

A text that is null, empty or without a letter is ``und`` with score 0; so is any text if no
training row has a language. Training rows with null text count only towards the shares of the
languages. Ties go to the first language by code point. Repeated rows count and are scored each for
itself. An empty table to score gives an empty result. Other columns are passed over.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of the vocabulary's longest lower-case piece; a model goes by its own pieces.
#: Smoothing adds so many occurrences to each piece.
LONGEST, SMOOTHING, UNKNOWN = 16, 0.5, 1e-8
#: Distinct words a task remembers, and characters of them.
REMEMBERED, REMEMBERED_CHARS = 300_000, 10_000_000
#: Words up to so many characters are scored with those of their length, longer ones with some of about it.
#: Characters scored at once, and characters of each word whose pieces are looked up together.
SHORT, TOGETHER, STRETCH = 40, 200_000, 64
#: Sums are scaled after so many characters, before they could vanish.
SCALED = 4
START = "▁"
UNDETERMINED = "und"
_word = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if there's no letter."""
    found = _word.findall((text or "").lower())
    if not any(c.isalpha() for w in found for c in w):  # numerals such as Ⅷ alone aren't letters
        return []
    return found


def read_pieces(path: str) -> list[str]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (
        model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
    ))
    return sorted({p for p in pieces if p == p.lower()})


@dataclass(frozen=True)
class Model:
    pieces: list[str]
    languages: list[str]
    prior: np.ndarray  # log share of each language
    probability: np.ndarray  # (pieces + unknown + none, languages)


def _training_words(documents: DataFrame) -> DataFrame:
    """lang, word, n over all texts: counted in each batch, then by Spark."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text.as_py()))
            for lang, own in counts.items():
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(own), pa.string()),
                        "word": pa.array(own.keys(), pa.string()),
                        "n": pa.array(own.values(), pa.int64()),
                    }
                )

    rows = documents.where("lang IS NOT NULL").select("lang", "text")
    counted = rows.mapInArrow(over, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(documents: DataFrame, pieces: list[str]) -> Model:
    """From the texts and languages of these documents; rows without a language are left out."""
    shares = documents.where("lang IS NOT NULL").groupBy("lang").count().collect()
    shares.sort()
    languages = [r[0] for r in shares]
    if not languages:
        return Model(pieces, [], np.empty(0), np.empty((len(pieces) + 2, 0)))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {p: i for i, p in enumerate(pieces)}
        heads = {p[:n] for p in pieces for n in range(1, len(p) + 1)}
        number = {lang: i for i, lang in enumerate(languages)}
        totals = np.zeros((len(languages), len(pieces)), np.int64)
        for batch in batches:
            langs, words, ns = (batch.column(c).to_pylist() for c in ("lang", "word", "n"))
            at, found, weight = [], [], []
            for lang, word, n in zip(langs, words, ns, strict=True):
                word = START + word
                ids = []
                for i in range(len(word)):
                    j = i + 1
                    while j <= len(word) and (part := word[i:j]) in heads:
                        if part in known:
                            ids.append(known[part])
                        j += 1
                found += ids
                at += [number[lang]] * len(ids)
                weight += [n] * len(ids)
            np.add.at(totals, (at, found), weight)
        lang, piece = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(piece), pa.array(totals[lang, piece])], ["lang", "piece", "n"]
        )

    counted = _training_words(documents).mapInArrow(over, "lang long, piece long, n long")
    counts = np.zeros((len(pieces), len(languages)))
    for r in counted.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
        counts[r.piece, r.lang] = r.n
    smooth = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=0)
    extra = np.vstack([np.full(len(languages), UNKNOWN), np.zeros(len(languages))])
    prior = np.log(np.array([r[1] for r in shares], float) / sum(r[1] for r in shares))
    return Model(pieces, languages, prior, np.vstack([smooth, extra]))


class Numbers:
    """Numbers of pieces for all short stretches of many words at once.

    Stretches are hashed (64 bits) character by character, and looked up in a table of slots; the few
    pieces whose slot is taken are in a second table without such clashes.
    """

    _step = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str]):
        self.unknown, self.none = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        numbers = np.arange(len(pieces), dtype=np.int32)
        self.tables = []
        bits = 18
        while len(hashes):
            slot = self._slot(hashes, bits, len(self.tables))
            _, first = np.unique(slot, return_index=True)
            keys, values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, self.none, np.int32)
            keys[slot[first]], values[slot[first]] = hashes[first], numbers[first]
            self.tables.append((bits, keys, values))
            hashes, numbers = np.delete(hashes, first), np.delete(numbers, first)

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(self._step) + ord(c)) % (1 << 64)
        return h

    def _slot(self, h: np.ndarray, bits: int, number: int) -> np.ndarray:
        factor = np.uint64((0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)[number % 3])
        return ((h ^ (h >> np.uint64(31))) * factor) >> np.uint64(64 - bits)

    def of(self, letters: np.ndarray) -> list[np.ndarray]:
        """For each length, the numbers of the stretches of that length, by word and start.

        Letters are code points by word and place, with noughts after a word's end.
        """
        letters = letters.astype(np.uint64)
        h, found = np.zeros_like(letters), []
        for k in range(1, min(self.longest, letters.shape[1]) + 1):
            h = h[:, : letters.shape[1] - k + 1] * self._step + letters[:, k - 1 :]
            ids = np.full(h.shape, self.none, np.int32)
            for number, (bits, keys, values) in enumerate(self.tables):
                slot = self._slot(h, bits, number)
                ids = np.where(keys[slot] == h, values[slot], ids)
            if k == 1:
                ids[ids == self.none] = self.unknown
            found.append(ids)
        return found


class Scorer:
    """Log probabilities of words in each language; one in each task."""

    def __init__(self, model: Model):
        self.model = model
        self.numbers = Numbers(model.pieces)
        self.row: dict[str, int] = {}
        self.chars = 0
        self.scores = np.empty((0, len(model.languages)))

    def forward(self, words: list[str]) -> np.ndarray:
        """The sum over all segmentations of each word, as logarithms."""
        longest, none, probability = self.numbers.longest, self.numbers.none, self.model.probability
        letters = np.array([START + w for w in words]).view(np.uint32).reshape(len(words), -1)
        sizes = np.array([len(w) + 1 for w in words])
        ends, whole = set(sizes.tolist()), letters.shape[1]
        # The sums up to a place, of the last places only: place j is at j modulo (longest + 1).
        alpha = np.zeros((longest + 1, len(words), len(self.model.languages)))
        alpha[0] = 1.0
        scale, found = np.zeros(alpha.shape[1:]), np.zeros(alpha.shape[1:])
        for at in range(0, whole, STRETCH):
            low = max(0, at - longest + 1)
            ids = self.numbers.of(letters[:, low : at + STRETCH])
            for j in range(at + 1, min(whole, at + STRETCH) + 1):
                now = np.zeros(alpha.shape[1:])
                for k in range(1, min(longest, j) + 1):
                    piece, before = ids[k - 1][:, j - k - low], alpha[(j - k) % (longest + 1)]
                    if k == 1:
                        now += before * probability[piece]
                    elif len(rows := np.flatnonzero(piece != none)):
                        now[rows] += before[rows] * probability[piece[rows]]
                alpha[j % (longest + 1)] = now
                if j in ends:
                    done = sizes == j
                    found[done] = np.log(now[done]) + scale[done]
                if j % SCALED == 0:  # each language by itself, so that none vanishes in a long word
                    alpha /= now
                    scale += np.log(now)
        return found

    def add(self, texts: list[list[str]]) -> None:
        """Score the words of these texts that aren't known yet."""
        if not self.model.languages:
            return
        new = {w for words in texts for w in words if w not in self.row}
        self.chars += sum(map(len, new))
        if len(self.row) + len(new) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.row, self.scores, self.chars = {}, self.scores[:0], 0
            new = {w for words in texts for w in words}
        by_size: dict[int, list[str]] = {}
        for w in new:
            by_size.setdefault(len(w) if len(w) <= SHORT else SHORT + len(w).bit_length(), []).append(w)
        made = [self.scores]
        for words in by_size.values():
            words.sort(key=len)
            step = max(1, min(5000, TOGETHER // len(words[-1])))
            for at in range(0, len(words), step):
                part = words[at : at + step]
                self.row.update(zip(part, range(len(self.row), len(self.row) + len(part)), strict=True))
                made.append(self.forward(part))
        self.scores = np.concatenate(made)

    def predict(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0
        rows = np.fromiter(map(self.row.__getitem__, words), np.int64, count=len(words))
        total = self.scores[rows].sum(axis=0) + self.model.prior
        share = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.model.languages[best], float(share[best] / share.sum())


def predict(documents: DataFrame, model: Model, *kept: str) -> DataFrame:
    """``kept``, lang_pred and score; only the text is looked at."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts, found = batch.column("__text"), []
            for at in range(0, batch.num_rows, 500):
                words = [words_of(t.as_py()) for t in texts.slice(at, 500)]
                scorer.add(words)
                found += [scorer.predict(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                [*kept, "lang_pred", "score"],
            )

    types = {f.name: f.dataType.simpleString() for f in documents.schema}
    schema = "".join(f"`{c}` {types[c]}, " for c in kept) + "lang_pred string, score double"
    return documents.select(*kept, documents["text"].alias("__text")).mapInArrow(over, schema)


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
