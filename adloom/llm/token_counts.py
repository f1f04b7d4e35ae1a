"""Token counts by a linear longest-match automaton.

A trie holds the vocabulary: pieces that begin a word (with its mark) under one root, those that
continue one under another. Where no child fits, a failure link leads to the node of what is left after
the longest pieces have been taken off the front, and each link knows how many pieces it takes off. A word
is read once, each character at most twice, and no piece is ever built: greedy longest-match counts in
linear time. A word that can't be covered counts as one unknown token, as word-piece models do.

A null or empty text has no words and no tokens. Very long texts are counted whole. The
longest piece always wins, and no two are of one length, so there are no ties. Repeated rows are counted each
for itself. An empty table gives an empty result. Other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

#: Distinct words a task remembers.
REMEMBERED = 500_000
START = "▁"
_UNKNOWN = 1 << 40


def read_pieces(path: str) -> list[str]:
    """Pieces of a word: a mark only at the start, no byte, control or unknown pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = (model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if p and START not in p[1:]})


class Automaton:
    def __init__(self, pieces: Iterable[str]):
        self.children: list[dict[str, int]] = [{}, {}]
        first, rest = 0, 1  # the roots: at a word's start, and after some piece of it
        ends: set[int] = set()
        for piece in pieces:
            node = first if piece.startswith(START) else rest
            for c in piece:
                node = self.children[node].setdefault(c, len(self.children))
                if node == len(self.children):
                    self.children.append({})
            ends.add(node)
        self.link: list[int | None] = [None] * len(self.children)
        self.popped = [0] * len(self.children)
        for root in (rest, first):  # links lead to shorter strings after the start
            level = [root]
            while level:
                below = []
                for node in level:
                    for c, child in self.children[node].items():
                        below.append(child)
                        if child in ends:
                            self.link[child], self.popped[child] = rest, 1
                            continue
                        at, taken = self.link[node], self.popped[node]
                        while at is not None and c not in self.children[at]:
                            taken += self.popped[at]
                            at = self.link[at]
                        if at is not None:
                            self.link[child], self.popped[child] = self.children[at][c], taken
                level = below

    def count(self, word: str) -> int | None:
        """The number of greedy longest-match pieces of the word, None if it can't be covered."""
        node, taken = 0, 0
        for c in START + word:
            while c not in self.children[node]:
                if self.link[node] is None:
                    return None
                taken += self.popped[node]
                node = self.link[node]
            node = self.children[node][c]
        while node != 1:
            if self.link[node] is None:
                return None
            taken += self.popped[node]
            node = self.link[node]
        return taken


class Counter:
    """Counts of texts; a distinct word goes through the automaton once as long as it's remembered."""

    def __init__(self, pieces: Iterable[str]):
        self.automaton = Automaton(pieces)
        self.known: dict[bytes, int] = {}

    def count(self, text: str | None) -> tuple[int, int, int]:
        """Words, tokens, unknown words."""
        words = (text or "").encode().split()  # bytes: the six ASCII white-space characters
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set(words)
        for word in new:
            n = self.automaton.count(word.decode())
            self.known[word] = _UNKNOWN + 1 if n is None else n
        total = sum(map(self.known.__getitem__, words))
        return len(words), total % _UNKNOWN, total // _UNKNOWN


def count_tokens(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown."""
    pieces = read_pieces(path)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces)
        for batch in batches:
            found = [counter.count(t.as_py()) for t in batch.column("text")]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_tokens", "n_unknown"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        over, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long"
    )
