"""Token counts: a linear longest-match automaton over a word-piece vocabulary.

A trie of the vocabulary gets, per node, a failure link and the number of tokens
that following it completes ("popped").  Reading a word once, a character at a
time, then gives the number of pieces that greedy longest-match-first splitting
would make, without building a piece.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loadsmith.llm.common import Remembered

WORD_START = "▁"


class PieceAutomaton:
    """``first``: pieces that begin a word; ``later``: pieces that go on with one.

    An empty piece in ``first`` is a word-start mark of its own: a word whose
    beginning fits no other first piece is that one token, then later pieces.
    """

    FIRST, LATER = 0, 1

    def __init__(self, first: Iterable[str], later: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        self.whole: list[bool] = [False, False]
        for root, pieces in ((self.FIRST, first), (self.LATER, later)):
            for piece in pieces:
                self._insert(root, piece)
        self.fail: list[int] = [-1] * len(self.next)
        self.popped: list[int] = [0] * len(self.next)
        self._link()

    def _insert(self, root: int, piece: str) -> None:
        node = root
        for c in piece:
            if c not in self.next[node]:
                self.next[node][c] = len(self.next)
                self.next.append({})
                self.whole.append(False)
            node = self.next[node][c]
        if node != self.LATER:
            self.whole[node] = True

    def _link(self) -> None:
        """Breadth first: a whole piece pops itself and restarts; others inherit from the parent's chain."""
        level = [self.FIRST, self.LATER]
        if self.whole[self.FIRST]:
            self.fail[self.FIRST], self.popped[self.FIRST] = self.LATER, 1
        while level:
            below = []
            for parent in level:
                for c, node in self.next[parent].items():
                    below.append(node)
                    if self.whole[node]:
                        self.fail[node], self.popped[node] = self.LATER, 1
                        continue
                    at, pops = self.fail[parent], self.popped[parent]
                    while at >= 0 and c not in self.next[at]:
                        pops += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.popped[node] = self.next[at][c], pops
            level = below

    def count(self, word: str) -> int | None:
        """Pieces of ``word`` (an empty one has none); None if the vocabulary cannot spell it."""
        if not word:
            return 0
        node, n = self.FIRST, 0
        for c in word:
            while c not in self.next[node]:
                if self.fail[node] < 0:
                    return None
                n += self.popped[node]
                node = self.fail[node]
            node = self.next[node][c]
        while node != self.LATER:
            if self.fail[node] < 0:
                return None
            n += self.popped[node]
            node = self.fail[node]
        return n


def marked_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Normal pieces of a sentencepiece model: word-initial ones (mark removed; '' is the bare mark), then the others."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    first, later = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        (first if piece.startswith(WORD_START) else later).append(piece.removeprefix(WORD_START))
    return first, later


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """As ``marked_vocabulary``, but without the bare mark: words need a first piece with a character."""
    first, later = marked_vocabulary(path)
    return [p for p in first if p], later


def count_tokens(docs: DataFrame, first: list[str], later: list[str]) -> DataFrame:
    """Per document: doc_id, n_words, n_unknown, n_tokens of the whole text.

    Words are runs of anything but ASCII white space.  A word that the vocabulary
    cannot spell counts as one token (and in n_unknown), as in word-piece
    tokenizers; with '' in ``first`` a word may begin with the bare mark.  Null and empty texts have 0 of each; repeated rows are each
    counted; an empty vocabulary leaves every word unknown.  The vocabulary is
    broadcast (tens of thousands of pieces); other columns are not carried.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(PieceAutomaton(first, later))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        known = Remembered(lambda w: automaton.count(w.decode()))
        for batch in batches:
            words_n, unknown, tokens = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                n = n_unknown = n_tokens = 0
                if text.is_valid:
                    for word in text.as_py().split():
                        pieces = known[word] if len(word) <= 64 else automaton.count(word.decode())
                        n += 1
                        if pieces is None:
                            n_unknown += 1
                            pieces = 1
                        n_tokens += pieces
                words_n.append(n)
                unknown.append(n_unknown)
                tokens.append(n_tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words_n, unknown, tokens))],
                names=["doc_id", "n_words", "n_unknown", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        counts, f"doc_id {kind}, n_words long, n_unknown long, n_tokens long")
