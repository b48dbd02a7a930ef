"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with failure links: where no edge goes on, the pieces already
certain are popped and the link leads to the node of what is left of the word. Each
link carries the number of pieces it pops, so the length of the greedy longest-match
segmentation is summed up in one pass over the letters and no piece is ever built.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Splitter, Tokenizer, byte_letters
from .shared import slices

#: Distinct words whose counts a task remembers before it starts anew.
REMEMBERED_WORDS = 500_000
NOWHERE = -1


class PieceCounter:
    """Counts the greedy longest-match pieces of words.

    ``first`` are the pieces that may begin a word, ``later`` those that may follow, both
    without any mark of continuation. A word that cannot be cut has no count.
    """

    def __init__(self, first: Iterable[str], later: Iterable[str]):
        self.edges: dict[tuple[int, str], int] = {}
        self._ends = [False, False]  # node 0 begins words, node 1 continues them
        order: list[tuple[int, str, int]] = []
        for root, pieces in ((0, first), (1, later)):
            for piece in pieces:
                if piece:
                    self._add(root, piece, order)
        self.fail = [NOWHERE] * len(self._ends)
        self.popped = [0] * len(self._ends)
        self._link(order)

    def _add(self, node: int, piece: str, order: list) -> None:
        for letter in piece:
            child = self.edges.get((node, letter))
            if child is None:
                child = self.edges[node, letter] = len(self._ends)
                self._ends.append(False)
                order.append((node, letter, child))
            node = child
        self._ends[node] = True

    def _link(self, order: list[tuple[int, str, int]]) -> None:
        """Links of all nodes, parents before children."""
        depth = [0] * len(self._ends)
        for parent, _, child in order:
            depth[child] = depth[parent] + 1
        for parent, letter, child in sorted(order, key=lambda e: depth[e[2]]):
            if self._ends[child]:  # the whole path is a piece
                self.fail[child], self.popped[child] = 1, 1
                continue
            node, count = self.fail[parent], self.popped[parent]
            while node != NOWHERE and (node, letter) not in self.edges:
                count += self.popped[node]
                node = self.fail[node]
            if node != NOWHERE:
                self.fail[child], self.popped[child] = self.edges[node, letter], count

    def __call__(self, word: str) -> int | None:
        """Pieces of the word, None if it cannot be cut; 0 for an empty word."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, count = 0, 0
        for letter in word:
            while (child := edges.get((node, letter))) is None:
                count += popped[node]
                node = fail[node]
                if node == NOWHERE:
                    return None
            node = child
        while node > 1:
            count += popped[node]
            node = fail[node]
            if node == NOWHERE:
                return None
        return count

    @classmethod
    def of(cls, state: dict) -> PieceCounter:
        """The counter with the attributes ``state``, which travels as plain data."""
        counter = cls.__new__(cls)
        counter.__dict__.update(state)
        return counter


#: Letters at the end of a word stand this far up, in a private range of code points.
LAST = 0xF0000


def spelled(letters: str) -> str:
    """A word with its last letter marked as such."""
    return letters[:-1] + chr(LAST + ord(letters[-1]))


def from_tokenizer(file: str) -> PieceCounter:
    """The counter of a ``tokenizers`` file with word ends: every piece may follow any other.

    Words are read as the file's byte letters, the last one marked.
    """
    with open(file, encoding="utf-8") as f:
        model = json.load(f)["model"]
    suffix = model["end_of_word_suffix"]
    pieces = [spelled(t.removesuffix(suffix)) if t.endswith(suffix) else t for t in model["vocab"]]
    return PieceCounter(pieces, pieces)


def count_pieces(
    docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Words and greedy word pieces of every text: doc_id, n_words, n_pieces, n_uncut.

    Texts are normalized and cut into words as the tokenizer file says. Null and empty
    texts have zeros; special tokens count one word and one piece; words that cannot be
    cut count as words and in ``n_uncut`` and have no pieces. One row per row.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        splitting = vars(Tokenizer(f.read()))
    keep = {k: splitting[k] for k in ("special", "source")}
    context = docs.sparkSession.sparkContext
    model = context.broadcast((keep, vars(from_tokenizer(tokenizer_file))))
    schema = T.StructType.fromDDL("doc_id long, n_words long, n_pieces long, n_uncut long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, state = model.value
        cut, count = Splitter(Tokenizer.of(names)), PieceCounter.of(state)
        letters = {b: c for c, b in byte_letters().items()}
        known: dict[str | int, int] = {}
        for batch in slices(batches, 1):
            texts = [cut(t) if t else [] for t in batch.column(1).to_pylist()]
            if len(known) > REMEMBERED_WORDS:
                known.clear()
            for w in {w for words in texts for w in words}.difference(known):
                known[w] = 1
                if isinstance(w, str):
                    pieces = count(spelled("".join(letters[b] for b in w.encode())))
                    known[w] = -1 if pieces is None else pieces
            counts = [np.fromiter(map(known.__getitem__, ws), np.int64, len(ws)) for ws in texts]
            columns = [
                [len(c) for c in counts],
                [int(c[c > 0].sum()) for c in counts],
                [int((c < 0).sum()) for c in counts],
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], schema.names
            )

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return plain.mapInArrow(task, schema)
