"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. A proposal is what BPE gives if
and only if every adjacent pair of it is compatible, that is, if no merge across the
border comes before the merges that made its two tokens. Pairs are checked with numpy,
all at once; only words with an incompatible pair are merged step by step.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import map_batches, quoted, slices, with_column

#: Distinct words that a task remembers before it starts anew; no result depends on it.
REMEMBERED_WORDS = 250_000
#: Words of more symbols than this are merged with a heap.
SHORT_WORD = 40
NO_MERGE = np.iinfo(np.int64).max

# The split pattern and steps this module reproduces: fixed values of the tokenizer file.
SPLIT_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
)
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]


def byte_letters() -> dict[str, int]:
    """Byte of each letter by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizer:
    """A byte-level BPE with word ends, read from a ``tokenizers`` JSON text.

    Raises ValueError for a file with other steps than this module reproduces.
    """

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if (
            model["type"] != "BPE"
            or not suffix
            or model.get("continuing_subword_prefix")
            or model.get("ignore_merges")
            or spec["normalizer"].get("normalizers") != NORMALIZERS
            or split["pattern"].get("Regex") != SPLIT_PATTERN
            or spec["decoder"] is not None
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                   for t in spec["added_tokens"])
        ):
            raise ValueError("a tokenizer file of another kind")
        self.source = source
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        self.strings = {i: s for s, i in (vocab | self.special).items()}
        letters = byte_letters()
        #: Tokens within a word and at its end, by their bytes.
        self.inner, self.final = {}, {}
        for text, number in vocab.items():
            body = text.removesuffix(suffix)
            pieces = self.final if body != text else self.inner
            pieces[bytes(letters[c] for c in body)] = number
        if any(bytes([b]) not in d for b in range(256) for d in (self.inner, self.final)):
            raise ValueError("the vocabulary lacks single bytes")
        self.longest = max(map(len, [*self.inner, *self.final]))
        self._read_merges(model["merges"], vocab)

    @classmethod
    def of(cls, state: dict) -> Tokenizer:
        """The tokenizer with the attributes ``state``, which travels as plain data."""
        tokenizer = cls.__new__(cls)
        tokenizer.__dict__.update(state)
        return tokenizer

    def _read_merges(self, merges: list, vocab: dict[str, int]) -> None:
        self.size = max(vocab.values()) + 1
        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        #: (rank, token) of a pair, by left * size + right.
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if self.rank[whole] >= 0 or max(self.rank[left], self.rank[right]) >= rank:
                raise ValueError("merges that make a token twice or use it before it is made")
            self.rank[whole], self.left[whole], self.right[whole] = rank, left, right
            self.merges[left * self.size + right] = rank, whole
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ranks = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        # A token that its own parts' merges would not give is never proposed.
        made = np.flatnonzero(self.rank >= 0)
        bad = set(made[~self.compatible(self.left[made], self.right[made], self.rank[made])])
        for pieces in (self.inner, self.final):
            for text in [t for t, i in pieces.items() if i in bad]:
                del pieces[text]

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(a), NO_MERGE)
        wanted = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], NO_MERGE)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit=None) -> np.ndarray:
        """Whether BPE leaves each pair of neighbours as it is.

        The later of the two tokens is taken apart again and again; each time, the
        merge of the parts now at the border must not come before what was undone.
        Of two merges of one rank the left one came first.
        """
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NO_MERGE) if limit is None else limit.astype(np.int64)
        while len(at):
            early = self._pair_ranks(a, b) < limit
            good[at[early]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~early & (np.maximum(ra, rb) >= 0)
            at, a, b, ra, rb = at[on], a[on], b[on], ra[on], rb[on]
            split_left = ra > rb
            limit = np.where(split_left, ra, rb + 1)
            a, b = np.where(split_left, self.right[a], a), np.where(split_left, b, self.left[b])
        return good

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        inner, final, longest = self.inner, self.final, self.longest
        start, end, out = 0, len(word), []
        while start < end:
            if end - start <= longest and (found := final.get(word[start:])) is not None:
                out.append(found)
                break
            stop = min(end - 1, start + longest)
            while (found := inner.get(word[start:stop])) is None:
                stop -= 1
                if stop == start:  # the last byte of the word
                    found, stop = final[word[start:]], end
                    break
            out.append(found)
            start = stop
        return out

    def merge(self, word: bytes) -> list[int]:
        """Tokens of a word by merging step by step."""
        ids = [self.inner[word[k : k + 1]] for k in range(len(word) - 1)]
        ids.append(self.final[word[-1:]])
        return self._merge_short(ids) if len(ids) <= SHORT_WORD else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        merges, size = self.merges, self.size
        none = (NO_MERGE, -1)
        found = [merges.get(a * size + b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is none:
                break
            k = found.index(best)
            ids[k : k + 2] = [best[1]]
            del found[k]
            if k:
                found[k - 1] = merges.get(ids[k - 1] * size + ids[k], none)
            if k < len(found):
                found[k] = merges.get(ids[k] * size + ids[k + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        merges, size, n = self.merges, self.size, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(k: int) -> None:
            if 0 <= k and after[k] < n:
                pair = ids[k] * size + ids[after[k]]
                if pair in merges:
                    heapq.heappush(heap, (merges[pair][0], k, pair, merges[pair][1]))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, k, pair, whole = heapq.heappop(heap)
            j = after[k]
            if ids[k] < 0 or j >= n or ids[k] * size + ids[j] != pair:
                continue
            ids[k], ids[j], after[k] = whole, -1, after[j]
            if after[j] < n:
                before[after[j]] = k
            offer(before[k])
            offer(k)
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Tokens of each word: proposed together, verified together, the rest merged."""
        proposals = [self.propose(w) for w in words]
        counts = np.fromiter(map(len, proposals), np.int64, len(words))
        flat = np.fromiter((i for p in proposals for i in p), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(words)), counts)
        inside = owner[1:] == owner[:-1]
        pairs, of = np.unique((flat[:-1] * self.size + flat[1:])[inside], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing = np.unique(owner[:-1][inside][~good[of]])
        for k in failing:
            proposals[k] = self.merge(words[k])
        return proposals


def _letter_classes() -> tuple[str, str, str]:
    """Classes of the plain characters below U+0250, their letters and their numbers.

    Plain: one lower-case character below U+0250, no composition, no control. All
    tools agree on them, so the fast path below needs no other normalization.
    """
    plain, letters, numbers = ["\t\n\r "], [], []
    for code in range(33, 0x250):
        c = chr(code)
        low, kind = c.lower(), unicodedata.category(c)
        if len(low) > 1 or ord(low) >= 0x250 or kind[0] in "CZ" or unicodedata.normalize("NFC", c) != c:
            continue
        plain.append(re.escape(c))
        (letters if kind[0] == "L" else numbers if kind[0] == "N" else []).append(re.escape(c))
    return "".join(plain), "".join(letters), "".join(numbers)


class Splitter:
    """Cuts a text into words as bytes, and special tokens as their numbers."""

    def __init__(self, tokenizer: Tokenizer):
        plain, letters, numbers = _letter_classes()
        self._other = re.compile(f"[^{plain}]").search
        clitics = "'s|'t|'re|'ve|'m|'ll|'d"
        self._ascii = re.compile(rf"{clitics}|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII).findall
        self._words = re.compile(
            rf"{clitics}|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+"
        ).findall
        self._special = tokenizer.special
        joined = "|".join(sorted(map(re.escape, self._special), key=len, reverse=True))
        self._cut = re.compile(f"({joined})").split if joined else None
        self._source, self._library = tokenizer.source, None

    def __call__(self, text: str) -> list[str | int]:
        if self._cut is None or "<" not in text:
            return self._plain_words(text)
        out: list[str | int] = []
        for part in self._cut(text):
            number = self._special.get(part)
            if number is None:
                out += self._plain_words(part)
            else:
                out.append(number)
        return out

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii() and not self._other(text):
            return self._ascii(text.lower())
        if not self._other(text):
            return self._words(text.lower())
        # Rarer characters: the tables of the tokenizers library decide.
        if self._library is None:
            from tokenizers import Tokenizer as Library

            self._library = Library.from_str(self._source)
            self._bytes = byte_letters()
        text = self._library.normalizer.normalize_str(text)
        letters = self._bytes
        return [
            bytes(letters[c] for c in word).decode("utf-8")
            for word, _ in self._library.pre_tokenizer.pre_tokenize_str(text)
        ]


class WordTokens:
    """Tokens of the words seen, one after the other in ``flat``."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.forget()

    def forget(self) -> None:
        self.index: dict[str | int, int] = {}
        self.starts, self.lengths, self.flat = array("q"), array("q"), array("i")

    def learn(self, words) -> None:
        if len(self.index) > REMEMBERED_WORDS:
            self.forget()
        new = [w for w in words if w not in self.index]
        texts = [w for w in new if isinstance(w, str)]
        found = dict(zip(texts, self.tokenizer.encode_words([w.encode() for w in texts])))
        for word in new:
            ids = found[word] if isinstance(word, str) else [word]
            self.index[word] = len(self.starts)
            self.starts.append(len(self.flat))
            self.lengths.append(len(ids))
            self.flat.extend(ids)

    def of(self, texts: list[list[str | int]]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in one array, and how many each text has."""
        self.learn({w for words in texts for w in words})
        at = np.fromiter((self.index[w] for ws in texts for w in ws), np.int64)
        starts, lengths = (np.frombuffer(x, np.int64)[at] for x in (self.starts, self.lengths))
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        steps = np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
        edges = np.cumsum([len(ws) for ws in texts])
        upto = np.concatenate([[0], ends])[edges]
        return np.frombuffer(self.flat, np.int32)[steps], np.diff(upto, prepend=0)


def encode(df: DataFrame, tokenizer_file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the tokens of the whole ``text`` in the array column ``ids``.

    Equal to the tokenizers library without special tokens added, truncation or padding.
    Null and empty texts have no tokens. Rows are neither lost nor merged; a column
    named like ``ids`` is replaced. The tokenizer (some MB) is read on the driver.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        model = df.sparkSession.sparkContext.broadcast(vars(Tokenizer(f.read())))
    rest = [c for c in df.columns if c != ids or c == text]
    source = df.select(*map(quoted, rest))
    schema = with_column(source.schema, ids, T.ArrayType(T.IntegerType()))
    position, dropped = rest.index(text), ids == text

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.of(model.value)
        cut, tokens = Splitter(tokenizer), WordTokens(tokenizer)
        for batch in slices(batches, position):
            words = [cut(t) if t else [] for t in batch.column(position).to_pylist()]
            flat, counts = tokens.of(words)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
            columns = [c for k, c in enumerate(batch.columns) if not (dropped and k == position)]
            yield pa.RecordBatch.from_arrays([*columns, lists], schema.names)

    return map_batches(source, task, schema)


def decode(
    df: DataFrame, tokenizer_file: str, ids: str = "ids", text: str = "decoded"
) -> DataFrame:
    """``df`` with the text of the tokens ``ids`` in the column ``text``.

    Equal to the library's decode without skipping special tokens: for a file that
    names no decoder, the tokens' strings joined by a space. Numbers that name no token
    and null numbers are passed over; a null array gives an empty text.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        strings = df.sparkSession.sparkContext.broadcast(Tokenizer(f.read()).strings)
    rest = [c for c in df.columns if c != text or c == ids]
    source = df.select(*map(quoted, rest))
    schema = with_column(source.schema, text, T.StringType())
    position, dropped = rest.index(ids), ids == text

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = strings.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                lists = batch.column(position)
                flat = lists.flatten()
                numbers = flat.to_pylist() if flat.null_count else flat.to_numpy().tolist()
                counts = pa.compute.list_value_length(lists).fill_null(0).to_pylist()
                texts, at = [], 0
                for n in counts:
                    part = numbers[at : at + n]
                    at += n
                    try:
                        texts.append(" ".join(map(known.__getitem__, part)))
                    except KeyError:
                        texts.append(" ".join(known[i] for i in part if i in known))
                columns = [c for k, c in enumerate(batch.columns) if not (dropped and k == position)]
                made = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, made], schema.names)

    return map_batches(source, task, schema)
