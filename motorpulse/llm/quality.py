"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w . x - threshold_k), with one weight vector w over hashed text
features for all grades and thresholds in ascending order. The expected grade orders
documents, the tail probability of the best grade selects them. The last threshold rises
with the number of marks in the text: words, or beginnings of words, that rated documents
of the grade below the best have and those of the best have not. How far it rises is
learned with the rest; no mark decides by itself.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_batches, slices, stored, with_column

#: Width of the hashed features.
BUCKETS = 1 << 19
#: Labelled documents to learn from, at most: the first by the MD5 of their id.
SAMPLE_ROWS = 10_000
#: A hashed word counts only if it is in this many of them.
LEAST_DOCS = 6
#: And if their grades differ by so many standard deviations from those of all.
LEAST_Z = 5.0
#: Value of a word that is there, beside the other features between 0 and 4.
WORD_VALUE = 1.0
#: Weight of the ridge.
RIDGE = 1e-4
STEPS = 250
#: A mark is in so many rated documents of the grade below the best at least, and these are
#: this share of those of both grades that have it.
MARK_DOCS, MARK_SHARE = 4, 0.9
#: Marks at most: the most frequent ones.
MOST_MARKS = 4096
#: The last threshold has a step of its own from each of these numbers of marks on.
MARK_STEPS = (1, 2, 4)
#: Parts of the sample: the marks that teach the steps come from the other parts.
FOLDS = 4
GRADES = 3
#: Documents are kept from this probability of the best grade on.
KEEP_FROM = 0.7
#: Distinct words whose features a task remembers before it starts anew.
REMEMBERED_WORDS = 500_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
SHAPES = 16


def grade(quality: Column, toxic: Column) -> Column:
    """0 for bad quality, 1 for good but toxic, 2 for good and clean; null if unrated."""
    return (
        F.when(quality == 0, 0)
        .when((quality == 1) & (toxic == 1), 1)
        .when((quality == 1) & (toxic == 0), 2)
    )


def _shape(token: str) -> int:
    if token[0].isalnum() or token[0] == "_":
        if token.isdigit():
            return 0
        if token.isalpha():
            return 1 if token.islower() else 2 if token.istitle() else 3 if token.isupper() else 4
        return 5
    if len(token) == 1:
        return 6 if token in ".," else 7 if token == "|" else 8
    return 9 if len(set(token)) == 1 else 10


def _code(token: str) -> int:
    """Buckets of the word and of its first four and five letters, and its shape, in one number."""
    word = token.lower()
    parts = (word, "4" + word[:4], "5" + word[:5])
    whole, four, five = (xxhash.xxh32_intdigest(p) % BUCKETS for p in parts)
    return whole << 42 | four << 23 | five << 4 | _shape(token)


def _mark_keys(token: str) -> list[int]:
    """64-bit keys of a word and of its first five letters: wide, so that words never seen
    before are not taken for others."""
    word = token.lower()
    if not word[0].isalnum():
        return []
    parts = [word] if len(word) <= 5 else [word, "5" + word[:5]]
    return [xxhash.xxh64_intdigest(p) - (1 << 63) for p in parts]


class Features:
    """Features of a text: hashed words and word beginnings it has, shares of token shapes, length, repetition."""

    def __init__(self, marks: frozenset[int] = frozenset()):
        self.known: dict[str, int] = {}
        self.marks, self.marked = marks, {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Columns and values, ``BUCKETS`` word columns before the few others, and the number
        of different marks."""
        tokens = TOKEN.findall(text or "")
        known, different = self.known, set(tokens)
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        for t in different.difference(known):
            known[t] = _code(t)
            if self.marks and (found := self.marks.intersection(_mark_keys(t))):
                self.marked[t] = found
        codes = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        hashed = np.concatenate([codes >> 42, codes >> 23 & BUCKETS - 1, codes >> 4 & BUCKETS - 1])
        words = np.unique(hashed)
        n = max(1, len(tokens))
        shares = np.bincount(codes & SHAPES - 1, minlength=SHAPES) / n
        size = min(19, int(math.log2(n)))
        lines = (text or "").split("\n")
        others = np.concatenate(
            [shares * 4, np.sqrt(shares) * 2, [len(words) / n, len(set(lines)) / len(lines), 1.0]]
        )
        columns = np.concatenate([words, BUCKETS + np.arange(len(others)), [BUCKETS + len(others) + size]])
        marks = len(set().union(*(self.marked[t] for t in different & self.marked.keys())))
        return columns, np.concatenate([np.full(len(words), WORD_VALUE), others, [1.0]]), marks


WIDTH = BUCKETS + 2 * SHAPES + 3 + 20


class Ordinal:
    """Weights and ascending thresholds of a cumulative-link model; marks and the steps by
    which they raise the last threshold."""

    def __init__(
        self,
        weights: np.ndarray,
        thresholds: np.ndarray,
        steps: np.ndarray = np.zeros(len(MARK_STEPS)),
        marks: frozenset[int] = frozenset(),
    ):
        self.weights, self.thresholds, self.steps, self.marks = weights, thresholds, steps, marks

    def score(self, columns: np.ndarray, values: np.ndarray) -> float:
        return float(self.weights[columns] @ values)

    def tails(self, scores: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score and number of marks, and for every threshold."""
        thresholds = np.repeat(self.thresholds[None], len(scores), axis=0)
        thresholds[:, -1] += _steps(marks) @ self.steps
        return _sigmoid(scores[:, None] - thresholds)


def _steps(marks: np.ndarray) -> np.ndarray:
    return (np.asarray(marks)[:, None] >= np.array(MARK_STEPS)).astype(float)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Likelihood:
    """Mean negative log-likelihood with a ridge, and its slope.

    The parameters are the first threshold, the logarithms of the steps between thresholds,
    the steps by marks and the weights.
    """

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, int]], marks: np.ndarray, grades: int):
        self.used, columns = np.unique(np.concatenate([c for c, _, _ in rows]), return_inverse=True)
        self.columns, self.values = columns, np.concatenate([v for _, v, _ in rows]).astype(float)
        self.owner = np.repeat(np.arange(len(rows)), [len(c) for c, _, _ in rows])
        self.y, self.marks = np.array([g for _, _, g in rows]), _steps(marks)
        self.last = grades - 1

    def start(self) -> np.ndarray:
        shares = np.clip([np.mean(self.y <= k) for k in range(self.last)], 0.01, 0.99)
        cuts = np.log(shares / (1 - shares))
        steps = np.log(np.maximum(np.diff(cuts), 0.1))
        return np.concatenate([cuts[:1], steps, np.full(len(MARK_STEPS), 0.5), np.zeros(len(self.used))])

    def split(self, params: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Thresholds, steps by marks, weights."""
        k, m = self.last, self.last + len(MARK_STEPS)
        cuts = np.concatenate([params[:1], params[0] + np.cumsum(np.exp(params[1:k]))])
        return cuts, params[k:m], params[m:]

    def __call__(self, params: np.ndarray) -> tuple[float, np.ndarray]:
        y, n, k = self.y, len(self.y), self.last
        cuts, steps, weights = self.split(params)
        scores = np.bincount(self.owner, self.values * weights[self.columns], n)
        thresholds = np.repeat(cuts[None], n, axis=0)
        thresholds[:, -1] += self.marks @ steps
        above = _sigmoid(scores[:, None] - thresholds)
        edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        chance = np.maximum(edges[at, y] - edges[at, y + 1], 1e-9)
        slope = edges * (1 - edges)
        by_score = -(slope[at, y] - slope[at, y + 1]) / chance / n
        own = np.arange(1, k + 1)
        by_cut = slope[:, 1:-1] * ((y[:, None] == own).astype(float) - (y[:, None] == own - 1)) / (chance * n)[:, None]
        total = by_cut.sum(axis=0)
        gradient = np.concatenate(
            [
                [total.sum()],
                [np.exp(params[j]) * total[j:].sum() for j in range(1, k)],
                self.marks.T @ by_cut[:, -1] + RIDGE * steps,
                np.bincount(self.columns, self.values * by_score[self.owner], len(self.used)) + RIDGE * weights,
            ]
        )
        loss = -np.log(chance).mean() + RIDGE / 2 * (weights @ weights + steps @ steps)
        return float(loss), gradient


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int = GRADES, marks: np.ndarray | None = None
) -> Ordinal:
    """The model of (columns, values, grade) and numbers of marks, by gradient steps.

    Steps by marks are never below 0, so the tails stay in order. Without rows every
    document gets the middle of the scale.
    """
    weights = np.zeros(WIDTH, np.float32)
    if not rows:
        return Ordinal(weights, np.arange(1 - grades / 2, grades / 2))
    loss = Likelihood(rows, np.zeros(len(rows)) if marks is None else marks, grades)
    params = loss.start()
    mean, square = np.zeros_like(params), np.zeros_like(params)
    by_marks = slice(grades - 1, grades - 1 + len(MARK_STEPS))
    for step in range(1, STEPS + 1):
        _, gradient = loss(params)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.05 * (1 - step / (STEPS + 1))
        params -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        params[by_marks] = np.maximum(params[by_marks], 0)
    cuts, steps, weights[loss.used] = loss.split(params)
    return Ordinal(weights, cuts, steps.copy())


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, grade) of ``SAMPLE_ROWS`` rated documents at most, chosen by hash of the id.

    ``labels``: doc_id, quality, toxic. Documents rated twice count by their worst grade;
    ratings with nulls are none.
    """
    rated = labels.select(
        F.col("doc_id").alias("rated_id"), grade(F.col("quality"), F.col("toxic")).alias("grade")
    )
    rated = rated.where("grade IS NOT NULL AND rated_id IS NOT NULL")
    rated = rated.groupBy("rated_id").agg(F.min("grade").alias("grade"))
    order = F.md5(F.col("rated_id").cast("string").cast("binary"))
    rated = rated.orderBy(order, "rated_id").limit(SAMPLE_ROWS)
    texts = docs.select(F.col(doc_id).alias("rated_id"), F.col(text).alias("text"))
    return texts.join(rated, "rated_id").select("text", "grade")


def _features(rated: DataFrame) -> DataFrame:
    """(grade, fold, columns, others, keys) of the rated texts; equal texts are in one fold."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches, 0):
            out: list[list] = [[], [], [], []]
            for text in batch.column(0).to_pylist():
                columns, values, _ = features(text)
                keys = {k for t in set(TOKEN.findall(text or "")) for k in _mark_keys(t)}
                others = values[columns >= BUCKETS].astype(np.float32)  # words all have the same value
                fold = xxhash.xxh32_intdigest((text or "").encode("utf-8", "replace")) % FOLDS
                for column, value in zip(out, (fold, columns.astype(np.int32), others, sorted(keys))):
                    column.append(value)
            kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float32()), pa.list_(pa.int64())]
            arrays = [pa.array(c, kind) for c, kind in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *arrays], ["grade", "fold", "columns", "others", "keys"]
            )

    schema = "grade int, fold int, columns array<int>, others array<float>, keys array<long>"
    return rated.mapInArrow(task, schema)


def _telling(made: DataFrame, totals: dict[int, int]) -> np.ndarray:
    """Columns that enough documents have and whose documents have one of the grades far
    more or less often than all have; counted by Spark, at most as many as there are columns."""
    n = max(1, sum(totals.values()))
    counts = made.select("grade", F.explode("columns").alias("column")).groupBy("column").agg(
        F.count("*").alias("n"), *(F.count_if(F.col("grade") == k).alias(f"n{k}") for k in range(GRADES))
    )
    off = F.lit(False)
    for k in range(GRADES):
        share = min(0.99, max(0.01, totals.get(k, 0) / n))
        far = LEAST_Z * F.sqrt(F.lit(share * (1 - share)) / F.col("n"))
        off = off | (F.abs(F.col(f"n{k}") / F.col("n") - share) >= far)
    chosen = counts.where((F.col("column") >= BUCKETS) | (off & (F.col("n") >= LEAST_DOCS)))
    return np.array(sorted(r["column"] for r in chosen.select("column").collect()), np.int32)


def _marks(made: DataFrame) -> list[frozenset[int]]:
    """Marks of the sample without each of its parts, and last of the whole sample."""
    near = made.where(F.col("grade") >= GRADES - 2).select("grade", "fold", F.explode("keys").alias("key"))
    below = F.col("grade") == GRADES - 2
    parts = [F.col("fold") == j for j in range(FOLDS)]
    counts = near.groupBy("key").agg(
        F.count_if(below).alias("below"),
        F.count("*").alias("both"),
        *(F.count_if(below & p).alias(f"below{j}") for j, p in enumerate(parts)),
        *(F.count_if(p).alias(f"both{j}") for j, p in enumerate(parts)),
    )
    without = [
        (F.col("below") - F.col(f"below{j}"), F.col("both") - F.col(f"both{j}"), MARK_DOCS * (FOLDS - 1) // FOLDS)
        for j in range(FOLDS)
    ]
    tests = [*without, (F.col("below"), F.col("both"), MARK_DOCS)]
    marks = [(a >= n) & (a >= MARK_SHARE * b) for a, b, n in tests]
    anywhere = marks[0]
    for m in marks[1:]:
        anywhere = anywhere | m
    chosen = counts.where(anywhere).orderBy(F.desc("below"), "key").limit(MOST_MARKS)
    found = chosen.select("key", *(m.alias(f"m{j}") for j, m in enumerate(marks))).collect()
    return [frozenset(r["key"] for r in found if r[f"m{j}"]) for j in range(FOLDS + 1)]


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Ordinal:
    """The classifier of a bounded sample of the rated documents.

    Features are made on the executors, and Spark counts which columns and marks tell
    something; the driver gets what ``SAMPLE_ROWS`` documents at most have of those, and
    fits the weights. The numbers of marks that it learns from are those that would be
    found in documents not seen: by the marks of the other parts of the sample.
    """
    made = stored(_features(sample(docs, labels, doc_id, text)))
    totals = {r["grade"]: r["n"] for r in made.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    telling, marks = _telling(made, totals), _marks(made)
    shared = made.sparkSession.sparkContext.broadcast((telling, marks))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        telling, marks = shared.value
        for batch in batches:
            out: list[list] = [[], [], []]
            for fold, columns, others, keys in zip(*(batch.column(k) for k in range(1, 5))):
                columns, others = columns.values.to_numpy(), others.values.to_numpy()
                values = np.concatenate([np.full(len(columns) - len(others), WORD_VALUE, np.float32), others])
                kept = np.isin(columns, telling)
                count = len(marks[fold.as_py()].intersection(keys.values.to_pylist()))
                for column, value in zip(out, (columns[kept].tobytes(), values[kept].tobytes(), count)):
                    column.append(value)
            arrays = [pa.array(c, kind) for c, kind in zip(out, (pa.binary(), pa.binary(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(0)], ["c", "v", "marks", "grade"])

    rows = made.mapInArrow(task, "c binary, v binary, marks int, grade int")
    # In one order, however the tasks ran, so that a rerun fits the same numbers.
    found = sorted((bytes(r["c"]), bytes(r["v"]), r["grade"], r["marks"]) for r in rows.collect())
    read = [(np.frombuffer(c, np.int32), np.frombuffer(v, np.float32), g) for c, v, g, _ in found]
    model = fit(read, marks=np.array([m for *_, m in found]))
    model.marks = marks[-1]
    return model


def rate(docs: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """``docs`` with expected_grade (0 to 2) and p_best (of the best grade) at the end.

    Columns of these names are replaced. Null and empty texts are rated as empty ones,
    whole texts are read however long, and equal texts are rated equal.
    """
    names = ("expected_grade", "p_best")
    state = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds, model.steps, model.marks))
    position = docs.columns.index(text)
    schema = docs.schema
    for name in names:
        schema = with_column(schema, name, T.DoubleType())
    keep = [k for k, c in enumerate(docs.columns) if c not in names]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ordinal(*state.value)
        features = Features(model.marks)
        for batch in slices(batches, position):
            found = [features(t) for t in batch.column(position).to_pylist()]
            scores = np.array([model.score(columns, values) for columns, values, _ in found])
            tails = model.tails(scores, np.array([marks for *_, marks in found]))
            columns = [batch.column(k) for k in keep]
            made = [pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])]
            yield pa.RecordBatch.from_arrays([*columns, *made], schema.names)

    return map_batches(docs, task, schema)
