"""Hard negatives of anchors by angular triangle filtering.

Every row keeps its angles to a few reference directions. By the triangle inequality of
angles, those of an anchor and of a row bound the angle between them from both sides; its
cosines, multiplied by the norms and rounded outwards, bound the integer score. Only rows
whose bounds overlap the scores that are wanted are scored in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .vector_blocks import HIGHEST, LOWEST, best, exact, flat, held, met, numbered, positions, scaled, sort_ids, usable

#: Reference directions, and the rows (the first by hash) among which they are chosen.
DIRECTIONS, SAMPLE_ROWS = 16, 1000
#: Angles near 0 and pi come out of arccos with an error of some 1e-8.
SLACK = 1e-6

POSITIVE = "anchor_row long, anchor_id long, positive_id long, positive_score long"
NEGATIVE = POSITIVE + ", place int, negative_id long, negative_score long"


def matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones are filled up with zeros."""
    numbers, lengths = flat(column)
    width = int(lengths.max(initial=0)) if width is None else width
    out = np.zeros((len(lengths), width), numbers.dtype)
    at = positions(lengths)
    inside = at < width
    out[np.repeat(np.arange(len(lengths)), lengths)[inside], at[inside]] = numbers[inside]
    return out


def _angles(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the directions; a zero vector's angles are 0 and mean nothing."""
    high = np.abs(vectors).max(axis=1, initial=0)[:, None]
    even = vectors / np.where(high == 0, 1, high)
    length = np.sqrt((even**2).sum(axis=1))[:, None]
    units = even / np.where(length == 0, 1, length)
    return (high * length)[:, 0], np.where(length == 0, 0, np.arccos(np.clip(units @ directions.T, -1, 1)))


def directions_of(sample: np.ndarray, k: int = DIRECTIONS) -> np.ndarray:
    """Units of the sample, each next one the farthest in angle from those chosen."""
    norms = np.sqrt((sample.astype(float) ** 2).sum(axis=1))
    units = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return np.zeros((0, sample.shape[1]))
    chosen, near = [0], units @ units[0]
    while len(chosen) < min(k, len(units)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, units @ units[chosen[-1]])
    return units[chosen]


def bounds(norm: float, angles: np.ndarray, norms: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores between which those with the rows must lie, rounded outwards."""
    if others.shape[1]:
        low = np.maximum(np.abs(others - angles).max(axis=1) - SLACK, 0)
        both = others + angles
        high = np.minimum(np.minimum(both, 2 * np.pi - both).min(axis=1) + SLACK, np.pi)
    else:
        low, high = np.zeros(len(norms)), np.full(len(norms), np.pi)
    size = norm * norms
    room = 1 + 1e-9 * size
    least, most = np.floor(size * np.cos(high) - room), np.ceil(size * np.cos(low) + room)
    return np.clip(least, LOWEST, HIGHEST), np.clip(most, LOWEST, HIGHEST)


class _Block:
    """The rows of a block, by label, and what an anchor asks of them."""

    def __init__(self, anchors: pa.Table, living: pa.Table):
        self.living = living.sort_by("label")
        self.labels = self.living["label"].to_numpy().astype(object)
        self.rows, self.ids = self.living["row"].to_numpy(), self.living["vec_id"].combine_chunks()
        self.ranks = sort_ids(self.living["vec_id"])
        self.weights, asked = matrix(self.living["weights"]), matrix(anchors["weights"])
        width = min(self.weights.shape[1], asked.shape[1])
        self.weights, self.asked = self.weights[:, :width], asked[:, :width]
        self.wide = not exact(self.weights, self.asked, width)
        self.norms, self.angles = self.living["norm"].to_numpy(), matrix(self.living["angles"])
        self.anchor_norms, self.anchor_angles = anchors["norm"].to_numpy(), matrix(anchors["angles"])

    def bounds(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return bounds(self.anchor_norms[k], self.anchor_angles[k], self.norms[at], self.angles[at])

    def scores(self, k: int, at: np.ndarray) -> np.ndarray:
        if self.wide:
            return held((self.weights[at].astype(object) * self.asked[k].astype(object)).sum(axis=1))
        return self.weights[at] @ self.asked[k]

    def same(self, label: str) -> slice:
        return slice(*(int(np.searchsorted(self.labels, label, side=s)) for s in ("left", "right")))


def _table(schema: str, columns: list[list]) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns)})


def _positives(k: int):
    """The first ``k`` rows of an anchor's label in a block."""

    def task(anchors: pa.Table, living: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if anchors.num_rows and living.num_rows:
            block = _Block(anchors, living)
            asks = zip(anchors["row"].to_pylist(), anchors["vec_id"].to_pylist(), anchors["label"].to_pylist())
            for n, (row, name, label) in enumerate(asks):
                part = block.same(label)
                at = np.arange(part.start, part.stop)
                at = at[block.rows[at] != row]
                if len(at) > k:
                    low, high = block.bounds(n, at)
                    at = at[high >= np.partition(low, len(low) - k)[len(low) - k]]
                scores = block.scores(n, at)
                first = best(scores, block.ranks[at], k)
                out[0].extend([row] * len(first))
                out[1].extend([name] * len(first))
                out[2].extend(block.ids.take(pa.array(at[first])).to_pylist())
                out[3].extend(scores[first].tolist())
        return _table(POSITIVE, out)

    return task


def _negatives(k: int, least: int, most: int):
    """For every positive of an anchor, the first ``k`` rows of other labels in its window."""

    def task(anchors: pa.Table, living: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], [], []]
        if anchors.num_rows and living.num_rows:
            block = _Block(anchors, living)
            asks = zip(*(anchors[c].to_pylist() for c in ("row", "vec_id", "label", "positives")))
            for n, (row, name, label, positives) in enumerate(asks):
                part = block.same(label)
                at = np.r_[0 : part.start, part.stop : len(block.rows)]
                low, high = block.bounds(n, at)
                # An integer score s is wanted if least * p <= 100 * s <= most * p.
                edges = [(-(-least * p["score"] // 100), most * p["score"] // 100) for p in positives]
                wanted = np.zeros(len(at), bool)
                for a, b in edges:
                    wanted |= (high >= a) & (low <= b)
                at = at[wanted]
                scores, ranks = block.scores(n, at), block.ranks[at]
                for p, (a, b) in zip(positives, edges):
                    inside = np.flatnonzero((scores >= a) & (scores <= b))
                    first = inside[best(scores[inside], ranks[inside], k)]
                    values = [row, name, p["vec_id"], p["score"], p["place"]]
                    for column, value in zip(out, values):
                        column.extend([value] * len(first))
                    out[5].extend(block.ids.take(pa.array(at[first])).to_pylist())
                    out[6].extend(scores[first].tolist())
        return _table(NEGATIVE, out)

    return task


def _with_angles(rows: DataFrame) -> DataFrame:
    """The rows with their norm and angles to the directions, which a bounded sample gives."""
    spark = rows.sparkSession
    sample = rows.select("weights").orderBy(F.xxhash64("weights")).limit(SAMPLE_ROWS).collect()
    width = max((len(r["weights"]) for r in sample), default=0)
    chosen = np.zeros((len(sample), width))
    for k, r in enumerate(sample):
        chosen[k, : len(r["weights"])] = r["weights"]
    shared = spark.sparkContext.broadcast(directions_of(chosen))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = shared.value
        for batch in batches:
            vectors = matrix(batch.column("weights")).astype(float)
            wide = np.zeros((len(directions), vectors.shape[1]))
            shown = min(wide.shape[1], directions.shape[1])
            wide[:, :shown] = directions[:, :shown]
            # A direction is as long as the sample's vectors: what a shorter row lacks is 0 there.
            norms, angles = _angles(vectors, wide)
            angles = pa.ListArray.from_arrays(
                np.arange(len(norms) + 1, dtype=np.int32) * angles.shape[1], pa.array(angles.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norms), angles], [*batch.schema.names, "norm", "angles"]
            )

    schema = "row long, vec_id long, label string, weights array<long>, norm double, angles array<double>"
    return rows.select("row", "vec_id", "label", "weights").mapInArrow(task, schema)


def _first(found: DataFrame, keys: list[str], score: str, name: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(name))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    *,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    factor: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of floor(``factor`` * x) with the anchor's, an exact integer
    held to the range of a long; higher scores come first, ties by the smaller id, null ids
    last. An anchor's positives are its first ``positives`` other rows of its label; each
    has the first ``negatives`` rows of other labels whose score is between ``least`` and
    ``most`` hundredths of the positive's. A negative positive score leaves no window.
    ``is_anchor`` and ``label`` are expressions on the columns of ``vectors``; labels are
    compared as text, a null condition is no, and rows with a null label or with a vector that is null or holds null
    or non-finite numbers take no part. Components that a shorter vector lacks count 0.
    Rows that share an id, or copies, are rows of their own: a repeated anchor id has the
    results of each of its rows, and its other rows may be its positives.
    """
    taken = vectors.where(usable(F.col(embedding)) & label.isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        label.cast("string").alias("label"),
        scaled(F.col(embedding), factor).alias("weights"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    taken = numbered(taken)
    rows = stored(_with_angles(taken))
    anchors = rows.join(taken.where("asks").select("row"), "row", "left_semi")
    near = met(anchors, rows, _positives(positives), POSITIVE)
    near = _first(near, ["anchor_row"], "positive_score", "positive_id", positives)
    one = F.struct(
        F.col("rank").alias("place"), F.col("positive_id").alias("vec_id"), F.col("positive_score").alias("score")
    )
    windows = near.where("positive_score >= 0").groupBy(F.col("anchor_row").alias("row"))
    asking = stored(anchors.join(windows.agg(F.array_sort(F.collect_list(one)).alias("positives")), "row"))
    found = met(asking, rows, _negatives(negatives, least, most), NEGATIVE)
    hard = _first(found, ["anchor_row", "place"], "negative_score", "negative_id", negatives)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
