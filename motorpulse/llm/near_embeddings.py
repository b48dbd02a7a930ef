"""Near-duplicate embeddings by an inverted multi-index.

A vector is cut into halves, each half has a codebook of its own, and the pairs of
nearest codewords form a grid of cells. A query visits cells in the order of a
multi-sequence traversal, nearest first, until the target recall is reached, and
compares itself with the vectors living there in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import components, stored

#: Vectors from which codebooks are learned, at most: the first by hash.
SAMPLE_ROWS = 20_000
#: Vectors of a cell of the grid, of all labels together, on average.
CELL_ROWS = 512
#: Vectors of a cell that meet in a task, on either side.
BLOCK_ROWS = 1024
#: Share of the neighbours at just the threshold whose cells are visited.
RECALL = 0.9999
ROUNDS = 12


def usable(vector: np.ndarray | None) -> bool:
    return vector is not None and bool(np.isfinite(vector).all()) and bool(vector.any())


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _halves(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (units.shape[1] + 1) // 2
    return units[:, :cut], units[:, cut:]


def _distances(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ words.T + (words**2).sum(axis=1)


def _codebook(points: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Codewords by Lloyd's rounds; a word without points stays where it is."""
    rng = np.random.default_rng(seed)
    words = points[rng.choice(len(points), min(size, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = _distances(points, words).argmin(axis=1)
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(words))
        words[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return words


class MultiIndex:
    """Two codebooks and the cost up to which cells are visited.

    The cost of a word for a half is the squared distance to the border between that
    word's region and the half's own, so the costs of a cell add up to (at most) the
    squared distance to the cell.
    """

    def __init__(self, books: tuple[np.ndarray, np.ndarray], reach: float = np.inf):
        self.books, self.reach = books, reach

    def costs(self, units: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Home word and costs of all words, for both halves."""
        homes, costs = [], []
        for half, words in zip(_halves(units), self.books):
            d = _distances(half, words)
            home = d.argmin(axis=1)
            apart = np.sqrt(np.maximum(_distances(words, words), 1e-30))[home]
            gap = d - d[np.arange(len(d)), home][:, None]
            cost = (np.maximum(gap, 0) / (2 * apart)) ** 2
            cost[np.arange(len(d)), home] = 0
            homes.append(home)
            costs.append(cost)
        return homes, costs

    def visits(self, guests: np.ndarray, hosts: np.ndarray) -> np.ndarray:
        """Whether each of the guests visits the home of each of the hosts."""
        (_, (first, second)), ((a, b), _) = self.costs(guests), self.costs(hosts)
        return first[:, a] + second[:, b] <= self.reach

    def cells_of(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Cells of one vector, nearest first, up to ``reach``: multi-sequence traversal."""
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        heap, seen, cells = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, []
        while heap:
            cost, i, j = heapq.heappop(heap)
            if cost > self.reach:
                break
            cells.append(int(a[i]) * len(second) + int(b[j]))
            for i2, j2 in ((i + 1, j), (i, j + 1)):
                if i2 < len(a) and j2 < len(b) and (i2, j2) not in seen:
                    seen.add((i2, j2))
                    heapq.heappush(heap, (first[a[i2]] + second[b[j2]], i2, j2))
        return cells


def learn(units: np.ndarray, size: int, cosine: float) -> MultiIndex:
    """The index of a sample; its reach covers ``RECALL`` of neighbours at ``cosine``.

    For every sampled vector, neighbours at just that cosine are drawn in random
    directions; the reach is the quantile of the costs of their cells.
    """
    first, second = _halves(units)
    books = (_codebook(first, size, 3), _codebook(second, size, 5))
    index = MultiIndex(books)
    rng = np.random.default_rng(9)
    costs = []
    for _ in range(max(1, min(10, 40_000 // len(units)))):
        noise = rng.standard_normal(units.shape)
        noise -= (noise * units).sum(axis=1, keepdims=True) * units
        noise = _unit(noise)
        near = cosine * units + np.sqrt(1 - cosine**2) * noise
        (_, per_half), (homes, _) = index.costs(units), index.costs(near)
        costs.append(sum(c[np.arange(len(units)), h] for c, h in zip(per_half, homes)))
    return MultiIndex(books, float(np.quantile(np.concatenate(costs), RECALL)))


def _packed(rows: DataFrame, number: str) -> DataFrame:
    """Rows (vec_id, label, embedding) with the vector packed; null if it links with nothing."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for vector in batch.column(2):
                numbers = None
                if vector.is_valid and not vector.values.null_count:
                    # -0.0 and 0.0 are one number, so copies are equal in their bytes.
                    numbers = vector.values.to_numpy(zero_copy_only=False) + 0.0
                packed.append(numbers.astype(number).tobytes() if usable(numbers) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                ["vec_id", "label", "vector"],
            )

    return rows.mapInArrow(task, "vec_id long, label string, vector binary")


def _stack(packed, number: str) -> np.ndarray:
    width = len(packed[0])
    flat = np.frombuffer(b"".join(packed), number).astype(np.float64)
    return _unit(flat.reshape(len(packed), width // np.dtype(number).itemsize))


def _link_block(number: str, cosine: float, model: Broadcast):
    """Links of queries with the vectors of one block: counts, and ties of the components.

    A link is counted at both ends, once: where the vector that lives here visits the
    query's home in its turn, it counts the link there, and here otherwise.
    """

    def task(queries: pd.DataFrame, living: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"key": [], "links": [], "tie": []}).astype("int64")
        if not len(queries) or not len(living):
            return empty
        ours, theirs = (_stack(df["vector"].tolist(), number) for df in (queries, living))
        mine, others = queries["key"].to_numpy(), living["key"].to_numpy()
        close = (ours @ theirs.T >= cosine) & (mine[:, None] != others)
        rows, columns = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
        if not len(rows):
            return empty
        close = close[np.ix_(rows, columns)]
        copies_q, copies_l = (df["copies"].to_numpy()[at] for df, at in ((queries, rows), (living, columns)))
        returned = MultiIndex(*model.value).visits(theirs[columns], ours[rows]).T
        links = close @ copies_l, (close & ~returned).T @ copies_q
        low_q, low_l, huge = mine[rows].copy(), others[columns].copy(), np.iinfo(np.int64).max
        while True:  # names fall until every tied set has its smallest
            new_q = np.minimum(low_q, np.where(close, low_l, huge).min(axis=1))
            new_l = np.minimum(low_l, np.where(close, new_q[:, None], huge).min(axis=0))
            if (new_q == low_q).all() and (new_l == low_l).all():
                break
            low_q, low_l = new_q, new_l
        return pd.DataFrame(
            {
                "key": np.concatenate([mine[rows], others[columns]]),
                "links": np.concatenate(links),
                "tie": np.concatenate([low_q, low_l]),
            }
        )

    return task


def _fitted(sets: DataFrame, n: int, number: str, cosine: float) -> MultiIndex:
    """The index learned from a bounded sample; its codebooks grow with the number of vectors."""
    rows = sets.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE_ROWS).collect()
    units = _stack([bytes(r["vector"]) for r in rows], number)
    return learn(units, max(2, int(np.ceil(np.sqrt(n / CELL_ROWS)))), cosine)


def _cells(sets: DataFrame, model: Broadcast, number: str) -> DataFrame:
    """(key, label, cell, visit): every vector at home, and in all the cells it visits."""
    schema = T.StructType.fromDDL("key long, label string, cell long, visit boolean")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = MultiIndex(*model.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                units = _stack(batch.column(2).to_pylist(), number)
                (first, second), (cost_a, cost_b) = index.costs(units)
                home = first * len(index.books[1]) + second
                visits = [index.cells_of(a, b) for a, b in zip(cost_a, cost_b)]
                own = np.arange(len(units))
                rows = np.concatenate([own, np.repeat(own, [len(v) for v in visits])])
                cells = np.concatenate([home, *visits]).astype(np.int64)
                taken = batch.select([0, 1]).take(pa.array(rows))
                visit = pa.array(np.arange(len(rows)) >= len(units))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(cells), visit], schema.names
                )

    return sets.select("key", "label", "vector").mapInArrow(task, schema)


def _links(sets: DataFrame, index: MultiIndex, number: str, cosine: float) -> DataFrame:
    """(key, links, tie): parts of the number of links, and ties that span the components.

    The vectors living in a cell and the queries that visit it are cut into blocks of
    about ``BLOCK_ROWS`` by hash, and every block of one meets every block of the other
    in a task of its own: pairs are counted there and never written out.
    """
    model = sets.sparkSession.sparkContext.broadcast((index.books, index.reach))
    cells = stored(_cells(sets, model, number))
    place = ["label", "cell"]
    parts = cells.groupBy(*place).agg(
        F.ceil(F.count_if(~F.col("visit")) / BLOCK_ROWS).cast("int").alias("homes"),
        F.ceil(F.count_if("visit") / BLOCK_ROWS).cast("int").alias("visits"),
    )
    parts = parts.where("homes > 0 AND visits > 0")
    placed = cells.join(parts, place).join(sets.drop("label"), "key")
    block = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    living = placed.where("NOT visit").select(
        *place, "key", "copies", "vector", block("homes").alias("home"), every("visits").alias("visitor")
    )
    queries = placed.where("visit").select(
        *place, "key", "copies", "vector", every("homes").alias("home"), block("visits").alias("visitor")
    )
    keys = [*place, "home", "visitor"]
    living = living.toDF(*living.columns)  # columns of its own beside those of the queries
    return (
        queries.groupBy(*keys)
        .cogroup(living.groupBy(*keys))
        .applyInPandas(_link_block(number, cosine, model), "key long, links long, tie long")
    )


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    *,
    cosine: float = 0.98,
) -> DataFrame:
    """Links of every vector: vec_id, n_links, component_id, kept; one row per row.

    Vectors are compared if their labels are equal and not null and their lengths are
    equal. Vectors that are null, zero or hold null or non-finite numbers, null ids and
    null labels are linked with nothing (component: the own id; kept). Copies of a vector
    are compared once and count each; rows that share an id are vectors of their own.
    Codebooks are learned from ``SAMPLE_ROWS`` vectors at most; every vector is indexed.
    No link is below ``cosine``; of links at just the threshold, in a random direction,
    the visits of either end find the share ``RECALL``, of closer ones more. A link that is
    found counts at both ends.
    """
    kind = vectors.schema[embedding].dataType
    number = "f4" if isinstance(kind, T.ArrayType) and kind.elementType == T.FloatType() else "f8"
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.when(F.col(vec_id).isNotNull() & F.col(label).isNotNull(), F.col(embedding)).alias("embedding"),
    )
    packed = stored(_packed(rows, number))
    groups = packed.where("vector IS NOT NULL").groupBy("label", "vector")
    sets = groups.agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    sets = stored(sets.withColumn("key", F.monotonically_increasing_id()))
    widths = sets.groupBy(F.length("vector").alias("width")).agg(F.count("*").alias("n")).collect()
    found = None
    for width, n in sorted(map(tuple, widths)):
        part = sets.where(F.length("vector") == width)
        links = _links(part, _fitted(part, n, number, cosine), number, cosine)
        found = links if found is None else found.unionByName(links)
    if found is None:
        none = F.lit(0).cast("long").alias("n_links")
        alone = packed.select("vec_id", none, F.col("vec_id").alias("component_id"))
        return alone.withColumn("kept", F.lit(True))
    found = stored(found)
    classes = components(found.select("key", "tie")).withColumnRenamed("node", "key")
    tied = classes.join(sets.select("key", "first"), "key")
    lowest = tied.groupBy("component").agg(F.min("first").alias("lowest"))
    named = classes.join(lowest, "component").select("key", "lowest")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    known = sets.join(counts, "key", "left").join(named, "key", "left").select(
        "label",
        "vector",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("lowest", "first").alias("lowest"),
    )
    return (
        packed.join(known, ["label", "vector"], "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("lowest", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
