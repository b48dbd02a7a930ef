"""Integer vectors, and a stated set of queries met with every row in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Rows of a block of candidates, if there are fewer blocks than shuffle partitions.
LEAST_ROWS = 1024
#: Numbers of a block of candidates and of a block of queries, as wide as the widest, on average.
MOST_NUMBERS, QUERY_NUMBERS = 4 << 20, 1 << 17
#: Sums below this are exact in 64 bits, a hundred times over too.
SAFE = 2**56
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def usable(embedding: Column) -> Column:
    """Whether the vector is not null and holds only finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return embedding.isNotNull() & ~F.exists(embedding, bad)


def scaled(embedding: Column, factor: int) -> Column:
    """floor(factor * x) of every component, x as double; held to the range of a long."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("long"))


def numbered(rows: DataFrame) -> DataFrame:
    """The rows stored once, each with a number ``row`` of its own: ids may repeat."""
    return stored(rows.withColumn("row", F.monotonically_increasing_id()))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of lists, end to end, and the lengths of the lists."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), lengths.astype(np.int64)


def positions(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each of the lists of these lengths."""
    starts = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) - np.repeat(starts, lengths)


def exact(a: np.ndarray, b: np.ndarray, width: int) -> bool:
    """Whether inner products of these numbers are exact in 64 bits."""
    high = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    return high[0] * high[1] * max(width, 1) < SAFE


def held(scores: np.ndarray) -> np.ndarray:
    """The scores as longs; larger numbers are held to that range."""
    if scores.dtype == object:
        scores = np.array([min(max(int(s), LOWEST), HIGHEST) for s in scores], np.int64)
    return scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id: partition, then sort."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], ~scores[kept]))[:k]]


def sort_ids(ids: pa.ChunkedArray) -> np.ndarray:
    """Ranks of the ids, nulls last; equal ids have equal ranks."""
    order = pa.compute.rank(ids.combine_chunks(), sort_keys="ascending", null_placement="at_end", tiebreaker="min")
    return order.to_numpy().astype(np.int64)


def met(queries: DataFrame, rows: DataFrame, task: Callable, schema: str) -> DataFrame:
    """``task(queries, rows)`` of Arrow tables for every block of one and every block of the other.

    Rows are dealt to blocks by number, so no key gathers more than another. There are
    about as many blocks as shuffle partitions, of ``LEAST_ROWS`` rows at least; more or
    wider rows make more blocks, so that one as a matrix has ``MOST_NUMBERS`` numbers. A
    side is copied once per block of the other.
    """
    spark = rows.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (n, width), (asked, longest) = (
        df.agg(F.count("*"), F.coalesce(F.max(F.size("weights")), F.lit(0))).first() for df in (rows, queries)
    )
    parts = max(-(-n * width // MOST_NUMBERS), min(-(-n // LEAST_ROWS), slots), 1)
    turns = max(-(-asked * longest // QUERY_NUMBERS), 1)
    deal = lambda k: F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    asking = queries.withColumn("turn", deal(turns)).withColumn("part", every(parts))
    living = rows.withColumn("part", deal(parts)).withColumn("turn", every(turns))
    living = living.toDF(*living.columns)  # columns of its own beside those of the queries
    return (
        asking.groupBy("part", "turn").cogroup(living.groupBy("part", "turn")).applyInArrow(task, schema)
    )
