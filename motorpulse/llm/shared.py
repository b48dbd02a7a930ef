"""What several operators of this subpackage need."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder

# Task functions travel whole, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: Bytes of text that a task holds as Python objects at a time.
SLICE_BYTES = 4 << 20


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the cluster's shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches cut where their texts reach ``SLICE_BYTES``; a row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        if pa.types.is_large_string(texts.type):
            lengths = pa.compute.binary_length(texts)
        else:
            lengths = pa.compute.binary_length(texts.cast(pa.string()))
        sizes = np.nan_to_num(lengths.to_numpy(zero_copy_only=False).astype(float))
        part = (np.cumsum(sizes) // SLICE_BYTES).astype(np.int64)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            yield batch.slice(start, stop - start)


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters are in it."""
    return "`" + name.replace("`", "``") + "`"


def with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """``schema`` with the column ``name`` at its end, in place of one of that name."""
    kept = [f for f in schema.fields if f.name != name]
    return T.StructType([*kept, T.StructField(name, kind)])


def map_batches(
    df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``df.mapInArrow(task, schema)`` whatever the columns are called, in and out."""
    places = [f"c{k}" for k in range(len(schema))]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in task(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, places)

    fields = [T.StructField(c, f.dataType) for c, f in zip(places, schema.fields)]
    plain = df.toDF(*(f"c{k}" for k in range(len(df.columns))))
    return plain.mapInArrow(renamed, T.StructType(fields)).toDF(*schema.names)


def components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge, by alternating large-star and small-star.

    ``edges`` holds two columns, the ends. Returns (node, component), the component
    being its smallest node. Edges that are null at an end or loops count for nothing.
    A star's centre may have any number of neighbours: minima are combined before
    the shuffle, and the joins have one row per node on one side.
    """
    a, b = (F.col(c) for c in edges.columns)
    kept = edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    stars = stored(kept.distinct())
    while not _are_stars(stars):
        stars = stored(_small_star(stored(_large_star(stars))))
    leaves = stars.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    centres = stars.select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return leaves.unionByName(centres.distinct())


def _both_ends(edges: DataFrame, hi: Column, lo: Column) -> DataFrame:
    """(node, other) of both, for every edge."""
    ends = (F.struct(x.alias("node"), y.alias("other")) for x, y in ((hi, lo), (lo, hi)))
    return edges.select(F.inline(F.array(*ends)))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or tied to one node only, which is one."""
    ends = _both_ends(edges, F.col("hi"), F.col("lo"))
    smaller, larger = (F.count_if(c) for c in (F.col("other") < F.col("node"), F.col("other") > F.col("node")))
    nodes = ends.groupBy("node").agg(smaller.alias("smaller"), larger.alias("larger"))
    return nodes.agg(F.max((F.col("smaller") > 1) | (F.col("smaller") > 0) & (F.col("larger") > 0))).first()[0] is not True


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it: as many
    edges as before, some more than once."""
    ends = _both_ends(edges, F.col("hi"), F.col("lo"))
    least = ends.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select(F.col("node").alias("lo"), F.least("node", "least").alias("least"))
    return edges.join(least, "lo").select("hi", F.col("least").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    tied = edges.join(least, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("least").alias("lo"))
    return tied.where("hi <> lo").distinct()
