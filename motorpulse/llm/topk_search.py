"""Exact top-k search by inner product, term at a time.

A vector's components are terms with integer weights. A block of candidates is turned
into one posting list per term; every query, a sparse row of its non-zero terms, scatters
its weighted postings into a dense array of scores. The highest are selected from each
array, and those of all blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .vector_blocks import best, exact, flat, held, met, numbered, positions, scaled, sort_ids, usable

FOUND = "query_row long, query_id long, vec_id long, score long"


def postings(weights: np.ndarray, lengths: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Of every term, the rows that have it and their weights; zeros are no posting."""
    rows, terms = np.repeat(np.arange(len(lengths)), lengths), positions(lengths)
    held = np.flatnonzero(weights)
    held = held[np.argsort(terms[held], kind="stable")]
    names, starts = np.unique(terms[held], return_index=True)
    cuts = zip(names.tolist(), np.split(held, starts[1:]) if len(starts) else [])
    return {term: (rows[at], weights[at]) for term, at in cuts}


def accumulate(query: np.ndarray, lists: dict, n: int) -> np.ndarray:
    """Scores of all ``n`` rows: the query's terms in turn, each scattering its postings."""
    scores = np.zeros(n, query.dtype)
    for term in np.flatnonzero(query).tolist():
        if term in lists:
            rows, weights = lists[term]
            if len(rows) == n:
                scores += query[term] * weights
            else:
                scores[rows] += query[term] * weights
    return scores


def _search(k: int):
    def task(queries: pa.Table, living: pa.Table) -> pa.Table:
        found = ([], [], [], [])
        if queries.num_rows and living.num_rows:
            weights, lengths = flat(living["weights"])
            asked, widths = flat(queries["weights"])
            if not exact(weights, asked, int(min(lengths.max(), widths.max()))):
                weights, asked = weights.astype(object), asked.astype(object)
            lists, own = postings(weights, lengths), living["row"].to_numpy()
            ids, ranks = living["vec_id"].combine_chunks(), sort_ids(living["vec_id"])
            ends = np.cumsum(widths)
            rows, names = queries["row"].to_numpy(), queries["vec_id"].to_pylist()
            for row, name, end, width in zip(rows, names, ends, widths):
                scores = held(accumulate(asked[end - width : end], lists, len(own)))
                others = np.flatnonzero(own != row)
                at = others[best(scores[others], ranks[others], k)]
                found[0].extend([row] * len(at))
                found[1].extend([name] * len(at))
                found[2].extend(ids.take(pa.array(at)).to_pylist())
                found[3].extend(scores[at].tolist())
        names = [f.split()[0] for f in FOUND.split(", ")]
        return pa.table(dict(zip(names, (pa.array(c, pa.int64()) for c in found))))

    return task


def search(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    *,
    k: int = 10,
    factor: int = 1024,
) -> DataFrame:
    """The ``k`` best rows for every query row: query_id, rank, vec_id, score.

    The score is the inner product of floor(``factor`` * x), an exact integer, held to the
    range of a long; ties go to the smaller id, null ids last. ``is_query`` is a condition
    on the columns of ``vectors``; null is no. Candidates are all rows but the query's own
    row: another row of the same id or with the same vector is one. Vectors that are null
    or hold null or non-finite numbers take no part. Missing components (shorter vectors)
    count 0, so an empty vector scores 0. All queries meet all rows, in blocks.
    """
    taken = vectors.where(usable(F.col(embedding))).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        scaled(F.col(embedding), factor).alias("weights"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    taken = numbered(taken)
    rows = taken.select("row", "vec_id", "weights")
    found = met(taken.where("asks").select("row", "vec_id", "weights"), rows, _search(k), FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")
