"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated as often as
allowed. A document's virtual finish time is the running number of tokens of its
source divided by the source's target; taken in that order until the total budget is
spent, the sources advance together and end near their targets.

DataFrame functions only. Running sums are taken in two steps (over bins of the order,
then inside a bin), so no task holds the rows of a whole source or of the whole order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Rows of a bin of a source's shuffled order, about, if the source had all rows.
BIN_ROWS = 50_000
#: Bins into which a stretch of virtual time is cut while the end of the mix is sought.
TIME_BINS = 4096
#: Rows among which the end of the mix is found by one running sum.
LAST_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column) -> Column:
    """What orders the documents of a source; rows equal in id and text have one."""
    md5 = lambda c: F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))
    return F.md5(F.concat(md5(doc_id), md5(text)).cast("binary"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Target of every source: (source, source_rank, source_size, target).

    Sources in order of code points, null last, take the weights in turn and share the
    sum of all sizes. No target exceeds ``max_repeats`` times its source's size; what is
    cut off is shared out by weight again until no target is above. That is filling by
    level: capped are the sources of the smallest cap per weight. One row per source
    goes through a window without partitions.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = (
        by_source.withColumn("source_rank", F.row_number().over(in_order))
        .withColumn("weight", weight)
        .withColumn("cap", (F.col("source_size") * max_repeats).cast("long"))
    )
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "source_rank")
    below = by_level.rowsBetween(Window.unboundedPreceding, -1)
    above = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything)
    level = (budget - F.coalesce(F.sum("cap").over(below), F.lit(0))) / F.sum("weight").over(above)
    leveled = ranked.withColumn("level", level)
    # The first source whose cap is above the level, and all after it, get the level.
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    water = F.first(free, ignorenulls=True).over(
        Window.orderBy(F.col("cap") / F.col("weight"), "source_rank").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
    )
    target = F.least(F.col("cap").cast("double"), F.col("weight") * water)
    return leveled.withColumn("target", F.coalesce(target, F.col("cap").cast("double"))).select(
        "source", "source_rank", "source_size", "target"
    )


def _queues(sizes: DataFrame, targets: DataFrame, rows: int) -> DataFrame:
    """``sizes`` with the rank, size and target of their source and the running sum in it.

    The digits of the hash that cut a source into bins, two or more, follow the rows.
    """
    digits = 2
    while 16**digits * BIN_ROWS < rows:
        digits += 1
    key = ["no_source", "source_name", "hash_bin"]
    rows = sizes.withColumn("hash_bin", F.substring("shuffle_key", 1, digits))
    before = Window.partitionBy(*key[:2]).orderBy("hash_bin")
    inside = Window.partitionBy(*key).orderBy("shuffle_key", "doc_id", "size")
    bins = rows.groupBy(*key).agg(F.sum("size").alias("words"))
    bins = bins.withColumn(
        "before",
        F.coalesce(F.sum("words").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).drop("words")
    bins = bins.join(_keyed(targets).drop("source"), key[:2])
    sofar = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn("sofar", sofar)
        .join(bins, key)
        .withColumn("sofar", F.col("sofar") + F.col("before"))
        .drop("before", *key)
    )


def _keyed(df: DataFrame) -> DataFrame:
    """``df`` with keys by which null sources meet each other and nothing else."""
    return df.withColumn("no_source", F.col("source").isNull()).withColumn(
        "source_name", F.coalesce("source", F.lit(""))
    )


ORDER = ("finish", "shuffle_key", "source_rank", "doc_id", "size", "round")


def _copy(number: int) -> Column:
    """One round of a document in its queue; null if it has no words."""
    finish = (F.col("sofar") + F.lit(number) * F.col("source_size")) / F.col("target")
    values = {"finish": finish, "round": F.lit(number)}
    fields = [values.get(c, F.col(c)).alias(c) for c in ORDER]
    return F.when(F.col("size") > 0, F.struct(*fields))


def _end(queued: DataFrame, total: int, max_repeats: int):
    """A function that tells of a copy whether it is in the mix.

    Sums over bins of virtual time show in which bin the budget ends; that bin is cut
    again until few rows are left, among which one running sum finds the last copy.
    Rows that finish at the same time are told apart by their hash in the same way.
    What reaches the driver is one bin's row each time.
    """
    copies = queued.select(F.explode(F.array(*map(_copy, range(max_repeats)))).alias("copy"))
    copies = copies.where("copy IS NOT NULL")
    before = lambda c: F.lit(False)
    here = lambda c: F.lit(True)
    spent, low, high, digits = 0, 0.0, 2.0, 0
    while True:
        if digits:
            bin_ = lambda c, n=digits: F.substring(c["shuffle_key"], 1, n)
        else:
            bin_ = lambda c, a=low, b=high: F.floor(
                F.least((c["finish"] - F.lit(a)) / F.lit(b - a), F.lit(1.0)) * TIME_BINS
            )
        c = F.col("copy")
        bins = copies.where(here(c)).groupBy(bin_(c).alias("bin")).agg(
            F.sum("copy.size").alias("words"),
            F.count("*").alias("rows"),
            F.min("copy.finish").alias("low"),
            F.max("copy.finish").alias("high"),
        )
        upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = bins.withColumn("upto", F.sum("words").over(upto) + F.lit(spent))
        cut = summed.where(F.col("upto") > total).orderBy("bin").first()
        if cut is None:
            return lambda c, b=before, h=here: b(c) | h(c)
        spent = cut["upto"] - cut["words"]
        outer_before, outer_here, value = before, here, F.lit(cut["bin"])
        before = lambda c, b=outer_before, h=outer_here, f=bin_, v=value: b(c) | (h(c) & (f(c) < v))
        here = lambda c, h=outer_here, f=bin_, v=value: h(c) & (f(c) == v)
        if cut["rows"] <= LAST_ROWS or digits >= 32:
            break
        low, high = cut["low"], cut["high"]
        digits = digits + 2 if digits or low == high else 0
    last = Window.orderBy(*(f"copy.{c}" for c in ORDER)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = F.sum("copy.size").over(last) + F.lit(spent)
    end = (
        copies.where(here(F.col("copy")))
        .withColumn("running", running)
        .where(F.col("running") <= total)
        .agg(F.max("copy").alias("copy"))
        .first()["copy"]
    )
    if end is None:
        return before
    limit = F.struct(*(F.lit(end[c]).cast(copies.schema["copy"].dataType[c].dataType).alias(c) for c in ORDER))
    return lambda c: before(c) | (here(c) & (c <= limit))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    *,
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """How often the mix takes each document.

    Returns one row per row of ``docs``: doc_id, source, size (words), source_size,
    target (of its source), copies, taken (size times copies) and shuffle_key. The shuffle
    is by the MD5 of id and text, so a rerun agrees and rows without an id, or with one id,
    are dealt out like others; rows equal in both are interchangeable. Null texts have
    size 0, null sources are one source.
    Rows of size 0 are never taken. Whole documents are taken, up to the one with which
    the mix would exceed the sum of all sizes.
    """
    sizes = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            shuffle_key(F.col(doc_id), F.col(text)).alias("shuffle_key"),
        )
    )
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    queued = stored(_queues(_keyed(sizes), source_targets(sizes, weights, max_repeats), rows))
    taken = _end(queued, total, max_repeats)
    rounds = [F.coalesce(taken(_copy(k)), F.lit(False)).cast("int") for k in range(max_repeats)]
    return (
        queued.withColumn("copies", sum(rounds[1:], rounds[0]))
        .withColumn("copies", F.when(F.col("size") > 0, F.col("copies")).otherwise(0))
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"), "shuffle_key",
        )
    )
