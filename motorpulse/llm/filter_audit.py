"""How filters of documents interact, in every order in which they may be applied.

Which documents fail which filters is found once: four filters look at a document alone,
the fifth is an existential self-join over the table. The ids of what fails are united,
the combinations of failures are counted, and all orders are derived from those counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
#: Texts that recur in more than one in this many rows are hot, so fewer keys than this are.
HOT_KEYS = 10_000
#: Rows of a hot text that meet in a task, about.
HOT_ROWS = 4096
#: Recurring hashes that are broadcast, at most (some 16 MB); more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000

KEY = ["doc_id", "part", "hash"]


def failures(text: Column) -> Column:
    """Bits of the filters that the text fails by itself: A 1, B 2, C 4, D 8."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * F.length(text), text.rlike(MARKS)]
    bits = [F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)]
    return (bits[0] + bits[1] + bits[2] + bits[3]).cast("int")


def _texts(docs: DataFrame, again: DataFrame) -> DataFrame:
    """The documents whose hash is one of ``again``, with the number of its parts.

    A measured list is broadcast. A longer one is joined by a shuffle, except for its hot
    hashes: by their definition there are fewer than ``HOT_KEYS``, so these are broadcast.
    """
    if again.count() <= BROADCAST_KEYS:
        return docs.join(F.broadcast(again), "hash")
    hot = docs.join(F.broadcast(again.where("parts > 1")), "hash")
    return hot.unionByName(docs.join(again.where("parts = 1").hint("merge"), "hash"))


def repeated(docs: DataFrame, narrow: DataFrame) -> DataFrame:
    """The key of every document (doc_id, part, hash, text) whose text a smaller id has too.

    A left-semi join on the hash, the exact text and a smaller id. The right side holds the
    smallest id of each text, combined before its shuffle. Only texts whose hash recurs
    with different ids are moved at all. The rows of a hot text are dealt to several parts
    by id, and that text's one row of the right side is copied to each.
    """
    seen = narrow.groupBy("hash").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest")
    )
    hot = F.greatest(F.lit(HOT_ROWS), F.ceil(F.lit(narrow.count()) / HOT_KEYS))
    again = stored(
        seen.where("lowest < highest").select("hash", F.ceil(F.col("n") / hot).cast("int").alias("parts"))
    )
    texts = _texts(docs, again)
    first = texts.groupBy("hash", "parts", "text").agg(F.min("doc_id").alias("first_id"))
    first = first.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = texts.withColumn("turn", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    a, b = dealt.alias("a"), first.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("hash", "turn", "text")]
    smaller = F.col("b.first_id") < F.col("a.doc_id")
    return a.join(b, same[0] & same[1] & same[2] & smaller, "left_semi").select(*KEY)


def combinations(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the set of filters that they fail."""
    docs = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    narrow = stored(docs.select(*KEY, failures(F.col("text")).alias("bits")))
    alone = narrow.select(*KEY, "bits", F.lit(1).alias("rows"))
    copies = repeated(docs, narrow).select(*KEY, F.lit(16).alias("bits"), F.lit(0).alias("rows"))
    failed = alone.unionByName(copies).groupBy(*KEY).agg(
        F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows")
    )
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    rated = lambda c: F.sum(F.col("rows") * F.coalesce(c, F.lit(0))).alias(c)
    return (
        failed.join(known, "doc_id", "left")
        .groupBy("part", "bits")
        .agg(F.sum("rows").alias("n"), rated("good"), rated("toxic"))
    )


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it) of all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def audit(documents: DataFrame, labels: DataFrame, **names: str) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.

    Null texts are empty, a null ``lang`` is the part ''. A document fails E if a smaller id
    has its text; rows of one id do not fail by each other, and a row without an id neither
    fails E nor makes others fail. Every row is a document, also one that repeats another
    in all columns. A document is good (toxic) if any label row of its id says 1. Without
    documents there are no parts and no rows. ``names`` are those of the columns doc_id,
    text and part; other columns are not read.
    """
    counts = stored(combinations(documents, labels, **names))
    names_of = ("filter_order", "step", "bit", "before")
    one = lambda s: F.struct(*(F.lit(v).alias(c) for c, v in zip(names_of, s)))
    each = F.explode(F.array(*map(one, _steps())))
    placed = counts.withColumn("s", each).select("part", "bits", "n", "good", "toxic", "s.*")
    fails = F.col("bits").bitwiseAND(F.col("bit")) > 0
    earlier = F.col("bits").bitwiseAND(F.col("before")) > 0
    total = lambda c, v="n": F.sum(F.when(c, F.col(v)).otherwise(0)).cast("long")
    out = placed.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("bits") == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
    )
    shares = out.groupBy("part", "bit").agg(F.sum("removed").cast("long").alias("shapley"))
    return out.join(shares, ["part", "bit"]).drop("bit")
