"""Document fingerprints by a homomorphic multiset hash.

A document is the multiset of its paragraphs, long ones cut at sentence ends. Every
piece is hashed to a wide vector of zeros and ones; the fingerprint is the sum of the
vectors, lane by lane, modulo 2**24, with the number of pieces as its last lane. It does
not depend on the order of the pieces, equal multisets have equal fingerprints, and
pieces are added to it or taken out of it without the rest of the text. Around its mean
the vector is also a sketch: the cosine of two documents' vectors estimates the cosine
of their piece counts. DataFrame functions only.
"""

from __future__ import annotations

import bisect
import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Ends of pieces: line feeds, and white space after a sentence's end.
PIECE_END = r"\n|(?<=[.!?])\s+"
#: Words of 32 bits taken from a piece's MD5; every bit is a lane.
WORDS = 4
LANES = 32 * WORDS
MODULUS = 1 << 24
#: Rows of a bin of ascending ids, about; each bin is one window partition.
BIN_ROWS = 256
#: Bins of a table, at most; beyond ``BIN_ROWS`` times as many rows, bins get larger.
MAX_BINS = 1 << 16


def pieces(text: Column) -> Column:
    """Pieces of a text, without spaces around them and without empty ones; null has none."""
    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), PIECE_END), lambda p: F.trim(p))
    return F.filter(trimmed, lambda p: p != "")


def _hash_words(piece: Column) -> list[Column]:
    """The MD5 in words, whose bits i and i+16 are laid 32 bits apart."""
    digest = F.md5(piece.cast("binary"))
    words = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(WORDS)]
    return [
        w.bitwiseAND(F.lit(0xFFFF)).bitwiseOR(F.shiftleft(F.shiftright(w, 16), 32)).alias(f"w{k}")
        for k, w in enumerate(words)
    ]


def _lane_sums() -> list[Column]:
    """Sums of two lanes each; one cannot run into the other below 2**31 pieces."""
    pair = F.lit(1 | 1 << 32)
    return [
        F.sum(F.shiftright(F.col(f"w{k}"), i).bitwiseAND(pair)).alias(f"s{k}_{i}")
        for k in range(WORDS)
        for i in range(16)
    ]


def _lanes() -> Column:
    sums = [F.coalesce(F.col(f"s{k}_{i}"), F.lit(0)) for k in range(WORDS) for i in range(16)]
    low = [s.bitwiseAND(F.lit(0x7FFFFFFF)) for s in sums]
    high = [F.shiftright(s, 32) for s in sums]
    return F.transform(F.array(*low, *high, F.col("n_pieces")), lambda x: F.pmod(x, F.lit(MODULUS)))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Fingerprint of every text: the ``keys`` and ``lanes``, an array of longs.

    Rows with equal keys are added up: that is how a stream of insertions is folded in.
    A text without pieces (null, empty, white space) has the zero vector.
    """
    rows = texts.select(*keys, F.explode_outer(pieces(F.col(text))).alias("piece"))
    rows = rows.select(*keys, "piece", *_hash_words(F.col("piece")))
    summed = rows.groupBy(*keys).agg(F.count("piece").alias("n_pieces"), *_lane_sums())
    return summed.select(*keys, _lanes().alias("lanes"))


def insert(lanes: Column, more: Column) -> Column:
    """Fingerprint of both multisets together."""
    return F.zip_with(lanes, more, lambda a, b: F.pmod(a + b, F.lit(MODULUS)))


def delete(lanes: Column, gone: Column) -> Column:
    """Fingerprint of what is left without the pieces of ``gone``."""
    return F.zip_with(lanes, gone, lambda a, b: F.pmod(a - b, F.lit(MODULUS)))


def as_text(lanes: Column) -> Column:
    """Six hexadecimal digits a lane."""
    return F.concat_ws("", F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")))


def _centered(lanes: Column) -> Column:
    n = F.element_at(lanes, -1)
    return F.transform(F.slice(lanes, 1, LANES), lambda x: (2 * x - n).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(lanes: Column, other: Column) -> Column:
    """Estimated cosine of two multisets, from 0 to 1; 1 exactly for equal fingerprints."""
    a, b = _centered(lanes), _centered(other)
    norms = F.sqrt(_dot(a, a) * _dot(b, b))
    cosine = F.when(norms > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), _dot(a, b) / norms)))
    return F.when(lanes == other, 1.0).otherwise(F.coalesce(cosine, F.lit(0.0)))


def _literal(values: list[int]) -> Column:
    """The numbers as one constant, however many they are."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _stretch(doc_id: Column, edges: list[int]) -> Column:
    """How many edges are not above an id, found among every so manyth edge first."""
    step = math.isqrt(len(edges)) + 1
    below = lambda e: e <= doc_id
    block = F.greatest(F.size(F.filter(_literal(edges[::step]), below)) - 1, F.lit(0)) * step
    return block + F.size(F.filter(F.slice(_literal(edges), block + 1, F.lit(step)), below))


def _binned(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, bool]:
    """Rows with the bin they belong to, and whether some id's rows are cut into parts.

    Returns doc_id, text, digest, part_count and bin; bins ascend with (id, MD5 of the
    text). What reaches the driver are the edges and the ids that have more rows than a
    bin should: no more than ``MAX_BINS`` of each.
    """
    ids = docs.select(F.col(doc_id).alias("doc_id"))
    n_rows, n_ids = ids.agg(F.count("*"), F.count("doc_id")).first()
    limit = max(BIN_ROWS, -(-n_rows // MAX_BINS))
    n_bins = max(1, n_ids // limit)
    found = ids.approxQuantile("doc_id", [k / n_bins for k in range(1, n_bins)], 0.2 / n_bins) if n_bins > 1 else []
    often = ids.where("doc_id IS NOT NULL").groupBy("doc_id").count().where(F.col("count") > limit).collect()
    edges = {int(e) for e in found} | {r["doc_id"] + k for r in often for k in (0, 1)}
    edges = sorted(e for e in edges if e < 1 << 63)
    parts = [1] * (len(edges) + 2)
    for r in often:
        parts[bisect.bisect_right(edges, r["doc_id"])] = -(-r["count"] // limit)
    parts[-1] = max(1, -(-(n_rows - n_ids) // limit))
    firsts = [sum_ - n for sum_, n in zip(itertools.accumulate(parts), parts)]
    stretch = F.when(F.col("doc_id").isNull(), F.lit(len(edges) + 1)).otherwise(_stretch(F.col("doc_id"), edges))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("stretch", stretch)
    crowded = max(parts) > 1
    digest = F.when(F.col("part_count") > 1, F.md5("text")).otherwise("") if crowded else F.lit("")
    rows = rows.withColumn("part_count", F.element_at(_literal(parts), F.col("stretch") + 1) if crowded else F.lit(1))
    rows = rows.withColumn("digest", digest)
    start = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.col("part_count")
    part = F.when(F.col("part_count") > 1, F.shiftright(start, 32)).otherwise(0)
    bin_ = F.element_at(_literal(firsts), F.col("stretch") + 1) + (part if crowded else F.lit(0))
    return rows.withColumn("bin", bin_).drop("stretch"), crowded


def with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Every document with the text of the next one in ascending order of ids.

    Returns bin, place (in its bin), guest, doc_id, text, next_text, copies; after the last
    document comes the first. Null texts are empty, null ids come last, equal ids in the
    order of the MD5 of their texts. Ids are cut into bins of about ``BIN_ROWS`` rows at
    approximate quantiles, and an id that has more of them, or the rows without one, by the
    MD5. There, rows equal in id and text are two rows at most: the last, and one with the
    number of the others, whose next is an equal row (``copies``; 1 elsewhere). Each bin is
    one window; the first document of every bin is also put, as a guest, behind the bin
    before.
    """
    rows, crowded = _binned(docs, doc_id, text)
    if crowded:
        keys = ["bin", "doc_id", "digest", "text"]
        many = rows.where("part_count > 1").groupBy(*keys).agg(F.count("*").alias("n"))
        two = F.when(F.col("n") > 1, F.array(F.col("n") - 1, F.lit(1).cast("long"))).otherwise(F.array("n"))
        many = stored(many.select(*keys, F.explode(two).alias("copies")))
        few = rows.where("part_count = 1").select(*keys, F.lit(1).cast("long").alias("copies"))
        rows = few.unionByName(many)
    else:
        rows = rows.drop("part_count").withColumn("copies", F.lit(1).cast("long"))
    rows = rows.withColumn("guest", F.lit(False))
    rows = rows.unionByName(_guests(rows))
    order = ["guest", F.asc_nulls_last("doc_id"), F.md5("text"), "text", F.desc("copies")]
    place = Window.partitionBy("bin").orderBy(*order)
    return rows.select(
        "bin",
        F.row_number().over(place).alias("place"),
        "guest",
        "doc_id",
        "text",
        F.lead("text").over(place).alias("next_text"),
        "copies",
    )


def _guests(rows: DataFrame) -> DataFrame:
    """The first document of every bin, in the bin before it; of the first, in the last.

    The table of bins that is broadcast has a row for each bin in use, 4 * ``MAX_BINS`` at most.
    """
    firsts = rows.groupBy("bin").agg(F.min("doc_id").alias("first_id"), F.min("digest").alias("first_digest"))
    last = F.max("bin").over(Window.partitionBy())
    before = F.coalesce(F.lag("bin").over(Window.orderBy("bin")), last)
    firsts = firsts.select(F.col("bin").alias("first_bin"), "first_id", "first_digest", before.alias("before"))
    here = (
        (F.col("bin") == F.col("first_bin"))
        & F.col("doc_id").eqNullSafe(F.col("first_id"))
        & (F.col("digest") == F.col("first_digest"))
    )
    found = rows.join(F.broadcast(firsts), here).groupBy("before", "doc_id", "digest")
    found = found.agg(F.min(F.struct(F.md5("text").alias("order"), "text")).alias("least"))
    return found.select(
        F.col("before").alias("bin"),
        "doc_id",
        "digest",
        F.col("least.text").alias("text"),
        F.lit(1).cast("long").alias("copies"),
        F.lit(True).alias("guest"),
    )


def _repeated(rows: DataFrame, copies: str) -> DataFrame:
    """Every row as often as its number of copies says, which is dropped."""
    n, block = F.col(copies), 1 << 16
    rows = rows.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(block).cast("long"))))
    here = F.array_repeat(F.lit(0), F.least(n - F.col("_from"), F.lit(block)).cast("int"))
    return rows.withColumn("_from", F.explode(here)).drop("_from", copies)


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half replaced by as much of the next one's beginning."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and their likeness.

    Returns one row per row of ``docs``: doc_id, n_chars, edited_sha256, lanes,
    edited_lanes, near_edited, near_next. One shuffle, by bins of ids, serves the order,
    the sums and the comparison with the next document. An empty table gives no rows.
    """
    rows = with_next(docs, doc_id, text)
    change = edited(F.col("text"), F.col("next_text"))
    rows = rows.withColumn("change", F.when(~F.col("guest"), change))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited_sha256", F.sha2("change", 256))
    keys = ["bin", "place", "guest", "doc_id", "copies", "n_chars", "edited_sha256", "version"]
    both = F.posexplode(F.array("text", "change")).alias("version", "wording")
    texts = rows.select(*keys[:-1], both).where("NOT guest OR version = 0")
    order = Window.partitionBy("bin").orderBy("place", "version")
    lined = fingerprints(texts, keys, "wording").withColumns(
        {"edited_lanes": F.lead("lanes", 1).over(order), "next_lanes": F.lead("lanes", 2).over(order)}
    )
    return _repeated(lined.where("NOT guest AND version = 0"), "copies").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "lanes",
        "edited_lanes",
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )
