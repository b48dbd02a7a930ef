"""MinHash near-duplicates: universal hash minima, banding, verification, components.

Documents with equal shingle sets are one set from the start. Every set is compared with
the smallest id of each of its buckets, first by signature, then by its full shingles.
Buckets whose sets are still in different components after that are compared set by
set, in blocks of bounded size that give back only the links that tie components
together. The sets of a bucket too large for one block meet by their rarest shingles
instead, where that is less work: of any two that are alike, one has a shingle among its
rarest that is among the rarest of the other. So no bucket's pairs are ever written out,
none is left unverified, and a passage that many documents share costs as much as these
documents are long.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import components, slices, stored

#: Distinct words whose hashes a task remembers before it starts anew.
REMEMBERED_WORDS = 500_000
#: Sets of one bucket that meet in a task, and their shingles, are about this many.
BLOCK_SETS = 512
BLOCK_SHINGLES = 2_000_000
#: Bits of a shingle that name the cell in which its frequency is counted.
CELL_BITS = 16
#: Standard deviations by which a signature may fall short of the threshold.
SLACK = 5.5
UPPER_TO_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class Shingler:
    """64-bit hashes of the distinct shingles of a text, sorted.

    Words are what ASCII white space leaves, A-Z in lower case. A text with fewer words
    than a shingle has its whole sequence as one shingle, one without words has none.
    """

    def __init__(self, size: int):
        rng = random.Random(7)
        self.size = size
        self.factors = [np.uint64(rng.getrandbits(64) | 1) for _ in range(size)]
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER).split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.size:
            whole = b" ".join(words)
            return np.array([xxhash.xxh64_intdigest(whole, seed=len(words))], np.uint64)
        known = self.known
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(words) - self.size + 1
        mixed = np.zeros(n, np.uint64)
        for k, factor in enumerate(self.factors):
            mixed += hashes[k : k + n] * factor
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed.sort()
        return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


class Minima:
    """Minima of universal hashes (a * x + b) modulo 2**64, of which the high half counts."""

    def __init__(self, count: int):
        rng = random.Random(11)
        self.a = np.array([rng.getrandbits(64) | 1 for _ in range(count)], np.uint64)
        self.b = np.array([rng.getrandbits(64) for _ in range(count)], np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max)
        for k in range(0, len(shingles), 256):
            hashed = shingles[k : k + 256, None] * self.a
            hashed += self.b
            np.minimum(least, hashed.min(axis=0), out=least)
        return (least >> np.uint64(32)).astype(np.uint32)


def _keys_of_bands(signature: np.ndarray, bands: int) -> list[int]:
    rows = signature.reshape(bands, -1)
    return [
        xxhash.xxh64_intdigest(r.tobytes(), seed=k) - (1 << 63) for k, r in enumerate(rows)
    ]


#: A document's row: its id, 0 if it has none, whether it has none, and a hash of its text.
ROW = ["id", "no_id", "text_hash"]


def _row_keys(doc_id: str, text: str) -> list[Column]:
    number = F.col(doc_id).cast("long")
    return [
        F.coalesce(number, F.lit(0).cast("long")).alias("id"),
        number.isNull().alias("no_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    ]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(*ROW, text): rows that share an id are told apart by their texts."""
    return docs.select(*_row_keys(doc_id, text), F.col(text).alias("text"))


def _same(shingles: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(shingles.tobytes())


def _signed_sets(rows: DataFrame, shingle: int, bands: int, count: int) -> DataFrame:
    """(*ROW, n_shingles, same, signature, buckets); ``same`` tells equal sets."""
    schema = T.StructType.fromDDL(
        "id long, no_id boolean, text_hash long, n_shingles long, same binary, signature binary, buckets array<long>"
    )
    names = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of, minima = Shingler(shingle), Minima(bands * count)
        for batch in slices(batches, 3):
            out: list[list] = [[] for _ in names[3:]]
            for text in batch.column(3).to_pylist():
                found = shingles_of(text)
                row = [0, None, None, None]
                if len(found):
                    signature = minima(found)
                    # Half of each minimum is enough to compare: chance only adds agreement.
                    short = signature.astype(np.uint16).tobytes()
                    row = [len(found), _same(found), short, _keys_of_bands(signature, bands)]
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names)

    return rows.mapInArrow(task, schema)


def _full_sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(set_id, shingles) of rows (set_id, same, text), the shingles as packed numbers.

    A row whose text has another set than it should is left out: it shares an id and the
    hash of its text with the row that is meant.
    """
    schema = T.StructType.fromDDL("set_id long, shingles binary")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles_of = Shingler(shingle)
        for batch in slices(batches, 2):
            found = [shingles_of(t) for t in batch.column(2).to_pylist()]
            meant = [_same(s) == same for s, same in zip(found, batch.column(1).to_pylist())]
            packed = pa.array([s.tobytes() for s in found], pa.binary())
            made = pa.RecordBatch.from_arrays([batch.column(0), packed], schema.names)
            yield made.filter(pa.array(meant, pa.bool_()))

    return rows.mapInArrow(task, schema)


def _alike(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def _similar_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of (a, b, set_a, set_b) that are alike on their full sets."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a = np.frombuffer(x.as_buffer(), np.uint64)
                b = np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                keep.append(_alike(int((a[at] == b).sum()), len(a), len(b), percent))
            chosen = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            yield chosen

    return pairs.mapInArrow(task, "a long, b long")


def _ties_within(percent: int):
    """Links that tie together the components met in a block of one bucket."""

    def task(block: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        ids, group = block["set_id"].to_numpy(), block["component"].to_numpy().copy()
        if len(np.unique(group)) > 1:
            sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
            sizes = np.array(list(map(len, sets)))
            _, local = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            marked = np.zeros(local.max() + 1, np.int64)
            for k in range(len(ids)):
                if (group == group[k]).all():
                    break
                own = local[starts[k] : starts[k] + sizes[k]]
                marked[own] = 1
                common = np.add.reduceat(marked[local], starts)
                marked[own] = 0
                alike = 100 * common >= percent * (sizes + sizes[k] - common)
                for j in np.flatnonzero(alike & (group != group[k])):
                    if group[j] != group[k]:
                        found.append((ids[k], ids[j]))
                        group[group == group[j]] = group[k]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return task


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 25,
    rows: int = 5,
) -> DataFrame:
    """Near-duplicate class of every document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * common >= ``percent`` * union of their shingle sets.
    One row per row of ``docs``. Null or empty texts have no shingles and are linked with
    nothing. ``component_id`` is the smallest id reachable, ``kept`` marks the rows that
    bear it. Rows that share an id are documents of their own, each with the class of its
    text; rows without an id are linked like others, and a class of such rows alone has a
    null component (kept). A pair just at the threshold t is missed with probability
    (1 - t**rows)**bands: 4e-7 for 0.85 and 5e-5 for 0.8 by default.
    """
    found = classes(docs, doc_id, text, shingle=shingle, percent=percent, bands=bands, rows=rows)
    found = found.withColumn("doc_id", F.when(~F.col("no_id"), F.col("id")))
    return found.select("doc_id", "n_shingles", "component_id").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of every class.

    It is that of the smallest id (rows without an id come last), of several with that id
    the one of the smallest hash of the text. Documents without shingles are in no class
    and stay, but rows that are equal in id and text are one. ``how``: as in ``near_duplicates``.
    """
    found = classes(docs, doc_id, text, **how)
    own = F.struct("no_id", "id", "text_hash")
    first = found.where("group IS NOT NULL").groupBy("group").agg(F.min(own).alias("row"))
    kept = first.select("row.*").unionByName(found.where("group IS NULL").select(*ROW).distinct())
    columns = docs.columns
    places = [f"c{k}" for k in range(len(columns))]  # whatever the columns are called
    named = docs.toDF(*places)
    named = named.select("*", *_row_keys(*(places[columns.index(c)] for c in (doc_id, text))))
    # Of rows equal in id and text, the first by the other plain columns.
    plain = [F.col(p) for p, f in zip(places, docs.schema.fields) if isinstance(f.dataType, T.AtomicType)]
    whole = F.min_by(F.struct(*places), F.struct(*plain)).alias("whole")
    one = named.join(kept, ROW).groupBy(*ROW).agg(whole)
    return one.select(*(F.col("whole")[p].alias(c) for p, c in zip(places, columns)))


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 25,
    rows: int = 5,
) -> DataFrame:
    """(*ROW, n_shingles, group, component_id) of every row: ``group`` is the number of its
    class, null without shingles, ``component_id`` the smallest id of the class."""
    plain = _rows(docs, doc_id, text)
    signed = stored(_signed_sets(plain, shingle, bands, rows))
    # A set is known by its content; of the rows that have it, one brings its text.
    own = F.struct("no_id", "id", "text_hash")
    of_content = [F.any_value(c).alias(c) for c in ("n_shingles", "signature", "buckets")]
    sets = signed.where("same IS NOT NULL").groupBy("same").agg(F.min(own).alias("row"), *of_content)
    sets = stored(sets.select(F.monotonically_increasing_id().alias("set_id"), "same", "row.*", "n_shingles", "signature", "buckets"))
    signed_sets = sets.select("set_id", "n_shingles", "signature", "buckets")
    sets = sets.select("set_id", "same", *ROW)
    member = signed_sets.select("set_id", F.posexplode("buckets").alias("band", "bucket"))
    shared = member.groupBy("band", "bucket").agg(F.min("set_id").alias("first"), F.count("*").alias("n"))
    member = stored(member.join(shared.where("n > 1"), ["band", "bucket"]))

    links = _links(plain, sets, signed_sets, member, shingle, percent, bands * rows)
    tied = components(links).select(F.col("node").alias("set_id"), F.col("component").alias("group"))
    named = sets.join(tied, "set_id", "left").select(
        "same",
        F.coalesce("group", "set_id").alias("group"),
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"),
    )
    least = named.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "group").select("same", "group", "component_id")
    component = F.when(F.col("same").isNull() & ~F.col("no_id"), F.col("id")).otherwise(F.col("component_id"))
    return (
        signed.select(*ROW, "n_shingles", "same")
        .join(named, "same", "left")
        .select(*ROW, "n_shingles", "group", component.alias("component_id"))
    )


def _links(
    docs: DataFrame, sets: DataFrame, signed: DataFrame, member: DataFrame, shingle: int, percent: int, hashes: int
) -> DataFrame:
    """Links that hold every component together: (a, b)."""
    wanted = sets.join(member.select("set_id").distinct(), "set_id")
    # Rows that are equal in all of this are one; grouped as they were joined.
    texts = docs.join(wanted, ROW).groupBy(*ROW, "text").agg(F.first("set_id").alias("set_id"), F.first("same").alias("same"))
    full = stored(_full_sets(texts.select("set_id", "same", "text"), shingle))

    t = percent / 100
    least = int(np.ceil(hashes * (t - SLACK * (t * (1 - t) / hashes) ** 0.5)))
    pairs = member.where("set_id <> first").select(F.col("set_id").alias("a"), F.col("first").alias("b"))
    signature = lambda c: signed.select(F.col("set_id").alias(c), F.col("signature").alias(f"of_{c}"))
    pairs = pairs.distinct().join(signature("a"), "a").join(signature("b"), "b")
    likely = _agreeing(pairs, least)
    shingles = lambda c: full.select(F.col("set_id").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = likely.join(shingles("a"), "a").join(shingles("b"), "b").select("a", "b", "set_a", "set_b")
    stars = stored(_similar_pairs(both, percent))

    # What is left: buckets where sets of different components meet.
    classes = components(stars).withColumnRenamed("node", "set_id")
    weight = F.col("n_shingles") / BLOCK_SHINGLES + 1 / BLOCK_SETS
    placed = member.select("band", "bucket", "set_id").join(classes, "set_id", "left")
    placed = placed.join(signed.select("set_id", weight.alias("weight")), "set_id")
    placed = placed.withColumn("component", F.coalesce("component", "set_id"))
    mixed = placed.groupBy("band", "bucket").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count("*").alias("n"),
        F.ceil(F.sum("weight")).cast("int").alias("parts"),
    )
    # In a bucket of two the only pair has been compared already.
    mixed = mixed.where("low <> high AND n > 2").select("band", "bucket", "parts")
    meeting = _blocks(stored(placed.join(mixed, ["band", "bucket"])), full, percent)
    ties = meeting.groupBy("band", "bucket", "low", "high").applyInPandas(
        _ties_within(percent), "a long, b long"
    )
    tied = classes.select(F.col("set_id").alias("a"), F.col("component").alias("b"))
    return tied.unionByName(stored(ties))


def _blocks(meeting: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Sets that meet: those of (band, bucket, set_id, component, weight, parts), with their
    shingles. ``parts`` is how many blocks the weights of the bucket's sets fill.

    Every two alike sets of a bucket are in one of the blocks (band, bucket, low, high). A
    bucket that fits into a block is one. Of a larger one either every two parts meet, or its
    sets meet by their rare shingles (band -1), whichever copies fewer shingles; what is
    tied together is the same. The first grows with the square of the bucket. The second
    grows with the bucket, and is the worse where many of its sets are nearly alike.
    """
    place = ["band", "bucket"]
    crowded = meeting.where("parts > 1")
    finer = _by_rare_shingles(crowded.select("set_id", "component").distinct().join(full, "set_id"), percent)
    times = finer.groupBy("set_id").agg(F.count("*").alias("times"))
    cost = crowded.join(times, "set_id", "left").groupBy(*place).agg(
        F.sum(F.col("weight") * F.col("parts")).alias("by_parts"),
        F.sum(F.col("weight") * F.coalesce("times", F.lit(0))).alias("by_shingles"),
    )
    refined = stored(cost.where("by_shingles < by_parts").select(*place))
    whole = meeting.join(refined, place, "left_anti")
    finer = finer.join(crowded.join(refined, place).select("set_id", "weight").distinct(), "set_id")
    of_shingles = finer.groupBy(*place).agg(F.ceil(F.sum("weight")).cast("int").alias("parts"))
    meeting = whole.unionByName(finer.join(of_shingles, place))
    # Every two parts of a bucket meet in one block, a part with itself in the first.
    part = F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")
    meeting = meeting.withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    meeting = meeting.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    return meeting.select(*place, "low", "high", "set_id", "component").join(full, "set_id")


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _ranks(sets: DataFrame) -> np.ndarray:
    """Places of the cells in ascending order of the shingles in them, over all ``sets``.

    One number for each of the 2**CELL_BITS cells reaches the driver.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                counts += np.bincount(_cells(np.frombuffer(packed.as_buffer(), np.uint64)), minlength=len(counts))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["cell", "n"])

    counted = sets.select("shingles").mapInArrow(task, "cell long, n long")
    counted = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    ranks = np.empty(len(counts), np.int32)
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    return ranks


def _by_rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """Groups of sets that share one of their rare shingles: (band, bucket, set_id, component).

    All shingles are put in one order, by the rank of their cell. Two sets of which one has
    n shingles and that are alike share ``percent`` * n of them at least, so the first
    n - ceil(percent * n / 100) + 1 of each hold one that both have. This is exact whatever
    the order; one by frequency makes the groups small. Groups of one component are left
    out, and so are all but one of those with the same sets.
    """
    sets = stored(sets)
    ranks = _ranks(sets)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare, sizes = [np.empty(0, np.uint64)], []
            for packed in batch.column(2):
                own = np.frombuffer(packed.as_buffer(), np.uint64)
                first = len(own) + (-percent * len(own) // 100) + 1
                rare.append(own[np.argsort(ranks[_cells(own)], kind="stable")[:first]])
                sizes.append(len(rare[-1]))
            row = np.repeat(np.arange(batch.num_rows), sizes)
            buckets = pa.array(np.concatenate(rare).view(np.int64))
            columns = [buckets, *(batch.column(k).take(pa.array(row)) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "set_id", "component"])

    rows = sets.select("set_id", "component", "shingles").mapInArrow(
        task, "bucket long, set_id long, component long"
    )
    rows = stored(rows)
    groups = rows.groupBy("bucket").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count("*").alias("n"),
        *(F.bit_xor(F.xxhash64("set_id", F.lit(k))).alias(f"sets{k}") for k in range(2)),
    )
    groups = groups.where("low <> high").groupBy("n", "low", "high", "sets0", "sets1")
    groups = groups.agg(F.min("bucket").alias("bucket"))
    found = rows.join(groups.select("bucket"), "bucket")
    return stored(found.select(F.lit(-1).alias("band"), "bucket", "set_id", "component"))


def _agreeing(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs whose signatures agree in at least ``least`` places: (a, b)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                for k in (2, 3)
            ) if batch.num_rows else (np.empty((0, 1)),) * 2
            keep = (a == b).sum(axis=1) >= least
            yield batch.select([0, 1]).filter(pa.array(keep))

    return pairs.select("a", "b", "of_a", "of_b").mapInArrow(task, "a long, b long")
