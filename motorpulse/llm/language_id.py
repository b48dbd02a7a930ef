"""Language identification by hyperdimensional profiles.

Every letter has a random vector of plus and minus ones. An n-gram is the product of its
letters' vectors, each permuted (rotated) by its place; a text is the sum of its n-grams'
vectors, a language the sum of its texts. A text is given the language whose vector has
the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_batches, quoted, slices

GRAM = 3
DIMENSIONS = 1024
#: A text is in no language below twice the deviation of a random vector's cosine ...
LEAST_SCORE = 2 / DIMENSIONS**0.5
#: ... and below this share of the median of its language's documents of its size.
LEAST_SHARE = 0.5
#: Sizes, powers of two, and the documents that a median needs at least.
SIZES = 24
LEAST_DOCS = 5
#: n-grams whose vectors a task remembers before it starts anew.
REMEMBERED_GRAMS = 30_000
UNKNOWN = "und"
SPACE = 32


def letter_table() -> np.ndarray:
    """Lower-case letter of every code point; 32, a space, for what is no letter."""
    table = np.full(0x110000, SPACE, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def grams_of(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, packed, and their counts; none without a letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.full(len(codes) + 2, SPACE, np.int64)
    letters[1:-1] = table[codes]
    blank = letters == SPACE
    blank[1:] &= blank[:-1]
    blank[0] = False
    letters = letters[~blank]
    if len(letters) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    n = len(letters) - GRAM + 1
    packed = np.zeros(n, np.int64)
    for k in range(GRAM):
        packed = packed << 21 | letters[k : k + n]
    packed.sort()
    first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    return packed[first], np.diff(np.append(first, n))


class GramVectors:
    """Vectors of n-grams, made when first asked for."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.empty((1024, DIMENSIONS), np.float32)

    def _letter(self, code: int, place: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng([17, code]).integers(0, 2, DIMENSIONS, np.int8)
            self.letters[code] = bits * 2 - 1
        return np.roll(self.letters[code], place)

    def _learn(self, gram: int) -> int:
        vector = np.ones(DIMENSIONS, np.int8)
        for place in range(GRAM):
            vector *= self._letter(gram >> 21 * place & 0x1FFFFF, place)
        row = self.rows[gram] = len(self.rows)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        self.table[row] = vector
        return row

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' vectors, each as often as it occurs; exact below 2**24."""
        total = np.zeros(DIMENSIONS)
        for k in range(0, len(grams), 4096):
            if len(self.rows) > REMEMBERED_GRAMS:
                self.rows.clear()
                self.letters.clear()
            part = grams[k : k + 4096].tolist()
            known = self.rows.get
            rows = [r if (r := known(g)) is not None else self._learn(g) for g in part]
            total += counts[k : k + 4096].astype(np.float32) @ self.table[rows]
        return np.rint(total)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[int]]:
    """Vector of every language of ``docs``; rows without text or language teach nothing.

    Each task adds up its n-grams by language and bundles them once; the driver gets one
    vector per language. Sums of whole numbers, so the order of tasks changes nothing.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    letters = docs.sparkSession.sparkContext.broadcast(letter_table())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = GramVectors()
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, 0):
            of_lang: dict[str, list[str]] = {}
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                of_lang.setdefault(name, []).append(t)
            for name, texts in of_lang.items():
                found = grams_of("\n".join(texts), letters.value)
                exact = _exact_bundle(vectors, *found)
                sums[name] = sums[name] + exact if name in sums else exact
        if sums:
            vectors_column = pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), vectors_column], ["lang", "vector"])

    taught = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    parts = taught.mapInArrow(task, "lang string, vector array<long>")
    places = parts.select("lang", F.posexplode("vector").alias("place", "value"))
    sums = places.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    order = F.sort_array(F.collect_list(F.struct("place", "value")))
    wide = sums.groupBy("lang").agg(F.transform(order, lambda s: s["value"]).alias("vector"))
    return {r["lang"]: r["vector"] for r in wide.collect()}


def _exact_bundle(vectors: GramVectors, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bundle in whole numbers, whatever the counts: low and high digits apart."""
    low = vectors.bundle(grams, counts % 1024)
    high = vectors.bundle(grams, counts // 1024)
    return low.astype(np.int64) + 1024 * high.astype(np.int64)


def identify(
    docs: DataFrame, languages: dict[str, list[int]], text: str = "text"
) -> DataFrame:
    """``docs`` with the columns lang_pred and score (cosine, 0 to 1) at the end.

    ``und`` with score 0 for a null text, one without any letter, and if no language was
    learned; of equal cosines the first language by name wins. Columns of these two names
    are replaced. A text's vector is compared whole, however long it is.
    """
    names = sorted(languages)
    matrix = np.array([languages[n] for n in names], float).reshape(len(names), DIMENSIONS)
    norms = np.sqrt((matrix**2).sum(axis=1, keepdims=True))
    matrix = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
    context = docs.sparkSession.sparkContext
    model, letters = context.broadcast((names, matrix)), context.broadcast(letter_table())
    docs = docs.select(*(quoted(c) for c in docs.columns if c not in ("lang_pred", "score") or c == text))
    position = docs.columns.index(text)
    keep = [k for k, c in enumerate(docs.columns) if c not in ("lang_pred", "score")]
    fields = [docs.schema.fields[k] for k in keep]
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*fields, *made])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = model.value
        vectors = GramVectors()
        for batch in slices(batches, position):
            found, scores = [], []
            for t in batch.column(position).to_pylist():
                grams, counts = grams_of(t, letters.value) if t else ((), ())
                if not len(grams) or not names:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                own = vectors.bundle(grams, counts)
                norm = np.sqrt(own @ own)
                cosines = matrix @ own / norm if norm else np.zeros(len(names))
                best = int(np.argmax(cosines))
                found.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            columns = [batch.column(k) for k in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                schema.names,
            )

    return map_batches(docs, task, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _size(text: Column) -> Column:
    """Power of two of the letters in a text's different words: 0 to ``SIZES`` - 1."""
    words = F.array_distinct(F.split(F.lower(text), r"\P{L}+"))
    letters = F.greatest(F.length(F.array_join(words, "")), F.lit(1))
    return F.least(F.floor(F.log2(letters)), F.lit(SIZES - 1)).cast("int")


def sized(named: DataFrame, text: str = "text") -> DataFrame:
    """Rows that ``identify`` named, with the column text_size that limits go by."""
    return named.withColumn("text_size", _size(F.col(text)))


def limits(named: DataFrame, languages: dict[str, list[int]], lang: str = "lang") -> dict[str, list[float]]:
    """Least score of a text in every language, for every size, from the scores of all
    rows of ``sized`` that were given their own language.

    ``LEAST_SHARE`` of the median, that of all languages where one has too few documents
    of a size, and that of a smaller size where all have; below the least such size it
    falls with the root of the letters. Never less than ``LEAST_SCORE``. The median is that
    of every score to four digits, of which there are few, so it is exact at any size.
    """
    scored = named.where(F.col("lang_pred") == F.col(lang)).select(F.col(lang).alias("lang"), F.col("text_size").alias("size"), "score")
    median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY round(score, 4))").alias("median")
    counted = scored.rollup("size", "lang").agg(F.count("*").alias("n"), median).where("size IS NOT NULL")
    known = {(r["lang"], r["size"]): r["median"] for r in counted.collect() if r["n"] >= LEAST_DOCS}
    made = {}
    for name in sorted(languages):
        own = [known.get((name, k), known.get((None, k))) for k in range(SIZES)]
        first = next((k for k in range(SIZES) if own[k] is not None), None)
        for k in range(SIZES):
            if own[k] is None and first is not None:
                own[k] = own[k - 1] if k > first else own[first] * 2 ** ((k - first) / 2)
        made[name] = [max(LEAST_SCORE, LEAST_SHARE * (m or 0.0)) for m in own]
    return made


def in_language(least: dict[str, list[float]]) -> Column:
    """Whether a row of ``sized`` is in the language it was given, by ``limits``."""
    if not least:
        return F.lit(False)
    of_lang = F.create_map(*(c for n, v in least.items() for c in (F.lit(n), F.array(*map(F.lit, v)))))
    limit = of_lang[F.col("lang_pred")][F.col("text_size")]
    return F.coalesce(F.col("score") >= limit, F.lit(False))
