"""A corpus from raw documents to tokens, in stages that each write Parquet for the next.

Quality rejects documents that are not likely good and clean, language rejects those that
are in none of the languages learned, near-duplicates keep one of each class, mixing repeats
or drops documents towards the sources' targets, and the tokenizer encodes what is left.
"""

from __future__ import annotations

from itertools import count
from os import getpid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpulse.files import delete
from motorpulse.llm import bpe, language_id, minhash, mixing, quality
from motorpulse.llm.queries import tokenizer_file
from motorpulse.llm.shared import stored, table
from motorpulse.session import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_runs = count()


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best grade (good and clean) is likely, by a model of the ratings."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    rated = quality.rate(docs.select(*COLUMNS), model)
    return rated.where(F.col("p_best") >= quality.KEEP_FROM).select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned: rejected are those whose score is below
    what documents of the language and of their size have, and texts without a letter.

    Every document is scored once; all these scores set the limits."""
    learned = language_id.learn(docs)
    named = stored(language_id.sized(language_id.identify(docs.select(*COLUMNS), learned)))
    least = language_id.limits(named, learned)
    return named.where(language_id.in_language(least)).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class: five-word shingles, similarity 0.8.

    Rows that share an id, or have none, are documents by their texts: see ``one_of_each``.
    """
    return minhash.one_of_each(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows equal in id and text are one, as
    often as they are taken together."""
    key = mixing.shuffle_key(F.col("doc_id"), F.col("text")).alias("shuffle_key")
    taken = mixing.mix(docs).groupBy("shuffle_key").agg(F.sum("copies").alias("copies"))
    one = docs.select(*COLUMNS, key).dropDuplicates(["shuffle_key"])
    copies = F.sequence(F.lit(1).cast("long"), "copies")
    repeated = one.join(taken.where("copies > 0"), "shuffle_key")
    return repeated.withColumn("copy", F.explode(copies)).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document: doc_id, lang, source, n_tokens, ids."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_file())
    n_tokens = F.size("ids").cast("long").alias("n_tokens")
    return encoded.select("doc_id", "lang", "source", n_tokens, "ids")


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding", token_stage),
]

#: Models, components and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/corpus-{spark.sparkContext.applicationId}-{getpid()}-{next(_runs)}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            delete(spark, f"{folder}/{k - 1}")  # read by no later stage
    return docs
