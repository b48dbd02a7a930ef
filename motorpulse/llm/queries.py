"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat,
    filter_audit,
    fingerprints,
    hard_negatives,
    html_text,
    language_id,
    minhash,
    mixing,
    near_embeddings,
    quality,
    token_counts,
    topk_search,
)
from .shared import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = tokenizer_file()
    both = bpe.decode(bpe.encode(docs, path).select("doc_id", "ids"), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_near_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return near_embeddings.near_duplicates(table(spark, sf, "embeddings"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    return token_counts.count_pieces(table(spark, sf, "documents"), tokenizer_file())


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Expected grade of every document and whether it is good and clean enough to keep."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf, "labels"))
    rated = quality.rate(docs, model).drop("text")
    return rated.withColumn("kept", F.col("p_best") >= quality.KEEP_FROM)


def op6_chat(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.sql(
        "SELECT * FROM VALUES (-7L, 0, 'user', :said), (-7L, 1, 'assistant', :said)"
        " AS t(conv_id, turn, role, text)",
        {"said": said},
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat.format_chats(chat.as_messages(rows.unionByName(added)))
    learned = chat.read_learned(F.col("formatted"), F.col("learn"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    turns = F.concat_ws("", F.transform(chat.read_turns(F.col("formatted")), line))
    return chats.select(
        F.col("tree").alias("conv_id"),
        F.size(chat.read_turns(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return fingerprints.compare_with_next(docs).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.as_text(F.col("lanes")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op8_html(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


def op9_minhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return minhash.near_duplicates(docs, shingle=3, percent=85)


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = language_id.held_out(F.col("doc_id")).alias("held_out")
    learned = language_id.learn(docs.where(~held_out))
    texts = docs.select("doc_id", held_out, "text")
    return language_id.identify(texts, learned).drop("text")


def op11_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk_search.search(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, moved)


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_near_embeddings": op2_near_embeddings,
    "op3_token_counts": op3_token_counts,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_chat": op6_chat,
    "op7_fingerprints": op7_fingerprints,
    "op8_html": op8_html,
    "op9_minhash": op9_minhash,
    "op10_language": op10_language,
    "op11_topk": op11_topk,
    "op12_audit": op12_audit,
    "op13_hard_negatives": op13_hard_negatives,
}
