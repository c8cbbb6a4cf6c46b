"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sondaflow.llm import chat, dedup, divergence, kneser, langid, mixing, packing, ppm, quality, secrets, simhash, vafile, whitening

WORD_TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _remainder(id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(id).cast("string")) % by


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(WORD_TOKENIZER)


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.near_duplicates(_table(spark, folder, "documents"), words=4).drop("text_hash")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(_table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.length("clean_text").cast("long").alias("clean_chars"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.with_digests(packing.packed(_table(spark, folder, "documents"), tokenizer_path()))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents, _ = mixing.mixed(_table(spark, folder, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.with_spans(_table(spark, folder, "documents").select("doc_id", "text"))
    entropy = secrets.KINDS.index("entropy")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != entropy)
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op6_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    trusted = _table(spark, folder, "labels").filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias("id"))
    return kneser.judged(_table(spark, folder, "documents"), trusted)


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    model = langid.learn(docs.filter(~held_out))
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op8_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.scored(_table(spark, folder, "documents"), _remainder("doc_id", 5) == 1).withColumnRenamed("id", "doc_id")


def op9_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return vafile.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.read_back(chat.format_conversations(rows.unionByName(planted))))


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audited(_table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(_table(spark, folder, "embeddings"))


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_mixing": op4_mixing,
    "op5_secrets": op5_secrets,
    "op6_perplexity": op6_perplexity,
    "op7_language": op7_language,
    "op8_language_model": op8_language_model,
    "op9_top_k": op9_top_k,
    "op10_chat": op10_chat,
    "op11_source_divergence": op11_source_divergence,
    "op12_whitening": op12_whitening,
    "op13_simhash": op13_simhash,
}
