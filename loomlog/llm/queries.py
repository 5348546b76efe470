"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, embedding, html, langid, lm, packing, quality, simhash, suffix
from .common import crc_mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embedding_links(table(spark, sf_dir, "embeddings"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql("select -1L conv_id, t.turn, t.role, '</s>[INST] ok [/INST]' text from values (0L, 'user'), (1L, 'assistant') t(turn, role)")
    return chat.digests(turns.unionByName(control))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "n_tokens", "perplexity", "threshold", "contrast", "limit", "kept")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    found = langid.predict_languages(docs, docs.where(~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_html_extraction, op3_suffix_dedup, op4_decontamination, op5_chat_formatting, op6_lm_scoring, op7_quality_classifier, op8_simhash_dedup, op9_language_id, op10_best_fit_packing)}

SQL: dict[str, str] = {"op1_embedding_dedup": embedding.SQL, "op3_suffix_dedup": suffix.SQL, "op4_decontamination": decontaminate.SQL, "op5_chat_formatting": chat.SQL}
