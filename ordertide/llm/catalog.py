"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import (
    chat, decontam, hardneg, langid, packing, pcadedup, pitmanyor, secrets, simhash, spelling, topk, urlfilter, warc,
)
from ordertide.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_pitman_yor_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urlfilter.judge(pages, urlfilter.spam_list(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: A conversation whose texts are made of control strings.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    return chat.digest(chat.expand(turns.unionByName(extra)))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.contamination(docs, table(spark, sf_dir, "benchmark")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    told = langid.identify(docs, langid.learn(docs))
    return told.select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("predicted.lang").alias("lang_pred"), F.col("predicted.score").alias("score"),
    )


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pcadedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.mine(hardneg.moved_labels(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")))


def registered() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
