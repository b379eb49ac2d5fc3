"""One query per text operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    decontaminate,
    embed_dedup,
    html_wrapper,
    jaccard,
    lang_id,
    line_dedup,
    merkle,
    mixing,
    passages,
    pii,
    toxicity,
    url_filter,
    whitening,
)
from tallyhouse.llm.common import read


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.main_text(read(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontaminate.decontaminate(docs, items).drop("_text")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lang_id.identify(docs, lang_id.train(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents")).drop("_text")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_embeddings(read(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read(spark, sf_dir, "documents")))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_html": op1_html,
    "op2_decontaminate": op2_decontaminate,
    "op3_language": op3_language,
    "op4_url_filter": op4_url_filter,
    "op5_passages": op5_passages,
    "op6_toxicity": op6_toxicity,
    "op7_jaccard": op7_jaccard,
    "op8_line_dedup": op8_line_dedup,
    "op9_embeddings": op9_embeddings,
    "op10_mixing": op10_mixing,
    "op11_pii": op11_pii,
    "op12_merkle": op12_merkle,
    "op13_whitening": op13_whitening,
}

SQL = {
    "op2_decontaminate": decontaminate.SQL.replace("{documents}", "documents").replace("{benchmark}", "benchmark"),
    "op8_line_dedup": line_dedup.SQL.replace("{documents}", "documents"),
}
