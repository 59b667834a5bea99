"""The registered queries of this subpackage: each operator over its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    backoff_model,
    decontaminate,
    embedding_dedup,
    lexical_search,
    licenses,
    merkle,
    mixing,
    pii,
    quality_rules,
    simhash,
    url_filters,
    warc,
    weak_labels,
)
from tidemark.llm.common import read


def op1_backoff_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_model.score_texts(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents", "doc_id", "text")).drop("broken")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(read(spark, sf_dir, "pages", "page_id", "url"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_labels.judge(read(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.select("doc_id", "quality", "kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.judge(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", *merkle.FIELDS)
    return merkle.manifest(docs, tampered=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return lexical_search.rank(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES = {
    "op1_backoff_model": op1_backoff_model,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash": op3_simhash,
    "op4_url_filters": op4_url_filters,
    "op5_warc_index": op5_warc_index,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_decontamination": op7_decontamination,
    "op8_pii": op8_pii,
    "op9_mixing": op9_mixing,
    "op10_license_scan": op10_license_scan,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_lexical_search": op12_lexical_search,
    "op13_embedding_dedup": op13_embedding_dedup,
    "pipeline": corpus_pipeline.run,
}
