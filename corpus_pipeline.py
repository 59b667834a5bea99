"""The training-data pipeline: documents in, a mixture of clean documents out.

Each stage works on all that its predecessor kept; what lies between two stages is a Parquet
table in the shared folder.
"""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, pii, simhash, weak_labels
from tidemark.llm.common import DOCUMENT_COLUMNS, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return weak_labels.judge(docs.select(*DOCUMENT_COLUMNS)).filter("kept").select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.one_per_class(docs.select(*DOCUMENT_COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs.select(*DOCUMENT_COLUMNS), benchmark)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs.select(*DOCUMENT_COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per use of a document in the mixture of sources."""
    return mixing.mix(docs.select(*DOCUMENT_COLUMNS))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
]

# The classifier is trained and fingerprints are hashed outside SQL: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
