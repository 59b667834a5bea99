"""Word expressions and stored intermediate tables that several operators share."""

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The white space that separates words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), "")


def once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row, however often later expressions name them.

    Catalyst does not merge projections, or push filters, through a generator.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select(*[c for c in frame.columns if c not in columns], F.inline(F.array(made)))


def text_key(text: Column) -> Column:
    """With doc_id, what tells rows apart. Rows equal in both are repeated rows and get equal results."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.length(text))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """`frame` written to the shared folder and read back, which cuts its lineage."""
    path = scratch_dir(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def give_back() -> None:
    """Hand what a finished task held back to the system. Python workers live on between stages, and what
    they keep for themselves is missing elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def share(frame: DataFrame, size: Column, per_task: int, least: int = 1) -> int:
    """How many tasks of `per_task` units the rows of `frame` make, by their summed sizes."""
    total = frame.agg(F.sum(size)).first()[0] or 0
    return max(least, -(-int(total) // per_task))
