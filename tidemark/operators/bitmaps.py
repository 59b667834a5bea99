"""Offsets as bitmaps: a bit per offset, in blocks of 32,768.

A block of a partition is one row of 4,096 bytes however many offsets it holds, so audits that
compare which offsets are where exchange an eighth of a byte per offset instead of a row. The
bits are looked at only in blocks where the bytes say there is something to see.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.ranges import positions
from tidemark.schema import PARTITION_KEYS, PROVENANCE

BLOCK_BITS = 15
BLOCK = 1 << BLOCK_BITS
BLOCK_KEYS = [*PARTITION_KEYS, "bucket"]


def block_of(offset: str) -> Column:
    return F.shiftright(F.col(offset), BLOCK_BITS)


def position_of(offset: str) -> Column:
    return F.col(offset).bitwiseAND(F.lit(BLOCK - 1).cast("bigint"))


def offset_bitmaps(rows: DataFrame, *copy: str) -> DataFrame:
    """`kafka_topic, kafka_partition, bucket, *copy, bits`: the offsets of `rows`, and of each copy of
    them apart if rows are copies that differ in `copy`. Built before the shuffle."""
    return rows.groupBy(*PARTITION_KEYS, block_of("kafka_offset").alias("bucket"), *copy).agg(
        F.bitmap_construct_agg(position_of("kafka_offset")).alias("bits")
    )


def entry_bitmaps(entries: DataFrame) -> DataFrame:
    """The offsets that the manifest says are staged: its entries keep them, and no row is read."""
    blocks = entries.select(
        F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), F.inline("offsets")
    )
    return blocks.groupBy(*BLOCK_KEYS).agg(F.bitmap_or_agg("bits").alias("bits"))


def _set_bits(bits: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


def _per_block(
    blocks: DataFrame, columns: list[str], of: Callable[..., Iterator[tuple]], fields: str
) -> DataFrame:
    """A row per tuple that `of` yields for a block's `columns`, with the keys of the block."""
    names = [field.split()[0] for field in fields.split(", ")]
    keys = [f"{name} {blocks.schema[name].dataType.simpleString()}" for name in PARTITION_KEYS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = [], []
            for place, (bucket, *values) in enumerate(zip(*[batch.column(c).to_pylist() for c in ["bucket", *columns]], strict=True)):
                rows = list(of(bucket << BLOCK_BITS, *values))
                places += [place] * len(rows)
                found += rows
            held = [batch.column(c).take(pa.array(places, pa.int64())) for c in PARTITION_KEYS]
            made = list(zip(*found, strict=True)) or [[] for _ in names]
            kinds = [pa.string() if field.endswith("string") else pa.int64() for field in fields.split(", ")]
            arrays = [*held, *[pa.array(m, k) for m, k in zip(made, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*PARTITION_KEYS, *names])

    return blocks.select(*BLOCK_KEYS, *columns).mapInArrow(run, ", ".join([*keys, fields]))


def _runs(first: int, bits: bytes) -> Iterator[tuple]:
    """Runs of offsets missing between two set ones, and the first and last set one as a run that ends before it begins."""
    present = _set_bits(bits)
    if not len(present):
        return
    yield first + int(present[0]), first + int(present[-1]), 1
    steps = np.flatnonzero(np.diff(present) > 1)
    for at in steps.tolist():
        yield first + int(present[at]) + 1, first + int(present[at + 1]) - 1, 0


def missing_runs(bitmaps: DataFrame) -> DataFrame:
    """Runs of offsets missing between two present ones of a partition.

    Runs inside a block come from its bits; between blocks, only one row per block is looked at.
    """
    runs = _per_block(bitmaps, ["bits"], _runs, "gap_start bigint, gap_end bigint, ends bigint")
    inside = runs.where("ends = 0").select(*PARTITION_KEYS, "gap_start", "gap_end")
    before = F.lag("gap_end").over(W.partitionBy(*PARTITION_KEYS).orderBy("gap_start"))
    between = (
        runs.where("ends = 1")
        .select(*PARTITION_KEYS, (before + 1).alias("start"), (F.col("gap_start") - 1).alias("gap_end"))
        .where("start <= gap_end")
        .withColumnRenamed("start", "gap_start")
    )
    return inside.unionByName(between).withColumn("missing", F.col("gap_end") - F.col("gap_start") + 1)


def _sides(log: DataFrame, staged: DataFrame) -> DataFrame:
    """Both bitmaps of every block; a side without the block has no bit set. One shuffle of blocks."""
    both = log.select(*BLOCK_KEYS, F.col("bits").alias("log"), F.lit(None).cast("binary").alias("staged")).unionByName(
        staged.select(*BLOCK_KEYS, F.lit(None).cast("binary").alias("log"), F.col("bits").alias("staged"))
    )
    return both.groupBy(*BLOCK_KEYS).agg(F.bitmap_or_agg("log").alias("log"), F.bitmap_or_agg("staged").alias("staged"))


def _one_sided(first: int, log: bytes, staged: bytes) -> Iterator[tuple]:
    a, b = (np.frombuffer(side, np.uint8) for side in (log, staged))
    for side, bits in (("log_only", a & ~b), ("staging_only", b & ~a)):
        yield from ((first + int(at), side) for at in np.flatnonzero(np.unpackbits(bits, bitorder="little")))


def differences(log: DataFrame, staged: DataFrame) -> DataFrame:
    """Offsets on one side only, of the bitmaps of both."""
    unequal = _sides(log, staged).where("log <> staged")
    return _per_block(unequal, ["log", "staged"], _one_sided, "kafka_offset bigint, side string")


def unsafe_commits(log: DataFrame, staged: DataFrame, frontier: DataFrame) -> DataFrame:
    """Offsets of the log below the committed offset that were never staged, of the bitmaps of both.

    Blocks beyond the frontier are left out before their bits are looked at.
    """
    committed = positions(frontier.where("commit_offset IS NOT NULL"))
    below = _sides(log, staged).where("log <> staged").join(committed, PARTITION_KEYS)
    below = below.where(F.shiftleft("bucket", BLOCK_BITS) < F.col("commit_offset"))

    def missing(first: int, log: bytes, staged: bytes, commit: int) -> Iterator[tuple]:
        yield from ((offset,) for offset, side in _one_sided(first, log, staged) if side == "log_only" and offset < commit)

    return _per_block(below, ["log", "staged", "commit_offset"], missing, "kafka_offset bigint").select(*PROVENANCE)


def _repeats(first: int, copies: list[bytes]) -> Iterator[tuple]:
    times = np.zeros(BLOCK, np.int64)
    for bits in copies:
        times += np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
    yield from ((first + int(at), int(times[at])) for at in np.flatnonzero(times > 1))


def repeated(bitmaps: DataFrame) -> DataFrame:
    """Offsets that more than one copy holds, of bitmaps with a row per block and copy.

    Blocks whose copies have no offset in common have as many bits in all as in their union.
    """
    blocks = bitmaps.groupBy(*BLOCK_KEYS).agg(
        F.collect_list("bits").alias("copies"),
        F.sum(F.bitmap_count("bits")).alias("held"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("distinct"),
    )
    return _per_block(blocks.where("held > distinct"), ["copies"], _repeats, "kafka_offset bigint, copies bigint")
