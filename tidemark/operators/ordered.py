"""Per-key ordering without per-key tasks.

A window over one log partition would put that partition into one task, and one
partition may hold a third of all rows. These operators cut the order axis into blocks:
the row-level window runs per (key, block), and only one row per block goes through the
per-key window. With 2**16 positions per block, a partition of 3e10 offsets becomes
groups of at most 65,536 distinct positions and a top level of about 5e5 rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 1 << 16
_BLOCK, _TAIL = "__block", "__tail"


def _block_of(order: str, block: int) -> Column:
    """The first position of the block. Whole numbers only: a quotient as a double would
    merge blocks at the top of the offset space."""
    return F.col(order) - F.col(order) % F.lit(block).cast("bigint")


def with_previous(
    df: DataFrame, keys: list[str], order: str, values: list[str], block: int = BLOCK, name: str = "previous"
) -> DataFrame:
    """`lag(struct(values)) over (partition by keys order by order)` as column `name`."""
    spread = df.withColumn(_BLOCK, _block_of(order, block))
    in_block = W.partitionBy(*keys, _BLOCK)
    row = F.struct(*values)
    inside = spread.withColumn(name, F.lag(row).over(in_block.orderBy(order))).withColumn(
        _TAIL, F.max_by(row, order).over(in_block)
    )
    # The first row of a block follows the last row of the nearest earlier block. Both
    # branches read one exchange: they differ only above the row-level windows.
    first = inside.where(F.col(name).isNull()).withColumn(
        name, F.lag(_TAIL).over(W.partitionBy(*keys).orderBy(_BLOCK))
    )
    return inside.where(F.col(name).isNotNull()).unionByName(first).drop(_BLOCK, _TAIL)


def with_position(df: DataFrame, keys: list[str], order: str, name: str, block: int = BLOCK) -> DataFrame:
    """`row_number() over (partition by keys order by order) - 1` as column `name`.

    `order` must be unique per key. Rows are counted per (key, block) before the shuffle;
    the running total of those counts is where each block starts.
    """
    spread = df.withColumn(_BLOCK, _block_of(order, block))
    counts = spread.groupBy(*keys, _BLOCK).agg(F.count(F.lit(1)).alias("__rows"))
    before = W.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*keys, _BLOCK, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    in_block = W.partitionBy(*keys, _BLOCK).orderBy(order)
    numbered = spread.withColumn("__nth", F.row_number().over(in_block))
    return (
        numbered.join(starts, [*keys, _BLOCK])
        .withColumn(name, F.col("__start") + F.col("__nth") - 1)
        .select(*df.columns, name)
    )
