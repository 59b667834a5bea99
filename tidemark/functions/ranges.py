"""Column arithmetic on fixed, aligned offset ranges."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_OFFSET = (1 << 63) - 1


def check_width(width: int) -> int:
    if not isinstance(width, int) or isinstance(width, bool) or width < 1:
        raise ValueError(f"range width must be a positive integer, got {width!r}")
    return width


def range_start(offset: Column, width: int) -> Column:
    check_width(width)
    return offset - offset % F.lit(width).cast("bigint")


def range_end(start: Column, width: int) -> Column:
    """Last offset of the range; clamped at the top so that it cannot overflow."""
    reach = check_width(width) - 1
    return F.when(start > F.lit(MAX_OFFSET - reach), F.lit(MAX_OFFSET)).otherwise(
        start + F.lit(reach).cast("bigint")
    )


def in_range(offset: Column, start: Column, end: Column) -> Column:
    return offset.between(start, end)


def is_complete(last_offset: Column, end: Column) -> Column:
    return last_offset >= end


def commit_offset(end: Column) -> Column:
    """The next offset to read once the range is durable."""
    return end + F.lit(1).cast("bigint")


def width_of(start: Column, end: Column) -> Column:
    """Offsets spanned, which is not a row count: offsets may have holes."""
    return end - start + F.lit(1).cast("bigint")


def object_name(topic: Column, partition: Column, date: Column, start: Column, end: Column) -> Column:
    """The name of a range's object: a function of its keys, never of its rows."""
    return F.concat(
        topic,
        F.lit("/dt="),
        date,
        F.lit("/"),
        F.concat_ws("-", partition.cast("string"), start.cast("string"), end.cast("string")),
        F.lit(".parquet"),
    )
