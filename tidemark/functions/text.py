"""Small text, time and nullability expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import REASON_LIMIT

RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def rfc3339(text: Column) -> Column:
    """RFC3339 text as an instant; anything else is NULL.

    A bare cast also takes dates, times without an offset and zone names, hence the
    pattern; it rejects lower-case `t` and `z`, hence the upper-casing.
    """
    return F.when(text.rlike(RFC3339), F.upper(text).try_cast("timestamp"))


def truncate_reason(reason: Column) -> Column:
    """At most `REASON_LIMIT` bytes of text, cut between characters, then an ellipsis."""
    raw = reason.cast("binary")
    # A character has at most four bytes, so one of four cuts falls between characters.
    cuts = [F.substring(raw, F.lit(1), F.lit(REASON_LIMIT - n)).cast("string") for n in range(4)]
    whole = F.coalesce(*[F.try_validate_utf8(cut) for cut in cuts])
    return F.when(F.octet_length(reason) <= REASON_LIMIT, reason).otherwise(F.concat(whole, F.lit("…")))


def utc_date(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd")


def required(value: Column, name: str, sentinel: Column) -> Column:
    """The column with a non-nullable type. A NULL fails the job; it is never replaced."""
    checked = F.when(value.isNull(), F.raise_error(F.lit(f"{name} must not be null"))).otherwise(value)
    return F.coalesce(checked, sentinel)
