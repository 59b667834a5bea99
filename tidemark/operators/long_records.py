"""Envelopes beyond the limits of Spark's parser.

`operators.records.parse_envelope` stays in compiled code and marks what its parser cannot hold. Here
those messages, and no others, are read again by a tokenizer in Python.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rfc3339
from tidemark.functions.json_envelope import BEYOND_LIMITS, LARGE
from tidemark.functions.long_json import Envelope, envelope
from tidemark.operators.records import parse_envelope

# No shorter message is beyond a limit: the least one is a number of 1,001 digits.
SHORTEST = 1_000
FIELDS = (
    "event_id string, gateway_id string, received_at string, retry_count int, stream_name string,"
    " event_header string, payload string, reason string"
)


def _read(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for values in parts:
        found = pd.DataFrame([envelope(bytes(value)) for value in values], columns=Envelope._fields, dtype=object)
        yield found.assign(retry_count=found["retry_count"].astype("Int32"))


def parse_all(records: DataFrame) -> DataFrame:
    """`parse_envelope`, and the fields of envelopes that are beyond its limits.

    Header and payload of these are kept as they stand in the message; the text of others is written
    anew by the parser. What is no envelope has its own reason instead of `beyond parser limits`, and
    stays in `raw_value`. Messages of more than `LARGE` bytes go to the tokenizer at once; of the others,
    those of `SHORTEST` bytes or more are read a second time.
    """
    size = F.coalesce(F.octet_length("value"), F.lit(0))
    parsed = parse_envelope(records.where(size <= LARGE))
    beyond = F.col("malformed_reason").eqNullSafe(F.lit(BEYOND_LIMITS))
    kept = [c for c in records.columns if c != "value"]
    flagged = parse_envelope(records.where((size >= SHORTEST) & (size <= LARGE))).where(beyond).select(*kept, "raw_value")
    large = records.where(size > LARGE).select(*kept, F.col("value").cast("binary").alias("raw_value"))
    fields = F.pandas_udf(_read, FIELDS)(F.col("raw_value"))
    # The fields are taken from one column that is worked out once, and only for these rows.
    read = flagged.unionByName(large).select("*", F.explode(F.array(fields)).alias("__fields"))
    good = F.col("__fields.reason").isNull()
    again = {
        "received_at": rfc3339(F.col("__fields.received_at")),
        "malformed": ~good,
        "malformed_reason": F.col("__fields.reason"),
        "raw_value": F.when(~good, F.col("raw_value")),
    }
    for name in ("event_id", "gateway_id", "retry_count", "stream_name", "event_header", "payload"):
        again[name] = F.col(f"__fields.{name}")
    recovered = read.select(*[again.get(name, F.col(name)).alias(name) for name in parsed.columns])
    return parsed.where(~beyond).unionByName(recovered)
