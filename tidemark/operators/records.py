"""From wire messages to rows of the staging contract."""

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import malformed_reason_of, required, rfc3339, strict_document, truncate_reason
from tidemark.functions.json_envelope import TYPED, UNTYPED, envelope_as
from tidemark.schema import STAGING
from tidemark.session import configure


def records_of(wire: DataFrame) -> DataFrame:
    """Provenance and value of each message; other columns pass through.

    The broker timestamp has millisecond precision and is NULL when the message has none
    (`timestampType` -1). A negative offset fails the job.
    """
    rest = [c for c in wire.columns if c not in {"topic", "partition", "offset", "timestamp", "timestampType", "value"}]
    offset = F.when(F.col("offset") < 0, F.raise_error(F.lit("negative log offset"))).otherwise(F.col("offset"))
    stamp = F.when(~F.col("timestampType").eqNullSafe(-1), F.date_trunc("millisecond", "timestamp"))
    return wire.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        offset.cast("bigint").alias("kafka_offset"),
        stamp.alias("kafka_timestamp"),
        F.col("value"),
        *rest,
    )


def parse_envelope(records: DataFrame) -> DataFrame:
    """Replace `value` by the seven envelope columns, `malformed`, `malformed_reason` and `raw_value`.

    Never fails on a message: an unreadable one keeps its provenance, carries a reason
    and has NULL in every envelope column. Its message is kept in `raw_value`.
    """
    configure(records.sparkSession)
    rest = [F.col(c) for c in records.columns if c != "value"]
    # Separate projections, so that the document is parsed once per row and not once per use.
    texts = records.select(*rest, "value", F.col("value").cast("string").alias("__text"))
    documents = texts.select(
        "*",
        F.when(F.is_valid_utf8("__text"), strict_document(F.col("__text"))).alias("__doc"),
    )
    taken = documents.select(
        *rest,
        "value",
        "__text",
        "__doc",
        F.when(F.col("__doc").isNotNull(), F.json_object_keys("__text")).alias("__keys"),
        envelope_as(F.col("__doc"), UNTYPED).alias("__raw"),
    )
    reason = malformed_reason_of(F.col("value"), F.col("__text"), F.col("__doc"), F.col("__keys"), F.col("__raw"))
    # A filter on `malformed` would be pushed below these projections with the whole parse
    # copied into it, once per use. It cannot pass a generator, so the reason is the one
    # element of an exploded array.
    judged = taken.select(*rest, "value", "__doc", F.explode(F.array(reason)).alias("__reason"))
    good = F.col("__reason").isNull()
    raw = F.when(~good, F.col("value").cast("binary")).alias("raw_value")
    typed = judged.select(*rest, raw, "__reason", F.when(good, envelope_as(F.col("__doc"), TYPED)).alias("__env"))
    header = F.col("__env.event_header")
    return typed.select(
        "__env.event_id",
        "__env.gateway_id",
        rfc3339(F.col("__env.received_at")).alias("received_at"),
        F.when(good, F.coalesce("__env.retry_count", F.lit(0))).alias("retry_count"),
        "__env.stream_name",
        F.when(~F.is_variant_null(header), F.to_json(header)).alias("event_header"),
        F.to_json("__env.payload").alias("payload"),
        *rest,
        (~good).alias("malformed"),
        F.col("__reason").alias("malformed_reason"),
        "raw_value",
    )


def staging_rows(parsed: DataFrame, written_at: Column, *extra: str) -> DataFrame:
    """The 14 contract columns in contract order and type and `raw_value`, then `extra` columns.

    `written_at` is one instant for the whole write. A reason of any parser is cut to the length of the contract.
    """
    epoch = F.timestamp_seconds(F.lit(0))
    sentinels: Mapping[str, Column] = {
        "kafka_topic": F.lit(""),
        "kafka_partition": F.lit(-1),
        "kafka_offset": F.lit(-1).cast("bigint"),
        "ingested_at": epoch,
        "malformed": F.lit(True),
    }
    stamped = parsed.withColumn("ingested_at", written_at.cast("timestamp"))
    columns = []
    for column in STAGING.fields:
        value = F.col(column.name).cast(column.dataType)
        if column.name == "malformed_reason":
            value = truncate_reason(value)
        if not column.nullable:
            value = required(value, column.name, sentinels[column.name])
        columns.append(value.alias(column.name))
    return stamped.select(*columns, *extra)


def now_utc() -> datetime:
    return datetime.now(timezone.utc)


def malformed_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where("malformed")


def parsed_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where("NOT malformed")


def malformed_by_reason(parsed: DataFrame) -> DataFrame:
    return (
        parsed.where("malformed").groupBy("kafka_topic", "malformed_reason").agg(F.count(F.lit(1)).alias("records"))
    )


def envelope_defaults(parsed: DataFrame) -> DataFrame:
    """How often optional fields took their defaults."""
    return (
        parsed.where("NOT malformed")
        .groupBy("retry_count", F.col("event_header").isNotNull().alias("has_header"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def payload_field(text: Column, path: str, type_name: str) -> Column:
    """One typed field of a payload or header kept as JSON text; NULL where it does not fit."""
    return F.try_variant_get(F.try_parse_json(text), path, type_name)

