"""Strict JSON reading of an envelope with Spark's VARIANT functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import TOMBSTONE_REASON

REQUIRED_TEXT = ("event_id", "gateway_id", "received_at")
KNOWN_FIELDS = ("event_id", "gateway_id", "received_at", "retry_count", "stream_name", "event_header", "payload")

# An escaped surrogate with no partner. The escape counts only after an even number of
# backslashes.
LONE_SURROGATE = (
    r"(?<!\\)(?:\\\\)*(?:"
    r"\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F])"
    r"|(?<!\\u[dD][89abAB][0-9a-fA-F]{2})\\u[dD][c-fC-F][0-9a-fA-F]{2})"
)


def strict_document(text: Column) -> Column:
    """The text as the first element of a two-element VARIANT array.

    The parser stops at the end of the first value, so text after it would go unnoticed.
    The text is therefore followed by its own hash inside one array: only if the hash is
    read back as the second element did the first one span the whole text.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]")))


def spans_whole_text(document: Column, text: Column) -> Column:
    return F.coalesce(F.try_variant_get(document, "$[1]", "bigint") == F.xxhash64(text), F.lit(False))


# What the parser cannot hold, however valid: longer names, longer numbers, deeper nesting, and
# documents that grow too large, which smaller ones than LARGE cannot.
LONGEST_NAME, LONGEST_NUMBER, DEEPEST, LARGE = 50_000, 1_000, 1_000, 16 << 20
BEYOND_LIMITS = "beyond parser limits"


def beyond_limits(text: Column) -> Column:
    """Whether a text that was not parsed goes beyond a limit of the parser.

    What else is in such a text is not known, except for a large one: its syntax is read by a
    parser that keeps nothing.
    """
    flat = F.regexp_replace(text, r"(?s)\\(?:u[0-9a-fA-F]{4}|.)", "_")
    bare = F.regexp_replace(flat, '"[^"]*+"', "")
    brackets = F.regexp_replace(bare, r"[^\[\]{}]", "")
    step = lambda held, c: F.struct(
        (held["depth"] + F.when(c.isin("[", "{"), 1).otherwise(-1)).alias("depth"),
        F.greatest(held["deepest"], held["depth"] + F.when(c.isin("[", "{"), 1).otherwise(-1)).alias("deepest"),
    )
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("deepest"))
    deepest = F.aggregate(F.split(brackets, ""), start, step, lambda held: held["deepest"])
    whole = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]"))).eqNullSafe(2)
    return (
        F.when((F.octet_length(text) > LARGE) & whole, True)
        .when(flat.rlike(r'[{,]\s*"[^"]{%d,}+"\s*:' % (LONGEST_NAME + 1)), True)
        .when(bare.rlike("[-+.0-9eE]{%d}" % (LONGEST_NUMBER + 1)), True)
        .when(F.length(brackets) > DEEPEST, deepest > DEEPEST - 1)
        .otherwise(False)
    )


# A known field that occurs twice in the JSON list of an object's keys.
REPEATED_FIELD = '"(' + "|".join(KNOWN_FIELDS) + r')",(?:.*,)?"\1"'

# One cast takes all fields apart, first as they are, so that their types can be judged,
# then as the types of the contract.
UNTYPED = "struct<" + ", ".join(f"{name}: variant" for name in KNOWN_FIELDS) + ">"
TYPED = (
    "struct<event_id: string, gateway_id: string, received_at: string, retry_count: int,"
    " stream_name: string, event_header: variant, payload: variant>"
)


def envelope_as(document: Column, struct_type: str) -> Column:
    return F.try_variant_get(document, "$[0]", struct_type)


def has_type(value: Column, name: str) -> Column:
    return F.schema_of_variant(value) == F.lit(name)


def malformed_reason_of(value: Column, text: Column, document: Column, keys: Column, untyped: Column) -> Column:
    """Why the record is unreadable, or NULL when it is a valid envelope.

    Earlier rules win. `retry_count` may be absent but not null; `stream_name` and
    `event_header` may be either.
    """
    reason = F.when(value.isNull(), F.lit(TOMBSTONE_REASON))
    reason = reason.when(
        ~spans_whole_text(document, text) | (text.contains("\\u") & text.rlike(LONE_SURROGATE)),
        F.when(~F.is_valid_utf8(text), F.lit("invalid UTF-8"))
        .when(document.isNull() & beyond_limits(text), F.lit(BEYOND_LIMITS))
        .otherwise(F.lit("invalid JSON")),
    )
    reason = reason.when(untyped.isNull(), F.lit("not an object"))
    repeated = (F.size(keys) > F.size(F.array_distinct(keys))) & F.to_json(keys).rlike(REPEATED_FIELD)
    reason = reason.when(repeated, F.lit("duplicate field"))
    for name in (*REQUIRED_TEXT, "payload"):
        reason = reason.when(untyped[name].isNull(), F.lit(f"missing field `{name}`"))
    for name in REQUIRED_TEXT:
        reason = reason.when(~has_type(untyped[name], "STRING"), F.lit(f"invalid type for `{name}`"))
    retry = untyped["retry_count"]
    reason = reason.when(
        retry.isNotNull() & ~(has_type(retry, "BIGINT") & F.try_variant_get(retry, "$", "int").isNotNull()),
        F.lit("invalid type for `retry_count`"),
    )
    return reason.when(
        ~has_type(untyped["stream_name"], "STRING") & ~F.is_variant_null(untyped["stream_name"]),
        F.lit("invalid type for `stream_name`"),
    )
