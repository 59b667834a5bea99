import json
from datetime import datetime, timezone

import pytest
from frames import STAMP, envelope, message, wire
from pyspark.sql import functions as F

from tidemark.functions import rfc3339, truncate_reason
from tidemark.operators.records import parse_envelope, payload_field, records_of, staging_rows
from tidemark.schema import ENVELOPE_COLUMNS, STAGING, TOMBSTONE_REASON

BASE = '"event_id":"e","gateway_id":"g","received_at":"2031-05-21T16:20:00Z"'

VERDICTS = [
    ("tombstone", None, TOMBSTONE_REASON),
    ("not json", '{"event_id": tru', "invalid JSON"),
    ("empty", " ", "invalid JSON"),
    ("no envelope", '{"seq":17}', "missing field `event_id`"),
    ("plain", "{" + BASE + ',"payload":1}', None),
    ("white space around", " \t\r\n{" + BASE + ',"payload":1}\n', None),
    ("text after", "{" + BASE + ',"payload":1} x', "invalid JSON"),
    ("brace after", "{" + BASE + ',"payload":1}}', "invalid JSON"),
    ("document after", "{" + BASE + ',"payload":1}{}', "invalid JSON"),
    ("list end after", "{" + BASE + ',"payload":1}] x', "invalid JSON"),
    ("second element", "{" + BASE + ',"payload":1},2', "invalid JSON"),
    ("trailing comma", "{" + BASE + ',"payload":1,}', "invalid JSON"),
    ("single quotes", "{'event_id':'e'}", "invalid JSON"),
    ("nan", "{" + BASE + ',"payload":NaN}', "invalid JSON"),
    ("leading zero", "{" + BASE + ',"payload":01}', "invalid JSON"),
    ("raw tab in text", "{" + BASE + ',"payload":"\t"}', "invalid JSON"),
    ("lone surrogate", "{" + BASE + ',"payload":"\\ud800"}', "invalid JSON"),
    ("lone low surrogate", "{" + BASE + ',"payload":"\\udc00"}', "invalid JSON"),
    ("surrogate pair", "{" + BASE + ',"payload":"\\ud83d\\ude00"}', None),
    ("escaped backslash before u", "{" + BASE + ',"payload":"\\\\ud800"}', None),
    ("bad utf-8", ("{" + BASE + ',"payload":"').encode() + b'\xff"}', "invalid UTF-8"),
    ("list", "[1,2]", "not an object"),
    ("positional list", '["e","g","2031-05-21T16:20:00Z",0,null,null,1]', "not an object"),
    ("number", "5", "not an object"),
    ("null", "null", "not an object"),
    ("empty object", "{}", "missing field `event_id`"),
    ("no gateway", '{"event_id":"e","received_at":"r","payload":1}', "missing field `gateway_id`"),
    ("no received_at", '{"event_id":"e","gateway_id":"g","payload":1}', "missing field `received_at`"),
    ("no payload", "{" + BASE + "}", "missing field `payload`"),
    ("payload null", "{" + BASE + ',"payload":null}', None),
    ("id number", envelope(1, event_id=5), "invalid type for `event_id`"),
    ("id null", envelope(1, event_id=None), "invalid type for `event_id`"),
    ("gateway object", envelope(1, gateway_id={}), "invalid type for `gateway_id`"),
    ("received_at number", envelope(1, received_at=0), "invalid type for `received_at`"),
    ("retry", envelope(1, retry_count=7), None),
    ("retry largest", envelope(1, retry_count=2**31 - 1), None),
    ("retry smallest", envelope(1, retry_count=-(2**31)), None),
    ("retry too large", envelope(1, retry_count=2**31), "invalid type for `retry_count`"),
    ("retry huge", envelope(1, retry_count=10**30), "invalid type for `retry_count`"),
    ("retry decimal", "{" + BASE + ',"retry_count":1.0,"payload":1}', "invalid type for `retry_count`"),
    ("retry exponent", "{" + BASE + ',"retry_count":1e0,"payload":1}', "invalid type for `retry_count`"),
    ("retry text", envelope(1, retry_count="7"), "invalid type for `retry_count`"),
    ("retry null", envelope(1, retry_count=None), "invalid type for `retry_count`"),
    ("stream", envelope(1, stream_name="s"), None),
    ("stream null", envelope(1, stream_name=None), None),
    ("stream number", envelope(1, stream_name=1), "invalid type for `stream_name`"),
    ("header null", envelope(1, event_header=None), None),
    ("header text", envelope(1, event_header="x"), None),
    ("unknown field", envelope(1, extra=[1]), None),
    ("unknown twice", "{" + BASE + ',"x":1,"x":2,"payload":1}', None),
    ("inner twice", "{" + BASE + ',"payload":{"a":1,"a":2}}', None),
    ("known twice", "{" + BASE + ',"payload":1,"payload":1}', "duplicate field"),
    ("known twice apart", "{" + BASE + ',"payload":1,"x":1,"event_id":"e"}', "duplicate field"),
    ("known twice escaped", "{" + BASE + ',"payload":1,"event\\u005fid":"e"}', "duplicate field"),
    ("quoted name inside a key", "{" + BASE + ',"payload":1,"a\\",\\"event_id":1,"x":1,"x":2}', None),
    ("deep", "{" + BASE + ',"payload":' + "[" * 100 + "]" * 100 + "}", None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [message(n, value=value) for n, (_, value, _) in enumerate(VERDICTS)]
    found = parse_envelope(records_of(wire(spark, *rows))).orderBy("kafka_offset").collect()
    return {VERDICTS[n][0]: row for n, row in enumerate(found)}


@pytest.mark.parametrize(("case", "value", "reason"), VERDICTS, ids=[v[0] for v in VERDICTS])
def test_verdict(parsed, case, value, reason):
    row = parsed[case]
    assert row.malformed_reason == reason
    assert row.malformed == (reason is not None)
    if row.malformed:
        assert all(row[c] is None for c in ENVELOPE_COLUMNS)
    else:
        assert row.event_id and row.gateway_id and row.retry_count is not None and row.payload is not None
    assert row.kafka_offset == [v[0] for v in VERDICTS].index(case)


def test_values(parsed):
    assert parsed["retry"].retry_count == 7
    assert parsed["plain"].retry_count == 0
    assert parsed["retry largest"].retry_count == 2**31 - 1
    assert parsed["stream"].stream_name == "s"
    assert parsed["stream null"].stream_name is None
    assert parsed["header null"].event_header is None
    assert parsed["header text"].event_header == '"x"'
    assert parsed["payload null"].payload == "null"
    assert parsed["inner twice"].payload == '{"a":2}'
    assert json.loads(parsed["surrogate pair"].payload) == "😀"
    assert parsed["deep"].payload == "[" * 100 + "]" * 100


def one(spark, value, **meta):
    return parse_envelope(records_of(wire(spark, message(7, value=value, **meta)))).first()


def test_header_of_authenticated_traffic(spark):
    header, payload = {"realm": "north", "roles": [2, 5]}, {"reading": -4.5, "unit": "mm"}
    value = envelope(31, retry_count=3, stream_name="ingestion-signals", event_header=header, payload=payload)
    row = one(spark, value)
    assert (row.event_id, row.stream_name, row.retry_count) == ("item-31", "ingestion-signals", 3)
    assert json.loads(row.event_header) == header and json.loads(row.payload) == payload


def test_api_key_traffic_has_no_header(spark):
    row = one(spark, envelope(2))
    assert (row.malformed, row.event_header, row.stream_name, row.retry_count) == (False, None, None, 0)


def test_large_broken_document_has_a_short_reason(spark):
    row = one(spark, '{"event_id": [' + "12.5, " * 4_000)
    assert row.malformed and len(row.malformed_reason) <= 201


def test_large_payload_is_kept_whole(spark):
    text = "é" * 200_000
    assert json.loads(one(spark, envelope(1, payload=text)).payload) == text


def test_malformed_messages_are_kept_and_parser_limits_named(spark):
    start = "{" + BASE + ',"payload":'
    beyond = [start + '{"' + "a" * 50_001 + '":1}}', start + "1" * 1_001 + "}", start + "[" * 1_001 + "]" * 1_001 + "}"]
    beyond.append(start + '{"' + "a\\n" * 50_001 + '":1}}')
    other = ["[1, tru", start + '"' + "1" * 2_000 + "[" * 2_000 + '"]}', start + "[]," * 2_000 + "}", "{" + BASE + ',"payload":1,}']
    wired = wire(spark, *[message(n, value=text) for n, text in enumerate([*beyond, *other, envelope(1)])])
    rows = staging_rows(parse_envelope(records_of(wired)), F.lit("2031-05-21 16:20:00")).orderBy("kafka_offset").collect()
    assert [r.malformed_reason for r in rows] == ["beyond parser limits"] * 4 + ["invalid JSON"] * 4 + [None]
    assert [r.raw_value and r.raw_value.decode() for r in rows] == [*beyond, *other, None]
    large = F.concat(F.lit(start + "["), F.repeat(F.lit("1,"), F.lit(25_000_000)), F.lit("1]}"))
    texts = spark.range(2).select(F.concat(large, F.when(F.col("id") == 0, "").otherwise("}")).cast("binary").alias("value"), "id")
    found = parse_envelope(texts).select("id", "malformed_reason", F.octet_length("raw_value")).orderBy("id").collect()
    size = len(start) + 50_000_004
    assert [tuple(r) for r in found] == [(0, "beyond parser limits", size), (1, "invalid JSON", size + 1)]


def test_unreadable_time_keeps_the_row(spark):
    row = one(spark, envelope(1, received_at="yesterday noon"))
    assert (row.malformed, row.received_at, row.payload) == (False, None, '{"level":1}')


def test_missing_broker_timestamp(spark):
    assert one(spark, envelope(1), stamp=None).kafka_timestamp is None
    assert one(spark, envelope(1)).kafka_timestamp is not None


def test_broker_timestamp_without_a_type(spark):
    topic, partition, offset, stamp, _, value = message(7)
    row = records_of(wire(spark, (topic, partition, offset, stamp, None, value))).first()
    assert row.kafka_timestamp is not None


def test_broker_timestamp_is_kept_in_milliseconds(spark):
    stamp = STAMP.replace(microsecond=123456)
    micros = parse_envelope(records_of(wire(spark, message(7, stamp=stamp)))).select(F.unix_micros("kafka_timestamp"))
    assert micros.first()[0] % 1_000_000 == 123_000


def test_negative_offset_fails_the_job(spark):
    with pytest.raises(Exception, match="negative log offset"):
        records_of(wire(spark, message(-1))).collect()


TIMES = {
    "2031-05-21T16:20:00Z": datetime(2031, 5, 21, 16, 20, tzinfo=timezone.utc),
    "2031-05-21t16:20:00z": datetime(2031, 5, 21, 16, 20, tzinfo=timezone.utc),
    "2031-05-21 16:20:00Z": datetime(2031, 5, 21, 16, 20, tzinfo=timezone.utc),
    "2031-05-21T16:20:00+02:00": datetime(2031, 5, 21, 14, 20, tzinfo=timezone.utc),
    "2031-05-21T16:20:00.123456789Z": datetime(2031, 5, 21, 16, 20, 0, 123456, tzinfo=timezone.utc),
    "2031-05-21": None,
    "2031-05-21T16:20:00": None,
    "2031-05-21T16:20:00+0200": None,
    "2031-05-21T16:20:00 UTC": None,
    "2031-5-21T16:20:00Z": None,
    "2031-13-21T16:20:00Z": None,
    "2031-02-30T16:20:00Z": None,
    "10:00:00Z": None,
    "": None,
}


def test_rfc3339(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    found = dict(df.select("t", F.unix_micros(rfc3339(F.col("t")))).collect())
    assert found == {t: None if v is None else round(v.timestamp() * 1_000_000) for t, v in TIMES.items()}


def test_reason_is_cut_between_characters(spark):
    texts = ["x" * 200, "x" * 201, "é" * 150, "x" + "é" * 150, "xy" + "😀" * 60, "short", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, cut in df.select("t", truncate_reason(F.col("t"))).collect():
        if text is None or len(text.encode()) <= 200:
            assert cut == text
        else:
            assert cut == text.encode()[:200].decode(errors="ignore") + "…"


def test_long_reasons_are_cut_when_staged(spark):
    parsed = parse_envelope(records_of(wire(spark, message(1, value="{")))).withColumn("malformed_reason", F.repeat(F.lit("é"), 150))
    assert staging_rows(parsed, F.lit("2031-05-21 16:20:00")).first().malformed_reason == "é" * 100 + "…"


def test_contract_columns(spark):
    rows = staging_rows(parse_envelope(records_of(wire(spark, message(1)))), F.lit("2031-05-21 16:20:00"))
    assert [(f.name, f.dataType, f.nullable) for f in rows.schema] == [
        (f.name, f.dataType, f.nullable) for f in STAGING
    ]
    assert rows.to(STAGING).count() == 1


def test_missing_provenance_fails_the_job(spark):
    bad = wire(spark, (None, 0, 1, None, -1, envelope(1).encode()))
    with pytest.raises(Exception, match="kafka_topic must not be null"):
        staging_rows(parse_envelope(records_of(bad)), F.lit("2031-05-21 16:20:00")).collect()


def test_payload_field(spark):
    df = spark.createDataFrame([('{"k":5,"s":"x"}',), ('{"k":"y"}',), ("broken",), (None,)], "p string")
    k, s = payload_field(F.col("p"), "$.k", "bigint"), payload_field(F.col("p"), "$.s", "string")
    assert [tuple(r) for r in df.select(k, s).collect()] == [(5, "x"), (None, None), (None, None), (None, None)]
