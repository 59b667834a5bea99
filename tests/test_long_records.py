"""Envelopes beyond the limits of the parser, and the tokenizer against a parser that knows them all."""

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from frames import envelope, message, wire

from tidemark.functions import long_json
from tidemark.operators.long_records import parse_all
from tidemark.operators.records import parse_envelope, records_of

START = '{"event_id":"e","gateway_id":"g","received_at":"2031-05-21T16:20:00Z","payload":'


def strict(text):
    def refuse(name):
        raise ValueError(name)

    try:
        value = json.loads(text, parse_constant=refuse)
    except ValueError:
        return None
    # The parser takes single surrogates and control characters that JSON has not.
    try:
        json.dumps(value, ensure_ascii=False).encode()
    except UnicodeEncodeError:
        return None
    return (value,)


def test_the_tokenizer_takes_what_json_is_and_no_more():
    dice = random.Random(7)
    pieces = ['"a"', '"\\u00e9"', '"\\ud83d\\ude00"', '"\\ud83d"', '"\\udc00x"', '"\\\\"', '"\\x"', '"\n"', "1", "-0", "01", "1.", "1.5e-7", "-", "true", "null", "nul", "{", "}", "[", "]", ",", ":", " ", "\t", '"b":', " ", "NaN", '"unclosed']

    def grown(depth):
        kind = dice.random()
        if depth == 0 or kind < 0.4:
            return dice.choice(pieces[:2] + pieces[5:6] + ["1", "-0", "1.5e-7", "true", "null", "2"])
        inner = [grown(depth - 1) for _ in range(dice.randint(0, 4))]
        space = dice.choice(["", " ", "\n"])
        if kind < 0.7:
            return "[" + space + f"{space},".join(inner) + space + "]"
        return "{" + space + ",".join(f'"k{n}"{space}: {value}' for n, value in enumerate(inner)) + "}"

    valid = 0
    for n in range(30_000):
        text = grown(4) if n % 2 else "".join(dice.choices(pieces, k=dice.randint(1, 9)))
        if n % 4 == 3:
            at = dice.randrange(len(text))
            text = text[:at] + dice.choice(pieces) + text[at + dice.randint(0, 1) :]
        expected = strict(text)
        try:
            found = long_json.members(text)
        except long_json.Broken:
            assert expected is None, text
            continue
        assert expected is not None, text
        valid += 1
        if isinstance(expected[0], dict):
            taken = {name: json.loads(text[begin:end]) for name, begin, end in found}
            assert taken == expected[0]
        else:
            assert found is None
    assert valid > 5000


LONG = [
    START + '{"' + "a" * 50_001 + '":1}}',
    START + "1" * 1_001 + "}",
    START + "[" * 1_001 + "]" * 1_001 + ',"retry_count":3,"stream_name":"s","event_header":{"x" :  [1]}}',
    START + '{"' + "n" * 50_001 + '":"\\ud83d\\ude00"},"event_header":null}',
]
FLAWED = {
    "invalid JSON": START + '{"' + "a" * 50_001 + '":1}}}',
    "duplicate field": START + '{"' + "a" * 50_001 + '":1},"payload":1}',
    "missing field `gateway_id`": '{"event_id":"e","payload":{"' + "a" * 50_001 + '":1},"received_at":"x"}',
    "invalid type for `event_id`": START.replace('"e"', "7") + '{"' + "a" * 50_001 + '":1}}',
    "invalid type for `retry_count`": START + "1" * 1_001 + ',"retry_count":' + "9" * 1_001 + "}",
    "invalid type for `stream_name`": START + "1" * 1_001 + ',"stream_name":[]}',
    "not an object": "[" * 1_001 + "]" * 1_001,
}


def test_envelopes_beyond_the_limits_are_parsed(spark):
    rest = [envelope(1), "{", None, "x" * 2000]
    rows = wire(spark, *[message(n, value=text) for n, text in enumerate([*LONG, *FLAWED.values(), *rest])])
    records = records_of(rows)
    got = parse_all(records).orderBy("kafka_offset").collect()
    assert [r.malformed_reason for r in got[: len(LONG)]] == [None] * len(LONG)
    for row, text in zip(got, LONG, strict=False):
        sent = json.loads(text) if "[[" not in text else None
        assert (row.event_id, row.gateway_id, row.received_at.day, row.raw_value) == ("e", "g", 21, None)
        assert row.payload in text and (sent is None or json.loads(row.payload) == sent["payload"])
    assert (got[2].retry_count, got[2].stream_name, got[2].event_header) == (3, "s", '{"x" :  [1]}')
    assert (got[3].retry_count, got[3].stream_name, got[3].event_header) == (0, None, None)
    for row, (reason, text) in zip(got[len(LONG) :], FLAWED.items(), strict=False):
        assert (row.malformed_reason, row.raw_value.decode(), row.event_id, row.payload) == (reason, text, None, None)
    same = parse_envelope(records).orderBy("kafka_offset").collect()
    assert got[len(LONG) + len(FLAWED) :] == same[len(LONG) + len(FLAWED) :]
    assert parse_all(records.limit(0)).count() == 0 and parse_all(records).columns == parse_envelope(records).columns


def test_rules_are_those_of_the_parser(spark):
    """What both ways can read, they judge alike."""
    body = {"event_id": "a", "gateway_id": "b", "received_at": "c", "payload": 1}
    changes = [{}, {"event_id": None}, {"gateway_id": 3}, {"retry_count": 2**31}, {"retry_count": -(2**31)}, {"retry_count": None}, {"retry_count": 1.0}]
    changes += [{"stream_name": None}, {"stream_name": 1}, {"event_header": None}, {"event_header": [1]}, {"payload": None}, {"event_id": {}}]
    texts = [json.dumps({**body, **change}) for change in changes] + [json.dumps({k: v for k, v in body.items() if k != d}) for d in body]
    texts += ["[]", "1", "{}", "", " ", '{"event_id":"a","event_id":"b"}', json.dumps({**body, "x": 1})[:-1] + ',"x":2}']
    parsed = parse_envelope(records_of(wire(spark, *[message(n, value=t or " ") for n, t in enumerate(texts)])))
    for row, text in zip(parsed.orderBy("kafka_offset").collect(), texts, strict=True):
        ours = long_json.envelope((text or " ").encode())
        assert ours.reason == row.malformed_reason, text
        if ours.reason is None:
            assert (ours.event_id, ours.retry_count, ours.stream_name, ours.event_header, ours.payload) == (
                row.event_id, row.retry_count, row.stream_name, row.event_header, row.payload,
            )


@pytest.mark.parametrize("unit", ["1,", '"\\n",', "{},", '[[],{"a":[1]}],'])
def test_large_documents_are_read_in_one_pass(unit):
    count = 20_000_000 // len(unit)
    text = START + "[" + unit * count + "0]}"
    found = long_json.envelope(text.encode())
    assert found.reason is None and len(found.payload) == len(unit) * count + 3
    assert long_json.envelope((text + "]").encode()).reason == "invalid JSON"


def test_an_envelope_of_130_mb(spark, tmp_path):
    size = 65_000_000
    value = (START + "[" + "1," * size + "0]}").encode()
    columns = {"kafka_topic": ["t"], "kafka_partition": [0], "kafka_offset": [5], "value": [value]}
    pq.write_table(pa.table(columns), tmp_path / "message.parquet")
    found = parse_all(spark.read.parquet(str(tmp_path))).selectExpr("kafka_offset", "malformed", "event_id", "length(payload) AS size")
    assert [tuple(r) for r in found.collect()] == [(5, False, "e", 2 * size + 3)]
