"""Top-level members of a JSON object of any size, for what Spark's parser cannot hold.

The text is read once from its beginning to its end, with a pattern per token and a byte per open
bracket. Nothing is built of it but the places of the members, so names, numbers, nesting and size have
no limit other than that of a column's value.
"""

import json
import re
from typing import NamedTuple

SPACE = re.compile(r"[ \t\n\r]*+")
_PLAIN = r'[^"\\\x00-\x1f]'
_ESCAPE = (
    r'\\(?:["\\/bfnrt]|u(?:[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|(?![dD][89a-fA-F])[0-9a-fA-F]{4}))'
)
_STRING = rf'"(?:{_PLAIN}++|{_ESCAPE})*+"'
_NUMBER = r"-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+"
SCALAR = re.compile(rf"{_STRING}|{_NUMBER}|true|false|null")
# What stands before the next value of a list, as long as it is scalars; and a name with its colon.
ELEMENTS = re.compile(rf"(?:[ \t\n\r]*+(?:{_STRING}|{_NUMBER}|true|false|null)[ \t\n\r]*+,)*+[ \t\n\r]*+")
NAME = re.compile(rf"[ \t\n\r]*+({_STRING})[ \t\n\r]*+:[ \t\n\r]*+")
INTEGER = re.compile(r"-?(?:0|[1-9][0-9]*)\Z")
LIST, OBJECT = 0, 1


class Broken(ValueError):
    """The text is no JSON."""


def _skip(text: str, at: int) -> int:
    return SPACE.match(text, at).end()


def value_end(text: str, at: int) -> int:
    """Where the value that begins at `at` ends."""
    held = bytearray()
    while True:
        scalar = SCALAR.match(text, at)
        if scalar:
            at = scalar.end()
        else:
            kind = "[{".find(text[at : at + 1]) if at < len(text) else -1
            if kind < 0:
                raise Broken(at)
            inside = _skip(text, at + 1)
            if text[inside : inside + 1] == "]}"[kind]:
                at = inside + 1
            else:
                held.append(kind)
                at = _next_value(text, at + 1, kind)
                continue
        while held:
            at = _skip(text, at)
            sign = text[at : at + 1]
            if sign == ",":
                at = _next_value(text, at + 1, held[-1])
                break
            if sign != "]}"[held[-1]] or not sign:
                raise Broken(at)
            held.pop()
            at += 1
        else:
            return at


def _next_value(text: str, at: int, kind: int) -> int:
    if kind == LIST:
        return ELEMENTS.match(text, at).end()
    name = NAME.match(text, at)
    if not name:
        raise Broken(at)
    return name.end()


def members(text: str) -> list[tuple[str, int, int]] | None:
    """Name, begin and end of each member of the object that `text` is; nothing if it is another value."""
    at = _skip(text, 0)
    if text[at : at + 1] != "{":
        if _skip(text, value_end(text, at)) != len(text):
            raise Broken(at)
        return None
    found = []
    at = _skip(text, at + 1)
    if text[at : at + 1] == "}":
        at += 1
    else:
        while True:
            name = NAME.match(text, at)
            if not name:
                raise Broken(at)
            end = value_end(text, name.end())
            found.append((json.loads(name.group(1)), name.end(), end))
            at = _skip(text, end) + 1
            if text[at - 1 : at] == "}":
                break
            if text[at - 1 : at] != ",":
                raise Broken(at)
    if _skip(text, at) != len(text):
        raise Broken(at)
    return found


class Envelope(NamedTuple):
    event_id: str | None = None
    gateway_id: str | None = None
    received_at: str | None = None
    retry_count: int | None = None
    stream_name: str | None = None
    event_header: str | None = None
    payload: str | None = None
    reason: str | None = None


def envelope(value: bytes) -> Envelope:
    """The fields of an envelope, header and payload as they stand in it, or the reason there are none.

    The rules, and the order in which they are judged, are those of `functions.json_envelope`.
    """
    try:
        text = value.decode()
        found = members(text)
    except UnicodeDecodeError:
        return Envelope(reason="invalid UTF-8")
    except Broken:
        return Envelope(reason="invalid JSON")
    if found is None:
        return Envelope(reason="not an object")
    fields: dict[str, str] = {}
    for name, begin, end in found:
        if name in Envelope._fields[:7]:
            if name in fields:
                return Envelope(reason="duplicate field")
            fields[name] = text[begin:end]
    for name in ("event_id", "gateway_id", "received_at", "payload"):
        if name not in fields:
            return Envelope(reason=f"missing field `{name}`")
    for name in ("event_id", "gateway_id", "received_at"):
        if fields[name][0] != '"':
            return Envelope(reason=f"invalid type for `{name}`")
    retry = fields.get("retry_count", "0")
    # Eleven characters hold every number of 32 bits.
    if not INTEGER.match(retry) or len(retry) > 11 or not -(1 << 31) <= int(retry) < 1 << 31:
        return Envelope(reason="invalid type for `retry_count`")
    stream = fields.get("stream_name", "null")
    if stream[0] != '"' and stream != "null":
        return Envelope(reason="invalid type for `stream_name`")
    header = fields.get("event_header", "null")
    texts = [json.loads(fields[name]) for name in ("event_id", "gateway_id", "received_at")]
    return Envelope(*texts, int(retry), json.loads(stream), None if header == "null" else header, fields["payload"])
