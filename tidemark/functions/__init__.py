from tidemark.functions.json_envelope import malformed_reason_of, strict_document
from tidemark.functions.ranges import (
    check_width,
    commit_offset,
    in_range,
    is_complete,
    object_name,
    range_end,
    range_start,
    width_of,
)
from tidemark.functions.text import required, rfc3339, truncate_reason, utc_date

__all__ = [
    "check_width",
    "commit_offset",
    "in_range",
    "is_complete",
    "malformed_reason_of",
    "object_name",
    "range_end",
    "range_start",
    "required",
    "rfc3339",
    "strict_document",
    "truncate_reason",
    "utc_date",
    "width_of",
]
