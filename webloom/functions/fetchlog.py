"""HTTP status from the browser's log of network events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: which log entry of a page holds its response (the fourth).
RESPONSE_ENTRY = 3

# Where the status may stand, by falling precedence, and whether the
# text there is a status line ("HTTP/1.1 301 Moved") or the bare status.
STATUS_PLACES = [
    ("$.message.params.response.headersText", "status line"),
    ("$.message.params.response.headers.status", "bare"),
    ("$.message.params.redirectResponse.headersText", "status line"),
    ("$.message.params.redirectResponse.headers.status", "bare"),
    ("$.message.params.response.status", "bare"),
]
DEFAULT_STATUS = "200"


def _first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def _read(message: Column, path: str, kind: str) -> Column:
    line = _first_line(F.get_json_object(message, path))
    if kind == "bare":
        return line
    found = F.regexp_extract(line, r"^\s*\S+\s+(\S+)", 1)
    return F.when(found != "", found)


def status(message: Column) -> Column:
    """HTTP status of a log message; 200 where it names none, null where it is no number."""
    found = [_read(message, path, kind) for path, kind in STATUS_PLACES]
    return F.coalesce(*found, F.lit(DEFAULT_STATUS)).try_cast("int")


def header_status(message: Column) -> Column:
    """The ``status`` response header alone, null where it is missing."""
    return _read(message, *STATUS_PLACES[1]).try_cast("int")


def response_entries(log: DataFrame, entry: int = RESPONSE_ENTRY) -> DataFrame:
    """The one log entry per page that holds its response."""
    return log.where(F.col("log_idx") == entry)
