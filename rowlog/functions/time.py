"""Epoch-millisecond helpers. All are time-zone independent: they work on
TIMESTAMP_NTZ values anchored at the epoch, never on the session zone."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowlog.functions.text import parse_long

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# The two text layouts of the reference's reports.
SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
# ISO instant with explicit +00:00 offset, used for times inside row images.
IMAGE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_from_millis(ms) -> Column:
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH))


def epoch_millis(ts) -> Column:
    """Whole milliseconds since the epoch of a wall-clock (NTZ) timestamp, floored."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), _c(ts).cast("timestamp_ntz"))


def utc_seconds(ms) -> Column:
    return F.date_format(ntz_from_millis(ms), SECONDS_FORMAT)


def utc_millis(ms) -> Column:
    """Null-safe `yyyy-MM-dd HH:mm:ss.SSS` text of an epoch-ms value."""
    return F.date_format(ntz_from_millis(ms), MILLIS_FORMAT)


def typed_instant(ms) -> Column:
    """The same instant as a TIMESTAMP column (written as ms, UTC-adjusted)."""
    return F.timestamp_millis(_c(ms))


def parse_time_text(c) -> Column:
    """Integer milliseconds, else `yyyy-MM-dd HH:mm:ss` read as UTC, else null."""
    c = _c(c)
    parsed = F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(SECONDS_FORMAT + " xx"))
    return F.coalesce(parse_long(c), F.unix_millis(parsed))
