"""Instant parsing (C4) and instant -> date (C11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedworks.functions.text import _col

# Fixed value: shape of an ISO-8601 instant as the feeds write it: date 'T' time with
# seconds, optional fraction (up to nanoseconds), then 'Z' or a numeric offset.
# Nothing else (date only, missing seconds, surrounding blanks) is an instant.
ISO_INSTANT = (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?"
               r"(Z|[+-]\d{2}:\d{2}(:\d{2})?)$")


def parse_instant(c) -> Column:
    """C4: ISO instant text -> timestamp; any other shape (or an invalid date) -> null.

    No trimming: a leading blank makes the value null, as in the feeds' contract.
    The letters ``T`` and ``Z`` may be of either case.  The guard is needed because
    Spark's cast alone also accepts a bare date.
    """
    c = F.upper(_col(c))
    return F.when(c.rlike(ISO_INSTANT), c.try_cast("timestamp"))


def instant_to_date(c) -> Column:
    """C11: calendar date of an instant in the session zone (pinned to UTC)."""
    return F.to_date(_col(c))


def parse_date(c) -> Column:
    """C4 + C11 in one step."""
    return instant_to_date(parse_instant(c))
