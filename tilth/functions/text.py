"""Text and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every character Unicode calls white space.
WHITE_SPACE = (
    r" \t\n\r\u000B\u000C\u0085\u00A0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    r"\u2009\u200A\u2028\u2029\u202F\u205F\u3000"
)


def strip_text(c: str) -> str:
    """Strip all surrounding white space; ``trim`` alone strips only spaces."""
    return f"trim(BOTH '{WHITE_SPACE}' FROM {c})"


def iso_weekday(day: str) -> str:
    """1 = Monday .. 7 = Sunday."""
    return f"weekday({day}) + 1"


def start_of(grain: str, day: str, name: str | None = None) -> Column:
    """First day of the ISO week, month, quarter or year; or the day itself."""
    return F.expr(f"to_date(date_trunc('{grain}', {day}))" + (f" AS {name}" if name else ""))


def hours_between(start: str, end: str) -> str:
    """Whole seconds between two instants, in hours."""
    return f"cast(floor((unix_micros({end}) - unix_micros({start})) / 1000000) as double) / 3600D"
