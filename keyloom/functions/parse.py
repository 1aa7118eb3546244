"""Guards and parsing of event fields, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: India Standard Time has no daylight saving: a fixed offset in milliseconds.
IST_MS = 19_800_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def filled(name: str, literal_null: bool = False) -> Column:
    """A field that is neither null nor blank; with ``literal_null``, not the word null in any case either."""
    ok = F.col(name).isNotNull() & (F.trim(name) != "")
    return ok & (F.lower(name) != "null") if literal_null else ok


def number(name: str) -> Column:
    """A field as a double; null where it is null, blank or not a number."""
    return F.trim(name).try_cast("double")


def is_yes(name: str = "authResult") -> Column:
    return F.coalesce(F.upper(name) == "Y", F.lit(False))


def is_no(name: str = "authResult") -> Column:
    return F.coalesce(F.upper(name) == "N", F.lit(False))


def ist_hour(ts: str = "ts") -> Column:
    """Hour of the day, 0 to 23, in India."""
    return F.floor((F.col(ts) + IST_MS) / HOUR_MS) % 24


def ist_weekday(ts: str = "ts") -> Column:
    """Day of the week in India, Monday 0 to Sunday 6; 1970-01-01 was a Thursday."""
    return (F.floor((F.col(ts) + IST_MS) / DAY_MS) + 3) % 7


def ist_time(ts: Column) -> Column:
    """Epoch milliseconds as local time in India, without a zone."""
    return F.timestamp_millis(ts + F.lit(IST_MS)).cast("timestamp_ntz")
