"""Publication dates: which texts are accepted, and as which instant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import is_blank

# Accepted text forms.
SQL_SECONDS = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
RFC_3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[Zz]|[+-]\d{2}:\d{2})\z"
RFC_1123 = r"^[A-Za-z]{3}, \d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4}\z"
RFC_1123_NAMED = r"^[A-Za-z]{3}, \d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} (?:GMT|UTC|UT|Z)\z"
US_DATE = r"^\d{2}/\d{2}/\d{4}\z"
EU_DATE = r"^\d{2}\.\d{2}\.\d{4}\z"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
WEEKDAYS = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]

_ISO_LIKE = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}.*)?\z"


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _utc(year: Column, month: Column, day: Column, time: Column) -> Column:
    """Instant of calendar parts given as text, NULL when they name no real time."""
    text = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit("T"), time, F.lit("Z"))
    return F.try_to_timestamp(text)


def _day_name(ts: Column) -> Column:
    # 1970-01-01 was a Thursday; arithmetic on the instant does not depend on the session zone
    days = F.floor(F.unix_micros(ts) / F.lit(86_400_000_000))
    return F.element_at(_names(WEEKDAYS), (F.pmod(days + 4, F.lit(7)) + 1).cast("int"))


def _rfc_1123_instant(c: Column) -> Column:
    """``Mon, 01 Jan 2024 12:00:00 +0300``; a weekday that does not fit the date gives NULL."""
    month = F.array_position(_names(MONTHS), F.lower(F.substring(c, 9, 3))).cast("string")
    local = _utc(
        F.substring(c, 13, 4), F.lpad(month, 2, "0"), F.substring(c, 6, 2), F.substring(c, 18, 8)
    )
    # a named zone has no digits here, so both parts are 0
    digits = F.regexp_extract(c, r"[+-](\d{4})\z", 1)
    hours = F.coalesce(F.substring(digits, 1, 2).try_cast("int"), F.lit(0))
    minutes = F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    shift = F.when(F.substring(c, 27, 1) == "-", -1).otherwise(1) * (hours * 3600 + minutes * 60)
    fits = (F.lower(F.substring(c, 1, 3)) == _day_name(local)) & (hours < 24) & (minutes < 60)
    return F.when(fits, F.timestamp_micros(F.unix_micros(local) - shift.cast("long") * 1_000_000))


def parse_published(c: Column, as_of: Column, mode: str = "strict") -> Column:
    """Publication text to an instant; blank text is ``as_of``, unknown text is NULL.

    Text without a zone is UTC. ``lenient`` also takes named zones and the
    month-first and day-first calendar dates.
    """
    parsed = (
        F.when(is_blank(c), as_of)
        .when(c.rlike(SQL_SECONDS), F.try_to_timestamp(F.concat(c, F.lit("Z"))))
        .when(c.rlike(RFC_3339), F.try_to_timestamp(F.upper(c)))
        .when(c.rlike(RFC_1123), _rfc_1123_instant(c))
    )
    if mode == "lenient":
        midnight = F.lit("00:00:00")
        parsed = (
            parsed.when(c.rlike(RFC_1123_NAMED), _rfc_1123_instant(c))
            .when(
                c.rlike(US_DATE),
                _utc(F.substring(c, 7, 4), F.substring(c, 1, 2), F.substring(c, 4, 2), midnight),
            )
            .when(
                c.rlike(EU_DATE),
                _utc(F.substring(c, 7, 4), F.substring(c, 4, 2), F.substring(c, 1, 2), midnight),
            )
        )
    return parsed


def parse_iso(c: Column) -> Column:
    """ISO-8601 date or date-time text, ``Z`` or offset or none (then UTC); else NULL."""
    return F.when(c.rlike(_ISO_LIKE), F.try_to_timestamp(c))


def rfc3339(ts: Column) -> Column:
    """Instant as RFC 3339 text in UTC, with 0, 3 or 6 fraction digits as needed."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = (
        F.when(micros == 0, F.lit(""))
        .when(micros % 1000 == 0, F.date_format(ts, ".SSS"))
        .otherwise(F.date_format(ts, ".SSSSSS"))
    )
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def rfc3339_seconds(ts: Column) -> Column:
    """Instant as RFC 3339 text in whole seconds, ``Z`` suffix."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def from_time_parts(parts: Column) -> Column:
    """``[year, month, day, hour, minute, second, ...]`` in UTC to an instant."""
    p = [F.get(parts, i).cast("string") for i in range(6)]
    two = [F.lpad(x, 2, "0") for x in p]
    time = F.concat_ws(":", two[3], two[4], two[5])
    return F.when(
        F.size(parts) >= 6, _utc(F.lpad(p[0], 4, "0"), two[1], two[2], time)
    )


def drop_zero_time(ts: Column) -> Column:
    """An unset time is sent as year 1; make it NULL."""
    return F.when(F.year(ts) > 1, ts)
