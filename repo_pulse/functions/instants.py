"""Instants: ISO 8601 text with an offset, hour alignment, UTC text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repo_pulse.functions.strict_json import bind

# The shape nearly every archive line has; Spark's cast takes it as it is.
_PLAIN = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z\z"
# Week dates and dates without hyphens, before a time or at the end.
_WEEK = r"\A(\d{4})(?:-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)(?=[^\d-]|\z)"
_BASIC = r"\A(\d{4})(\d{2})(\d{2})(?=\D|\z)"
# Times without colons behind a date of ten characters and a separator.
_BASIC_SECONDS = r"\A(.{11}\d{2})(\d{2})(\d{2}(?:[.,]\d+)?(?:Z|[+-]|\z))"
_BASIC_MINUTES = r"\A(.{11}\d{2})(\d{2})(Z|[+-]|\z)"
# Extended ISO 8601: a date, any one separator, a time, an offset.
_DATE = r"\A\d{4}-\d{2}-\d{2}"
_TIME = r".\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?"
_OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?)"

NAIVE = "datetime must be timezone-aware"


def _week_day(text: Column) -> Column:
    """The date that ISO text with a week date begins with, as text; null if there is no such one.

    Week 1 holds the fourth of January; a week belongs to the year of its Thursday.
    """
    part = lambda *groups: F.concat(
        *[F.regexp_extract(text, _WEEK, group) for group in groups]
    )
    year, week = part(1).try_cast("int"), part(2, 4).try_cast("int")
    day = F.coalesce(part(3, 5).try_cast("int"), F.lit(1))
    first = F.concat(part(1), F.lit("-01-04")).try_cast("date")
    monday = F.date_add(F.date_trunc("week", first).cast("date"), (week - 1) * 7)
    exists = (F.year(F.date_add(monday, 3)) == year) & (week > 0) & day.between(1, 7) & (year > 0)
    return F.when(exists, F.date_format(F.date_add(monday, day - 1), "yyyy-MM-dd"))


def _extended(text: Column) -> Column:
    """ISO 8601 text with its date as year, month and day, and colons in its time."""
    rest = F.regexp_replace(text, _WEEK, "")
    dated = F.when(text.rlike(_WEEK), F.concat(_week_day(text), rest)).otherwise(
        F.regexp_replace(text, _BASIC, "$1-$2-$3")
    )
    timed = F.regexp_replace(dated, _BASIC_SECONDS, "$1:$2:$3")
    return F.regexp_replace(timed, _BASIC_MINUTES, "$1:$2$3")


def parse_instant(text: Column) -> Column:
    """The UTC instant of ISO 8601 text, null where it is not a date-time with an offset.

    Less usual spellings are rewritten into the one Spark's cast takes: `T` as separator, a
    point before the fraction, minutes and seconds present, at most six digits of a second. That
    happens outside generated code, which stays short.
    """
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp")).otherwise(
        bind(_extended(text), _cast_extended)
    )


def _cast_extended(text: Column) -> Column:
    spelled = F.replace(F.overlay(text, F.lit("T"), 11, 1), F.lit(","), F.lit("."))
    spelled = F.regexp_replace(spelled, r"T(\d{2})(Z|[+-])", "T$1:00$2")
    spelled = F.regexp_replace(spelled, r"T(\d{2}:\d{2})(Z|[+-])", "T$1:00$2")
    spelled = F.regexp_replace(spelled, r"(\.\d{6})\d+", "$1")
    return F.when(
        text.rlike(_DATE + _TIME + _OFFSET + r"\z"), spelled.try_cast("timestamp")
    )


def instant_error(text: Column) -> Column:
    """Why `parse_instant` gave null for this text."""
    naive = bind(
        _extended(text),
        lambda full: full.rlike(_DATE + "(" + _TIME + r")?\z")
        & F.substring(full, 1, 10).try_cast("date").isNotNull(),
    )
    return F.when(F.coalesce(naive, F.lit(False)), F.lit(NAIVE)).otherwise(
        F.concat(F.lit("Invalid isoformat string: '"), text, F.lit("'"))
    )


def utc_text(instant: Column) -> Column:
    """`2025-01-02T03:00:00+00:00`, the ISO text of a UTC instant on a full second."""
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
