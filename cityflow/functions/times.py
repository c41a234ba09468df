"""ISO-8601 text to timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)"
_TIME = r"T\d{2}(:\d{2}(:\d{2}([.,]\d{1,30})?)?)?" + _ZONE + "?"
_CALENDAR = r"^\d{4}(-\d{2}(-\d{2}(" + _TIME + r")?)?)?$"
_BASIC = r"^\d{8}(T\d{2}(\d{2}(\d{2}([.,]\d{1,30})?)?)?" + _ZONE + "?)?$"


def iso_timestamp(text: Column) -> Column:
    """Timestamp (millisecond precision) of an ISO-8601 text, UTC when it names no offset, else NULL.

    Accepts calendar dates of any precision, with hour, minute, second or fraction, and `Z`, `+02`,
    `+0200`, `+02:00`; also the basic form without separators. Week dates (`2031-W05-3`), ordinal dates (`2031-123`), both
    with or without separators, and midnight at the end of a day (`T24:00`) are first written as the calendar date they mean.
    """
    # Arrays of one, so that a text is made once and not wherever it is used.
    return F.get(F.transform(F.array(text), _any_timestamp), 0)


def _any_timestamp(text: Column) -> Column:
    # Few texts are of the rarer forms, so the rest only pays for one look at the first characters.
    written = F.when(text.rlike(_RARE), _as_calendar(text)).otherwise(text)
    other = F.get(F.transform(F.array(written), _calendar_timestamp), 0)
    # Most texts are what the cast takes as it is.
    return F.when(text.rlike(_USUAL), to_milliseconds(text.try_cast("timestamp"))).otherwise(other)


# Date, time to the second or a fraction of it, and offset.
_USUAL = r"^\d{4}-\d{2}-\d{2}T([01]\d|2[0-3]):\d{2}:\d{2}(\.\d{1,30})?(Z|[+-]\d{2}:\d{2})?$"


# A week or ordinal date, or an hour 24.
_RARE = r"^\d{4}(-?W\d|-?\d{3}(T|$)|[^T]*T24)"
_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?(T.*)?$"
_ORDINAL = r"^(\d{4})-?(\d{3})(T.*)?$"
_END_OF_DAY = r"^([^T]*)T24(:?00(?::?00(?:[.,]0+)?)?)?(Z|[+-].*)?$"


def _as_calendar(text: Column) -> Column:
    """A text of one of the rarer forms as a calendar date with what follows it; what means no day is NULL."""
    part = lambda pattern, k: F.regexp_extract(text, pattern, k)
    number = lambda pattern, k: part(pattern, k).try_cast("int")
    # Week 1 is the one with the fourth of January, and begins on its Monday.
    year, week = number(_WEEK, 1), number(_WEEK, 2)
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(fourth, F.weekday(fourth))
    last = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    of_week = F.when(week.between(1, last), F.date_add(monday, (week - 1) * 7 + F.coalesce(number(_WEEK, 3), F.lit(1)) - 1))
    first = F.make_date(number(_ORDINAL, 1), F.lit(1), F.lit(1))
    nth = number(_ORDINAL, 2)
    of_year = F.when(nth.between(1, F.dayofyear(F.make_date(number(_ORDINAL, 1), F.lit(12), F.lit(31)))), F.date_add(first, nth - 1))
    dated = (
        F.when(text.rlike(_WEEK), F.concat(of_week.cast("string"), part(_WEEK, 4)))
        .when(text.rlike(_ORDINAL), F.concat(of_year.cast("string"), part(_ORDINAL, 3)))
        .otherwise(text)
    )
    # The end of a day is the start of the next one.
    day = F.regexp_replace(F.regexp_extract(dated, _END_OF_DAY, 1), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date")
    over = F.concat(F.date_add(day, 1).cast("string"), F.lit("T00:00:00"), F.regexp_extract(dated, _END_OF_DAY, 3))
    return F.when(dated.rlike(_END_OF_DAY), over).otherwise(dated)


def _calendar_timestamp(text: Column) -> Column:
    spread = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    spread = F.regexp_replace(spread, r"T(\d{2})(\d{2})", "T$1:$2")
    spread = F.regexp_replace(spread, r"(T\d{2}:\d{2})(\d{2})", "$1:$2")
    calendar = F.when(text.rlike(_BASIC), spread).when(text.rlike(_CALENDAR), text)
    # The cast wants seconds before a zone and a point before the fraction.
    timed = F.regexp_replace(calendar, r"T(\d{2})(Z|[+-]|$)", "T$1:00$2")
    timed = F.regexp_replace(timed, r"(T\d{2}:\d{2})(Z|[+-])", "$1:00$2")
    timed = F.translate(timed, ",", ".")
    return to_milliseconds(timed.try_cast("timestamp"))


def to_milliseconds(ts: Column) -> Column:
    """Timestamp cut to whole milliseconds."""
    return F.timestamp_millis(F.unix_millis(ts))


def iso_text(ts: Column) -> Column:
    """ISO-8601 text of a timestamp with milliseconds, in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
