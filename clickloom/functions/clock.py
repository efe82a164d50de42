"""Calendar arithmetic on zone-less timestamps.

All of it works on the wall-clock fields of TIMESTAMP_NTZ, so results do not depend on
``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T


def epoch_day(ts: Column) -> Column:
    return F.unix_date(ts.cast("date")).cast("bigint")


def epoch_hour(ts: Column) -> Column:
    return epoch_day(ts) * 24 + F.hour(ts)


def epoch_minute(ts: Column) -> Column:
    return epoch_hour(ts) * 60 + F.minute(ts)


def epoch_second(ts: Column) -> Column:
    return epoch_minute(ts) * 60 + F.second(ts)


_UNITS = {"day": epoch_day, "hour": epoch_hour, "minute": epoch_minute, "second": epoch_second}


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries between two timestamps (10:00:59 to 10:30:00 is 30 minutes)."""
    index = _UNITS[unit]
    return index(end) - index(start)


# Date spellings accepted beyond ISO 8601, month before day: (shape, format).
EXTRA_DATE_FORMATS = (
    (r"^[0-9]{1,2}/.*[AaPp][Mm]$", "M/d/yyyy h:mm[:ss] a"),
    (r"^[0-9]{1,2}/", "M/d/yyyy[ H:mm[:ss[.SSS]]]"),
    (r"^[0-9]{4}/", "yyyy/M/d[ H:mm[:ss[.SSS]]]"),
    (r"^[0-9]{1,2} [A-Za-z]", "d MMM yyyy[ H:mm[:ss]]"),
    (r"^[A-Za-z]{3} ", "MMM d, yyyy[ H:mm[:ss]]"),
    (r"^[0-9]{8}$", "yyyyMMdd"),
)
DAY_FIRST_FORMAT = "d/M/yyyy[ H:mm[:ss[.SSS]]]"  # where the first number is no month


def _utc_wall_clock(instant: Column) -> Column:
    return F.timestamp_add(
        "MICROSECOND", F.unix_micros(instant), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    )


def _iso(text: Column) -> Column:
    """ISO 8601 variants in the spelling that casts know: dashes, minutes, a dot before the fraction."""
    text = F.regexp_replace(text, r"^([0-9]{4})([0-9]{2})([0-9]{2})([T ])", "$1-$2-$3$4")
    text = F.regexp_replace(text, r"^([0-9-]+[T ][0-9]{2})([0-9]{2})([0-9]{2})", "$1:$2:$3")
    text = F.regexp_replace(text, r"^([0-9-]+[T ][0-9]{2})([0-9]{2})($|[^0-9])", "$1:$2$3")
    text = F.regexp_replace(text, r"^([0-9-]+[T ][0-9]{1,2})($|[^0-9:])", "$1:00$2")
    return F.regexp_replace(text, r"^([0-9-]+[T ][0-9:]+),([0-9]+)", "$1.$2")


def _zone(text: Column) -> Column:
    """Zones in the spelling that casts know: ``Z``, ``+hh:mm`` or a region's name."""
    offset = F.regexp_replace(text, r"^(?:UTC|GMT)(?=[+-])", "")
    offset = F.regexp_replace(offset, r"^([+-])([0-9])($|:)", "$10$2$3")
    offset = F.regexp_replace(offset, r"^([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    offset = F.regexp_replace(offset, r"^([+-][0-9]{2})$", "$1:00")
    return F.when(F.upper(text) == "Z", "Z").otherwise(offset)


# The shape nearly all stamps have; its only zone is UTC, so a cast that passes over zones reads it right.
CANONICAL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.][0-9]+)?Z?$"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _iso_timestamp(plain: Column) -> Column:
    """ISO 8601 text in plain spelling; a clock time with a zone is converted to UTC."""
    parts = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9:.]+) ?([A-Za-z+-].*)$"

    def zoned(zone: Column) -> Column:
        clock_time = F.regexp_replace(F.regexp_extract(plain, parts, 1), r"^([0-9-]+[T ][0-9]{1,2}:[0-9]{1,2})$", "$1:00")
        whole = F.concat(clock_time, F.when(zone.rlike("^[A-Za-z]{2}"), " ").otherwise(""), _zone(zone))
        return F.when(zone == "", plain.try_cast("timestamp_ntz")).otherwise(_utc_wall_clock(whole.try_cast("timestamp")))

    return _bound(F.regexp_extract(plain, parts, 2), zoned)


def _spelled_timestamp(text: Column) -> Column:
    """Text of any accepted spelling."""
    # the shape picks one format, so other text is refused without a parsing attempt
    spelling = F
    for shape, fmt in EXTRA_DATE_FORMATS:
        spelling = spelling.when(text.rlike(shape), fmt)
    day_first = F.when(text.rlike(r"^(1[3-9]|[23][0-9])/"), DAY_FIRST_FORMAT)
    other = F.try_to_timestamp(text, F.coalesce(day_first, spelling)).cast("timestamp_ntz")
    starts_with_year = text.rlike(r"^[0-9]{4}([^0-9/]|$)|^[0-9]{8}[T ]")
    return F.coalesce(F.when(starts_with_year, _bound(_iso(text), _iso_timestamp)), other)


def parse_timestamp(text: Column) -> Column:
    """Trimmed text to TIMESTAMP_NTZ in UTC, NULL where it is not a date and time.

    An offset or a named zone is converted to UTC; text without a zone is taken as UTC. A zone that
    is unknown makes the text no timestamp, as does time-only text. One look at the shape sends
    canonical text to a cast, and only other text through the rules for further spellings.
    """
    return F.when(text.rlike(CANONICAL), text.try_cast("timestamp_ntz")).otherwise(_spelled_timestamp(text))


def epoch_number_to_timestamp(number: Column) -> Column:
    """Typed numeric epochs: above 1e10 they are milliseconds, else seconds."""
    value = number.cast("double")
    micros = F.when(value > F.lit(1e10), value * 1e3).otherwise(value * 1e6)
    return F.timestamp_add(
        "MICROSECOND", F.round(micros).cast("bigint"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    )


def as_timestamp_ntz(column: Column, data_type: T.DataType) -> Column:
    """Timestamp value of a source column that may be stripped text, typed or numeric."""
    if isinstance(data_type, T.TimestampNTZType):
        return column
    if isinstance(data_type, T.TimestampType):
        return _utc_wall_clock(column)
    if isinstance(data_type, T.NumericType):
        return epoch_number_to_timestamp(column)
    if isinstance(data_type, T.DateType):
        return column.cast("timestamp_ntz")
    return parse_timestamp(column)


# Every whitespace character of Unicode plus the four ASCII separators, as str.isspace() has it.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(column: Column) -> Column:
    """Text without whitespace at its ends; cells that begin and end in plain ASCII pass unread."""
    def may_be_space(char: Column) -> Column:
        return ~F.ascii(char).between(33, 126)

    edges = may_be_space(column) | may_be_space(F.substring(column, -1, 1))
    return F.when(edges, F.trim(column, F.lit(WHITESPACE))).otherwise(column)
