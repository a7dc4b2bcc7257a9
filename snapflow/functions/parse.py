"""Column expressions that turn raw text cells into typed values.

All of them give null for what they cannot read, whatever the session's ANSI setting.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: accepted date spellings; the first that matches wins ---
DATE_FORMATS: tuple[str, ...] = ("yyyy.MM.dd", "yyyy-MM-dd", "yy.dd.MM", "MM/dd/yyyy")

# --- fixed values: publish-time spellings, plain and with fractions of seconds or +07:00 offsets ---
PUBLISH_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
DETAILED_PUBLISH_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"

WHITESPACE = " \t\n\r\f\v"


def read_number(df: DataFrame, name: str) -> Column:
    """Double value of column ``name``; thousands separators are dropped from text.  What is not a plain number is null.

    Spark's cast also takes words such as ``NaN`` and ``Infinity``, Java's suffixes (``5d``) and hexadecimal texts.  None of
    them starts and ends like a plain number and has no x, so three looks at the text replace a pattern.
    What is too large for a double is infinite; :func:`finite` turns it to null.
    """
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name).cast("double")
    digits = F.trim(F.replace(F.col(name).cast("string"), F.lit(","), F.lit("")))
    plain = F.substring(digits, 1, 1).between("+", "9") & F.substring(digits, -1, 1).between(".", "9")
    return F.when(plain & ~F.contains(F.lower(digits), F.lit("x")), digits.try_cast("double"))


def finite(number: Column) -> Column:
    """The number, or null if it is infinite or not a number.  Refers to it twice: give it a column that is made already."""
    return F.when(F.abs(number) < float("inf"), number)


def clean_number(df: DataFrame, name: str) -> Column:
    """:func:`read_number` and :func:`finite` in one expression, for a column that is a number already or is read once."""
    return finite(read_number(df, name))


def text_or_default(value: Column, default: str = "") -> Column:
    return F.coalesce(value.cast("string"), F.lit(default))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def parse_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date in the first of ``formats`` that fits.

    A failed parse costs an exception inside Spark, so a format is only tried on text of its own
    length with its first separator in the right place.
    """

    def fits(fmt: str) -> Column:
        place = re.search("[^a-zA-Z]", fmt).start()
        return (F.length(value) == len(fmt)) & (F.substring(value, place + 1, 1) == fmt[place])

    return F.coalesce(*[F.when(fits(fmt), F.try_to_date(value, fmt)) for fmt in formats])


def parse_publish_time(value: Column) -> Column:
    """Timestamp of an ISO text, else of whatever Spark's own cast takes; a text without a zone is UTC.

    The same rule in batch and stream, whatever the session's time zone.
    """
    text = blank_to_null(value)
    # Date and time take 19 characters in both spellings; what follows tells them apart.
    detailed = (F.substring(text, 20, 1) == ".") | (F.substring(text, 23, 1) == ":")
    parsed = F.when(detailed, F.try_to_timestamp(text, F.lit(DETAILED_PUBLISH_FORMAT))).otherwise(
        F.try_to_timestamp(text, F.lit(PUBLISH_FORMAT))
    )
    zoned = F.concat(text, F.when(F.length(text) == 10, F.lit("T00:00:00Z")).otherwise(F.lit("Z")))
    return F.coalesce(parsed, zoned.try_cast("timestamp"), text.try_cast("timestamp"))


def with_parsed_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like ``withColumns``, but a later filter on these columns stays above them.

    Catalyst pushes a filter below a projection and repeats the column's expression there, so each
    cell would be parsed twice.  It does not push one below a generator; the one-element array
    makes exactly one row of each.
    """
    rest = [name for name in df.columns if name not in columns]
    parsed = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*rest, F.inline(F.array(parsed)))


def as_timestamp(df: DataFrame, name: str, zone: str = "UTC") -> Column:
    """Column ``name`` as timestamp: text is parsed, a date or a time without zone is one of ``zone``."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return parse_publish_time(value)
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        clock = value.cast("timestamp_ntz")
        second = F.extract(F.lit("SECOND"), clock)
        return F.make_timestamp(
            F.year(clock), F.month(clock), F.day(clock), F.hour(clock), F.minute(clock), second, F.lit(zone)
        )
    return value.cast("timestamp")


def clock_hour(moment: Column, zone: str = "UTC") -> Column:
    """Hour of the day (0 to 23) in ``zone``, whatever the session's time zone."""
    return F.pmod(F.floor(F.unix_seconds(F.from_utc_timestamp(moment, zone)) / 3600), F.lit(24)).cast("int")


def clock_weekday(moment: Column, zone: str = "UTC") -> Column:
    """Day of the week in ``zone``, 1 = Sunday, whatever the session's time zone."""
    days = F.floor(F.unix_seconds(F.from_utc_timestamp(moment, zone)) / 86400)
    return (F.pmod(days + 4, F.lit(7)) + 1).cast("int")  # day 0 was a Thursday


def normalize_country(value: Column) -> Column:
    return F.upper(F.btrim(value, F.lit(WHITESPACE)))
