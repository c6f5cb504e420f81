"""Guarded casts: text to a typed value, NULL when the text is not one.

Spark's own try_cast is wider than the data means: it reads '2024' as a date and ignores what
follows a date. Each cast therefore checks the shape first. Surrounding blanks are ignored.
Everything here is a built-in column expression, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted shapes. \z and not $, which also matches before a final newline.
TEMPORAL_SHAPE = r"^ *\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,6}0*)?)?)? *\z"
NUMERIC_SHAPE = r"^ *[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d{1,6})? *\z"
CLOCK_SHAPE = r"^ *(\d{1,2}|[1-9]\d{2,7}):([0-5]\d)(?::([0-5]\d(?:\.\d{1,6}0*)?))? *\z"
TIME_OF_DAY_SHAPE = r"^ *(([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?|24:00(:00(\.0{1,6})?)?) *\z"

# Numbers without an exponent that need no rounding, whatever their digits are: most there are.
PLAIN_NUMBER = r"^ *[+-]?\d{1,28}(\.\d{0,10})? *\z"

NUMERIC_SCALE = 10
NUMERIC_TYPE = f"decimal(38,{NUMERIC_SCALE})"
EXPONENT = r"[eE]([+-]?\d+)"
FRACTION = r"\.(\d*[1-9])0*(?:[eE ]|\z)"
WHOLE_ZEROS = r"^[^.eE]*?(0+)(?:\.0*)?(?:[eE ]|\z)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_ts(c: str | Column) -> Column:
    """Timestamp without zone. A zone suffix is refused rather than silently dropped."""
    text = _col(c)
    return F.when(text.rlike(TEMPORAL_SHAPE), text.try_cast("timestamp_ntz"))


def try_date(c: str | Column) -> Column:
    """Date. A timestamp is accepted if all of it is valid, and loses its time."""
    return try_ts(c).cast("date")


def try_numeric(c: str | Column) -> Column:
    """A number that the type holds exactly. One with more decimals is refused rather than rounded.

    Plain numbers cost one pattern. Decimals are counted for the others alone, in a lambda, which is evaluated outside
    the generated code, so that a wide projection stays small enough for the JVM to compile.
    """
    text = _col(c)

    def counted(v: Column) -> Column:
        return F.when(_decimals(v) <= NUMERIC_SCALE, v.try_cast(NUMERIC_TYPE))

    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast(NUMERIC_TYPE)).when(
        text.rlike(NUMERIC_SHAPE), F.element_at(F.transform(F.array(text), counted), 1)
    )


def _decimals(text: Column) -> Column:
    """Decimals that a number's text needs, trailing zeros aside; below zero for whole hundreds and so on."""
    exponent = F.coalesce(F.regexp_extract(text, EXPONENT, 1).try_cast("int"), F.lit(0))
    fraction = F.length(F.regexp_extract(text, FRACTION, 1))
    zeros = F.length(F.regexp_extract(text, WHOLE_ZEROS, 1))
    return F.when(fraction > 0, fraction).otherwise(-zeros) - exponent


def _clock_parts(c: str | Column) -> tuple[Column, Column, Column]:
    """Hours, minutes and seconds of text that has the clock shape."""
    parts = [F.split_part(F.trim(_col(c)), F.lit(":"), F.lit(i)) for i in (1, 2, 3)]
    return (
        parts[0].try_cast("int"), parts[1].try_cast("int"),
        F.coalesce(parts[2].try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)")),
    )


def clock_seconds(c: str | Column) -> Column:
    """Seconds since midnight as decimal(18,6); hours beyond 24 are allowed and mean a duration."""
    hours, minutes, seconds = _clock_parts(c)
    total = (hours.cast("bigint") * 3600 + minutes * 60 + seconds).cast("decimal(18,6)")
    return F.when(_col(c).rlike(CLOCK_SHAPE), total)


def parse_clock(c: str | Column) -> Column:
    """H:mm or H:mm:ss as an interval; hours beyond 24 are kept."""
    hours, minutes, seconds = _clock_parts(c)
    return F.when(
        _col(c).rlike(CLOCK_SHAPE), F.make_dt_interval(F.lit(0), hours, minutes, seconds)
    )


def clock_text(c: str | Column) -> Column:
    """Canonical HH:mm:ss for a time of day up to and including 24:00:00, otherwise NULL.

    A fraction of a second is kept, without trailing zeros.
    """
    text = F.trim(_col(c))
    shown = (
        F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit(".")))
        .when(F.length(text) <= 5, F.concat(text, F.lit(":00")))
        .otherwise(text)
    )
    padded = F.when(F.substr(shown, F.lit(2), F.lit(1)) == ":", F.concat(F.lit("0"), shown)).otherwise(shown)
    return F.when(_col(c).rlike(TIME_OF_DAY_SHAPE), padded)


def clock_kind(c: str | Column) -> Column:
    """clock, over24h, invalid or empty: a time of day, a duration or typing error, or no time."""
    text = _col(c)
    return (
        F.when(~set_flag(text), "empty")
        .when(text.rlike(TIME_OF_DAY_SHAPE), "clock")
        .when(text.rlike(CLOCK_SHAPE), "over24h")
        .otherwise("invalid")
    )


def set_flag(c: str | Column) -> Column:
    """True when the value holds anything but spaces; never NULL. A tab counts as set."""
    return F.nullif(F.trim(_col(c)), F.lit("")).isNotNull()
