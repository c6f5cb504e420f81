"""Text rendering: values to staging text, and the cleaning rules for names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.casts import _col

# A word is a run of letters and digits; control characters are dropped from names.
WORD_OR_GAP = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"
CONTROL_CHARACTERS = r"[\x00-\x1F\x7F]"


def number_text(c: str | Column) -> Column:
    """A double as text with a point and no exponent between 1e-4 and 1e16: 12345678.0, 0.0001.

    Outside that range the exponent form is 1e+16 or 1.5e-05; not-a-number is nan, infinity is inf.
    """
    x = _col(c)
    size = F.abs(x)

    def rare(v: Column) -> Column:
        # The digits as they are printed, with the point moved by the exponent: no digit is lost.
        printed = F.abs(v).cast("string")
        digits = F.regexp_replace(F.regexp_extract(printed, r"^([\d.]+)", 1), r"\.0?\z|\.", "")
        exponent = F.regexp_extract(printed, r"E(-?\d+)", 1).try_cast("int")
        whole = F.rpad(F.substr(digits, F.lit(1), exponent + 1), exponent + 1, F.lit("0"))
        rest = F.substr(digits, exponent + 2)
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), F.regexp_replace(digits, r"(\d)0+\z", "$1"))
        large = F.concat(whole, F.lit("."), F.when(F.length(rest) > 0, rest).otherwise("0"))
        plain = F.concat(F.when(v < 0, "-").otherwise(""), F.when(exponent < 0, small).otherwise(large))
        other = v.cast("string")
        for pattern, shown in ((r"\.0E", "E"), (r"E(-?)(\d)\z", "E$10$2"), (r"E(?=\d)", "e+"), (r"E", "e"),
                               (r"NaN", "nan"), (r"Infinity", "inf")):
            other = F.regexp_replace(other, pattern, shown)
        return F.when((F.abs(v) >= 1e-4) & (F.abs(v) < 1e16), plain).otherwise(other)

    # From 1e7 on a double prints at most nine decimals, so the decimal holds what is printed.
    large = F.rtrim(x.try_cast("decimal(26,9)").cast("string"), F.lit("0"))
    large = F.when(large.endswith("."), F.concat(large, F.lit("0"))).otherwise(large)
    # The rare forms sit in a lambda, which is evaluated outside the generated code: with them
    # inline, a few numeric columns make one method too large for the JVM to compile.
    return (
        F.when((x == 0) | ((size >= 1e-3) & (size < 1e7)), x.cast("string"))
        .when((size >= 1e7) & (size < 1e16), large)
        .otherwise(F.element_at(F.transform(F.array(x), rare), 1))
    )


def initcap(c: str | Column) -> Column:
    """Upper-case the first character of every run of letters and digits, lower-case the rest.

    Spark's built-in starts a word only after white space; here O'neil becomes O'Neil.
    """

    def raised(part: Column) -> Column:
        first = F.substr(part, F.lit(1), F.lit(1))
        # A character whose upper case is two characters (the German sharp s) stays as it is.
        upper = F.when(F.length(F.upper(first)) == 1, F.upper(first)).otherwise(first)
        return F.concat(upper, F.substr(part, F.lit(2)))

    parts = F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD_OR_GAP), F.lit(0))
    return F.array_join(F.transform(parts, raised), "")


def clean_name(c: str | Column) -> Column:
    return F.regexp_replace(initcap(c), CONTROL_CHARACTERS, "")


def row_hash(*columns: str | Column) -> Column:
    """A hash of a row. The hash function skips NULLs, so where they are is hashed as well."""
    cols = [_col(c) for c in columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def collapse_spaces(c: str | Column) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def quote_name(c: str | Column) -> Column:
    return F.concat(F.lit('"'), _col(c), F.lit('"'))
