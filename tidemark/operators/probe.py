"""Verdicts on which tables can be read, from a log of read attempts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.casts import _col
from tidemark.functions.text import collapse_spaces
from tidemark.operators.profile import newest_per
from tidemark.sources.scan import ntz

# What the source's own error codes and SQLSTATEs mean.
MISSING_CODES = (100, 105, 802)
DENIED_CODES = (204, 212, 213)
ERROR_CODES = (101,)
LINK_STATES = ("08S01", "08003", "08001", "HY000")
TIMEOUT_STATES = ("HYT00", "HYT01")
TRAILING_CODE = r"\((\d+)\)\s*(\(SQL\w+\))?\s*\z"

STATUSES = ("ok", "missing", "denied", "timeout", "error")


def native_code(message: str | Column) -> Column:
    """The source's own code: the number in the last parentheses of its message."""
    return F.regexp_extract(collapse_spaces(message), TRAILING_CODE, 1).try_cast("int")


def probe_classify(log: DataFrame, sqlstate: str = "sqlstate", message: str = "message") -> DataFrame:
    """Add status and native_error to each failed attempt; the message loses repeated blanks.

    The tests apply in this order: lost link, timeout, known code, wording, error. 'link' asks for a
    reconnect and is no verdict about the table.
    """
    text = collapse_spaces(message)
    native = native_code(message)
    lower = F.lower(text)
    status = (
        F.when(_col(sqlstate).isin(*LINK_STATES) & lower.contains("link failure"), "link")
        .when(_col(sqlstate).isin(*TIMEOUT_STATES), "timeout")
        .when(native.isin(*MISSING_CODES), "missing")
        .when(native.isin(*DENIED_CODES), "denied")
        .when(native.isin(*ERROR_CODES), "error")
        .when(lower.contains("not permitted") | lower.contains("denied"), "denied")
        .otherwise("error")
    )
    return log.withColumns({"status": status, "native_error": native, message: text})


def probe_latest(probes: DataFrame) -> DataFrame:
    """The newest verdict per table, not per run: a narrow re-probe must not hide the full sweep."""
    return newest_per(probes, "source_table", "probed_at")


def readable_tables(latest: DataFrame) -> DataFrame:
    return latest.filter("readable").select(
        "source_table", "column_count", "has_rows", "elapsed_ms", "probed_at"
    )


def unreadable_tables(latest: DataFrame) -> DataFrame:
    return latest.filter("not readable").select(
        "source_table", "status", "native_error", "message", "probed_at"
    )


def probe_tally(probes: DataFrame) -> DataFrame:
    return probes.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def like_pattern(pattern: str) -> str:
    return "(?iu)" + pattern.replace("%", ".*").replace("_", ".")


def catalog_like(names: DataFrame, pattern: str, column: str = "table_name") -> DataFrame:
    """Names matching a LIKE-style pattern: any case, anywhere in the name."""
    return names.filter(F.col(column).rlike(like_pattern(pattern)))


def record_probe(wh, probes: DataFrame, probed_at: dt.datetime) -> None:
    """Append one probe run; all its rows share one ``probed_at``."""
    wh.append_state("table_probe", probes.withColumn("probed_at", ntz(probed_at)))
