"""Sources in text formats and ORC, written from a test table with broken lines among the sound ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.facts import record_refused_lines
from tidemark.queries.registry import at, query, table
from tidemark.sources.scan import read_source, scan_text
from tidemark.sources.store import Warehouse, shared_folder

SCHEMA = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderstatus string"
_COLUMNS = "o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus"
# Of ten orders one line each breaks off, holds a word for a number, or has a field too many (csv) or no end (json).
_SOUND = "o_orderkey % 10 NOT IN (3, 5, 7)"


def _csv_lines(orders):
    key, customer, price, date, status = (F.col(c).cast("string") for c in _COLUMNS.split(", "))
    comma = F.lit(",")
    start = F.concat(key, comma, customer, comma)
    return orders.select(
        F.when(F.col("o_orderkey") % 10 == 3, F.concat(key, comma, customer))
        .when(F.col("o_orderkey") % 10 == 5, F.concat(start, F.lit("n/a,"), date, comma, status))
        .when(F.col("o_orderkey") % 10 == 7, F.concat(start, price, comma, date, comma, status, F.lit(",left over")))
        .otherwise(F.concat(start, price, comma, date, comma, F.lit('"'), status, F.lit('"'))).alias("value")
    )


def _json_lines(orders):
    key = F.col("o_orderkey").cast("string")
    sound = F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderstatus"))
    return orders.select(
        F.when(F.col("o_orderkey") % 10 == 3, F.concat(F.lit('{"o_orderkey": '), key))
        .when(F.col("o_orderkey") % 10 == 5, F.concat(F.lit('{"o_orderkey": '), key, F.lit(', "o_totalprice": "n/a"}')))
        .when(F.col("o_orderkey") % 10 == 7, F.concat(F.lit("order "), key))
        .otherwise(sound).alias("value")
    )


def _text_source(spark, sf, fmt: str):
    """The orders as lines of text, read back."""
    folder = shared_folder(spark, f"scan-{fmt}")
    lines = {"csv": _csv_lines, "json": _json_lines}[fmt](table(spark, sf, "orders"))
    lines.write.text(f"{folder}/source")
    return Warehouse(spark, folder), scan_text(spark, fmt, f"{folder}/source", SCHEMA, f"{folder}/read")


def _refused(spark, sf, fmt: str):
    wh, scan = _text_source(spark, sf, fmt)
    record_refused_lines(wh, "ORDERS", fmt, scan.refused, "run-1", at("2024-03-01"))
    return wh.state("parse_errors")


@query(f"SELECT {_COLUMNS} FROM orders WHERE {_SOUND}")
def scan_csv(spark, sf):
    return _text_source(spark, sf, "csv")[1].rows


@query(f"SELECT {_COLUMNS} FROM orders WHERE {_SOUND}")
def scan_json(spark, sf):
    return _text_source(spark, sf, "json")[1].rows


def _refused_sql(fmt: str, broken: str, typed: str, other: str) -> str:
    return f"""SELECT 'run-1' AS run_id, 'ORDERS' AS source_table, CAST(NULL AS VARCHAR) AS source_column, CAST(NULL AS VARCHAR) AS row_key,
        CASE o_orderkey % 10 WHEN 3 THEN {broken} WHEN 5 THEN {typed} ELSE {other} END AS raw_value,
        'not a {fmt} record' AS error_type, TIMESTAMP '2024-03-01' AS logged_at FROM orders WHERE NOT ({_SOUND})"""


@query(_refused_sql(
    "csv", "o_orderkey || ',' || o_custkey", "o_orderkey || ',' || o_custkey || ',n/a,' || o_orderdate || ',' || o_orderstatus",
    "o_orderkey || ',' || o_custkey || ',' || o_totalprice || ',' || o_orderdate || ',' || o_orderstatus || ',left over'",
))
def refused_csv(spark, sf):
    """Each broken line of the csv source in the table of parse errors, as it was."""
    return _refused(spark, sf, "csv")


@query(_refused_sql(
    "json", """'{"o_orderkey": ' || o_orderkey""", """'{"o_orderkey": ' || o_orderkey || ', "o_totalprice": "n/a"}'""", "'order ' || o_orderkey",
))
def refused_json(spark, sf):
    return _refused(spark, sf, "json")


@query(f"SELECT {_COLUMNS} FROM orders")
def scan_orc(spark, sf):
    """A typed format: a file that can be read holds no broken record."""
    folder = shared_folder(spark, "scan-orc")
    table(spark, sf, "orders").write.orc(f"{folder}/source")
    return read_source(spark, "orc", f"{folder}/source", SCHEMA)
