"""The query registry and the frames that several queries derive from the tables."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.casts import CLOCK_SHAPE, EXPONENT, FRACTION, NUMERIC_SCALE, NUMERIC_SHAPE, TEMPORAL_SHAPE, WHOLE_ZEROS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with the SQL that should give the same rows."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- derived frames: one SQL text for both engines ----------------------------------------------
# {plus_s ...} and {plus_us ...} stand for what the engines spell differently.

_FRAMES = {
    # A text history of incidents: several versions per customer, unparsable and missing
    # modification times, rows without a key, over-long times, blanks in flags.
    "incident_history": """
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS __key_incident,
               concat('B', CAST(o_orderkey AS STRING)) AS bltr,
               o_orderstatus AS call_type, o_orderpriority AS call_source,
               CAST(o_orderdate AS STRING) AS creation_date_timestamp,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'unknown'
                    ELSE CAST(o_orderdate AS STRING) END AS modification_date_timestamp,
               o_orderpriority AS crime_type,
               CASE o_orderkey % 5 WHEN 0 THEN '2024-02-30' WHEN 1 THEN NULL
                    ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS date_occurred,
               CASE o_orderkey % 6 WHEN 0 THEN '26:10:00' WHEN 1 THEN '24:00:00' WHEN 2 THEN '9:05'
                    WHEN 3 THEN '10:61' WHEN 4 THEN '' ELSE '23:59:59' END AS time_occurred,
               substr(CAST(o_orderdate AS STRING), 1, 10) AS "date",
               CASE o_orderkey % 3 WHEN 0 THEN '08:30' WHEN 1 THEN '08:30:15.250' END AS time_received,
               CASE o_orderkey % 7 WHEN 0 THEN 'later' ELSE '12:00:00' END AS time_dispatched,
               o_orderstatus AS finalisation_status,
               concat('village ', CAST(o_custkey % 40 AS STRING)) AS village,
               CAST(o_custkey % 9 AS STRING) AS section, CAST(NULL AS STRING) AS location,
               concat(CAST(o_custkey % 100 AS STRING), ' main street') AS location_of_incident_street,
               '' AS location_of_incident_other,
               CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN ' Yes ' END AS alcohol,
               CASE o_orderkey % 5 WHEN 0 THEN 'Yes' END AS domestic,
               CASE o_orderkey % 6 WHEN 0 THEN ' ' ELSE 'x' END AS narcotics_flag,
               CASE o_orderkey % 6 WHEN 1 THEN 'other' END AS narcotics_type,
               CASE o_orderkey % 7 WHEN 0 THEN 'No' END AS mental_health,
               CASE o_orderkey % 2 WHEN 0 THEN '' ELSE 'Yes' END AS significant,
               {plus_s 2024-01-01 00:00:00|o_orderkey} AS loaded_at
        FROM orders""",
    # A text history of charges: (order, line) repeats, so some charges have several versions.
    "charge_history": """
        SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS __pkeycharge_id,
               concat('A', CAST(l_orderkey AS STRING)) AS "arrest_#",
               CAST(l_shipdate AS STRING) AS creation_timestamp,
               concat('user ', CAST(l_suppkey AS STRING)) AS created_by,
               CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_shipdate AS STRING) END AS modification_timestamp,
               CAST(l_orderkey AS STRING) AS _fk_incident, CAST(l_partkey AS STRING) AS _fkeynyslaw_id,
               CAST(l_suppkey AS STRING) AS _fkeyarrest_id,
               CAST(l_partkey % 50 AS STRING) AS code, l_returnflag AS class,
               concat('offense ', CAST(l_partkey % 20 AS STRING)) AS offense,
               CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN 'Yes' END AS attempt,
               concat('judge ', CAST(l_suppkey % 5 AS STRING)) AS judge,
               CASE l_partkey % 4 WHEN 0 THEN '2024-13-01' ELSE substr(CAST(l_shipdate AS STRING), 1, 10) END AS disp_date,
               l_linestatus AS disp_sentence,
               CASE l_linenumber % 2 WHEN 0 THEN '  ' ELSE 'x' END AS conviction,
               CASE l_suppkey % 6 WHEN 0 THEN 'two' WHEN 1 THEN NULL ELSE CAST(l_quantity AS STRING) END AS counts,
               {plus_us 2024-01-01 00:00:00|l_partkey * 4096 + l_suppkey} AS loaded_at
        FROM lineitem""",
    # Text as a loosely typed source delivers it.
    "dirty_text": """
        SELECT event_id, CASE event_id % 16
                 WHEN 0 THEN CAST(ts AS STRING) WHEN 1 THEN substr(CAST(ts AS STRING), 1, 10)
                 WHEN 2 THEN '2024-02-30' WHEN 3 THEN '2024' WHEN 4 THEN '2024-01-02Tgarbage'
                 WHEN 5 THEN 'today' WHEN 6 THEN '10:20' WHEN 7 THEN '24:00:00' WHEN 8 THEN '26:10:00'
                 WHEN 9 THEN CAST(value AS STRING) WHEN 10 THEN '' WHEN 12 THEN ' Yes '
                 WHEN 13 THEN concat(CAST(event_id % 30 AS STRING), ':', CAST(event_id % 59 AS STRING), ':07')
                 WHEN 14 THEN '  ' WHEN 15 THEN '2024-01-02T9:05' END AS raw
        FROM events""",
    # A column of each kind a profile has to tell apart.
    "mixed_columns": """
        SELECT CAST(o_orderkey AS STRING) AS __pkey_order, concat('N', CAST(o_orderkey AS STRING)) AS alternate_no,
               CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN NULL
                    ELSE concat('name ', CAST(o_custkey AS STRING)) END AS name,
               CASE WHEN o_orderkey % 2 = 0 THEN '' END AS "never filled",
               CASE WHEN o_orderkey % 5 = 0 THEN '  ' END AS blanks,
               CASE WHEN o_orderkey % 10 = 0 THEN 'same' END AS constant,
               CASE WHEN o_orderkey = 7 THEN 'only' END AS one,
               CAST(o_orderdate AS STRING) AS last_modified_ts, CAST(o_orderdate AS STRING) AS credit_ts,
               CAST(o_orderdate AS STRING) AS created_ts, CAST(o_orderdate AS STRING) AS seen_ts,
               substr(CAST(o_orderdate AS STRING), 1, 10) AS day,
               CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END AS price
        FROM orders""",
    # A log of runs and of their table runs, four tables to a run.
    "run_log": """
        SELECT CAST(o_orderkey AS STRING) AS run_id, {plus_s 2024-01-01 00:00:00|o_orderkey * 60} AS started_at,
               CASE WHEN o_custkey % 9 <> 0 THEN {plus_s 2024-01-01 00:00:00|o_orderkey * 60 + o_custkey} END AS finished_at,
               {plus_s 2024-01-01 00:00:00|o_orderkey * 60} AS watermark_to,
               CASE WHEN o_custkey % 9 = 0 THEN 'running' WHEN o_custkey % 9 = 1 THEN 'failed' ELSE 'succeeded' END AS status,
               CASE WHEN o_custkey % 9 = 1 THEN 'tables failed' END AS error_message,
               o_orderkey % 50 = 0 AS dry_run
        FROM orders""",
    "table_run_log": """
        SELECT CAST(o_orderkey - o_orderkey % 4 AS STRING) AS run_id,
               concat('table_', CAST(o_orderkey % 4 AS STRING)) AS source_table,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS watermark_from,
               100 + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS source_row_count, 100 AS extracted_row_count,
               100 - CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS staged_row_count,
               100 - CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS loaded_row_count,
               CASE o_orderkey % 19 WHEN 0 THEN 'failed' WHEN 1 THEN 'drift' WHEN 2 THEN 'unheard of' ELSE 'succeeded' END AS status,
               CASE WHEN o_orderkey % 19 = 0 THEN 'counts do not reconcile' END AS error_message
        FROM orders""",
    # A log of read attempts: the driver's message for each kind of failure.
    "probe_log": """
        SELECT concat('TABLE_', CAST(user_id AS STRING)) AS source_table, ts AS probed_at, event_id,
               CASE event_id % 10 WHEN 0 THEN '08S01' WHEN 1 THEN 'HYT00' WHEN 2 THEN 'HY000' WHEN 8 THEN NULL ELSE '42000' END AS sqlstate,
               CASE event_id % 10 WHEN 0 THEN 'Communication  link failure' WHEN 1 THEN 'timed out (100)'
                    WHEN 2 THEN '[driver] file is missing   (802) (SQLExecDirectW)' WHEN 3 THEN 'table is missing (100)'
                    WHEN 4 THEN 'access (204)' WHEN 5 THEN 'record missing (101)'
                    WHEN 6 THEN 'Not Permitted here (9) (SQLExecDirectW)' WHEN 7 THEN 'odd (99999999999)'
                    WHEN 8 THEN NULL ELSE ' something else ' END AS message,
               event_id % 10 >= 8 AS readable
        FROM events""",
}

_TOKEN = re.compile(r"\{(plus_s|plus_us) ([^|}]*)\|([^}]*)\}")


def _spell(text: str, spark_sql: bool) -> str:
    def one(m):
        literal = f"{'TIMESTAMP_NTZ' if spark_sql else 'TIMESTAMP'} '{m[2]}'"
        micro = m[1] == "plus_us"
        if spark_sql:
            seconds = f"CAST(({m[3]}) * 0.000001 AS DECIMAL(18,6))" if micro else m[3]
            return f"({literal} + make_dt_interval(0, 0, 0, {seconds}))"
        return f"({literal} + to_{'micro' if micro else ''}seconds(CAST({m[3]} AS BIGINT)))"

    text = _TOKEN.sub(one, text)
    return re.sub(r'"([^"]*)"', r"`\1`", text) if spark_sql else text


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = _spell(_FRAMES[name], True)
    base = re.search(r"FROM (\w+)", text).group(1)
    return spark.sql(re.sub(rf"FROM {base}\b", f"FROM {{{base}}}", text), **{base: table(spark, sf_dir, base)})


def frame_sql(name: str) -> str:
    """The same frame as a subquery for the SQL side."""
    return "(" + _spell(_FRAMES[name], False) + ")"


# -- SQL spellings of the guarded casts ----------------------------------------------------------


def _re2(pattern: str) -> str:
    return pattern.replace(r"\z", "$")


def sql_ts(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}, ' '), '{_re2(TEMPORAL_SHAPE)}') THEN TRY_CAST(trim({x}, ' ') AS TIMESTAMP) END"


def sql_date(x: str) -> str:
    return f"CAST({sql_ts(x)} AS DATE)"


def sql_numeric(x: str) -> str:
    t = f"trim({x}, ' ')"
    fraction, zeros = (f"length(regexp_extract({t}, '{_re2(p)}', 1))" for p in (FRACTION, WHOLE_ZEROS))
    exponent = f"coalesce(TRY_CAST(nullif(regexp_extract({t}, '{EXPONENT}', 1), '') AS INT), 0)"
    decimals = f"CASE WHEN {fraction} > 0 THEN {fraction} ELSE -{zeros} END - {exponent}"
    return f"CASE WHEN regexp_matches({t}, '{_re2(NUMERIC_SHAPE)}') AND {decimals} <= {NUMERIC_SCALE} THEN TRY_CAST({t} AS DECIMAL(38,{NUMERIC_SCALE})) END"


def _clock_part(x: str, i: int) -> str:
    return f"nullif(regexp_extract(trim({x}, ' '), '{_re2(CLOCK_SHAPE)}', {i}), '')"


def sql_clock_seconds(x: str) -> str:
    h, m, s = (_clock_part(x, i) for i in (1, 2, 3))
    return f"(CAST({h} AS BIGINT) * 3600 + CAST({m} AS BIGINT) * 60 + CAST(coalesce({s}, '0') AS DECIMAL(18,6)))"


def sql_clock(x: str) -> str:
    h, m, s = (_clock_part(x, i) for i in (1, 2, 3))
    shown = (
        f"lpad(CAST(CAST({h} AS BIGINT) AS VARCHAR), 2, '0') || ':' || {m} || ':' || "
        f"CASE WHEN contains({s}, '.') THEN rtrim(rtrim({s}, '0'), '.') ELSE coalesce({s}, '00') END"
    )
    return f"CASE WHEN {sql_clock_seconds(x)} <= 86400 THEN {shown} END"


def sql_flag(x: str) -> str:
    return f"(nullif(trim({x}, ' '), '') IS NOT NULL)"


SQL_KIND = {
    "timestamp": sql_ts, "date": sql_date, "clock": sql_clock, "numeric": sql_numeric,
    "flag": sql_flag, "text": lambda x: x,
}


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
