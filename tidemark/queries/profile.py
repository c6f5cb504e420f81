"""Profiles and what is read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import profile as ops
from tidemark.plans.profiles import profile_history as merged_profile
from tidemark.queries.registry import at, frame, frame_sql, query, sql_clock_seconds, sql_date, sql_numeric, sql_ts, table
from tidemark.sources.history import append_history
from tidemark.sources.scan import ntz, stage_text, stamp_loaded_at
from tidemark.sources.store import Warehouse, shared_folder

FIRST_RUN, SECOND_RUN = at("2024-05-01"), at("2024-05-02")

ORDERS_TEXT = """(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
    CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders)"""
CUSTOMER_TEXT = """(SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer)"""
LINEITEM_TEXT = """(SELECT CAST(COLUMNS(*) AS VARCHAR) FROM lineitem)"""


def profile_sql(text_table: str, source_table: str, sampled: str = "false", profiled_at: str | None = None) -> str:
    stamp = f", TIMESTAMP '{profiled_at}' AS profiled_at" if profiled_at else ""
    total, filled = "count(*)", "count(*) FILTER (WHERE nullif(value, '') IS NOT NULL)"
    return f"""SELECT '{source_table}' AS source_table, column_name, {total} AS total_rows, {filled} AS populated,
        CAST(((2000 * {filled} + {total}) // (2 * {total})) / 10.0 AS DECIMAL(5,1)) AS pct_filled,
        count(DISTINCT nullif(value, '')) AS distinct_values,
        count(*) FILTER (WHERE regexp_matches(value, '^\\d{{4}}-\\d{{2}}-\\d{{2}}[ T]\\d{{2}}:\\d{{2}}')) AS looks_timestamp,
        count(*) FILTER (WHERE regexp_matches(value, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')) AS looks_date,
        count(*) FILTER (WHERE regexp_matches(value, '^-?\\d+(\\.\\d+)?$')) AS looks_numeric,
        min(nullif(value, '')) AS min_value, max(nullif(value, '')) AS max_value, {sampled} AS sampled{stamp}
        FROM (SELECT column_name, value FROM {text_table} UNPIVOT INCLUDE NULLS (value FOR column_name IN (COLUMNS(*))))
        GROUP BY column_name"""


def mixed_profile(spark, sf, profiled_at=SECOND_RUN) -> DataFrame:
    return ops.profile_columns(frame(spark, sf, "mixed_columns"), "mixed", profiled_at=profiled_at)


def mixed_profile_sql() -> str:
    return "(" + profile_sql(frame_sql("mixed_columns"), "mixed", profiled_at=str(SECOND_RUN)) + ")"


def two_runs(spark, sf) -> DataFrame:
    """Two profiling runs of one table, one of another: the older saw every name blank."""
    older = frame(spark, sf, "mixed_columns").withColumn("name", F.lit(""))
    return ops.profile_columns(older, "mixed", sampled=True, profiled_at=FIRST_RUN).unionByName(
        mixed_profile(spark, sf)
    ).unionByName(ops.profile_columns(table(spark, sf, "customer"), "customer", profiled_at=FIRST_RUN))


def two_runs_sql() -> str:
    older = f"(SELECT * REPLACE ('' AS name) FROM {frame_sql('mixed_columns')})"
    return " UNION ALL ".join([
        profile_sql(older, "mixed", "true", str(FIRST_RUN)),
        profile_sql(frame_sql("mixed_columns"), "mixed", profiled_at=str(SECOND_RUN)),
        profile_sql(CUSTOMER_TEXT, "customer", profiled_at=str(FIRST_RUN)),
    ])


_LATEST = f"""(WITH p AS ({two_runs_sql()}) SELECT * FROM p
    WHERE profiled_at = (SELECT max(x.profiled_at) FROM p x WHERE x.source_table = p.source_table))"""


def _latest(spark, sf) -> DataFrame:
    return ops.latest_profile(two_runs(spark, sf))


@query(profile_sql(ORDERS_TEXT, "orders"))
def profile_columns(spark, sf):
    return ops.profile_columns(table(spark, sf, "orders"), "orders")


@query(profile_sql(LINEITEM_TEXT, "lineitem"))
def profile_columns_lineitem(spark, sf):
    return ops.profile_columns(table(spark, sf, "lineitem"), "lineitem")


@query(profile_sql(frame_sql("mixed_columns"), "mixed"))
def profile_columns_mixed(spark, sf):
    return ops.profile_columns(frame(spark, sf, "mixed_columns"), "mixed")


@query(f"SELECT column_name, populated, pct_filled, distinct_values FROM ({profile_sql(CUSTOMER_TEXT, 'customer')})")
def profile_light(spark, sf):
    return ops.profile_light(table(spark, sf, "customer"))


@query(_LATEST[1:-1])
def latest_profile(spark, sf):
    return _latest(spark, sf)


@query(f"""SELECT source_table, count(*) AS n_columns, count(*) FILTER (WHERE populated = 0) AS empty_columns,
                  count(*) FILTER (WHERE populated > 0 AND distinct_values = 1) AS constant_columns,
                  count(*) FILTER (WHERE populated > 1 AND distinct_values = 1) AS constant_multi, max(total_rows) AS n_rows
           FROM {_LATEST} GROUP BY source_table""")
def profile_summary(spark, sf):
    return ops.profile_summary(_latest(spark, sf))


@query(f"SELECT source_table, column_name, total_rows, sampled FROM {_LATEST} WHERE populated = 0")
def empty_columns(spark, sf):
    return ops.empty_columns(_latest(spark, sf))


@query(f"""SELECT source_table, column_name, populated, min_value AS the_only_value FROM {_LATEST}
           WHERE populated > 1 AND distinct_values = 1""")
def constant_columns(spark, sf):
    return ops.constant_columns(_latest(spark, sf))


@query(f"""SELECT source_table, column_name, populated, min_value, max_value,
                  CASE WHEN regexp_matches(column_name, '{ops.MODIFICATION_NAME}') THEN 'modification'
                       WHEN regexp_matches(column_name, '(?i)creat') THEN 'creation (not usable)'
                       ELSE 'unclassified' END AS kind
           FROM {_LATEST} WHERE looks_timestamp > 0 AND looks_timestamp = populated""")
def watermark_candidates(spark, sf):
    return ops.watermark_candidates(_latest(spark, sf))


@query(f"""SELECT column_name, count(*) AS total, count(nullif(value, '')) AS populated, count({sql_ts('value')}) AS as_timestamp,
                  count({sql_date('value')}) AS as_date, count(*) FILTER (WHERE {sql_clock_seconds('value')} <= 86400) AS as_clock,
                  count({sql_numeric('value')}) AS as_numeric
           FROM (SELECT column_name, value FROM (SELECT raw, CAST(event_id AS VARCHAR) AS event_id FROM {frame_sql('dirty_text')})
                 UNPIVOT INCLUDE NULLS (value FOR column_name IN (COLUMNS(*)))) GROUP BY column_name""")
def cast_survival(spark, sf):
    return ops.cast_survival(frame(spark, sf, "dirty_text"))


@query(f"SELECT * FROM ({profile_sql(CUSTOMER_TEXT, 'customer', profiled_at='2024-06-01')})")
def record_profile(spark, sf):
    wh = Warehouse(spark, shared_folder(spark, "record-profile"))
    ops.record_profile(wh, ops.profile_columns(table(spark, sf, "customer"), "customer"), at("2024-06-01"))
    return wh.state("column_profile")


_GROWN = profile_sql(ORDERS_TEXT, "stg.orders")


@query(f"SELECT * EXCLUDE (distinct_values), true AS distinct_close FROM ({_GROWN})")
def profile_history(spark, sf):
    """A history that is profiled, grows and is profiled again. Its sketches' distinct counts are held against exact ones."""
    wh, orders = Warehouse(spark, shared_folder(spark, "profile-history")), stage_text(table(spark, sf, "orders"))
    for part, stamp in (("o_orderstatus = 'F'", FIRST_RUN), ("o_orderstatus <> 'F'", SECOND_RUN)):
        append_history(wh, "stg.orders", stamp_loaded_at(orders.filter(part), stamp), orders.columns)
        merged = merged_profile(wh, "stg.orders")
    exact = ops.profile_light(orders).select("column_name", F.col("distinct_values").alias("n_distinct"))
    close = F.abs(F.col("distinct_values") - F.col("n_distinct")) <= F.col("n_distinct") * 0.05
    return merged.join(exact, "column_name").withColumn("distinct_close", close).drop("distinct_values", "n_distinct")
