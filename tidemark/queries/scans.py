"""Scans, staging, batch ranges and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import (
    clean_name, clock_kind, clock_seconds, clock_text, set_flag, try_date, try_numeric, try_ts,
)
from tidemark.operators import windows
from tidemark.queries.registry import (
    at, frame, frame_sql, query, sql_clock, sql_clock_seconds, sql_date, sql_flag, sql_numeric, sql_ts, table,
)
from tidemark.sources import scan
from tidemark.sources.history import staged_columns as staged_names

FLOOR, CEILING = at("2024-01-10"), at("2024-01-20")
_RANGE = "ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'"


def _events_history(spark, sf):
    """Events as a history: the event time is the load time, an event of type error has no key."""
    return table(spark, sf, "events").withColumnRenamed("ts", "loaded_at").withColumn(
        "key", F.nullif(F.col("event_type"), F.lit("error"))
    )


@query("SELECT event_id, ts, event_type FROM events")
def scan_columns(spark, sf):
    return scan.scan_columns(table(spark, sf, "events"), ["event_id", "ts", "event_type"])


@query("SELECT * FROM events")
def scan_all(spark, sf):
    return scan.scan_all(table(spark, sf, "events"))


@query("SELECT least(count(*), 100) AS n, true AS sampled FROM events")
def scan_sample(spark, sf):
    """How many rows come and that all are marked; which ones come is not defined."""
    sample = scan.scan_sample(table(spark, sf, "events"), 100)
    return sample.agg(F.count("*").alias("n"), F.min("sampled").alias("sampled"))


@query(None)
def scan_sample_rows(spark, sf):
    """The sampled rows themselves. SQL cannot give the same ones; a test holds them against events."""
    return scan.scan_sample(table(spark, sf, "events"), 100)


@query(f"SELECT * FROM events WHERE {_RANGE}")
def scan_bounded(spark, sf):
    return scan.scan_bounded(table(spark, sf, "events"), "ts", FLOOR, CEILING)


@query(f"SELECT count(*) AS source_n FROM events WHERE {_RANGE}")
def source_count(spark, sf):
    return scan.source_count(table(spark, sf, "events"), "ts", FLOOR, CEILING)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
                 CAST(o_totalprice * 64 AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
                 o_orderpriority FROM orders""")
def stage_text(spark, sf):
    # Above 1e7 the engines' own renderings of a double differ; the staging text does not.
    df = table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice") * 64)
    return scan.stage_text(df)


@query("SELECT event_id, CAST(ts AS VARCHAR) AS ts, value FROM events")
def trim_temporal(spark, sf):
    return scan.trim_temporal(table(spark, sf, "events").select("event_id", "ts", "value"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def normalise_columns(spark, sf):
    df = table(spark, sf, "customer")
    return scan.normalise_columns(df.toDF(*[c.upper() for c in df.columns]))


@query("SELECT o_orderkey, o_orderdate, TIMESTAMP '2024-03-01 02:00:00' AS loaded_at FROM orders")
def stamp_loaded_at(spark, sf):
    return scan.stamp_loaded_at(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), at("2024-03-01T02:00:00")
    )


@query("""SELECT n AS column_name, p AS position, (SELECT count(*) FROM events) AS n_rows
          FROM (VALUES ('event_id', 1), ('user_id', 2), ('event_type', 3), ('value', 4), ('props', 5), ('key', 6)) t(n, p)""")
def staged_columns(spark, sf):
    history = _events_history(spark, sf)
    names = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"))
        for i, c in enumerate(staged_names(history), 1)
    ])
    return history.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(names), "n_rows")


@query(f"SELECT max({sql_ts('raw')}) AS high_watermark FROM {frame_sql('dirty_text')}")
def high_watermark(spark, sf):
    return windows.high_watermark(frame(spark, sf, "dirty_text"), "raw")


@query("SELECT max(ts) AS batch_to FROM events WHERE ts > TIMESTAMP '2024-01-10'")
def batch_ceiling(spark, sf):
    return windows.batch_ceiling(_events_history(spark, sf), FLOOR)


@query(f"SELECT event_id, ts AS loaded_at, nullif(event_type, 'error') AS key FROM events WHERE {_RANGE}")
def batch_window(spark, sf):
    return windows.batch_window(_events_history(spark, sf), FLOOR, CEILING).select("event_id", "loaded_at", "key")


@query(f"""SELECT count(*) AS n_batch, count(*) FILTER (WHERE nullif(event_type, 'error') IS NULL) AS n_nokey
           FROM events WHERE {_RANGE}""")
def batch_counts(spark, sf):
    return windows.batch_counts(windows.batch_window(_events_history(spark, sf), FLOOR, CEILING), "key")


@query("SELECT event_id, event_type AS key FROM events WHERE event_type <> 'error'")
def not_null_key(spark, sf):
    return windows.not_null_key(_events_history(spark, sf), "key").select("event_id", "key")


@query(f"""SELECT event_id, {sql_ts('raw')} AS as_ts, {sql_date('raw')} AS as_date, {sql_numeric('raw')} AS as_numeric,
                  {sql_clock('raw')} AS as_clock FROM {frame_sql('dirty_text')}""")
def guarded_cast(spark, sf):
    return frame(spark, sf, "dirty_text").select(
        "event_id", try_ts("raw").alias("as_ts"), try_date("raw").alias("as_date"),
        try_numeric("raw").alias("as_numeric"), clock_text("raw").alias("as_clock"),
    )


@query(f"SELECT event_id, {sql_flag('raw')} AS flag FROM {frame_sql('dirty_text')}", name="set_flag")
def set_flag_query(spark, sf):
    return frame(spark, sf, "dirty_text").select("event_id", set_flag("raw").alias("flag"))


@query(f"""SELECT event_id, CASE WHEN raw IS NULL OR trim(raw, ' ') = '' THEN 'empty'
                  WHEN {sql_clock_seconds('raw')} <= 86400 THEN 'clock'
                  WHEN {sql_clock_seconds('raw')} > 86400 THEN 'over24h' ELSE 'invalid' END AS kind,
                  CAST({sql_clock_seconds('raw')} AS BIGINT) AS seconds FROM {frame_sql('dirty_text')}""")
def time_kind(spark, sf):
    return frame(spark, sf, "dirty_text").select(
        "event_id", clock_kind("raw").alias("kind"), clock_seconds("raw").cast("bigint").alias("seconds")
    )


@query(r"""SELECT doc_id, regexp_replace(array_to_string(list_transform(
                 regexp_extract_all(lower(text), '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'),
                 lambda p: CASE WHEN p[1] = 'ß' THEN 'ß' ELSE upper(p[1]) END || p[2:]), ''), '[\x00-\x1F\x7F]', '', 'g') AS name
           FROM documents""", name="clean_name")
def clean_name_query(spark, sf):
    return table(spark, sf, "documents").select("doc_id", clean_name("text").alias("name"))
