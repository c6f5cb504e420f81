"""Probe results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import probe as ops
from tidemark.queries.registry import at, frame, frame_sql, query, table
from tidemark.sources.store import Warehouse, shared_folder

_CLASSIFIED = f"""(SELECT source_table, probed_at, event_id, sqlstate, readable, m AS message, n AS native_error,
    CASE WHEN sqlstate IN ('08S01', '08003', '08001', 'HY000') AND contains(lower(m), 'link failure') THEN 'link'
         WHEN sqlstate IN ('HYT00', 'HYT01') THEN 'timeout'
         WHEN n IN (100, 105, 802) THEN 'missing' WHEN n IN (204, 212, 213) THEN 'denied' WHEN n = 101 THEN 'error'
         WHEN contains(lower(m), 'not permitted') OR contains(lower(m), 'denied') THEN 'denied' ELSE 'error' END AS status
    FROM (SELECT *, TRY_CAST(nullif(regexp_extract(m, '\\((\\d+)\\)\\s*(\\(SQL\\w+\\))?\\s*$', 1), '') AS INTEGER) AS n
          FROM (SELECT *, trim(regexp_replace(message, '\\s+', ' ', 'g')) AS m FROM {frame_sql('probe_log')})))"""

_PROBES = f"""(SELECT source_table, CASE WHEN readable THEN 'ok' WHEN status = 'link' THEN 'error' ELSE status END AS status,
    readable, CASE WHEN readable THEN event_id % 300 END AS column_count, CASE WHEN readable THEN event_id % 20 <> 8 END AS has_rows,
    event_id % 1000 AS elapsed_ms, sqlstate, native_error, message, probed_at FROM {_CLASSIFIED})"""
_LATEST = f"""(WITH p AS (SELECT * FROM {_PROBES}) SELECT * FROM p
    WHERE probed_at = (SELECT max(x.probed_at) FROM p x WHERE x.source_table = p.source_table))"""


def _probes(log):
    """Attempts with their verdicts, in the shape of the probe table."""
    c = ops.probe_classify(log)
    ok = F.col("readable")
    return c.select(
        "source_table",
        F.when(ok, "ok").when(F.col("status") == "link", "error").otherwise(F.col("status")).alias("status"),
        "readable", F.when(ok, F.col("event_id") % 300).alias("column_count"),
        F.when(ok, F.col("event_id") % 20 != 8).alias("has_rows"), (F.col("event_id") % 1000).alias("elapsed_ms"),
        "sqlstate", "native_error", "message", "probed_at",
    )


def _latest_probes(spark, sf):
    """The newest attempts first, then their messages: only rows that stay are classified."""
    return _probes(ops.probe_latest(frame(spark, sf, "probe_log")))


@query(f"SELECT event_id, source_table, sqlstate, message, status, native_error FROM {_CLASSIFIED}")
def probe_classify(spark, sf):
    return ops.probe_classify(frame(spark, sf, "probe_log")).select(
        "event_id", "source_table", "sqlstate", "message", "status", "native_error"
    )


@query(f"SELECT * FROM {_LATEST}")
def probe_latest(spark, sf):
    return _latest_probes(spark, sf)


@query(f"SELECT source_table, column_count, has_rows, elapsed_ms, probed_at FROM {_LATEST} WHERE readable")
def readable_tables(spark, sf):
    return ops.readable_tables(_latest_probes(spark, sf))


@query(f"SELECT source_table, status, native_error, message, probed_at FROM {_LATEST} WHERE NOT readable")
def unreadable_tables(spark, sf):
    return ops.unreadable_tables(_latest_probes(spark, sf))


@query(f"SELECT status, count(*) AS n FROM {_PROBES} GROUP BY status")
def probe_tally(spark, sf):
    return ops.probe_tally(_probes(frame(spark, sf, "probe_log")))


@query("SELECT p_partkey, p_name AS table_name FROM part WHERE regexp_matches(p_name, '(?i)E.*_.I'.replace('_', '.'))")
def catalog_like(spark, sf):
    names = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("table_name"))
    return ops.catalog_like(names, "E%__I")


@query(f"SELECT * REPLACE (TIMESTAMP '2024-06-01' AS probed_at) FROM {_PROBES}")
def record_probe(spark, sf):
    wh = Warehouse(spark, shared_folder(spark, "record-probe"))
    ops.record_probe(wh, _probes(frame(spark, sf, "probe_log")), at("2024-06-01"))
    return wh.state("table_probe")
