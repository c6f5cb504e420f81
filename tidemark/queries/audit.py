"""Reconciliation and monitors over run logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import audit as ops
from tidemark.plans.loads import Audit, LoadResult
from tidemark.queries.registry import at, frame, frame_sql, query, table
from tidemark.sources.store import Warehouse, shared_folder

AS_OF = at("2024-01-08T03:00:00")
_AS_OF = "TIMESTAMP '2024-01-08 03:00:00'"


@query("""WITH t AS (SELECT o_orderkey AS run_id, o_orderkey % 3 <> 0 AS bounded,
                 100 + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS source_n, 100 AS extracted_n,
                 100 - CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS staged_n,
                 100 - CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS loaded_n FROM orders),
          h AS (SELECT run_id, CASE WHEN bounded AND source_n IS DISTINCT FROM extracted_n THEN 'fetch'
                 WHEN extracted_n IS DISTINCT FROM staged_n THEN 'land'
                 WHEN staged_n IS DISTINCT FROM loaded_n THEN 'append' ELSE 'none' END AS failed_hop FROM t)
          SELECT run_id, failed_hop, failed_hop = 'none' AS reconciled FROM h""")
def reconcile(spark, sf):
    runs = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS run_id", "o_orderkey % 3 <> 0 AS bounded",
        "100 + IF(o_orderkey % 5 = 0, 1, 0) AS source_n", "100 AS extracted_n",
        "100 - IF(o_orderkey % 7 = 0, 1, 0) AS staged_n",
        "100 - IF(o_orderkey % 7 = 0 OR o_orderkey % 13 = 0, 1, 0) AS loaded_n",
    )
    return ops.reconcile(runs).select("run_id", "failed_hop", "reconciled")


@query(f"""SELECT r.run_id, r.started_at, t.source_table, t.watermark_from, t.source_row_count, t.extracted_row_count,
                  t.staged_row_count, t.loaded_row_count, coalesce(t.status, r.status) AS status,
                  coalesce(t.error_message, r.error_message) AS error_message
           FROM {frame_sql('run_log')} r LEFT JOIN {frame_sql('table_run_log')} t ON r.run_id = t.run_id
           WHERE NOT r.dry_run AND CASE WHEN t.run_id IS NULL THEN r.status = 'failed' ELSE
                 t.status <> 'succeeded' OR t.extracted_row_count IS DISTINCT FROM t.staged_row_count
                 OR t.staged_row_count IS DISTINCT FROM t.loaded_row_count
                 OR (t.watermark_from IS NOT NULL AND t.source_row_count IS DISTINCT FROM t.extracted_row_count) END""")
def load_exceptions(spark, sf):
    return ops.load_exceptions(frame(spark, sf, "run_log"), frame(spark, sf, "table_run_log"))


@query(f"""SELECT * FROM {frame_sql('run_log')} WHERE status = 'running' AND started_at < {_AS_OF} - INTERVAL 6 HOUR""")
def stalled_runs(spark, sf):
    return ops.stalled_runs(frame(spark, sf, "run_log"), AS_OF)


@query(f"""SELECT max(finished_at) AS last_success, date_sub('second', max(finished_at), {_AS_OF}) AS age_seconds,
                  coalesce({_AS_OF} - max(finished_at) > INTERVAL 26 HOUR, true) AS overdue
           FROM {frame_sql('run_log')} WHERE status = 'succeeded' AND NOT dry_run""")
def heartbeat(spark, sf):
    return ops.heartbeat(frame(spark, sf, "run_log"), AS_OF)


# One transform watermark per customer.
_WATERMARKS = """(SELECT 'rep.' || CAST(o_custkey AS VARCHAR) AS target_table, 'stg.' || CAST(o_custkey % 50 AS VARCHAR) AS source_table,
    max(o_orderdate) AS last_loaded_at, min(o_orderdate) AS source_as_at FROM orders GROUP BY o_custkey)"""


def _watermarks(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last_loaded_at"), F.min("o_orderdate").alias("source_as_at")
    ).selectExpr(
        "concat('rep.', o_custkey) AS target_table", "concat('stg.', o_custkey % 50) AS source_table",
        "last_loaded_at", "source_as_at",
    )


LAG_AS_OF = at("2001-08-01T12:00:00")
_LAG_AS_OF = "TIMESTAMP '2001-08-01 12:00:00'"


@query(f"""SELECT target_table, source_table, last_loaded_at, date_sub('second', last_loaded_at, {_LAG_AS_OF}) AS lag_seconds,
                  {_LAG_AS_OF} - last_loaded_at > INTERVAL 26 HOUR AS overdue FROM {_WATERMARKS}""")
def transform_lag(spark, sf):
    return ops.transform_lag(_watermarks(spark, sf), LAG_AS_OF)


@query(f"""SELECT target_table, source_as_at AS as_at, last_loaded_at AS transformed_to,
                  date_sub('second', last_loaded_at, {_LAG_AS_OF}) AS lag_seconds,
                  {_LAG_AS_OF} - last_loaded_at > INTERVAL 26 HOUR AS stale FROM {_WATERMARKS}""")
def data_currency(spark, sf):
    return ops.data_currency(_watermarks(spark, sf), LAG_AS_OF)


@query(f"""SELECT w.target_table, w.source_table, count(a.loaded_at) AS pending_rows
           FROM {_WATERMARKS} w LEFT JOIN (SELECT 'stg.' || CAST(o_custkey % 50 AS VARCHAR) AS source_table, o_orderdate AS loaded_at FROM orders) a
             ON a.source_table = w.source_table AND a.loaded_at > w.last_loaded_at
           GROUP BY w.target_table, w.source_table""")
def pending_rows(spark, sf):
    arrivals = table(spark, sf, "orders").selectExpr(
        "concat('stg.', o_custkey % 50) AS source_table", "o_orderdate AS loaded_at"
    )
    return ops.pending_rows(_watermarks(spark, sf), arrivals)


@query(f"""WITH t AS (SELECT run_id, count(*) FILTER (WHERE status = 'failed') AS n_failed, count(*) FILTER (WHERE status = 'drift') AS n_drift,
                  string_agg(DISTINCT source_table, ', ' ORDER BY source_table) FILTER (WHERE status = 'failed') AS names
                FROM {frame_sql('table_run_log')} GROUP BY run_id),
           x AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CASE WHEN o_custkey % 10 = 0 THEN 'no space' END AS e FROM orders)
           SELECT t.run_id, n_failed, n_drift, CASE WHEN n_failed > 0 OR e IS NOT NULL THEN 'failed' ELSE 'succeeded' END AS status,
                  CASE WHEN n_failed > 0 THEN 'tables failed: ' || names WHEN e IS NOT NULL THEN 'loaded, but transform failed: ' || e END AS error_message
           FROM t LEFT JOIN x ON t.run_id = x.run_id""")
def run_outcome(spark, sf):
    transforms = table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS run_id", "IF(o_custkey % 10 = 0, 'no space', NULL) AS transform_error"
    )
    return ops.run_outcome(frame(spark, sf, "table_run_log"), transforms)


@query("""SELECT t AS source_table, 'succeeded' AS status, n AS source_row_count, n AS loaded_row_count, 'failed' AS run_status,
                 'tables failed: part' AS run_error
          FROM (SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem)
          UNION ALL SELECT 'part', 'failed', count(*), count(*) - 1, 'failed', 'tables failed: part' FROM part""")
def audit_run(spark, sf):
    """Start and finish events of a run over three tables, read back as current state."""
    wh = Warehouse(spark, shared_folder(spark, "audit-run"))
    audit = Audit(wh)
    audit.start_run(AS_OF)
    for name in ("orders", "lineitem", "part"):
        n = table(spark, sf, name).count()
        audit.start_table(name, None)
        lost = 1 if name == "part" else 0
        audit.finish_table(name, "failed" if lost else "succeeded", LoadResult(n, n, n, n - lost, False, "normal"))
    audit.finish_run("failed", "tables failed: part")
    runs = wh.current("load_run").select(
        "run_id", F.col("status").alias("run_status"), F.col("error_message").alias("run_error")
    )
    return wh.current("load_table_run").join(runs, "run_id").select(
        "source_table", "status", "source_row_count", "loaded_row_count", "run_status", "run_error"
    )
