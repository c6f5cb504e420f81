"""Latest version, upsert and the fact transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import versions as ops
from tidemark.plans import facts as plan
from tidemark.queries.registry import SQL_KIND, at, frame, frame_sql, query, table
from tidemark.sources.history import append_history
from tidemark.sources.store import Warehouse, shared_folder
from tidemark.operators.audit import heartbeat, load_exceptions
from tidemark.streaming import audited_stream as start_audited_stream
from tidemark.streaming import stream_transform as start_stream

INCIDENT = plan.incident_fact("__key_incident")
CHARGE = plan.charge_fact("_fk_incident")
NOW = at("2024-03-01")


def fact_sql(spec, source: str, where: str = "true") -> str:
    """Latest version per key, then the typed projection."""
    quoted = lambda c: '"' + c + '"'
    fields = ", ".join(f"{SQL_KIND[f.kind](quoted(f.source))} AS {quoted(f.target)}" for f in spec.fields)
    return f"""SELECT {fields}, loaded_at FROM (
        SELECT *, row_number() OVER (PARTITION BY {quoted(spec.source_key)}
            ORDER BY {SQL_KIND['timestamp'](quoted(spec.source_modified))} DESC NULLS LAST, loaded_at DESC) AS rn
        FROM (SELECT * FROM {source} WHERE {where}) WHERE {quoted(spec.source_key)} IS NOT NULL) WHERE rn = 1"""


def upsert_sql(spec, source: str, cut: str) -> str:
    """The fact after a first batch up to the cut and a second with the rest."""
    cols = [f.target for f in spec.fields] + ["loaded_at"]
    key, mod = spec.key, spec.modified
    takes = f"(o.{key} IS NULL OR (n.{key} IS NOT NULL AND (o.{mod} IS NULL OR n.{mod} >= o.{mod})))"
    picked = ", ".join(f'CASE WHEN {takes} THEN n."{c}" ELSE o."{c}" END AS "{c}"' for c in cols)
    return f"""WITH o AS ({fact_sql(spec, source, f"loaded_at <= {cut}")}), n AS ({fact_sql(spec, source, f"loaded_at > {cut}")})
        SELECT {picked} FROM o FULL JOIN n ON o.{key} = n.{key}"""


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders)
          WHERE rn = 1""")
def latest_version(spark, sf):
    return ops.latest_version(
        table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"),
        "o_custkey", "o_orderdate", "o_orderkey",
    )


_ORDER_BATCHES = """WITH h AS (SELECT o_custkey AS k, o_orderkey AS l, o_totalprice AS v,
                  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS m FROM orders),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY m DESC NULLS LAST, l DESC) rn FROM h WHERE l % 3 <> 0) WHERE rn = 1),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY m DESC NULLS LAST, l DESC) rn FROM h WHERE l % 3 = 0) WHERE rn = 1),
a AS (SELECT coalesce(o.k, n.k) AS k,
             CASE WHEN o.k IS NULL THEN 'insert' WHEN n.k IS NULL THEN 'keep'
                  WHEN o.m IS NULL OR n.m >= o.m THEN 'update' ELSE 'stale' END AS action,
             o.m AS om, o.v AS ov, o.l AS ol, n.m AS nm, n.v AS nv, n.l AS nl
      FROM o FULL JOIN n ON o.k = n.k)"""
_UPSERTED = f"""{_ORDER_BATCHES} SELECT k, action, CASE WHEN action IN ('insert','update') THEN nm ELSE om END AS m,
       CASE WHEN action IN ('insert','update') THEN nv ELSE ov END AS v,
       CASE WHEN action IN ('insert','update') THEN nl ELSE ol END AS l FROM a"""


def _order_upsert(spark, sf):
    """Orders split in two batches by key; a third is the later one."""
    h = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("l"), F.col("o_totalprice").alias("v"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")).alias("m"),
    )
    old, new = (ops.latest_version(h.filter(c), "k", "m", "l") for c in ("l % 3 <> 0", "l % 3 = 0"))
    return ops.upsert_latest(old, new, "k", "m")


@query(_UPSERTED)
def upsert_latest(spark, sf):
    return _order_upsert(spark, sf)


@query(f"""{_ORDER_BATCHES} SELECT count(*) FILTER (WHERE action IN ('insert', 'update')) AS n_written,
           count(*) FILTER (WHERE action = 'insert') AS n_inserted, count(*) FILTER (WHERE action = 'update') AS n_updated,
           count(*) FILTER (WHERE action = 'stale') AS n_stale FROM a""")
def written_count(spark, sf):
    return ops.written_count(_order_upsert(spark, sf))


def _project(spec, source: str) -> str:
    quoted = lambda c: '"' + c + '"'
    fields = ", ".join(f"{SQL_KIND[f.kind](quoted(f.source))} AS {quoted(f.target)}" for f in spec.fields)
    return f"SELECT {fields}, loaded_at FROM {source}"


@query(_project(INCIDENT, frame_sql("incident_history")))
def fact_incident(spark, sf):
    return plan.project_fact(frame(spark, sf, "incident_history"), INCIDENT)


@query(_project(CHARGE, frame_sql("charge_history")))
def fact_charge(spark, sf):
    return plan.project_fact(frame(spark, sf, "charge_history"), CHARGE)


@query(fact_sql(INCIDENT, frame_sql("incident_history")))
def rebuild_incident(spark, sf):
    return plan.rebuild(frame(spark, sf, "incident_history"), INCIDENT)


@query(fact_sql(CHARGE, frame_sql("charge_history")))
def rebuild_charge(spark, sf):
    return plan.rebuild(frame(spark, sf, "charge_history"), CHARGE)


def _fill(wh: Warehouse, spec, rows) -> None:
    append_history(wh, spec.source_table, rows, spec.source_columns)


def _split_at(history):
    """The load time in the middle of the range, so that both batches grow with the data."""
    seconds = "unix_seconds(cast(cast({}(loaded_at) as string) || 'Z' as timestamp))"
    return history.selectExpr(
        f"timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, ({seconds.format('min')} + {seconds.format('max')}) div 2)"
    ).first()[0]


def _two_batches(spark, sf, spec, source: str, **options):
    """Load half, transform, load the rest, transform again."""
    wh = Warehouse(spark, shared_folder(spark, "transform"))
    history = frame(spark, sf, source)
    cut = _split_at(history)
    cut_lit = F.lit(str(cut)).cast("timestamp_ntz")
    for part in (history.filter(F.col("loaded_at") <= cut_lit), history.filter(F.col("loaded_at") > cut_lit)):
        _fill(wh, spec, part)
        plan.transform(wh, spec, now=NOW, **options)
    return wh.read_fact(spec).drop("transformed_at")


def _cut(source: str) -> str:
    return f"""(SELECT TIMESTAMP '1970-01-01' + to_seconds(CAST(floor((epoch(min(loaded_at)) + epoch(max(loaded_at))) / 2) AS BIGINT))
        FROM {source})"""


@query(upsert_sql(INCIDENT, frame_sql("incident_history"), _cut(frame_sql("incident_history"))))
def transform_incident(spark, sf):
    return _two_batches(spark, sf, INCIDENT, "incident_history")


@query(upsert_sql(INCIDENT, frame_sql("incident_history"), _cut(frame_sql("incident_history"))))
def transform_incident_shuffled(spark, sf):
    """The same with small buckets: the second batch outgrows those of the first, and all are dealt anew."""
    return _two_batches(spark, sf, INCIDENT, "incident_history", bucket_bytes=1 << 16)


@query(fact_sql(INCIDENT, frame_sql("incident_history")))
def rebuild_fact(spark, sf):
    """Half the history transformed, the rest consumed, then the fact built anew and committed."""
    wh = Warehouse(spark, shared_folder(spark, "rebuild"))
    history = frame(spark, sf, "incident_history")
    cut = F.lit(str(_split_at(history))).cast("timestamp_ntz")
    for part in (history.filter(F.col("loaded_at") <= cut), history.filter(F.col("loaded_at") > cut)):
        _fill(wh, INCIDENT, part)
        plan.transform(wh, INCIDENT, now=NOW)
    plan.rebuild_fact(wh, INCIDENT, now=NOW, bucket_bytes=1 << 22)
    return wh.read_fact(INCIDENT).drop("transformed_at")


@query(upsert_sql(CHARGE, frame_sql("charge_history"), _cut(frame_sql("charge_history"))))
def transform_charge(spark, sf):
    return _two_batches(spark, sf, CHARGE, "charge_history")


_COUNTS = """SELECT '{target}' AS target_table, '{source}' AS source_table, max(loaded_at) AS last_loaded_at,
    TIMESTAMP '2024-02-29' AS source_as_at, count(*) AS n_batch, count(*) FILTER (WHERE "{key}" IS NULL) AS n_nokey,
    count(DISTINCT "{key}") AS n_written FROM {frame}"""


@query(" UNION ALL ".join(
    _COUNTS.format(target=s.target_table, source=s.source_table, key=s.source_key, frame=frame_sql(f))
    for s, f in ((INCIDENT, "incident_history"), (CHARGE, "charge_history"))
))
def run_transforms(spark, sf):
    """Both facts in one commit; the state rows it leaves."""
    wh = Warehouse(spark, shared_folder(spark, "run-transforms"))
    _fill(wh, INCIDENT, frame(spark, sf, "incident_history"))
    _fill(wh, CHARGE, frame(spark, sf, "charge_history"))
    plan.run_transforms(wh, [INCIDENT, CHARGE], source_as_at=at("2024-02-29"), now=NOW)
    return wh.current("transform_watermark").select(
        "target_table", "source_table", "last_loaded_at", "source_as_at", "n_batch", "n_nokey", "n_written"
    )


@query("""SELECT 'rep.orders' AS target_table, 'stg.orders' AS source_table, max(o_orderdate) AS last_loaded_at,
                 max(o_orderdate) FILTER (WHERE o_orderstatus = 'F') AS source_as_at FROM orders""")
def advance_transform_watermark(spark, sf):
    """Without a given as-at, the ceiling of the newest succeeded run is taken."""
    wh = Warehouse(spark, shared_folder(spark, "advance"))
    orders = table(spark, sf, "orders")
    wh.append_state("load_run", orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderdate").alias("watermark_to"),
        F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("failed").alias("status"),
        F.lit(False).alias("dry_run"), F.col("o_orderdate").alias("event_at"), F.lit(1).alias("event_seq"),
        *[F.lit(None).alias(c) for c in ("started_at", "finished_at", "trigger_source", "host_name", "error_message")],
    ))
    consumed = orders.agg(F.max("o_orderdate")).first()[0]
    plan.advance_transform_watermark(wh, "rep.orders", "stg.orders", consumed, now=NOW)
    return wh.current("transform_watermark").select("target_table", "source_table", "last_loaded_at", "source_as_at")


@query(fact_sql(INCIDENT, frame_sql("incident_history")))
def stream_transform(spark, sf):
    """Two loads, each consumed by a run of the same stream: the same fact as one rebuild."""
    wh = Warehouse(spark, shared_folder(spark, "stream"))
    history = frame(spark, sf, "incident_history")
    for part in (history.filter("call_type = 'F'"), history.filter("call_type <> 'F'")):
        _fill(wh, INCIDENT, part)
        start_stream(wh, INCIDENT, f"{wh.root}/checkpoint").awaitTermination()
    return wh.read_fact(INCIDENT).drop("transformed_at")


@query(f"""SELECT source_table, step, n AS source_row_count, n AS extracted_row_count, n AS staged_row_count, n AS loaded_row_count,
                  'succeeded' AS status, 'stream' AS trigger_source, false AS exception, false AS overdue
           FROM (SELECT 'stg.incident' AS source_table, CASE WHEN call_type = 'F' THEN 1 ELSE 2 END AS step, count(*) AS n
                 FROM {frame_sql('incident_history')} GROUP BY 1, 2)""")
def audited_stream(spark, sf):
    """Two audited runs of a stream: their counts agree, no exception is listed and the heartbeat has heard of them."""
    wh = Warehouse(spark, shared_folder(spark, "audited-stream"))
    history = frame(spark, sf, "incident_history")
    for part in (history.filter("call_type = 'F'"), history.filter("call_type <> 'F'")):
        _fill(wh, INCIDENT, part)
        start_audited_stream(wh, INCIDENT, f"{wh.root}/checkpoint", clock=lambda: NOW).await_termination()
    runs, table_runs = wh.current("load_run"), wh.current("load_table_run")
    wrong = load_exceptions(runs, table_runs).select("run_id", F.lit(True).alias("_wrong"))
    step = F.when(F.col("watermark_from").isNull(), 1).otherwise(2).alias("step")
    return (
        table_runs.join(runs.select("run_id", "trigger_source"), "run_id").join(wrong, "run_id", "left")
        .join(heartbeat(runs, NOW).select("overdue"))
        .select("source_table", step, "source_row_count", "extracted_row_count", "staged_row_count", "loaded_row_count",
                "status", "trigger_source", F.coalesce("_wrong", F.lit(False)).alias("exception"), "overdue")
    )
