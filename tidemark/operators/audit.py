"""Reconciliation and monitoring over the run audit. Every "now" is an explicit ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.sources.scan import ntz

# When a run counts as stalled, and when a success or a watermark is too old.
STALLED_HOURS = 6
OVERDUE_HOURS = 26
RUN_STATUSES = ("running", "succeeded", "failed")
TABLE_RUN_STATUSES = ("running", "succeeded", "failed", "drift")


def differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def failed_hop(bounded: Column, source_n: Column, extracted_n: Column, staged_n: Column, loaded_n: Column) -> Column:
    """The first hop that lost rows: fetch, land, append or none. The source count gates only a
    bounded read; the count of a live source that is read without bounds is an observation."""
    return (
        F.when(bounded & differs(source_n, extracted_n), "fetch")
        .when(differs(extracted_n, staged_n), "land")
        .when(differs(staged_n, loaded_n), "append")
        .otherwise("none")
    )


def reconcile(table_runs: DataFrame, bounded: str = "bounded") -> DataFrame:
    """Add ``failed_hop`` and ``reconciled`` to rows with source_n, extracted_n, staged_n, loaded_n."""
    hop = failed_hop(*[F.col(c) for c in (bounded, "source_n", "extracted_n", "staged_n", "loaded_n")])
    return table_runs.withColumn("failed_hop", hop).withColumn("reconciled", F.col("failed_hop") == "none")


def load_exceptions(runs: DataFrame, table_runs: DataFrame) -> DataFrame:
    """Table runs that did not succeed or whose counts disagree; empty means the last run is sound.

    A failed run without any table run is listed too; dry runs, which write nothing, are not.
    """
    run = runs.filter(~F.coalesce("dry_run", F.lit(False))).select(
        "run_id", "started_at", F.col("status").alias("_run_status"),
        F.col("error_message").alias("_run_error"),
    )
    t = table_runs.select(
        "run_id", "source_table", "watermark_from", "source_row_count", "extracted_row_count",
        "staged_row_count", "loaded_row_count", "status", "error_message",
    )
    joined = run.join(t, "run_id", "left")
    no_table = F.col("source_table").isNull()
    wrong = (
        (F.col("status") != "succeeded")
        | differs(F.col("extracted_row_count"), F.col("staged_row_count"))
        | differs(F.col("staged_row_count"), F.col("loaded_row_count"))
        | (F.col("watermark_from").isNotNull()
           & differs(F.col("source_row_count"), F.col("extracted_row_count")))
    )
    return joined.filter(
        F.when(no_table, F.col("_run_status") == "failed").otherwise(wrong)
    ).select(
        "run_id", "started_at", "source_table", "watermark_from", "source_row_count",
        "extracted_row_count", "staged_row_count", "loaded_row_count",
        F.coalesce("status", "_run_status").alias("status"),
        F.coalesce("error_message", "_run_error").alias("error_message"),
    )


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds, without passing through the session's time zone."""
    return (later - earlier).cast("interval second").cast("bigint")


def older_than(at: Column, as_of: dt.datetime, hours: int) -> Column:
    return at < ntz(as_of - dt.timedelta(hours=hours))


def stalled_runs(runs: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Runs that still say running six hours after they began."""
    return runs.filter(
        (F.col("status") == "running") & older_than(F.col("started_at"), as_of, STALLED_HOURS)
    )


def heartbeat(runs: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The last success, its age and whether that is too old; overdue when there never was one."""
    real = runs.filter(F.col("status") == "succeeded")
    if "dry_run" in runs.columns:
        real = real.filter(~F.coalesce("dry_run", F.lit(False)))
    last = F.col("last_success")
    return real.agg(F.max("finished_at").alias("last_success")).select(
        "last_success", seconds_between(last, ntz(as_of)).alias("age_seconds"),
        F.coalesce(older_than(last, as_of, OVERDUE_HOURS), F.lit(True)).alias("overdue"),
    )


def transform_lag(watermarks: DataFrame, as_of: dt.datetime) -> DataFrame:
    """How far each target is behind the clock."""
    at = F.col("last_loaded_at")
    return watermarks.select(
        "target_table", "source_table", "last_loaded_at",
        seconds_between(at, ntz(as_of)).alias("lag_seconds"),
        older_than(at, as_of, OVERDUE_HOURS).alias("overdue"),
    )


def data_currency(watermarks: DataFrame, as_of: dt.datetime) -> DataFrame:
    """What a report prints in its footer: the point up to which the source was read."""
    at = F.col("last_loaded_at")
    return watermarks.select(
        "target_table", F.col("source_as_at").alias("as_at"), at.alias("transformed_to"),
        seconds_between(at, ntz(as_of)).alias("lag_seconds"),
        older_than(at, as_of, OVERDUE_HOURS).alias("stale"),
    )


def pending_rows(watermarks: DataFrame, arrivals: DataFrame) -> DataFrame:
    """History rows each target has not consumed yet: tells a quiet source from a stopped transform.

    ``arrivals`` has source_table and loaded_at. It is counted per load stamp first, then one running
    total per source meets each target once: the work grows with stamps plus targets, not their product.
    """
    per_batch = arrivals.groupBy("source_table", "loaded_at").agg(F.count(F.lit(1)).alias("n"))
    targets = watermarks.select("source_table", F.col("last_loaded_at").alias("loaded_at"), F.lit(0).cast("bigint").alias("n"), "target_table")
    # From the newest stamp down, a watermark before the stamps of its own time: what has passed it so far is pending.
    line = targets.withColumn("_mark", F.lit(0)).unionByName(
        per_batch.withColumns({"target_table": F.lit(None).cast("string"), "_mark": F.lit(1)})
    )
    down = W.partitionBy("source_table").orderBy(F.desc("loaded_at"), "_mark").rowsBetween(W.unboundedPreceding, 0)
    passed = line.withColumn("_n", F.sum("n").over(down)).filter("_mark = 0")
    return passed.select(
        "target_table", "source_table", F.when(F.col("loaded_at").isNull(), 0).otherwise(F.col("_n")).cast("bigint").alias("pending_rows")
    )


def run_outcome(table_runs: DataFrame, transforms: DataFrame | None = None) -> DataFrame:
    """Per run: failed when a table failed or the transform did; drift alone does not fail a run.

    ``transforms`` has run_id and transform_error, NULL for a transform that went well. A failed
    transform leaves the loads as they are.
    """
    failed = F.col("status") == "failed"
    per_run = table_runs.groupBy("run_id").agg(
        F.count_if(failed).alias("n_failed"),
        F.count_if(F.col("status") == "drift").alias("n_drift"),
        F.array_join(F.array_sort(F.collect_set(F.when(failed, F.col("source_table")))), ", ").alias("_names"),
    )
    if transforms is None:
        per_run = per_run.withColumn("transform_error", F.lit(None).cast("string"))
    else:
        per_run = per_run.join(transforms.select("run_id", "transform_error"), "run_id", "left")
    tables_failed = F.col("n_failed") > 0
    transform_failed = F.col("transform_error").isNotNull()
    return per_run.select(
        "run_id", "n_failed", "n_drift",
        F.when(tables_failed | transform_failed, "failed").otherwise("succeeded").alias("status"),
        F.when(tables_failed, F.concat(F.lit("tables failed: "), F.col("_names")))
        .when(transform_failed, F.concat(F.lit("loaded, but transform failed: "), F.col("transform_error")))
        .alias("error_message"),
    )
