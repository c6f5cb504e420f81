"""Typed facts from text history: projection, incremental transform, full rebuild."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.functions.casts import clock_text, set_flag, try_date, try_numeric, try_ts
from tidemark.functions.text import clean_name, row_hash
from tidemark.operators.versions import latest_version, upsert_latest
from tidemark.operators.quality import CASTS, parse_errors, refusal
from tidemark.operators.windows import batch_ceiling, batch_counts, batch_window, not_null_key
from tidemark.sources.history import loaded_range, read_history
from tidemark.sources.scan import ident, ntz
from tidemark.sources.store import Warehouse, bucket_of, utc_now
from tidemark.spec import FactSpec, Field, LOADED_AT

_KIND = {
    "timestamp": try_ts, "date": try_date, "clock": clock_text, "numeric": try_numeric,
    "flag": set_flag, "name": clean_name, "text": lambda c: c,
}

# Text of a bucket, about. A fact that has outgrown its buckets twice over is dealt to more of them.
BUCKET_BYTES = 256 << 20
# The driver hears of each task. So many write a fact of more buckets, whose number is then a multiple.
BUCKET_TASKS = 1024
# A key of more rows is brought down to its latest version before its rows are dealt to a bucket.
HOT_ROWS = 100_000


def bucket_count(n_bytes: int, current: int = 0, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The number of buckets for so much text: the current one until twice as many are needed."""
    wanted = max(1, -(-n_bytes // bucket_bytes))
    if wanted > BUCKET_TASKS:
        wanted = -(-wanted // BUCKET_TASKS) * BUCKET_TASKS
    return current if current and wanted <= 2 * current else wanted


def bucket_tasks(n_buckets: int) -> int:
    """The tasks for so many buckets, each bucket whole in one: a task for each, or BUCKET_TASKS with as many each."""
    return BUCKET_TASKS if n_buckets % BUCKET_TASKS == 0 else n_buckets


# The columns of the two histories and what they are called in the facts.


def incident_fact(key: str, target_table: str = "rep.fact_incident", source_table: str = "stg.incident",
                  n_buckets: int | None = None) -> FactSpec:
    """One row per incident. ``key`` is the history's primary key column."""
    return FactSpec(
        target_table, source_table, "pk_incident", "modification_date_timestamp",
        (
            Field("pk_incident", key),
            Field("incident_no", "bltr"),
            Field("call_type", "call_type"),
            Field("call_source", "call_source"),
            Field("creation_date_timestamp", "creation_date_timestamp", "timestamp"),
            Field("modification_date_timestamp", "modification_date_timestamp", "timestamp"),
            Field("crime_type", "crime_type"),
            Field("date_occurred", "date_occurred", "date"),
            Field("time_occurred", "time_occurred", "clock"),
            Field("date_reported", "date", "date"),
            Field("time_received", "time_received", "clock"),
            Field("time_dispatched", "time_dispatched", "clock"),
            Field("finalisation_status", "finalisation_status"),
            Field("incident_village", "village"),
            Field("section", "section"),
            Field("location", "location"),
            Field("location_of_incident_street", "location_of_incident_street"),
            Field("location_of_incident_other", "location_of_incident_other"),
            Field("flag_alcohol", "alcohol", "flag"),
            Field("flag_domestic", "domestic", "flag"),
            Field("flag_narcotics", "narcotics_flag", "flag"),
            Field("narcotics_type", "narcotics_type"),
            Field("flag_mental_health", "mental_health", "flag"),
            Field("flag_significant", "significant", "flag"),
        ),
        n_buckets,
    )


def charge_fact(incident_key: str, target_table: str = "rep.fact_incident_charge",
                source_table: str = "stg.charges", n_buckets: int | None = None) -> FactSpec:
    """One row per charge. ``incident_key`` is the history's column that points to the incident.

    No integrity is enforced: a charge may arrive before its incident. See ``orphan_rows``.
    """
    return FactSpec(
        target_table, source_table, "pk_incident_charge", "modification_date_timestamp",
        (
            Field("pk_incident_charge", "__pkeycharge_id"),
            Field("arrest_no", "arrest_#"),
            Field("creation_date_timestamp", "creation_timestamp", "timestamp"),
            Field("created_by", "created_by"),
            Field("modification_date_timestamp", "modification_timestamp", "timestamp"),
            Field("fk_incident", incident_key),
            Field("fk_law", "_fkeynyslaw_id"),
            Field("fk_arrest", "_fkeyarrest_id"),
            Field("code", "code"),
            Field("class", "class"),
            Field("offense", "offense"),
            Field("attempt", "attempt", "flag"),
            Field("judge", "judge"),
            Field("disp_date", "disp_date", "date"),
            Field("disp_sentence", "disp_sentence"),
            Field("conviction", "conviction", "flag"),
            Field("counts", "counts", "numeric"),
        ),
        n_buckets,
    )


def project_fact(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """The typed projection: rename, cast, flag. Carries ``loaded_at``."""
    return rows.select(*[_KIND[f.kind](ident(f.source)).alias(f.target) for f in spec.fields], LOADED_AT)


def checked_fact(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """The typed projection with ``refused``: an array of the values that its casts turned into NULL, each with its
    source column, its text and the type that was wanted; empty for a sound row.

    The casts make one projection and the refusals read its columns, so each cast is evaluated once.
    """
    # names of its own for the texts, as a source column may be called like a target
    texts = {c: f"_text_{i}" for i, c in enumerate(spec.source_columns)}
    typed = rows.select(
        *[_KIND[f.kind](ident(f.source)).alias(f.target) for f in spec.fields], LOADED_AT,
        *[ident(c).alias(n) for c, n in texts.items()],
    )
    found = [
        F.when(r.isNotNull(), F.struct(F.lit(f.source).alias("source_column"), r["raw_value"].alias("raw_value"), r["error_type"].alias("error_type")))
        for f in spec.fields if f.kind in CASTS
        for r in [refusal(Field(f.target, texts[f.source], f.kind), ident(f.target))]
    ]
    return typed.select(*[ident(f.target) for f in spec.fields], LOADED_AT, F.array_compact(F.array(*found)).alias("refused"))


def _latest_fact(history: DataFrame, spec: FactSpec, tiebreak: bool, dealt: tuple[int, list] | None = None) -> DataFrame:
    """The typed rows of the latest versions. Rows are typed before they are sorted and exchanged, as typed values are
    narrower than their texts and the modification is then parsed once. Keys are told apart by their text.

    ``dealt`` has a number of tasks, to which rows are dealt by a key that is text, and the keys of so many rows that
    their latest version is found before."""
    rows = not_null_key(history.select(*[ident(c) for c in spec.source_columns], LOADED_AT), spec.source_key)
    key, modified, extra = ident(spec.key), ident(spec.modified), []
    if spec.field_of(spec.key).kind != "text":
        key, extra = F.col("_key"), [ident(spec.source_key).alias("_key")]
    if spec.field_of(spec.modified).kind != "timestamp":
        modified, extra = F.col("_modified"), [*extra, try_ts(ident(spec.source_modified)).alias("_modified")]
    if tiebreak:
        extra.append(row_hash(*[ident(c) for c in spec.source_columns]).alias("_hash"))
    typed = rows.select(*[_KIND[f.kind](ident(f.source)).alias(f.target) for f in spec.fields], LOADED_AT, *extra)
    order = [F.col("_hash").desc()] if tiebreak else ()
    if dealt is not None:
        tasks, hot = dealt
        if hot:
            often = key.cast("string").isin(hot)
            typed = typed.filter(~often).unionByName(latest_version(typed.filter(often), key, modified, order=order))
        typed = typed.repartition(tasks, spec.key)
    latest = latest_version(typed, key, modified, order=order)
    return latest.select(*[ident(f.target) for f in spec.fields], LOADED_AT)


def rebuild(history: DataFrame, spec: FactSpec, tiebreak: bool = False) -> DataFrame:
    """The whole fact from the whole history: latest version per key, typed.

    ``tiebreak`` makes the choice between rows of the same key, modification and load definite, for
    histories in which one batch may hold a key twice.
    """
    return _latest_fact(history, spec, tiebreak)


rebuild_incident = rebuild
rebuild_charge = rebuild


@dataclass(frozen=True)
class Prepared:
    """A written but uncommitted fact version. ``row`` is its state row; None when nothing is new."""

    target_table: str
    outcome: str  # transformed, nothing new, skipped
    row: dict | None = None
    counts: dict | None = None
    floor: dt.datetime | None = None
    ceiling: dt.datetime | None = None


def newest_ceiling(wh: Warehouse) -> dt.datetime | None:
    """The ceiling of the newest succeeded run, without dry runs: what the data is current to."""
    # A run that succeeded stays so: its last event is the one that says it.
    return (
        wh.state("load_run").filter("status = 'succeeded' and not coalesce(dry_run, false)")
        .agg(F.max("watermark_to")).first()[0]
    )


def _text_bytes(columns) -> Column:
    """The text length of a row plus a fixed cost per column."""
    total = F.lit(16 * len(columns)).cast("bigint")
    for c in columns:
        total = total + F.coalesce(F.octet_length(ident(c).cast("string")), F.lit(0))
    return total


def _outline(window: DataFrame, spec: FactSpec):
    """``batch_counts`` of a window with, about, its keys and the text of their latest versions, and the hot keys."""
    key, none = ident(spec.source_key), ident(spec.source_key).isNull()
    total = window.select(*[ident(c) for c in spec.source_columns], LOADED_AT).withColumns({
        "_key": key, "_bytes": F.when(~none, _text_bytes([*spec.source_columns, LOADED_AT, LOADED_AT])),
    }).agg(
        F.count(F.lit(1)).alias("n_batch"), F.count_if(F.col("_key").isNull()).alias("n_nokey"),
        F.approx_count_distinct("_key").alias("n_keys"), F.sum("_bytes").alias("n_bytes"),
        F.expr(f"filter(approx_top_k(coalesce(cast(_key as string), ''), 1000, 10000), x -> x.count > {HOT_ROWS}).item").alias("hot"),
    ).first()
    rows = total.n_batch - total.n_nokey
    return total, round((total.n_bytes or 0) * min(1, total.n_keys / max(rows, 1))), rows <= 2 * total.n_keys


def prepare_transform(wh: Warehouse, spec: FactSpec, source_as_at: dt.datetime | None = None,
                      now: dt.datetime | None = None, history: DataFrame | None = None,
                      ordered_by_load: bool = False, advance_as_at: bool = False,
                      bucket_bytes: int = BUCKET_BYTES, stream: tuple[str, int] | None = None,
                      ) -> Prepared:
    """Take what reached the history since the last commit, keep the latest version of each key,
    and write a new version of the fact. Nothing is visible until the row is committed.

    The floor is ``loaded_at``, the warehouse's clock: a row loaded again after a failure has a new
    one although its modification is unchanged. ``history`` and ``stream`` are given by the stream.
    A batch rewrites the buckets it touches, or all of them when the fact needs more buckets.
    """
    now = now or utc_now()
    state = wh.fact_state(spec.target_table)
    floor = None if stream or state is None else state.last_loaded_at
    history = read_history(wh, spec.source_table) if history is None else history
    if history is None:
        return Prepared(spec.target_table, "skipped")

    ceiling = batch_ceiling(history, floor).first().batch_to
    if ceiling is None:
        row = None
        if advance_as_at and state is not None:
            row = {**state.asDict(), "version": state.version + 1,
                   "source_as_at": source_as_at or newest_ceiling(wh),
                   "updated_at": now, "n_batch": 0, "n_nokey": 0, "n_written": 0}
        return Prepared(spec.target_table, "nothing new", row)

    window = batch_window(history, floor, ceiling)
    counts, batch, n_first = _count_and_build(window, spec, bucket_bytes, fresh=state is None or not state.bucket_versions)
    return _merge_version(
        wh, spec, state, batch, now, bucket_bytes, LOADED_AT if ordered_by_load else None, floor, ceiling,
        {"source_as_at": source_as_at or newest_ceiling(wh), "n_batch": counts.n_batch, "n_nokey": counts.n_nokey,
         "last_loaded_at": max(filter(None, [ceiling, state and state.last_loaded_at])),
         "stream_id": stream[0] if stream else None, "batch_id": stream[1] if stream else None}, n_first=n_first,
    )


def _count_and_build(window: DataFrame, spec: FactSpec, bucket_bytes: int, fresh: bool) -> tuple:
    """The counts of a window, its latest versions, and the number of buckets that these are dealt to already.

    Where nothing is there to merge with and most rows are the latest of their keys, rows are exchanged once, straight to
    their buckets, whose number follows an estimate of the text. Otherwise the number is None: the latest versions are
    found first, within the map tasks too, and dealt when their text is known.
    """
    if fresh and spec.field_of(spec.key).kind == "text":
        counts, n_bytes, mostly_latest = _outline(window, spec)
        if mostly_latest:
            n = spec.n_buckets or bucket_count(n_bytes, 0, bucket_bytes)
            return counts, _latest_fact(window, spec, True, (bucket_tasks(n), counts.hot or [])), n
    else:
        counts = batch_counts(window, spec.source_key).first()
    return counts, rebuild(window, spec, tiebreak=True), None


def _merge_version(wh: Warehouse, spec: FactSpec, state, batch: DataFrame, now: dt.datetime, bucket_bytes: int,
                   loaded_at: str | None, floor, ceiling, row: dict, replace: bool = False, n_first: int | None = None) -> Prepared:
    """Write the batch merged into the snapshot, or in its place, as the next version. ``n_first`` is the number of buckets
    of a batch that is dealt to them already and has nothing to merge with: it is written straight to its version."""
    version = 1 if state is None else state.version + 1
    versions = [] if state is None or replace else list(state.bucket_versions)
    batch = batch.withColumn("transformed_at", ntz(now))
    path = f"{spec.target_table}_batch/v={version}"
    if n_first is not None:
        n, held, touched = n_first, 0, range(n_first)
        merged = upsert_latest(None, batch, spec.key, spec.modified, loaded_at)
    else:
        # The batch is written once: what follows reads it several times, its size is then known,
        # and a lost executor does not cost a second pass over the history.
        size = Observation()
        # A task's report holds the observed expressions, so what they add up is a column before.
        sized = batch.withColumn("_bytes", _text_bytes(batch.columns)).observe(size, F.sum("_bytes").alias("bytes"))
        sized.drop("_bytes").write.mode("overwrite").parquet(wh.path(path))
        staged = wh.spark.read.schema(batch.schema).parquet(wh.path(path))
        held = (state.n_bytes or 0) if versions else 0
        added = size.get["bytes"] or 0
        n = spec.n_buckets or bucket_count(held + added, len(versions), bucket_bytes)
        existing, touched = None, range(n)
        if len(versions) == n:
            touched = [r.b for r in staged.select(bucket_of(F.col(spec.key), n).alias("b")).distinct().collect()]  # at most n
            existing = wh.read_fact(spec, touched if len(touched) < n else None, state, batch.schema)
        elif versions:
            existing = wh.read_fact(spec, None, state, batch.schema)
        tasks = bucket_tasks(n)
        if existing is not None:
            existing = existing.repartition(tasks, spec.key)
        merged = upsert_latest(existing, staged.repartition(tasks, spec.key), spec.key, spec.modified, loaded_at)
    actions = Observation()
    merged = merged.withColumn("_bytes", F.when(F.col("action") == "insert", _text_bytes(batch.columns)))
    counted = [F.count_if(F.col("action") == a).alias(a) for a in ("insert", "update", "stale", "keep")]
    observed = merged.observe(actions, *counted, F.sum("_bytes").alias("bytes"))
    wh.write_fact(observed.drop("action", "_bytes").withColumn("bucket", bucket_of(F.col(spec.key), n)), spec, version)
    if n_first is None:
        wh.clear(path)

    done = actions.get
    inserted = done.pop("bytes") or 0
    versions = versions if len(versions) == n else [None] * n
    for b in touched:
        versions[b] = version
    row = {
        **row, "target_table": spec.target_table, "source_table": spec.source_table, "updated_at": now, "version": version,
        "bucket_versions": versions, "n_bytes": held + inserted, "n_written": done["insert"] + done["update"],
    }
    return Prepared(spec.target_table, "transformed", row, done, floor, ceiling)


def rebuild_fact(wh: Warehouse, spec: FactSpec, source_as_at: dt.datetime | None = None, now: dt.datetime | None = None,
                 bucket_bytes: int = BUCKET_BYTES) -> Prepared:
    """Build the fact anew from what it has consumed of its history, or all of it before its first transform, and
    commit it in as many buckets as it needs. Rows whose history is gone go with it."""
    now, state = now or utc_now(), wh.fact_state(spec.target_table)
    history = read_history(wh, spec.source_table)
    if history is None:
        return Prepared(spec.target_table, "skipped")
    upto = state.last_loaded_at if state is not None else batch_ceiling(history, None).first()[0]
    counts, batch, n_first = _count_and_build(batch_window(history, None, upto), spec, bucket_bytes, fresh=True)
    kept = {k: state[k] for k in ("stream_id", "batch_id")} if state is not None else {}
    prepared = _merge_version(
        wh, spec, state, batch, now, bucket_bytes, None, None, upto, replace=True, n_first=n_first,
        row={**kept, "source_as_at": source_as_at or (state and state.source_as_at) or newest_ceiling(wh),
             "last_loaded_at": upto, "n_batch": counts.n_batch, "n_nokey": counts.n_nokey},
    )
    commit(wh, [prepared])
    return prepared


def commit(wh: Warehouse, prepared: list[Prepared]) -> None:
    """Make prepared versions current, all in one small file: every fact moves forward or none."""
    rows = [p.row for p in prepared if p.row is not None]
    if rows:
        wh.append_state("transform_watermark", rows)


def transform(wh: Warehouse, spec: FactSpec, **options) -> Prepared:
    prepared = prepare_transform(wh, spec, **options)
    commit(wh, [prepared])
    return prepared


transform_incident = transform
transform_charge = transform


def run_transforms(wh: Warehouse, specs: list[FactSpec], source_as_at: dt.datetime | None = None,
                   now: dt.datetime | None = None, parallel: int = 4, **options) -> list[Prepared]:
    """All targets, ``parallel`` at a time, all or nothing: every version is written before the one commit.

    Each call has a job tag of its own. The first target that fails cancels the jobs of the others and keeps those that
    wait from starting; its error is raised once all have ended, and nothing is committed. What the others have written
    belongs to no commit, and the next run writes over it.
    """
    targets = [s.target_table for s in specs]
    if len(set(targets)) < len(targets):
        raise ValueError(f"a target is there twice: {', '.join(targets)}")
    context, tag = wh.spark.sparkContext, f"transforms-{uuid.uuid4().hex}"
    first: list[BaseException] = []
    lock = threading.Lock()

    def prepare(spec: FactSpec) -> Prepared | None:
        if first:
            return None
        context.addJobTag(tag)
        try:
            return prepare_transform(wh, spec, source_as_at=source_as_at, now=now, **options)
        except BaseException as e:  # noqa: BLE001 - raised below, by the thread that asked
            with lock:
                first.append(e)
            if len(first) == 1:
                context.cancelJobsWithTag(tag)
            return None
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        started = [pool.submit(inheritable_thread_target(wh.spark)(prepare), s) for s in specs]
        prepared = [f.result() for f in started]
    if first:
        raise first[0]
    commit(wh, prepared)
    return prepared


def advance_transform_watermark(wh: Warehouse, target_table: str, source_table: str,
                                consumed_to: dt.datetime, source_as_at: dt.datetime | None = None,
                                now: dt.datetime | None = None) -> dict:
    """Record how far a target has consumed its source. The as-at is the given one, else the
    ceiling of the newest succeeded run."""
    state = wh.fact_state(target_table)
    row = dict(state.asDict()) if state is not None else {"target_table": target_table, "version": 0, "bucket_versions": []}
    row |= {
        "source_table": source_table, "last_loaded_at": consumed_to,
        "source_as_at": source_as_at or newest_ceiling(wh), "updated_at": now or utc_now(),
        "version": row["version"] + 1,
    }
    wh.append_state("transform_watermark", [row])
    return row


def record_parse_errors(wh: Warehouse, spec: FactSpec, run_id: str | None, floor: dt.datetime | None,
                        ceiling: dt.datetime | None, now: dt.datetime | None = None) -> None:
    """Append the cast failures of a range of the history to the parse_errors table."""
    history = read_history(wh, spec.source_table)
    if history is None:
        return
    wh.append_state(
        "parse_errors",
        parse_errors(loaded_range(history, floor, ceiling), spec).withColumns({
            "run_id": F.lit(run_id), "source_table": F.lit(spec.source_table), "logged_at": ntz(now or utc_now()),
        }),
    )


def record_refused_lines(wh: Warehouse, source_table: str, fmt: str, refused: DataFrame, run_id: str | None,
                         now: dt.datetime | None = None) -> None:
    """Append the broken lines of a text source to the parse_errors table. They have neither a key nor a column."""
    wh.append_state("parse_errors", refused.select(
        F.lit(run_id).alias("run_id"), F.lit(source_table).alias("source_table"), F.lit(None).cast("string").alias("source_column"),
        F.lit(None).cast("string").alias("row_key"), "raw_value", F.lit(f"not a {fmt} record").alias("error_type"),
        ntz(now or utc_now()).alias("logged_at"),
    ))
