"""Loading: source -> landing -> history, reconciled and audited."""

from __future__ import annotations

import datetime as dt
import socket
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.quality import content_hash, reference_check
from tidemark.operators.windows import high_watermark
from tidemark.plans.facts import record_parse_errors, run_transforms
from tidemark.sources.history import (
    append_history, land_overwrite, next_loaded_at, read_history, read_load_day,
)
from tidemark.sources.scan import ident, scan_bounded, scan_columns, source_count, stage_text, stamp_loaded_at, ntz
from tidemark.sources.store import Warehouse, utc_now
from tidemark.spec import FactSpec, LOADED_AT, TableSpec


@dataclass(frozen=True)
class LoadPlan:
    mode: str  # reference, unbounded or bounded
    floor: dt.datetime | None = None


@dataclass(frozen=True)
class LoadResult:
    source_n: int
    extracted_n: int
    staged_n: int
    loaded_n: int
    bounded: bool
    mode: str  # normal, reference-ok, reference-seed or reference-drift

    def failed_hop(self) -> str:
        if self.bounded and self.source_n != self.extracted_n:
            return "fetch"
        if self.extracted_n != self.staged_n:
            return "land"
        return "append" if self.staged_n != self.loaded_n else "none"


def extract_floor(wh: Warehouse, spec: TableSpec) -> dt.datetime | None:
    """The newest watermark already in the history: from the state row when there is one, else by
    a scan. An empty history has no floor whatever the state says: it is to be read in full."""
    history = read_history(wh, spec.target_table)
    if history is None or history.isEmpty():
        return None
    state = wh.state_row("extract_watermark", target_table=spec.target_table)
    if state is not None and state.last_watermark is not None:
        return state.last_watermark
    return high_watermark(history, spec.watermark_column.lower()).first()[0]


def load_plan(wh: Warehouse, spec: TableSpec) -> LoadPlan:
    """The mode follows from the data: no watermark column, an empty history, or a floor."""
    if spec.is_reference:
        return LoadPlan("reference")
    floor = extract_floor(wh, spec)
    return LoadPlan("unbounded" if floor is None else "bounded", floor)


def _land_and_append(wh: Warehouse, rows: DataFrame, spec: TableSpec, append: bool,
                     loaded_at: dt.datetime) -> tuple[int, int, int]:
    """(extracted, staged, loaded). The source is read once; the two other counts come from what
    was written: file metadata of the landing, and the rows of this load stamp in the history."""
    text = stamp_loaded_at(stage_text(scan_columns(rows, spec.columns)), loaded_at)
    extracted = land_overwrite(wh, spec.staging_table, text)
    landed = wh.spark.read.schema(text.schema).parquet(wh.path(spec.staging_table))
    staged = landed.count()
    if not append:
        return extracted, staged, 0
    append_history(wh, spec.target_table, landed, [c.lower() for c in spec.columns], spec.watermark_column and spec.watermark_column.lower())
    if staged == 0:
        return extracted, staged, 0
    loaded = read_load_day(wh, spec.target_table, loaded_at.date()).filter(F.col(LOADED_AT) == ntz(loaded_at)).count()
    return extracted, staged, loaded


def set_extract_watermark(wh: Warehouse, spec: TableSpec, now: dt.datetime | None = None, restart: bool = False,
                          floor: dt.datetime | None = None) -> dt.datetime | None:
    """Record the floor of the next load: the newest watermark of the landed batch, which is small.
    The floor never moves back, but for a ``restart``: a full load of an empty history. A load that knows its floor
    gives it; otherwise it is looked up."""
    landed = wh.read(spec.staging_table)
    newest = None if landed is None else high_watermark(landed, spec.watermark_column.lower()).first()[0]
    if newest is None:
        return None
    floor = None if restart else floor or extract_floor(wh, spec)
    newest = newest if floor is None else max(floor, newest)
    wh.append_state("extract_watermark", [{
        "source_table": spec.source_table, "target_table": spec.target_table,
        "last_watermark": newest, "updated_at": now or utc_now(),
    }])
    return newest


def incremental_load(wh: Warehouse, source: DataFrame, spec: TableSpec, ceiling: dt.datetime,
                     plan: LoadPlan | None = None, dry_run: bool = False,
                     loaded_at: dt.datetime | None = None) -> LoadResult:
    """One table: bounded above its floor, or in full when its history is empty.

    A run that dies after landing leaves the history as it was; the next run computes the same
    floor and lands the same range again.
    """
    if spec.is_reference:
        return reference_load(wh, source, spec, dry_run, loaded_at)
    plan = plan or load_plan(wh, spec)
    bounded = plan.floor is not None
    source_n = source_count(source, spec.watermark_column, plan.floor, ceiling).first()[0]
    rows = scan_bounded(source, spec.watermark_column, plan.floor, ceiling)
    if dry_run:
        extracted = stage_text(scan_columns(rows, spec.columns)).count()
        return LoadResult(source_n, extracted, 0, 0, bounded, "normal")
    stamp = next_loaded_at(wh, spec.target_table, loaded_at or utc_now())
    counts = _land_and_append(wh, rows, spec, True, stamp)
    if counts[0] == counts[1] == counts[2]:
        set_extract_watermark(wh, spec, restart=not bounded, floor=plan.floor)
    return LoadResult(source_n, *counts, bounded, "normal")


def reference_pull(wh: Warehouse, source: DataFrame, spec: TableSpec, source_n: int, append: bool,
                   dry_run: bool = False, loaded_at: dt.datetime | None = None) -> LoadResult:
    """Read a reference table in full into landing; append to the history only when seeding."""
    mode = "reference-seed" if append else "reference-drift"
    if dry_run:
        return LoadResult(source_n, 0, 0, 0, False, mode)
    stamp = next_loaded_at(wh, spec.target_table, loaded_at or utc_now())
    return LoadResult(source_n, *_land_and_append(wh, source, spec, append, stamp), False, mode)


def reference_load(wh: Warehouse, source: DataFrame, spec: TableSpec, dry_run: bool = False,
                   loaded_at: dt.datetime | None = None, compare_content: bool = False) -> LoadResult:
    """A table without a watermark: compare counts, seed an empty history, report a difference.

    A difference lands the table for inspection and leaves the history unchanged. A count cannot
    see an edit in place; ``compare_content`` reads both sides and can.
    """
    history = read_history(wh, spec.target_table)
    check = reference_check(source, source.limit(0) if history is None else history).first()
    source_n = check.source_n
    if check["mode"] == "reference-seed":
        return reference_pull(wh, source, spec, source_n, True, dry_run, loaded_at)
    same = check["mode"] == "reference-ok"
    if same and compare_content:
        text = stage_text(scan_columns(source, spec.columns))
        same = content_hash(text).first() == content_hash(history.select(*[ident(c) for c in text.columns])).first()
    if same:
        return LoadResult(source_n, 0, 0, 0, False, "reference-ok")
    return reference_pull(wh, source, spec, source_n, False, dry_run, loaded_at)


class Audit:
    """Start and finish events of a run and its tables. Append-only: a repeat is harmless, and the
    record of a failure does not depend on what failed."""

    def __init__(self, wh: Warehouse, clock=utc_now):
        self.wh = wh
        self.clock = clock
        self.run_id: str | None = None
        self._run: dict = {}
        self._tables: dict[str, dict] = {}
        self._seq = 0
        self._lock = threading.Lock()

    def _append(self, name: str, rows: list[dict]) -> None:
        with self._lock:
            self._seq += 1
            seq = self._seq
        self.wh.append_state(name, [{**r, "event_at": self.clock(), "event_seq": seq} for r in rows])

    def start_run(self, watermark_to: dt.datetime, trigger_source: str = "manual", dry_run: bool = False) -> str:
        self.run_id = uuid.uuid4().hex
        self._run = {
            "run_id": self.run_id, "started_at": self.clock(), "watermark_to": watermark_to,
            "status": "running", "trigger_source": trigger_source, "host_name": socket.gethostname(),
            "dry_run": dry_run,
        }
        self._append("load_run", [self._run])
        return self.run_id

    def start_table(self, source_table: str, watermark_from: dt.datetime | None) -> None:
        self._tables[source_table] = {
            "run_id": self.run_id, "source_table": source_table, "watermark_from": watermark_from,
            "started_at": self.clock(), "status": "running",
        }
        self._append("load_table_run", [self._tables[source_table]])

    def finish_table(self, source_table: str, status: str, result: LoadResult | None = None,
                     error: str | None = None) -> None:
        row = self._tables.get(source_table) or {
            "run_id": self.run_id, "source_table": source_table, "started_at": self.clock(),
        }
        row = {**row, "status": status, "finished_at": self.clock(),
               "error_message": error}
        if result is not None:
            row |= {
                "source_row_count": result.source_n, "extracted_row_count": result.extracted_n,
                "staged_row_count": result.staged_n, "loaded_row_count": result.loaded_n,
            }
        self._append("load_table_run", [row])

    def finish_run(self, status: str, error: str | None = None) -> None:
        self._append("load_run", [{**self._run, "status": status, "finished_at": self.clock(), "error_message": error}])


@dataclass(frozen=True)
class RunReport:
    run_id: str
    status: str
    error: str | None
    tables: dict
    transforms: list


def run_load(wh: Warehouse, sources: dict[str, DataFrame], specs: list[TableSpec], ceiling: dt.datetime | None = None,
             facts: list[FactSpec] = (), dry_run: bool = False, trigger_source: str = "manual",
             clock=utc_now, parallel: int = 1, log_parse_errors: bool = False) -> RunReport:
    """The nightly run: every table, then the transforms when no table failed.

    One ceiling for all tables, in whole seconds. A table that fails does not stop the others but
    keeps the facts as they were; drift fails nothing; a failed transform fails the run and leaves
    the loads, which the next run consumes. ``parallel`` loads that many tables at a time.
    ``log_parse_errors`` records the values of the consumed rows that a guarded cast refused.
    """
    ceiling = ceiling or clock().replace(microsecond=0)
    audit = Audit(wh, clock)
    audit.start_run(ceiling, trigger_source, dry_run)

    def load_one(spec: TableSpec) -> tuple[str, LoadResult | None, bool]:
        """(table, result, failed): loads, reconciles and records one table."""
        name = spec.source_table
        try:
            plan = load_plan(wh, spec)
            audit.start_table(name, plan.floor)
            result = incremental_load(wh, sources[name], spec, ceiling, plan, dry_run)
        except Exception as e:  # noqa: BLE001 - recorded, and the other tables go on
            audit.finish_table(name, "failed", error=str(e))
            return name, None, True
        if result.mode == "reference-drift":
            audit.finish_table(name, "drift", result, (
                f"reference table drift: {result.source_n} rows at source, {result.staged_n} landed in "
                f"{spec.staging_table}, {spec.target_table} left unchanged"
            ))
            return name, result, False
        sound = dry_run or result.mode == "reference-ok" or result.failed_hop() == "none"
        audit.finish_table(name, "succeeded" if sound else "failed", result,
                           None if sound else "counts do not reconcile")
        return name, result, not sound

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        outcomes = list(pool.map(load_one, specs))
    results = {name: result for name, result, _ in outcomes if result is not None}
    failures = [name for name, _, failed in outcomes if failed]

    done, error = [], None
    if failures:
        error = "tables failed: " + ", ".join(failures)
    elif not dry_run and facts:
        try:
            done = run_transforms(wh, list(facts), source_as_at=ceiling)
        except Exception as e:  # noqa: BLE001
            error = f"loaded, but transform failed: {e}"
    status = "succeeded" if error is None else "failed"
    try:
        for spec, p in zip(facts, done):
            if log_parse_errors and p.outcome == "transformed":
                record_parse_errors(wh, spec, audit.run_id, p.floor, p.ceiling)
    except Exception as e:  # noqa: BLE001 - the facts are committed; the run stands
        error = f"transformed, but parse errors were not recorded: {e}"
    audit.finish_run(status, error)
    return RunReport(audit.run_id, status, error, results, done)


def dry_run(wh: Warehouse, source: DataFrame, spec: TableSpec, ceiling: dt.datetime) -> LoadResult:
    """Extract and count; nothing is written and nothing is transformed."""
    return incremental_load(wh, source, spec, ceiling, dry_run=True)
