"""Landing and the append-only text history."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tidemark.sources.scan import as_timestamp, ident, ntz, stage_text
from tidemark.sources.store import Warehouse, path_exists, utc_now
from tidemark.spec import HISTORY_COLUMNS, LOAD_DATE, LOADED_AT, WATERMARK


def staged_columns(history: DataFrame) -> list[str]:
    """The column list of a staged table in order, without the warehouse's own columns."""
    return [c for c in history.columns if c not in HISTORY_COLUMNS]


def land_overwrite(wh: Warehouse, landing_table: str, batch: DataFrame) -> int:
    """Replace the landing table with this batch; returns the rows read from the source.

    The count is observed on the way through, so the source is read once.
    """
    seen = Observation()
    (
        batch.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite").parquet(wh.path(landing_table))
    )
    return seen.get["n"]


def append_history(wh: Warehouse, target_table: str, landed: DataFrame, columns, watermark: str | None = None) -> None:
    """Append landed rows by column name, carrying ``loaded_at``.

    History is partitioned by load date, so a transform's range reads only its days. The ``watermark`` column is kept
    as a timestamp as well, so that bounds on it reach the scan. A load that brings no column the history does not have
    leaves the register of its columns alone. Rows of a single date are written as they come, without the sort by date.
    """
    day = F.to_date(LOADED_AT)
    days = landed.agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count_if(day.isNull()).alias("none")).first()
    single = days.first is not None and days.first == days.last and not days.none
    rows = landed.select(*[ident(c) for c in columns], LOADED_AT).withColumn(LOAD_DATE, F.lit(days.first) if single else day)
    if watermark is not None:
        rows = rows.withColumn(WATERMARK, as_timestamp(landed, watermark))
    _register(wh, target_table, rows.schema, watermark)
    rows.write.mode("append").partitionBy(LOAD_DATE).parquet(wh.path(target_table))


def _register(wh: Warehouse, target_table: str, schema: T.StructType, watermark: str | None) -> None:
    """Before rows with new columns are written, the register names them. The watermark stays registered only while
    every load, from the first on, has brought it typed."""
    row = wh.state_row("history_columns", target_table=target_table)
    if row is not None:
        known, typed = T.StructType.fromJson(json.loads(row.fields)), row.watermark
    elif path_exists(wh.spark, wh.path(target_table)):  # filled before there was a register
        old = wh.read(target_table, merge=True)
        known, typed = T.StructType([]) if old is None else old.schema, None if old is not None else watermark
    else:
        known, typed = T.StructType([]), watermark
    names = set(known.fieldNames())
    grown = T.StructType([*known.fields, *[T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in names]])
    kept = watermark if typed == watermark else None
    if row is None or len(grown) > len(known) or kept != row.watermark:
        wh.append_state("history_columns", [{
            "target_table": target_table, "fields": grown.json(), "watermark": kept, "registered_at": utc_now(),
        }])


def read_history(wh: Warehouse, target_table: str) -> DataFrame | None:
    """The whole history. It has the columns of all loads: one that was added to the scope later is NULL before.

    The register gives the columns, so no file's footer is read for them; a history that was filled before there was a
    register shows the columns of all its files. Its typed watermark is there only if every load brought it.
    """
    if not path_exists(wh.spark, wh.path(target_table)):
        return None
    row = wh.state_row("history_columns", target_table=target_table)
    if row is None:
        return wh.read(target_table, merge=True)
    history = wh.read(target_table, T.StructType.fromJson(json.loads(row.fields)))
    return history.drop(WATERMARK) if row.watermark is None else history


def typed_watermark(history: DataFrame, watermark: str) -> Column:
    """A history's watermark as a timestamp: the typed column that loads keep beside the text, else parsed text."""
    return F.col(WATERMARK) if WATERMARK in history.columns else as_timestamp(history, watermark)


def watermark_range(history: DataFrame, watermark: str, floor: dt.datetime | None, ceiling: dt.datetime | None) -> DataFrame:
    """History rows with floor < watermark <= ceiling, a bound that is None left out. With a typed watermark both bounds
    reach the scan and no text is parsed."""
    at = typed_watermark(history, watermark)
    if floor is not None:
        history = history.filter(at > ntz(floor))
    return history if ceiling is None else history.filter(at <= ntz(ceiling))


def read_load_day(wh: Warehouse, target_table: str, day: dt.date) -> DataFrame:
    """The load stamps of one load date of a history, without listing the others or reading a footer for the columns."""
    schema = T.StructType([T.StructField(LOADED_AT, T.TimestampNTZType())])
    return wh.spark.read.schema(schema).parquet(f"{wh.path(target_table)}/{LOAD_DATE}={day.isoformat()}")


def loaded_range(history: DataFrame, floor: dt.datetime | None, ceiling: dt.datetime | None) -> DataFrame:
    """floor < loaded_at <= ceiling, with the matching bounds on the partition column."""
    days = LOAD_DATE in history.columns
    if floor is not None:
        history = history.filter(F.col(LOADED_AT) > ntz(floor))
        if days:
            history = history.filter(F.col(LOAD_DATE) >= F.lit(floor.date()))
    if ceiling is not None:
        history = history.filter(F.col(LOADED_AT) <= ntz(ceiling))
        if days:
            history = history.filter(F.col(LOAD_DATE) <= F.lit(ceiling.date()))
    return history


def next_loaded_at(wh: Warehouse, target_table: str, now: dt.datetime) -> dt.datetime:
    """Reserve a load stamp above every earlier one, so that two batches never share it.

    The last stamp comes from a state row; a history that was filled without one is looked at once.
    """
    row = wh.state_row("load_stamp", target_table=target_table)
    if row is not None:
        last = row.loaded_at
    else:
        history = read_history(wh, target_table)
        last = None if history is None else history.agg(F.max(LOADED_AT)).first()[0]
    stamp = now if last is None or now > last else last + dt.timedelta(microseconds=1)
    wh.append_state("load_stamp", [{"target_table": target_table, "loaded_at": stamp}])
    return stamp


def seed_history(wh: Warehouse, copy: DataFrame, latest_profile: DataFrame, target_table: str,
                 loaded_at: dt.datetime | None) -> int:
    """Fill an empty history from a discovery copy, populated columns only; returns the rows.

    Refuses when there is no profile, when the profile was sampled and when the target holds rows,
    and checks that the row counts agree. ``loaded_at`` restamps the rows, so that a transform that
    had already passed the copy's own stamps still consumes them; None keeps the copy's stamps.
    """
    profile = latest_profile.select("column_name", "populated", "sampled").collect()
    if not profile:
        raise ValueError(f"{target_table}: no profile")
    if any(r.sampled for r in profile):
        raise ValueError(f"{target_table}: the profile was row-limited, columns may be missing")
    kept = sorted(r.column_name for r in profile if r.populated > 0)
    if not kept:
        raise ValueError(f"{target_table}: every column profiled as empty")
    existing = read_history(wh, target_table)
    if existing is not None and not existing.isEmpty():
        raise ValueError(f"{target_table} already holds rows")
    rows = stage_text(copy.select(*[ident(c) for c in kept], *([LOADED_AT] if loaded_at is None else [])))
    if loaded_at is not None:
        rows = rows.withColumn(LOADED_AT, ntz(loaded_at))
    # Through landing, so that a disagreement is found before the history is touched.
    landing = f"lnd.{target_table.split('.')[-1]}"
    land_overwrite(wh, landing, rows)
    landed = wh.spark.read.schema(rows.schema).parquet(wh.path(landing))
    n_copy, n_landed = copy.count(), landed.count()
    if n_copy != n_landed:
        raise ValueError(f"{target_table}: row counts disagree, copy {n_copy}, landed {n_landed}")
    append_history(wh, target_table, landed, kept)
    n_history = read_history(wh, target_table).count()
    if n_copy != n_history:
        raise ValueError(f"{target_table}: row counts disagree, copy {n_copy}, history {n_history}")
    # What an earlier history had reached says nothing about these rows: the next load looks at them.
    wh.append_state("extract_watermark", [{"target_table": target_table, "updated_at": utc_now()}])
    return n_history
