"""Profiles of a growing history: each profile reads what has arrived since the last one and merges the parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.operators.profile import SKETCH_K, merge_parts, profile_part
from tidemark.operators.windows import batch_ceiling, batch_window
from tidemark.sources.history import read_history, staged_columns
from tidemark.sources.scan import ident, ntz
from tidemark.sources.store import Warehouse, path_exists


def parts_table(target_table: str) -> str:
    return f"dsc.{target_table.partition('.')[2]}_profile_parts"


def profile_history(wh: Warehouse, target_table: str, profiled_at: dt.datetime | None = None, restart: bool = False,
                    sketch_k: int = SKETCH_K) -> DataFrame | None:
    """The profile of a whole history; None without one.

    Rows that came after the newest part are read, by load time and load date, and become the next part; older rows are
    not read again. Counts, minima and maxima are exact, distinct counts are estimates of merged sketches. Forget the
    parts with ``restart`` when the history was emptied or rewritten. Rows without a load time are in no part.
    """
    history, table = read_history(wh, target_table), parts_table(target_table)
    if history is None:
        return None
    if restart and path_exists(wh.spark, wh.path(table)):
        wh.clear(table)
    parts = wh.read(table)
    floor = None if parts is None else parts.selectExpr("max(loaded_to)").first()[0]
    ceiling = batch_ceiling(history, floor).first().batch_to
    if ceiling is not None:
        rows = batch_window(history, floor, ceiling).select(*[ident(c) for c in staged_columns(history)])
        part = profile_part(rows, target_table, sketch_k).withColumn("loaded_to", ntz(ceiling))
        part.write.mode("append").parquet(wh.path(table))  # one task, one file: it is there as a whole or not
        parts = wh.read(table)
    return None if parts is None else merge_parts(parts, profiled_at)
