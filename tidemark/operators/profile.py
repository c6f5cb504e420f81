"""Column profiles: what each column of a text table holds.

A profile is long: one row per (source_table, column_name, profiled_at). All rows of one run share
their ``profiled_at``, and "latest" is decided per table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.casts import clock_kind, try_date, try_numeric, try_ts
from tidemark.sources.scan import ident, ntz, stage_text
from tidemark.spec import LOAD_DATE, LOADED_AT

# The shapes counted by the profile. The timestamp shape is open at its end.
LOOKS_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}"
LOOKS_DATE = r"^\d{4}-\d{2}-\d{2}\z"
LOOKS_NUMERIC = r"^-?\d+(\.\d+)?\z"

# Name patterns of watermark candidates, tried in this order.
MODIFICATION_NAME = r"(?i)(modif|updat|changed|amend|edit)"
CREATION_NAME = r"(?i)creat"

#: Size of a distinct-count sketch: 2**12 registers, 4 KB, a standard error of about 1.6 %.
SKETCH_K = 12


def _percent(part: str, total: str) -> Column:
    """Percent with one decimal, half rounded up, in whole-number arithmetic."""
    tenths = F.expr(f"(2000 * {part} + {total}) div (2 * nullif({total}, 0))")
    return (tenths.cast("decimal(12,1)") / 10).cast("decimal(5,1)")


def _numbered(df: DataFrame) -> tuple[DataFrame, Column]:
    """(column_no, value) for every cell, and the expression that gives the column's name back.

    The number travels through the shuffle instead of the name, which is often longer than the value.
    """
    text = df.toDF(*[str(i) for i in range(len(df.columns))])
    cells = text.unpivot([], [ident(c) for c in text.columns], "column_no", "value")
    names = F.array(*[F.lit(c) for c in df.columns])
    return cells, F.element_at(names, F.col("column_no").cast("int") + 1).alias("column_name")


def _per_value(cells: DataFrame) -> DataFrame:
    """Every distinct (column, value) with its count: the only shuffle that grows with the data,
    and repeated values, however many, are already summed before it."""
    return cells.groupBy("column_no", "value").agg(F.count(F.lit(1)).alias("n"))


def _data_text(df: DataFrame) -> DataFrame:
    return stage_text(df.select(*[ident(c) for c in df.columns if c not in (LOADED_AT, LOAD_DATE)]))


def profile_columns(df: DataFrame, source_table: str, sampled: bool = False,
                    profiled_at: dt.datetime | None = None, approximate_distinct: bool = False) -> DataFrame:
    """Fill rate, distinct values, apparent types and range of every column.

    Blanks-only values count as populated, empty strings do not. Minimum and maximum are in byte
    order. Two steps: count per value, then fold the values of each column, so text minimum and
    maximum are taken over distinct values only. ``approximate_distinct`` trades the exact distinct
    count for a sketch; key detection needs the exact one.
    """
    cells, column_name = _numbered(_data_text(df))
    if approximate_distinct:
        counted = cells.withColumn("n", F.lit(1).cast("bigint"))
        distinct = F.approx_count_distinct(F.nullif(F.col("value"), F.lit("")))
    else:
        counted = _per_value(cells)
        distinct = F.count(F.nullif(F.col("value"), F.lit("")))
    value, n = F.nullif(F.col("value"), F.lit("")), F.col("n")

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    folded = counted.groupBy("column_no").agg(
        F.sum(n).alias("total_rows"),
        rows_where(value.isNotNull()).alias("populated"),
        distinct.alias("distinct_values"),
        rows_where(value.rlike(LOOKS_TIMESTAMP)).alias("looks_timestamp"),
        rows_where(value.rlike(LOOKS_DATE)).alias("looks_date"),
        rows_where(value.rlike(LOOKS_NUMERIC)).alias("looks_numeric"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )
    out = folded.select(
        F.lit(source_table).alias("source_table"), column_name, "total_rows", "populated",
        _percent("populated", "total_rows").alias("pct_filled"), "distinct_values",
        "looks_timestamp", "looks_date", "looks_numeric", "min_value", "max_value",
        F.lit(sampled).alias("sampled"),
    )
    return out if profiled_at is None else out.withColumn("profiled_at", ntz(profiled_at))


def profile_part(df: DataFrame, source_table: str, sketch_k: int = SKETCH_K) -> DataFrame:
    """What a profile needs to know of some rows, in a form that merges: counts, range and a sketch of distinct values.

    One global aggregation of the wide rows: cells are neither unpivoted nor shuffled, a task gives one row. Grouping
    cells by column would sort them where there are more columns than a hash map of sketches may hold.
    """
    text = _data_text(df)
    numbered = text.toDF(*[str(i) for i in range(len(text.columns))])
    measures = []
    for i, name in enumerate(text.columns):
        value = F.nullif(ident(str(i)), F.lit(""))
        measures.append(F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("total_rows"), F.count(value).alias("populated"),
            F.count_if(value.rlike(LOOKS_TIMESTAMP)).alias("looks_timestamp"),
            F.count_if(value.rlike(LOOKS_DATE)).alias("looks_date"),
            F.count_if(value.rlike(LOOKS_NUMERIC)).alias("looks_numeric"),
            F.min(value).alias("min_value"), F.max(value).alias("max_value"),
            F.hll_sketch_agg(value, sketch_k).alias("sketch"),
        ))
    return numbered.agg(F.array(*measures).alias("_c")).select(F.lit(source_table).alias("source_table"), F.inline("_c"))


def merge_parts(parts: DataFrame, profiled_at: dt.datetime | None = None) -> DataFrame:
    """The profile of all parts' rows, in the columns of ``profile_columns``; ``loaded_to`` tells the parts of a table apart.

    A column that joined the table later is empty in the rows of parts that do not name it.
    """
    rows = parts.select("source_table", "loaded_to", "total_rows").distinct().groupBy("source_table").agg(
        F.sum("total_rows").alias("total_rows")
    )
    summed = [F.sum(c).alias(c) for c in ("populated", "looks_timestamp", "looks_date", "looks_numeric")]
    folded = parts.groupBy("source_table", "column_name").agg(
        *summed, F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("distinct_values"),
    ).join(rows, "source_table")
    out = folded.select(
        "source_table", "column_name", "total_rows", "populated", _percent("populated", "total_rows").alias("pct_filled"),
        F.least("distinct_values", "populated").alias("distinct_values"),
        "looks_timestamp", "looks_date", "looks_numeric", "min_value", "max_value", F.lit(False).alias("sampled"),
    )
    return out if profiled_at is None else out.withColumn("profiled_at", ntz(profiled_at))


def profile_light(df: DataFrame) -> DataFrame:
    """Fill rate and distinct values only; ``loaded_at`` is profiled like any other column."""
    names = [c for c in df.columns if c != LOAD_DATE]
    # Positional names while staging, so that loaded_at becomes text like the rest.
    text = stage_text(df.select(*[ident(c).alias(f"c{i}") for i, c in enumerate(names)])).toDF(*names)
    cells, column_name = _numbered(text)
    value = F.nullif(F.col("value"), F.lit(""))
    folded = _per_value(cells).groupBy("column_no").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(value.isNotNull(), F.col("n")).otherwise(0)).alias("populated"),
        F.count(value).alias("distinct_values"),
    )
    return folded.select(
        column_name, "populated", _percent("populated", "total_rows").alias("pct_filled"),
        "distinct_values",
    )


def newest_per(df: DataFrame, key: str, at: str) -> DataFrame:
    """All rows of the newest ``at`` per key.

    Aggregate and join rather than a window: the maximum is partly computed before the shuffle, and
    the join key includes the time, so a key with very many rows is not gathered in one task.
    """
    newest = df.groupBy(key).agg(F.max(at).alias(at))
    return df.join(newest, [key, at], "left_semi")


def latest_profile(profiles: DataFrame) -> DataFrame:
    """The rows of the newest profiling run of each table."""
    return newest_per(profiles, "source_table", "profiled_at")


def profile_summary(latest: DataFrame) -> DataFrame:
    """Per table: columns, columns without any value, columns that never vary, rows.

    ``constant_columns`` counts one distinct value in any number of rows; ``constant_multi`` only
    where at least two rows hold it.
    """
    constant = F.col("distinct_values") == 1
    return latest.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if(F.col("populated") == 0).alias("empty_columns"),
        F.count_if((F.col("populated") > 0) & constant).alias("constant_columns"),
        F.count_if((F.col("populated") > 1) & constant).alias("constant_multi"),
        F.max("total_rows").alias("n_rows"),
    )


def empty_columns(latest: DataFrame) -> DataFrame:
    return latest.filter("populated = 0").select("source_table", "column_name", "total_rows", "sampled")


def constant_columns(latest: DataFrame) -> DataFrame:
    """Columns with one value in two rows or more, and that value."""
    return latest.filter("populated > 1 and distinct_values = 1").select(
        "source_table", "column_name", "populated", F.col("min_value").alias("the_only_value")
    )


def watermark_candidates(latest: DataFrame) -> DataFrame:
    """Columns whose every populated value looks like a timestamp, with what the name suggests."""
    kind = (
        F.when(F.col("column_name").rlike(MODIFICATION_NAME), "modification")
        .when(F.col("column_name").rlike(CREATION_NAME), "creation (not usable)")
        .otherwise("unclassified")
    )
    return latest.filter("looks_timestamp > 0 and looks_timestamp = populated").select(
        "source_table", "column_name", "populated", "min_value", "max_value", kind.alias("kind")
    )


def cast_survival(df: DataFrame) -> DataFrame:
    """Per column, how many populated values survive each guarded cast.

    Plain counts over the unpivoted cells: partly summed in the map tasks, no value is shuffled.
    """
    cells, column_name = _numbered(_data_text(df))
    value = F.nullif(F.col("value"), F.lit(""))
    counts = cells.groupBy("column_no").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(value).alias("populated"),
        F.count(try_ts(value)).alias("as_timestamp"),
        F.count(try_date(value)).alias("as_date"),
        F.count_if(clock_kind(value) == "clock").alias("as_clock"),
        F.count(try_numeric(value)).alias("as_numeric"),
    )
    return counts.select(column_name, *counts.columns[1:])


def record_profile(wh, profile: DataFrame, profiled_at: dt.datetime) -> None:
    """Append one profiling run; all its rows share one ``profiled_at``."""
    wh.append_state("column_profile", profile.withColumn("profiled_at", ntz(profiled_at)))
