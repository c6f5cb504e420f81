"""From a profile to an extract scope: columns, key, watermark, staging schema, drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import quote_name
from tidemark.operators.profile import MODIFICATION_NAME, latest_profile
from tidemark.spec import LOADED_AT

# The markers of a configuration that needs a decision by hand.
NO_KEY = "NO UNIQUE COMPLETE COLUMN IN THE PROFILE - SET THIS BY HAND"
NO_WATERMARK = "NO MODIFICATION TIMESTAMP IN THE PROFILE - FULL REFRESH ONLY"
PRIMARY_PREFIX = "__pkey"

# The findings of the drift check.
DRIFT_MISSING_FROM_HISTORY = "populated at source, missing from stg"
DRIFT_NOT_POPULATED = "in stg, not populated at source"
DRIFT_MISSING_FROM_LANDING = "in stg, missing from lnd - regenerate lnd"
DRIFT_ONLY_IN_LANDING = "in lnd, not in stg"


def _ordered_names(condition: Column) -> Column:
    """The names for which the condition holds, in byte order. Bounded by one table's columns."""
    return F.array_sort(F.collect_list(F.when(condition, F.col("column_name"))))


def column_list(latest: DataFrame) -> DataFrame:
    """Per table the populated columns, quoted and comma-joined, in name order."""
    quoted = F.array_join(F.transform(_ordered_names(F.col("populated") > 0), quote_name), ", ")
    return latest.groupBy("source_table").agg(F.nullif(quoted, F.lit("")).alias("column_list"))


def profile_facts(latest: DataFrame) -> DataFrame:
    """Per table: when it was profiled, whether sampled, all columns, kept columns and their names."""
    return latest.groupBy("source_table").agg(
        F.max("profiled_at").alias("profiled_at"),
        F.bool_or("sampled").alias("sampled"),
        F.count(F.lit(1)).alias("all_cols"),
        F.count_if(F.col("populated") > 0).alias("kept_cols"),
        _ordered_names(F.col("populated") > 0).alias("columns"),
    )


def _first_name(condition: Column, preferred: Column | None = None) -> Column:
    """The first column name for which the condition holds; preferred names go before the others.

    A minimum, not a sort: it is partly computed before the shuffle.
    """
    name = F.col("column_name")
    if preferred is None:
        return F.min(F.when(condition, name))
    return F.coalesce(F.min(F.when(condition & preferred, name)), F.min(F.when(condition, name)))


def _key_condition() -> Column:
    return F.expr("populated = total_rows and distinct_values = populated and populated > 0")


def _watermark_condition() -> Column:
    return F.expr("populated > 0 and looks_timestamp = populated") & F.col("column_name").rlike(
        MODIFICATION_NAME
    )


def key_candidate(latest: DataFrame) -> DataFrame:
    """Per table the complete and unique column: a declared primary name first, then by name."""
    found = _first_name(_key_condition(), F.col("column_name").startswith(PRIMARY_PREFIX))
    return latest.groupBy("source_table").agg(found.alias("key_column")).filter("key_column is not null")


def watermark_column(latest: DataFrame) -> DataFrame:
    """Per table the first modification-named column that is a timestamp wherever it is filled."""
    found = _first_name(_watermark_condition())
    return latest.groupBy("source_table").agg(found.alias("watermark_column")).filter(
        "watermark_column is not null"
    )


def table_config(latest: DataFrame) -> DataFrame:
    """Per table the load configuration its profile supports, with markers where it supports none.

    Tables without any populated column have none.
    """
    name = F.lower("source_table")
    facts = latest.groupBy("source_table").agg(
        _first_name(_key_condition(), F.col("column_name").startswith(PRIMARY_PREFIX)).alias("k"),
        _first_name(_watermark_condition()).alias("w"),
        _ordered_names(F.col("populated") > 0).alias("columns"),
    )
    return facts.filter(F.size("columns") > 0).select(
        "source_table",
        F.concat(F.lit("stg."), name).alias("target_table"),
        F.concat(F.lit("lnd."), name).alias("staging_table"),
        F.coalesce("k", F.lit(NO_KEY)).alias("key_column"),
        F.coalesce("w", F.lit(NO_WATERMARK)).alias("watermark_column"),
        "columns",
    )


def config_json(config: DataFrame) -> DataFrame:
    """The same configuration as one JSON document per table."""
    fields = ["source_table", "target_table", "staging_table", "key_column", "watermark_column", "columns"]
    return config.select("source_table", F.to_json(F.struct(*fields)).alias("config"))


def stage_schema(profiles: DataFrame, source_table: str, allow_sampled: bool = False) -> T.StructType:
    """The staging schema of a table: populated columns as text, then ``loaded_at``.

    An error without a profile, from a sampled profile unless allowed, and when all columns are
    empty: a schema from such a profile would leave out real columns.
    """
    facts = profile_facts(latest_profile(profiles.filter(F.col("source_table") == source_table))).first()
    if facts is None:
        raise ValueError(f"no profile for {source_table}")
    if facts.sampled and not allow_sampled:
        raise ValueError(f"the latest profile of {source_table} was row-limited")
    if not facts.columns:
        raise ValueError(f"every column of {source_table} profiled as empty")
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in facts.columns]
        + [T.StructField(LOADED_AT, T.TimestampNTZType(), False)]
    )


def scope_drift(staged: DataFrame, profiled: DataFrame, landed: DataFrame) -> DataFrame:
    """Column names present on one side only: history against profile, history against landing.

    Each input has a ``column_name``; ``staged`` and ``landed`` include ``loaded_at``, ``profiled``
    holds the populated columns. Empty when all agree.
    """

    def one_sided(label: str, other: DataFrame, left: DataFrame, missing_left: str, missing_right: str) -> DataFrame:
        s, o = F.col("_in_stg"), F.col("_in_other")
        both = left.select("column_name", F.lit(True).alias("_in_stg")).join(
            other.select("column_name", F.lit(True).alias("_in_other")), "column_name", "full_outer"
        )
        return both.filter(s.isNull() | o.isNull()).select(
            F.lit(label).alias("check"), "column_name",
            F.when(s.isNull(), missing_left).otherwise(missing_right).alias("detail"),
        )

    data_columns = staged.filter(F.col("column_name") != LOADED_AT)
    return one_sided(
        "stg vs profile", profiled, data_columns, DRIFT_MISSING_FROM_HISTORY, DRIFT_NOT_POPULATED
    ).unionByName(
        one_sided("stg vs lnd", landed, staged, DRIFT_ONLY_IN_LANDING, DRIFT_MISSING_FROM_LANDING)
    )


def column_names(df: DataFrame) -> DataFrame:
    """A DataFrame's column names as a frame, for comparisons with a profile."""
    spark = df.sparkSession
    return spark.createDataFrame([(c,) for c in df.columns], "column_name string")
