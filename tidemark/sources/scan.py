"""Reading a source and turning it into staging text.

A source is any batch DataFrame: parquet, csv, json, orc or JDBC through ``read_source``, or one
the caller already holds. Nothing here shuffles; filters and column lists reach the scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.casts import try_ts
from tidemark.functions.text import number_text
from tidemark.spec import LOADED_AT

TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def read_source(spark: SparkSession, fmt: str, path: str | None = None, schema=None, **options) -> DataFrame:
    """A source in any format Spark reads. Text formats need a schema: nothing is inferred."""
    if fmt in ("csv", "json") and schema is None:
        raise ValueError(f"a {fmt} source needs an explicit schema")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


REFUSED_LINE = "_refused_line"


@dataclass(frozen=True)
class TextScan:
    """The sound rows of a text source, and ``refused``: ``raw_value``, each line that is not a record of its schema."""

    rows: DataFrame
    refused: DataFrame


def scan_text(spark: SparkSession, fmt: str, path: str, schema: T.StructType | str, folder: str, **options) -> TextScan:
    """Read csv or json in permissive mode, once: sound rows and broken lines go side by side to ``folder``, a new folder
    that the cluster shares, and are read from there.

    A line with too few or too many fields, a value of another type or broken syntax is refused as a whole and kept as
    it was. Were the source read again for each side, a query of some columns would judge a line by these alone.
    Blank lines are no records. An empty source gives two empty frames.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"{fmt} is no text format")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if REFUSED_LINE in schema.fieldNames():
        raise ValueError(f"{REFUSED_LINE} is a reserved name")
    wide = T.StructType([*schema.fields, T.StructField(REFUSED_LINE, T.StringType())])
    options = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REFUSED_LINE}
    read = read_source(spark, fmt, path, wide, **options)
    read.withColumn("_broken", ident(REFUSED_LINE).isNotNull()).write.partitionBy("_broken").parquet(folder)
    both = spark.read.schema(T.StructType([*wide.fields, T.StructField("_broken", T.BooleanType())])).parquet(folder)
    return TextScan(
        both.filter("NOT _broken").drop("_broken", REFUSED_LINE),
        both.filter("_broken").select(ident(REFUSED_LINE).alias("raw_value")),
    )


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names; two names that become equal are an error."""
    names = [c.lower() for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column names collide in lower case: {', '.join(repeated)}")
    return df.toDF(*names)


def ident(name: str) -> Column:
    """A column by its exact name, also when the name holds dots, blanks or #."""
    return F.col("`" + name.replace("`", "``") + "`")


def scan_columns(df: DataFrame, columns) -> DataFrame:
    """A pinned column list, in list order. A listed column that is missing is an error."""
    present = {c.lower(): c for c in df.columns}
    missing = [c for c in columns if c.lower() not in present]
    if missing:
        raise ValueError(f"not in the source: {', '.join(missing)}")
    return df.select(*[ident(present[c.lower()]).alias(c.lower()) for c in columns])


def scan_all(df: DataFrame) -> DataFrame:
    """The full width and every row: no predicate, names in lower case."""
    return normalise_columns(df)


def scan_sample(df: DataFrame, n: int) -> DataFrame:
    """The first n rows, marked as sampled so that nothing derived from them passes for complete.

    Which rows come first is not defined.
    """
    return df.limit(n).withColumn("sampled", F.lit(True))


def as_timestamp(df: DataFrame, column: str) -> Column:
    """A watermark column, in any case, as a timestamp: itself when typed, so filters on it reach the scan."""
    if column not in df.columns:
        column = next((c for c in df.columns if c.lower() == column.lower()), column)
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return ident(column)
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return ident(column).cast("timestamp_ntz")
    return try_ts(ident(column))


def ntz(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def scan_bounded(df: DataFrame, watermark: str, floor: dt.datetime | None, ceiling: dt.datetime | None) -> DataFrame:
    """floor < watermark <= ceiling. Without a floor there is no predicate at all."""
    if floor is None:
        return df
    wm = as_timestamp(df, watermark)
    return df.filter((wm > ntz(floor)) & (wm <= ntz(ceiling)))


def source_count(df: DataFrame, watermark: str | None = None, floor: dt.datetime | None = None,
                 ceiling: dt.datetime | None = None) -> DataFrame:
    """Rows at the source: of the range when there is a floor, of the whole table otherwise."""
    if watermark is not None and floor is not None:
        df = scan_bounded(df, watermark, floor, ceiling)
    return df.agg(F.count(F.lit(1)).alias("source_n"))


def _as_text(field: T.StructField) -> Column:
    c = ident(field.name)
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return c
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return number_text(c)
    if isinstance(kind, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise TypeError(f"{field.name}: {kind.simpleString()} has no staging text")
    return c.cast("string")


def stage_text(df: DataFrame) -> DataFrame:
    """Every column as text. NULL stays NULL. ``loaded_at`` keeps its type."""
    return df.select(
        *[
            ident(f.name) if f.name == LOADED_AT else _as_text(f).alias(f.name)
            for f in df.schema.fields
        ]
    )


def trim_temporal(df: DataFrame) -> DataFrame:
    """Dates and timestamps as trimmed text; other columns unchanged."""
    return df.select(
        *[
            F.trim(ident(f.name).cast("string")).alias(f.name)
            if isinstance(f.dataType, TEMPORAL_TYPES) and f.name != LOADED_AT
            else ident(f.name)
            for f in df.schema.fields
        ]
    )


def stamp_loaded_at(df: DataFrame, at: dt.datetime) -> DataFrame:
    """The warehouse clock, one value for the whole landing batch."""
    return df.withColumn(LOADED_AT, ntz(at))
