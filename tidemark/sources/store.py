"""A warehouse directory: landing, history, snapshots and state tables, all parquet.

    lnd/<table>                     the last run's delta, overwritten each run
    stg/<table>/load_date=<date>    append-only text history
    dsc/<table>                     discovery copies
    rep/<fact>/v=<n>/bucket=<b>     typed facts; a version holds the buckets it rewrote
    elt/<state table>               append-only state rows

Nothing that is being read is ever overwritten. A fact version counts once a state row names it;
the state row is one small file, so a commit of several facts is all or nothing. Everything goes
through Spark's reader and writer, so the root may be on any file system the cluster shares.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.spec import FactSpec

_NTZ = T.TimestampNTZType()


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


_S, _L, _B, _I = T.StringType(), T.LongType(), T.BooleanType(), T.IntegerType()

# The columns of the state tables.
STATE_SCHEMAS = {
    "load_run": _schema(
        run_id=_S, started_at=_NTZ, finished_at=_NTZ, watermark_to=_NTZ, status=_S,
        trigger_source=_S, host_name=_S, error_message=_S, dry_run=_B, event_at=_NTZ, event_seq=_L,
    ),
    "load_table_run": _schema(
        run_id=_S, source_table=_S, watermark_from=_NTZ, source_row_count=_L,
        extracted_row_count=_L, staged_row_count=_L, loaded_row_count=_L, started_at=_NTZ,
        finished_at=_NTZ, status=_S, error_message=_S, event_at=_NTZ, event_seq=_L,
    ),
    "extract_watermark": _schema(
        source_table=_S, target_table=_S, last_watermark=_NTZ, updated_at=_NTZ,
    ),
    "load_stamp": _schema(target_table=_S, loaded_at=_NTZ),
    # One row for each change of a history's columns; `fields` is the schema of all its loads so far.
    "history_columns": _schema(target_table=_S, fields=_S, watermark=_S, registered_at=_NTZ),
    "transform_watermark": _schema(
        target_table=_S, source_table=_S, last_loaded_at=_NTZ, source_as_at=_NTZ, updated_at=_NTZ,
        version=_L, bucket_versions=T.ArrayType(_L), n_batch=_L, n_nokey=_L, n_written=_L,
        stream_id=_S, batch_id=_L, n_bytes=_L,
    ),
    "column_profile": _schema(
        source_table=_S, column_name=_S, total_rows=_L, populated=_L,
        pct_filled=T.DecimalType(5, 1), distinct_values=_L, looks_timestamp=_L, looks_date=_L,
        looks_numeric=_L, min_value=_S, max_value=_S, sampled=_B, profiled_at=_NTZ,
    ),
    "table_probe": _schema(
        source_table=_S, status=_S, readable=_B, column_count=_L, has_rows=_B, elapsed_ms=_L,
        sqlstate=_S, native_error=_I, message=_S, probed_at=_NTZ,
    ),
    "parse_errors": _schema(
        run_id=_S, source_table=_S, source_column=_S, row_key=_S, raw_value=_S, error_type=_S,
        logged_at=_NTZ,
    ),
}

# The rows that tell the current state of an event table: one per key, the newest by order.
CURRENT_BY = {
    "load_run": (["run_id"], ["event_at", "event_seq"]),
    "load_table_run": (["run_id", "source_table"], ["event_at", "event_seq"]),
    "extract_watermark": (["target_table"], ["updated_at"]),
    "load_stamp": (["target_table"], ["loaded_at"]),
    "history_columns": (["target_table"], ["registered_at"]),
    "transform_watermark": (["target_table"], ["version"]),
}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder the cluster names in spark.checkpoint.dir; below its warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system it is on."""
    p, fs = path_of(spark, path)
    return fs.exists(p)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._state_lock = threading.Lock()

    def path(self, table: str) -> str:
        """'stg.orders' -> <root>/stg/orders"""
        zone, _, name = table.partition(".")
        return f"{self.root}/{zone}/{name}"

    def read(self, table: str, schema: T.StructType | None = None, merge: bool = False) -> DataFrame | None:
        """The table, or None when nothing has been written to it. ``merge`` unites the columns of all its files."""
        if not path_exists(self.spark, self.path(table)):
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.option("mergeSchema", merge).parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without any file
                return None
            raise

    def clear(self, table: str) -> None:
        """Delete all files of a table; its state rows stay."""
        p, fs = path_of(self.spark, self.path(table))
        fs.delete(p, True)

    # -- state tables ---------------------------------------------------------------------------

    def _state_path(self, name: str) -> str:
        return f"{self.root}/elt/{name}"

    def append_state(self, name: str, rows) -> None:
        """Append state rows. A list of dicts becomes one file, so it appears as a whole or not."""
        schema = STATE_SCHEMAS[name]
        if isinstance(rows, DataFrame):
            df = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        else:
            # An Arrow table becomes a local relation: no Python worker starts for a handful of rows.
            columns = {f.name: [r.get(f.name) for r in rows] for f in schema.fields}
            df = self.spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema))).coalesce(1)
        # Two writers of one folder would remove each other's temporary files.
        with self._state_lock:
            df.write.mode("append").parquet(self._state_path(name))

    def state(self, name: str) -> DataFrame:
        """All rows of a state table."""
        schema = STATE_SCHEMAS[name]
        if not path_exists(self.spark, self._state_path(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._state_path(name))

    def current(self, name: str) -> DataFrame:
        """The newest row per key of a state table."""
        keys, order = CURRENT_BY[name]
        w = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
        return (
            self.state(name).withColumn("_rn", F.row_number().over(w))
            .filter("_rn = 1").drop("_rn")
        )

    def state_row(self, name: str, **key):
        """The newest row of one key, or None."""
        if not path_exists(self.spark, self._state_path(name)):
            return None
        df = self.state(name)
        for column, value in key.items():
            df = df.filter(F.col(column) == value)
        _, order = CURRENT_BY[name]
        return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).first()

    # -- fact snapshots -------------------------------------------------------------------------

    def fact_state(self, target_table: str):
        return self.state_row("transform_watermark", target_table=target_table)

    def read_fact(self, spec: FactSpec, buckets=None, state=None, schema: T.StructType | None = None) -> DataFrame | None:
        """The committed snapshot of a fact, or only some of its buckets. None before the first.

        A version's folder holds the buckets it rewrote; of each bucket only the committed version is read.
        """
        state = state or self.fact_state(spec.target_table)
        if state is None:
            return None
        root = self.path(spec.target_table)
        wanted = range(len(state.bucket_versions)) if buckets is None else buckets
        versions = {state.bucket_versions[b] for b in wanted} - {None}
        if not versions:
            return None
        reader = self.spark.read.option("basePath", root)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField("v", _L), T.StructField("bucket", _I)]))
        df = reader.parquet(*[f"{root}/v={v}" for v in sorted(versions)])
        current = F.element_at(F.lit([v or 0 for v in state.bucket_versions]), F.col("bucket") + 1) == F.col("v")
        if buckets is not None:
            current = current & F.col("bucket").isin(sorted(buckets))
        return df.filter(current).drop("v", "bucket")

    def expire_versions(self, spec: FactSpec, keep: int = 2) -> list[str]:
        """Delete bucket folders that none of the newest ``keep`` commits names; returns them.

        Readers of an older commit lose their files, so keep as many as reads may lag behind.
        Versions above the newest commit belong to a running transform and stay.
        """
        states = (
            self.state("transform_watermark").filter(F.col("target_table") == spec.target_table)
            .orderBy(F.col("version").desc()).limit(keep).collect()
        )
        used = {(v, b) for s in states for b, v in enumerate(s.bucket_versions)}
        expired = []
        root = self.path(spec.target_table)
        for version in range(1, states[0].version + 1 if states else 1):
            folder, fs = path_of(self.spark, f"{root}/v={version}")
            if not fs.exists(folder):
                continue
            for entry in fs.listStatus(folder):
                name = entry.getPath().getName()
                if name.startswith("bucket=") and (version, int(name[7:])) not in used:
                    fs.delete(entry.getPath(), True)
                    expired.append(f"v={version}/{name}")
            staged, _ = path_of(self.spark, f"{root}_batch/v={version}")
            fs.delete(staged, True)
        return expired

    def write_fact(self, df: DataFrame, spec: FactSpec, version: int) -> None:
        """Write one version. An unfinished version of the same number is replaced."""
        (
            df.write.mode("overwrite").partitionBy("bucket")
            .parquet(f"{self.path(spec.target_table)}/v={version}")
        )


def path_of(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def bucket_of(key, n_buckets: int):
    """Same hash as Spark's own hash partitioning: repartition(n_buckets, key) puts every bucket
    into one task, and that task writes one file per bucket."""
    return F.pmod(F.hash(key), F.lit(n_buckets))


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
