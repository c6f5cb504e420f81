"""Which rows of a reference table changed: its history's digests are kept beside it, its source is read once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.hash_tree import ROWS_PER_BUCKET, changed_keys, differing_buckets, hash_tree, key_digests, tree_buckets
from tidemark.operators.windows import batch_ceiling
from tidemark.sources.history import read_history
from tidemark.sources.scan import ident, scan_columns, stage_text
from tidemark.sources.store import Warehouse, path_exists
from tidemark.spec import LOADED_AT, TableSpec


def _write_digests(wh: Warehouse, table: str, digests: DataFrame, n_buckets: int) -> DataFrame:
    """One folder per bucket, each written by one task, so that a bucket can be read alone."""
    digests.repartition(n_buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(wh.path(table))
    # Spark reads an empty table's folder without the columns; the given schema holds in both cases.
    return wh.spark.read.schema(digests.schema).parquet(wh.path(table))


def record_reference(wh: Warehouse, spec: TableSpec, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame | None:
    """Digest the history of a reference table; returns its hash tree, or None without a history.

    The tree tells the newest load it has seen. It is written after the digests and removed before they are replaced, so
    a tree that is there belongs to whole digests.
    """
    history = read_history(wh, spec.target_table)
    if history is None:
        return None
    n_rows, newest = history.agg(F.count(F.lit(1)), F.max(LOADED_AT)).first()
    tree_table, digest_table = _names(spec)
    if path_exists(wh.spark, wh.path(tree_table)):
        wh.clear(tree_table)
    n_buckets = tree_buckets(n_rows, rows_per_bucket)
    held = {c.lower() for c in history.columns}
    columns = [(ident(c) if c.lower() in held else F.lit(None).cast("string")).alias(c) for c in spec.columns]
    stored = _write_digests(wh, digest_table, key_digests(history.select(*columns), spec.key_column, n_buckets), n_buckets)
    # A row without a level says what the tree covers; it is there for an empty history too.
    nodes = hash_tree(stored)
    covers = wh.spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in nodes.schema.fields],
        F.lit(n_buckets).alias("n_buckets"), F.lit(newest).cast("timestamp_ntz").alias("loaded_at"),
    )
    nodes.unionByName(covers, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(wh.path(tree_table))
    return wh.read(tree_table)


def _names(spec: TableSpec) -> tuple[str, str]:
    name = spec.target_table.partition(".")[2]
    return f"dsc.{name}_tree", f"dsc.{name}_digests"


def reference_tree(wh: Warehouse, spec: TableSpec, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame | None:
    """The stored tree of a history, built anew when the history has a load that the tree has not seen."""
    tree, history = wh.read(_names(spec)[0]), read_history(wh, spec.target_table)
    if tree is not None and history is not None:
        seen = tree.filter("level IS NULL").first()
        if seen is not None and seen.loaded_at == batch_ceiling(history, None).first().batch_to:
            return tree
    return record_reference(wh, spec, rows_per_bucket)


def reference_changes(wh: Warehouse, source: DataFrame, spec: TableSpec, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """row_key, change, n_before, n_after: the keys that the source has added, removed or changed since the history.

    The source is read once, into digests in landing. Both trees are compared, and of both sides' digests only the
    buckets that differ are read; the history itself is read only when it has grown. Without a history every key is
    added.
    """
    tree = reference_tree(wh, spec, rows_per_bucket)
    text = stage_text(scan_columns(source, spec.columns))
    n_buckets = tree_buckets(0) if tree is None else tree.filter("level IS NULL").first().n_buckets
    landing = spec.staging_table
    landed = _write_digests(wh, f"{landing}_digests", key_digests(text, spec.key_column, n_buckets), n_buckets)
    if tree is None:
        return changed_keys(landed.limit(0), landed)
    stored = wh.spark.read.schema(landed.schema).parquet(wh.path(_names(spec)[1]))
    hash_tree(landed).coalesce(1).write.mode("overwrite").parquet(wh.path(f"{landing}_tree"))
    buckets = differing_buckets(tree, wh.read(f"{landing}_tree"))
    wanted = F.col("bucket").isin(buckets) if buckets else F.lit(False)
    return changed_keys(stored.filter(wanted), landed.filter(wanted))
