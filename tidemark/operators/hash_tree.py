"""Where two versions of a table differ: digests of its rows by key, and a tree of hashes of two levels over them.

A digest is one row per key: how many rows have it and an order-free hash of them. Keys are dealt to buckets; a leaf of
the tree is the hash of a bucket, a node that of ``FANOUT`` buckets. Two trees over the same number of buckets name the
buckets that differ, and only the digests of those have to be read to name the keys.

A NULL key is a key of its own. Rows that repeat count: one more of the same row is a change. Equal hashes of different
content are possible with a chance of about 2**-64 per row, key and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import row_hash
from tidemark.sources.scan import ident
from tidemark.spec import HISTORY_COLUMNS

FANOUT = 16
ROWS_PER_BUCKET = 1 << 17
MAX_BUCKETS = 4096


def tree_buckets(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """As many buckets as the rows fill, in whole nodes. Beyond ``MAX_BUCKETS`` buckets grow instead."""
    nodes = max(-(-n_rows // (rows_per_bucket * FANOUT)), 1)
    return min(nodes * FANOUT, MAX_BUCKETS)


def _fold(h: Column) -> list[Column]:
    return [F.bit_xor(h).alias("hash_xor"), F.sum(h.cast("decimal(28,0)")).alias("hash_sum")]


def key_digests(df: DataFrame, key: str, n_buckets: int) -> DataFrame:
    """row_key, n, hash_xor, hash_sum, bucket: one row per key, summed before the shuffle, so that a key with very many
    rows is one row per task. The warehouse's own columns are left out; the order of columns does not matter."""
    columns = sorted((c for c in df.columns if c not in HISTORY_COLUMNS), key=str.lower)
    rows = df.select(ident(key).cast("string").alias("row_key"), row_hash(*[ident(c) for c in columns]).alias("_h"))
    folded = rows.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"), *_fold(F.col("_h")))
    return folded.withColumn("bucket", F.pmod(F.xxhash64("row_key"), F.lit(n_buckets)).cast("int"))


def hash_tree(digests: DataFrame) -> DataFrame:
    """level, node, bucket, n, hash_xor, hash_sum. Leaves are level 1; nodes are level 0 and have no bucket."""
    h = row_hash("row_key", "n", "hash_xor", "hash_sum")
    node = F.floor(F.col("bucket") / FANOUT).cast("int").alias("node")
    leaves = digests.groupBy("bucket").agg(F.sum("n").alias("n"), *_fold(h)).select(
        F.lit(1).alias("level"), node, "bucket", "n", "hash_xor", "hash_sum"
    )
    leaf = row_hash("bucket", "n", "hash_xor", "hash_sum")
    nodes = leaves.groupBy("node").agg(F.sum("n").alias("n"), *_fold(leaf)).select(
        F.lit(0).alias("level"), "node", F.lit(None).cast("int").alias("bucket"), "n", "hash_xor", "hash_sum"
    )
    return nodes.unionByName(leaves)


def differing_buckets(before: DataFrame, after: DataFrame) -> list[int]:
    """The buckets whose leaves differ, looked for below differing nodes only; at most ``MAX_BUCKETS`` numbers."""

    def differing(level: int, column: str, below: list[int] | None = None) -> list[int]:
        sides = []
        for side, tree in enumerate((before, after)):
            part = tree.filter(F.col("level") == level)
            if below is not None:
                part = part.filter(F.col("node").isin(below))
            sides.append(part.select(column, F.struct("n", "hash_xor", "hash_sum").alias("h"), F.lit(side).alias("side")))
        h = [F.max(F.when(F.col("side") == side, F.col("h"))) for side in (0, 1)]
        both = sides[0].unionByName(sides[1]).groupBy(column).agg(h[0].eqNullSafe(h[1]).alias("same"))
        return sorted(r[0] for r in both.filter("NOT same").collect())

    nodes = differing(0, "node")
    return differing(1, "bucket", nodes) if nodes else []


def changed_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """row_key, change (added, removed or changed), n_before, n_after of each key whose digests differ."""
    sides = before.withColumn("_after", F.lit(False)).unionByName(after.withColumn("_after", F.lit(True)))
    # Numbers rather than structs: their maxima fit a hash aggregation.
    values = {
        f"{c}_{name}": F.max(F.when(F.col("_after") == is_after, F.col(c)))
        for name, is_after in (("before", False), ("after", True)) for c in ("n", "hash_xor", "hash_sum")
    }
    same = F.lit(True)
    for c in ("n", "hash_xor", "hash_sum"):
        same = same & F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after"))
    both = sides.groupBy("row_key").agg(*[v.alias(name) for name, v in values.items()]).filter(~same)
    change = F.when(F.col("n_before").isNull(), "added").when(F.col("n_after").isNull(), "removed").otherwise("changed")
    none = F.lit(0).cast("bigint")
    return both.select(
        "row_key", change.alias("change"), F.coalesce("n_before", none).alias("n_before"), F.coalesce("n_after", none).alias("n_after")
    )
