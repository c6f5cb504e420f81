"""Shards of near equal bytes by a k-d tree over metadata, with built-in functions only.

A node of the tree is split along its widest dimension at a weighted median. The median of all nodes of a level is found
together: bytes are summed in bins of the sort key, the bin that holds the median is cut into finer bins, and so on.
Only the bins that hold a median, one per node, ever reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

#: Bits of the sort key: the place in the dimension, then a hash of the text, so that equal texts stand together.
PLACE_BITS, HASH_BITS = 24, 38
KEY_BITS = PLACE_BITS + HASH_BITS
BIN_BITS = 10
#: A bin with no more than this share of its node's bytes is not refined: the cut goes to its nearer edge.
TOLERANCE = 0.0005
#: A group of equal texts of no more than this share of a shard is never cut.
TOGETHER = 0.05
#: Rows numbered in one piece when slots are given out.
CHUNK_ROWS = 100_000


def kd_shards(docs: DataFrame, dimensions: dict[str, Column], leaves: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, shard (from 0), slot (gapless from 0 within the shard).

    Give the number of leaves, or `target_bytes`: then there are as many as hold about so many bytes each. Size is the
    UTF-8 bytes of the text (null: none) plus one. `dimensions` are numbers by name; null counts as the least value. Equal
    texts all take the least dimensions among them, so they stand together, and stay in one shard where they hold no more than
    `TOGETHER` of it; a heavier group that a cut meets is cut by a hash of the id. Rows that repeat are separate rows. An empty table gives no shards.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "kd-shards")
    names, text = list(dimensions), F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - HASH_BITS).alias("text_hash"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 64 - KEY_BITS).alias("id_hash"),
        *(F.coalesce(c.cast("double"), F.lit(float("-inf"))).alias(f"d{i}") for i, c in enumerate(dimensions.values())),
    )
    rows = scratch.table(rows)
    finite = [F.when(F.abs(f"d{i}") < float("inf"), F.col(f"d{i}")) for i in range(len(names))]
    whole = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *(f(x).alias(f"{k}{i}") for i, x in enumerate(finite) for k, f in (("lo", F.min), ("hi", F.max)))).first()
    if not whole.n:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    if names:
        text_key, d = ["text_crc32", "text_hash"], [f"d{i}" for i in range(len(names))]
        apart = rows.groupBy(*text_key).agg(F.min(F.struct(*d)).alias("least"), F.max(F.struct(*d)).alias("most"))
        apart = scratch.table(apart.filter("least <> most").select(*text_key, "least"))
        rows = rows.join(apart, text_key, "left").withColumns({c: F.coalesce(F.col("least")[c], F.col(c)) for c in d}).drop("least")
    for i in range(len(names)):
        lo, hi = whole[f"lo{i}"] or 0.0, whole[f"hi{i}"] or 0.0
        place = F.least(F.greatest((F.col(f"d{i}") - lo) / ((hi - lo) or 1.0), F.lit(0.0)), F.lit(1.0)) * ((1 << PLACE_BITS) - 1)
        rows = rows.withColumn(f"d{i}", F.floor(place).cast("long"))
    leaves = leaves or max(1, math.ceil(whole.bytes / target_bytes))
    rows = scratch.table(rows.withColumn("node", F.lit(0)))

    # a node is named by its first leaf; open nodes have more than one
    open_ = {0: leaves}
    while open_ := {n: k for n, k in open_.items() if k > 1}:
        rows = _split(spark, scratch, rows, open_, len(names), TOGETHER * whole.bytes / leaves)
        open_ = {m: j for n, k in open_.items() for m, j in ((n, k // 2), (n + k // 2, k - k // 2))}

    chunk = F.pmod(F.col("id_hash"), F.lit(1 + whole.n // CHUNK_ROWS))
    rows = rows.withColumn("chunk", chunk)
    before = Window.partitionBy("node").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("node", "chunk").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("node", "chunk").orderBy("id_hash", "doc_id", "text_hash")) - 1
    return rows.withColumn("within", within).join(sizes, ["node", "chunk"]).select(
        "doc_id", "size", "text_crc32", F.col("node").alias("shard"), (F.col("before") + F.col("within")).cast("long").alias("slot")
    )


def _split(spark, scratch: Scratch, rows: DataFrame, open_: dict[int, int], n_dims: int, light: float) -> DataFrame:
    """Splits the open nodes (node -> leaves below it): the right part's rows get the name of its first leaf. Groups of
    equal texts of at most `light` bytes stay whole."""

    def beside(state: list[tuple], schema: str) -> DataFrame:
        """Rows beside what is known of their node: one row per open node, so at most one per leaf."""
        return rows.join(F.broadcast(spark.createDataFrame(state, f"node int, {schema}")), "node")

    wide = rows.filter(F.col("node").isin(list(open_))) if len(open_) <= 64 else rows
    wide = wide.groupBy("node").agg(F.sum("size").alias("bytes"), *(F.max(f"d{i}") - F.min(f"d{i}") for i in range(n_dims))).collect()
    widest, bytes_, goal = {}, {}, {}
    for r in wide:
        if r.node in open_:
            widest[r.node] = max(range(n_dims), key=lambda i: (r[2 + i], -i)) if n_dims else 0
            bytes_[r.node], goal[r.node] = r.bytes, r.bytes * (open_[r.node] // 2) / open_[r.node]

    def key(dim: Column) -> Column:
        place = F.lit(0).cast("long")
        for i in range(n_dims):
            place = F.when(dim == i, F.col(f"d{i}")).otherwise(place)
        return F.shiftleft(place, HASH_BITS).bitwiseOR(F.col("text_hash"))

    # low: the first value of the bin that holds the goal; left: bytes below it; fixed: a single key, cut by the id's hash
    low, left, fixed = {n: 0 for n in goal}, {n: 0.0 for n in goal}, {}
    cut: dict[int, tuple[int, int]] = {}
    bits = {n: KEY_BITS for n in goal}
    while todo := [n for n in goal if n not in cut]:
        state = [(n, widest[n], low[n], bits[n] - min(BIN_BITS, bits[n]), bits[n], fixed.get(n), goal[n] - left[n]) for n in todo]
        at = beside(state, "dim int, low long, shift int, bits int, fixed long, goal double")
        value = F.when(F.col("fixed").isNull(), key(F.col("dim"))).when(key(F.col("dim")) == F.col("fixed"), F.col("id_hash"))
        at = at.withColumn("value", value - F.col("low")).filter("value >= 0 AND shiftright(value, bits) = 0")
        bins = at.groupBy("node", F.expr("shiftright(value, shift)").alias("bin"), "goal").agg(F.sum("size").alias("bytes"))
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("bin"))
        found = bins.withColumn("upto", upto).filter("upto >= goal AND upto - bytes < goal").collect()
        for r in found:
            n, before = r.node, r.upto - r.bytes
            shift = bits[n] - min(BIN_BITS, bits[n])
            first = low[n] + (r.bin << shift)
            if r.bytes <= TOLERANCE * bytes_[n] or (shift == 0 and (n in fixed or r.bytes <= light)):
                here = first if r.goal - before <= r.upto - r.goal else first + (1 << shift)
                cut[n] = (fixed[n], here) if n in fixed else (here, 0)
            elif shift == 0:
                fixed[n], low[n], bits[n], left[n] = first, 0, KEY_BITS, left[n] + before
            else:
                low[n], bits[n], left[n] = first, shift, left[n] + before
        for n in set(todo) - {r.node for r in found}:  # rounding left the goal behind the last bin
            cut[n] = (fixed[n], low[n] + (1 << bits[n])) if n in fixed else (low[n] + (1 << bits[n]), 0)
    state = [(n, widest[n], *cut[n], n + open_[n] // 2) for n in cut]
    known = F.broadcast(spark.createDataFrame(state, "node int, dim int, cut long, cut_id long, right int"))
    at = rows.join(known, "node", "left")
    own = key(F.col("dim"))
    right = (own > F.col("cut")) | ((own == F.col("cut")) & (F.col("id_hash") >= F.col("cut_id")))
    return scratch.table(at.withColumn("node", F.when(right, F.col("right")).otherwise(F.col("node"))).drop("dim", "cut", "cut_id", "right"))
