"""Exact duplicates by deterministic block naming, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, delete_spaces, is_empty

#: Code points of a block. Most documents are one block; a text of a gigabyte needs 17 levels of pairs.
BLOCK_CHARS = 8192


def _blocks(norm: Column, block_chars: int) -> Column:
    """Whole blocks and a shorter last one; the empty text is one empty block."""
    cut = F.regexp_extract_all(norm, F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
    return F.when(F.char_length(norm) <= block_chars, F.array(norm)).otherwise(cut)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, hash_bits: int = 64
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Two texts are equal when they are identical without ASCII white space. The distinct blocks of all texts are sorted
    and numbered, then adjacent pairs of numbers are, level by level, until a document is one number: equal numbers at
    equal block counts are equal texts, with no hash to trust. Occurrences find a block's number by a 64-bit hash; where
    distinct blocks share a hash, they are found by their text instead. (`hash_bits` below 64 is for tests of that.)

    The whole text is shuffled once, and only after each task has folded its equal blocks to one. Of a group the row
    with the most code points stays, then the one with the smallest doc_id, then any one of rows that repeat both.
    Null text counts as empty; empty texts are equal to each other; a null doc_id sorts last. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    modulus = 1 << hash_bits

    def hashed(block: Column) -> Column:
        h = F.xxhash64(block)
        return h if hash_bits == 64 else F.pmod(h, F.lit(modulus))

    norm = docs.select(
        F.col(id_col).alias("id"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"),
        delete_spaces(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"),
    )
    blocks = norm.select(F.explode(_blocks(F.col("norm"), block_chars)).alias("block")).select(hashed(F.col("block")).alias("h"), "block")

    def numbered(distinct: DataFrame, *order: str) -> DataFrame:
        return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())

    names = scratch.table(numbered(blocks.groupBy("h", "block").agg(F.count("*").alias("n")), "h", "block").select("h", "name"))
    shared_hashes = [r[0] for r in names.groupBy("h").count().filter("count > 1").select("h").collect()]

    # h alone finds the number; a block whose hash is shared brings its text along
    shared = F.lit(False) if not shared_hashes else F.col("h").isin(shared_hashes)
    rows = scratch.table(
        norm.withColumn("blocks", _blocks(F.col("norm"), block_chars)).select(
            F.monotonically_increasing_id().alias("row"), "id", "n_chars", F.sha2("norm", 256).alias("sha"),
            F.size("blocks").alias("n_blocks"),
            F.transform("blocks", lambda b: F.struct(hashed(b).alias("h"), b.alias("block"))).alias("blocks")
            if shared_hashes else F.transform("blocks", lambda b: F.struct(hashed(b).alias("h"))).alias("blocks"),
        )
    )
    at = rows.select("row", F.col("n_blocks").cast("long").alias("len"), F.posexplode("blocks").alias("pos", "b")).select(
        "row", "len", F.col("pos").cast("long").alias("pos"), "b.*"
    )
    found = at.filter(~shared).select("row", "len", "pos", "h").join(names.filter(~shared), "h")
    level = found.select("row", "len", "pos", "name")
    if shared_hashes:
        by_text = scratch.table(numbered(blocks.filter(shared).distinct(), "h", "block").withColumn("name", -1 - F.col("name")))
        level = level.unionByName(at.filter(shared).join(by_text, ["h", "block"]).select("row", "len", "pos", "name"))
    level = scratch.table(level)

    done = level.filter("len = 1").select("row", "name")
    level = level.filter("len > 1")
    while not is_empty(level):
        pairs = level.groupBy("row", F.col("pos").bitwiseAND(F.lit(-2)).alias("pos"), "len").agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-(2**63))).alias("right"),
        )
        pairs = scratch.table(pairs.select("row", F.expr("pos div 2").alias("pos"), F.expr("(len + 1) div 2").alias("len"), "left", "right"))
        names = scratch.table(numbered(pairs.groupBy("left", "right").agg(F.count("*").alias("n")), "left", "right"))
        level = scratch.table(pairs.join(names, ["left", "right"]).select("row", "len", "pos", "name"))
        done = done.unionByName(level.filter("len = 1").select("row", "name"))
        level = level.filter("len > 1")

    known = scratch.table(rows.drop("blocks").join(done, "row"))
    best = F.min(F.struct((-F.col("n_chars")).alias("fewer"), F.col("id").isNull().alias("none"), "id", "row"))
    # as a table of its own, so that Spark may split a large group's rows in the join
    groups = scratch.table(known.groupBy("n_blocks", "name").agg(best.alias("best"), F.count("*").alias("group_size")))
    return known.join(groups, ["n_blocks", "name"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"),
    )
