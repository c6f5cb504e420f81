"""Latest version per key, and the order-safe upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.text import row_hash
from tidemark.spec import LOADED_AT


def latest_version(df: DataFrame, key, modified: str | Column, loaded_at: str | Column = LOADED_AT,
                   tiebreak=(), order=()) -> DataFrame:
    """One row per key: newest modification, unknown modifications last, then newest load.

    The row_number = 1 form lets Spark keep only the best row of each key in every map task, so a
    key that holds a third of all rows reaches its reducer as one row per map task. ``tiebreak``
    names columns whose row hash decides between rows of the same key, modification and load;
    ``order`` holds what else decides before it.
    """
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    mod = F.col(modified) if isinstance(modified, str) else modified
    loaded = F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at
    order = [mod.desc_nulls_last(), loaded.desc_nulls_last(), *order]
    if tiebreak:
        order.append(row_hash(*tiebreak).desc())
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _action(old_mod: Column, new_mod: Column, old_loaded: Column | None, new_loaded: Column | None) -> Column:
    """update or stale for a key on both sides. NULL comparisons fall through to stale."""
    if old_loaded is None:
        takes = old_mod.isNull() | (new_mod >= old_mod)
    else:
        later = new_loaded >= old_loaded
        takes = (
            (old_mod.isNull() & (new_mod.isNotNull() | later))
            | (new_mod > old_mod)
            | ((new_mod == old_mod) & later)
        )
    return F.when(takes, "update").otherwise("stale")


def upsert_latest(existing: DataFrame | None, batch: DataFrame, key: str, modified: str,
                  loaded_at: str | None = None) -> DataFrame:
    """Merge a batch (one row per key) into a snapshot (one row per key), with the action taken.

    insert: new key. update: the snapshot's modification is unknown or not newer than the batch's.
    stale: the batch row is older, or unknown against known, and loses. keep: key not in the batch.
    Nothing is ever deleted. With ``loaded_at``, equal modifications are decided by load time, which
    makes the result independent of the order in which batches arrive.

    Both sides meet in one full outer join on the key.
    """
    columns = batch.columns
    if existing is None:
        return batch.withColumn("action", F.lit("insert"))
    o = existing.select(*[F.col(c).alias(f"_o_{c}") for c in columns])
    n = batch.select(*[F.col(c).alias(f"_n_{c}") for c in columns])
    old, new = (lambda c: F.col(f"_o_{c}")), (lambda c: F.col(f"_n_{c}"))
    both = _action(old(modified), new(modified),
                   old(loaded_at) if loaded_at else None, new(loaded_at) if loaded_at else None)
    action = F.when(old(key).isNull(), "insert").when(new(key).isNull(), "keep").otherwise(both)
    joined = o.join(n, old(key) == new(key), "full_outer").withColumn("action", action)
    taken = F.col("action").isin("insert", "update")
    return joined.select(
        *[F.when(taken, new(c)).otherwise(old(c)).alias(c) for c in columns], "action"
    )


def written_count(upserted: DataFrame) -> DataFrame:
    """Rows the upsert wrote: inserted and updated, without those refused as older."""
    return upserted.agg(
        F.count_if(F.col("action").isin("insert", "update")).alias("n_written"),
        F.count_if(F.col("action") == "insert").alias("n_inserted"),
        F.count_if(F.col("action") == "update").alias("n_updated"),
        F.count_if(F.col("action") == "stale").alias("n_stale"),
    )
