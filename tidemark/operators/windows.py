"""Watermarks and batch ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark.sources.history import loaded_range, typed_watermark
from tidemark.sources.scan import ident
from tidemark.spec import LOADED_AT


def high_watermark(history: DataFrame, watermark: str) -> DataFrame:
    """The newest watermark in the history; NULL when it is empty or nothing parses. A history that keeps its watermark
    typed answers from that column, without parsing a text."""
    return history.agg(F.max(typed_watermark(history, watermark)).alias("high_watermark"))


def batch_ceiling(history: DataFrame, floor: dt.datetime | None) -> DataFrame:
    """The newest loaded_at above the floor; NULL means nothing new."""
    return loaded_range(history, floor, None).agg(F.max(LOADED_AT).alias("batch_to"))


def batch_window(history: DataFrame, floor: dt.datetime | None, ceiling: dt.datetime | None) -> DataFrame:
    """History rows with floor < loaded_at <= ceiling; no lower bound without a floor."""
    return loaded_range(history, floor, ceiling)


def batch_counts(batch: DataFrame, key: str) -> DataFrame:
    """Rows of a batch, and those without a key."""
    return batch.agg(
        F.count(F.lit(1)).alias("n_batch"), F.count_if(ident(key).isNull()).alias("n_nokey")
    )


def not_null_key(df: DataFrame, key: str) -> DataFrame:
    """Rows without a key cannot be matched to anything and are left out."""
    return df.filter(ident(key).isNotNull())
