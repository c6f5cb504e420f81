from tidemark.sources.history import (
    append_history,
    land_overwrite,
    read_history,
    seed_history,
    staged_columns,
    watermark_range,
)
from tidemark.sources.scan import (
    normalise_columns,
    read_source,
    scan_all,
    scan_bounded,
    scan_columns,
    scan_sample,
    scan_text,
    source_count,
    stage_text,
    stamp_loaded_at,
    trim_temporal,
)
from tidemark.sources.store import Warehouse

__all__ = [
    "Warehouse", "append_history", "land_overwrite", "normalise_columns", "read_history",
    "read_source", "scan_all", "scan_bounded", "scan_columns", "scan_sample", "scan_text", "seed_history",
    "source_count", "stage_text", "staged_columns", "stamp_loaded_at", "trim_temporal", "watermark_range",
]
