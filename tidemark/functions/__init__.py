from tidemark.functions.casts import (
    clock_kind,
    clock_seconds,
    clock_text,
    parse_clock,
    set_flag,
    try_date,
    try_numeric,
    try_ts,
)
from tidemark.functions.text import clean_name, collapse_spaces, initcap, number_text, quote_name, row_hash

__all__ = [
    "clean_name", "clock_kind", "clock_seconds", "clock_text", "collapse_spaces", "initcap",
    "number_text", "parse_clock", "quote_name", "row_hash", "set_flag", "try_date", "try_numeric", "try_ts",
]
