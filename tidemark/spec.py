"""Declarations shared by the operators: what to load and what to build from it."""

from __future__ import annotations

from dataclasses import dataclass

LOADED_AT = "loaded_at"
LOAD_DATE = "load_date"
WATERMARK = "_wm"  # the table's watermark text as a timestamp, beside it in the history

# Columns the warehouse adds itself.
HISTORY_COLUMNS = {LOADED_AT, LOAD_DATE, WATERMARK}
FACT_COLUMNS = {LOADED_AT, "transformed_at", "v", "bucket", "action"}


def _check_names(names, reserved) -> None:
    """Refuse names that collide in lower case or with the warehouse's own columns."""
    folded = [n.lower() for n in names]
    bad = {n for n in folded if folded.count(n) > 1} | (set(folded) & reserved)
    if bad:
        raise ValueError(f"repeated or reserved column names: {', '.join(sorted(bad))}")


@dataclass(frozen=True)
class TableSpec:
    """One table to load: where it comes from, its key, its watermark and its pinned columns.

    A table without a ``watermark_column`` is a reference table: it is compared by row count, not
    read incrementally.
    """

    source_table: str
    target_table: str
    columns: tuple[str, ...]
    key_column: str | None = None
    watermark_column: str | None = None
    staging_table: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        object.__setattr__(self, "watermark_column", self.watermark_column or None)
        _check_names(self.columns, HISTORY_COLUMNS)
        if self.watermark_column and self.watermark_column.lower() not in {c.lower() for c in self.columns}:
            raise ValueError(f"{self.source_table}: the watermark {self.watermark_column!r} is not among its columns")
        if not self.staging_table:
            object.__setattr__(self, "staging_table", "lnd." + self.target_table.split(".")[-1])

    @property
    def is_reference(self) -> bool:
        return self.watermark_column is None


# How a fact column is derived from its text source column.
KINDS = ("text", "timestamp", "date", "clock", "numeric", "flag", "name")


@dataclass(frozen=True)
class Field:
    target: str
    source: str
    kind: str = "text"

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}, expected one of {KINDS}")


@dataclass(frozen=True)
class FactSpec:
    """A typed fact, one row per key, built from an append-only text history.

    ``fields`` is the whole projection, key first. ``key`` and ``modified`` name target columns.
    ``n_buckets`` is the number of key-hash buckets of the stored snapshot: an upsert rewrites only
    the buckets its batch touches. None takes it from the size of the first batch.
    """

    target_table: str
    source_table: str
    key: str
    modified: str
    fields: tuple[Field, ...]
    n_buckets: int | None = None

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))
        _check_names([f.target for f in self.fields], FACT_COLUMNS)
        for name in (self.key, self.modified):
            self.field_of(name)

    def field_of(self, target: str) -> Field:
        for f in self.fields:
            if f.target == target:
                return f
        raise ValueError(f"{self.target_table} has no column {target!r}")

    @property
    def source_key(self) -> str:
        return self.field_of(self.key).source

    @property
    def source_modified(self) -> str:
        return self.field_of(self.modified).source

    @property
    def source_columns(self) -> list[str]:
        return list(dict.fromkeys(f.source for f in self.fields))
