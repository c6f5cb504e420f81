"""tidemark: incremental reporting tables as Spark DataFrame jobs.

Sub-packages
------------
functions   column expressions: guarded casts, flags, text rendering
sources     scans, text staging, append-only history, committed snapshots
operators   DataFrame -> DataFrame operators: profile, latest version, upsert, quality, monitors
plans       compositions that read and write a warehouse: loads and fact transforms
streaming   the same transform as an available-now stream
queries     every operator on the benchmark tables, each beside its SQL equivalent
"""

from tidemark.spec import Field, FactSpec, TableSpec

__all__ = ["Field", "FactSpec", "TableSpec"]
