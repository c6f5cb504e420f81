"""Every operator on the benchmark tables, each beside the SQL that gives the same rows.

Inputs are whole tables, or frames Spark derives from whole tables, so work grows with the data.
"""

from tidemark.queries.registry import ORACLES, QUERIES
from tidemark.queries import (  # noqa: F401  (importing registers the queries)
    audit,
    facts,
    formats,
    loads,
    probe,
    profile,
    quality,
    scans,
    scope,
)

__all__ = ["ORACLES", "QUERIES"]
