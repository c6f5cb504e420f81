"""Session settings the operators are written for. All can also be set by the cluster."""

from __future__ import annotations


def recommended_conf() -> dict[str, str]:
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Wide projections of guarded casts: a method beyond this size is not compiled by the JVM,
        # so let Spark fall back to split, compiled functions instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    }
