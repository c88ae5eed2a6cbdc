"""Session settings the plans are written for. All are runtime SQL settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # statistics decide joins and partition counts at run time; oversized partitions of a hot key are split
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # generated methods above 8000 bytes are never compiled to machine code; fall back to smaller ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # one loop over all columns of a wide row stays just below that limit and runs badly compiled; wide operators work by their own small projections
    "spark.sql.codegen.maxFields": "25",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
