"""Report sinks."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame

from ..errors import RuleError
from .listings import file_system_of

FORMATS = ("parquet", "json", "orc")


def save_report(report: DataFrame, path: str, file_format: str = "parquet") -> str:
    """Write a report table, replacing an existing one, and return its full path. The parent folder must exist.

    The table is written beside the old one and takes its place by renames once it is complete: a write that fails leaves the old report as it
    was and nothing else. Only if the last rename fails is the old report put back.
    """
    if file_format not in FORMATS:
        raise RuleError(f"unknown report format {file_format}")
    spark = report.sparkSession
    file_system, where = file_system_of(spark, path)
    full = file_system.makeQualified(where)
    if not file_system.exists(full.getParent()):
        raise RuleError(f"folder {posixpath.dirname(path)} does not exist")
    mark = uuid.uuid4().hex
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    made, old = (path_of(full.getParent(), f"_{full.getName()}-{mark}-{kind}") for kind in ("new", "old"))
    try:
        report.write.format(file_format).save(made.toString())
    except Exception:
        file_system.delete(made, True)
        raise
    replaced = file_system.exists(full)
    if replaced and not file_system.rename(full, old):
        raise OSError(f"the old report at {full.toString()} cannot be moved")
    if not file_system.rename(made, full):
        if replaced:
            file_system.rename(old, full)
        raise OSError(f"the new report cannot be moved to {full.toString()}")
    if replaced:
        file_system.delete(old, True)
    return full.toString()
