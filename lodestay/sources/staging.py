"""Tables written once and read many times, in the shared folder the cluster names.

A staged table is plain parquet: later passes read only the columns they need, and a lost executor
costs a re-read instead of a re-run of the cleaning shuffles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the session's warehouse folder; every executor reaches both."""
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def _application_folder(spark: SparkSession):
    folder = f"{staging_root(spark)}/lodestay/{spark.sparkContext.applicationId}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return folder, where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path for a table of this application; its parent folder exists."""
    folder, where, file_system = _application_folder(spark)
    file_system.mkdirs(where)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Remove every table this application staged. Call it once no result that reads them is needed."""
    _, where, file_system = _application_folder(spark)
    file_system.delete(where, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet and return the table read back, with the same schema."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    # the plan of a write runs once, so its shuffle files can go as soon as the table is there
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
