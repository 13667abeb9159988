"""Cutting a long plan by writing it to the shared folder the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: under ``spark.checkpoint.dir``, else under the warehouse.

    The rule is the same on every master. Both are folders all executors share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return configured.rstrip("/") + "/opsloom"


def new_path(spark: SparkSession, name: str) -> str:
    """A path for one table, deleted by its file system when the application ends."""
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once as Parquet and return a scan of the written table.

    The table survives lost executors, gives later stages column pruning and pushdown, and
    replaces the plan behind it.
    """
    path = new_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
