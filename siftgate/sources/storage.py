"""Shared folders and sinks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's checkpoint directory, reachable by every executor.

    Where the session names none, a local folder is set for a local master; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="siftgate-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def write_run(df: DataFrame, path: str, run_id: str, table: str, fmt: str = "parquet") -> str:
    """Write one result table of a run under its own directory; a repeated run replaces itself."""
    target = f"{path.rstrip('/')}/{table}/run_id={run_id}"
    df.write.mode("overwrite").format(fmt).save(target)
    return target


def read_runs(spark: SparkSession, path: str, table: str, schema, fmt: str = "parquet") -> DataFrame:
    """All runs of a result table, with ``run_id`` from the directory name."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{path.rstrip('/')}/{table}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives executor loss.

    The shuffle files of the write are removed when it ends, since nothing but the written table is read again.
    """
    spark, target = df.sparkSession, shared_dir(df.sparkSession)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(target)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(target)
    out._folder = target
    return out


def release(*tables: DataFrame) -> None:
    """Remove tables from ``materialise`` that no later step reads, by Hadoop's file API on the shared folder."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
