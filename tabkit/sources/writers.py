"""Sinks: CSV, Parquet (codec, partitions), bucketed tables, models, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession


def csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> str:
    """CSV folder; ``partition_by`` writes several sets (splits) in one pass."""
    writer = df.write.mode(mode).option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path


def csv_single_file(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One CSV part with a header.  One task writes it: for reports only."""
    return csv(df.coalesce(1), path, header=True, mode=mode)


def parquet(
    df: DataFrame,
    path: str,
    codec: str = "snappy",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> str:
    """Parquet, optionally partitioned by low-cardinality columns.

    A partitioned write is rebalanced first: rows of one partition value meet
    in few tasks (few files), and adaptive execution splits a value that holds
    too many rows over several tasks, so a hot value is not one task's work.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def bucketed_table(
    df: DataFrame, name: str, key: str, path: str, buckets: int
) -> str:
    """External table bucketed and sorted by ``key``; replaces ``name``.

    The caller states the number of buckets: the table's size over half a gigabyte or so
    keeps a bucket within a task's memory, and tables to be joined need equal numbers.
    Rows are sent to their bucket before the write, so each bucket is one
    file instead of one file per task and bucket.  ``key`` should be close to
    unique: all rows of one key share a bucket.
    """
    drop_table(df.sparkSession, name)
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )
    return name


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def report(df: DataFrame, path: str, fmt: str = "json") -> str:
    """A small report (section, item, value) as one JSON or CSV part."""
    if fmt == "csv":
        return csv_single_file(df, path)
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def model_name(name: str) -> str:
    return name.replace(" ", "_")


# Ending of the folders that hold a model as Parquet tables.
TABLES = ".tables"


def model(fitted, folder: str, name: str) -> str:
    """Persist a fitted model under a file-safe name.

    A bare MLlib model is stored as a pipeline of one stage, so one loader reads all of
    them; a model that knows how to save itself as tables does so.
    """
    path = f"{folder}/{model_name(name)}"
    if not isinstance(fitted, MLWritable):
        return fitted.save(SparkSession.active(), path + TABLES)
    if not isinstance(fitted, PipelineModel):
        fitted = PipelineModel([fitted])
    fitted.write().overwrite().save(path)
    return path
