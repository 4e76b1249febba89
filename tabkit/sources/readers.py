"""Sources: typed and inferred CSV, Parquet, catalog tables, ranges, file lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Driver-side rows are for labels and reports, never for data.
MAX_DRIVER_ROWS = 10_000

CAST_FAILURES = "cast_failures"


class EmptySourceError(RuntimeError):
    """The source has no rows."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Shapes of number text.  Only text of the right shape is cast: a cast that
# fails costs many times one that works.
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
POINT_ZERO_TEXT = r"^\s*[+-]?\d+\.0*\s*$"
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_NUMBERS = ("NaN", "Infinity", "-Infinity", "Inf", "-Inf")


def _typed(cell: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return cell
    if isinstance(kind, T.IntegralType):
        # Integer columns that once held NaN are written as "120.0"; a plain
        # cast would silently null the whole column.
        wide = cell.try_cast("double")
        return (
            F.when(cell.rlike(INTEGER_TEXT), cell.try_cast(kind))
            .when(cell.rlike(POINT_ZERO_TEXT), F.substring_index(cell, ".", 1).try_cast(kind))
            .when(cell.rlike(NUMBER_TEXT), F.when(wide == F.floor(wide), wide.try_cast(kind)))
        )
    if isinstance(kind, T.NumericType):
        number = cell.rlike(NUMBER_TEXT) | cell.isin(*SPECIAL_NUMBERS)
        return F.when(number, cell.try_cast(kind))
    return cell.try_cast(kind)


def csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    count_failures: bool = False,
) -> DataFrame:
    """CSV under an explicit schema; a cell that does not fit becomes NULL.

    With ``count_failures`` each row also tells how many of its cells held
    text that did not fit, so a wrong schema is seen instead of being silent.
    """
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(raw_schema).option("header", header).csv(path)
    typed = {f.name: _typed(F.col(f.name), f.dataType) for f in schema.fields}
    columns = [typed[f.name].alias(f.name) for f in schema.fields]
    if count_failures:
        failed = F.lit(0)
        for f in schema.fields:
            bad = F.col(f.name).isNotNull() & typed[f.name].isNull()
            failed = failed + bad.cast("int")
        columns.append(failed.alias(CAST_FAILURES))
    return raw.select(*columns)


def csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with inferred types.  Inference reads the data once more."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .csv(path)
    )


def parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet files or partitioned folders.

    ``merge_schema`` reads every footer, so it is off unless the files are
    known to differ; a column absent from a file reads as NULL.
    """
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def id_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    return spark.range(0, n, 1, partitions)


def from_records(
    spark: SparkSession, records: Sequence, schema: T.StructType | str | list[str]
) -> DataFrame:
    if len(records) > MAX_DRIVER_ROWS:
        raise ValueError(f"{len(records)} driver rows; write a file and read it instead")
    return spark.createDataFrame(records, schema)


def file_list(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below ``path`` as rows (path, length); contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def with_path_label(
    df: DataFrame, path_column: str, pattern: str, label: str = "label"
) -> DataFrame:
    """Label taken from the first group of ``pattern``; other paths are dropped."""
    found = F.regexp_extract(path_column, pattern, 1)
    return df.withColumn(label, found).filter(F.col(label) != "")


def require_rows(df: DataFrame, what: str = "source") -> DataFrame:
    if df.isEmpty():
        raise EmptySourceError(f"{what} has no rows")
    return df
