"""The same table in several storage layouts, the same query over each.

Answers must agree between layouts; what differs is their cost.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.numeric import saving_pct
from tabkit.functions.text import human_bytes
from tabkit.operators.relational import inner_count, union_all
from tabkit.sources import readers, writers

BUCKETS = 8
LAYOUTS = ("csv", "parquet_plain", "parquet_snappy", "partitioned", "merged", "bucketed")


def write_all(
    df: DataFrame,
    base: str,
    key: str,
    category: str,
    names: Sequence[str] = LAYOUTS,
    buckets: int = BUCKETS,
) -> dict[str, DataFrame]:
    """Write ``df`` once per layout below ``base``; returns a reader for each."""
    return {name: _write(df, name, f"{base}/{name}", key, category, buckets) for name in names}


def _write(
    df: DataFrame, name: str, path: str, key: str, category: str, buckets: int
) -> DataFrame:
    spark = df.sparkSession
    if name == "csv":
        return readers.csv_typed(spark, writers.csv(df, path), df.schema)
    if name == "parquet_plain":
        return readers.parquet(spark, writers.parquet(df, path, codec="uncompressed"))
    if name == "parquet_snappy":
        return readers.parquet(spark, writers.parquet(df, path))
    if name == "partitioned":
        return readers.parquet(spark, writers.parquet(df, path, partition_by=[category]))
    if name == "merged":
        return split_and_merge(df, path, key)
    if name == "bucketed":
        table = "bucketed_" + path.rstrip("/").split("/")[-2].replace("-", "_")
        writers.bucketed_table(df, table, key, path, buckets)
        return readers.catalog_table(spark, table)
    raise ValueError(f"unknown layout {name}")


def split_and_merge(df: DataFrame, path: str, key: str, extra: str = "extra_col") -> DataFrame:
    """Two Parquet sets of differing schema, read back as one table.

    The sets are an explicit range of keys each (the middle of the key range
    divides them), not a ``limit``, whose rows depend on the layout.  Rows of
    the set without the extra column read it as NULL.
    """
    ends = df.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    middle = low + (high - low) // 2
    first = writers.parquet(df.filter(F.col(key) <= middle), f"{path}/a")
    rest = df.filter(F.col(key) > middle).withColumn(extra, F.lit(1))
    second = writers.parquet(rest, f"{path}/b")
    return readers.parquet(df.sparkSession, first, second, merge_schema=True)


def compare(
    tables: Mapping[str, DataFrame], query: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The query's rows over each layout, labelled by layout."""
    return union_all(
        [query(table).select(F.lit(name).alias("layout"), "*") for name, table in tables.items()]
    )


def timed(
    cases: Mapping[str, Callable[[], DataFrame]], repeats: int = 2
) -> list[tuple[str, float, float]]:
    """(name, cold seconds, best warm seconds) of each case run to completion.

    Each case runs ``repeats`` more times after its cold run, so no case pays
    for being first.
    """
    results = []
    for name, build in cases.items():
        seconds = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        results.append((name, seconds[0], min(seconds[1:] or seconds)))
    return results


def matrix(
    tables: Mapping[str, DataFrame], key: str, category: str, wanted: str, value: str
) -> dict[str, Callable[[], DataFrame]]:
    """The eight cases compared: one-row results in a column ``value`` each.

    A filtered sum over CSV, plain, compressed and partitioned Parquet; the
    same pushed down on few and on many different values; a count over a
    merged schema; and a join of the bucketed table with itself.
    """

    def total(name: str) -> Callable[[], DataFrame]:
        return lambda: tables[name].filter(F.col(category) == wanted).agg(F.sum(value).alias("value"))

    snappy, merged, bucketed = (tables[n] for n in ("parquet_snappy", "merged", "bucketed"))
    middle = snappy.agg((F.max(key) / 2).cast("long")).scalar()
    rows = F.count(F.lit(1)).cast("double").alias("value")
    return {
        "csv": total("csv"),
        "parquet_plain": total("parquet_plain"),
        "parquet_snappy": total("parquet_snappy"),
        "pushdown_few_values": total("parquet_snappy"),
        "pushdown_many_values": lambda: snappy.filter(F.col(key) == middle).agg(
            F.sum(value).alias("value")
        ),
        "partitioned": total("partitioned"),
        "merged": lambda: merged.agg(rows),
        "bucketed_join": lambda: inner_count(bucketed, bucketed, key).select(
            F.col("n_rows").cast("double").alias("value")
        ),
    }


def scans_of(df: DataFrame) -> list[dict[str, int]]:
    """What each file scan of a DataFrame that has been run has read: files, bytes, rows, partitions, columns.

    From the metrics of the executed plan, through the stages that adaptive execution made.
    """
    found: list[dict[str, int]] = []

    def look(node) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            look(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            look(node.plan())
        elif kind == "FileSourceScanExec":
            told = {}
            for name, metric in (("files", "numFiles"), ("bytes", "filesSize"), ("rows", "numOutputRows"), ("partitions", "numPartitions")):
                value = node.metrics().get(metric)
                told[name] = value.get().value() if value.isDefined() else 0
            found.append(told | {"columns": node.requiredSchema().length()})
        else:
            children = node.children()
            for i in range(children.size()):
                look(children.apply(i))

    look(df._jdf.queryExecution().executedPlan())
    return found


def reads(cases: Mapping[str, Callable[[], DataFrame]], spark: SparkSession) -> DataFrame:
    """layout, value, files_read, bytes_read, rows_read, columns_read of one-row queries (column ``value``), run to their end."""
    records = []
    for name, build in cases.items():
        df = build()
        value = df.collect()[0]["value"]
        scans = scans_of(df)
        told = [sum(s[c] for s in scans) for c in ("files", "bytes", "rows")]
        records.append((name, float(value), *told, max(s["columns"] for s in scans)))
    return readers.from_records(
        spark, records, "layout string, value double, files_read long, bytes_read long, rows_read long, columns_read int"
    )


def footprint(spark: SparkSession, paths: Mapping[str, str], base: str) -> DataFrame:
    """layout, n_files, n_bytes, size_text, pct_saved against ``base``.

    The file listing is a table like any other: sizes are summed by Spark.
    """
    parts = [
        readers.file_list(spark, path).agg(
            F.lit(name).alias("layout"),
            F.count(F.lit(1)).alias("n_files"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"),
        )
        for name, path in paths.items()
    ]
    return with_savings(union_all(parts), base)


def with_savings(sizes: DataFrame, base: str) -> DataFrame:
    """(layout, n_files, n_bytes) with the size as text and the share saved against ``base``."""
    base_bytes = sizes.filter(F.col("layout") == base).select("n_bytes").scalar()
    return sizes.withColumn("size_text", human_bytes(F.col("n_bytes"))).withColumn(
        "pct_saved", F.round(saving_pct(base_bytes, F.col("n_bytes")), 1)
    )
