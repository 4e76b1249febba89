"""Streams over a table that grows by files: score, latest state, routing.

State belongs in RocksDB (``STATE_STORE``) where it may outgrow a task's memory; with
``files_per_batch`` a backlog is taken in parts.
Every job keeps its checkpoint and output in the shared folder, runs with
``availableNow`` (all present input, then stop) unless another trigger is
given, and writes so that a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabkit.operators.quality import absent

ACCEPTED = 200
# Session setting (name, value) that keeps streaming state outside the heap.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


def read_files(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder (or one file) as they arrive.

    A plain path must be a folder to a stream; written as a pattern that
    matches only itself it may also be a single file.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def _start(writer, checkpoint: str, trigger: Mapping | None) -> StreamingQuery:
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    trigger: Mapping | None = None,
    required: Sequence[str] = (),
) -> StreamingQuery:
    """Every record through ``transform`` (a fitted model and its payload).

    Records that lack one of the ``required`` columns (NULL or NaN) go to ``out/rejects``
    with a ``reason`` instead; they never stop the stream or the others' scores.
    """
    if not required:
        writer = transform(stream).writeStream.format("parquet").outputMode("append")
        return _start(writer.option("path", f"{out}/data"), f"{out}/checkpoint", trigger)
    lacking = absent(stream)
    names = F.array_compact(F.array(*[F.when(lacking[c], F.lit(c)) for c in required]))

    def write(batch: DataFrame, batch_id: int) -> None:
        told = batch.withColumn("reason", F.concat(F.lit("missing: "), F.array_join(names, ", ")))
        good = told.filter(F.size(names) == 0).drop("reason")
        for rows, kind in ((transform(good), "data"), (told.filter(F.size(names) > 0), "rejects")):
            rows.write.mode("overwrite").parquet(f"{out}/{kind}/batch={batch_id}")

    return _start(stream.writeStream.foreachBatch(write), f"{out}/checkpoint", trigger)


def compact(spark: SparkSession, out: str, key: str) -> str:
    """Fold what the batches of ``latest_state`` wrote into one snapshot; returns its path.

    Later reads then take the snapshot and the batches written since.  The stream may go
    on meanwhile: only batches present at the start are folded.
    """
    written = spark.read.parquet(f"{out}/data")
    last = written.agg(F.max("batch")).first()[0]
    newest = written.filter(F.col("batch") <= last)
    previous = _snapshot(spark, out)
    if previous is not None:
        path, upto = previous
        newest = newest.filter(F.col("batch") > upto).drop("batch")
        newest = newest.unionByName(spark.read.parquet(path).select(*newest.columns))
    else:
        newest = newest.drop("batch")
    state = newest.groupBy(key).agg(
        F.max_by("last", "position").alias("last"), F.max("position").alias("position")
    )
    path = f"{out}/snapshots/upto={last}"
    state.write.mode("overwrite").parquet(path)
    return path


def _snapshot(spark: SparkSession, out: str) -> tuple[str, int] | None:
    """The newest finished snapshot and the last batch it holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/snapshots")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return None
    done = [
        (int(p.getPath().getName().split("=")[1]), p.getPath().toString())
        for p in system.listStatus(folder)
        if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p.getPath(), "_SUCCESS"))
    ]
    upto, path = max(done, default=(None, None))
    return None if path is None else (path, upto)


def latest_state(
    stream: DataFrame,
    key: str,
    order: Sequence[str],
    values: Sequence[str],
    out: str,
    trigger: Mapping | None = None,
    expire: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Last ``values`` per key by ``order``.

    State is one row per key; rows are combined per task before they meet, so
    a hot key moves little.  Each batch writes only the keys it changed.
    ``expire=(time column, delay)`` sets a watermark and keeps state per day
    of that column, so days behind the watermark leave the state; a key quiet
    since then starts anew, while the written rows still hold its last state.
    """
    groups = [key]
    if expire:
        time_column, delay = expire
        stream = stream.withWatermark(time_column, delay)
        groups.append(F.window(time_column, "1 day").alias("day"))
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("last")
    latest = stream.groupBy(*groups).agg(
        newest, F.max(F.struct(*order)).alias("position")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(key, "position", "last").write.mode("overwrite").parquet(
            f"{out}/data/batch={batch_id}"
        )

    return _start(
        latest.writeStream.outputMode("update").foreachBatch(write), f"{out}/checkpoint", trigger
    )


def read_latest(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The current state per key: the newest snapshot, if any, and the batches since."""
    written = spark.read.parquet(f"{out}/data")
    previous = _snapshot(spark, out)
    if previous is not None:
        path, upto = previous
        since = written.filter(F.col("batch") > upto).drop("batch")
        written = since.unionByName(spark.read.parquet(path).select(*since.columns))
    return (
        written.groupBy(key)
        .agg(F.max_by("last", "position").alias("last"))
        .select(key, "last.*")
    )


def status(rules: Sequence[tuple[Column, int, str]]) -> tuple[Column, Column]:
    """(status, reason) of a record: the first broken rule, else accepted."""
    code: Column = F.lit(ACCEPTED)
    reason: Column = F.lit(None).cast("string")
    for broken, number, why in reversed(rules):
        hit = F.coalesce(broken, F.lit(True))
        code = F.when(hit, F.lit(number)).otherwise(code)
        reason = F.when(hit, F.lit(why)).otherwise(reason)
    return code, reason


def with_status(df: DataFrame, rules: Sequence[tuple[Column, int, str]]) -> DataFrame:
    code, reason = status(rules)
    return df.withColumns({"status": code, "reason": reason}).withColumn(
        "route", F.when(F.col("status") == ACCEPTED, "accepted").otherwise("rejected")
    )


def route_rejects(
    stream: DataFrame,
    rules: Sequence[tuple[Column, int, str]],
    out: str,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Accepted and rejected records into separate folders in one pass.

    A bad record gets a status and a reason and never stops the stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("route").parquet(
            f"{out}/data/batch={batch_id}"
        )

    writer = with_status(stream, rules).writeStream.foreachBatch(write)
    return _start(writer, f"{out}/checkpoint", trigger)
