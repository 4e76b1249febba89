"""Cost of building a plan against running it, and of a derived column."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.sources.readers import from_records


def jobs_of(spark: SparkSession, step: Callable[[], object]) -> tuple[object, int, int]:
    """What a step returns, and the numbers of jobs and of tasks that Spark started for it.

    The step's jobs carry a group of their own; what the caller had set comes back.
    """
    context = spark.sparkContext
    group, kept = f"phase-{uuid.uuid4().hex}", context.getLocalProperty("spark.jobGroup.id")
    context.setJobGroup(group, "one step", False)
    try:
        result = step()
    finally:
        context.setLocalProperty("spark.jobGroup.id", kept)
    # jobs are told by events that arrive a little later
    context._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = context.statusTracker()
    jobs = tracker.getJobIdsForGroup(group)
    stages = {s for j in jobs if (info := tracker.getJobInfo(j)) for s in info.stageIds}
    tasks = sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))
    return result, len(jobs), tasks


def time_phases(spark: SparkSession, df_source: Callable[[], DataFrame], steps: Mapping[str, Callable]) -> DataFrame:
    """phase, kind, n_rows, n_jobs, n_tasks, seconds.  A step takes the DataFrame so far.

    ``kind`` goes by evidence: a step for which Spark started a job is an action, one that
    only let the plan grow is a transformation.  A step that returns no DataFrame returns
    its number of rows.
    """
    df, records = None, []
    for name, step in {"read": lambda _: df_source(), **steps}.items():
        start = time.perf_counter()
        result, jobs, tasks = jobs_of(spark, lambda step=step, df=df: step(df))
        took = time.perf_counter() - start
        rows = None
        if isinstance(result, DataFrame):
            df = result
        else:
            rows = result
        records.append((name, "action" if jobs else "transformation", rows, jobs, tasks, took))
    return from_records(spark, records, "phase string, kind string, n_rows long, n_jobs int, n_tasks int, seconds double")


def column_cost(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """n_rows, seconds, microseconds_per_row of computing derived columns.

    The columns are folded into an aggregate: a bare ``count`` would let the
    optimizer drop them and time the row count instead.
    """
    used = [F.count(F.xxhash64(F.struct(c))).alias(name) for name, c in columns.items()]
    start = time.perf_counter()
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *used).first()
    took = time.perf_counter() - start
    n = row["_rows"]
    return from_records(
        df.sparkSession,
        [(n, took, took / n * 1e6 if n else None)],
        "n_rows long, seconds double, microseconds_per_row double",
    )
