"""Session settings and the shared working folder.

Operators never build a session: they take the caller's.  ``build_session`` is
for tests, the benchmark and scripts.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARED_DIR_KEY = "spark.checkpoint.dir"

# Largest number of rows, and bytes of them, that any operator may ask Spark to broadcast.
BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 8 << 20


def build_session(
    app: str,
    master: str | int | None = None,
    shuffle_partitions: int | None = None,
    log_level: str = "WARN",
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session on ``master``: a URL, a number of local cores, or SPARK_MASTER.

    The number of shuffle partitions is left to the cluster's settings unless given:
    adaptive execution merges partitions but never adds any.
    ``conf`` adds or overrides settings, such as executor memory and cores.
    """
    if isinstance(master, int):
        master = f"local[{master}]"
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Looking up the Python line of every column costs more than small queries.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(conf or {}),
    }
    if shuffle_partitions:
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = SparkSession.builder.appName(app).master(
        master or os.environ.get("SPARK_MASTER", "local[*]")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel(log_level)
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local path would lose the data with the executor that wrote it.
    """
    configured = spark.conf.get(SHARED_DIR_KEY, None)
    if configured:
        if not spark.sparkContext.master.startswith("local") and configured.startswith("file:"):
            # a mounted network folder looks the same, so this cannot be refused
            warnings.warn(f"{SHARED_DIR_KEY} is {configured}: every executor must share that folder")
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder all executors share")
    own = tempfile.mkdtemp(prefix="tabkit-")
    spark.conf.set(SHARED_DIR_KEY, own)
    return own


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; unique, so runs never collide."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tabkit/{app}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by writing ``df`` as Parquet in the shared folder.

    Columnar, unlike ``checkpoint()``, so each later pass reads only the
    columns it needs, and it survives the loss of any executor.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it proves to have at most ``max_rows`` rows of bounded size.

    The rows fetched for the check are the ones broadcast, so ``df`` (cut
    points, class weights, per-group results) is computed once.  A larger one
    comes back without a hint: Spark then plans a shuffle join and adaptive
    execution splits skewed keys.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows and sum(len(str(row)) for row in rows) <= BROADCAST_BYTES:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return df


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it is on a shared path but not installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def spread(df: DataFrame, keys: Sequence[str], parts: int | None) -> DataFrame:
    """Rows dealt into ``parts`` partitions by a hash of their key, if a number is given.

    For work that passes over the rows many times when the input has too few partitions
    for the cores.  Which rows share a partition depends on nothing but the number, so a
    fit that depends on the partitioning is the same on every machine.  With 0 the session's
    shuffle settings say how many, so that they grow with the rows.
    """
    if parts is None:
        return df
    return df.repartition(parts, *keys) if parts else df.repartition(*keys)
