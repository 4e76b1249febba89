"""Streams over the events table; each gives what the batch job would give."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.hashing import key_hash
from tabkit.operators import models
from tabkit.plans.registry import query
from tabkit.session import work_path
from tabkit.sources.readers import table
from tabkit.streaming import jobs

READ_SQL = "json_extract(props, '$.k')::DOUBLE"
# The feature, missing in a band of the events.
K_SQL = f"CASE WHEN md5('k' || event_id::VARCHAR) >= '05' THEN {READ_SQL} END"


def _k() -> Column:
    return F.when(
        key_hash(["event_id"], "k") >= "05", F.get_json_object("props", "$.k").try_cast("double")
    )


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return jobs.read_files(spark, f"{folder}/events.parquet", schema)


@query(
    "stream_score",
    f"""WITH m AS (SELECT regr_slope(value, {K_SQL}) AS b, regr_intercept(value, {K_SQL}) AS a FROM events)
SELECT event_id, CASE WHEN ({K_SQL}) IS NULL THEN 'missing: k' END AS reason,
  round(a + b * {K_SQL}, 4) AS prediction,
  '{{"event_id":' || event_id || ',"prediction":' || round(a + b * {K_SQL}, 4) || '}}' AS payload FROM events, m""",
)
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """A model fitted on the table scores it again as a stream; records without the feature are told."""
    events = table(spark, folder, "events")
    fitted = models.linear_fit(events.select("value", _k().alias("k")), ["k"], "value")
    stream = event_stream(spark, folder).withColumn("k", _k())

    def answer(df: DataFrame, model: PipelineModel = fitted) -> DataFrame:
        scored = model.transform(df)
        rounded = scored.select("event_id", F.round("prediction", 4).alias("prediction"))
        return rounded.withColumn("payload", F.to_json(F.struct("event_id", "prediction")))

    out = work_path(spark, "stream_score")
    jobs.score(stream, answer, out, required=["k"]).awaitTermination()
    scored = spark.read.parquet(f"{out}/data").drop("batch")
    rejects = spark.read.parquet(f"{out}/rejects").select("event_id", "reason")
    return scored.unionByName(rejects, allowMissingColumns=True)


@query(
    "stream_latest_state",
    """SELECT user_id, CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'none'
  ELSE arg_max(event_type, (ts, event_id)) END AS last_type, max(ts) AS last_ts FROM events GROUP BY user_id""",
)
def stream_latest_state(spark: SparkSession, folder: str) -> DataFrame:
    """Last type per user; an error resets it to "none"."""
    events = event_stream(spark, folder).select(
        "user_id",
        "event_id",
        "ts",
        F.when(F.col("event_type") == "error", "none")
        .otherwise(F.col("event_type"))
        .alias("last_type"),
        F.col("ts").alias("last_ts"),
    )
    out = work_path(spark, "stream_latest")
    jobs.latest_state(
        events, "user_id", ["ts", "event_id"], ["last_type", "last_ts"], out
    ).awaitTermination()
    return jobs.read_latest(spark, out, "user_id")


REJECTS = (
    ("event_type <> 'error'", 415, "kind of record not accepted"),
    ("get_json_object(props, '$.k') IS NOT NULL", 400, "properties cannot be read"),
    ("value <= 200", 400, "value out of range"),
)


@query(
    "reject_route",
    f"""SELECT event_id, CASE WHEN event_type = 'error' THEN 415 WHEN {READ_SQL} IS NULL OR value > 200 THEN 400
  ELSE 200 END AS status, CASE WHEN event_type = 'error' THEN 'kind of record not accepted'
  WHEN {READ_SQL} IS NULL THEN 'properties cannot be read' WHEN value > 200 THEN 'value out of range' END AS reason,
  CASE WHEN event_type = 'error' OR {READ_SQL} IS NULL OR value > 200 THEN 'rejected' ELSE 'accepted' END AS route
FROM events""",
)
def reject_route(spark: SparkSession, folder: str) -> DataFrame:
    """Bad records go to their own folder with a status and a reason."""
    rules = [(~F.expr(accepted), code, why) for accepted, code, why in REJECTS]
    out = work_path(spark, "stream_route")
    jobs.route_rejects(event_stream(spark, folder), rules, out).awaitTermination()
    return spark.read.option("basePath", f"{out}/data").parquet(f"{out}/data").select(
        "event_id", "status", "reason", "route"
    )
