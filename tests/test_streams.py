from __future__ import annotations

from pyspark.sql import functions as F

from tabkit import session
from tabkit.streaming import jobs

SCHEMA = "key string, n long, ts timestamp, kind string"


def feed(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return jobs.read_files(spark, path, spark.read.parquet(path).schema, files_per_batch=1)


def at(spark, text):
    import datetime

    return datetime.datetime.fromisoformat(text)


def rows_of(spark):
    t1, t2, t3 = (at(spark, f"2024-01-01T00:0{i}:00") for i in (1, 2, 3))
    first = [("a", 1, t1, "one"), ("a", 2, t2, "two"), ("b", 3, t1, "error")]
    later = [("a", 4, t1, "old"), ("b", 5, t3, "three"), ("c", 6, t3, "one")]
    return first, later


def test_latest_state_over_batches_and_restart(spark):
    """State survives a stop; a late older record does not replace a newer one."""
    base = session.work_path(spark, "latest_test")
    first, later = rows_of(spark)
    data, out = f"{base}/in", f"{base}/out"
    feed(spark, data, first)

    def run():
        jobs.latest_state(stream(spark, data), "key", ["ts", "n"], ["kind"], out).awaitTermination()
        return {r["key"]: r["kind"] for r in jobs.read_latest(spark, out, "key").collect()}

    assert run() == {"a": "two", "b": "error"}
    feed(spark, data, later)
    assert run() == {"a": "two", "b": "three", "c": "one"}
    batches = spark.read.parquet(f"{out}/data").groupBy("batch").count().count()
    assert batches == 2


def test_latest_state_with_expiry(spark):
    base = session.work_path(spark, "expire_test")
    first, later = rows_of(spark)
    feed(spark, f"{base}/in", first + later)
    jobs.latest_state(
        stream(spark, f"{base}/in"), "key", ["ts", "n"], ["kind"], f"{base}/out", expire=("ts", "1 hour")
    ).awaitTermination()
    got = {r["key"]: r["kind"] for r in jobs.read_latest(spark, f"{base}/out", "key").collect()}
    assert got == {"a": "two", "b": "three", "c": "one"}


def test_routes(spark):
    base = session.work_path(spark, "route_test")
    first, later = rows_of(spark)
    feed(spark, f"{base}/in", first)
    feed(spark, f"{base}/in", later + [("d", None, at(spark, "2024-01-01T00:09:00"), "one")])
    rules = [
        (F.col("kind") == "error", 415, "kind"),
        (F.col("n") > 5, 400, "too large"),
    ]
    jobs.route_rejects(stream(spark, f"{base}/in"), rules, f"{base}/out").awaitTermination()
    written = spark.read.option("basePath", f"{base}/out/data").parquet(f"{base}/out/data")
    got = {(r["key"], r["n"]): (r["status"], r["reason"], r["route"]) for r in written.collect()}
    assert got["b", 3] == (415, "kind", "rejected")
    assert got["c", 6] == (400, "too large", "rejected")
    # a rule that cannot be decided rejects
    assert got["d", None] == (400, "too large", "rejected")
    assert got["a", 1] == (200, None, "accepted") and len(got) == 7
    accepted = spark.read.parquet(f"{base}/out/data/batch=0/route=accepted")
    assert accepted.count() > 0


def test_score_emits_each_record_once(spark):
    base = session.work_path(spark, "score_test")
    first, later = rows_of(spark)
    feed(spark, f"{base}/in", first)
    feed(spark, f"{base}/in", later)

    def double(df):
        return df.select("n", F.to_json(F.struct((F.col("n") * 2).alias("twice"))).alias("payload"))

    for _ in range(2):  # the second run finds nothing new
        jobs.score(stream(spark, f"{base}/in"), double, f"{base}/out").awaitTermination()
    got = {r["n"]: r["payload"] for r in spark.read.parquet(f"{base}/out/data").collect()}
    assert got == {n: f'{{"twice":{2 * n}}}' for n in range(1, 7)}
    assert spark.read.parquet(f"{base}/out/data").count() == 6


def test_a_missing_feature_does_not_stop_the_stream(spark):
    base = session.work_path(spark, "missing_test")
    first, later = rows_of(spark)
    t1 = at(spark, "2024-01-01T00:01:00")
    for rows in (first, [("x", None, t1, "one"), ("y", 7, t1, None)], later):
        feed(spark, f"{base}/in", rows)
    jobs.score(
        stream(spark, f"{base}/in"), lambda df: df.selectExpr("key", "n * 2 AS twice"), f"{base}/out", required=["n", "kind"]
    ).awaitTermination()
    scored = spark.read.parquet(f"{base}/out/data")
    assert sorted(r["twice"] for r in scored.collect()) == [2, 4, 6, 8, 10, 12]
    rejects = {r["key"]: r["reason"] for r in spark.read.parquet(f"{base}/out/rejects").collect()}
    assert rejects == {"x": "missing: n", "y": "missing: kind"}


def test_compaction_keeps_the_state(spark):
    base = session.work_path(spark, "compact_test")
    first, later = rows_of(spark)
    data, out = f"{base}/in", f"{base}/out"

    def run(rows):
        feed(spark, data, rows)
        jobs.latest_state(stream(spark, data), "key", ["ts", "n"], ["kind"], out).awaitTermination()
        return {r["key"]: r["kind"] for r in jobs.read_latest(spark, out, "key").collect()}

    run(first)
    jobs.compact(spark, out, "key")
    assert run(later) == {"a": "two", "b": "three", "c": "one"}
    jobs.compact(spark, out, "key")
    assert run([("c", 9, at(spark, "2024-01-01T00:09:00"), "last")])["c"] == "last"
