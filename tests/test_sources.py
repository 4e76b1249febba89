from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_of
from tabkit import session
from tabkit.operators import layouts, phases
from tabkit.operators import relational as rel
from tabkit.plans.relational import parquet_scan_agg, point_lookup_sum
from tabkit.schemas import LABELLED_FILE
from tabkit.sources import readers, writers

MIXED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("g", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)


def write_text(spark, lines, name):
    path = session.work_path(spark, name)
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_typed_csv(spark):
    lines = [
        "id,n,x,g,label",
        "9007199254740993.0,120.0,1.5,,01",
        '2,120.5,abc,"   ",2',
        '3,99999999999,NaN,"",3',
        "4,1.2e2,-2e-3,a,4",
        "5",
    ]
    df = readers.csv_typed(spark, write_text(spark, lines, "typed"), MIXED, count_failures=True)
    rows = {r["id"]: r for r in df.collect()}
    first = rows[9007199254740993]  # beyond what a double can hold
    assert (first["n"], first["x"], first["g"], first["label"]) == (120, 1.5, None, "01")
    assert first["cast_failures"] == 0
    assert (rows[2]["n"], rows[2]["x"], rows[2]["g"]) == (None, None, "   ")
    assert rows[2]["cast_failures"] == 2
    assert rows[3]["n"] is None and rows[3]["x"] != rows[3]["x"] and rows[3]["g"] is None
    assert (rows[4]["n"], rows[4]["x"], rows[4]["cast_failures"]) == (120, -0.002, 0)
    assert (rows[5]["n"], rows[5]["cast_failures"]) == (None, 0)


def test_require_rows(spark):
    readers.require_rows(spark.range(1))
    with pytest.raises(readers.EmptySourceError):
        readers.require_rows(spark.range(0), "orders")
    with pytest.raises(ValueError):
        readers.from_records(spark, [(1,)] * (readers.MAX_DRIVER_ROWS + 1), ["a"])


def test_labels_from_files(spark):
    """Labels parsed from listed file names; other files are dropped."""
    base = session.work_path(spark, "files")
    names = ["0_1.0.png", "7_3.0.png", "x_3.0.png", "note.txt", "5_9.png"]
    for name in names:
        spark.range(1).selectExpr("cast(id as string)").coalesce(1).write.text(f"{base}/{name}")
    files = readers.file_list(spark, base, "part-*")
    parent = files.withColumn("path", F.regexp_replace("path", r"/part-[^/]*$", ""))
    got = readers.with_path_label(parent, "path", r"_(\d)\.0\.png$").collect()
    assert sorted(r["label"] for r in got) == ["1", "3", "3"]


def test_single_file_and_report(spark):
    base = session.work_path(spark, "single")
    df = spark.range(100).repartition(5)
    writers.csv_single_file(df, f"{base}/csv")
    writers.report(df.selectExpr("'s' as section", "id as value"), f"{base}/report")
    parts = readers.file_list(spark, base, "part-*").collect()
    assert len(parts) == 2
    assert readers.csv_inferred(spark, f"{base}/csv").count() == 100


def test_partition_nulls(spark):
    """NULL and "" of a partition column read back as NULL; blanks stay."""
    path = session.work_path(spark, "nulls")
    rows = [(1, "Female"), (2, None), (3, ""), (4, "   ")]
    writers.parquet(spark.createDataFrame(rows, "id int, g string"), path, partition_by=["g"])
    got = {r["id"]: r["g"] for r in readers.parquet(spark, path).collect()}
    assert got == {1: "Female", 2: None, 3: None, 4: "   "}


@pytest.fixture(scope="module")
def tables(spark, folder):
    orders = readers.table(spark, folder, "orders")
    base = session.work_path(spark, "layout_tests")
    return layouts.write_all(orders, base, "o_orderkey", "o_orderstatus"), base


def test_layouts_agree(tables):
    query = lambda df: df.filter("o_orderstatus = 'F'").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    rows = layouts.compare(tables[0], query).collect()
    assert len(rows) == 6 and len({(r["n"], r["total"]) for r in rows}) == 1


def test_footprint(spark, tables):
    names = ["csv", "parquet_plain", "parquet_snappy"]
    rows = {
        r["layout"]: r
        for r in layouts.footprint(spark, {n: f"{tables[1]}/{n}" for n in names}, "csv").collect()
    }
    assert rows["csv"]["pct_saved"] == 0.0
    assert 0 < rows["parquet_snappy"]["n_bytes"] <= rows["parquet_plain"]["n_bytes"]
    assert rows["parquet_plain"]["pct_saved"] > 0


def test_scans_tell_what_they_read(tables):
    cases = {
        n: (lambda n=n: tables[0][n].filter("o_orderstatus = 'F'").agg(F.sum("o_totalprice").alias("value"))) for n in ("parquet_plain", "partitioned")
    }
    told = {r["layout"]: r for r in layouts.reads(cases, tables[0]["partitioned"].sparkSession).collect()}
    needed = tables[0]["parquet_plain"].filter("o_orderstatus = 'F'").count()
    assert told["partitioned"]["rows_read"] == needed < told["parquet_plain"]["rows_read"] == 1500
    assert told["partitioned"]["columns_read"] == 1 and told["parquet_plain"]["columns_read"] == 2
    both = tables[0]["parquet_plain"].join(tables[0]["parquet_snappy"].hint("shuffle_hash"), "o_orderkey")
    both.collect()
    assert len(layouts.scans_of(both)) == 2  # also behind the stages of a join


def test_partition_filter_prunes(tables):
    plan = plan_of(tables[0]["partitioned"].filter("o_orderstatus = 'F'").agg(F.sum("o_totalprice")))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan
    assert "ReadSchema: struct<o_totalprice:double>" in plan


def test_filters_are_pushed_and_columns_pruned(spark, folder):
    plan = plan_of(parquet_scan_agg(spark, folder))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in plan
    plan = plan_of(point_lookup_sum(spark, folder))
    assert "EqualTo(o_orderkey,5000)" in plan


def test_bucketed_join_has_no_exchange_of_data(tables):
    bucketed = tables[0]["bucketed"]
    plan = plan_of(rel.inner_count(bucketed, bucketed.select("o_orderkey"), "o_orderkey"))
    assert "SortMergeJoin" in plan
    # the only exchange gathers the partial counts
    assert plan.count("Exchange\n") + plan.count("Exchange (") <= 2
    assert "hashpartitioning(o_orderkey" not in plan


def test_split_needs_no_shuffle_of_rows(spark, folder):
    from tabkit.operators.splits import stratified_split

    orders = readers.table(spark, folder, "orders")
    plan = plan_of(
        stratified_split(orders, "o_orderpriority", ["o_orderkey"], {"a": 0.7, "b": 0.3})
    )
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_schema_merge(tables):
    row = tables[0]["merged"].agg(F.count(F.lit(1)), F.count("extra_col"), F.min("extra_col")).first()
    assert row[0] == 1500 and row[1] == 750 and row[2] == 1


def test_bench_helpers(spark):
    (timing,) = layouts.timed({"range": lambda: spark.range(10)}, repeats=1)
    assert timing[0] == "range" and timing[2] > 0
    kinds = phases.time_phases(
        spark, lambda: spark.range(10), {"filter": lambda d: d.filter("id > 3"), "count": lambda d: d.count()}
    ).collect()
    assert [r["kind"] for r in kinds] == ["transformation", "transformation", "action"]
    assert [r["n_jobs"] > 0 for r in kinds] == [False, False, True] and kinds[2]["n_tasks"] > 0 and kinds[2]["n_rows"] == 6
    cost = phases.column_cost(spark.range(100), {"c": F.col("id") * 2}).first()
    assert cost["n_rows"] == 100 and cost["microseconds_per_row"] > 0


def test_small_side_is_broadcast_only_within_bound(spark):
    from tabkit.session import small_side

    keys = spark.range(50)
    data = spark.range(1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(data.join(small_side(keys, 50), "id"))
        assert "BroadcastHashJoin" not in plan_of(data.join(small_side(keys, 49), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get(session.SHARED_DIR_KEY, None)
    found = session.shared_dir(spark)
    assert found == named.rstrip("/") if named else found
    assert session.work_path(spark, "a") != session.work_path(spark, "a")
    assert session.work_path(spark, "a").startswith(found)


def test_split_sets_as_csv(spark, folder):
    """Train, validation and test sets leave in one pass and are read one by one."""
    from tabkit.operators.splits import stratified_split

    labelled = readers.table(spark, folder, "orders").selectExpr(
        "concat('/data/', o_orderkey, '.png') as path", "substr(o_orderpriority, 1, 1) as label"
    )
    weights = {"train": 0.7, "val": 0.15, "test": 0.15}
    split = stratified_split(labelled, "label", ["path"], weights)
    base = writers.csv(split, session.work_path(spark, "sets"), partition_by=["split"])
    sizes = {}
    for name in weights:
        part = readers.csv_typed(spark, f"{base}/split={name}", LABELLED_FILE)
        assert dict(part.dtypes) == {"path": "string", "label": "string"}
        sizes[name] = part.count()
    assert sum(sizes.values()) == 1500 and abs(sizes["train"] - 1050) <= 5
