"""Storage layouts: agreement, footprint, pruning, schema merge, bucketed join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.numeric import ratio
from tabkit.operators import layouts, phases
from tabkit.operators import relational as rel
from tabkit.plans.registry import query
from tabkit.plans.relational import SCORED_SQL, scored_lines
from tabkit.session import work_path
from tabkit.sources import readers, writers
from tabkit.sources.readers import table

KEY, CATEGORY = "o_orderkey", "o_orderstatus"


def _total(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col(CATEGORY) == "F").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "layout_agreement",
    """SELECT layout, n_rows, total FROM
  (SELECT unnest(['csv', 'parquet_plain', 'parquet_snappy', 'partitioned', 'merged', 'bucketed']) AS layout),
  (SELECT count(*) AS n_rows, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'F')""",
)
def layout_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """The same filtered sum over every layout."""
    base = work_path(spark, "layouts")
    tables = layouts.write_all(table(spark, folder, "orders"), base, KEY, CATEGORY)
    return layouts.compare(tables, _total)


@query(
    "layout_matrix",
    """WITH s AS (SELECT round(sum(o_totalprice), 2) AS v FROM orders WHERE o_orderstatus = 'F'),
m AS (SELECT sum(o_totalprice) AS v FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) // 2 FROM orders)),
j AS (SELECT count(*)::DOUBLE AS v FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey),
r AS (SELECT count(*)::DOUBLE AS v FROM orders)
SELECT layout, v AS value FROM
  (SELECT unnest(['csv', 'parquet_plain', 'parquet_snappy', 'pushdown_few_values', 'partitioned']) AS layout), s
UNION ALL SELECT 'pushdown_many_values', round(v, 2) FROM m
UNION ALL SELECT 'merged', v FROM r UNION ALL SELECT 'bucketed_join', v FROM j""",
)
def layout_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """layout, value of the eight cases; their times are the benchmark's matter."""
    base = work_path(spark, "layout_matrix")
    tables = layouts.write_all(table(spark, folder, "orders"), base, KEY, CATEGORY)
    cases = layouts.matrix(tables, KEY, CATEGORY, "F", "o_totalprice")
    return rel.union_all(
        [
            case().select(F.lit(name).alias("layout"), F.round("value", 2).alias("value"))
            for name, case in cases.items()
        ]
    )


UNIT_SQL = "CASE WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN printf('%.2f KB', b / 1024.0) ELSE printf('%.2f MB', b / 1048576.0) END"


@query(
    "storage_footprint",
    f"""WITH f AS (SELECT lang AS layout, count(*) AS n_files, sum(octet_length(encode(text)))::BIGINT AS b FROM documents
  WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang),
o AS (SELECT arg_min(b, layout) AS base FROM f)
SELECT layout, n_files, b AS n_bytes, {UNIT_SQL} AS size_text, CASE WHEN b < base THEN round((base - b) / base * 100, 1) ELSE 0.0 END::DOUBLE AS pct_saved FROM f, o""",
)
def storage_footprint(spark: SparkSession, folder: str) -> DataFrame:
    """Number, bytes, size as text and share saved: the report on layouts, over texts whose bytes SQL can count, too.

    A document stands for a file and its language for a layout; ``layout_reads`` has the files.
    """
    docs = table(spark, folder, "documents").filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = docs.groupBy(F.col("lang").alias("layout")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum(F.octet_length("text")).alias("n_bytes")
    )
    base = sizes.agg(F.min("layout")).first()[0]
    return layouts.with_savings(sizes, base)


@query(
    "layout_reads",
    """WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, count(DISTINCT o_orderstatus) AS p,
  round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS v FROM orders)
SELECT layout, v AS value, CASE layout WHEN 'partitioned' THEN f ELSE n END AS rows_read, f AS rows_needed,
  CASE layout WHEN 'partitioned' THEN 1 ELSE 2 END AS columns_read, layout = 'partitioned' AS pruned, layout <> 'parquet_plain' AS smaller
FROM n, (SELECT unnest(['parquet_plain', 'parquet_snappy', 'partitioned']) AS layout)""",
)
def layout_reads(spark: SparkSession, folder: str) -> DataFrame:
    """The same filtered sum over three layouts: rows and columns read against rows needed, by the scans' own figures.

    ``pruned``: fewer files than the table has; ``smaller``: fewer bytes than the plain one.
    """
    base = work_path(spark, "reads")
    names = ["parquet_plain", "parquet_snappy", "partitioned"]
    tables = layouts.write_all(table(spark, folder, "orders"), base, KEY, CATEGORY, names)
    total = F.round(F.sum("o_totalprice"), 2).alias("value")
    cases = {n: (lambda n=n: tables[n].filter(F.col(CATEGORY) == "F").agg(total)) for n in names}
    told = layouts.reads(cases, spark)
    files = layouts.footprint(spark, {n: f"{base}/{n}" for n in names}, base=names[0])
    needed = table(spark, folder, "orders").filter(F.col(CATEGORY) == "F").count()
    plain = told.filter(F.col("layout") == names[0]).select("bytes_read").scalar()
    return told.join(F.broadcast(files), "layout").select(  # a row a layout
        "layout", "value", "rows_read", F.lit(needed).cast("long").alias("rows_needed"), "columns_read",
        (F.col("files_read") < F.col("n_files")).alias("pruned"), (F.col("bytes_read") < plain).alias("smaller"),
    )


@query(
    "partition_pruned_sum",
    """SELECT o_orderstatus, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderstatus""",
)
def partition_pruned_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Sum over one partition of a partitioned, compressed copy."""
    path = writers.parquet(
        table(spark, folder, "orders"), work_path(spark, "partitioned"), partition_by=[CATEGORY]
    )
    kept = readers.parquet(spark, path).filter(F.col(CATEGORY) == "F")
    return kept.groupBy(CATEGORY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "schema_merge_scan",
    """WITH m AS (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 2 AS middle FROM orders)
SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey > middle) AS n_extra,
  round(sum(o_totalprice), 2) AS total FROM orders, m""",
)
def schema_merge_scan(spark: SparkSession, folder: str) -> DataFrame:
    merged = layouts.split_and_merge(
        table(spark, folder, "orders"), work_path(spark, "merged"), KEY
    )
    return merged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("extra_col").alias("n_extra"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@query(
    "bucketed_self_join",
    "SELECT count(*) AS n_rows FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey",
)
def bucketed_self_join(spark: SparkSession, folder: str) -> DataFrame:
    """Join of a bucketed, sorted table with itself: no exchange."""
    path = work_path(spark, "bucketed")
    name = path.split("/")[-1].replace("-", "_")
    writers.bucketed_table(table(spark, folder, "orders"), name, KEY, path, layouts.BUCKETS)
    joined = rel.inner_count(
        readers.catalog_table(spark, name), readers.catalog_table(spark, name), KEY
    )
    # the plan holds the files' place and buckets; only the name leaves the catalog
    writers.drop_table(spark, name)
    return joined


@query(
    "lazy_actions",
    """WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice > 250000) AS f FROM orders),
p AS (SELECT schema, phase, phase IN ('count', 'first_rows') OR (schema = 'inferred' AND phase = 'read') AS runs FROM
  (SELECT unnest(['explicit', 'inferred']) AS schema), (SELECT unnest(['read', 'filter', 'project', 'ratio', 'count', 'first_rows']) AS phase))
SELECT schema, phase, CASE WHEN runs THEN 'action' ELSE 'transformation' END AS kind, runs AS starts_jobs, CASE WHEN NOT runs THEN 0 END AS n_jobs_of_plan,
  CASE phase WHEN 'count' THEN f WHEN 'first_rows' THEN least(f, 5) END AS n_rows FROM n, p""",
)
def lazy_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Which steps only build the plan and which run it, by the jobs that Spark started for them.

    Reading with an inferred schema runs: the schema is found by reading the files.
    """
    told = phase_times(spark, folder)
    jobs = F.col("n_jobs")
    return told.select(
        "schema", "phase", "kind", (jobs > 0).alias("starts_jobs"), F.when(jobs == 0, jobs).alias("n_jobs_of_plan"), "n_rows"
    )


def phase_times(spark: SparkSession, folder: str) -> DataFrame:
    """Building the plan against running it, for inferred and explicit schemas."""
    orders = table(spark, folder, "orders")
    path = writers.csv(orders, work_path(spark, "timing"))
    steps = {
        "filter": lambda df: df.filter(F.col("o_totalprice") > 250000),
        "project": lambda df: df.select("o_orderkey", "o_custkey", "o_totalprice"),
        "ratio": lambda df: df.withColumn(
            "per_customer", ratio(F.col("o_totalprice"), F.col("o_custkey"))
        ),
        "count": lambda df: df.count(),
        "first_rows": lambda df: len(df.orderBy("o_orderkey").take(5)),
    }
    explicit = phases.time_phases(spark, lambda: readers.csv_typed(spark, path, orders.schema), steps)
    inferred = phases.time_phases(spark, lambda: readers.csv_inferred(spark, path), steps)
    return rel.union_all(
        [
            explicit.withColumn("schema", F.lit("explicit")),
            inferred.withColumn("schema", F.lit("inferred")),
        ]
    )


@query(
    "derived_column_cost",
    f"WITH {SCORED_SQL} SELECT count(*) AS n_rows, count(profile) AS n_classed, round(sum(score), 4) AS score_sum FROM scored",
)
def derived_column_cost(spark: SparkSession, folder: str) -> DataFrame:
    """What the derived columns come to over all rows; ``phases.column_cost`` times them."""
    scored = scored_lines(spark, folder)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("profile").alias("n_classed"),
        F.round(F.sum("score"), 4).alias("score_sum"),
    )
