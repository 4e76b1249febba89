"""Scans, filters, projections, rule scores, grouped and pivoted summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.numeric import is_multiple, ratio
from tabkit.functions.rules import ClassRule, Rule, ScoreSpec
from tabkit.operators import relational as rel
from tabkit.plans.registry import query
from tabkit.session import work_path
from tabkit.sources import readers, writers
from tabkit.sources.readers import table

# Points of our own for order lines.
LINE_TIERS = (("l_quantity <= 12", 4.0), ("l_quantity <= 30", 7.0))
LINE_TOP = 11.0
LINE_BONUSES = (
    ("l_extendedprice > 60000", 2.5),
    ("l_shipdate >= timestamp '1996-01-01'", 1.5),
    ("l_tax <= 0.03", 0.5),
    ("l_linenumber = 1", 1.0),
    ("l_linestatus = 'O'", 2.0),
)
LINE_STEPS = (("expert", 12.0), ("regular", 8.0))
LINE_SCORE = ScoreSpec(
    zero_when="l_discount = 0",
    tiers=tuple(Rule(when, points) for when, points in LINE_TIERS),
    otherwise=LINE_TOP,
    bonuses=tuple(Rule(when, points) for when, points in LINE_BONUSES),
)
LINE_CLASSES = (
    ClassRule("score = 0", "none"),
    *[ClassRule(f"score >= {least}", name) for name, least in LINE_STEPS],
)
PROFILES = ("none", "novice", "regular", "expert")

SCORED_SQL = f"""
s AS (SELECT *, CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE
    CASE {" ".join(f"WHEN {when} THEN {points}::DOUBLE" for when, points in LINE_TIERS)} ELSE {LINE_TOP}::DOUBLE END
    {" ".join(f"+ CASE WHEN {when} THEN {points}::DOUBLE ELSE 0.0::DOUBLE END" for when, points in LINE_BONUSES)}
    END AS score FROM lineitem),
scored AS (SELECT *, CASE WHEN score = 0 THEN 'none'
  {" ".join(f"WHEN score >= {least} THEN '{name}'" for name, least in LINE_STEPS)} ELSE 'novice' END AS profile FROM s)
"""


def scored_lines(spark: SparkSession, folder: str) -> DataFrame:
    return rel.with_score(table(spark, folder, "lineitem"), LINE_SCORE, LINE_CLASSES, "novice")


@query(
    "range_even_count",
    """SELECT (count(*) + 1) // 2 AS n_even_ids,
  count(*) FILTER (l_orderkey % 2 = 0) AS n_even_keys FROM lineitem""",
)
def range_even_count(spark: SparkSession, folder: str) -> DataFrame:
    """As many generated ids as the table has rows, and the stored keys; even ones."""
    lines = table(spark, folder, "lineitem")
    ids = readers.id_range(spark, lines.count(), spark.sparkContext.defaultParallelism)
    even_ids = ids.filter(is_multiple(F.col("id"), 2)).agg(F.count(F.lit(1)).alias("n_even_ids"))
    even_keys = lines.filter(is_multiple(F.col("l_orderkey"), 2)).agg(F.count(F.lit(1)))
    return even_ids.select("n_even_ids", even_keys.scalar().alias("n_even_keys"))


ORDERS_TEXT = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]
)


@query(
    "csv_typed_scan",
    """SELECT o_orderstatus, count(*) AS n_rows, sum(o_custkey)::BIGINT AS sum_custkey,
  round(sum(o_totalprice), 2) AS sum_price, count(DISTINCT o_orderpriority) AS n_priorities,
  max(o_orderdate) AS last_date, count(o_orderstatus) AS cast_failures
FROM orders GROUP BY o_orderstatus""",
)
def csv_typed_scan(spark: SparkSession, folder: str) -> DataFrame:
    """CSV round trip under a schema.

    Integers written as ``899.0`` are kept; letters read as integers are NULL
    and counted.  The small summary goes out as one CSV file with a header and
    is read back the same way.
    """
    base = work_path(spark, "csv_typed")
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("double").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_orderstatus").alias("status_code"),
        "o_totalprice",
        "o_orderpriority",
        "o_orderdate",
    )
    writers.csv(orders, f"{base}/data")
    typed = readers.csv_typed(spark, f"{base}/data", ORDERS_TEXT, count_failures=True)
    summary = typed.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("o_custkey").alias("sum_custkey"),
        F.round(F.sum("o_totalprice"), 2).alias("sum_price"),
        F.countDistinct("o_orderpriority").alias("n_priorities"),
        F.max("o_orderdate").alias("last_date"),
        F.sum("cast_failures").alias("cast_failures"),
    )
    writers.csv_single_file(summary, f"{base}/summary")
    return readers.csv_typed(spark, f"{base}/summary", summary.schema)


@query(
    "csv_inferred_scan",
    """SELECT 'o_orderkey' AS column_name,
  CASE WHEN max(o_orderkey) > 2147483647 THEN 'bigint' ELSE 'int' END AS inferred_type,
  count(o_orderkey) AS n_values FROM orders
UNION ALL SELECT 'o_custkey', CASE WHEN max(o_custkey) > 2147483647 THEN 'bigint' ELSE 'int' END,
  count(o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'timestamp', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""",
)
def csv_inferred_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Types inferred from a CSV copy, with the values found per column."""
    path = writers.csv(table(spark, folder, "orders"), work_path(spark, "csv_inferred"))
    inferred = readers.csv_inferred(spark, path)
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("inferred_type"),
                F.count(f.name).alias("n_values"),
            )
            for f in inferred.schema.fields
        ]
    )
    return inferred.agg(rows.alias("rows")).select(F.inline("rows"))


@query(
    "parquet_scan_agg",
    "SELECT round(sum(l_extendedprice), 2) AS total FROM lineitem WHERE l_returnflag = 'R'",
)
def parquet_scan_agg(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    return lines.agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query(
    "point_lookup_sum",
    "SELECT count(*) AS n_rows, sum(o_totalprice) AS total FROM orders WHERE o_orderkey = 5000",
)
def point_lookup_sum(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "orders").filter(F.col("o_orderkey") == 5000)
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("total"))


@query(
    "metric_records",
    """SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open'
  WHEN 'P' THEN 'partial' END AS meaning, count(*) AS n_rows, round(avg(o_totalprice), 4) AS mean_price
FROM orders GROUP BY o_orderstatus""",
)
def metric_records(spark: SparkSession, folder: str) -> DataFrame:
    """Labels held by the driver, joined to measures of the table."""
    labels = readers.from_records(
        spark,
        [("F", "finished"), ("O", "open"), ("P", "partial")],
        ["o_orderstatus", "meaning"],
    )
    measures = (
        table(spark, folder, "orders")
        .groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")
        )
    )
    # Three labels, written above: safe to broadcast.
    return measures.join(F.broadcast(labels), "o_orderstatus", "left").select(
        "o_orderstatus", "meaning", "n_rows", "mean_price"
    )


@query(
    "guarded_sources",
    """SELECT s AS source, count(o_orderkey) AS n_rows, count(o_orderkey) > 0 AS accepted
FROM (SELECT unnest(['F', 'O', 'P', 'X']) AS s) LEFT JOIN orders ON o_orderstatus = s GROUP BY s""",
)
def guarded_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Sources by status, the empty one refused before any work is done on it."""
    told = []
    for status in ("F", "O", "P", "X"):
        source = table(spark, folder, "orders").filter(F.col("o_orderstatus") == status)
        try:
            told.append((status, readers.require_rows(source, status).count(), True))
        except readers.EmptySourceError:
            told.append((status, 0, False))
    return readers.from_records(spark, told, "source string, n_rows long, accepted boolean")


PAGE_LABEL = r"/([a-z]{2})/\d+"


@query(
    "filename_label",
    r"""SELECT label, count(*) AS n_pages FROM
  (SELECT regexp_extract(url, '/([a-z]{2})/\d+', 1) AS label FROM pages)
WHERE label <> '' GROUP BY label ORDER BY label""",
)
def filename_label(spark: SparkSession, folder: str) -> DataFrame:
    """Label parsed out of a path; paths without one are dropped."""
    pages = readers.with_path_label(
        table(spark, folder, "pages").select("url"), "url", PAGE_LABEL
    )
    return pages.groupBy("label").agg(F.count(F.lit(1)).alias("n_pages")).orderBy("label")


@query(
    "filter_flag_project",
    """SELECT o_orderkey, o_custkey, o_totalprice > 400000 AS is_large FROM orders
WHERE o_totalprice > 250000""",
)
def filter_flag_project(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").filter(F.col("o_totalprice") > 250000)
    flagged = rel.with_flag(orders, "is_large", F.col("o_totalprice") > 400000)
    return flagged.select("o_orderkey", "o_custkey", "is_large")


@query(
    "ratio_column",
    """SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (l_discount = 0) AS n_undefined,
  round(avg(l_extendedprice / nullif(l_discount, 0)), 2) AS mean_ratio
FROM lineitem GROUP BY l_returnflag""",
)
def ratio_column(spark: SparkSession, folder: str) -> DataFrame:
    """A ratio whose divisor may be zero."""
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("r")
    )
    return lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("r").isNull()).alias("n_undefined"),
        F.round(F.avg("r"), 2).alias("mean_ratio"),
    )


@query(
    "rule_score",
    f"""WITH {SCORED_SQL}
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, score, profile FROM scored""",
)
def rule_score(spark: SparkSession, folder: str) -> DataFrame:
    return scored_lines(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "score", "profile"
    )


@query(
    "profile_summary",
    f"""WITH {SCORED_SQL}
SELECT profile, count(*) AS total, round(avg(score), 3) AS mean_score,
  round(avg(l_quantity), 2) AS mean_quantity, round(avg(l_extendedprice), 1) AS mean_price
FROM scored GROUP BY profile ORDER BY mean_score DESC""",
)
def profile_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rel.grouped_means(
        scored_lines(spark, folder),
        ["profile"],
        {
            "mean_score": ("score", 3),
            "mean_quantity": ("l_quantity", 2),
            "mean_price": ("l_extendedprice", 1),
        },
        count="total",
    ).orderBy(F.col("mean_score").desc())


@query(
    "profile_feature_means",
    f"""WITH {SCORED_SQL}
SELECT profile, round(avg(l_extendedprice), 2) AS price_mean, round(avg(l_discount), 2) AS discount_mean,
  round(avg(l_tax), 2) AS tax_mean, round(avg(l_linenumber), 2) AS line_mean,
  round(avg(l_quantity), 2) AS quantity_mean FROM scored GROUP BY profile ORDER BY profile""",
)
def profile_feature_means(spark: SparkSession, folder: str) -> DataFrame:
    return rel.grouped_means(
        scored_lines(spark, folder),
        ["profile"],
        {
            "price_mean": ("l_extendedprice", 2),
            "discount_mean": ("l_discount", 2),
            "tax_mean": ("l_tax", 2),
            "line_mean": ("l_linenumber", 2),
            "quantity_mean": ("l_quantity", 2),
        },
        count=None,
    ).orderBy("profile")


@query(
    "profile_crosstab",
    f"""WITH {SCORED_SQL}
SELECT l_returnflag, nullif(count(*) FILTER (profile = 'none'), 0) AS none,
  nullif(count(*) FILTER (profile = 'novice'), 0) AS novice,
  nullif(count(*) FILTER (profile = 'regular'), 0) AS regular,
  nullif(count(*) FILTER (profile = 'expert'), 0) AS expert
FROM scored GROUP BY l_returnflag ORDER BY l_returnflag""",
)
def profile_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return rel.crosstab(
        scored_lines(spark, folder), "l_returnflag", "profile", PROFILES
    ).orderBy("l_returnflag")
