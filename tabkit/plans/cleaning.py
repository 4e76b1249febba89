"""Damage, diagnosis and cleaning of the orders table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions import text
from tabkit.operators import cleaning, corruption, quality
from tabkit.operators import relational as rel
from tabkit.plans.registry import query
from tabkit.session import materialize
from tabkit.sources.readers import table

KEY = ["o_orderkey"]
COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]

DIRTY_SQL = """
b AS (SELECT o_orderkey, o_custkey,
  CASE WHEN md5('p' || o_orderkey::VARCHAR) < '08' THEN NULL WHEN md5('n' || o_orderkey::VARCHAR) < '03'
    THEN 'nan'::DOUBLE ELSE o_totalprice END AS o_totalprice,
  CASE WHEN md5('g' || o_orderkey::VARCHAR) < '02' THEN '' WHEN md5('g' || o_orderkey::VARCHAR) < '035'
    THEN '   ' ELSE o_orderpriority END AS o_orderpriority,
  1 + (md5('d' || o_orderkey::VARCHAR) < '09')::INT + (md5('d' || o_orderkey::VARCHAR) < '01')::INT AS copies
  FROM orders),
dirty AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority
  FROM (SELECT *, unnest(range(copies)) AS k FROM b)),
unique_rows AS (SELECT DISTINCT * FROM dirty),
nulled AS (SELECT o_orderkey, o_custkey, CASE WHEN NOT isnan(o_totalprice) THEN o_totalprice END AS o_totalprice,
  CASE WHEN trim(o_orderpriority) <> '' THEN o_orderpriority END AS o_orderpriority FROM unique_rows),
moments AS (SELECT avg(o_totalprice) AS mean, median(o_totalprice) AS mid, skewness(o_totalprice) AS skew,
  count(*) FILTER (o_totalprice IS NULL) AS missing_price,
  count(*) FILTER (o_orderpriority IS NULL) AS missing_priority FROM nulled),
common AS (SELECT o_orderpriority AS common FROM nulled WHERE o_orderpriority IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
filled AS (SELECT o_orderkey, o_custkey,
  coalesce(o_totalprice, CASE WHEN abs(skew) > 0.5 THEN mid ELSE mean END) AS o_totalprice,
  array_to_string(list_transform(string_split(lower(trim(regexp_replace(
    coalesce(o_orderpriority, common), '\\s+', ' ', 'g'))), ' '), lambda w: upper(w[1]) || w[2:]), ' ')
    AS o_orderpriority FROM nulled, moments, common),
fences AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM filled),
flagged AS (SELECT filled.*, o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)
  AS o_totalprice_outlier FROM filled, fences)
"""

SPEC = cleaning.CleanSpec(exclude=("o_orderkey", "o_custkey"), outlier_columns=("o_totalprice",))


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(*COLUMNS)
    nulled = corruption.inject_nulls(orders, KEY, {"o_totalprice": ("p", "08")})
    without = corruption.inject_nan(nulled, KEY, {"o_totalprice": ("n", "03")})
    blanked = corruption.inject_blanks(without, KEY, "o_orderpriority", "g", ["02", "035"])
    return corruption.append_copies(blanked, KEY, "d", ["09", "01"])


@query(
    "dirty_dataset",
    f"""WITH {DIRTY_SQL} SELECT o_orderkey, o_custkey, CASE WHEN NOT isnan(o_totalprice) THEN o_totalprice END
  AS o_totalprice, coalesce(isnan(o_totalprice), false) AS price_is_nan, o_orderpriority FROM dirty""",
)
def dirty_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """The damaged rows; NaN is told by a column of its own, as engines print it differently."""
    dirty = dirty_orders(spark, folder)
    marked = dirty.withColumn("price_is_nan", F.coalesce(F.isnan("o_totalprice"), F.lit(False)))
    return quality.nan_to_null(marked, ["o_totalprice"])


@query(
    "dirty_exact_nulls",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('p' || o_orderkey::VARCHAR)) AS p,
  row_number() OVER (ORDER BY md5('c' || o_orderkey::VARCHAR)) AS c FROM orders)
SELECT count(*) FILTER (p <= 190) AS null_prices, sum(o_orderkey) FILTER (p <= 190)::BIGINT AS price_keys,
  count(*) FILTER (c <= 75) AS null_customers, sum(o_orderkey) FILTER (c <= 75)::BIGINT AS customer_keys FROM r""",
)
def dirty_exact_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """NULLs in an exact number of different rows of two columns."""
    damaged = corruption.inject_nulls_exact(
        table(spark, folder, "orders").select(*COLUMNS),
        KEY,
        {"o_totalprice": ("p", 190), "o_custkey": ("c", 75)},
    )
    no_price, no_customer = F.col("o_totalprice").isNull(), F.col("o_custkey").isNull()
    return damaged.agg(
        F.count_if(no_price).alias("null_prices"),
        F.sum(F.when(no_price, F.col("o_orderkey"))).alias("price_keys"),
        F.count_if(no_customer).alias("null_customers"),
        F.sum(F.when(no_customer, F.col("o_orderkey"))).alias("customer_keys"),
    )


@query(
    "dirty_exact_copies",
    """WITH p AS (SELECT *, row_number() OVER (ORDER BY md5('x' || o_orderkey::VARCHAR), o_orderkey) - 1 AS place,
  count(*) OVER () AS n FROM orders),
d AS (SELECT ('0x' || substr(md5('x#' || i::VARCHAR), 1, 12))::BIGINT % (SELECT count(*) FROM orders) AS place
  FROM (SELECT unnest(range(700)) AS i)),
a AS (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM p JOIN d USING (place)),
c AS (SELECT o_orderkey, count(*) AS copies FROM a GROUP BY 1)
SELECT copies, count(*) AS n_keys, sum(o_orderkey)::BIGINT AS key_sum FROM c GROUP BY copies""",
)
def dirty_exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Exactly 700 rows drawn with replacement and appended; keys by copies."""
    orders = table(spark, folder, "orders").select(*COLUMNS)
    repeated = corruption.append_copies_exact(orders, KEY, 700, "x")
    per_key = repeated.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy("copies").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "dirty_summary",
    f"""WITH {DIRTY_SQL}, t AS (SELECT count(*) AS n_rows,
  count(*) FILTER (o_totalprice IS NULL OR isnan(o_totalprice)) AS n_nulls, count(*) FILTER (trim(o_orderpriority) = '') AS n_blanks,
  count(*) FILTER (o_totalprice IS NULL OR isnan(o_totalprice) OR trim(o_orderpriority) = '') AS n_affected FROM dirty),
d AS (SELECT count(*) AS n_distinct FROM unique_rows)
SELECT n_rows, 4 AS n_columns, n_nulls, n_blanks, n_rows - n_distinct AS n_duplicates, n_affected,
  round(100.0::DOUBLE * (n_affected + n_rows - n_distinct) / n_rows, 2) AS pct_corrupt FROM t, d""",
)
def dirty_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.diagnosis(dirty_orders(spark, folder))


@query(
    "null_profile",
    f"""WITH {DIRTY_SQL}, t AS (SELECT count(*)::DOUBLE AS n FROM dirty), c AS (
  SELECT 'o_orderkey' AS column_name, 'numeric' AS kind, count(*) FILTER (o_orderkey IS NULL) AS n_nulls FROM dirty
  UNION ALL SELECT 'o_custkey', 'numeric', count(*) FILTER (o_custkey IS NULL) FROM dirty
  UNION ALL SELECT 'o_totalprice', 'numeric', count(*) FILTER (o_totalprice IS NULL OR isnan(o_totalprice)) FROM dirty
  UNION ALL SELECT 'o_orderpriority', 'text', count(*) FILTER (o_orderpriority IS NULL) FROM dirty)
SELECT column_name, kind, n_nulls, round(n_nulls / n * 100, 2) AS pct_nulls FROM c, t""",
)
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_profile(dirty_orders(spark, folder))


@query(
    "affected_rows",
    f"""WITH {DIRTY_SQL}
SELECT count(*) AS n_rows, count(*) FILTER (o_totalprice IS NULL OR isnan(o_totalprice)) AS n_null_rows,
  count(*) FILTER (trim(o_orderpriority) = '') AS n_blank_rows,
  count(*) FILTER (o_totalprice IS NULL OR isnan(o_totalprice) OR trim(o_orderpriority) = '') AS n_affected,
  round(100.0::DOUBLE * count(*) FILTER (o_totalprice IS NULL OR isnan(o_totalprice) OR trim(o_orderpriority) = '') / count(*), 2)
    AS pct_affected FROM dirty""",
)
def affected_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.affected_rows(dirty_orders(spark, folder))


@query(
    "duplicate_count",
    f"""WITH {DIRTY_SQL}, u AS (SELECT count(*) AS n_distinct FROM unique_rows)
SELECT count(*) AS n_rows, any_value(n_distinct) AS n_distinct, count(*) - any_value(n_distinct) AS n_duplicates
FROM dirty, u""",
)
def duplicate_count(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_count(dirty_orders(spark, folder))


@query(
    "dedupe_rows",
    f"""WITH {DIRTY_SQL}
SELECT o_orderpriority, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum FROM unique_rows GROUP BY 1""",
)
def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    unique = quality.drop_duplicates(dirty_orders(spark, folder))
    return unique.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "blank_to_null",
    f"""WITH {DIRTY_SQL}
SELECT 'o_orderpriority' AS column_name, count(*) FILTER (trim(o_orderpriority) = '') AS n_converted,
  count(*) FILTER (o_orderpriority IS NULL OR trim(o_orderpriority) = '') AS n_nulls_after FROM dirty""",
)
def blank_to_null(spark: SparkSession, folder: str) -> DataFrame:
    dirty = dirty_orders(spark, folder)
    return quality.one_pass(
        dirty,
        ["o_orderpriority"],
        {
            "n_converted": lambda c: F.count_if(text.is_blank(F.col(c))),
            "n_nulls_after": lambda c: F.count_if(text.blank_to_null(F.col(c)).isNull()),
        },
    )


@query(
    "impute_values",
    f"""WITH {DIRTY_SQL},
e AS (SELECT avg(value) AS mean, median(value) AS mid, skewness(value) AS skew,
  count(*) FILTER (value IS NULL) AS m_value, count(*) FILTER (event_type IS NULL) AS m_type FROM events),
t AS (SELECT event_type FROM events WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT 'orders' AS source, 'o_totalprice' AS column_name,
  CASE WHEN abs(skew) > 0.5 THEN 'median' ELSE 'mean' END AS strategy,
  round(CASE WHEN abs(skew) > 0.5 THEN mid ELSE mean END, 4) AS fill_number, NULL::VARCHAR AS fill_text,
  round(skew, 4) AS skew, missing_price AS n_missing FROM moments
UNION ALL SELECT 'orders', 'o_orderpriority', 'mode', NULL, common, NULL, missing_priority FROM moments, common
UNION ALL SELECT 'events', 'value', CASE WHEN abs(skew) > 0.5 THEN 'median' ELSE 'mean' END,
  round(CASE WHEN abs(skew) > 0.5 THEN mid ELSE mean END, 4), NULL, round(skew, 4), m_value FROM e
UNION ALL SELECT 'events', 'event_type', 'mode', NULL, event_type, NULL, m_type FROM e, t""",
)
def impute_values(spark: SparkSession, folder: str) -> DataFrame:
    """Fills of the de-duplicated dirty orders, and of events (skewed)."""
    unique = materialize(
        cleaning.blanks_to_null(quality.drop_duplicates(dirty_orders(spark, folder))), "unique"
    )
    orders = cleaning.fit_fills(unique, ["o_totalprice"], ["o_orderpriority"])
    events = table(spark, folder, "events")
    typical = cleaning.fit_fills(events, ["value"], ["event_type"], only_missing=False)
    return rel.union_all(
        [
            cleaning.fills_table(unique, orders).withColumn("source", F.lit("orders")),
            cleaning.fills_table(events, typical).withColumn("source", F.lit("events")),
        ]
    )


@query(
    "normalize_text",
    """SELECT normalized, count(*) AS n_rows FROM (
  SELECT array_to_string(list_transform(string_split(lower(trim(regexp_replace(
    '  ' || replace(o_orderpriority, ' ', '   ') || ' ', '\\s+', ' ', 'g'))), ' '),
    lambda w: upper(w[1]) || w[2:]), ' ') AS normalized FROM orders) GROUP BY normalized""",
)
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    """Stray spaces and letter case are evened out."""
    untidy = table(spark, folder, "orders").select(
        F.concat(
            F.lit("  "), F.replace("o_orderpriority", F.lit(" "), F.lit("   ")), F.lit(" ")
        ).alias("normalized")
    )
    tidy = cleaning.normalize_text(untidy, ["normalized"])
    return tidy.groupBy("normalized").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "iqr_outliers",
    """WITH v AS (SELECT 'value' AS column_name, value AS x FROM events
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem),
q AS (SELECT column_name, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, count(*) AS n FROM v GROUP BY 1)
SELECT column_name, round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3,
  round(any_value(q1 - 1.5 * (q3 - q1)), 6) AS low_fence, round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS high_fence,
  count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers,
  round(100.0::DOUBLE * count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) / count(*), 2)
    AS pct_outliers FROM v JOIN q USING (column_name) GROUP BY column_name""",
)
def iqr_outliers(spark: SparkSession, folder: str) -> DataFrame:
    found = rel.union_all(
        [
            quality.iqr_outliers(table(spark, folder, "events"), ["value"]),
            quality.iqr_outliers(table(spark, folder, "lineitem"), ["l_extendedprice"]),
        ]
    )
    # Cents interpolated by quarters and scaled by 1.5 end within five digits, so
    # six leave no tie that engines could round differently.
    return found.withColumns(
        {c: F.round(c, 6) for c in ("q1", "q3", "low_fence", "high_fence")}
    )


def _text_is_date(column: str) -> str:
    return (
        f"coalesce(avg((try_cast({column} AS TIMESTAMP) IS NOT NULL)::INT) "
        f"FILTER ({column} IS NOT NULL) >= 0.95, false)"
    )


@query(
    "date_columns",
    f"""WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders)
SELECT 'o_orderkey' AS column_name, false AS is_date
UNION ALL SELECT 'o_orderdate', true
UNION ALL SELECT 'o_orderstatus', {_text_is_date("o_orderstatus")} FROM o
UNION ALL SELECT 'o_orderpriority', {_text_is_date("o_orderpriority")} FROM o
UNION ALL SELECT 'date_text', {_text_is_date("date_text")} FROM o
UNION ALL SELECT 'event_id', false UNION ALL SELECT 'ts', true UNION ALL SELECT 'user_id', false
UNION ALL SELECT 'value', false
UNION ALL SELECT 'event_type', {_text_is_date("event_type")} FROM events
UNION ALL SELECT 'props', {_text_is_date("props")} FROM events""",
)
def date_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Date columns by type, and by content for text."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderdate",
        "o_orderstatus",
        "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
    )
    return rel.union_all(
        [quality.date_columns(orders), quality.date_columns(table(spark, folder, "events"))]
    )


@query(
    "clean_dataset",
    f"""WITH {DIRTY_SQL}
SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice, o_orderpriority, o_totalprice_outlier
FROM flagged""",
)
def clean_dataset(spark: SparkSession, folder: str) -> DataFrame:
    cleaned, _ = cleaning.clean(dirty_orders(spark, folder), SPEC)
    return cleaned.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query(
    "cleaning_report",
    f"""WITH {DIRTY_SQL},
n AS (SELECT (SELECT count(*) FROM dirty)::DOUBLE AS before, (SELECT count(*) FROM unique_rows)::DOUBLE AS after,
  (SELECT count(*) FROM unique_rows WHERE trim(o_orderpriority) = '')::DOUBLE AS blanks,
  (SELECT count(*) FROM flagged WHERE o_totalprice_outlier)::DOUBLE AS outliers,
  missing_price::DOUBLE AS mp, missing_priority::DOUBLE AS mo FROM moments)
SELECT 'size' AS section, 'rows_before' AS item, before AS value FROM n
UNION ALL SELECT 'size', 'rows_removed', before - after FROM n
UNION ALL SELECT 'size', 'rows_after', after FROM n
UNION ALL SELECT 'size', 'pct_kept', round(100.0::DOUBLE * after / before, 2) FROM n
UNION ALL SELECT 'blank_to_null', 'o_orderpriority', blanks FROM n
UNION ALL SELECT 'imputed', 'o_totalprice', mp FROM n WHERE mp > 0
UNION ALL SELECT 'imputed', 'o_orderpriority', mo FROM n WHERE mo > 0
UNION ALL SELECT 'imputed', 'total', mp + mo FROM n
UNION ALL SELECT 'outliers', 'o_totalprice', outliers FROM n
UNION ALL SELECT 'outliers', 'columns', (outliers > 0)::INT::DOUBLE FROM n
UNION ALL SELECT 'dates', 'o_orderpriority', 0.0::DOUBLE""",
)
def cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    _, report = cleaning.clean(dirty_orders(spark, folder), SPEC)
    return report
