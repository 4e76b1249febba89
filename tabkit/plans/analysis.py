"""Splits, feature ranking and encoding, scaling, bins, metrics, curves, arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions import arrays, bins
from tabkit.functions.hashing import key_hash
from tabkit.operators import closed_form, curves, features, landmarks, metrics, splits
from tabkit.operators.quantiles import exact_quantiles
from tabkit.plans.registry import query
from tabkit.session import work_path
from tabkit.sources import readers, writers
from tabkit.sources.readers import table

LINE_KEY = ["l_orderkey", "l_linenumber"]
RANKED = [
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
]
CHARGE_SQL = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
SPLIT = {"train": 0.7, "val": 0.15, "test": 0.15}


def charged_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Lines with ``charge``, the amount to be explained by the other columns."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, folder, "lineitem").select(*columns, charge.alias("charge"))


def _correlation_sql() -> str:
    parts = [
        f"SELECT '{c}' AS feature, corr({c}, {CHARGE_SQL}) AS r FROM lineitem" for c in RANKED
    ]
    return " UNION ALL ".join(parts)


@query(
    "correlation_rank",
    f"""SELECT feature, round(r, 6) AS r, (row_number() OVER (ORDER BY abs(r) DESC, feature))::INT AS place
FROM ({_correlation_sql()})""",
)
def correlation_rank(spark: SparkSession, folder: str) -> DataFrame:
    """All features by |r|; the order is taken over one row per feature."""
    lines = charged_lines(spark, folder, *RANKED)
    found = features.correlations(lines, RANKED, "charge")
    ordered = F.sort_array(
        F.collect_list(F.struct((-F.abs("r")).alias("key"), "feature", "r"))
    )
    return (
        found.agg(ordered.alias("ranked"))
        .select(F.posexplode("ranked").alias("i", "f"))
        .select("f.feature", F.round("f.r", 6).alias("r"), (F.col("i") + 1).alias("place"))
    )


@query(
    "topk_features",
    f"""SELECT feature, round(r, 6) AS r FROM ({_correlation_sql()})
ORDER BY abs(r) DESC, feature LIMIT 4""",
)
def topk_features(spark: SparkSession, folder: str) -> DataFrame:
    lines = charged_lines(spark, folder, *RANKED)
    return features.top_correlated(lines, RANKED, "charge", k=4).withColumn("r", F.round("r", 6))


@query(
    "hash_split",
    """SELECT CASE WHEN md5('split' || o_orderkey::VARCHAR) < 'cccccccd' THEN 'train' ELSE 'test' END AS split,
  count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1""",
)
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey")
    split = splits.random_split(orders, ["o_orderkey"], {"train": 0.8, "test": 0.2}, "split")
    return splits.split_sizes(split, ["split"], F.sum("o_orderkey").alias("key_sum"))


@query(
    "stratified_split",
    """WITH t AS (SELECT o_orderkey, o_orderpriority,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) rn,
  count(*) OVER (PARTITION BY o_orderpriority) n FROM orders)
SELECT o_orderpriority, CASE WHEN rn <= floor(n * 0.7) THEN 'train' WHEN rn <= floor(n * 0.85) THEN 'val'
  ELSE 'test' END AS split, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum FROM t GROUP BY ALL""",
)
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    split = splits.stratified_split(orders, "o_orderpriority", ["o_orderkey"], SPLIT)
    # the sets are stored, one CSV folder each, and counted as they were stored
    path = writers.csv(split, work_path(spark, "sets"), partition_by=["split"])
    stored = readers.csv_typed(spark, path, split.schema)
    return splits.split_sizes(
        stored, ["o_orderpriority", "split"], F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "kfold_assign",
    """SELECT ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 6))::INT % 5 AS fold, count(*) AS n_rows,
  sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1""",
)
def kfold_assign(spark: SparkSession, folder: str) -> DataFrame:
    folded = splits.with_fold(table(spark, folder, "orders"), ["o_orderkey"], 5)
    return splits.split_sizes(folded, ["fold"], F.sum("o_orderkey").alias("key_sum"))


@query(
    "class_distribution",
    """SELECT o_orderpriority, CASE WHEN md5('c' || o_orderkey::VARCHAR) < 'b3333333' THEN 'train'
  WHEN md5('c' || o_orderkey::VARCHAR) < 'd999999a' THEN 'val' ELSE 'test' END AS split,
  count(*) AS n_rows FROM orders GROUP BY ALL""",
)
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Class balance of a split whose rows are drawn one by one."""
    orders = table(spark, folder, "orders")
    split = splits.stratified_split(
        orders, "o_orderpriority", ["o_orderkey"], SPLIT, salt="c", exact=False
    )
    return splits.split_sizes(split, ["o_orderpriority", "split"])


@query(
    "string_index",
    """SELECT o_orderpriority, (row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1)::DOUBLE AS category_index, n AS n_rows
FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)""",
)
def string_index(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderpriority")
    _, indexed = features.index_categories(orders, "o_orderpriority", "category_index")
    return indexed.groupBy("o_orderpriority", "category_index").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "one_hot",
    """WITH i AS (SELECT o_orderpriority, row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1 AS idx, n,
  count(*) OVER () AS k FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1))
SELECT o_orderpriority, p::INT AS position, (CASE WHEN p = idx THEN n ELSE 0 END)::BIGINT AS n_hot
FROM (SELECT *, unnest(range(k - 1)) AS p FROM i)""",
)
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Hot positions per category; the rarest category is all zeros."""
    orders = table(spark, folder, "orders").select("o_orderpriority")
    _, indexed = features.index_categories(orders, "o_orderpriority", "category_index")
    hot = features.one_hot(indexed, "category_index", "hot")
    per_vector = hot.groupBy("o_orderpriority", "hot").agg(F.count(F.lit(1)).alias("n"))
    return per_vector.select(
        "o_orderpriority", "n", F.posexplode("hot").alias("position", "value")
    ).select(
        "o_orderpriority", "position", (F.col("value") * F.col("n")).cast("long").alias("n_hot")
    )


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


def _scale_sql(variant: str, shift: str, spread: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{variant}' AS variant, round(any_value(m), 6) AS mean_before,
  round(any_value(s0), 6) AS std_before, round(avg(({c} - {shift}) / {spread}), 6) + 0.0::DOUBLE AS mean_after,
  round(stddev_pop(({c} - {shift}) / {spread}), 6) AS std_after
FROM lineitem, (SELECT avg({c}) AS m, stddev_pop({c}) AS s0, stddev_samp({c}) AS s1 FROM lineitem)"""
        for c in SCALED
    )


@query(
    "standard_scale",
    f"""{_scale_sql("centred_population", "m", "s0")}
UNION ALL {_scale_sql("uncentred_sample", "0", "s1")}""",
)
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Moments before and after both scalings: one pass to fit, one to look."""
    lines = table(spark, folder, "lineitem").select(*SCALED)
    fitted = features.fit_moments(lines, SCALED)
    return features.before_and_after(
        lines,
        {
            "centred_population": features.scales_of(fitted, center=True, population=True),
            "uncentred_sample": features.scales_of(fitted, center=False, population=False),
        },
    )


TERCILES = ["low", "mid", "high"]


@query(
    "tercile_bins",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, [0, 1/3, 2/3, 1]) e FROM lineitem)
SELECT CASE WHEN l_extendedprice <= e[1] - 0.01 OR l_extendedprice > e[4] + 0.01 THEN NULL
  WHEN l_extendedprice <= e[2] THEN 'low' WHEN l_extendedprice <= e[3] THEN 'mid' ELSE 'high' END AS bin,
  count(*) AS n_rows FROM lineitem, q GROUP BY 1""",
)
def tercile_bins(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_extendedprice")
    binned = lines.select(
        bins.cut(F.col("l_extendedprice"), _terciles(lines, "l_extendedprice"), TERCILES).alias("bin")
    )
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n_rows"))


def _terciles(df: DataFrame, column: str) -> list[float]:
    return bins.widen(exact_quantiles(df, [column], [0.0, 1 / 3, 2 / 3, 1.0])[column])


BINNED_SQL = f"""
y AS (SELECT {CHARGE_SQL} AS charge, l_extendedprice AS x FROM lineitem),
line AS (SELECT regr_slope(charge, x) AS b, regr_intercept(charge, x) AS a FROM y),
q AS (SELECT quantile_cont(charge, [0, 1/3, 2/3, 1]) e FROM y),
p AS (SELECT charge AS v, a + b * x AS w, e FROM y, line, q),
binned AS (SELECT
  CASE WHEN v <= e[1] - 0.01 OR v > e[4] + 0.01 THEN NULL WHEN v <= e[2] THEN 'low' WHEN v <= e[3] THEN 'mid'
    ELSE 'high' END AS actual,
  CASE WHEN w <= e[1] - 0.01 OR w > e[4] + 0.01 THEN NULL WHEN w <= e[2] THEN 'low' WHEN w <= e[3] THEN 'mid'
    ELSE 'high' END AS predicted FROM p)
"""


def binned_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Charge and its one-feature prediction, both cut at the charge's terciles."""
    lines = charged_lines(spark, folder, "l_extendedprice")
    line = closed_form.fit_line(lines, "l_extendedprice", "charge")
    edges = _terciles(lines, "charge")
    predicted = closed_form.predict_line("l_extendedprice", line)
    return lines.select(
        bins.cut(F.col("charge"), edges, TERCILES).alias("actual"),
        bins.cut(predicted, edges, TERCILES).alias("predicted"),
    )


@query(
    "confusion_matrix",
    f"""WITH {BINNED_SQL}
SELECT actual, count(*) FILTER (predicted = 'low') AS pred_low, count(*) FILTER (predicted = 'mid') AS pred_mid,
  count(*) FILTER (predicted = 'high') AS pred_high FROM binned WHERE actual IS NOT NULL GROUP BY actual""",
)
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(
        binned_predictions(spark, folder), "actual", "predicted", TERCILES
    )


@query(
    "confusion_normalized",
    f"""WITH {BINNED_SQL}
SELECT actual, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY actual), 6) AS share
FROM binned WHERE actual IS NOT NULL AND predicted IS NOT NULL GROUP BY actual, predicted""",
)
def confusion_normalized(spark: SparkSession, folder: str) -> DataFrame:
    binned = binned_predictions(spark, folder).dropna()
    shares = metrics.confusion_shares(binned, "actual", "predicted")
    return shares.withColumn("share", F.round("share", 6))


@query(
    "classification_report",
    """WITH p AS (SELECT quality AS y, 1 - toxic AS p FROM labels),
c AS (SELECT DISTINCT unnest([y, p]) AS cls FROM p),
k AS (SELECT cls, sum((y = cls AND p = cls)::INT)::DOUBLE AS hits, sum((p = cls)::INT)::DOUBLE AS called,
  sum((y = cls)::INT)::BIGINT AS support FROM p, c GROUP BY 1),
m AS (SELECT cls, hits, support, coalesce(hits / nullif(called, 0), 0) AS pr, coalesce(hits / nullif(support, 0), 0) AS re,
  coalesce(2 * hits / nullif(called + support, 0), 0) AS f FROM k)
SELECT cls::VARCHAR AS label, round(pr, 6) AS precision, round(re, 6) AS recall, round(f, 6) AS f1, support FROM m
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
  round(sum(hits) / sum(support), 6), sum(support)::BIGINT FROM m
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f), 6), sum(support)::BIGINT FROM m
UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 6), round(sum(re * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM m""",
)
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    rated = table(spark, folder, "labels").select(
        F.col("quality").alias("actual"), (1 - F.col("toxic")).alias("predicted")
    )
    return metrics.classification_report(rated, "actual", "predicted")


@query(
    "class_weights",
    """SELECT label, count(*) AS n_rows, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM embeddings GROUP BY label""",
)
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    weights = metrics.class_weights(table(spark, folder, "embeddings"), "label")
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    "label_smoothing",
    """WITH k AS (SELECT max(label) + 1 AS k FROM embeddings)
SELECT vec_id, c::INT AS class_index, round((CASE WHEN c = label THEN 1 ELSE 0 END) * 0.9::DOUBLE + 0.1::DOUBLE / k, 6) AS mass
FROM (SELECT vec_id, label, k, unnest(range(k)) AS c FROM embeddings, k)""",
)
def label_smoothing(spark: SparkSession, folder: str) -> DataFrame:
    """Smoothed one-hot label of each vector, a row per class."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "label")
    last = vectors.agg(F.max("label")).first()[0]
    if last is None:  # no label, no class
        return vectors.limit(0).selectExpr("vec_id", "0 AS class_index", "0D AS mass")
    size = last + 1
    smooth = arrays.smooth_labels(arrays.one_hot(F.col("label"), size), size, 0.1)
    return vectors.select("vec_id", F.posexplode(smooth).alias("class_index", "mass")).withColumn(
        "mass", F.round("mass", 6)
    )


HISTORY_SQL = """
h AS (SELECT event_type AS run, row_number() OVER (PARTITION BY event_type ORDER BY ts::DATE) AS e,
  round(avg(value), 6) AS v FROM events GROUP BY event_type, ts::DATE)
"""


def daily_history(spark: SparkSession, folder: str) -> DataFrame:
    """(run, epoch, value): daily mean value per event type."""
    daily = (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("run"), F.to_date("ts").alias("day"))
        .agg(F.round(F.avg("value"), 6).alias("value"))
    )
    return curves.numbered(daily, "run", "day")


@query(
    "early_stop",
    f"""WITH RECURSIVE {HISTORY_SQL},
r AS (SELECT run, e, v AS best, e AS best_e, 0 AS wait FROM h WHERE e = 1
  UNION ALL SELECT h.run, h.e, CASE WHEN h.v > r.best + 1e-4 THEN h.v ELSE r.best END,
  CASE WHEN h.v > r.best + 1e-4 THEN h.e ELSE r.best_e END,
  CASE WHEN h.v > r.best + 1e-4 THEN 0 ELSE r.wait + 1 END FROM r JOIN h ON h.run = r.run AND h.e = r.e + 1 WHERE r.wait < 3)
SELECT run, max(e) AS stop_epoch, arg_max(best_e, e) AS best_epoch, arg_max(best, e) AS best_value FROM r GROUP BY run""",
)
def early_stop(spark: SparkSession, folder: str) -> DataFrame:
    return curves.early_stop(
        daily_history(spark, folder), "run", "epoch", "value", patience=3, min_delta=1e-4
    )


@query(
    "lr_plateau",
    f"""WITH RECURSIVE {HISTORY_SQL},
r AS (SELECT run, e, v AS best, 0 AS wait, 1e-4::DOUBLE AS used, 1e-4::DOUBLE AS next FROM h WHERE e = 1
  UNION ALL SELECT run, e, least(best, gain), CASE WHEN cut THEN 0 ELSE w END, next,
    CASE WHEN cut THEN greatest(next * 0.5, 1e-6) ELSE next END
  FROM (SELECT h.run, h.e, r.best, r.next, CASE WHEN h.v < r.best - 1e-4 THEN h.v ELSE r.best END AS gain,
      CASE WHEN h.v < r.best - 1e-4 THEN 0 ELSE r.wait + 1 END AS w,
      h.v >= r.best - 1e-4 AND r.wait + 1 >= 5 AND r.next > 1e-6 AS cut
    FROM r JOIN h ON h.run = r.run AND h.e = r.e + 1))
SELECT run, e AS epoch, round(used, 12) AS lr FROM r""",
)
def lr_plateau(spark: SparkSession, folder: str) -> DataFrame:
    rates = curves.lr_plateau(
        daily_history(spark, folder), "run", "epoch", "value", initial=1e-4
    )
    return rates.withColumn("lr", F.round("lr", 12))


@query(
    "best_epoch",
    """WITH d AS (SELECT event_type AS run, ts::DATE AS day,
  round(avg(value) FILTER (md5(event_id::VARCHAR) < 'cccccccd'), 6) AS train,
  round(avg(value) FILTER (md5(event_id::VARCHAR) >= 'cccccccd'), 6) AS valid FROM events GROUP BY ALL),
h AS (SELECT *, (row_number() OVER (PARTITION BY run ORDER BY day))::INT AS e FROM d)
SELECT run, count(*) AS n_epochs, arg_max(e, (valid, -e)) FILTER (valid IS NOT NULL) AS best_epoch,
  max(valid) AS best_value, round(arg_max(train - valid, e) FILTER (train - valid IS NOT NULL), 6) AS final_gap
FROM h GROUP BY run""",
)
def best_epoch(spark: SparkSession, folder: str) -> DataFrame:
    """Daily means of a training and a validation part, and their best day."""
    is_train = key_hash(["event_id"]) < "cccccccd"
    daily = (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("run"), F.to_date("ts").alias("day"))
        .agg(
            F.round(F.avg(F.when(is_train, F.col("value"))), 6).alias("train"),
            F.round(F.avg(F.when(~is_train, F.col("value"))), 6).alias("valid"),
        )
    )
    best = curves.best_epoch(
        curves.numbered(daily, "run", "day"), "run", "epoch", "train", "valid"
    )
    return best.withColumn("final_gap", F.round("final_gap", 6))


PAYLOAD_SQL = """
z AS (SELECT vec_id, embedding, list_max(embedding)::DOUBLE AS top FROM embeddings),
x AS (SELECT vec_id, list_transform(embedding, lambda v: exp(v::DOUBLE - top)) AS e FROM z),
s AS (SELECT vec_id, list_transform(e, lambda v: v / list_sum(e)) AS p FROM x),
b AS (SELECT vec_id, p, list_position(p, list_max(p)) AS best FROM s)
"""


@query(
    "predict_payload",
    f"""WITH {PAYLOAD_SQL}
SELECT vec_id, 'c' || best AS clase, best::INT AS dedos, round(p[best], 4) AS confianza,
  '{{"clase":"c' || best || '","dedos":' || best || ',"confianza":' || round(p[best], 4) || ',"probabilidades":{{' ||
  array_to_string(list_transform(p, lambda v, i: '"c' || i || '":' || round(v, 4)), ',') || '}}}}' AS payload FROM b""",
)
def predict_payload(spark: SparkSession, folder: str) -> DataFrame:
    """The answer per vector: class, count, confidence and the JSON document.

    The vector's values serve as the scores of as many classes.
    """
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0]
    classes = [f"c{i + 1}" for i in range(width)]
    scored = vectors.select("vec_id", arrays.softmax(F.col("embedding")).alias("probs"))
    answered = scored.select(
        "vec_id", arrays.prediction_payload(classes, F.col("probs")).alias("a")
    )
    return answered.select(
        "vec_id", "a.clase", "a.dedos", "a.confianza", F.to_json("a").alias("payload")
    )


@query(
    "landmark_normalize",
    """WITH pt AS (SELECT vec_id, i, embedding[2 * i + 1]::DOUBLE x, embedding[2 * i + 2]::DOUBLE y
  FROM (SELECT vec_id, embedding, unnest(range(len(embedding) // 2)) AS i FROM embeddings)),
o AS (SELECT p.vec_id, p.i, p.x - z.x AS x, p.y - z.y AS y FROM pt p JOIN pt z ON z.vec_id = p.vec_id AND z.i = 0),
b AS (SELECT vec_id, min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM o GROUP BY 1),
g AS (SELECT *, CASE WHEN greatest(x1 - x0, y1 - y0) = 0 THEN 1 ELSE 160 / greatest(x1 - x0, y1 - y0) END AS sc FROM b)
SELECT o.vec_id, o.i::INT AS point, trunc(x * sc + (112 - (x0 + x1) / 2 * sc))::INT AS px,
  trunc(y * sc + (112 - (y0 + y1) / 2 * sc))::INT AS py FROM o JOIN g USING (vec_id)""",
)
def landmark_normalize(spark: SparkSession, folder: str) -> DataFrame:
    """Each vector read as a list of points, moved and scaled onto the canvas."""
    frames = table(spark, folder, "embeddings").select(
        "vec_id", arrays.points_from_flat(F.col("embedding")).alias("points")
    )
    return landmarks.normalize(frames, "vec_id", "points")
