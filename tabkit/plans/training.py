"""Classifiers on vectors: weighted softmax by Newton steps, a network with its own training loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions import arrays
from tabkit.operators import curves, metrics, softmax, splits, training
from tabkit.operators import relational as rel
from tabkit.plans.registry import query
from tabkit.session import materialize
from tabkit.sources.readers import from_records, table

# Partitions of the rows that the passes go over again and again.
PARTS = 8
SHARES = {"train": 0.7, "held_out": 0.1, "test": 0.2}


def labelled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return splits.stratified_split(vectors, "label", ["vec_id"], SHARES).select("vec_id", "label", "embedding", "split")


def fitted_softmax(data: DataFrame) -> softmax.Softmax:
    model = softmax.fit(data.filter("split <> 'test'"), "embedding", "label", keys=["vec_id"], parts=PARTS)
    if not model.converged:
        raise RuntimeError(f"no optimum in {model.steps} steps: slope {model.steepest}")
    return model


# One column, two classes: few enough figures for SQL to take the same Newton steps.
STEPS_SQL = 30
LINES_SQL = """d AS (SELECT l_discount * 10 AS x, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS y FROM lineitem
    WHERE l_tax + l_discount > 0.05 OR l_linestatus = 'F')"""


@query(
    "softmax_optimum",
    f"""WITH RECURSIVE {LINES_SQL},
n AS (SELECT count(*)::DOUBLE AS n, sum(y)::DOUBLE AS n1 FROM d),
z AS (SELECT x, y, count(*) * CASE WHEN y = 1 THEN n / (2 * n1) ELSE n / (2 * (n - n1)) END AS w FROM d, n GROUP BY x, y, n, n1),
s AS (
  SELECT 0 AS step, 0::DOUBLE AS a, 0::DOUBLE AS b UNION ALL
  SELECT step + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) FROM (
    SELECT step, a, b, sum(w * (p - y)) AS ga, sum(w * (p - y) * x) + any_value(n) * {softmax.RIDGE} / 2 * b AS gb,
      sum(w * p * (1 - p)) AS haa, sum(w * p * (1 - p) * x) AS hab, sum(w * p * (1 - p) * x * x) + any_value(n) * {softmax.RIDGE} / 2 AS hbb
    FROM (SELECT step, a, b, x, y, w, n, 1 / (1 + exp(-a - b * x)) AS p FROM s, z, n WHERE step < {STEPS_SQL}) GROUP BY step, a, b)
),
o AS (SELECT a, b FROM s WHERE step = {STEPS_SQL}),
q AS (SELECT y, w, 1 / (1 + exp(-a - b * x)) AS p FROM z, o)
SELECT round(a, 6) + 0.0::DOUBLE AS bias, round(b, 6) + 0.0::DOUBLE AS weight, round(sum(w * p), 3) AS mass_f, round(any_value(n) / 2, 3) AS wanted_f,
  round(-sum(w * ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) / any_value(n) + {softmax.RIDGE} / 4 * b * b, 6) AS loss, 0.0::DOUBLE AS steepest,
  TRUE AS converged FROM q, o, n GROUP BY a, b""",
)
def softmax_optimum(spark: SparkSession, folder: str) -> DataFrame:
    """The optimum of a weighted fit on one column, and its slope measured anew over the rows.

    Classes are the lines' status; weights and biases are told as differences of both classes.
    """
    lines = table(spark, folder, "lineitem").filter("l_tax + l_discount > 0.05 OR l_linestatus = 'F'")
    data = lines.select(F.array(F.col("l_discount") * 10).alias("x"), F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("y"))
    model = softmax.fit(data, "x", "y")
    bias, weight = (model.weights[1] - model.weights[0]).tolist()
    weights = metrics.class_weights(data, "y").select("y", "weight")
    scored = model.transform(data).join(F.broadcast(weights), "y")  # a row a class: two
    p, w = F.col("probs")[1], F.col("weight")
    off = w * (p - F.col("y"))
    n = F.count("*")
    slopes = [F.sum(off) / n, F.sum(off * F.col("x")[0]) / n + F.lit(softmax.RIDGE * float(model.weights[1, 1]))]
    return scored.agg(
        (F.round(F.lit(bias), 6) + 0.0).alias("bias"),
        (F.round(F.lit(weight), 6) + 0.0).alias("weight"),
        F.round(F.sum(w * p), 3).alias("mass_f"),
        F.round(n / 2, 3).alias("wanted_f"),
        F.round(F.lit(model.loss), 6).alias("loss"),
        (F.round(F.greatest(*[F.abs(s) for s in slopes]), 7) + 0.0).alias("steepest"),
        F.lit(model.converged).alias("converged"),
    )


UNITS, SMALL_UNITS = 32, 4


def _draw_sql(name: str, i: str, j: str, reach: str) -> str:
    return f"(('0x' || substr(md5('{name}-' || {i} || '-' || {j}), 1, 8))::BIGINT / 4294967296.0::DOUBLE * 2 - 1) * ({reach})"


@query(
    "training_first_step",
    f"""WITH e AS (SELECT vec_id AS v, label AS c, list_prepend(1.0::DOUBLE, embedding::DOUBLE[]) AS x, md5(vec_id::VARCHAR) >= 'e0000000' AS held FROM embeddings),
k AS (SELECT count(DISTINCT c) AS k, count(*) AS n FROM e WHERE NOT held),
m AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i, n / (k * count(*))::DOUBLE AS w FROM e, k WHERE NOT held GROUP BY c, n, k),
u AS (SELECT unnest(range({SMALL_UNITS})) AS u),
wi AS (SELECT u, list(w ORDER BY j) AS w FROM (SELECT u, j, {_draw_sql("inner", "u", "j", "1 / sqrt(64)")} AS w FROM u, (SELECT unnest(range(65)) AS j)) GROUP BY u),
h AS (SELECT v, list_prepend(1.0::DOUBLE, list(tanh(list_dot_product(x, w)) ORDER BY u)) AS h FROM e, wi GROUP BY v),
wo AS (SELECT i, list(w ORDER BY j) AS w FROM (SELECT i, j, {_draw_sql("outer", "i", "j", f"1 / sqrt({SMALL_UNITS})")} AS w FROM m, (SELECT unnest(range({SMALL_UNITS + 1})) AS j)) GROUP BY i),
z AS (SELECT v, i, exp(list_dot_product(h, w)) AS z FROM h, wo),
p AS (SELECT e.v, z.i, z.z / sum(z.z) OVER (PARTITION BY e.v) AS p, m.w, {training.SMOOTHING} / k + CASE WHEN z.i = m.i THEN 1 - {training.SMOOTHING} ELSE 0 END AS t
  FROM e JOIN m ON m.c = e.c JOIN z ON z.v = e.v, k WHERE NOT e.held),
g2 AS (SELECT i, j, sum(w * (p - t) * h[j]) / any_value(n) AS g FROM p JOIN h ON h.v = p.v, k, (SELECT unnest(range(1, {SMALL_UNITS + 2})) AS j) GROUP BY i, j),
bk AS (SELECT p.v, u.u, sum(p.w * (p.p - p.t) * wo.w[u.u + 2]) * (1 - any_value(h.h[u.u + 2]) ** 2) AS b FROM p JOIN wo ON wo.i = p.i JOIN h ON h.v = p.v, u GROUP BY p.v, u.u),
g1 AS (SELECT u, j, sum(b * x[j]) / any_value(n) AS g FROM bk JOIN e ON e.v = bk.v, k, (SELECT unnest(range(1, 66)) AS j) GROUP BY u, j)
SELECT (SELECT round(-sum(w * t * ln(p)) / any_value(n), 6) FROM p, k) AS loss,
  (SELECT round(sqrt(sum(g * g)), 6) FROM (SELECT g FROM g1 UNION ALL SELECT g FROM g2)) AS slope, (SELECT n FROM k) AS n_rows""",
)
def training_first_step(spark: SparkSession, folder: str) -> DataFrame:
    """Loss and length of the gradient where a small network begins: weighted classes, smoothed labels."""
    vectors = table(spark, folder, "embeddings").withColumn("held", F.md5(F.col("vec_id").cast("string")) >= "e0000000")
    run = training.train(vectors, "embedding", "label", "held", units=SMALL_UNITS, keys=["vec_id"], parts=PARTS, most=1)
    _, _, loss, slope, _, _ = run.history[0]
    return vectors.filter("NOT held").agg(
        F.lit(round(float(loss), 6)).alias("loss"), F.lit(round(float(slope), 6)).alias("slope"), F.count("*").alias("n_rows")
    )


def trained_network(data: DataFrame) -> training.Training:
    learn = data.filter("split <> 'test'").withColumn("held", F.col("split") == "held_out")
    return training.train(learn, "embedding", "label", "held", units=UNITS, rate=0.02, patience=20, keys=["vec_id"], parts=PARTS)


@query("weighted_classifier")
def weighted_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Class-weighted softmax and a network on the vectors, reported on test rows; all scores are written once."""
    data = labelled_vectors(spark, folder)
    linear, network = fitted_softmax(data), trained_network(data).network
    test = data.filter("split = 'test'")
    scored = materialize(network.transform(linear.transform(test, "weighted softmax"), "network").drop("embedding"), "scored")
    reports = [
        softmax.report(scored, "label", f"`{name}`", model.classes).withColumn("model", F.lit(name))
        for name, model in (("weighted softmax", linear), ("network", network))
    ]
    return rel.union_all(reports)


@query("network_training")
def network_training(spark: SparkSession, folder: str) -> DataFrame:
    """Every epoch of the network's training, with what the stop rule says of its history.

    The rule read off the history agrees with the training, which ended by it.
    """
    run = trained_network(labelled_vectors(spark, folder))
    history = from_records(spark, [(e, *map(float, r)) for e, *r in run.history], run.COLUMNS).withColumn("run", F.lit("network"))
    rule = curves.early_stop(history, "run", "epoch", "watched_accuracy", 20, 0.0)
    told = history.join(F.broadcast(rule), "run")  # one row
    return told.select(
        "epoch", "rate", *[F.round(c, 9).alias(c) for c in ("loss", "slope", "watched_loss", "watched_accuracy")], "stop_epoch", "best_epoch",
        (F.col("best_epoch") == run.best_epoch).alias("same_best"), F.lit(run.stopped).alias("stopped"),
    )


@query("classifier_payload")
def classifier_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector scored by the weighted classifier and answered as JSON."""
    data = labelled_vectors(spark, folder)
    model = fitted_softmax(data)
    answer = arrays.prediction_payload([str(c) for c in model.classes], F.col("probs"))
    return model.transform(data).select("vec_id", "label", answer.alias("a")).select(
        "vec_id", "label", "a.clase", "a.confianza", F.to_json("a").alias("payload")
    )
