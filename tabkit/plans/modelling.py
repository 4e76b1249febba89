"""Fitted models: closed-form lines checked by SQL, and MLlib models."""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions import text
from tabkit.operators import closed_form, families, features, gram, metrics, models, softmax, splits
from tabkit.operators import relational as rel
from tabkit.plans.analysis import CHARGE_SQL, LINE_KEY, charged_lines
from tabkit.plans.registry import query
from tabkit.schemas import numeric_columns
from tabkit.session import work_path
from tabkit.sources import writers
from tabkit.sources.readers import from_records, table

LINEAR = ["l_extendedprice", "l_discount", "l_tax"]
# Partitions of the rows that iterative fits pass over again and again.
PARTS = 8
CANDIDATES = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@query(
    "linreg_coefficients",
    f"""WITH d AS (SELECT l_extendedprice AS a, l_discount AS b, l_tax AS c, {CHARGE_SQL} AS y FROM lineitem),
s AS (SELECT var_pop(a) aa, var_pop(b) bb, var_pop(c) cc, covar_pop(a, b) ab, covar_pop(a, c) ac, covar_pop(b, c) bc,
  covar_pop(a, y) ay, covar_pop(b, y) yb, covar_pop(c, y) cy, avg(a) ma, avg(b) mb, avg(c) mc, avg(y) my FROM d),
t AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM s),
w AS (SELECT *, (ay * (bb * cc - bc * bc) - ab * (yb * cc - bc * cy) + ac * (yb * bc - bb * cy)) / det AS wa,
  (aa * (yb * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - yb * ac)) / det AS wb,
  (aa * (bb * cy - yb * bc) - ab * (ab * cy - yb * ac) + ay * (ab * bc - bb * ac)) / det AS wc FROM t)
SELECT 'l_extendedprice' AS feature, round(wa, 3) AS coefficient FROM w UNION ALL SELECT 'l_discount', round(wb, 3) FROM w
UNION ALL SELECT 'l_tax', round(wc, 3) FROM w
UNION ALL SELECT 'intercept', round(my - wa * ma - wb * mb - wc * mc, 3) FROM w""",
)
def linreg_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    return models.coefficients(charged_lines(spark, folder, *LINEAR), LINEAR, "charge", digits=3)


@query(
    "regression_metrics",
    f"""WITH d AS (SELECT {CHARGE_SQL} AS y, l_extendedprice AS x FROM lineitem),
m AS (SELECT regr_slope(y, x) b, regr_intercept(y, x) a FROM d), p AS (SELECT y, a + b * x AS p FROM d, m)
SELECT count(*) AS n_rows, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 4) AS r2,
  round(sqrt(avg((y - p) ** 2)), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae FROM p""",
)
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    lines = charged_lines(spark, folder, "l_extendedprice")
    line = closed_form.fit_line(lines, "l_extendedprice", "charge")
    scored = lines.withColumn("p", closed_form.predict_line("l_extendedprice", line))
    return metrics.regression(scored, "charge", "p", digits=4)


FOLD_SQL = "('0x' || substr(md5(l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR), 1, 6))::INT % 5"


@query(
    "cv_metrics",
    f"""WITH f AS (SELECT {CHARGE_SQL} y, l_extendedprice x, {FOLD_SQL} AS fold FROM lineitem),
m AS (SELECT k.fold, regr_slope(f.y, f.x) b, regr_intercept(f.y, f.x) a
  FROM f, (SELECT unnest(range(5)) AS fold) k WHERE f.fold <> k.fold GROUP BY 1),
s AS (SELECT m.fold, sqrt(avg((f.y - m.a - m.b * f.x) ** 2)) rmse, avg(abs(f.y - m.a - m.b * f.x)) mae,
  1 - sum((f.y - m.a - m.b * f.x) ** 2) / (var_pop(f.y) * count(*)) r2 FROM f JOIN m USING (fold) GROUP BY 1)
SELECT round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std, round(avg(rmse), 3) AS rmse_mean,
  round(stddev_pop(rmse), 3) AS rmse_std, round(avg(mae), 3) AS mae_mean, round(stddev_pop(mae), 3) AS mae_std FROM s""",
)
def cv_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Five-fold cross-validation of one line: two scans for all folds."""
    lines = charged_lines(spark, folder, *LINE_KEY, "l_extendedprice")
    folded = splits.with_fold(lines, LINE_KEY, 5)
    fitted = closed_form.fold_lines(folded, ["l_extendedprice"], "charge", "fold", 5)
    scored = closed_form.fold_predictions(folded, fitted, ["l_extendedprice"], "fold")
    scores = closed_form.wide_scores(scored, ["l_extendedprice"], "charge", ["fold"])
    summary = metrics.across_folds(scores, ["r2", "rmse", "mae"])
    digits = {"r2": 6, "rmse": 3, "mae": 3}
    return summary.select(
        *[
            F.round(f"{m}_{s}", d).alias(f"{m}_{s}")
            for m, d in digits.items()
            for s in ("mean", "std")
        ]
    )


def _models_sql() -> str:
    wide = f"""
base AS (SELECT {CHARGE_SQL} AS y, l_extendedprice, l_quantity, l_discount, l_tax, {FOLD_SQL} AS fold,
  md5('s' || l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR) < 'cccccccd' AS is_train FROM lineitem),
d AS ({" UNION ALL ".join(f"SELECT '{c}' AS model, y, {c} AS x, fold, is_train FROM base" for c in CANDIDATES)}),
k AS (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS part),
m AS (SELECT model, part, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM d, k
  WHERE is_train AND fold <> part GROUP BY ALL),
s AS (SELECT d.model, m.part, 1 - sum((y - a - b * x) ** 2) / (var_pop(y) * count(*)) AS r2,
  sqrt(avg((y - a - b * x) ** 2)) AS rmse, avg(abs(y - a - b * x)) AS mae
  FROM d JOIN m ON d.model = m.model AND m.part = CASE WHEN is_train THEN fold ELSE -1 END GROUP BY ALL),
cv AS (SELECT model, avg(r2) AS r2_mean, stddev_pop(r2) AS r2_std, avg(rmse) AS rmse_mean FROM s WHERE part >= 0 GROUP BY 1),
test AS (SELECT model, r2 AS test_r2, rmse AS test_rmse, mae AS test_mae FROM s WHERE part < 0),
both_parts AS (SELECT * FROM cv JOIN test USING (model))
"""
    return wide


def compared(spark: SparkSession, folder: str) -> DataFrame:
    lines = charged_lines(spark, folder, *LINE_KEY, *CANDIDATES)
    folded = splits.with_fold(lines, LINE_KEY, 5)
    split = splits.random_split(folded, LINE_KEY, {"train": 0.8, "test": 0.2}, "s")
    return closed_form.compare_models(split, CANDIDATES, "charge", "split", "fold", 5)


@query(
    "model_comparison",
    f"""WITH {_models_sql()}
SELECT model AS model_name, printf('%.4f', r2_mean) || ' ± ' || printf('%.4f', r2_std) AS cv_r2,
  round(rmse_mean, 4) AS cv_rmse, round(test_r2, 4) + 0.0::DOUBLE AS test_r2, round(test_rmse, 4) AS test_rmse,
  round(test_mae, 4) AS test_mae FROM both_parts ORDER BY test_r2 DESC""",
)
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-validation and test metrics of the models, best test R² first."""
    table_of = compared(spark, folder).orderBy(F.col("test_r2").desc())
    shown = table_of.select(
        "model",
        text.mean_plus_minus(F.col("cv_r2_mean"), F.col("cv_r2_std")).alias("cv_r2"),
        F.round("cv_rmse_mean", 4).alias("cv_rmse"),
        (F.round("test_r2", 4) + 0.0).alias("test_r2"),
        F.round("test_rmse", 4).alias("test_rmse"),
        F.round("test_mae", 4).alias("test_mae"),
    )
    return rel.rename(shown, {"model": "model_name"})


@query(
    "best_model",
    f"""WITH {_models_sql()}
SELECT model, round(r2_mean, 6) AS cv_r2, round(test_r2, 6) AS test_r2, round(test_rmse, 4) AS test_rmse,
  round((r2_mean - test_r2) / r2_mean * 100, 4) + 0.0::DOUBLE AS r2_gap_pct FROM both_parts
ORDER BY r2_mean DESC, model LIMIT 1""",
)
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    """The winner, chosen by cross-validation; the test rows only describe it."""
    results = compared(spark, folder)
    winner = metrics.best_of(results, "cv_r2_mean", "model").select("model")
    # The winner is one row: safe to broadcast.
    won = results.join(F.broadcast(winner), "model", "left_semi")
    gap = closed_form.gap_pct(F.col("cv_r2_mean"), F.col("test_r2"))
    return won.select(
        "model",
        F.round("cv_r2_mean", 6).alias("cv_r2"),
        F.round("test_r2", 6).alias("test_r2"),
        F.round("test_rmse", 4).alias("test_rmse"),
        (F.round(gap, 4) + 0.0).alias("r2_gap_pct"),
    )


KEPT = 4
# Dummies in SQL: dropping another value of a category spans the same fits.
DUMMIES_SQL = {"d0": "l_returnflag = 'A'", "d1": "l_returnflag = 'N'", "d2": "l_linestatus = 'F'"}


def _selection_sql(numeric: list[str], k: int) -> str:
    """R² on the test rows of all columns and of the k most correlated ones, by sweeping the covariances."""
    names = [*[f"x{i}" for i in range(len(numeric))], *DUMMIES_SQL, "y"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    entry = lambda a, b: f"{a}_{b}" if (a, b) in pairs else f"{b}_{a}"
    columns = ", ".join(f"{c}::DOUBLE AS x{i}" for i, c in enumerate(numeric))
    columns += "".join(f", ({test})::INT::DOUBLE AS {d}" for d, test in DUMMIES_SQL.items())
    moments = ", ".join([f"covar_pop({a}, {b}) AS {a}_{b}" for a, b in pairs] + [f"avg({a}) AS m_{a}" for a in names])
    ranked = " UNION ALL ".join(
        f"SELECT {i} AS i, '{c}' AS name, abs(corr(x{i}, y)) AS r FROM d WHERE is_train" for i, c in enumerate(numeric)
    )
    used = {f"x{i}": f"(n = 0 OR list_contains(best, {i}))" for i in range(len(numeric))} | {d: "TRUE" for d in DUMMIES_SQL}
    steps, before = [], "v0"
    for j, p in enumerate(names[:-1]):
        swept = []
        for a, b in pairs:
            d, value = entry(p, p), entry(a, b)
            if a == b == p:
                new = f"-1 / {d}"
            elif p in (a, b):
                new = f"{value} / {d}"
            else:
                new = f"{value} - {entry(a, p)} * {entry(p, b)} / {d}"
            swept.append(f"CASE WHEN {used[p]} THEN {new} ELSE {value} END AS {value}")
        steps.append(f"v{j + 1} AS (SELECT n, best, {', '.join(swept)}, {', '.join(f'm_{a}' for a in names)} FROM {before})")
        before = f"v{j + 1}"
    weights = ", ".join(f"CASE WHEN {used[a]} THEN {entry(a, 'y')} ELSE 0 END AS w_{a}" for a in names[:-1])
    off = " - ".join([f"(t.m_y - w.m_y)", *[f"w.w_{a} * (t.m_{a} - w.m_{a})" for a in names[:-1]]])
    inner = " + ".join(f"w.w_{a} * w.w_{b} * t.{entry(a, b)}" for a in names[:-1] for b in names[:-1])
    outer = " + ".join(f"w.w_{a} * t.{entry(a, 'y')}" for a in names[:-1])
    listed = "[" + ", ".join(f"'{c}'" for c in numeric) + "]"
    return f"""WITH d AS (SELECT {columns}, {CHARGE_SQL} AS y,
  md5('fs' || l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR) < 'cccccccd' AS is_train FROM lineitem),
o AS (SELECT list(i ORDER BY r DESC, name)[1:{k}] AS best, list(name ORDER BY r DESC, name)[1:{k}] AS named FROM ({ranked})),
s AS (SELECT unnest([0, {k}]) AS n), v0 AS (SELECT n, best, a.* FROM s, o, (SELECT {moments} FROM d WHERE is_train) a),
{", ".join(steps)},
w AS (SELECT n, {weights}, {", ".join(f"m_{a}" for a in names)} FROM {before}),
t AS (SELECT {moments} FROM d WHERE NOT is_train),
e AS (SELECT n, 1 - (t.y_y - 2 * ({outer}) + {inner} + ({off}) ** 2) / t.y_y AS r2 FROM w, t)
SELECT CASE WHEN n = 0 THEN 'all' ELSE 'best {k}' END AS feature_set,
  (CASE WHEN n = 0 THEN {len(numeric)} ELSE {k} END + {len(DUMMIES_SQL)})::INT AS n_features,
  array_to_string(CASE WHEN n = 0 THEN {listed} ELSE named END, ',') AS features, round(r2, 6) AS r2,
  round((b.r2_all - r2) / b.r2_all * 100, 4) + 0.0::DOUBLE AS r2_loss_pct
FROM e, o, (SELECT r2 AS r2_all FROM e WHERE n = 0) b"""


NUMERIC = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("feature_selection_compare", _selection_sql(NUMERIC, KEPT))
def feature_selection_compare(spark: SparkSession, folder: str) -> DataFrame:
    """All numeric columns of the lines (by schema, keys aside) against the most correlated ones.

    Both sets hold the categories' dummies.  One pass gives the moments; times are the bench's.
    """
    lines = table(spark, folder, "lineitem")
    numeric = numeric_columns(lines.schema, LINE_KEY)
    lines = lines.withColumn("charge", F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
    added = []
    for category in ("l_returnflag", "l_linestatus"):
        lines, names = gram.dummies(lines, category)
        added += names
    split = splits.random_split(lines, LINE_KEY, {"train": 0.8, "test": 0.2}, "fs")
    return gram.feature_sets_table(split, numeric, "charge", "split", KEPT, added)


def _cuts_sql(rows: str, place: str) -> str:
    """The best cut of some rows by quantity: every middle between two values is tried."""
    return f"""
{place}_v AS (SELECT l_quantity AS q, count(*) AS n, sum(charge) AS s FROM {rows} GROUP BY 1),
{place}_c AS (SELECT (q + lead(q) OVER (ORDER BY q)) / 2 AS cut, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
  sum(n) OVER () AS nt, sum(s) OVER () AS st FROM {place}_v WINDOW w AS (ORDER BY q)),
{place}_b AS (SELECT cut, nl, nt - nl AS nr, sl / nl AS ml, (st - sl) / (nt - nl) AS mr FROM {place}_c
  WHERE cut IS NOT NULL ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1)"""


@query(
    "tree_first_split",
    f"""WITH x AS (SELECT l_quantity, {CHARGE_SQL} AS charge FROM lineitem),
{_cuts_sql("x", "r")},
xl AS (SELECT x.* FROM x, r_b WHERE l_quantity <= cut), xr AS (SELECT x.* FROM x, r_b WHERE l_quantity > cut),
{_cuts_sql("xl", "a")}, {_cuts_sql("xr", "b")},
u AS (SELECT 'root' AS place, * FROM r_b UNION ALL SELECT 'root/left', * FROM a_b
  UNION ALL SELECT 'root/right', * FROM b_b)
SELECT place, cut AS threshold, round(ml, 4) AS mean_left, round(mr, 4) AS mean_right FROM u""",
)
def tree_first_split(spark: SparkSession, folder: str) -> DataFrame:
    """The first three cuts of a tree on one column of few values, where every cut can be tried."""
    lines = charged_lines(spark, folder, "l_quantity")
    data = features.assemble(lines, ["l_quantity"]).select("features", "charge")
    tree = DecisionTreeRegressor(
        featuresCol="features", labelCol="charge", maxDepth=2, maxBins=64
    ).fit(data)
    rows = [
        (s["place"], s["threshold"], round(s["mean_left"], 4), round(s["mean_right"], 4))
        for s in models.splits_of(tree)
    ]
    return from_records(
        spark, rows, "place string, threshold double, mean_left double, mean_right double"
    )


KINDS = ["boosted", "forest", "line", "pipeline", "softmax", "tree"]


@query(
    "model_roundtrip",
    f"""WITH k AS (SELECT unnest({KINDS}) AS kind), n AS (SELECT (SELECT count(*) FROM embeddings) AS v, (SELECT count(*) FROM lineitem) AS l)
SELECT kind, CASE WHEN kind = 'softmax' THEN v ELSE l END AS n_rows, CASE WHEN kind = 'softmax' THEN v ELSE l END AS n_equal, TRUE AS centred FROM k, n""",
)
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of model stored, loaded and applied again: equal values, and about the right mean.

    Least-squares models call the mean of their own rows exactly; a bagged forest does so
    nearly, and the mean of class probabilities equals the classes' (weighted) shares.
    """
    lines = charged_lines(spark, folder, *LINE_KEY, *LINEAR)
    small = families.Settings(tree_depth=3, forest_step=3, forest_most=3, forest_depth=3, rounds=2, boost_depth=2, watched=0.0)
    _, fitted = families.compare(lines, LINEAR, "charge", LINE_KEY, 2, small, 0)
    line = LinearRegression(featuresCol="features", labelCol="charge", predictionCol="prediction")
    kinds = {"line": fitted["linear"], **{n: fitted[n] for n in ("tree", "forest", "boosted")}}
    kinds["pipeline"] = features.feature_pipeline(LINEAR, None, line).fit(lines)
    folder_of = work_path(spark, "models")
    stored = {n: models.load(writers.model(m, folder_of, f"{n} of charge")) for n, m in kinds.items()}
    both = lines
    for n in kinds:
        both = kinds[n].transform(both).withColumnRenamed("prediction", f"kept_{n}").drop("features", "_raw_features")
        both = stored[n].transform(both).withColumnRenamed("prediction", f"read_{n}").drop("features", "_raw_features")
    spread = 0.05 * F.stddev_pop("charge")
    told = [
        F.struct(
            F.lit(n).alias("kind"), F.count("*").alias("n_rows"),
            F.count_if(F.col(f"kept_{n}") == F.col(f"read_{n}")).alias("n_equal"),
            (F.abs(F.avg(f"read_{n}") - F.avg("charge")) < spread).alias("centred"),
        )
        for n in kinds
    ]
    measured = both.agg(F.array(*told).alias("rows")).select(F.inline("rows"))
    return measured.unionByName(_softmax_roundtrip(spark, folder, folder_of))


def _softmax_roundtrip(spark: SparkSession, folder: str, folder_of: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    model = softmax.fit(vectors, "embedding", "label", weighted=False)
    again = models.load(writers.model(model, folder_of, "softmax of labels"))
    both = again.transform(model.transform(vectors, "kept"), "read")
    share = F.avg(F.col("read")[0]) - F.avg((F.col("label") == F.lit(model.classes[0])).cast("double"))
    return both.agg(
        F.lit("softmax").alias("kind"), F.count("*").alias("n_rows"),
        F.count_if(F.col("kept") == F.col("read")).alias("n_equal"), (F.abs(share) < 0.05).alias("centred"),
    )
