"""MLlib models: fit, compare, weigh, persist, reload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.operators import families, histograms, metrics, softmax
from tabkit.operators.splits import with_fold
from tabkit.session import spread
from tabkit.sources import writers
from tabkit.sources.readers import from_records

# Tree settings the published metrics were reached with.
TREE_DEPTH = 5
TREE_MIN_LEAF = 10
TREE_MIN_GAIN = 0.001


def linear_fit(df: DataFrame, columns: Sequence[str], target: str):
    """Fitted pipeline of an assembled least-squares model.

    Rows with a missing feature or target take no part in the fit; when scored, a row
    with a missing feature gets NaN and does not stop the others.
    """
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip"),
        LinearRegression(featuresCol="features", labelCol=target, solver="normal"),
    ]
    fitted = Pipeline(stages=stages).fit(df.dropna(subset=[target]))
    fitted.stages[0].setHandleInvalid("keep")
    return fitted


def coefficients(df: DataFrame, columns: Sequence[str], target: str, digits: int) -> DataFrame:
    """feature, coefficient: largest absolute value first; the intercept last."""
    line = linear_fit(df, columns, target).stages[-1]
    records = [(c, round(float(v), digits)) for c, v in zip(columns, line.coefficients)]
    ranked = sorted(records, key=lambda r: (-abs(r[1]), r[0]))
    ranked.append(("intercept", round(float(line.intercept), digits)))
    return from_records(df.sparkSession, ranked, "feature string, coefficient double")


def cross_validate(
    df: DataFrame, model, keys: Sequence[str], target: str, k: int = 5, parts: int | None = None
) -> DataFrame:
    """Fold scores (fold, r2, rmse, mae) of an MLlib model on hash folds."""
    folded = with_fold(spread(df, keys, parts), keys, k).persist(StorageLevel.MEMORY_AND_DISK)
    records = []
    try:
        for fold in range(k):
            fitted = model.fit(folded.filter(F.col("fold") != fold))
            scored = fitted.transform(folded.filter(F.col("fold") == fold))
            row = metrics.regression(scored, target, "prediction", digits=12).first()
            records.append((fold, row["r2"], row["rmse"], row["mae"]))
    finally:
        folded.unpersist()
    return from_records(
        df.sparkSession, records, "fold int, r2 double, rmse double, mae double"
    )


def grid_search(df: DataFrame, model, grid: dict, keys: Sequence[str], target: str, k: int = 5):
    """MLlib cross-validation over a parameter grid with hash folds."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, values)
    search = CrossValidator(
        estimator=model,
        estimatorParamMaps=builder.build(),
        evaluator=RegressionEvaluator(labelCol=target, metricName="r2"),
        numFolds=k,
        foldCol="fold",
        parallelism=2,
    )
    return search.fit(with_fold(df, keys, k))


def tree_learner(target: str) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        featuresCol="features",
        labelCol=target,
        maxDepth=TREE_DEPTH,
        minInstancesPerNode=TREE_MIN_LEAF,
        minInfoGain=TREE_MIN_GAIN,
        seed=42,
    )


def decision_tree(df: DataFrame, target: str):
    return tree_learner(target).fit(df)


def splits_of(model) -> list[dict]:
    """Inner nodes of a tree from the root down: place, feature, threshold, and both means."""
    found = []

    def walk(node, place: str) -> None:
        if node.subtreeDepth() > 0:
            split, left, right = node.split(), node.leftChild(), node.rightChild()
            found.append(
                {
                    "place": place,
                    "feature": split.featureIndex(),
                    "threshold": split.threshold(),
                    "mean_left": left.prediction(),
                    "mean_right": right.prediction(),
                }
            )
            walk(left, f"{place}/left")
            walk(right, f"{place}/right")

    walk(model._java_obj.rootNode(), "root")
    return found


def tree_summary(name: str, model: histograms.Ensemble) -> list[tuple]:
    """(model, measure, value) rows: size and feature importances."""
    if len(model.trees) == 1:
        only = model.trees[0]
        rows = [(name, "depth", float(only.depth())), (name, "n_leaves", float(sum(f < 0 for f in only.feature)))]
    else:
        rows = [(name, "n_trees", float(len(model.trees)))]
    return rows + [(name, f"importance:{c}", v) for c, v in model.importances().items()]


def tree_text(model, columns: Sequence[str]) -> str:
    """The tree as text with column names instead of feature numbers."""
    text = model.toDebugString
    for i in reversed(range(len(columns))):
        text = text.replace(f"feature {i} ", f"{columns[i]} ")
    return text


def as_vector(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def probabilities(scored: DataFrame, out: str = "probs") -> DataFrame:
    return scored.withColumn(out, vector_to_array("probability"))


def keep_best(fitted: Mapping, results: DataFrame, metric: str, folder: str) -> tuple[str, str]:
    """Store only the model whose row in ``results`` (model, metric) is best.

    Returns its name and path.
    """
    name = metrics.best_of(results, metric, "model").first()["model"]
    return name, writers.model(fitted[name], folder, name)


def load(path: str) -> PipelineModel | histograms.Ensemble | families.LinearModel | softmax.Softmax:
    """A model stored by ``writers.model``: an MLlib pipeline (if of one stage), or one kept as tables."""
    if path.endswith(writers.TABLES):
        return families.load(SparkSession.active(), path)
    return PipelineModel.load(path)
