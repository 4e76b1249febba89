"""Regression and classification metrics as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.numeric import ratio


def r2(actual: Column, predicted: Column) -> Column:
    """Aggregate: 1 - residual / total sum of squares."""
    residual = F.sum(F.pow(actual - predicted, F.lit(2.0)))
    n = F.count(F.when(predicted.isNotNull(), actual))
    total = F.var_pop(F.when(predicted.isNotNull(), actual)) * n
    return F.lit(1.0) - ratio(residual, total)


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, F.lit(2.0))))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def regression(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), digits: int = 6
) -> DataFrame:
    """r2, rmse, mae (rounded) and n_rows, in one pass; per group with ``by``."""
    y, p = F.col(actual), F.col(predicted)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(r2(y, p), digits).alias("r2"),
        F.round(rmse(y, p), digits).alias("rmse"),
        F.round(mae(y, p), digits).alias("mae"),
    )


def across_folds(scores: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return scores.groupBy(*by).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    )


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Long confusion matrix (actual, predicted, n): classes squared rows."""
    return df.groupBy(
        F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, labels: Sequence[str], prefix: str = "pred_"
) -> DataFrame:
    """A row per actual label and a column per predicted one, in label order.

    Every label has its row and column even when it never occurs.  Rows whose
    actual or predicted class is NULL or not among the labels count nowhere.
    """
    spark = df.sparkSession
    counts = confusion_counts(df, actual, predicted)
    cells = [
        F.coalesce(F.sum(F.when(F.col("predicted") == label, F.col("n"))), F.lit(0))
        .cast("long")
        .alias(f"{prefix}{label}")
        for label in labels
    ]
    wide = counts.groupBy("actual").agg(*cells)
    axis = spark.createDataFrame([(i, label) for i, label in enumerate(labels)], "_i int, actual string")
    names = [f"{prefix}{label}" for label in labels]
    return (
        axis.join(wide.withColumn("actual", F.col("actual").cast("string")), "actual", "left")
        .na.fill(0, names)
        .orderBy("_i")
        .select("actual", *names)
    )


def confusion_shares(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Long confusion matrix with each count as a share of its actual class."""
    in_row = Window.partitionBy("actual")
    return confusion_counts(df, actual, predicted).withColumn(
        "share", ratio(F.col("n"), F.sum("n").over(in_row))
    )


def accuracy(actual: Column, predicted: Column) -> Column:
    return F.avg((actual == predicted).cast("double"))


def classification_report(df: DataFrame, actual: str, predicted: str, digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class, then the averages.

    Everything after the first grouped count works on the confusion counts.
    A division by zero counts as 0.
    """
    counts = confusion_counts(df, actual, predicted)
    # Each count is seen from its actual and its predicted class.
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").cast("string").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("called"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n"))
                    .otherwise(0)
                    .alias("hits"),
                ),
                F.struct(
                    F.col("predicted").cast("string").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("called"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per_class = (
        sides.filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(
            F.sum("support").alias("support"),
            F.sum("called").alias("called"),
            F.sum("hits").alias("hits"),
        )
        .select(
            "label",
            F.coalesce(ratio(F.col("hits"), F.col("called")), F.lit(0.0)).alias("precision"),
            F.coalesce(ratio(F.col("hits"), F.col("support")), F.lit(0.0)).alias("recall"),
            F.coalesce(
                ratio(F.col("hits") * 2, F.col("called") + F.col("support")), F.lit(0.0)
            ).alias("f1"),
            "support",
            "hits",
        )
    )
    scores = ["precision", "recall", "f1"]
    total = F.sum("support")

    def weighted(c: str) -> Column:
        return ratio(F.sum(F.col(c) * F.col("support")), total)

    # the averages are one more group of the classes' rows: nothing is gathered
    every = per_class.groupingSets([["label"], []], "label").agg(
        F.grouping("label").alias("_all"),
        *[F.avg(c).alias(c) for c in scores],
        *[weighted(c).alias(f"_{c}") for c in scores],
        ratio(F.sum("hits"), total).alias("_hits"),
        total.alias("support"),
    )
    support = F.col("support")
    averages = F.array(
        _report_row("accuracy", [F.col("_hits")] * 3, support),
        _report_row("macro avg", [F.col(c) for c in scores], support),
        _report_row("weighted avg", [F.col(f"_{c}") for c in scores], support),
    )
    own = F.array(F.struct("label", *scores, "support"))
    report = every.select(F.inline(F.when(F.col("_all") == 1, averages).otherwise(own)))
    return report.withColumns({c: F.round(c, digits) for c in scores})


def _report_row(label: str, scores: Sequence[Column], support: Column) -> Column:
    precision, recall, f1 = scores
    return F.struct(
        F.lit(label).alias("label"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        support.alias("support"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label, n_rows, weight = n / (k * n_c).

    The window runs over the class counts (one row per class), not the data.
    """
    whole = Window.partitionBy(F.lit(1))
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn(
            "weight",
            ratio(
                F.sum("n_rows").over(whole),
                F.count(F.lit(1)).over(whole) * F.col("n_rows"),
            ),
        )
    )


def best_of(results: DataFrame, metric: str, name: str, maximize: bool = True) -> DataFrame:
    """The one row of ``results`` with the best metric; ties by name."""
    order = F.col(metric).desc_nulls_last() if maximize else F.col(metric).asc_nulls_last()
    return results.orderBy(order, name).limit(1)
