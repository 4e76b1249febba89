"""Class-weighted softmax regression by Newton steps, to a tolerance.

A step is one pass over the rows: every task adds up the loss, the gradient and the blocks
of the curvature (one for each pair of classes), the sums are of the model's size, and the
driver solves for the step.  A step that does not lower the loss is halved.  The fit ends
when no entry of the gradient exceeds the tolerance, and tells if it never got there.

Weights are drawn to zero by ``ridge``, biases are not; so at the optimum the weighted sum
of each class's probabilities is the weighted number of its rows.  Rows without a label, or
whose vector is NULL or holds NULL or non-finite values, take no part in a fit; such vectors
get NULL probabilities.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions import arrays
from tabkit.operators import metrics, sums
from tabkit.session import spread

TOLERANCE, RIDGE = 1e-9, 1e-3
# A ceiling for safety only: Newton's method takes some ten steps.
MOST_STEPS = 200
# Classes times length of the vectors: the curvature has the square of that many entries, and
# the driver solves with it.  Larger models are for ``training.train``.
MOST_WEIGHTS = 5_000


@dataclass(frozen=True)
class Softmax:
    """Scores of a class: its row of ``weights`` times the vector, and its bias in front."""

    column: str
    classes: tuple
    weights: np.ndarray
    converged: bool
    steps: int
    loss: float
    steepest: float

    def scores(self) -> Column:
        """The classes' scores as an array, in whole-stage code."""
        rows = []
        for row in self.weights:
            weights = F.array(*[F.lit(float(w)) for w in row[1:]])
            products = F.zip_with(F.col(self.column), weights, lambda v, w: v.cast("double") * w)
            rows.append(F.aggregate(products, F.lit(float(row[0])), lambda acc, v: acc + v))
        return F.array(*rows)

    def transform(self, df: DataFrame, out: str = "probs") -> DataFrame:
        """``df`` with the classes' probabilities, in the order of ``classes``."""
        return df.withColumn(out, F.when(usable(self.column), arrays.softmax(self.scores())))

    def save(self, spark: SparkSession, path: str) -> str:
        # classes may be numbers or text
        rows = [(i, json.dumps(c), row.tolist()) for i, (c, row) in enumerate(zip(self.classes, self.weights))]
        table = spark.createDataFrame(rows, "i int, class string, weights array<double>")
        told = F.struct(
            F.lit(self.column).alias("column"), F.lit(self.converged).alias("converged"), F.lit(self.steps).alias("steps"),
            F.lit(self.loss).alias("loss"), F.lit(self.steepest).alias("steepest"),
        )
        table.withColumn("told", told).coalesce(1).write.mode("overwrite").parquet(f"{path}/softmax")
        return path


def load(spark: SparkSession, path: str) -> Softmax:
    rows = sorted(spark.read.parquet(f"{path}/softmax").collect(), key=lambda r: r["i"])
    told = rows[0]["told"]
    classes = tuple(json.loads(r["class"]) for r in rows)
    return Softmax(told["column"], classes, np.array([r["weights"] for r in rows]), told["converged"], told["steps"], told["loss"], told["steepest"])


def usable(column: str) -> Column:
    """True where a vector can be scored."""
    bad = F.exists(F.col(column), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.col(column).isNotNull() & ~bad


def learnable(
    df: DataFrame, column: str, label: str, weighted: bool, keys: Sequence[str], parts: int | None, most: int | None = None
) -> tuple[DataFrame, list, int]:
    """(rows with ``_x``, class number ``_c`` and weight ``_w``, the classes, the vectors' length).

    ``most``: weights that a model of these classes and vectors may have.
    """
    rows = df.filter(F.col(label).isNotNull() & usable(column))
    # one row a class
    sizes = [f(F.size(column)).alias(n) for f, n in ((F.count, "_n"), (F.min, "_low"), (F.max, "_high"))]
    told = rows.groupBy(F.col(label).alias("_label")).agg(*sizes).collect()
    if not told:
        raise ValueError("no rows to learn from")
    width = {r["_low"] for r in told} | {r["_high"] for r in told}
    if len(width) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(width)}")
    weights = len(told) * (max(width) + 1)
    if most is not None and weights > most:
        raise ValueError(f"{len(told)} classes of {max(width)} values are {weights} weights; Newton steps are for {most} at most")
    classes = sorted(r["_label"] for r in told)
    n = sum(r["_n"] for r in told)
    rows_of = {r["_label"]: r["_n"] for r in told}
    weights = [n / (len(told) * rows_of[c]) if weighted else 1.0 for c in classes]
    number = (F.array_position(F.lit(classes), F.col(label)) - 1).cast("int")
    weight = F.get(F.lit(weights), number)
    out = spread(rows, keys, parts).select(F.col(column).cast("array<double>").alias("_x"), number.alias("_c"), weight.alias("_w"))
    return out.persist(StorageLevel.MEMORY_AND_DISK), classes, width.pop()


def vectors_of(batch, width: int) -> np.ndarray:
    """The vectors of a batch, a column of ones in front."""
    values = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return np.hstack([np.ones((len(values), 1)), values])


def probabilities(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(1, keepdims=True))
    return powers / powers.sum(1, keepdims=True)


def fit(
    df: DataFrame,
    column: str,
    label: str,
    weighted: bool = True,
    ridge: float = RIDGE,
    tolerance: float = TOLERANCE,
    keys: Sequence[str] = (),
    parts: int | None = None,
) -> Softmax:
    """The softmax of least weighted log loss (a mean over the rows) plus ``ridge`` / 2 times the squared weights."""
    rows, classes, width = learnable(df, column, label, weighted, keys, parts, MOST_WEIGHTS)
    k, d = len(classes), width + 1
    penalty = np.full((k, d), ridge)
    penalty[:, 0] = 0.0
    # scores may all be shifted alike: that direction of the biases is pinned, its slope is 0
    pinned = np.zeros((k, d, k, d))
    pinned[:, 0, :, 0] = 1.0

    def figures_at(weights):
        def figures(batch):
            x, w = vectors_of(batch, width), batch.column("_w").to_numpy()
            c = batch.column("_c").to_numpy()
            p = probabilities(x @ weights.T)
            off = p.copy()
            off[np.arange(len(c)), c] -= 1.0
            out = {0: np.array([w.sum(), -(w * np.log(np.maximum(p[np.arange(len(c)), c], 1e-300))).sum()])}
            for a in range(k):
                out[1 + a] = (w * off[:, a]) @ x
                bent = [((w * p[:, a] * ((a == b) - p[:, b]))[:, None] * x).T @ x for b in range(k)]
                out[1 + k + a] = np.stack(bent, 1).ravel()  # d rows, k blocks, d columns
            return out

        return figures

    def measure(weights):
        found = sums.total(rows, ["_x", "_c", "_w"], figures_at(weights), k * d * (k * d + 1) + 2)
        n, loss = found[0]
        slope = np.stack([found[1 + a] for a in range(k)]) / n + penalty * weights
        bent = np.stack([found[1 + k + a].reshape(d, k, d) for a in range(k)]) / n
        bent = bent + pinned
        for a in range(k):
            bent[a, range(d), a, range(d)] += penalty[a]
        return loss / n + 0.5 * (penalty * weights**2).sum(), slope, bent.reshape(k * d, k * d)

    weights = np.zeros((k, d))
    try:
        loss, slope, bent = measure(weights)
        steps = 0
        while np.abs(slope).max() > tolerance and steps < MOST_STEPS:
            move, share = np.linalg.lstsq(bent, slope.ravel(), rcond=None)[0].reshape(k, d), 1.0
            # near the optimum losses differ by less than their rounding
            while True:
                tried = weights - share * move
                new = measure(tried)
                steps += 1
                if new[0] <= loss + 1e-12 * abs(loss) or share < 1e-6 or steps >= MOST_STEPS:
                    break
                share /= 2
            stuck = np.abs(new[1]).max() >= np.abs(slope).max() and new[0] >= loss
            if stuck:
                break
            weights, (loss, slope, bent) = tried, new
    finally:
        rows.unpersist()
    steepest = float(np.abs(slope).max())
    return Softmax(column, tuple(classes), weights, steepest <= tolerance, steps, float(loss), steepest)


def report(scored: DataFrame, label: str, probs: str, classes: Sequence) -> DataFrame:
    """``metrics.classification_report`` of the likeliest class."""
    names = F.array(*[F.lit(c) for c in classes])
    called = F.element_at(names, arrays.argmax(F.col(probs)) + 1)
    return metrics.classification_report(scored.select(label, called.alias("called")), label, "called")
