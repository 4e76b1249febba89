"""Four model families compared on the same folds, fitted side by side.

One fold table serves all families.  The fits on "all folds but one", and the fit on all
rows that is kept if its family wins, are slots of the same passes: five folds of a family
take as many passes as one fit.  Rows that boosting watches to stop come from the training
folds; a forest watches the rows that its trees did not draw.  One last pass scores every
row by the models that have not seen its fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.functions.hashing import fold_of, hex_cut, key_hash
from tabkit.operators import gram, histograms, metrics, softmax

FAMILIES = ("linear", "tree", "forest", "boosted")


@dataclass(frozen=True)
class Settings:
    """How far the families may grow; the defaults are those of the published metrics."""

    tree_depth: int = 5
    tree_least: float = 10
    tree_gain: float = 0.001
    forest_step: int = histograms.FOREST_STEP
    forest_most: int = histograms.FOREST_MAX
    forest_depth: int = histograms.FOREST_DEPTH
    rounds: int = histograms.BOOST_ROUNDS
    boost_depth: int = histograms.BOOST_DEPTH
    watched: float = 0.1


@dataclass(frozen=True)
class LinearModel:
    """A least-squares line that can be applied and kept like the other families."""

    line: gram.Line

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.line.predict())

    def save(self, spark: SparkSession, path: str) -> str:
        rows = [(c, float(w)) for c, w in zip(self.line.columns, self.line.weights)] + [(None, self.line.intercept)]
        spark.createDataFrame(rows, "name string, weight double").coalesce(1).write.mode("overwrite").parquet(f"{path}/line")
        return path


def compare(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    keys: Sequence[str],
    k: int = 5,
    settings: Settings = Settings(),
    parts: int | None = None,
) -> tuple[DataFrame, dict]:
    """(model, fold, n_rows, r2, rmse, mae) on the fold left out, and each family fitted on all rows."""
    s = settings
    rows = df.filter(F.col(target).isNotNull())
    bins = histograms.fit_bins(rows, columns)
    raw = {f"_r{i}": F.col(c).cast("double") for i, c in enumerate(columns)}
    keep = {"_k": key_hash(keys), "_fold": fold_of(key_hash(keys), k)} | raw
    if s.watched:
        keep["_w"] = key_hash(keys, "watch") < hex_cut(s.watched)
    # the flags follow from the fold, so they are not written
    seen = {f"_t{f}": (F.col("_fold") != f).cast("byte") for f in range(k)} | {f"_t{k}": F.lit(1).cast("byte")}
    learnt = {f"_g{f}": (~F.col("_w") & (c == 1)).cast("byte") for f, c in enumerate(seen.values())}
    held = {f"_h{f}": (F.col("_w") & (c == 1)).cast("byte") for f, c in enumerate(seen.values())}
    flags = seen | learnt | held if s.watched else seen
    table = histograms.prepare(rows, bins, target, keep, keys, parts).withColumns(flags)
    slots = list(seen)
    added = histograms.cells(table, bins, list(flags))
    trees = histograms.decision_trees(table, bins, slots, s.tree_depth, s.tree_least, s.tree_gain, added)
    pairs = list(zip(learnt, held)) if s.watched else [(c, None) for c in slots]
    # many small jobs each, and neither needs the other: one's tasks run where the other waits
    with ThreadPoolExecutor(2) as side_by_side:
        grow = partial(histograms.forests, table, bins, "_k", slots, s.forest_step, s.forest_most, depth=s.forest_depth)
        boost = partial(histograms.boosted, table, bins, pairs, s.rounds, depth=s.boost_depth, added=added)
        # each with a copy of its own of the thread's properties
        growing, boosting = (side_by_side.submit(inheritable_thread_target(df.sparkSession)(f)) for f in (grow, boost))
    (forests, _), (boosted, _) = growing.result(), boosting.result()
    moments = gram.grams(table, list(raw), "_y", "_fold")
    lines = [gram.without(moments, f).fit(list(raw)) for f in range(k)]
    fitted = {f: (trees[f], forests[f], boosted[f]) for f in range(k)}
    line = F.lit(None).cast("double")
    for f in range(k):
        line = F.when(F.col("_fold") == f, lines[f].predict()).otherwise(line)
    called = histograms.predictions(table.withColumn("_line", line), fitted, "_fold", ["_y", "_line"], added)
    predicted = dict(zip(FAMILIES, [F.col("_line"), *[F.col("_p")[i] for i in range(3)]]))
    wide = called.select("_fold", "_y", *[c.alias(f"p_{m}") for m, c in predicted.items()])
    y = F.col("_y")
    each = [
        F.struct(
            F.lit(m).alias("model"), F.count("*").alias("n_rows"), metrics.r2(y, F.col(f"p_{m}")).alias("r2"),
            metrics.rmse(y, F.col(f"p_{m}")).alias("rmse"), metrics.mae(y, F.col(f"p_{m}")).alias("mae"),
        )
        for m in FAMILIES
    ]
    found = wide.groupBy(F.col("_fold").alias("fold")).agg(F.array(*each).alias("rows")).select("fold", F.inline("rows"))
    # a row a family and fold: kept as they are, not scored again
    scores = df.sparkSession.createDataFrame(found.collect(), found.schema)
    whole = gram.total(moments.values()).fit(list(raw))
    linear = LinearModel(gram.Line(tuple(columns), whole.weights, whole.intercept))
    return scores, dict(zip(FAMILIES, (linear, trees[k], forests[k], boosted[k])))


def load(spark: SparkSession, path: str) -> LinearModel | histograms.Ensemble | softmax.Softmax:
    """A model as its ``save`` wrote it."""

    def holds(part: str) -> bool:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}")
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    if holds("softmax"):
        return softmax.load(spark, path)
    if holds("nodes"):
        return histograms.load(spark, path)
    rows = spark.read.parquet(f"{path}/line").collect()
    named = [r for r in rows if r["name"] is not None]
    (intercept,) = (r["weight"] for r in rows if r["name"] is None)
    return LinearModel(gram.Line(tuple(r["name"] for r in named), np.array([r["weight"] for r in named]), intercept))
