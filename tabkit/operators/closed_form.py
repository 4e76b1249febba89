"""One-feature linear models solved from sums: cross-validation in two scans.

The least-squares line of a fold's training rows needs only sums, and the sums
of "all folds but one" are the total minus that fold's.  So one pass over the
data fits every model on every fold, and a second pass scores them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.numeric import ratio
from tabkit.operators import metrics
from tabkit.session import small_side


def fit_line(df: DataFrame, x: str, y: str) -> tuple[float, float]:
    """(intercept, slope) over all rows with both values."""
    row = df.agg(
        F.regr_intercept(F.col(y), F.col(x)).alias("a"), F.regr_slope(F.col(y), F.col(x)).alias("b")
    ).first()
    return row["a"], row["b"]


def predict_line(x: str, line: tuple[float, float]) -> Column:
    return F.lit(line[0]) + F.lit(line[1]) * F.col(x)


def _line_sums(x: str, y: str, i: int) -> Column:
    """What one fold says about a line: size, means, spread and co-spread."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    u = F.when(both, F.col(x).cast("double"))
    v = F.when(both, F.col(y).cast("double"))
    return F.struct(
        F.count(u).alias("n"),
        F.avg(u).alias("mx"),
        F.avg(v).alias("my"),
        F.var_pop(u).alias("vx"),
        F.covar_pop(u, v).alias("cxy"),
    ).alias(f"s_{i}")


def fold_lines(
    df: DataFrame, features: Sequence[str], target: str, fold: str, k: int
) -> dict[int | None, dict[str, tuple[float, float]]]:
    """Line of each feature fitted without fold 0..k-1; key None: on all rows.

    The pass returns at most k + 1 rows, as every fold outside 0..k-1 falls into one
    group; such rows would belong to no fit, so they are refused.
    """
    sums = [_line_sums(x, target, i) for i, x in enumerate(features)]
    known = F.when(F.col(fold).between(0, k - 1), F.col(fold)).alias(fold)
    per_fold = {row[fold]: row for row in df.groupBy(known).agg(*sums).collect()}
    if None in per_fold:
        raise ValueError(f"column {fold} holds folds outside 0..{k - 1}")
    return {
        left_out: {
            x: _line([row[f"s_{i}"] for f, row in per_fold.items() if f != left_out])
            for i, x in enumerate(features)
        }
        for left_out in [None, *range(k)]
    }


def _line(parts: list) -> tuple[float, float]:
    """(intercept, slope) of the union of parts, combined about the common mean."""
    parts = [p for p in parts if p["n"]]
    n = sum(p["n"] for p in parts)
    if not n:
        return 0.0, 0.0
    mx = sum(p["n"] * p["mx"] for p in parts) / n
    my = sum(p["n"] * p["my"] for p in parts) / n
    vx = sum(p["n"] * (p["vx"] + (p["mx"] - mx) ** 2) for p in parts)
    cxy = sum(p["n"] * (p["cxy"] + (p["mx"] - mx) * (p["my"] - my)) for p in parts)
    slope = cxy / vx if vx else 0.0
    return my - slope * mx, slope


def fold_predictions(
    df: DataFrame,
    lines: dict[int | None, dict[str, tuple[float, float]]],
    features: Sequence[str],
    fold: str,
) -> DataFrame:
    """``pred_<feature>``: each row predicted by the line fitted without its fold.

    A row whose fold has no line of its own takes the line fitted on all rows.
    The lines are literals, so scoring is one projection.
    """

    def pick(x: str) -> Column:
        value = predict_line(x, lines[None][x])
        for f, by_feature in lines.items():
            if f is not None:
                value = F.when(F.col(fold) == f, predict_line(x, by_feature[x])).otherwise(value)
        return value

    return df.withColumns({f"pred_{x}": pick(x) for x in features})


def wide_scores(
    df: DataFrame, features: Sequence[str], target: str, by: Sequence[str]
) -> DataFrame:
    """(by, model, r2, rmse, mae) of every ``pred_<feature>`` in one pass."""
    y = F.col(target)
    rows = F.array(
        *[
            F.struct(
                F.lit(x).alias("model"),
                metrics.r2(y, F.col(f"pred_{x}")).alias("r2"),
                metrics.rmse(y, F.col(f"pred_{x}")).alias("rmse"),
                metrics.mae(y, F.col(f"pred_{x}")).alias("mae"),
            )
            for x in features
        ]
    )
    return df.groupBy(*by).agg(rows.alias("rows")).select(*by, F.inline("rows"))


def compare_models(
    df: DataFrame, features: Sequence[str], target: str, split: str, fold: str, k: int = 5
) -> DataFrame:
    """model, cross-validation and test metrics of one-feature linear models.

    Rows with ``split`` "train" are cross-validated; the others are the test
    set, scored by the lines fitted on all training rows.  The fitted values
    come from the training rows of each fold only.
    """
    train = df.filter(F.col(split) == "train")
    lines = fold_lines(train, features, target, fold, k)
    part = F.when(F.col(split) == "train", F.col(fold)).otherwise(F.lit(-1))
    scored = fold_predictions(df.withColumn("_part", part), lines, features, "_part")
    # At most k + 1 rows per model, named by the caller.
    scores = small_side(wide_scores(scored, features, target, ["_part"]))
    cv = metrics.across_folds(
        scores.filter("_part >= 0"), ["r2", "rmse", "mae"], by=["model"]
    ).withColumnsRenamed(
        {f"{m}_{s}": f"cv_{m}_{s}" for m in ("r2", "rmse", "mae") for s in ("mean", "std")}
    )
    test = scores.filter("_part < 0").select(
        "model",
        F.col("r2").alias("test_r2"),
        F.col("rmse").alias("test_rmse"),
        F.col("mae").alias("test_mae"),
    )
    return cv.join(F.broadcast(test), "model")


def gap_pct(better: Column, worse: Column) -> Column:
    return ratio(better - worse, better) * 100
