from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import closed_form, curves, features, landmarks, metrics, splits


def test_regression(spark):
    y, p = [1.0, 2.0, 4.0, 7.0], [1.5, 2.0, 3.0, 8.0]
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    row = metrics.regression(df, "y", "p").first()
    error = np.array(y) - np.array(p)
    assert row["r2"] == pytest.approx(1 - (error**2).sum() / ((y - np.mean(y)) ** 2).sum(), abs=1e-6)
    assert row["rmse"] == pytest.approx(np.sqrt((error**2).mean()), abs=1e-6)
    assert row["mae"] == pytest.approx(np.abs(error).mean(), abs=1e-6)


def report_of(spark, pairs):
    df = spark.createDataFrame(pairs, "y string, p string")
    return {r["label"]: r for r in metrics.classification_report(df, "y", "p").collect()}


def test_report_of_five_classes(spark):
    """Counts behind a published report: each rounded figure comes out again."""
    counts = {
        ("1", "1"): 34, ("2", "2"): 37, ("2", "1"): 3, ("2", "3"): 1, ("3", "3"): 27,
        ("3", "4"): 4, ("3", "2"): 1, ("3", "5"): 1, ("4", "4"): 35, ("4", "3"): 2, ("5", "5"): 42,
    }
    pairs = [pair for pair, n in counts.items() for _ in range(n)]
    got = report_of(spark, pairs)
    assert [got[c]["support"] for c in "12345"] == [34, 41, 33, 37, 42]
    assert [round(got[c]["precision"], 2) for c in "12345"] == [0.92, 0.97, 0.90, 0.90, 0.98]
    assert [round(got[c]["recall"], 2) for c in "12345"] == [1.0, 0.90, 0.82, 0.95, 1.0]
    assert [round(got[c]["f1"], 4) for c in "12345"] == [0.9577, 0.9367, 0.8571, 0.9211, 0.9882]
    assert round(got["accuracy"]["f1"], 4) == 0.9358
    assert round(got["macro avg"]["f1"], 4) == 0.9322
    assert got["weighted avg"]["support"] == 187


def test_report_zero_division(spark):
    got = report_of(spark, [("a", "a"), ("b", "a"), ("b", "c")])
    assert (got["b"]["precision"], got["b"]["recall"], got["b"]["f1"]) == (0.0, 0.0, 0.0)
    assert (got["c"]["support"], got["c"]["recall"]) == (0, 0.0)


def test_confusion_keeps_absent_labels(spark):
    df = spark.createDataFrame([("low", "low"), ("low", "high"), ("high", None)], "y string, p string")
    rows = [tuple(r) for r in metrics.confusion_matrix(df, "y", "p", ["low", "mid", "high"]).collect()]
    assert rows == [("low", 1, 0, 1), ("mid", 0, 0, 0), ("high", 0, 0, 0)]


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "label string")
    got = {r["label"]: r["weight"] for r in metrics.class_weights(df, "label").collect()}
    assert got == {"a": pytest.approx(8 / 12), "b": pytest.approx(8 / 4)}


def test_best_of_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "model string, r2 double")
    assert metrics.best_of(df, "r2", "model").first()["model"] == "a"


def test_correlation_skips_null_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    assert features.correlations(df, ["x"], "y").first()["r"] == pytest.approx(1.0)


def test_top_correlated_breaks_ties_by_name(spark):
    df = spark.range(20).selectExpr("id as b", "-id as a", "id % 3 as c", "id as y")
    assert [r["feature"] for r in features.top_correlated(df, ["b", "a", "c"], "y", 2).collect()] == [
        "a",
        "b",
    ]


def test_scaling_both_ways(spark):
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import vector_to_array

    values = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v, 3.0) for v in values], "x double, same double")
    own = features.apply_scales(df, features.fit_scales(df, ["x", "same"]))
    got = [r["x"] for r in own.orderBy("x").collect()]
    assert got == pytest.approx(list((np.array(values) - np.mean(values)) / np.std(values)))
    assert {r["same"] for r in own.collect()} == {0.0}
    scaler = StandardScaler(inputCol="v", outputCol="s")
    vectors = features.assemble(df.select("x"), ["x"], "v")
    mllib = scaler.fit(vectors).transform(vectors).select(vector_to_array("s")[0])
    plain = features.apply_scales(df, features.fit_scales(df, ["x"], False, False))
    assert sorted(r[0] for r in mllib.collect()) == pytest.approx(
        sorted(r["x"] for r in plain.collect())
    )


def test_index_and_one_hot(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",)], "g string")
    _, indexed = features.index_categories(df, "g", "i")
    hot = features.one_hot(indexed, "i", "hot")
    got = {r["g"]: (r["i"], list(r["hot"])) for r in hot.collect()}
    assert got == {"b": (0.0, [1.0, 0.0]), "a": (1.0, [0.0, 1.0]), "c": (2.0, [0.0, 0.0])}


def test_fold_lines_match_a_fit_per_fold(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 10, 400)
    y = 3 * x + 1e6 + rng.normal(size=400)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, x double, y double")
    folded = splits.with_fold(df, ["id"], 4).cache()
    lines = closed_form.fold_lines(folded, ["x"], "y", "fold", 4)
    rows = folded.collect()
    for left_out in (None, 0, 1, 2, 3):
        kept = [(r["x"], r["y"]) for r in rows if r["fold"] != left_out]
        slope, intercept = np.polyfit(*zip(*kept), 1)
        assert lines[left_out]["x"] == pytest.approx((intercept, slope), rel=1e-9)
    folded.unpersist()


def history(spark, values, run="r"):
    return spark.createDataFrame(
        [(run, i + 1, float(v)) for i, v in enumerate(values)], "run string, epoch long, value double"
    ).repartition(4)


def test_early_stop_patience_and_delta(spark):
    # 0.50005 is no gain above 1e-4; 0.6 comes after the stop
    df = history(spark, [0.1, 0.5, 0.50005, 0.4, 0.45, 0.6])
    row = curves.early_stop(df, "run", "epoch", "value", patience=3, min_delta=1e-4).first()
    assert (row["stop_epoch"], row["best_epoch"], row["best_value"]) == (5, 2, 0.5)
    row = curves.early_stop(df, "run", "epoch", "value", patience=4, min_delta=1e-4).first()
    assert (row["stop_epoch"], row["best_epoch"]) == (6, 6)
    low = curves.early_stop(df, "run", "epoch", "value", 2, maximize=False).first()
    assert (low["stop_epoch"], low["best_epoch"]) == (3, 1)


def keras_like_rates(values, initial, factor=0.5, patience=5, floor=1e-6, delta=1e-4):
    best, wait, lr, out = None, 0, initial, []
    for v in values:
        out.append(lr)
        if best is None or v < best - delta:
            best, wait = v, 0
        else:
            wait += 1
            if wait >= patience and lr > floor:
                lr, wait = max(lr * factor, floor), 0
    return out


def test_lr_plateau(spark):
    rng = np.random.default_rng(4)
    values = list(np.exp(-np.arange(60) / 8) + rng.uniform(0, 0.2, 60))
    got = curves.lr_plateau(history(spark, values), "run", "epoch", "value", initial=1e-4)
    rates = [r["lr"] for r in got.orderBy("epoch").collect()]
    assert rates == pytest.approx(keras_like_rates(values, 1e-4))
    assert min(rates) < 1e-4


def test_best_epoch(spark):
    df = spark.createDataFrame(
        [("r", 1, 0.5, 0.4), ("r", 2, 0.7, 0.6), ("r", 3, 0.9, 0.6), ("r", 4, 0.9, None)]
        + [("none", 1, 0.5, None)],
        "run string, epoch int, t double, v double",
    )
    rows = {r["run"]: r for r in curves.best_epoch(df, "run", "epoch", "t", "v").collect()}
    row = rows["r"]
    assert (row["n_epochs"], row["best_epoch"], row["best_value"]) == (4, 2, 0.6)
    assert row["final_gap"] == pytest.approx(0.3)
    assert tuple(rows["none"])[2:] == (None, None, None)


def by_hand(points, side=160, canvas=224):
    moved = [(x - points[0][0], y - points[0][1]) for x, y in points]
    xs, ys = [p[0] for p in moved], [p[1] for p in moved]
    longest = max(max(xs) - min(xs), max(ys) - min(ys))
    scale = side / longest if longest else 1
    off = [canvas / 2 - (min(v) + max(v)) / 2 * scale for v in (xs, ys)]
    return [(int(x * scale + off[0]), int(y * scale + off[1])) for x, y in moved]


def test_landmarks(spark):
    rng = np.random.default_rng(5)
    frames = [[(float(a), float(b)) for a, b in rng.uniform(0, 1, (21, 2))] for _ in range(30)]
    frames.append([(0.25, 0.75)] * 21)  # degenerate: every point in one place
    df = spark.createDataFrame(
        list(enumerate(frames)), "frame int, points array<struct<x:double,y:double>>"
    )
    rows = landmarks.normalize(df, "frame", "points").collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["point"]):
        got.setdefault(r["frame"], []).append((r["px"], r["py"]))
    assert got == {i: by_hand(points) for i, points in enumerate(frames)}
    assert set(got[30]) == {(112, 112)}


def test_compare_models_picks_the_planted_feature(spark):
    df = spark.range(2000).selectExpr("id", "cast(id % 37 as double) as a", "cast(id % 11 as double) as b")
    df = df.withColumn("y", F.col("a") * 2 + 1)
    df = splits.random_split(splits.with_fold(df, ["id"]), ["id"], {"train": 0.8, "test": 0.2}, "s")
    got = {r["model"]: r for r in closed_form.compare_models(df, ["a", "b"], "y", "split", "fold").collect()}
    assert got["a"]["test_r2"] == pytest.approx(1.0) and got["a"]["cv_r2_std"] == pytest.approx(0, abs=1e-9)
    assert got["b"]["test_r2"] < 0.1
