from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from tabkit import session
from tabkit.functions import folds
from tabkit.functions.hashing import key_hash
from tabkit.operators import families, features, gram, histograms, metrics, models, softmax, splits, training
from tabkit.plans import trees
from tabkit.sources import writers

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def planted(spark):
    """A linear target of three columns, with a little noise and a category."""
    rng = np.random.default_rng(7)
    n = 1500
    x = rng.uniform(0, 10, (n, 3))
    y = x @ [3.0, -2.0, 0.5] + 4 + rng.normal(0, 0.01, n)
    rows = [
        (i, *map(float, x[i]), ["Male", "Female", "Other"][i % 3], float(y[i])) for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, g string, y double")
    df = df.repartition(4).cache()
    df.count()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def parts(planted):
    split = splits.random_split(planted, ["id"], {"train": 0.7, "held_out": 0.1, "test": 0.2})
    data = features.assemble(split, COLUMNS)
    return [data.filter(F.col("split") == name) for name in ("train", "held_out", "test")]


def r2(model, test) -> float:
    return metrics.regression(model.transform(test), "y", "prediction").first()["r2"]


def test_text_of_a_tree(parts):
    tree = models.decision_tree(parts[0], "y")
    assert tree.depth <= models.TREE_DEPTH
    text = models.tree_text(tree, COLUMNS)
    assert "feature" not in text and "a <=" in text


def test_coefficients(planted):
    got = {r["feature"]: r["coefficient"] for r in models.coefficients(planted, COLUMNS, "y", 2).collect()}
    assert got == {
        "a": pytest.approx(3.0, abs=0.01),
        "b": pytest.approx(-2.0, abs=0.01),
        "c": pytest.approx(0.5, abs=0.01),
        "intercept": pytest.approx(4.0, abs=0.05),
    }
    assert list(got)[0] == "a" and list(got)[-1] == "intercept"


def test_feature_sets(planted):
    """R² of both sets from one pass of moments equals a fit of each on the rows."""
    with_g, names = gram.dummies(planted, "g")
    assert names == ["g=Female", "g=Male"]  # as frequent as each other, the last by name left out
    split = splits.random_split(with_g, ["id"], {"train": 0.8, "test": 0.2})
    rows = gram.compare_feature_sets(split, COLUMNS, "y", "split", 2, names)
    assert [(r[0], r[1], r[2]) for r in rows] == [("all", 5, COLUMNS), ("best 2", 4, ["a", "b"])]
    told = split.toPandas()
    train, test = told[told.split == "train"], told[told.split == "test"]
    for _, _, chosen, r2_told, _ in rows:
        x = lambda f: np.column_stack([np.ones(len(f)), f[[*chosen, *names]].to_numpy(float)])
        weights = np.linalg.lstsq(x(train), train.y.to_numpy(), rcond=None)[0]
        error = test.y.to_numpy() - x(test) @ weights
        assert r2_told == pytest.approx(1 - (error**2).sum() / ((test.y - test.y.mean()) ** 2).sum(), abs=1e-9)
    assert rows[0][4] == 0 and rows[1][4] > 0


def test_moments_add_up_and_missing_values_take_no_part(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(50, 3, (400, 2))
    y = x @ [2.0, -1.0] + 7 + rng.normal(0, 1, 400)
    rows = [(i % 4, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    rows += [(0, None, 1.0, 1.0), (1, float("nan"), 1.0, 1.0), (2, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "f int, a double, b double, y double")
    parts = gram.grams(df, ["a", "b"], "y", "f")
    whole, once = gram.total(parts.values()), gram.grams(df, ["a", "b"], "y")[None]
    assert whole.n == once.n == 400 and np.allclose(whole.spread, once.spread) and np.allclose(whole.mean, once.mean)
    line = gram.without(parts, 2).fit(["a", "b"])
    keep = np.arange(400) % 4 != 2
    want = np.linalg.lstsq(np.column_stack([np.ones(keep.sum()), x[keep]]), y[keep], rcond=None)[0]
    assert np.allclose([line.intercept, *line.weights], want)
    error = ((y - line.intercept - x @ line.weights) ** 2)[~keep].sum()
    assert parts[2].squared_error(line) == pytest.approx(error)
    same = gram.grams(df.withColumn("c", F.col("a")), ["a", "c"], "y")[None].fit(["a", "c"])
    assert same.weights[0] == pytest.approx(same.weights[1])


@pytest.fixture(scope="module")
def binned(planted):
    """The planted rows, binned, with flags of the parts."""
    split = splits.random_split(planted, ["id"], {"train": 0.7, "held_out": 0.1, "test": 0.2})
    bins = histograms.fit_bins(split, COLUMNS)
    flags = {f"_{n}": (F.col("split") == n).cast("byte") for n in ("train", "held_out", "test")}
    table = histograms.prepare(split, bins, "y", {"id": F.col("id"), "_k": key_hash(["id"]), **flags}, ["id"], 4).persist()
    yield table, bins, split
    table.unpersist()


def test_trees_in_published_order(binned):
    """Boosting, forest, shallow tree: best first on a linear target."""
    table, bins, split = binned
    test = split.filter("split = 'test'")
    (tree,) = histograms.decision_trees(table, bins, ["_train"], models.TREE_DEPTH, models.TREE_MIN_LEAF, models.TREE_MIN_GAIN)
    assert tree.trees[0].depth() <= models.TREE_DEPTH
    leaves = [w for f, w in zip(tree.trees[0].feature, tree.trees[0].weight) if f < 0]
    assert min(leaves) >= models.TREE_MIN_LEAF and sum(leaves) == tree.trees[0].weight[0]
    (forest,), by_size = histograms.forests(table, bins, "_k", ["_train"], most=30, depth=8)
    assert len(forest.trees) in (10, 20, 30) and len(by_size) <= 3
    (boosted,), losses = histograms.boosted(table, bins, [("_train", "_held_out")], rounds=40)
    assert 2 <= len(boosted.trees) <= 41 and len(losses) >= len(boosted.trees) - 1
    quality = [r2(m, test) for m in (boosted, forest, tree)]
    assert quality[0] > 0.97 and quality[1] > 0.93 and quality[2] > 0.75 and quality[1] > quality[2]
    summary = {k: v for _, k, v in models.tree_summary("f", forest)}
    assert summary["n_trees"] == len(forest.trees)
    assert sum(v for k, v in summary.items() if k.startswith("importance")) == pytest.approx(1.0)
    assert boosted.importances()["a"] > boosted.importances()["c"]


def test_tree_equals_exhaustive_search(spark):
    """Every cut of every column tried by hand, level by level, weights and ties included."""
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 9, 300), rng.integers(0, 5, 300), rng.integers(0, 5, 300)]).astype(float)
    y = np.where(x[:, 0] > 4, 3.0, 0.0) + x[:, 1] + rng.normal(0, 0.1, 300)
    x[:10, 1] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, p double, q double, r double, y double")
    bins = histograms.fit_bins(df, ["p", "q", "r"])
    table = histograms.prepare(df, bins, "y", {"_all": F.lit(1).cast("byte")}, ["id"], 3).persist()
    (model,) = histograms.decision_trees(table, bins, ["_all"], 3, 5, 0.0)
    z = np.where(np.isnan(x), -np.inf, x)

    def search(rows, depth):
        """Predictions of the best tree below these rows."""
        best = None
        for f in range(3):
            for cut in bins.edges[f]:
                left = z[rows, f] <= cut
                if 5 <= left.sum() <= len(rows) - 5:
                    a, b = y[rows][left], y[rows][~left]
                    gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - y[rows].sum() ** 2 / len(rows)
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, rows[left], rows[~left])
        if best is None or not depth:
            return {i: y[rows].mean() for i in rows}
        return search(best[1], depth - 1) | search(best[2], depth - 1)

    want = search(np.arange(300), 3)
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert got == pytest.approx(want)
    table.unpersist()


def test_histograms_are_the_same_direct_and_shuffled(binned, monkeypatch):
    table, bins, _ = binned
    plain = histograms.decision_trees(table, bins, ["_train", "_test"], 4, 5, 0.0)
    monkeypatch.setattr(histograms, "DIRECT_BYTES", 0)
    monkeypatch.setattr(histograms, "NODES_AT_ONCE", 3)
    moved = histograms.decision_trees(table, bins, ["_train", "_test"], 4, 5, 0.0)
    assert [m.trees[0].feature for m in plain] == [m.trees[0].feature for m in moved]
    assert [m.trees[0].cut for m in plain] == [m.trees[0].cut for m in moved]
    alone = histograms.decision_trees(table, bins, ["_test"], 4, 5, 0.0)
    assert alone[0].trees[0].cut == plain[1].trees[0].cut  # slots do not see each other


def test_draws_are_poisson_and_out_of_bag_r2_is_of_rows_not_drawn(binned):
    table, bins, split = binned
    (forest,), ((_, size, told),) = histograms.forests(table, bins, "_k", ["_train"], step=6, most=6, depth=4)
    drawn = [histograms.drawn(F.col("_k"), j).alias(f"c{j}") for j in range(6)]
    rows = table.filter("_train = 1").select("id", "_y", *drawn).toPandas().set_index("id")
    counts = rows[[f"c{j}" for j in range(6)]].to_numpy()
    assert abs(counts.mean() - 1) < 0.05 and abs((counts == 0).mean() - np.exp(-1)) < 0.03
    assert [int(t.weight[0]) for t in forest.trees] == counts.sum(0).tolist()
    total, many = np.zeros(len(rows)), np.zeros(len(rows))
    for j, tree in enumerate(forest.trees):
        one = histograms.Ensemble(bins, [tree], [1.0]).transform(split.filter("split = 'train'"))
        called = one.select("id", "prediction").toPandas().set_index("id")["prediction"].loc[rows.index].to_numpy()
        out = counts[:, j] == 0
        total[out] += called[out]
        many[out] += 1
    y = rows["_y"].to_numpy()[many > 0]
    error = y - total[many > 0] / many[many > 0]
    assert size == 6 and told == pytest.approx(1 - (error**2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-9)


def test_patience_counts_steps_without_gain():
    rule = folds.Patience(3, 0.1)
    values = [1.0, 2.0, 2.05, 2.09, None]
    seen = [rule.goes_on(i, v) for i, v in enumerate(values)]
    assert seen == [True, True, True, True, False] and rule.best_step == 1
    low = folds.Patience(2, 0.0, maximize=False)
    assert [low.goes_on(i, v) for i, v in enumerate([3.0, 2.0, 2.0, 2.5])] == [True, True, True, False] and low.best == 2.0


def test_growth_stops_by_patience_and_restores_the_best(binned):
    table, bins, _ = binned
    (forest,), scores = histograms.forests(table, bins, "_k", ["_train"], step=2, most=400, patience=3, depth=4)
    best, value = 0, float("-inf")
    for _, size, r2_value in scores:
        if r2_value > value + histograms.GAIN:
            best, value = size, r2_value
    assert len(forest.trees) == best and scores[-1][1] == best + 3 * 2


def test_boosting_stops_by_patience_and_restores_the_best(binned, monkeypatch):
    monkeypatch.setattr(histograms, "CUT_EVERY", 4)  # sums are written now and then
    table, bins, split = binned
    coarse = table.withColumn("_y", F.round(F.col("_y") / 20) * 20)
    # two slots side by side: each stops by itself
    pairs = [("_train", "_held_out"), ("_held_out", "_train")]
    fitted, losses = histograms.boosted(coarse, bins, pairs, rounds=200, patience=4)
    for s, part in ((0, "held_out"), (1, "train")):
        mine = [loss for slot, _, loss in losses if slot == s]
        best, value = 0, float("inf")
        for i, loss in enumerate(mine, start=1):
            if loss < value - histograms.GAIN:
                best, value = i, loss
        assert len(fitted[s].trees) == best + 1 and len(mine) == best + 4
        told = split.filter(F.col("split") == part).withColumn("y", F.round(F.col("y") / 20) * 20)
        assert 1 - r2(fitted[s], told) == pytest.approx(mine[best - 1], abs=1e-5)
    all_rounds, none = histograms.boosted(coarse, bins, [("_train", None)], rounds=3, depth=2)
    assert len(all_rounds[0].trees) == 4 and none == []


@pytest.mark.parametrize("kind", ["tree", "forest", "boosted", "linear", "line", "softmax"])
def test_every_kind_of_model_is_stored(spark, parts, binned, kind):
    train, held_out, test = parts
    table, bins, _ = binned
    fitted = {
        "tree": lambda: models.decision_tree(train, "y"),
        "forest": lambda: histograms.forests(table, bins, "_k", ["_train"], step=2, most=4, depth=3)[0][0],
        "boosted": lambda: histograms.boosted(table, bins, [("_train", "_held_out")], rounds=3)[0][0],
        "linear": lambda: LinearRegression(featuresCol="features", labelCol="y").fit(train),
        "line": lambda: families.LinearModel(gram.grams(train, COLUMNS, "y")[None].fit(COLUMNS)),
        "softmax": lambda: softmax.fit(train.withColumn("v", F.array(*COLUMNS)).withColumn("n", F.concat(F.lit("c"), F.col("id") % 3)), "v", "n"),
    }[kind]()
    path = writers.model(fitted, session.work_path(spark, "models"), kind)
    again, out = models.load(path), "probs" if kind == "softmax" else "prediction"
    test = test.withColumn("v", F.array(*COLUMNS))
    before = {r["id"]: r[out] for r in fitted.transform(test).collect()}
    after = {r["id"]: r[out] for r in again.transform(test).collect()}
    assert before == after and len(before) > 200
    if kind == "softmax":
        assert (again.weights == fitted.weights).all()
        assert all(getattr(again, f) == getattr(fitted, f) for f in ("column", "classes", "converged", "steps", "loss", "steepest"))
    if kind in ("forest", "boosted"):
        assert again.importances() == fitted.importances()
        rows = test.select("id", F.lit(None).cast("double").alias("a"), F.lit(float("nan")).alias("b"), "c")
        assert again.transform(rows).filter("prediction IS NULL").count() == 0


def test_families_share_folds_and_passes(planted):
    small = families.Settings(tree_depth=2, forest_step=2, forest_most=4, forest_depth=3, rounds=4, boost_depth=2, watched=0.2)
    scores, fitted = families.compare(planted, COLUMNS, "y", ["id"], 3, small, 4)
    rows = {(r["model"], r["fold"]): r for r in scores.collect()}
    assert set(rows) == {(m, f) for m in families.FAMILIES for f in range(3)}
    folded = splits.with_fold(planted, ["id"], 3)
    for f in range(3):
        rest, out = folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f)
        assert rows["linear", f]["n_rows"] == out.count()
        line = families.LinearModel(gram.grams(rest, COLUMNS, "y")[None].fit(COLUMNS))
        assert rows["linear", f]["r2"] == pytest.approx(r2(line, out), abs=1e-6)
    bins = histograms.fit_bins(planted, COLUMNS)
    rest = folded.filter("fold <> 1").select("*", F.lit(1).cast("byte").alias("_t"))
    table = histograms.prepare(rest, bins, "y", {"_t": F.col("_t")}, ["id"]).persist()
    (alone,) = histograms.decision_trees(table, bins, ["_t"], 2, small.tree_least, small.tree_gain)
    assert rows["tree", 1]["r2"] == pytest.approx(r2(alone, folded.filter("fold = 1")), abs=1e-6)
    assert rows["linear", 0]["r2"] > rows["boosted", 0]["r2"] > 0
    assert r2(fitted["linear"], planted) > 0.99
    table.unpersist()


def test_folds_outside_the_range_are_refused(spark):
    from tabkit.operators import closed_form

    df = spark.range(100).selectExpr("id % 10 AS fold", "CAST(id AS double) x", "CAST(id AS double) y")
    with pytest.raises(ValueError):
        closed_form.fold_lines(df, ["x"], "y", "fold", 5)


def test_cross_validation_and_grid(planted):
    data = features.assemble(planted, COLUMNS).select("id", "features", "y")
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="y", maxDepth=3)
    scores = models.cross_validate(data, tree, ["id"], "y", 3)
    summary = metrics.across_folds(scores, ["r2", "rmse"]).first()
    assert 0.5 < summary["r2_mean"] < 0.95 and summary["r2_std"] >= 0
    best = models.grid_search(data, tree, {tree.maxDepth: [2, 4]}, ["id"], "y", 3)
    assert best.bestModel.getMaxDepth() == 4


def test_stored_model_answers_the_same(spark, planted):
    fitted = models.linear_fit(planted, COLUMNS, "y")
    path = writers.model(fitted, session.work_path(spark, "models"), "reg lineal")
    assert path.endswith("/reg_lineal")
    before = {r["id"]: r["prediction"] for r in fitted.transform(planted).collect()}
    after = {r["id"]: r["prediction"] for r in models.load(path).transform(planted).collect()}
    assert before == after


def clouds(spark, n=400, classes=3, width=4):
    """Clouds of points; class 0 holds three quarters of the rows."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1.2, (classes, width))
    rows = []
    for i in range(n):
        label = 0 if i % 4 else 1 + (i // 4) % (classes - 1)
        rows.append((i, [float(v) for v in centres[label] + rng.normal(0, 0.7, width)], label, i % 5 == 0))
    rows += [(n, None, 0, False), (n + 1, [1.0, None, 2.0, 3.0], 1, True), (n + 2, [1.0, float("nan"), 2.0, 3.0], 2, False), (n + 3, [0.0] * width, None, False)]
    return spark.createDataFrame(rows, "id long, v array<double>, label int, held boolean")


def test_softmax_reaches_the_optimum(spark):
    """The slope, measured by hand from the weights, vanishes; weights of rows and ridge included."""
    df = clouds(spark)
    model = softmax.fit(df, "v", "label", keys=["id"], parts=3)
    assert model.converged and model.steepest <= softmax.TOLERANCE and model.classes == (0, 1, 2)
    rows = [r for r in df.collect() if r["label"] is not None and r["v"] and None not in r["v"] and not np.isnan(r["v"]).any()]
    x = np.column_stack([np.ones(len(rows)), [r["v"] for r in rows]])
    c = np.array([r["label"] for r in rows])
    w = len(rows) / (3 * np.bincount(c)[c])
    p = softmax.probabilities(x @ model.weights.T)
    off = p - np.eye(3)[c]
    slope = (w[:, None] * off).T @ x / len(rows)
    slope[:, 1:] += softmax.RIDGE * model.weights[:, 1:]
    assert np.abs(slope).max() < 1e-8
    assert np.bincount(c, w) == pytest.approx((w[:, None] * p).sum(0))
    scored = {r["id"]: r["probs"] for r in model.transform(df).collect()}
    assert all(scored[r["id"]] == pytest.approx(q.tolist(), abs=1e-9) for r, q in zip(rows, p))
    assert scored[400] is None and scored[401] is None and scored[402] is None and sum(scored[403]) == pytest.approx(1)
    report = {r["label"]: r for r in softmax.report(model.transform(df).filter("probs IS NOT NULL"), "label", "probs", model.classes).collect()}
    assert report["accuracy"]["f1"] > 0.85
    apart = softmax.fit(df.filter("label < 2"), "v", "label", weighted=False, ridge=1e-6)
    assert apart.converged
    with pytest.raises(ValueError):
        softmax.fit(df.limit(0), "v", "label")
    with pytest.raises(ValueError, match="weights"):
        softmax.fit(spark.range(3000).select(F.array(F.lit(1.0)).alias("v"), F.col("id").alias("label")), "v", "label")
    with pytest.raises(ValueError):
        softmax.fit(df.unionByName(df.limit(1).withColumn("v", F.array(F.lit(1.0)))), "v", "label")


def test_sums_are_the_same_direct_and_shuffled(spark, monkeypatch):
    from tabkit.operators import sums

    df = spark.range(1000).withColumn("x", F.col("id") * 1.0).repartition(5).persist()
    figures = lambda b: {0: np.array([b.num_rows]), 3: b.column("x").to_numpy()[:0].sum() + np.array([b.column("x").to_numpy().sum(), 1.0])}
    direct = sums.total(df, ["x"], figures, 3)
    monkeypatch.setattr(sums, "DIRECT_BYTES", 0)
    moved = sums.total(df, ["x"], figures, 3)
    assert {k: v.tolist() for k, v in direct.items()} == {k: v.tolist() for k, v in moved.items()}
    assert direct[0][0] == 1000 and direct[3][0] == 499500
    assert sums.total(df.limit(0), ["x"], figures, 3) == {}


def test_training_takes_the_steps_of_a_plain_loop(spark):
    """Every epoch's figures again, by plain numpy over all rows; the stop and the best weights too."""
    df = clouds(spark, 240)
    run = training.train(df, "v", "label", "held", units=3, rate=0.6, patience=12, plateau=1, keys=["id"], parts=3)
    rows = [r for r in df.collect() if r["label"] is not None and r["v"] and None not in r["v"] and not np.isnan(r["v"]).any()]
    x = np.column_stack([np.ones(len(rows)), [r["v"] for r in rows]])
    c, held = np.array([r["label"] for r in rows]), np.array([r["held"] for r in rows])
    w = np.where(held, 0.0, (~held).sum() / (3 * np.bincount(c[~held]))[c])
    wanted = np.eye(3)[c] * (1 - training.SMOOTHING) + training.SMOOTHING / 3
    net = training.Network("v", (0, 1, 2), training.first_weights("inner", 3, 5, 0.5), training.first_weights("outer", 3, 4, 1 / np.sqrt(3)))
    m, v, rate = [0, 0], [0, 0], 0.6
    plateau, stop = folds.Plateau(0.6, patience=1), folds.Patience(12)
    n = w.sum()
    for epoch, told_rate, loss, slope, held_loss, hits in run.history:
        h, p = net.forward(x)
        losses = -(wanted * np.log(p)).sum(1)
        off = w[:, None] * (p - wanted) / n
        slopes = [((off @ net.outer[:, 1:]) * (1 - h[:, 1:] ** 2)).T @ x, off.T @ h]
        assert loss == pytest.approx(w @ losses / n) and slope == pytest.approx(np.sqrt(sum((s**2).sum() for s in slopes)))
        assert told_rate == pytest.approx(rate)
        moved = []
        for i, (at, s) in enumerate(zip((net.inner, net.outer), slopes)):
            m[i], v[i] = 0.9 * m[i] + 0.1 * s, 0.999 * v[i] + 0.001 * s * s
            moved.append(at - rate * (m[i] / (1 - 0.9**epoch)) / (np.sqrt(v[i] / (1 - 0.999**epoch)) + training.TINY))
        net = training.Network("v", (0, 1, 2), *moved)
        p = net.forward(x)[1]
        losses = -(wanted * np.log(p)).sum(1)
        assert held_loss == pytest.approx(losses[held].mean()) and hits == pytest.approx((p[held].argmax(1) == c[held]).mean())
        rate = plateau.step(epoch, held_loss)
        on = stop.goes_on(epoch, hits)
        if epoch == run.best_epoch:
            assert np.allclose(net.inner, run.network.inner) and np.allclose(net.outer, run.network.outer)
    assert not on and run.stopped and run.best_epoch == stop.best_step
    assert min(r[1] for r in run.history) < 0.6  # the rate was lowered on the way
    scored = {r["id"]: r["probs"] for r in run.network.transform(df).collect()}
    assert scored[240] is None and scored[241] is None and scored[242] is None
    best = run.network.forward(x)[1]
    assert all(scored[r["id"]] == pytest.approx(q.tolist()) for r, q in zip(rows, best))


def test_spread_goes_by_the_number_given(spark):
    df = spark.range(100, numPartitions=1)
    assert session.spread(df, ["id"], 5).rdd.getNumPartitions() == 5
    assert session.spread(df, ["id"], None) is df


def test_only_the_best_model_is_kept(spark, planted):
    from tabkit.sources import readers

    fitted = {
        "one column": models.linear_fit(planted, ["c"], "y"),
        "all columns": models.linear_fit(planted, COLUMNS, "y"),
    }
    scores = [
        (n, metrics.regression(m.transform(planted), "y", "prediction").first()["r2"])
        for n, m in fitted.items()
    ]
    results = readers.from_records(spark, scores, "model string, r2 double")
    folder = session.work_path(spark, "best")
    name, path = models.keep_best(fitted, results, "r2", folder)
    assert name == "all columns" and path == f"{folder}/all_columns"
    assert readers.file_list(spark, folder).filter("path LIKE '%one_column%'").count() == 0


def test_levels_pass_over_cells_not_rows(spark, monkeypatch):
    """Rows of equal bins are added up once; no level goes over the rows again."""
    rows = [(i, float(i % 3), float(i % 2), float(i % 3) * 10 + i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double").repartition(4, "id")
    bins = histograms.fit_bins(df, ["a", "b"])
    flags = {"_learn": (F.col("id") % 5 > 0).cast("byte"), "_held": (F.col("id") % 5 == 0).cast("byte"), "_all": F.lit(1).cast("byte")}
    table = histograms.prepare(df, bins, "y", {"_k": key_hash(["id"]), **flags}, ["id"], 4)
    sizes, level = [], histograms.level

    def noted(table, *rest):
        sizes.append(table.count())
        return level(table, *rest)

    monkeypatch.setattr(histograms, "level", noted)
    histograms.decision_trees(table, bins, ["_all"], 2, 1, 0.0)
    histograms.boosted(table, bins, [("_learn", "_held")], rounds=2, depth=2)
    histograms.forests(table, bins, "_k", ["_all"], step=3, most=3, depth=2)
    assert len(sizes) >= 6 and max(sizes) <= 12


def test_cells_hold_the_moments_of_their_rows(spark, monkeypatch):
    """Also where tasks pass on what they hold, and where the bins and flags need more than eight bytes."""
    monkeypatch.setattr(histograms, "ROWS_AT_ONCE", 64)
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 2, (500, 7)), rng.normal(1e6, 1.0, 500)
    columns = [f"c{i}" for i in range(7)]
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], ["id", *columns, "y"])
    bins = histograms.fit_bins(df, columns)
    flags = {f"_f{k}": (F.col("id") % 4 == k).cast("byte") for k in range(3)}
    table = histograms.prepare(df, bins, "y", flags, ["id"], 3)
    found = histograms.cells(table, bins, list(flags)).toPandas()
    keys = [*[f"_x{i}" for i in range(7)], *flags]
    want = table.filter("_f0 + _f1 + _f2 > 0").toPandas().groupby(keys)["_y"].agg(["count", "sum", lambda v: ((v - v.mean()) ** 2).sum()])
    parts = found.groupby(keys)
    assert len(want) == len(parts) and (parts["_cell_n"].sum() == want["count"]).all()
    assert np.allclose(parts["_cell_t"].sum(), want["sum"], rtol=1e-12)
    whole = found.groupby(keys).apply(lambda g: (g["_cell_q"] + g["_cell_n"] * (g["_cell_t"] / g["_cell_n"] - g["_cell_t"].sum() / g["_cell_n"].sum()) ** 2).sum())
    assert np.allclose(whole, want.iloc[:, 2], atol=1e-6)


def test_draws_in_tasks_are_those_of_the_column(spark):
    rows = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("_k"))
    trees = range(3, 9)
    batch = rows.select("_k", *histograms._digests("_k", trees)).toArrow().combine_chunks().to_batches()[0]
    cuts = np.array([int(c, 16) for c in histograms.draw_cuts()], np.uint32)
    got = histograms._draws(batch, trees, cuts)
    table = spark.createDataFrame([(k,) for k in batch.column("_k").to_pylist()], "_k string").coalesce(1)
    want = table.select(*[histograms.drawn(F.col("_k"), t).alias(f"c{t}") for t in trees], histograms.left_out(F.col("_k"), trees).alias("out")).toPandas()
    assert (want[[f"c{t}" for t in trees]].to_numpy() == got).all() and (want["out"] == (got == 0).any(axis=1)).all()


def test_rows_spread_as_the_session_says(spark):
    """With 0 the number of partitions follows the session, so it can grow with the rows."""
    df = spark.range(1000).coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert session.spread(df, ["id"], 0).select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_bins_in_the_plan_are_those_of_the_code(spark):
    """Also of missing and infinite values, zeros of either sign, and columns of one or no value."""
    inf, nan = float("inf"), float("nan")
    few = [None, nan, -inf, inf, 0.0, -0.0, 1.0, 2.5, 0.5, -3.0]
    rows = [(i, few[i % 10], float(i * 7 % 1000) - 500, 4.0, None, 1.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double")
    for bins in (histograms.fit_bins(df, list("abcd")), histograms.Bins(tuple("ab"), (np.array([-inf, -1.0, 0.0, 1.0, inf]), np.array([0.0])))):
        got = histograms.prepare(df, bins, "y", {"id": F.col("id")}, ["id"], 2).orderBy("id").toPandas()
        for i, c in enumerate(bins.columns):
            values = np.array([nan if r["abcd".index(c) + 1] is None else r["abcd".index(c) + 1] for r in rows], float)
            assert got[f"_x{i}"].tolist() == bins.code(i, values).tolist()


def test_families_pass_no_row_through_python(spark, monkeypatch):
    """Where many rows have equal bins, only cells leave Spark: binning, draws, scores and predictions do not."""
    rows = [(i, float(i % 3), float(i % 2), float(i % 3) * 10 + i % 7) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double").repartition(4, "id")
    sizes, plain = [], type(df).mapInArrow

    def noted(self, *rest, **more):
        sizes.append(self.count())
        return plain(self, *rest, **more)

    monkeypatch.setattr(type(df), "mapInArrow", noted)
    small = families.Settings(tree_depth=1, tree_gain=0.0, forest_step=3, forest_most=3, forest_depth=1, rounds=2, boost_depth=1, watched=0.0)
    scores, _ = families.compare(df, ["a", "b"], "y", ["id"], 3, small, 4)
    assert {(r["model"], r["fold"]) for r in scores.collect()} == {(m, f) for m in families.FAMILIES for f in range(3)}
    assert sizes and max(sizes) <= 6 * 3 * 8 * 4


def test_out_of_bag_r2_of_cells_is_that_of_rows(binned, monkeypatch):
    """Rows that the same trees leave out are scored together; three slots, one of rows without a hash."""
    table, bins, _ = binned
    table = table.withColumn("_k", F.when(F.col("id") % 10 > 0, F.col("_k")))
    slots = ["_train", "_held_out", "_test"]
    found = {}
    for alike in (0, 4):
        monkeypatch.setattr(histograms, "ALIKE", alike)
        found[alike] = histograms.forests(table, bins, "_k", slots, step=3, most=3, depth=3)
    assert [m.trees for m in found[0][0]] == [m.trees for m in found[4][0]] or all(
        a.feature == b.feature and a.cut == b.cut and a.value == pytest.approx(b.value)
        for x, y in zip(found[0][0], found[4][0]) for a, b in zip(x.trees, y.trees)
    )
    assert [r[:2] for r in found[0][1]] == [r[:2] for r in found[4][1]]
    assert [r[2] for r in found[0][1]] == pytest.approx([r[2] for r in found[4][1]], abs=1e-9)


def test_predictions_looked_up_are_those_of_the_rows(spark, monkeypatch):
    rows = [(i, None if i % 11 == 0 else float(i % 5), float(i % 3), float(i % 5 * 3 + i % 3)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    bins = histograms.fit_bins(df, ["a", "b"])
    flags = {f"_t{p}": (F.col("id") % 2 == p).cast("byte") for p in range(2)}
    table = histograms.prepare(df, bins, "y", {"id": F.col("id"), "_part": (F.col("id") % 2).cast("int"), **flags}, ["id"], 3)
    added = histograms.cells(table, bins, list(flags))
    trees = histograms.decision_trees(table, bins, list(flags), 3, 1, 0.0, added)
    deep = histograms.decision_trees(table, bins, list(flags), 1, 1, 0.0)
    models_of = {0: (trees[1], deep[1]), 1: (trees[0], deep[0])}
    want = sorted(histograms.predictions(table, models_of, "_part", ["id"]).collect())
    assert len(want) == 900 and len({tuple(r["_p"]) for r in want}) > 10
    assert sorted(histograms.predictions(table, models_of, "_part", ["id"], added).collect()) == want
    monkeypatch.setattr(histograms, "small_side", lambda df: df)  # too many cells: each row is called
    assert sorted(histograms.predictions(table, models_of, "_part", ["id"], added).collect()) == want


class Seen(Exception):
    """Ends a query once what it asked for is known."""


def test_the_stored_winner_is_of_families_grown_to_their_stop_rules(spark, folder, monkeypatch):
    """No smaller trees, forests or boosting, no fewer folds, and the columns as they are."""

    def asked(df, columns, target, keys, k=5, settings=families.Settings(), parts=None):
        assert (columns, k, settings, df.count()) == (trees.COLUMNS, 5, families.Settings(), spark.read.parquet(f"{folder}/lineitem.parquet").count())
        assert df.filter(F.col("l_extendedprice") % 5000 != 0).count()
        raise Seen

    monkeypatch.setattr(families, "compare", asked)
    with pytest.raises(Seen):
        trees.best_model_stored(spark, folder)


def _linear_sql() -> str:
    """``lw``: least-squares weights on three columns for each group ``g`` of ``x``."""
    pairs = [("a", "f0"), ("b", "f1"), ("c", "f2"), ("y", "y")]
    spreads = ", ".join(f"covar_pop({p}, {q}) AS {m}{n}" for i, (m, p) in enumerate(pairs) for n, q in pairs[i:])
    return f"""ls AS (SELECT g, {spreads}, avg(f0) ma, avg(f1) mb, avg(f2) mc, avg(y) my FROM x WHERE learn GROUP BY g),
ld AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM ls),
lw AS (SELECT *, (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det AS wa,
  (aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det AS wb,
  (aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det AS wc FROM ld)""".replace(" AS by,", " AS by_,")


def _families_sql() -> str:
    """Scores of the four families on each fold left out, in SQL."""
    return f"""{trees.ROWS_SQL},
x AS (SELECT k.g, r.*, r.fold <> k.g AS learn FROM rows_ r, (SELECT unnest(range(5)) AS g) k),
{_linear_sql()},
pl AS (SELECT x.g, 'linear' AS model, x.y, my + wa * (f0 - ma) + wb * (f1 - mb) + wc * (f2 - mc) AS p FROM x JOIN lw ON lw.g = x.g WHERE NOT learn),
tr AS (SELECT g, 1 AS w, y AS r, f0, f1, f2 FROM x WHERE learn),
{trees._stump_sql("tt", "tr")},
pt AS (SELECT x.g, 'tree' AS model, x.y, {trees._call_sql("tt_b", "x")} AS p FROM x JOIN tt_b ON tt_b.g = x.g WHERE NOT learn),
fr AS ({" UNION ALL ".join(f"SELECT g * {trees.BAG} + {j} AS g, {trees._draws_sql(j)} AS w, y AS r, f0, f1, f2 FROM x WHERE learn" for j in range(trees.BAG))}),
{trees._stump_sql("ff", "fr")},
pf AS (SELECT x.g, 'forest' AS model, any_value(x.y) AS y, avg({trees._call_sql("ff_b", "x")}) AS p FROM x JOIN ff_b ON ff_b.g // {trees.BAG} = x.g
  WHERE NOT learn GROUP BY x.g, x.i),
{trees._boost_sql("x", "g", "learn")},
pb AS (SELECT g, 'boosted' AS model, y, s AS p FROM s{trees.ROUNDS} WHERE NOT learn),
scored AS (SELECT model, g, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2, sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae
  FROM (SELECT * FROM pl UNION ALL SELECT * FROM pt UNION ALL SELECT * FROM pf UNION ALL SELECT * FROM pb) GROUP BY model, g),
told AS (SELECT model, avg(r2) AS r2_mean, stddev_pop(r2) AS r2_std, avg(rmse) AS rmse_mean, avg(mae) AS mae_mean FROM scored GROUP BY model)"""


def test_families_at_their_smallest_equal_sql(spark):
    """Single cuts, three trees and three rounds on columns of few values, where SQL can try every cut."""
    import duckdb
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n = 600
    rows = {
        "l_orderkey": np.arange(n) // 3, "l_linenumber": np.arange(n) % 3 + 1, "l_extendedprice": rng.integers(900, 60_000, n) * 1.0,
        "l_discount": rng.integers(0, 11, n) / 100, "l_tax": rng.integers(0, 9, n) / 100,
    }
    con = duckdb.connect()
    con.register("lineitem", pa.table(rows))
    want = {r[0]: r[1:] for r in con.execute(f"WITH {_families_sql()} SELECT model, r2_mean, r2_std, rmse_mean, mae_mean FROM told").fetchall()}
    df = spark.createDataFrame(list(zip(*[c.tolist() for c in rows.values()])), "l_orderkey long, l_linenumber long, l_extendedprice double, l_discount double, l_tax double")
    df = df.selectExpr("*", "double(floor(l_extendedprice / 5000)) AS price_band", f"{trees.CHARGE_SQL} AS charge")
    small = families.Settings(
        tree_depth=1, tree_least=10, tree_gain=0.0, forest_step=trees.BAG, forest_most=trees.BAG, forest_depth=1,
        rounds=trees.ROUNDS, boost_depth=1, watched=0.0,
    )
    scores, _ = families.compare(df, trees.FEW, "charge", trees.LINE_KEY, 5, small, 4)
    got = metrics.across_folds(scores, ["r2", "rmse", "mae"], ["model"]).collect()
    assert {r["model"] for r in got} == set(want) == set(families.FAMILIES)
    for r in got:
        assert [r[c] for c in ("r2_mean", "r2_std", "rmse_mean", "mae_mean")] == pytest.approx(want[r["model"]], rel=1e-6)
