from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from tabkit.functions import arrays, bins, numeric, text
from tabkit.functions.hashing import fold_of, hex_cut, key_hash
from tabkit.functions.rules import Rule, ScoreSpec, classify, score
from tabkit.functions.student_rules import (
    GAMING_CLASSES,
    GAMING_ORDER,
    GAMING_OTHERWISE,
    GAMING_SCORE,
)
from tabkit.operators import relational as rel

STUDENT = (
    "gaming_hours double, youtube_hours double, social_media_hours double, sleep_hours double, "
    "phone_usage_hours double, stress_level int, age int, gender string"
)


def student(gaming, youtube=0.0, social=0.0, sleep=9.0, phone=0.0, stress=1, age=30, gender="Male"):
    return (gaming, youtube, social, sleep, phone, stress, age, gender)


def scored(spark, rows):
    df = spark.createDataFrame(rows, STUDENT)
    return rel.with_score(
        df, GAMING_SCORE, GAMING_CLASSES, GAMING_OTHERWISE, "score_gamer", "perfil_gamer"
    )


def test_student_score_edges(spark):
    rows = [
        student(0.0, youtube=9.0, social=9.0),  # no play: no bonus either
        student(2.0),
        student(2.5),
        student(None),  # NULL fails every condition: last tier
        student(1.0, youtube=4.0),
        student(1.0, youtube=4.0, social=6.0, sleep=4.0, phone=9.0),
        student(2.0, age=None, gender=None, stress=None),
    ]
    got = [(r["score_gamer"], r["perfil_gamer"]) for r in scored(spark, rows).collect()]
    assert got == [
        (0.0, "No Juega"),
        (1.0, "Novato"),
        (2.0, "Gamer"),
        (3.0, "Experto Gamer"),
        (1.5, "Gamer"),
        (pytest.approx(2.6), "Experto Gamer"),
        (1.0, "Novato"),
    ]


def test_student_score_all_combinations(spark):
    """Classes by doubles equal classes by exact tenths."""
    on = [(4.0, 0.0), (6.0, 0.0), (4.0, 9.0), (9.0, 0.0), (8, 1), (20, 30), ("Other", "Male")]
    points = [5, 3, 5, 3, 2, 3, 1]
    rows, expected = [], []
    for gaming, base in ((1.0, 10), (3.0, 20), (5.0, 30)):
        for flags in product((0, 1), repeat=7):
            rows.append((gaming, *[pair[1 - f] for pair, f in zip(on, flags)]))
            total = base + sum(p for p, f in zip(points, flags) if f)
            expected.append(
                "Experto Gamer" if total >= 25 else "Gamer" if total >= 15 else "Novato"
            )
    got = [r["perfil_gamer"] for r in scored(spark, rows).collect()]
    assert got == expected


def test_null_policy(spark):
    spec = ScoreSpec("a = 0", (Rule("a <= 1", 1.0),), 3.0, null_inputs=("a",), null_policy="null")
    df = spark.createDataFrame([(None,), (0,), (1,), (5,)], "a int")
    assert [r[0] for r in df.select(score(spec)).collect()] == [None, 0.0, 1.0, 3.0]


def test_crosstab_hole_is_null(spark):
    df = spark.createDataFrame([("M", "Novato"), ("F", "Gamer"), ("F", "Gamer")], "g string, p string")
    rows = {r["g"]: r for r in rel.crosstab(df, "g", "p", GAMING_ORDER).collect()}
    assert rows["F"]["Gamer"] == 2 and rows["F"]["Novato"] is None
    assert rows["M"].asDict().keys() == {"g", *GAMING_ORDER}


def test_first_class_wins(spark):
    from tabkit.functions.rules import ClassRule

    rules = (ClassRule("a > 1", "first"), ClassRule("a > 0", "second"))
    df = spark.createDataFrame([(2,), (1,), (0,), (None,)], "a int")
    assert [r[0] for r in df.select(classify(rules, "rest")).collect()] == [
        "first",
        "second",
        "rest",
        "rest",
    ]


def test_ratio_and_changes(spark):
    df = spark.createDataFrame([(6, 3), (6, 0), (6, None), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(numeric.ratio(F.col("a"), F.col("b"))).collect()] == [
        2.0,
        None,
        None,
        None,
    ]
    one = spark.range(1)
    saving = numeric.saving_pct(F.lit(200), F.lit(50)), numeric.saving_pct(F.lit(50), F.lit(200))
    assert tuple(one.select(*saving).first()) == (75.0, 0.0)


def test_blanks(spark):
    df = spark.createDataFrame([("",), ("   ",), ("\t\n",), (" a ",), (None,)], "v string")
    got = df.select(text.is_blank(F.col("v")), text.blank_to_null(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [
        (True, None),
        (True, None),
        (True, None),
        (False, " a "),
        (False, None),
    ]


def test_formats(spark):
    row = (
        spark.range(1)
        .select(
            text.mean_plus_minus(F.lit(0.997), F.lit(0.0012)),
            text.human_bytes(F.lit(512)),
            text.human_bytes(F.lit(2048)),
            text.human_bytes(F.lit(3 * 1024 * 1024)),
            text.normalize(F.lit("  fEMALE   student ")),
            text.file_safe(F.lit("Gradient Boosting model")),
        )
        .first()
    )
    assert list(row) == [
        "0.9970 ± 0.0012",
        "512 B",
        "2.00 KB",
        "3.00 MB",
        "Female Student",
        "Gradient_Boosting_model",
    ]


def test_argmax_takes_first_of_ties(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.5, 0.5, 0.0],)], "p array<double>")
    assert [r[0] for r in df.select(arrays.argmax(F.col("p"))).collect()] == [1, 0]


def test_payload(spark):
    df = spark.createDataFrame([([0.91666, 0.05, 0.03334],)], "p array<double>")
    payload = arrays.prediction_payload(["1", "2", "3"], F.col("p"))
    got = df.select(F.to_json(payload)).first()[0]
    assert got == (
        '{"clase":"1","dedos":1,"confianza":0.9167,'
        '"probabilidades":{"1":0.9167,"2":0.05,"3":0.0333}}'
    )


def test_softmax_and_smoothing(spark):
    import numpy as np

    values = [0.5, -1.0, 3.0]
    row = (
        spark.createDataFrame([(values, 2)], "v array<float>, y int")
        .select(
            arrays.softmax(F.col("v")).alias("p"),
            arrays.smooth_labels(arrays.one_hot(F.col("y"), 5), 5, 0.1).alias("s"),
        )
        .first()
    )
    assert row["p"] == pytest.approx(list(np.exp(values) / np.exp(values).sum()))
    assert row["s"] == pytest.approx([0.02, 0.02, 0.92, 0.02, 0.02])


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (2.02,), (None,)], "v double")
    edges = bins.widen([0.0, 1.0, 2.0])
    got = [r[0] for r in df.select(bins.cut(F.col("v"), edges, ["low", "high"])).collect()]
    assert got == ["low", "low", "high", "high", None, None]


def test_hash_cut_shares(spark):
    assert (hex_cut(0.7), hex_cut(0.8), hex_cut(1)) == ("b3333333", "cccccccd", "g")
    df = spark.range(20000).withColumn("h", key_hash(["id"]))
    share = df.agg(F.avg((F.col("h") < hex_cut(0.7)).cast("double"))).first()[0]
    assert abs(share - 0.7) < 0.02
    folds = df.groupBy(fold_of(F.col("h"), 5)).count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4]
    assert all(abs(r["count"] - 4000) < 300 for r in folds)


def test_key_hash_tells_text_keys_apart(spark):
    rows = [("a-b", "c"), ("a", "b-c"), ("null", "x"), (None, "x"), ("\\N", "x"), ("1", "2-3"), ("1-2", "3"), ("-1", "2")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(key_hash(["x", "y"])).distinct().count() == len(rows)
    assert df.select(key_hash(["x"])).distinct().count() == 8


def test_points_from_short_vectors(spark):
    df = spark.createDataFrame([([],), ([1.0],), ([1.0, 2.0, 3.0],), (None,)], "v array<double>")
    got = [r[0] for r in df.select(arrays.points_from_flat(F.col("v"))).collect()]
    assert [None if p is None else [tuple(x) for x in p] for p in got] == [[], [], [(1.0, 2.0)], None]


def test_key_hash_keeps_null_parts_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(key_hash(["x", "y"])).distinct().count() == 2
