from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabkit.operators import cleaning, corruption, quality
from tabkit.schemas import STUDENT, numeric_columns, text_columns

SCHEMA = "id long, x double, n int, g string"
ROWS = [
    (1, 1.0, 10, "Female"),
    (1, 1.0, 10, "Female"),
    (2, None, 20, "  "),
    (2, None, 20, "  "),
    (2, None, 20, "  "),
    (3, 3.0, None, "male  student"),
    (4, 100.0, 40, ""),
    (5, 2.0, 30, None),
    (6, 2.5, 25, "Female"),
    (7, 1.5, 20, "Male"),
    (8, 2.2, 35, "Male"),
]


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


def test_student_schema():
    assert len(STUDENT) == 18
    assert len(numeric_columns(STUDENT)) == 17 and text_columns(STUDENT) == ["gender"]


def test_profile(dirty):
    rows = {r["column_name"]: r for r in quality.null_profile(dirty).collect()}
    assert {c: r["n_nulls"] for c, r in rows.items()} == {"id": 0, "x": 3, "n": 1, "g": 1}
    assert rows["x"]["pct_nulls"] == 27.27
    assert (rows["g"]["kind"], rows["n"]["kind"]) == ("text", "numeric")


def test_affected_and_duplicates(dirty):
    got = quality.affected_rows(dirty).first().asDict()
    assert got == {
        "n_rows": 11,
        "n_null_rows": 5,
        "n_blank_rows": 4,
        "n_affected": 6,
        "pct_affected": 54.55,
    }
    assert tuple(quality.duplicate_count(dirty).first()) == (11, 8, 3)
    one = quality.diagnosis(dirty).first()
    assert (one["n_nulls"], one["n_blanks"], one["n_duplicates"], one["n_affected"]) == (5, 4, 3, 6)
    assert one["pct_corrupt"] == pytest.approx(81.82)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tuple(quality.duplicate_count(empty).first()) == (0, 0, 0)
    assert quality.affected_rows(empty).first()["pct_affected"] is None


def test_clean(dirty):
    spec = cleaning.CleanSpec(exclude=("id",))
    cleaned, report = cleaning.clean(dirty, spec)
    rows = {r["id"]: r for r in cleaned.collect()}
    assert len(rows) == 8
    # x is skewed: median of 1, 3, 100, 2, 2.5, 1.5, 2.2
    assert rows[2]["x"] == 2.2
    # n is not: mean of 10, 20, 40, 30, 25, 20, 35, as double
    assert rows[3]["n"] == pytest.approx(180 / 7)
    assert rows[2]["g"] == rows[4]["g"] == rows[5]["g"] == "Female"
    assert rows[3]["g"] == "Male Student"
    assert [i for i, r in rows.items() if r["x_outlier"]] == [4]
    facts = {(r["section"], r["item"]): r["value"] for r in report.collect()}
    assert facts["size", "rows_before"] == 11 and facts["size", "rows_after"] == 8
    assert facts["size", "pct_kept"] == 72.73
    assert facts["blank_to_null", "g"] == 2
    assert facts["imputed", "total"] == 1 + 1 + 3 == sum(
        v for (section, item), v in facts.items() if section == "imputed" and item != "total"
    )
    assert facts["outliers", "x"] == 1
    assert facts["dates", "g"] == 0


def test_clean_gives_back_what_dirtying_took(spark):
    base = spark.range(4000).selectExpr(
        "id", "cast(id % 97 as double) as x", "concat('k', id % 3) as g"
    )
    damaged = corruption.append_copies(
        corruption.inject_blanks(
            corruption.inject_nulls(base, ["id"], {"x": ("a", "08")}), ["id"], "g", "b", ["02", "04"]
        ),
        ["id"],
        "c",
        ["10", "02"],
    )
    extra = damaged.count() - 4000
    assert extra > 100
    cleaned, report = cleaning.clean(damaged, cleaning.CleanSpec(exclude=("id",)))
    assert cleaned.count() == 4000
    assert cleaned.filter("x IS NULL OR g IS NULL OR trim(g) = ''").count() == 0
    facts = {(r["section"], r["item"]): r["value"] for r in report.collect()}
    assert facts["size", "rows_removed"] == extra


def test_exact_nulls(spark):
    df = spark.range(1000).selectExpr("id", "id as a", "id as b").repartition(7)
    damaged = corruption.inject_nulls_exact(df, ["id"], {"a": ("p", 190), "b": ("q", 0)})
    row = damaged.agg(F.count_if(F.col("a").isNull()), F.count_if(F.col("b").isNull())).first()
    assert tuple(row) == (190, 0)
    whole = corruption.inject_nulls_exact(df, ["id"], {"a": ("p", 5000)})
    assert whole.filter("a IS NULL").count() == 1000


def test_mode_ties_and_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None)], "g string, h string")
    assert cleaning.fit_modes(df, ["g", "h"]) == {"g": "a", "h": None}


def test_date_columns(spark):
    rows = [("2024-01-01", "2024", "x", None)] * 19 + [("no date", "2025", "y", None)]
    df = spark.createDataFrame(rows, "d string, year string, t string, nothing string")
    found = {r["column_name"]: r["is_date"] for r in quality.date_columns(df).collect()}
    assert found == {"d": True, "year": False, "t": False, "nothing": False}


def test_outlier_flags_keep_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in range(20)] + [(500.0,), (None,)], "v double")
    flagged = quality.flag_outliers(df, ["v"])
    assert flagged.count() == 22
    assert [r["v"] for r in flagged.filter("v_outlier").collect()] == [500.0]


def test_skewness_is_bias_adjusted(spark):
    import pandas as pd

    values = [1.0, 2.0, 2.0, 3.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(cleaning.sample_skewness("v")).first()[0] == pytest.approx(pd.Series(values).skew())
    assert df.limit(2).agg(cleaning.sample_skewness("v")).first()[0] is None


@pytest.mark.parametrize("n", [0, 1, 37, 500])
def test_exact_copies(spark, n):
    df = spark.range(200).selectExpr("id", "id * 2 as v").repartition(6)
    repeated = corruption.append_copies_exact(df, ["id"], n, "x")
    assert repeated.count() == 200 + n
    assert repeated.distinct().count() == 200
    again = corruption.append_copies_exact(df.repartition(3), ["id"], n, "x")
    assert sorted(repeated.collect()) == sorted(again.collect())


def test_every_spelling_of_missing(spark):
    """NULL, NaN, empty and blank text in one table: counted, filled, never flagged."""
    nan = float("nan")
    rows = [(i, float(i % 10), f"w{i % 3}") for i in range(100)]
    rows += [(100 + i, nan, "w0") for i in range(10)] + [(200, None, "w0"), (201, 5.0, ""), (202, 5.0, "   "), (203, 5.0, None)]
    df = spark.createDataFrame(rows, "id long, x double, word string")
    profile = {r["column_name"]: r["n_nulls"] for r in quality.null_profile(df).collect()}
    assert profile == {"id": 0, "x": 11, "word": 1}
    affected = quality.affected_rows(df).first()
    assert (affected["n_null_rows"], affected["n_blank_rows"], affected["n_affected"]) == (12, 2, 14)
    assert quality.diagnosis(df).first()["n_nulls"] == 12
    assert quality.iqr_outliers(df, ["x"]).first()["n_outliers"] == 0
    cleaned, report = cleaning.clean(df, cleaning.CleanSpec(exclude=("id",)))
    assert cleaned.filter("x IS NULL OR isnan(x) OR word IS NULL OR trim(word) = ''").count() == 0
    assert cleaned.filter("x_outlier").count() == 0
    lines = {(r["section"], r["item"]): r["value"] for r in report.collect()}
    assert lines["imputed", "x"] == 11 and lines["imputed", "word"] == 3 and lines["outliers", "x"] == 0
