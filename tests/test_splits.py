from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabkit.operators import splits

WEIGHTS = {"train": 0.7, "val": 0.15, "test": 0.15}


def labelled(spark, n=3000):
    """A third of all rows in one class; one class of a single row; NULL labels."""
    label = (
        F.when(F.col("id") == 7, "single")
        .when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("c"), F.col("id") % 5))
    )
    return spark.range(n).select("id", label.alias("label"))


def assigned(df):
    return {r["id"]: r["split"] for r in df.collect()}


@pytest.mark.parametrize("exact", [True, False])
def test_split_does_not_depend_on_layout(spark, exact):
    df = labelled(spark, 1000)
    seen = [
        assigned(splits.stratified_split(df.repartition(n), "label", ["id"], WEIGHTS, exact=exact))
        for n in (1, 2, 5, 8)
    ]
    assert seen[0] == seen[1] == seen[2] == seen[3]
    assert len(seen[0]) == 1000 and set(seen[0].values()) == set(WEIGHTS)


@pytest.mark.parametrize("digits", [2, 3, None])
def test_rows_at_places_of_the_hash_order(spark, digits):
    import hashlib

    order = sorted(range(500), key=lambda i: hashlib.md5(f"s{i}".encode()).hexdigest())
    asked = [0, 1, 7, 250, 251, 498, 499]
    places = spark.createDataFrame([(p, f"at {p}") for p in asked], "place long, name string")
    rows = splits.rows_at(spark.range(500).repartition(5), ["id"], places, 500, "s", digits).collect()
    assert {(r["id"], r["place"], r["name"]) for r in rows} == {(order[p], p, f"at {p}") for p in asked}


def test_slices_follow_the_number_of_rows_and_places():
    assert splits.slice_digits(100, 1) == 2 and splits.slice_digits(10**6, 5000) == 5
    assert 16 ** splits.slice_digits(10**12, 1000) * splits.ROWS_PER_SLICE >= 10**12
    assert splits.slice_digits(10**13, 10**13) <= 12
