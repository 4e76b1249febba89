from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabkit.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.25, 1 / 3, 0.5, 0.9, 1.0]


def check(spark, values, bracket_rows):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    got = exact_quantiles(df, ["v"], PROBABILITIES, bracket_rows)["v"]
    clean = [v for v in values if v is not None and not np.isnan(v)]
    assert got == pytest.approx(list(np.quantile(clean, PROBABILITIES)))


@pytest.mark.parametrize("bracket_rows", [1, 10, 10_000])
def test_distinct_values(spark, bracket_rows):
    rng = np.random.default_rng(1)
    check(spark, [float(v) for v in rng.normal(size=3000)], bracket_rows)


@pytest.mark.parametrize("bracket_rows", [1, 7])
def test_hot_value(spark, bracket_rows):
    """A third of all rows share one value, another third a second one."""
    rng = np.random.default_rng(2)
    values = [5.0] * 1000 + [5.000001] * 1000 + [float(v) for v in rng.uniform(0, 10, 1000)]
    check(spark, values, bracket_rows)


def test_missing_and_empty(spark):
    check(spark, [None, float("nan"), 3.0, 1.0, None, 2.0], 1)
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    assert exact_quantiles(empty, ["v"], [0.5]) == {"v": [None]}


def test_several_columns_and_integers(spark):
    df = spark.range(1, 1002).selectExpr("id", "cast(id * id as int) as square")
    got = exact_quantiles(df, ["id", "square"], [0.5], bracket_rows=3)
    assert got == {"id": [501.0], "square": [501.0**2]}


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.sampled_from([-2.5, 0.0, 1.0, 1.5, 7.0, 1e9]), min_size=1, max_size=60))
def test_heavy_ties(spark, values):
    check(spark, values, 2)
