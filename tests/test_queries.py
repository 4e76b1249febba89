"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402
from tabkit.plans import ORACLES, QUERIES  # noqa: E402
from tools.check_queries import compare, connect  # noqa: E402

@pytest.fixture(scope="module")
def sql(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, folder, name):
    verdict = compare(spark, sql, folder, name)
    assert verdict.startswith("ok" if name in ORACLES else "rows only"), verdict


def test_a_missing_library_costs_only_its_own_queries(monkeypatch):
    """Without a library of the training-data operators the other queries are still there."""
    pytest.importorskip("tabkit.llm")
    for name in [m for m in sys.modules if m.startswith("tabkit.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tabkit.llm.packing", None)
    with pytest.warns(UserWarning, match="left out"):
        left = driver.queries()
    assert set(left) == set(QUERIES)


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    result = driver.entry(spark)
    assert result.columns == ["profile", "total", "mean_score", "mean_quantity", "mean_price"]
    assert result.count() == 4
