"""Filters, flags, grouped and pivoted summaries, joins and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.rules import ClassRule, ScoreSpec, classify, score


def with_flag(df: DataFrame, name: str, condition: Column) -> DataFrame:
    return df.withColumn(name, condition)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_score(
    df: DataFrame,
    spec: ScoreSpec,
    classes: Sequence[ClassRule],
    otherwise: str,
    score_name: str = "score",
    class_name: str = "profile",
) -> DataFrame:
    """Rule score and the class read off it; class rules name the score column."""
    return df.withColumn(score_name, score(spec)).withColumn(
        class_name, classify(classes, otherwise)
    )


def grouped_means(
    df: DataFrame, keys: Sequence[str], means: Mapping[str, tuple[str, int]], count: str | None
) -> DataFrame:
    """Rounded means per group: ``{alias: (column, digits)}``, and a row count."""
    counts = [F.count(F.lit(1)).alias(count)] if count else []
    averages = [F.round(F.avg(c), digits).alias(alias) for alias, (c, digits) in means.items()]
    return df.groupBy(*keys).agg(*counts, *averages)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``row`` by the given values of ``column``; empty cells are NULL.

    The value list is explicit, so there is no extra pass to find it and the
    result has the same columns on any data.
    """
    return df.groupBy(row).pivot(column, list(values)).count()


def inner_count(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of an inner equi-join.

    The merge hint keeps a join of two tables bucketed and sorted alike free
    of any exchange.
    """
    return left.join(right.hint("merge"), key).agg(F.count(F.lit(1)).alias("n_rows"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts by column name; a column a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def long_form(df: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per column of a small wide result."""
    return df.unpivot([], list(columns), name, value)


def top_by_size(df: DataFrame, value: Column, tie: str, k: int) -> DataFrame:
    """The ``k`` rows of largest absolute ``value``; ties by name."""
    return df.orderBy(F.abs(value).desc(), F.col(tie)).limit(k)
