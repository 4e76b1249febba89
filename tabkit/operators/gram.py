"""Least squares from one pass: counts, means and co-spreads of all columns by group.

The pass gives one row a group (a split, a fold).  Groups add up, so the fit on "all folds
but one" is the total less that fold; any subset of the columns is solved from its part of
the matrix; and the squared error of any line on any group follows from that group's row.
Nothing but these sums is ever needed: comparing feature sets costs no further scan.

A row with a missing value in any of the columns takes no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.sources.readers import from_records


@dataclass(frozen=True)
class Gram:
    """``n`` rows, their means, and the sums of products about the means; the target is last."""

    names: tuple[str, ...]
    n: float
    mean: np.ndarray
    spread: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        n = self.n + other.n
        if not n:
            return self
        off = self.mean - other.mean
        mean = (self.n * self.mean + other.n * other.mean) / n
        return Gram(self.names, n, mean, self.spread + other.spread + np.outer(off, off) * self.n * other.n / n)

    def fit(self, columns: Sequence[str]) -> Line:
        """The least-squares line on some of the columns; of equal ones, that of least weights."""
        at = [self.names.index(c) for c in columns]
        if not self.n:
            raise ValueError("no rows to learn from")
        inner, outer = self.spread[np.ix_(at, at)], self.spread[at, -1]
        scale = np.sqrt(np.where(np.diag(inner) > 0, np.diag(inner), 1.0))
        weights = np.linalg.lstsq(inner / np.outer(scale, scale), outer / scale, rcond=1e-12)[0] / scale
        return Line(tuple(columns), weights, float(self.mean[-1] - weights @ self.mean[at]))

    def squared_error(self, line: Line) -> float:
        """Sum of squared errors of the line on these rows."""
        at = [self.names.index(c) for c in line.columns]
        inner = self.spread[np.ix_(at, at)]
        off = self.mean[-1] - line.intercept - line.weights @ self.mean[at]
        about = self.spread[-1, -1] - 2 * line.weights @ self.spread[at, -1] + line.weights @ inner @ line.weights
        return float(about + self.n * off * off)

    def r2(self, line: Line) -> float | None:
        total = float(self.spread[-1, -1])
        return 1.0 - self.squared_error(line) / total if total > 0 else None

    def correlation(self, column: str) -> float | None:
        i = self.names.index(column)
        both = self.spread[i, i] * self.spread[-1, -1]
        return float(self.spread[i, -1] / np.sqrt(both)) if both > 0 else None


@dataclass(frozen=True)
class Line:
    columns: tuple[str, ...]
    weights: np.ndarray
    intercept: float

    def predict(self) -> Column:
        value = F.lit(self.intercept)
        for c, w in zip(self.columns, self.weights):
            value = value + F.lit(float(w)) * F.col(c)
        return value


def grams(df: DataFrame, columns: Sequence[str], target: str, by: str | None = None) -> dict:
    """``Gram`` by value of ``by`` (a split or a fold: few values); under None without it."""
    names = [*columns, target]
    whole = [F.col(c).cast("double") for c in names]
    known = F.lit(True)
    for c in whole:
        known = known & c.isNotNull() & ~F.isnan(c)
    rows = df.filter(known).select(*([F.col(by)] if by else []), *[c.alias(f"c{i}") for i, c in enumerate(whole)])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    figures = [F.avg(f"c{i}").alias(f"m{i}") for i in range(len(names))]
    figures += [F.covar_pop(f"c{i}", f"c{j}").alias(f"p{i}_{j}") for i, j in pairs]
    found = {}
    for row in rows.groupBy(*([by] if by else [])).agg(F.count("*").alias("n"), *figures).collect():
        n = float(row["n"])
        spread = np.zeros((len(names), len(names)))
        for i, j in pairs:
            spread[i, j] = spread[j, i] = n * (row[f"p{i}_{j}"] or 0.0)
        mean = np.array([row[f"m{i}"] or 0.0 for i in range(len(names))])
        found[row[by] if by else None] = Gram(tuple(names), n, mean, spread)
    return found


def total(parts: Iterable[Gram]) -> Gram:
    parts = list(parts)
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def without(parts: Mapping, left_out) -> Gram:
    """All groups but one."""
    return total(g for k, g in parts.items() if k != left_out)


def dummies(df: DataFrame, column: str) -> tuple[DataFrame, list[str]]:
    """A 0/1 column for each value of a category of few values but the rarest, and their names.

    Values by falling frequency, ties by name; a missing value is none of them.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    values = [r[column] for r in counts.orderBy(F.desc("count"), column).collect()][:-1]
    added = {f"{column}={v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in values}
    return df.withColumns(added), list(added)


def compare_feature_sets(
    df: DataFrame, columns: Sequence[str], target: str, split: str, k: int, always: Sequence[str] = ()
) -> list[tuple]:
    """(feature_set, n_features, features, r2 on the test rows, loss against all in percent).

    All ``columns`` against the ``k`` most correlated with the target on the training rows,
    ties by name; the ``always`` columns are in both sets.
    """
    parts = grams(df, [*columns, *always], target, split)
    train, test = parts["train"], parts["test"]
    ranked = sorted(columns, key=lambda c: (-abs(train.correlation(c) or 0.0), c))
    rows = []
    for name, chosen in (("all", list(columns)), (f"best {k}", ranked[:k])):
        line = train.fit([*chosen, *always])
        rows.append((name, len(chosen) + len(always), chosen, test.r2(line)))
    base = rows[0][3]
    return [(*r, (base - r[3]) / base * 100 if base else None) for r in rows]


def feature_sets_table(
    df: DataFrame, columns: Sequence[str], target: str, split: str, k: int, always: Sequence[str] = ()
) -> DataFrame:
    """``compare_feature_sets`` as a table: feature_set, n_features, features, r2, r2_loss_pct (rounded)."""
    found = compare_feature_sets(df, columns, target, split, k, always)
    rows = [
        (name, n, ",".join(chosen), None if r2 is None else round(r2, 6), None if loss is None else round(loss, 4) + 0.0)
        for name, n, chosen, r2, loss in found
    ]
    return from_records(df.sparkSession, rows, "feature_set string, n_features int, features string, r2 double, r2_loss_pct double")
