"""Exact order statistics of any number of rows.

``percentile`` keeps every distinct value of a column in one task.  Here the
wanted rank is closed in by brackets instead: an approximate quantile proposes
cuts around it, an exact count says on which side the rank lies, and this
repeats until few enough rows are left to be sorted.  Every pass is a scan that
returns one row, whatever the data or its skew, and the answer is exact.  Some
fifteen million rows need three passes, tens of billions five, a trillion seven.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most rows of one bracket that a task may hold to sort them.
BRACKET_ROWS = 10_000
# An approximate rank is off by at most one part in this many.
ACCURACY = 10_000
MARGIN = 2.0 / ACCURACY


@dataclass
class _Bracket:
    """Closed range known to hold the value of ``rank`` (0 is the smallest)."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int

    def done(self, limit: int) -> bool:
        return self.low == self.high or self.inside <= limit

    def holds(self) -> Column:
        return F.col(self.column).between(self.low, self.high)


def _present(df: DataFrame, column: str) -> Column:
    value = F.col(column).cast("double")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


def _around(place: float) -> tuple[float, float]:
    return max(place - MARGIN, 0.0), min(place + MARGIN, 1.0)


def first_look(df: DataFrame, column: str, probabilities: Sequence[float]) -> Column:
    """Aggregate struct (n, low, high, cuts) that ``exact_quantiles`` starts from."""
    value = _present(df, column)
    proposed = [p for probability in probabilities for p in _around(probability)]
    return F.struct(
        F.count(value).alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.percentile_approx(value, proposed, ACCURACY).alias("cuts"),
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    bracket_rows: int = BRACKET_ROWS,
    looks: Mapping[str, Mapping] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column; NULL and NaN are left out.

    ``looks`` hands in a first look per column when an earlier pass took it.
    Its size and ends must be those of ``df``; its cuts are only proposals.
    """
    if not columns:
        return {}
    if looks is None:
        row = df.agg(
            *[first_look(df, c, probabilities).alias(f"c_{i}") for i, c in enumerate(columns)]
        ).first()
        looks = {c: row[f"c_{i}"] for i, c in enumerate(columns)}
    values = df.select(*[_present(df, c).alias(c) for c in columns])

    brackets: dict[tuple[str, int], _Bracket] = {}
    cuts: dict[tuple[str, int], tuple[float, float]] = {}
    wanted: dict[str, list[tuple[int, int, float]]] = {}
    for c in columns:
        seen = looks[c]
        if seen["n"] == 0:
            continue
        wanted[c] = _ranks(seen["n"], probabilities)
        for j, (first, second, _) in enumerate(wanted[c]):
            for rank in (first, second):
                if (c, rank) not in brackets:
                    brackets[c, rank] = _Bracket(c, rank, seen["low"], seen["high"], 0, seen["n"])
                    cuts[c, rank] = tuple(seen["cuts"][2 * j : 2 * j + 2])

    while pending := [b for b in brackets.values() if not b.done(bracket_rows)]:
        if not cuts:
            cuts = _propose(values, pending)
        _narrow_all(values, pending, cuts)
        cuts = {}
    found = _pick(values, list(brackets.values()))
    return {
        c: [
            found[c, first] + (found[c, second] - found[c, first]) * part
            for first, second, part in wanted[c]
        ]
        if c in wanted
        else [None] * len(probabilities)
        for c in columns
    }


def _ranks(n: int, probabilities: Sequence[float]) -> list[tuple[int, int, float]]:
    places = [(n - 1) * p for p in probabilities]
    return [(math.floor(x), math.ceil(x), x - math.floor(x)) for x in places]


def _propose(values: DataFrame, pending: list[_Bracket]) -> dict:
    """Two cuts around each rank, from the rows inside its bracket only."""
    aggregates = []
    for i, b in enumerate(pending):
        inside = F.when(b.holds(), F.col(b.column))
        place = (b.rank - b.below) / max(b.inside - 1, 1)
        around = list(_around(place))
        aggregates.append(F.percentile_approx(inside, around, ACCURACY).alias(f"c_{i}"))
    row = values.agg(*aggregates).first()
    return {(b.column, b.rank): tuple(row[f"c_{i}"]) for i, b in enumerate(pending)}


def _narrow_all(values: DataFrame, pending: list[_Bracket], cuts: dict) -> None:
    aggregates, used = [], []
    for i, b in enumerate(pending):
        low, high = cuts[b.column, b.rank]
        if (low, high) == (b.low, b.high):
            # Nothing cut off: halve the range, which always moves an end.
            low = high = b.low + (b.high - b.low) / 2
        used.append((low, high))
        c = F.col(b.column)
        aggregates += [
            F.count_if(c < low).alias(f"below_{i}"),
            F.count_if(c <= high).alias(f"upto_{i}"),
            F.max(F.when(c < low, c)).alias(f"left_{i}"),
            F.min(F.when(c > high, c)).alias(f"right_{i}"),
        ]
    counted = values.agg(*aggregates).first()
    for i, (b, (low, high)) in enumerate(zip(pending, used)):
        below, upto = counted[f"below_{i}"], counted[f"upto_{i}"]
        if b.rank < below:
            b.high, b.inside = counted[f"left_{i}"], below - b.below
        elif b.rank >= upto:
            b.low, b.inside = counted[f"right_{i}"], b.below + b.inside - upto
            b.below = upto
        else:
            b.low, b.high, b.below, b.inside = low, high, below, upto - below


def _pick(values: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    """The value at each rank; at most ``bracket_rows`` values are held per rank."""
    found = {(b.column, b.rank): b.low for b in brackets if b.low == b.high}
    rest = [b for b in brackets if b.low != b.high]
    if rest:
        row = values.agg(
            *[
                F.get(
                    F.sort_array(F.collect_list(F.when(b.holds(), F.col(b.column)))),
                    F.lit(b.rank - b.below),
                ).alias(f"v_{i}")
                for i, b in enumerate(rest)
            ]
        ).first()
        found.update({(b.column, b.rank): row[f"v_{i}"] for i, b in enumerate(rest)})
    return found
