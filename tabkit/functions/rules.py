"""Declarative scoring rules compiled into one Column.

The rules are data: SQL conditions with points.  Spark sees a single
expression, so scoring is one projection inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``points`` where the SQL ``condition`` is true."""

    condition: str
    points: float


@dataclass(frozen=True)
class ScoreSpec:
    """Base tier (first match wins) plus independent bonuses.

    ``zero_when`` gives 0 without any bonus.  A NULL input fails every
    condition, so it takes ``otherwise`` and no bonus; with ``null_inputs`` set
    and ``null_policy="null"`` a row with a NULL among them scores NULL.
    """

    zero_when: str
    tiers: Sequence[Rule]
    otherwise: float
    bonuses: Sequence[Rule] = ()
    null_inputs: Sequence[str] = field(default_factory=tuple)
    null_policy: str = "keep"


@dataclass(frozen=True)
class ClassRule:
    """``name`` where the SQL ``condition`` is true; the first match wins."""

    condition: str
    name: str


def _first_match(pairs: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(
        lambda rest, pair: F.when(pair[0], pair[1]).otherwise(rest), reversed(pairs), otherwise
    )


def score(spec: ScoreSpec) -> Column:
    base = _first_match(
        [(F.expr(t.condition), F.lit(float(t.points))) for t in spec.tiers],
        F.lit(float(spec.otherwise)),
    )
    for bonus in spec.bonuses:
        base = base + _first_match(
            [(F.expr(bonus.condition), F.lit(float(bonus.points)))], F.lit(0.0)
        )
    total = F.when(F.expr(spec.zero_when), F.lit(0.0)).otherwise(base)
    if spec.null_policy == "null" and spec.null_inputs:
        return F.when(_all_set(spec), total)
    return total


def _all_set(spec: ScoreSpec) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.null_inputs])


def classify(rules: Sequence[ClassRule], otherwise: str) -> Column:
    return _first_match([(F.expr(r.condition), F.lit(r.name)) for r in rules], F.lit(otherwise))
