"""Ratios, relative changes and predicates that never raise on zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double; NULL where ``bottom`` is zero or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def relative_change_pct(before: Column, after: Column) -> Column:
    """How much smaller ``after`` is than ``before``, in percent of ``before``."""
    return ratio(before - after, before) * 100


def saving_pct(before: Column, after: Column) -> Column:
    """As ``relative_change_pct``, but growth counts as a saving of zero."""
    return F.when(after < before, relative_change_pct(before, after)).otherwise(F.lit(0.0))


def is_multiple(value: Column, of: int) -> Column:
    return value % of == 0


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(ratio(part, whole) * 100, digits)
