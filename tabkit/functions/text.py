"""Blank handling, normalisation and number formatting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


WHITESPACE = " \t\n\r\f\v"


def is_blank(value: Column) -> Column:
    """Present but only white space; NULL is not blank."""
    return F.coalesce(F.trim(value, F.lit(WHITESPACE)) == "", F.lit(False))


def blank_to_null(value: Column) -> Column:
    """Blank becomes NULL; any other text keeps its own spaces."""
    return F.when(~is_blank(value), value)


def normalize(value: Column) -> Column:
    """Trim, single inner spaces, first letter of each word in upper case."""
    return F.initcap(F.trim(F.regexp_replace(value, r"\s+", " ")))


def any_true(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def count_true(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("int") for c in conditions], F.lit(0))


def mean_plus_minus(mean: Column, std: Column, digits: int = 4) -> Column:
    """For example ``0.9970 ± 0.0012``."""
    return F.format_string(f"%.{digits}f ± %.{digits}f", mean, std)


def file_safe(value: Column) -> Column:
    return F.translate(value, " ", "_")


def human_bytes(size: Column) -> Column:
    """Size as B, KB or MB."""
    kib = 1024.0
    return (
        F.when(size < kib, F.format_string("%d B", size.cast("long")))
        .when(size < kib * kib, F.format_string("%.2f KB", size / kib))
        .otherwise(F.format_string("%.2f MB", size / (kib * kib)))
    )
