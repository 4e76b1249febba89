"""Labelled right-closed bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``labels[i]`` for ``edges[i] < value <= edges[i + 1]``, else NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    label = F.lit(None).cast("string")
    for low, high, name in zip(edges[:-1], edges[1:], labels):
        inside = (value > F.lit(float(low))) & (value <= F.lit(float(high)))
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label


def widen(edges: Sequence[float], margin: float = 0.01) -> list[float]:
    """Outer edges moved out so that the extreme values fall inside."""
    inner = list(edges[1:-1])
    return [edges[0] - margin, *inner, edges[-1] + margin]
