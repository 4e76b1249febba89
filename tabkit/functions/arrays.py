"""Per-row work on probability vectors and point lists, on array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _each(value: Column, like: Column) -> Column:
    """``value`` once per element of ``like``.

    A lambda that uses a computed value would compute it again for every
    element; handed over as an array it is computed once per row.
    """
    return F.array_repeat(value, F.size(like))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits).cast("double")
    powers = F.zip_with(
        logits, _each(top, logits), lambda v, most: F.exp(v.cast("double") - most)
    )
    total = F.aggregate(powers, F.lit(0.0), lambda acc, v: acc + v)
    return F.zip_with(powers, _each(total, logits), lambda v, whole: v / whole)


def argmax(values: Column) -> Column:
    """Zero-based place of the largest value; the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def probability_map(classes: Sequence[str], probabilities: Column, digits: int = 4) -> Column:
    names = F.array(*[F.lit(c) for c in classes])
    return F.map_from_arrays(names, F.transform(probabilities, lambda p: F.round(p, digits)))


# Field names of the answer, in order.
PAYLOAD_FIELDS = ("clase", "dedos", "confianza", "probabilidades")


def prediction_payload(
    classes: Sequence[str], probabilities: Column, digits: int = 4
) -> Column:
    """Struct answered per scored record: class, count, confidence, map."""
    best = argmax(probabilities)
    names = F.array(*[F.lit(c) for c in classes])
    parts = (
        F.element_at(names, best + 1),
        best + 1,
        F.round(F.array_max(probabilities), digits),
        probability_map(classes, probabilities, digits),
    )
    return F.struct(*[part.alias(name) for name, part in zip(PAYLOAD_FIELDS, parts)])


def one_hot(index: Column, size: int) -> Column:
    places = F.sequence(F.lit(0), F.lit(size - 1))
    return F.transform(places, lambda i: (i == index).cast("double"))


def smooth_labels(one_hot_label: Column, size: int, epsilon: float = 0.1) -> Column:
    """Move a share ``epsilon`` of the label's mass evenly over all classes."""
    return F.transform(one_hot_label, lambda v: v * (1 - epsilon) + epsilon / size)


def points_from_flat(flat: Column) -> Column:
    """``[x0, y0, x1, y1, ...]`` as an array of points; a last x without its y is left out.

    Fewer than two values make no point.
    """
    pairs = F.floor(F.size(flat) / 2).cast("int")
    places = F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)).when(
        flat.isNotNull(), F.array().cast("array<int>")
    )
    return F.transform(
        places,
        lambda i: F.struct(
            F.get(flat, i * 2).cast("double").alias("x"),
            F.get(flat, i * 2 + 1).cast("double").alias("y"),
        ),
    )
