"""Hand-landmark style normalisation of point lists, without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Longest side of the scaled hand and side of the square canvas.
BOX_SIDE = 160
CANVAS = 224


def normalize(
    df: DataFrame, frame: str, points: str, side: int = BOX_SIDE, canvas: int = CANVAS
) -> DataFrame:
    """Pixel of every point: (frame, point, px, py).

    The first point moves to the origin, the longest side of the bounding box
    is fitted to ``side`` (a box without extent keeps its size), the box is
    centred and positions are truncated towards zero.

    All points of a frame are in one row, so its box needs no shuffle.  Box,
    scale and offsets are computed once per frame, before the points become
    rows; after that each point is plain arithmetic.

    The offset is complete before it is added to a scaled point: box edges land
    exactly on whole pixels, where another grouping of the same sum would
    truncate to a different one.
    """
    xs, ys = F.col(f"{points}.x"), F.col(f"{points}.y")
    boxed = df.select(
        frame,
        points,
        F.get(xs, F.lit(0)).alias("ox"),
        F.get(ys, F.lit(0)).alias("oy"),
        F.array_min(xs).alias("x0"),
        F.array_max(xs).alias("x1"),
        F.array_min(ys).alias("y0"),
        F.array_max(ys).alias("y1"),
    ).withColumns({c: F.col(c) - F.col(f"o{c[0]}") for c in ("x0", "x1", "y0", "y1")})
    longest = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    sized = boxed.withColumn(
        "scale", F.when(longest == 0, F.lit(1.0)).otherwise(F.try_divide(F.lit(float(side)), longest))
    )
    placed = sized.withColumns(
        {
            f"d{c}": F.lit(canvas / 2.0) - (F.col(f"{c}0") + F.col(f"{c}1")) / 2 * F.col("scale")
            for c in ("x", "y")
        }
    )
    rows = placed.select(
        frame, "ox", "oy", "scale", "dx", "dy", F.posexplode(points).alias("point", "p")
    )
    return rows.select(
        frame,
        "point",
        ((F.col("p.x") - F.col("ox")) * F.col("scale") + F.col("dx")).cast("int").alias("px"),
        ((F.col("p.y") - F.col("oy")) * F.col("scale") + F.col("dy")).cast("int").alias("py"),
    )
