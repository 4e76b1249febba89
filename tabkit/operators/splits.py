"""Splits and folds that do not depend on how the data is laid out.

Every draw is a hash of the row's key, so a split survives repartitioning and
task retries and can be checked in any SQL engine.  Rows with equal keys always
fall on the same side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.hashing import fold_of, hex_cut, key_hash
from tabkit.session import materialize, small_side

# Hash prefix that cuts a stratum into 16**4 slices.  Only slices that hold a
# boundary are looked at row by row: about 1/65,000 of the stratum each.
SLICE_DIGITS = 4


def _cumulative(weights: Mapping[str, float]) -> list[tuple[str, Decimal]]:
    total = sum(Decimal(str(w)) for w in weights.values())
    reached, steps = Decimal(0), []
    for name, weight in weights.items():
        reached += Decimal(str(weight))
        steps.append((name, reached / total))
    return steps


def _by_cut(hash_text: Column, cuts: Sequence[tuple[str, Column]], last: str) -> Column:
    label = F.lit(last)
    for name, inside in reversed(cuts):
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label


def random_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Mapping[str, float],
    salt: str = "",
    column: str = "split",
) -> DataFrame:
    """Each row drawn on its own (Bernoulli).  A projection: no shuffle."""
    *steps, (last, _) = _cumulative(weights)
    h = key_hash(keys, salt)
    cuts = [(name, h < hex_cut(share)) for name, share in steps]
    return df.withColumn(column, _by_cut(h, cuts, last))


def with_fold(
    df: DataFrame, keys: Sequence[str], k: int = 5, salt: str = "", column: str = "fold"
) -> DataFrame:
    """Shuffled fold 0..k-1 of each row.  A projection: no shuffle of data."""
    return df.withColumn(column, fold_of(key_hash(keys, salt), k))


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    weights: Mapping[str, float],
    salt: str = "",
    exact: bool = True,
    column: str = "split",
) -> DataFrame:
    """Split inside each class.

    With ``exact`` a class of n rows gives exactly floor(n * share) rows up to
    each boundary; the hash at each boundary is found first, then every row is
    placed by comparing its own hash, so the data itself is never shuffled and
    a class with a third of all rows is no hot task.  Without it each row is
    drawn on its own, as ``random_split``.
    """
    if not exact:
        return random_split(df, keys, weights, salt, column)
    *steps, (last, _) = _cumulative(weights)
    targets = [F.floor(F.col("total") * F.lit(share)) for _, share in steps]
    hashed = df.select(F.col(label), key_hash(keys, salt).alias("h"))
    bounds = small_side(
        rank_cuts(hashed, label, "h", targets).withColumnRenamed(label, "cut_label")
    )
    h = key_hash(keys, salt)
    cuts = [
        (name, h <= F.coalesce(F.get("cuts", F.lit(i)), F.lit("")))
        for i, (name, _) in enumerate(steps)
    ]
    joined = df.join(bounds, F.col(label).eqNullSafe(F.col("cut_label")), "left")
    return joined.withColumn(column, _by_cut(h, cuts, last)).drop("cut_label", "cuts")


def rank_cuts(
    hashed: DataFrame,
    label: str,
    hash_column: str,
    targets: Sequence[Column],
    slice_digits: int | None = None,
) -> DataFrame:
    """Per label, the hash reached after each target number of rows.

    ``targets`` may use ``total``, the rows of the label.  Returns (label,
    cuts): ``cuts[i]`` is the hash of row number ``targets[i]`` in hash order,
    NULL for a target of zero.  Counts per hash slice find the slice of each
    boundary; only that slice is ordered, after equal hashes are counted
    together, so one key repeated without bound is still one row.
    """
    digits = slice_digits or SLICE_DIGITS
    sliced = hashed.withColumn("slice", F.substring(hash_column, 1, digits))
    per_slice = sliced.groupBy(label, "slice").agg(F.count(F.lit(1)).alias("n"))
    in_label = Window.partitionBy(label)
    placed = (
        per_slice.withColumn("upto", F.sum("n").over(in_label.orderBy("slice")))
        .withColumn("total", F.sum("n").over(in_label))
        .withColumn(
            "wanted",
            F.array(
                *[
                    F.struct(F.lit(i).alias("i"), t.cast("long").alias("target"))
                    for i, t in enumerate(targets)
                ]
            ),
        )
        .select(label, "slice", "n", "upto", F.explode("wanted").alias("w"))
        .filter((F.col("w.target") > F.col("upto") - F.col("n")) & (F.col("w.target") <= F.col("upto")))
        .select(
            F.col(label).alias("b_label"),
            F.col("slice").alias("b_slice"),
            F.col("w.i").alias("i"),
            (F.col("w.target") - (F.col("upto") - F.col("n"))).alias("need"),
        )
    )
    same = F.col(label).eqNullSafe(F.col("b_label")) & (F.col("slice") == F.col("b_slice"))
    in_slice = Window.partitionBy(label, "i").orderBy(hash_column)
    reached = (
        sliced.join(small_side(placed), same)
        .groupBy(label, "i", "need", hash_column)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(in_slice))
        .filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
    )
    order = F.map_from_entries(F.collect_list(F.struct("i", hash_column)))
    return (
        reached.groupBy(label)
        .agg(order.alias("by_i"))
        .select(
            label,
            F.array(*[F.col("by_i")[F.lit(i)] for i in range(len(targets))]).alias("cuts"),
        )
    )


def first_by_hash(
    df: DataFrame, keys: Sequence[str], draws: Mapping[str, tuple[str, int]]
) -> dict[str, Column]:
    """Per draw ``{name: (salt, n)}``, true for exactly ``n`` rows (unique keys).

    The rows first in the order of the salted hash are taken.  All draws are
    found together: each is a label of its own over the same rows.
    """
    hashes = F.array(
        *[
            F.struct(F.lit(name).alias("draw"), key_hash(keys, salt).alias("h"))
            for name, (salt, _) in draws.items()
        ]
    )
    hashed = df.select(F.explode(hashes).alias("d")).select("d.draw", "d.h")
    wanted = F.lit(0)
    for name, (_, n) in draws.items():
        wanted = F.when(F.col("draw") == name, F.lit(n)).otherwise(wanted)
    cuts = rank_cuts(hashed, "draw", "h", [F.least(wanted, F.col("total"))])
    # One row per draw: the labels are the names given by the caller.
    found = {row["draw"]: row["cuts"][0] for row in cuts.collect()}
    assert set(found) <= set(draws)
    return {
        name: key_hash(keys, salt) <= found[name] if found.get(name) else F.lit(False)
        for name, (salt, _) in draws.items()
    }


# Rows that a slice should hold, and how many slices there should be for each place asked for.
ROWS_PER_SLICE, SLICES_PER_PLACE = 4096, 16
# Leading hex digits whose counts are put in order by one task: 256 rows.
COARSE_DIGITS = 2
# Slices that may be broadcast to find their rows.
FEW_SLICES = 100_000


def slice_digits(size: int, places: int) -> int:
    """Hex digits that make small slices, most of which hold none of the places."""
    wanted = max(size / ROWS_PER_SLICE, min(size, SLICES_PER_PLACE * places), 1)
    digits = COARSE_DIGITS
    while 16**digits < wanted and digits < 12:
        digits += 1
    return digits


def rows_at(
    df: DataFrame, keys: Sequence[str], places: DataFrame, size: int, salt: str = "", digits: int | None = None
) -> DataFrame:
    """(keys and the columns of ``places``): the rows at the places 0.. of the order of the salted hash.

    ``places`` has a column ``place``, each value once; ``size`` is the number of rows.
    Counts per hash slice say which slices hold a place, and where in it; only the rows of
    those slices are moved and numbered, the others are read and passed over.
    """
    digits = digits or slice_digits(size, places.count())
    hashed = df.select(*keys, key_hash(keys, salt).alias("_h")).withColumn("_slice", F.substring("_h", 1, digits))
    counts = hashed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    counts = materialize(counts.withColumn("_coarse", F.substring("_slice", 1, COARSE_DIGITS)), "slices")
    # rows ahead of a slice: those of earlier coarse slices, and of earlier ones in its own
    coarse = counts.groupBy("_coarse").agg(F.sum("_n").alias("_m"))
    ahead = coarse.select("_coarse", (F.sum("_m").over(Window.partitionBy(F.lit(1)).orderBy("_coarse")) - F.col("_m")).alias("_ahead"))
    inside = Window.partitionBy("_coarse").orderBy("_slice")
    placed = counts.withColumn("_inside", F.sum("_n").over(inside) - F.col("_n")).join(F.broadcast(ahead), "_coarse")
    placed = placed.select("_slice", "_n", (F.col("_ahead") + F.col("_inside")).alias("_before"))
    # slices and places meet in steps of the order, as long as a slice on average
    width = max(1, size // 16**digits)
    step = lambda c: F.floor(c / width)
    spans = F.sequence(step(F.col("_before")), step(F.col("_before") + F.col("_n") - 1))
    within = (F.col("place") >= F.col("_before")) & (F.col("place") < F.col("_before") + F.col("_n"))
    found = (
        places.withColumn("_step", step(F.col("place")))
        .join(placed.withColumn("_step", F.explode(spans)), "_step")
        .filter(within)
        .withColumn("_i", F.col("place") - F.col("_before"))
        .drop("_step", "_n", "_before")
    )
    found = materialize(found, "places")
    wanted = found.select("_slice").distinct()
    if wanted.count() <= FEW_SLICES:
        wanted = F.broadcast(wanted)
    numbered = hashed.join(wanted, "_slice", "left_semi").withColumn(
        "_i", F.row_number().over(Window.partitionBy("_slice").orderBy("_h", *keys)) - 1
    )
    return numbered.join(found, ["_slice", "_i"]).drop("_slice", "_i", "_h")


def split_sizes(df: DataFrame, columns: Sequence[str], *extra: Column) -> DataFrame:
    """Rows per split (and class), in order."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"), *extra).orderBy(*columns)
