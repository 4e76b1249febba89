"""Controlled damage to a clean table: NULLs, blanks and duplicated rows.

Rows are chosen by a hash of their key, so the same rows are damaged under any
layout and the damage can be reproduced in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.hashing import key_hash
from tabkit.operators.splits import first_by_hash, rows_at
from tabkit.session import small_side

BLANKS = ("", "   ")


def inject_nulls(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """NULL where the salted key hash is below a cut: ``{column: (salt, cut)}``."""
    return df.withColumns(
        {
            c: F.when(key_hash(keys, salt) >= cut, F.col(c))
            for c, (salt, cut) in columns.items()
        }
    )


def inject_nan(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """NaN where the salted key hash is below a cut; NULLs stay NULL."""
    nan = F.lit(float("nan"))
    return df.withColumns(
        {
            c: F.when((key_hash(keys, salt) < cut) & F.col(c).isNotNull(), nan).otherwise(F.col(c))
            for c, (salt, cut) in columns.items()
        }
    )


def inject_nulls_exact(
    df: DataFrame, keys: Sequence[str], counts: Mapping[str, tuple[str, int]]
) -> DataFrame:
    """NULL in exactly n different rows per column: ``{column: (salt, n)}``."""
    hit = first_by_hash(df, keys, counts)
    return df.withColumns({c: F.when(~hit[c], F.col(c)) for c in counts})


def inject_blanks(
    df: DataFrame, keys: Sequence[str], column: str, salt: str, cuts: Sequence[str]
) -> DataFrame:
    """Hash bands become the blank spellings in turn; ``cuts`` are rising."""
    h = key_hash(keys, salt)
    value = F.col(column)
    for cut, blank in reversed(list(zip(cuts, BLANKS))):
        value = F.when(h < cut, F.lit(blank)).otherwise(value)
    return df.withColumn(column, value)


def append_copies(
    df: DataFrame, keys: Sequence[str], salt: str, cuts: Sequence[str]
) -> DataFrame:
    """One more copy of a row for every cut its hash is below.

    Nested bands stand for draws with replacement: a row may be drawn twice.
    """
    h = key_hash(keys, salt)
    copies: Column = F.lit(1)
    for cut in cuts:
        copies = copies + (h < cut).cast("int")
    return (
        df.withColumn("copy", F.explode(F.array_repeat(F.lit(True), copies))).drop("copy")
    )


def append_copies_exact(
    df: DataFrame, keys: Sequence[str], n: int, salt: str = ""
) -> DataFrame:
    """Exactly ``n`` more rows, drawn with replacement (unique keys).

    Draw i takes the row at a pseudo-random place of the hash order.  Only the rows of the
    hash slices that hold a drawn place are moved; the drawn keys, broadcast if few, then
    pick their rows, so the table itself is not shuffled.
    """
    spark = df.sparkSession
    draw = F.conv(F.substring(key_hash(["id"], f"{salt}#"), 1, 12), 16, 10).cast("long")
    size = df.count()
    if not size or not n:
        return df
    drawn = (
        spark.range(n)
        .groupBy((draw % size).alias("place"))
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
    )
    chosen = small_side(rows_at(df, keys, drawn, size, salt).select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_times"))
    # a NULL key part is a key like any other
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    copies = (
        df.join(chosen, same)
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(True), F.col("_times"))))
        .select(*df.columns)
    )
    return df.unionByName(copies)
