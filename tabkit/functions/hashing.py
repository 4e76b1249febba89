"""Layout-independent pseudo-randomness from a row's key.

``rand`` and ``randomSplit`` depend on how rows are spread over partitions.
An md5 of the key does not: the same row gets the same draw under any layout,
after a lost task, and in any other SQL engine.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(keys: Sequence[str], salt: str = "") -> Column:
    """md5 (hex text) of the salt and the key columns joined by ``-``.

    Different keys are written differently: among several parts a dash or backslash
    within a part is escaped unless the part is a lone number, and NULL is ``\\N``, which
    no escaped text can be.
    """
    def part(k: str) -> Column:
        value = F.col(k).cast("string")
        if len(keys) > 1:
            escaped = F.regexp_replace(value, r"([\\-])", r"\\$1")
            # of a column of whole numbers this is known before any row is read
            whole = F.typeof(F.col(k)).isin("tinyint", "smallint", "int", "bigint")
            value = F.when(whole | value.rlike(r"^-?[0-9.]+$"), value).otherwise(escaped)
        else:
            value = F.replace(value, F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(value, F.lit("\\N"))

    parts = [part(k) for k in keys]
    return F.md5(F.concat(F.lit(salt), F.concat_ws("-", *parts)))


def hex_cut(fraction: float | Decimal) -> str:
    """Hex text below which a share of ``fraction`` of all hashes lies."""
    share = Decimal(str(fraction))
    if share >= 1:
        return "g"  # above every hex digit
    return f"{int((share * 16**8).to_integral_value(ROUND_HALF_UP)):08x}"


def fold_of(hash_text: Column, k: int) -> Column:
    """Fold 0..k-1 from the first six hex digits."""
    return (F.conv(F.substring(hash_text, 1, 6), 16, 10).cast("int") % k).alias("fold")
