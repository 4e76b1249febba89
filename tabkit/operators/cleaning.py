"""Fit-and-apply cleaning of a damaged table.

Order of work: drop duplicate rows, blank and NaN to NULL, fill NULLs, normalise text,
find dates, flag outliers.  What is fitted (one small record per column) is
read once on the driver and enters the plan as literals, so applying it is one
projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit import schemas
from tabkit.functions import text
from tabkit.operators import quality
from tabkit.operators.quantiles import exact_quantiles, first_look
from tabkit.session import materialize
from tabkit.sources.readers import from_records

# Share of skew up to which the mean stands for a column; beyond it the median.
SKEW_CUTOFF = 0.5


@dataclass(frozen=True)
class Fill:
    column: str
    strategy: str
    value: float | str | None
    skew: float | None
    n_missing: int


@dataclass(frozen=True)
class CleanSpec:
    """What to clean; empty lists mean every column of the kind."""

    skew_cutoff: float = SKEW_CUTOFF
    iqr_factor: float = 1.5
    exclude: tuple[str, ...] = ()
    outlier_columns: tuple[str, ...] | None = None


def blanks_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = schemas.text_columns(df.schema) if columns is None else columns
    return df.withColumns({c: text.blank_to_null(F.col(c)) for c in columns})


def sample_skewness(column: str) -> Column:
    """Bias-adjusted skewness; NULL under three values."""
    n = F.count(column).cast("double")
    adjusted = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)) * F.skewness(column)
    return F.when(n > 2, adjusted)


def _fill_measures(numeric: Sequence[str], words: Sequence[str]) -> list[Column]:
    missing = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in [*numeric, *words]]
    means = [F.avg(c).alias(f"mean_{c}") for c in numeric]
    skews = [sample_skewness(c).alias(f"skew_{c}") for c in numeric]
    return [*missing, *means, *skews]


def fit_fills(
    df: DataFrame,
    numeric: Sequence[str],
    words: Sequence[str],
    skew_cutoff: float = SKEW_CUTOFF,
    only_missing: bool = True,
    seen=None,
) -> list[Fill]:
    """Mean, or median when skewed, of numeric columns; mode of text columns.

    One pass gives counts, means and skewness (``seen`` hands in its row when
    the caller already has it).  Medians and modes, which cost more, are found
    only for the columns that need them.  NaN counts as missing.
    """
    columns = [*numeric, *words]
    if not columns:
        return []
    df = quality.nan_to_null(df, numeric)
    if seen is None:
        seen = df.agg(*_fill_measures(numeric, words)).first()
    wanted = [c for c in columns if seen[f"missing_{c}"] > 0 or not only_missing]
    skews = {c: seen[f"skew_{c}"] for c in numeric}
    skewed = [
        c
        for c in numeric
        if c in wanted and skews[c] is not None and abs(skews[c]) > skew_cutoff
    ]
    # neither waits for the other, so their jobs run side by side
    with ThreadPoolExecutor(1) as beside:
        finding = beside.submit(fit_modes, df, [c for c in words if c in wanted])
        medians = exact_quantiles(df, skewed, [0.5])
        modes = finding.result()
    fills = []
    for c in wanted:
        missing = seen[f"missing_{c}"]
        if c in modes:
            fills.append(Fill(c, "mode", modes[c], None, missing))
        elif c in medians:
            fills.append(Fill(c, "median", medians[c][0], skews[c], missing))
        else:
            fills.append(Fill(c, "mean", seen[f"mean_{c}"], skews[c], missing))
    return fills


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent text of each column; the smallest one on ties."""
    if not columns:
        return {}
    values = df.select(*columns).unpivot([], list(columns), "column_name", "value")
    counts = (
        values.filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("column_name").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("mode")
    )
    found = {row["column_name"]: row["mode"] for row in best.collect()}
    return {c: found.get(c) for c in columns}


def apply_fills(df: DataFrame, fills: Sequence[Fill]) -> DataFrame:
    """NULLs and NaN replaced; a number column filled with a mean becomes double."""
    df = quality.nan_to_null(df, [f.column for f in fills])
    replaced = {}
    for fill in fills:
        if fill.value is None:
            continue
        value = F.col(fill.column)
        if not isinstance(fill.value, str):
            value = value.cast("double")
        replaced[fill.column] = F.coalesce(value, F.lit(fill.value))
    return df.withColumns(replaced) if replaced else df


def fills_table(df: DataFrame, fills: Sequence[Fill]) -> DataFrame:
    """The fitted fills as a small table."""
    records = [
        (
            f.column,
            f.strategy,
            None if isinstance(f.value, str) or f.value is None else round(f.value, 4),
            f.value if isinstance(f.value, str) else None,
            None if f.skew is None else round(f.skew, 4),
            f.n_missing,
        )
        for f in fills
    ]
    return from_records(
        df.sparkSession,
        records,
        "column_name string, strategy string, fill_number double, fill_text string, "
        "skew double, n_missing long",
    )


def normalize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.normalize(F.col(c)) for c in columns})


def clean(df: DataFrame, spec: CleanSpec = CleanSpec()) -> tuple[DataFrame, DataFrame]:
    """The cleaned table, with outlier flags, and its report.

    De-duplication is the one shuffle of the data.  Its result is written to
    the shared folder, because fills, fences and the final table each read it
    again; they then scan single columns instead of repeating the shuffle.
    """
    spark = df.sparkSession
    numeric = schemas.numeric_columns(df.schema, spec.exclude)
    words = schemas.text_columns(df.schema, spec.exclude)
    with_marks = df.withColumns(
        {f"_blank_{i}": text.is_blank(F.col(c)) for i, c in enumerate(words)}
    )
    groups = (
        with_marks.groupBy(*with_marks.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumns({c: text.blank_to_null(F.col(c)) for c in words})
    )
    unique = materialize(quality.nan_to_null(groups, numeric), "clean")
    rows = unique.select(*df.columns)
    dated = [*words, *schemas.date_like_columns(df.schema)]
    is_date = quality.date_measures(df.select(*dated))
    checked = list(spec.outlier_columns) if spec.outlier_columns is not None else numeric
    seen = unique.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("_before"),
        F.count(F.lit(1)).alias("_after"),
        *[F.count_if(F.col(f"_blank_{i}")).alias(f"_blank_{i}") for i in range(len(words))],
        *[is_date[c].alias(f"date_{c}") for c in dated],
        *[first_look(rows, c, quality.QUARTILES).alias(f"look_{c}") for c in checked],
        *_fill_measures(numeric, words),
    ).first()

    # fences need the fills of numbers only, so the modes are found beside them
    with ThreadPoolExecutor(1) as beside:
        finding = beside.submit(fit_fills, rows, [], words, spec.skew_cutoff, True, seen)
        fills = fit_fills(rows, numeric, [], spec.skew_cutoff, seen=seen)
        looks = {c: _look_after_fill(seen[f"look_{c}"], c, fills) for c in checked}
        fences = quality.iqr_fences(apply_fills(rows, fills), checked, spec.iqr_factor, looks)
        fills += finding.result()
    tidy = normalize_text(apply_fills(rows, fills), words)
    outlier = {c: quality.is_outlier(c, fences[c]) for c in checked}
    cleaned = tidy.withColumns({f"{c}_outlier": flag for c, flag in outlier.items()})

    before, after = seen["_before"], seen["_after"]
    imputed = sum(f.n_missing for f in fills if f.value is not None)
    records = [
        ("size", "rows_before", float(before)),
        ("size", "rows_removed", float(before - after)),
        ("size", "rows_after", float(after)),
        ("size", "pct_kept", round(100.0 * after / before, 2) if before else None),
        *[("blank_to_null", c, float(seen[f"_blank_{i}"])) for i, c in enumerate(words)],
        *[("imputed", f.column, float(f.n_missing)) for f in fills if f.value is not None],
        ("imputed", "total", float(imputed)),
    ]
    records += [("dates", c, float(seen[f"date_{c}"])) for c in dated]
    counts = from_records(spark, records, "section string, item string, value double")
    return cleaned, counts.unionByName(_outlier_counts(tidy, outlier))


def _look_after_fill(look, column: str, fills: Sequence[Fill]) -> dict:
    """A first look at a column, as it is once its NULLs are filled.

    A mean or median lies between the ends, so only the size changes.
    """
    filled = sum(f.n_missing for f in fills if f.column == column and f.value is not None)
    return {**look.asDict(), "n": look["n"] + filled}


def _outlier_counts(tidy: DataFrame, outlier: Mapping[str, Column]) -> DataFrame:
    """Report lines (section, item, value) counted when the report is read."""
    counts = {c: F.count_if(flag).cast("double") for c, flag in outlier.items()}
    hit = F.lit(0.0)
    for count in counts.values():
        hit = hit + (count > 0).cast("double")
    lines = [*counts.items(), ("columns", hit)]
    rows = F.array(
        *[
            F.struct(
                F.lit("outliers").alias("section"), F.lit(item).alias("item"), value.alias("value")
            )
            for item, value in lines
        ]
    )
    return tidy.agg(rows.alias("rows")).select(F.inline("rows"))
