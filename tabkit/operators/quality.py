"""Diagnosis of a table: nulls, blanks, duplicates, dates, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit import schemas
from tabkit.functions import text
from tabkit.functions.numeric import ratio, share_pct
from tabkit.operators.quantiles import exact_quantiles

DATE_SHARE = 0.95
# Text that may be a date: a bare number is not one.
DATE_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def one_pass(df: DataFrame, columns: Sequence[str], measures: Mapping[str, object]) -> DataFrame:
    """Row per column with the given measures, from a single aggregate.

    ``measures`` maps an output name to a function from column name to an
    aggregate.  The wide one-row result is turned into rows afterwards, so the
    data is scanned once whatever the number of columns.
    """
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[make(c).alias(alias) for alias, make in measures.items()],
        )
        for c in columns
    ]
    return df.agg(F.array(*per_column).alias("rows")).select(F.inline("rows"))


def absent(df: DataFrame) -> dict[str, Column]:
    """Per column whether it holds no value: NULL, and NaN where a column can hold it.

    Blank text is a problem of its own, counted apart.
    """
    fractional = set(schemas.fractional_columns(df.schema))
    return {
        c: F.col(c).isNull() | F.isnan(c) if c in fractional else F.col(c).isNull()
        for c in df.columns
    }


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN becomes NULL, so that one of them spoils no mean and is filled like a NULL."""
    fractional = schemas.fractional_columns(df.schema)
    wanted = [c for c in fractional if columns is None or c in columns]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in wanted}) if wanted else df


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column_name, kind, n_nulls, pct_nulls of each column; NaN counts as NULL."""
    missing = absent(df)
    columns = list(columns or df.columns)
    numeric = set(schemas.numeric_columns(df.schema))
    words = set(schemas.text_columns(df.schema))
    kind = {c: "numeric" if c in numeric else "text" if c in words else "other" for c in columns}
    return one_pass(
        df,
        columns,
        {
            "kind": lambda c: F.lit(kind[c]),
            "n_nulls": lambda c: F.count_if(missing[c]),
            "pct_nulls": lambda c: share_pct(F.count_if(missing[c]), F.count(F.lit(1))),
        },
    )


def any_blank(df: DataFrame) -> Column:
    return text.any_true([text.is_blank(F.col(c)) for c in schemas.text_columns(df.schema)])


def any_absent(df: DataFrame) -> Column:
    return text.any_true(list(absent(df).values()))


def problem_row(df: DataFrame) -> Column:
    """True where any column is NULL or NaN, or any text column is blank."""
    return any_absent(df) | any_blank(df)


def affected_rows(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_null_rows, n_blank_rows, n_affected, pct_affected."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(any_absent(df)).alias("n_null_rows"),
        F.count_if(any_blank(df)).alias("n_blank_rows"),
        F.count_if(problem_row(df)).alias("n_affected"),
        share_pct(F.count_if(problem_row(df)), F.count(F.lit(1))).alias("pct_affected"),
    )


def row_groups(df: DataFrame) -> DataFrame:
    """Each different row once, with its number of copies.

    Copies are counted before the shuffle, so a row repeated without bound
    moves as one row per task.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows; NULLs are equal."""
    total = F.coalesce(F.sum("_copies"), F.lit(0))
    return row_groups(df).agg(
        total.alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        (total - F.count(F.lit(1))).alias("n_duplicates"),
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def date_measures(df: DataFrame, min_share: float = DATE_SHARE) -> dict[str, Column]:
    """Per column an aggregate that tells whether it holds dates."""
    typed = set(schemas.date_like_columns(df.schema))
    words = set(schemas.text_columns(df.schema))

    def is_date(c: str) -> Column:
        if c not in words:
            return F.lit(c in typed)
        value = F.col(c)
        reads = value.rlike(DATE_SHAPE) & value.try_cast("timestamp").isNotNull()
        readable = F.avg(reads.cast("int"))
        return F.coalesce(readable >= min_share, F.lit(False))

    return {c: is_date(c) for c in df.columns}


def date_columns(df: DataFrame, min_share: float = DATE_SHARE) -> DataFrame:
    """column_name, is_date: typed dates, or text that nearly always reads as one."""
    measures = date_measures(df, min_share)
    return one_pass(df, df.columns, {"is_date": lambda c: measures[c]})


QUARTILES = (0.25, 0.75)


def iqr_fences(
    df: DataFrame,
    columns: Sequence[str],
    factor: float = 1.5,
    looks: Mapping[str, Mapping] | None = None,
) -> dict[str, tuple[float, float, float, float] | None]:
    """(q1, q3, low fence, high fence) per column; None without values."""
    fences = {}
    for c, (q1, q3) in exact_quantiles(df, columns, QUARTILES, looks=looks).items():
        if q1 is None:
            fences[c] = None
        else:
            reach = factor * (q3 - q1)
            fences[c] = (q1, q3, q1 - reach, q3 + reach)
    return fences


def is_outlier(column: str, fence: tuple[float, float, float, float] | None) -> Column:
    if fence is None:
        return F.lit(False)
    _, _, low, high = fence
    value = F.col(column)
    # NaN sorts above every number, but is no value
    outside = (value < F.lit(low)) | (value > F.lit(high))
    return F.coalesce(outside & ~F.isnan(value.cast("double")), F.lit(False))


def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """column_name, q1, q3, fences, n_outliers, pct_outliers."""
    fences = {c: f for c, f in iqr_fences(df, columns, factor).items() if f is not None}
    return one_pass(
        df,
        [c for c in columns if c in fences],
        {
            "q1": lambda c: F.lit(fences[c][0]),
            "q3": lambda c: F.lit(fences[c][1]),
            "low_fence": lambda c: F.lit(fences[c][2]),
            "high_fence": lambda c: F.lit(fences[c][3]),
            "n_outliers": lambda c: F.count_if(is_outlier(c, fences[c])),
            "pct_outliers": lambda c: share_pct(
                F.count_if(is_outlier(c, fences[c])), F.count(F.lit(1))
            ),
        },
    )


def flag_outliers(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, suffix: str = "_outlier"
) -> DataFrame:
    """Rows stay; a boolean column per checked column is added."""
    fences = iqr_fences(df, columns, factor)
    return df.withColumns({c + suffix: is_outlier(c, fences[c]) for c in columns})


def diagnosis(df: DataFrame) -> DataFrame:
    """One row from one shuffle: size, nulls, blanks, duplicates, affected rows."""
    words = schemas.text_columns(df.schema)
    groups = row_groups(df)
    weight = F.col("_copies")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value * weight), F.lit(0))

    nulls = text.count_true(list(absent(df).values()))
    blanks = text.count_true([text.is_blank(F.col(c)) for c in words])
    rows = F.coalesce(F.sum(weight), F.lit(0))
    duplicates = rows - F.count(F.lit(1))
    affected = total(problem_row(df).cast("int"))
    return groups.agg(
        rows.alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        total(nulls).alias("n_nulls"),
        total(blanks).alias("n_blanks"),
        duplicates.alias("n_duplicates"),
        affected.alias("n_affected"),
        F.round(ratio(affected + duplicates, rows) * 100, 2).alias("pct_corrupt"),
    )
