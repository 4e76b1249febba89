"""Feature ranking, indexing, scaling and MLlib pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tabkit.operators.quality import one_pass
from tabkit.operators.relational import top_by_size


def correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """feature, r: Pearson's r of each feature with the target, in one pass.

    Pairs with a NULL are left out (a NULL is not taken for a zero).
    """
    return one_pass(df, features, {"r": lambda c: F.corr(c, target)}).withColumnRenamed(
        "column_name", "feature"
    )


def top_correlated(df: DataFrame, features: Sequence[str], target: str, k: int = 8) -> DataFrame:
    """The ``k`` features of largest |r|, best first."""
    return top_by_size(correlations(df, features, target), F.col("r"), "feature", k)


def index_categories(df: DataFrame, column: str, out: str, keep_null: bool = False):
    """Index by falling frequency, ties alphabetical.  Returns (fitted, table)."""
    fitted = StringIndexer(
        inputCol=column,
        outputCol=out,
        stringOrderType="frequencyDesc",
        handleInvalid="keep" if keep_null else "error",
    ).fit(df)
    return fitted, fitted.transform(df)


def one_hot(df: DataFrame, index: str, out: str, drop_last: bool = True) -> DataFrame:
    """0/1 array of an index column; the last category is all zeros if dropped."""
    vector = f"{out}_vector"
    encoder = OneHotEncoder(inputCol=index, outputCol=vector, dropLast=drop_last).fit(df)
    return encoder.transform(df).withColumn(out, vector_to_array(vector)).drop(vector)


@dataclass(frozen=True)
class Scale:
    column: str
    shift: float
    divisor: float


def fit_scales(
    df: DataFrame, columns: Sequence[str], center: bool = True, population: bool = True
) -> list[Scale]:
    """Centred with population deviation, or uncentred with sample deviation."""
    return scales_of(fit_moments(df, columns), center, population)


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, Row]:
    """(mean, pop, samp) of each column from one pass, for any kind of scaling."""
    row = df.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"), F.stddev_pop(c).alias("pop"), F.stddev_samp(c).alias("samp")
            ).alias(f"m_{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return {c: row[f"m_{i}"] for i, c in enumerate(columns)}


def scales_of(
    moments_of: Mapping[str, Row], center: bool = True, population: bool = True
) -> list[Scale]:
    return [
        Scale(c, m["mean"] if center else 0.0, m["pop"] if population else m["samp"])
        for c, m in moments_of.items()
    ]


def apply_scales(df: DataFrame, scales: Sequence[Scale], suffix: str = "") -> DataFrame:
    """A constant column is only shifted, never divided by zero."""

    def scaled(s: Scale) -> Column:
        moved = F.col(s.column) - F.lit(s.shift)
        return moved / F.lit(s.divisor) if s.divisor else moved

    return df.withColumns({s.column + suffix: scaled(s) for s in scales})


def before_and_after(
    df: DataFrame, variants: Mapping[str, Sequence[Scale]], digits: int = 6
) -> DataFrame:
    """column_name, variant, mean and std before and after, in one pass over all."""
    wide = df
    for i, scales in enumerate(variants.values()):
        wide = apply_scales(wide, scales, f"_{i}")

    def at(c: str, spread: bool) -> Column:
        # Adding zero turns a rounded -0.0 into 0.0.
        return F.round(F.stddev_pop(c) if spread else F.avg(c), digits) + 0.0

    rows = [
        F.struct(
            F.lit(s.column).alias("column_name"),
            F.lit(variant).alias("variant"),
            at(s.column, False).alias("mean_before"),
            at(s.column, True).alias("std_before"),
            at(f"{s.column}_{i}", False).alias("mean_after"),
            at(f"{s.column}_{i}", True).alias("std_after"),
        )
        for i, (variant, scales) in enumerate(variants.items())
        for s in scales
    ]
    return wide.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def feature_pipeline(
    numeric: Sequence[str], category: str | None, model, with_mean: bool = False
) -> Pipeline:
    """Index and encode one category, assemble, scale, fit ``model``."""
    stages = []
    inputs = list(numeric)
    if category:
        stages.append(
            StringIndexer(inputCol=category, outputCol="_category_index", handleInvalid="keep")
        )
        stages.append(OneHotEncoder(inputCol="_category_index", outputCol="_category_vector"))
        inputs.append("_category_vector")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_raw_features"))
    stages.append(
        StandardScaler(
            inputCol="_raw_features", outputCol="features", withMean=with_mean, withStd=True
        )
    )
    return Pipeline(stages=[*stages, model])
