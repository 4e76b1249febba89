"""Schemas of the tables the toolkit was designed around."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the student productivity table.
STUDENT = T.StructType(
    [
        T.StructField("student_id", T.IntegerType(), True),
        T.StructField("age", T.IntegerType(), True),
        T.StructField("gender", T.StringType(), True),
        T.StructField("study_hours_per_day", T.FloatType(), True),
        T.StructField("sleep_hours", T.FloatType(), True),
        T.StructField("phone_usage_hours", T.FloatType(), True),
        T.StructField("social_media_hours", T.FloatType(), True),
        T.StructField("youtube_hours", T.FloatType(), True),
        T.StructField("gaming_hours", T.FloatType(), True),
        T.StructField("breaks_per_day", T.IntegerType(), True),
        T.StructField("coffee_intake_mg", T.IntegerType(), True),
        T.StructField("exercise_minutes", T.IntegerType(), True),
        T.StructField("assignments_completed", T.IntegerType(), True),
        T.StructField("attendance_percentage", T.FloatType(), True),
        T.StructField("stress_level", T.IntegerType(), True),
        T.StructField("focus_score", T.IntegerType(), True),
        T.StructField("final_grade", T.FloatType(), True),
        T.StructField("productivity_score", T.FloatType(), True),
    ]
)

# A labelled file; the class stays text although it looks like a number.
LABELLED_FILE = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("label", T.StringType())]
)

# One row per training epoch.
HISTORY = T.StructType(
    [
        T.StructField(name, T.DoubleType())
        for name in ("loss", "accuracy", "val_loss", "val_accuracy", "lr")
    ]
)


def numeric_columns(schema: T.StructType, exclude: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def fractional_columns(schema: T.StructType, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns that can hold NaN."""
    kinds = (T.FloatType, T.DoubleType)
    return [f.name for f in schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def text_columns(schema: T.StructType, exclude: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def date_like_columns(schema: T.StructType) -> list[str]:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in schema.fields if isinstance(f.dataType, kinds)]
