"""The student productivity table: gaming score, its reports, feature choice.

The given tables do not hold this table, so nothing here is registered; the
functions take a DataFrame with ``schemas.STUDENT``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.student_rules import (
    GAMING_CLASSES,
    GAMING_ORDER,
    GAMING_OTHERWISE,
    GAMING_SCORE,
)
from tabkit.operators import cleaning, gram, splits
from tabkit.operators import relational as rel
from tabkit.schemas import numeric_columns

KEY, TARGET = "student_id", "productivity_score"


def with_gaming_profile(students: DataFrame) -> DataFrame:
    return rel.with_score(
        students, GAMING_SCORE, GAMING_CLASSES, GAMING_OTHERWISE, "score_gamer", "perfil_gamer"
    )


def gaming_reports(students: DataFrame) -> dict[str, DataFrame]:
    """Summary by profile, gender by profile, and mean habits by profile."""
    scored = with_gaming_profile(students)
    summary = rel.grouped_means(
        scored,
        ["perfil_gamer"],
        {
            "score_medio": ("score_gamer", 3),
            "gaming_h_medio": ("gaming_hours", 2),
            "edad_media": ("age", 1),
        },
        count="total",
    )
    habits = rel.grouped_means(
        scored,
        ["perfil_gamer"],
        {
            "yt_h_med": ("youtube_hours", 2),
            "sm_h_med": ("social_media_hours", 2),
            "sleep_med": ("sleep_hours", 2),
            "phone_med": ("phone_usage_hours", 2),
            "stress_med": ("stress_level", 2),
        },
        count=None,
    )
    return {
        "summary": summary.orderBy(F.col("score_medio").desc()),
        "by_gender": rel.crosstab(scored, "gender", "perfil_gamer", GAMING_ORDER).orderBy("gender"),
        "habits": habits.orderBy("perfil_gamer"),
    }


def clean_students(students: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned table and report; the id is neither filled nor checked."""
    return cleaning.clean(students, cleaning.CleanSpec(exclude=(KEY,)))


def compare_features(students: DataFrame, k: int = 8) -> DataFrame:
    """All numeric columns against the ``k`` most correlated with the target."""
    coded, dummies = gram.dummies(students, "gender")
    split = splits.random_split(coded, [KEY], {"train": 0.8, "test": 0.2}, "fs")
    every = numeric_columns(students.schema, (KEY, TARGET))
    return gram.feature_sets_table(split, every, TARGET, "split", k, dummies)
