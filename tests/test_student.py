"""The student table end to end, on a table made in its schema."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit import session
from tabkit.functions.hashing import key_hash
from tabkit.functions.student_rules import GAMING_ORDER
from tabkit.operators import corruption
from tabkit.plans import student
from tabkit.schemas import STUDENT
from tabkit.sources import readers, writers


@pytest.fixture(scope="module")
def students(spark):
    """2,000 rows whose target is linear in the habits."""
    df = spark.range(1, 2001).select(F.col("id").alias("student_id"))
    for f in STUDENT.fields[1:]:
        draw = F.conv(F.substring(key_hash(["student_id"], f.name), 1, 8), 16, 10).cast("double")
        unit = draw / 2**32
        if isinstance(f.dataType, T.StringType):
            value = F.element_at(
                F.array(F.lit("Male"), F.lit("Female"), F.lit("Other")),
                (unit * 3).cast("int") + 1,
            )
        else:
            value = unit * 10
        df = df.withColumn(f.name, value.cast(f.dataType))
    target = F.col("study_hours_per_day") * 5 - F.col("phone_usage_hours") * 2 + F.col("sleep_hours")
    df = df.withColumn("productivity_score", target.cast("float"))
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STUDENT.fields])
    return session.materialize(typed, "students")


def test_reports(students):
    reports = student.gaming_reports(students)
    summary = reports["summary"].collect()
    assert sum(r["total"] for r in summary) == 2000
    assert {r["perfil_gamer"] for r in summary} <= set(GAMING_ORDER)
    means = [r["score_medio"] for r in summary]
    assert means == sorted(means, reverse=True)
    assert reports["by_gender"].columns == ["gender", *GAMING_ORDER]
    assert [r["gender"] for r in reports["by_gender"].collect()] == ["Female", "Male", "Other"]


def test_dirty_csv_is_cleaned(spark, students):
    """Damage, CSV round trip, clean: all rows come back without a gap."""
    damaged = corruption.inject_nulls_exact(
        students,
        ["student_id"],
        {"study_hours_per_day": ("s", 190), "coffee_intake_mg": ("c", 130)},
    )
    damaged = corruption.inject_blanks(damaged, ["student_id"], "gender", "g", ["09", "10"])
    damaged = corruption.append_copies_exact(damaged, ["student_id"], 70, "d")
    # integers with gaps pass through a float, as in a NaN-holding column
    damaged = damaged.withColumn("coffee_intake_mg", F.col("coffee_intake_mg").cast("double"))
    path = writers.csv(damaged, session.work_path(spark, "students"))
    loaded = readers.csv_typed(spark, path, STUDENT, count_failures=True)
    assert loaded.agg(F.sum("cast_failures")).first()[0] == 0
    cleaned, report = student.clean_students(loaded.select(*STUDENT.names))
    assert cleaned.count() == 2000
    facts = {(r["section"], r["item"]): r["value"] for r in report.collect()}
    assert facts["size", "rows_removed"] == 70
    assert facts["imputed", "study_hours_per_day"] == 190
    assert facts["imputed", "coffee_intake_mg"] == 130
    assert cleaned.filter("gender IS NULL OR coffee_intake_mg IS NULL").count() == 0


def test_feature_choice(students):
    rows = student.compare_features(students).collect()
    assert [(r["feature_set"], r["n_features"]) for r in rows] == [("all", 17), ("best 8", 10)]
    assert rows[0]["r2"] > 0.999 and rows[1]["r2"] > 0.999
