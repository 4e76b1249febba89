"""Corpus pipeline: language, quality, near duplicates, packing, over the documents table.

Each stage works on everything its predecessor kept, is written as Parquet in the shared
folder and read again by the next.  All but the last return the columns of documents.

Rows that a stage rejects: those whose language cannot be told, those predicted to be of
low quality, and all but one row in each group of near duplicates: the row of the smallest
id, rows that repeat an id or have none included.  Rows without words are in no group.  Where nothing could be learned (no
labelled rows) a stage keeps every row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm import jaccard, language, packing, quality
from tabkit.llm.common import table
from tabkit.session import materialize

# A language must be at least this likely; a text of one short word may well be below one half.
LEAST_LIKELY = 0.35
# Columns of the decisions; no table may use names that start like this.
MARK = "__stage_"


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart."""
    model = language.train(language.learnable(docs))
    if not model.languages:
        return docs
    marked = language.predict(docs, model, keep=docs.columns, prefix=MARK)
    sure = (F.col(f"{MARK}lang_pred") != language.UNKNOWN) & (F.col(f"{MARK}score") >= LEAST_LIKELY)
    return marked.filter(sure).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours vote for them."""
    model = quality.train(docs, quality.learnable(table(spark, sf_dir, "labels")))
    if not len(model.labels):
        return docs
    marked = quality.score(docs, model, keep=docs.columns, prefix=MARK)
    return marked.filter(f"{MARK}predicted = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by the shingle join: that of smallest id, rows without id last.

    Rows are numbered in a written copy, so rows that share an id, or have none, are told apart.
    """
    row, group, best = f"{MARK}row", f"{MARK}group", f"{MARK}best"
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = jaccard.jaccard_components(numbered, key=row).filter("component_id IS NOT NULL")
    members = materialize(
        found.select(F.col("doc_id").alias(row), F.col("component_id").alias(group))
        .join(numbered.select(row, "doc_id"), row)
        .select(row, group, "doc_id"),
        "members",
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    groups = members.groupBy(group).agg(F.min(order)["row"].alias(best), F.count("*").alias("many"))
    groups = materialize(groups.filter("many > 1").drop("many"), "groups")
    # a large group is one key: joined without a shuffle where there are few groups
    if groups.count() <= jaccard.BROADCAST_IDS:
        groups = F.broadcast(groups)
    gone = materialize(members.join(groups, group).filter(F.col(row) != F.col(best)).select(row), "gone")
    if gone.count() <= jaccard.BROADCAST_IDS:
        gone = F.broadcast(gone)
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their sequences."""
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [
    ("language", detect_language),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

# No stage but the shingle join could be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
