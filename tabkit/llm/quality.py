"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space.

The terms of a text are its words, the shapes of its tokens (letter case, digits and the
punctuation stuck to them, runs shortened) and, as terms too, bands of a few ratios of
the whole text.  Term counts, damped and weighted by inverse document frequency, are
projected on the leading singular directions of the labelled documents.  Every document
is then compared with all labelled vectors, which are broadcast, by blocked products;
the nearest vote, each with the weight of its similarity, and so do all others that are
as near as the last of them.

Learned from a sample of at most ``per_class`` labelled documents of each class, drawn
by a hash of the id: the vectors broadcast are bounded by that.  Of rows that share an id
the one whose text has the smallest hash is learned from.  Scoring covers every
whole text.  A text without a token scores 0; so do all where nothing was learned.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import bucket_of, map_text, query, table

PER_CLASS = 1_000
TERMS = 4096
DIRECTIONS = 48
NEIGHBOURS = 15
# Similarities closer than this are equal.
TIE = 1e-9
# Similarities count by this power, so that near ones outweigh the rest.
SHARPNESS = 8
# Tokens a worker remembers before it starts afresh.
MEMO_ENTRIES = 250_000


def shape(token: str) -> str:
    """Letters as a or A, digits as 0, the rest as it is, and no sign more than twice in a row."""
    out: list[str] = []
    for char in token:
        kind = "A" if char.isupper() else "a" if char.isalpha() else "0" if char.isdigit() else char
        if len(out) < 2 or out[-1] != kind or out[-2] != kind:
            out.append(kind)
    return "".join(out)


def slot(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % TERMS


class Terms(dict):
    """Token to the places of its terms, a number that holds both."""

    def __missing__(self, token: str) -> int:
        both = slot("w" + token.lower().strip(".,;:!?")) * TERMS + slot("s" + shape(token))
        if len(token) <= 64:  # longer ones hardly repeat
            self[token] = both
        return both

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and damped counts of the terms of one text."""
        tokens = text.split() if text else []
        if not tokens:
            return np.zeros(0, np.int64), np.zeros(0)
        if len(self) > MEMO_ENTRIES:
            self.clear()
        both = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        counted = np.bincount(np.concatenate([both // TERMS, both % TERMS]), minlength=TERMS)
        places = np.flatnonzero(counted)
        values = 1.0 + np.log(counted[places])
        extra = [slot(t) for t in ratio_terms(text, tokens, both)]
        return np.concatenate([places, extra]), np.concatenate([values, np.full(len(extra), 4.0)])


def ratio_terms(text: str, tokens: list[str], both: np.ndarray) -> list[str]:
    """Bands of the share of repeated neighbours, of distinct tokens and of distinct lines."""
    n = len(tokens)
    again = int((both[1:] == both[:-1]).sum()) / n
    distinct = len(np.unique(both)) / n**0.85
    lines = text.split("\n")
    fresh = len(set(lines)) / len(lines)
    return [f"r{min(5, int(again * 12))}", f"d{min(8, int(distinct * 6))}", f"l{int(fresh * 5)}"]


@dataclass(frozen=True)
class Model:
    """Term weights, directions (terms by directions), unit vectors and labels of the sample."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def sample(labels: DataFrame, per_class: int, key: str, label: str) -> DataFrame:
    """At most ``per_class`` ids of each class, by a hash of the id; ids of both classes go."""
    rows = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("id"))
    clear = rows.agg(F.min(label).alias("label"), F.max(label).alias("top")).filter("label = top").drop("top")
    draw = F.xxhash64("id")
    parts = [clear.filter(F.col("label") == k).orderBy(draw, "id").limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    per_class: int = PER_CLASS,
) -> Model:
    """Term weights, singular directions and vectors from the labelled rows given."""
    chosen = sample(labels, per_class, key, label)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("body"))
    rows = rows.join(F.broadcast(chosen), "id").filter(F.col("body").isNotNull())
    # of rows that share an id one is learned from, so the sample is as large as stated
    first = F.min(F.struct(F.xxhash64("body").alias("hash"), F.col("body")))
    rows = rows.groupBy("id", "label").agg(first["body"].alias("body"))

    def make():
        terms = Terms()

        def work(texts):
            found = [terms.counts(t) for t in texts]
            return [f[0].tolist() for f in found], [f[1].tolist() for f in found]

        return work

    fields = [
        T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("amounts", T.ArrayType(T.DoubleType())),
    ]
    taken = sorted(map_text(rows, "body", ["id", "label"], fields, make).collect(), key=lambda r: r["id"])
    taken = [r for r in taken if r["places"]]
    if not taken:
        return Model(np.zeros(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0))
    seen = Counter(p for r in taken for p in set(r["places"]))
    weights = np.zeros(TERMS)
    for place, n in seen.items():
        weights[place] = np.log((1 + len(taken)) / (1 + n)) + 1.0
    matrix = np.zeros((len(taken), TERMS))
    for i, r in enumerate(taken):
        np.add.at(matrix[i], r["places"], r["amounts"])
    matrix *= weights
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    # the right singular vectors by the eigenvectors of the smaller Gram matrix
    values, left = np.linalg.eigh(matrix @ matrix.T)
    best = np.argsort(values)[::-1][:DIRECTIONS]
    best = best[values[best] > 1e-9]
    directions = matrix.T @ (left[:, best] / np.sqrt(values[best]))
    vectors = matrix @ directions
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Model(weights, directions, vectors, np.array([r["label"] for r in taken], float))


def vote(model: Model, vectors: np.ndarray) -> np.ndarray:
    """Weighted share of label 1 among the nearest labelled vectors, for a block of rows."""
    if not len(model.labels):
        return np.zeros(len(vectors))
    close = vectors @ model.vectors.T
    k = min(NEIGHBOURS, close.shape[1])
    last = np.partition(close, close.shape[1] - k, axis=1)[:, close.shape[1] - k, None]
    weight = np.where(close >= last - TIE, np.maximum(close, 0.0), 0.0) ** SHARPNESS
    total = weight.sum(axis=1)
    votes = weight @ model.labels
    return np.where(total > 0, votes / np.maximum(total, 1e-300), 0.0)


def score(df: DataFrame, model: Model, text: str = "text", keep=("doc_id",), prefix: str = "") -> DataFrame:
    """``keep``, then ``score`` and ``predicted`` (names after ``prefix``) of each whole text."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sample, terms and directions

    def make():
        model, terms = sent.value, Terms()

        def work(texts):
            scores = np.zeros(len(texts))
            for at in range(0, len(texts), 512):
                block = texts[at : at + 512]
                vectors = np.zeros((len(block), model.directions.shape[1]))
                for i, t in enumerate(block):
                    places, amounts = terms.counts(t)
                    if len(places):
                        vectors[i] = (amounts * model.weights[places]) @ model.directions[places]
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                scores[at : at + len(block)] = vote(model, vectors)
            scores = np.clip(scores, 0.0, 1.0)
            return scores.tolist(), (scores >= 0.5).astype(int).tolist()

        return work

    fields = [
        T.StructField(f"{prefix}score", T.DoubleType()),
        T.StructField(f"{prefix}predicted", T.IntegerType()),
    ]
    return map_text(df, text, keep, fields, make)


HELD_OUT = (3, 1)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels a model may learn from: all but those whose remainder is held out."""
    return labels.filter(bucket_of("doc_id", HELD_OUT[0]) != HELD_OUT[1])


@query("op6_quality_knn")
def op6_quality_knn(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = score(docs, train(docs, learnable(table(spark, folder, "labels"))))
    held_out = F.coalesce(bucket_of("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")
