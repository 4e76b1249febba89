"""Language identification by word-first backoff.

A word seen in training counts with its log frequency in each language.  An unseen word
falls back to its character n-grams, from the longest length of which any n-gram is
known down to single characters.  A document's score in a language is the sum over its
words; the answer is the best language, its score the softmax of the sums.

The model is learned from a sample of some ``sample_docs`` labelled documents a language
(all of them where there are fewer), drawn by a hash of the id, and holds every word and
n-gram of the sample, which is its bound; prediction covers every word of every document.

An item a language lacks counts with one floor common to all languages, and languages
without a word in their sample are left out: a rare label draws no foreign documents.

Null text, or text without a letter, gives ``und`` with score 0, and so does every row
when nothing could be learned.  Text of unknown characters only gets the most frequent
language.  Of equally good languages the first by name is taken.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import bucket_of, map_text, query, reach_package, released, table

UNKNOWN = "und"
WORD = regex.compile(r"\p{L}+")
LONGEST_GRAM = 4
SAMPLE_DOCS = 1_500
# Unknown words a worker remembers before it starts afresh.
MEMO_ENTRIES = 100_000


@dataclass(frozen=True)
class Model:
    """Log frequencies: a row of the tables for each word and n-gram, a column a language by name."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    word_rows: np.ndarray
    grams: dict[str, int]
    gram_rows: np.ndarray


NOTHING = Model([], np.zeros(0), {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """The n-grams of a word between its boundary marks; single characters without marks."""
    if n == 1:
        return list(word)
    marked = f"_{word}_"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _word_counts(batches):
    import pyarrow as pa

    for batch in batches:
        found: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.setdefault(lang, Counter()).update(words_of(text))
        rows = [(lang, word, n) for lang, c in found.items() for word, n in c.items()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in zip(*rows)], names=["lang", "item", "n"]
            )


def _gram_counts(batches):
    import pyarrow as pa

    for batch in batches:
        found: Counter = Counter()
        columns = [batch.column(i).to_pylist() for i in range(3)]
        for lang, word, n in zip(*columns):
            for size in range(1, LONGEST_GRAM + 1):
                for gram in grams_of(word, size):
                    found[lang, size, gram] += n
        if found:
            rows = [(lang, gram, size, n) for (lang, size, gram), n in found.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int64()))],
                names=["lang", "item", "size", "n"],
            )


def train(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    sample_docs: int = SAMPLE_DOCS,
) -> Model:
    """Learn from the labelled rows given; what comes to the driver are the sample's counts."""
    reach_package(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{label}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.col(f"`{key}`").alias("key")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return NOTHING
    # a row is in the sample if its draw, any of 2**64, is at most its language's share of them
    last = {k: -(1 << 63) + int(min(1.0, sample_docs / n) * ((1 << 64) - 1)) for k, n in sizes.items()}
    share = F.create_map(*[F.lit(x) for k, n in last.items() for x in (k, min(n, (1 << 63) - 1))])
    sample = rows.filter(F.xxhash64("key") <= share[F.col("lang")])
    counted = (
        sample.select("lang", "text")
        .mapInArrow(released(_word_counts), "lang string, item string, n long")
        .groupBy("lang", "item")
        .agg(F.sum("n").alias("n"))
    )
    counted = counted.persist()
    try:
        totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        word_counts = counted.select("lang", "item", "n").toArrow()
        pieces = (
            counted.mapInArrow(released(_gram_counts), "lang string, item string, size int, n long")
            .groupBy("lang", "item", "size")
            .agg(F.sum("n").alias("n"))
        )
        gram_counts = pieces.select("lang", "item", "size", "n").toArrow()
    finally:
        counted.unpersist()
    # one without a word in its sample has no frequencies to compare
    languages = sorted(x for x in sizes if totals.get(x))
    if not languages:
        return NOTHING
    prior = np.array([sizes[x] for x in languages], float)

    def frequencies(langs, items, counts, total):
        """Rows of logs of relative frequencies; languages without the item get half a count of the largest.

        The floor is one for all and below every frequency: with one of its own, a language
        of few labelled words would find the words of all others more likely than they do.
        """
        place = {lang: i for i, lang in enumerate(languages)}
        known = {item: i for i, item in enumerate(dict.fromkeys(items))}
        rows = np.full((len(known), len(languages)), np.log(0.5 / max(1, *map(total, languages))))
        for lang, item, n in zip(langs, items, counts):
            rows[known[item], place[lang]] = np.log(n / max(total(lang), 1))
        return known, rows

    columns = [word_counts[c].to_pylist() for c in ("lang", "item", "n")]
    words, word_rows = frequencies(*columns, lambda x: totals.get(x, 0))
    columns = [gram_counts[c].to_pylist() for c in ("lang", "item", "n")]
    sizes_of = gram_counts["size"].to_numpy()
    grams: dict[str, int] = {}
    tables = []
    for size in range(1, LONGEST_GRAM + 1):
        mine = np.flatnonzero(sizes_of == size)
        langs, items, counts = ([c[i] for i in mine] for c in columns)
        sums = Counter()
        for lang, n in zip(langs, counts):
            sums[lang] += n
        known, rows_of = frequencies(langs, items, counts, lambda x, sums=sums: sums[x])
        grams |= {item: i + len(grams) for item, i in known.items()}
        tables.append(rows_of)
    return Model(languages, prior / prior.sum(), words, word_rows, grams, np.concatenate(tables))


class Scorer(dict):
    """Word to its row in a table of scores: the known words, and unknown ones as they turn up."""

    def __init__(self, model: Model):
        super().__init__(model.words)
        self.languages, self.prior = model.languages, model.prior
        self.grams, self.gram_rows = model.grams, model.gram_rows
        self.known, self.rows = len(model.words), model.word_rows
        self.met: list[str] = []

    def unknown(self, word: str) -> np.ndarray:
        """The mean of its longest known n-grams."""
        for size in range(LONGEST_GRAM, 0, -1):
            found = [self.grams[g] for g in grams_of(word, size) if g in self.grams]
            if found:
                return self.gram_rows[found].mean(axis=0)
        return np.zeros(len(self.languages))

    def __missing__(self, word: str) -> int:
        at = self.known + len(self.met)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(1024, len(self.met)), len(self.languages)))])
        self.rows[at] = self.unknown(word)
        self.met.append(word)
        self[word] = at
        return at

    def forget(self) -> None:
        for word in self.met:
            del self[word]
        self.met = []

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        languages = self.languages
        if not words or not languages:
            return UNKNOWN, 0.0
        if len(self.met) > MEMO_ENTRIES:
            self.forget()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        sums = self.rows[places].sum(axis=0)
        if not sums.any():
            best = int(np.argmax(self.prior))
            return languages[best], float(self.prior[best])
        best = int(np.argmax(sums))
        return languages[best], float(1.0 / np.exp(sums - sums[best]).sum())


def predict(df: DataFrame, model: Model, text: str = "text", keep=("doc_id",), prefix: str = "") -> DataFrame:
    """``keep``, then ``lang_pred`` and ``score`` (names after ``prefix``) of each whole text."""
    sent = df.sparkSession.sparkContext.broadcast(Scorer(model))  # bounded by the sample

    def make():
        scorer = sent.value  # a worker's own copy, where it remembers what it meets
        return lambda texts: list(zip(*map(scorer.predict, texts))) or [[], []]

    fields = [
        T.StructField(f"{prefix}lang_pred", T.StringType()),
        T.StructField(f"{prefix}score", T.DoubleType()),
    ]
    return map_text(df, text, keep, fields, make)


HELD_OUT = (4, 2)


def learnable(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: all but those whose remainder is held out."""
    return docs.filter(bucket_of("doc_id", HELD_OUT[0]) != HELD_OUT[1])


@query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = predict(docs, train(learnable(docs)))
    held_out = F.coalesce(bucket_of("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
