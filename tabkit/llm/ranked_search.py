"""Ranked lexical search by the Best Position Algorithm over impact lists.

Statistics cover all documents: one pass counts every document's terms and keeps those that
the queries hold, as a written table of postings; document frequencies and totals come from
it.  A second pass turns postings into shards of bounded size.  Each shard has one impact
list per term, sorted by falling impact, and answers every query by itself:

* sorted access reads the next positions of all lists of the query;
* a document met there is scored at once by direct access to its entry in every other list,
  which marks that entry's position as seen too;
* the best position of a list is the last one before which all positions are seen.  No
  unseen document can score more than the impacts at the best positions add up to, a bound
  below that of the positions last read;
* reading stops when this bound is strictly below the k-th best score (a document of equal
  score could still win by its id), or when the lists are read to their ends.

A task carries its k best of every query from shard to shard, so later shards stop sooner,
and hands on at most k rows a query.  Those are merged in two steps, over groups of tasks
first.  Queries are taken in blocks of bounded text, so what is broadcast is bounded, too.

Defined results: NULL and empty texts have no terms and are never found; queries without
terms, or with terms that no document holds, give no rows.  Equal scores go by document id,
missing ids last.  Repeated rows are documents, and queries, of their own.  Empty tables give
no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabkit.llm.common import query, reach_package, slices, table
from tabkit.session import materialize

K = 20
# A shard's entries: what one task holds in memory, however many documents it reads.
SHARD_ENTRIES = 2_000_000
# Text of the queries answered at once; a longer query comes alone.
BLOCK_BYTES = 4 << 20
# Positions read at once in every list, at first and at most.
FIRST_READ, MOST_READ = 16, 4096
# Bytes of a text split at once.
PIECE = 1 << 20
# Tasks whose best rows are merged first.
GROUPS = 64

# Term characters are ASCII letters and digits and all beyond ASCII; A-Z alone are lowered.
LOWERED = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def count_terms(text: bytes) -> tuple[int, Counter]:
    """How many terms a UTF-8 text has, and how often each occurs."""
    plain, found, n, at = text.translate(LOWERED), Counter(), 0, 0
    while at < len(plain):
        stop = plain.find(b" ", at + PIECE)
        stop = len(plain) if stop < 0 else stop
        terms = plain[at:stop].split()
        n += len(terms)
        found.update(terms)
        at = stop
    return n, found


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norm(n_terms, n_docs: int, all_terms: int):
    """The length norm m of documents of ``n_terms`` terms."""
    return 100 - 25 + (25 * n_terms * n_docs) // all_terms


def postings(docs: DataFrame, key: str, text: str, terms: Sequence[bytes]) -> DataFrame:
    """doc_id, n (all its terms), and the numbers and counts of those in ``terms``."""
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})
    ids = docs.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

    out = StructType(
        [StructField("doc_id", ids), StructField("n", LongType())]
        + [StructField(c, ArrayType(IntegerType())) for c in ("terms", "counts")]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out])

    def run(batches):
        number = known.value
        for batch in batches:
            for part in slices(batch, 1):
                keys, sizes, found, often = [], [], [], []
                for i, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    n, seen = count_terms(body or b"")
                    if n:
                        mine = [(number[t], c) for t, c in seen.items() if t in number]
                        keys.append(i)
                        sizes.append(n)
                        found.append([t for t, _ in mine])
                        often.append([c for _, c in mine])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip((keys, sizes, found, often), arrow)], schema=arrow
                )

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("binary")).mapInArrow(run, out)


class Best:
    """The k best (score, id) of one query so far; ids of None go last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def floor(self) -> int:
        """Score that a document must reach to matter; 1 as long as fewer than k are known."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def offer(self, rows: list[tuple]) -> None:
        self.rows = sorted([*self.rows, *rows], key=lambda r: (-r[0], r[1] is None, r[1] or 0))[: self.k]


class Shard:
    """Impact lists of some documents, and the way from a document into them."""

    def __init__(self, ids: list, sizes: np.ndarray, per_doc: np.ndarray, terms: np.ndarray, counts: np.ndarray, stats):
        """``per_doc`` entries a document, in order, of ``terms`` and ``counts``."""
        n_docs, all_terms, weights = stats
        self.ids = ids
        m = norm(sizes.astype(np.int64), n_docs, all_terms)
        doc = np.repeat(np.arange(len(ids)), per_doc)
        tf = counts.astype(np.int64)
        impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        order = np.lexsort((doc, -impact, terms))
        # lists: entries by term, falling impact
        self.list_doc, self.list_impact = doc[order], impact[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        # entries by document: term, place in the lists
        self.term, self.place = terms, np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.from_entry = np.concatenate([[0], np.cumsum(per_doc)])
        self.seen = np.zeros(len(order), bool)
        self.done = np.zeros(len(ids), bool)
        self.times = np.zeros(len(weights), np.int64)
        self.accesses = 0

    def _direct(self, docs: np.ndarray) -> np.ndarray:
        """Scores of the documents, from their entries in all lists, which count as seen."""
        begin, end = self.from_entry[docs], self.from_entry[docs + 1]
        sizes = end - begin
        cuts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        entries = np.arange(sizes.sum()) + np.repeat(begin - cuts, sizes)
        often = self.times[self.term[entries]]
        places = self.place[entries]
        self.seen[places[often > 0]] = True
        self.accesses += len(docs)
        return np.add.reduceat(often * self.list_impact[places], cuts)

    def search(self, terms: np.ndarray, times: np.ndarray, best: Best) -> None:
        """Offer to ``best`` all documents that can be among the k best for the terms."""
        start, stop = self.starts[terms], self.starts[terms + 1]
        there = stop > start
        start, stop, times, terms = start[there], stop[there], times[there], terms[there]
        if not len(terms):
            return
        self.times[terms] = times
        read, step, position, met = 0, FIRST_READ, start.copy(), []
        while True:
            ahead = [self.list_doc[a + read : min(a + read + step, b)] for a, b in zip(start, stop)]
            new = np.unique(np.concatenate(ahead))
            new = new[~self.done[new]]
            if len(new):
                self.done[new] = True
                met.append(new)
                scores = self._direct(new)
                for_floor = np.flatnonzero(scores >= best.floor())
                if len(for_floor) > best.k:  # the k-th of these is a floor, too
                    least = np.partition(scores[for_floor], len(for_floor) - best.k)[len(for_floor) - best.k]
                    for_floor = for_floor[scores[for_floor] >= least]
                best.offer([(int(scores[i]), self.ids[new[i]]) for i in for_floor])
            read, step = read + step, min(2 * step, MOST_READ)
            bound, going = 0, False
            for i, (a, b) in enumerate(zip(start, stop)):
                rest = self.seen[position[i] : b]
                ahead_seen = int(rest.argmin()) if len(rest) else 0
                if len(rest) and rest[ahead_seen]:
                    ahead_seen = len(rest)
                position[i] += ahead_seen
                if position[i] < b:  # else no document of this list is unseen
                    going = True
                    bound += int(times[i]) * int(self.list_impact[position[i] - 1])
            if not going or bound < best.floor():
                break
        for a, b in zip(start, stop):
            self.seen[a:b] = False
        for docs in met:
            self.done[docs] = False
        self.times[terms] = 0


def _shards(batches: Iterator[pa.RecordBatch], stats, entries: int) -> Iterator[Shard]:
    """Shards of at most ``entries`` entries, but for one document's own."""
    held, size = [], 0

    def built() -> Shard:
        whole = pa.Table.from_batches(held).combine_chunks()
        terms, counts = whole.column("terms").combine_chunks(), whole.column("counts").combine_chunks()
        per_doc = pa.compute.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = [c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (terms, counts)]
        return Shard(whole.column("doc_id").to_pylist(), whole.column("n").to_numpy(), per_doc, *flat, stats)

    for batch in batches:
        batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column("terms")), 0))
        ends = np.cumsum(pa.compute.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            take = max(1, int(np.searchsorted(ends, before + entries - size, "right")) - at)
            part = batch.slice(at, take)
            at += take
            held.append(part)
            size += int(ends[at - 1]) - before
            if size >= entries or at < batch.num_rows:
                yield built()
                held, size = [], 0
    if held:
        yield built()


def _answers(found: DataFrame, queries: list[tuple[list[int], list[int]]], stats, k: int, entries: int) -> DataFrame:
    """(task, q, doc_id, score): the k best of every task for every query."""
    shared = found.sparkSession.sparkContext.broadcast((queries, stats))
    from pyspark.sql.pandas.types import to_arrow_type

    kind = found.schema["doc_id"].dataType
    arrow = pa.schema([("task", pa.int32()), ("q", pa.int32()), ("doc_id", to_arrow_type(kind)), ("score", pa.int64())])

    def run(batches):
        asked, known = shared.value
        best = [Best(k) for _ in asked]
        for shard in _shards(batches, known, entries):
            for (terms, times), top in zip(asked, best):
                shard.search(np.asarray(terms, np.int64), np.asarray(times, np.int64), top)
        task = TaskContext.get().partitionId()
        for at in range(0, len(best), 256):
            rows = [(task, at + i, doc, score) for i, b in enumerate(best[at : at + 256]) for score, doc in b.rows]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return found.mapInArrow(run, f"task int, q int, doc_id {kind.simpleString()}, score long")


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """The queries (id, text as bytes), a bounded amount of text at once."""
    held, size = [], 0
    for row in items.select(F.col(f"`{key}`").alias("i"), F.col(f"`{text}`").cast("binary").alias("t")).toLocalIterator():
        held.append((row["i"], bytes(row["t"] or b"")))
        size += len(held[-1][1]) + 64
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    entries: int = SHARD_ENTRIES,
) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for every query."""
    spark = docs.sparkSession
    reach_package(spark)
    numbered = items.schema[item].dataType.simpleString()
    parts = []
    for block in _blocks(items, item, item_text):
        counted = [count_terms(body)[1] for _, body in block]
        terms = sorted(set().union(*counted))
        number = {t: i for i, t in enumerate(terms)}
        found = materialize(postings(docs, key, text, terms), "postings")
        n_docs, all_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # one row a term of the block
        df = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = np.array([weight(n_docs, df[i]) if i in df else 0 for i in range(len(terms))], np.int64)
        asked = []
        for seen in counted:
            # a weight of 0 adds nothing to any score
            kept = [(number[t], c) for t, c in seen.items() if weights[number[t]] > 0]
            asked.append(([t for t, _ in kept], [c for _, c in kept]))
        rows = _answers(found, asked, (n_docs, max(all_terms, 1), weights), k, entries)
        ids = spark.createDataFrame([(i, row[0]) for i, row in enumerate(block)], f"q int, item_id {numbered}")
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        some = Window.partitionBy("q", F.col("task") % GROUPS).orderBy(*order)
        few = rows.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
        rank = F.row_number().over(Window.partitionBy("q").orderBy(*order))
        last = few.withColumn("rank", rank).filter(F.col("rank") <= k)
        # as many rows as queries of the block
        parts.append(last.join(F.broadcast(ids), "q").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        kind = docs.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {numbered}, rank int, doc_id {kind}, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _sql() -> str:
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lowered}, '{pattern}') AS w FROM documents),
    sizes AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
    totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM sizes),
    p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
    q AS (SELECT i, item_id, term, count(*) AS times FROM (
      SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all({lowered}, '{pattern}')) AS term FROM benchmark) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, totals GROUP BY term, nn),
    scored AS (
      SELECT q.i, q.item_id, s.doc_id, p.r, CAST(sum(q.times * w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // l)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN sizes s ON s.r = p.r, totals GROUP BY ALL
    ),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {K}
    """


@query("op11_ranked_search", _sql())
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
