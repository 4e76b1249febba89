"""Near duplicates among embeddings: spherical k-means cells and blocked products.

Unit vectors go to the cell of their nearest centre.  Two vectors within the similarity
lie a bounded distance apart, so a partner in another cell is possible only if a vector
lies that near to the plane between the two centres; it then visits that cell, and no
pair is lost.  Of two cells the vector of the lower one visits the higher, so every pair
is compared once.  Cells are split into chunks and their visitors into batches: a task
multiplies one bounded block by another, in double precision.

Equal vectors are counted first and compared once.  A task reports, per vector, how many
others it is linked with and the smallest id of its linked group, never the pairs.

Null vectors, and such as hold null or non-finite components or only zeros, link with
nothing; so do vectors of different length, and rows without an id.  Rows that share an
id are one vector with the links of both.

The centres are fitted on at most ``SAMPLE`` vectors; which centres they are changes
only how much is compared, not what is found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (reached as pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm.common import query, reach_package, table
from tabkit.llm.graph import components
from tabkit.session import materialize

SIMILARITY = 0.95
CELL_VECTORS = 4_096
MOST_CELLS = 512
SAMPLE = 16_384
BLOCK = 4_096
ROUNDS = 8
SLACK = 1e-6


def fit_centres(vectors: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres by spherical k-means from spread-out rows of the sample."""
    rng = np.random.default_rng(7)
    centres = vectors[rng.permutation(len(vectors))[:cells]].copy()
    for _ in range(rounds):
        home = np.argmax(vectors @ centres.T, axis=1)
        for k in range(len(centres)):
            total = vectors[home == k].sum(axis=0)
            size = np.linalg.norm(total)
            if size > 0:
                centres[k] = total / size
    return np.unique(centres, axis=0)


def homes_and_visits(unit: np.ndarray, centres: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each vector, and a mask of the higher cells where partners may be."""
    close = unit @ centres.T
    home = np.argmax(close, axis=1)
    gaps = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * centres @ centres.T))
    reach = np.sqrt(2.0 - 2.0 * similarity) + SLACK
    visits = close[np.arange(len(unit)), home][:, None] - close <= reach * gaps[home] + SLACK
    return home, visits & (np.arange(len(centres)) > home[:, None])


def unit_rows(embeddings: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(x.as_py() for x in embeddings), "<f8")
    rows = flat.reshape(len(embeddings), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def block_groups(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of the linked groups of a block: of its rows, and of its columns."""
    rows, columns = mask.shape
    left, right = np.arange(rows), np.arange(columns) + rows
    while True:
        new_right = np.minimum(right, _least(mask.T, left))
        new_left = np.minimum(left, _least(mask, new_right))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _least(mask: np.ndarray, labels: np.ndarray) -> np.ndarray:
    out = np.full(mask.shape[0], np.iinfo(np.int64).max)
    step = max(1, (1 << 22) // max(1, mask.shape[1]))
    for at in range(0, mask.shape[0], step):
        part = mask[at : at + step]
        out[at : at + step] = np.where(part, labels, np.iinfo(np.int64).max).min(axis=1)
    return out


def _chunk(ids: np.ndarray, parts: np.ndarray | int, salt: int) -> np.ndarray:
    """An even share of ids by hash."""
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
    return (x % np.asarray(parts, np.uint64)).astype(np.int64)


TASKS = "cell long, chunk long, batch long, visitor boolean, id long, weight long, vector binary"
FOUND = "id long, links long, first long"


def _multiply(similarity: float):
    def job(rows: pa.Table) -> pa.Table:
        visitor = rows["visitor"].to_numpy(zero_copy_only=False).astype(bool)
        ids, weight = rows["id"].to_numpy(), rows["weight"].to_numpy()
        unit = unit_rows(rows["vector"].combine_chunks())
        host, guest = np.flatnonzero(~visitor), np.flatnonzero(visitor)
        links = np.zeros(len(ids), np.int64)
        first = ids.copy()

        def compare(a: np.ndarray, b: np.ndarray, same: bool) -> None:
            mask = np.zeros((len(a), len(b)), bool)
            for at in range(0, len(a), 512):
                mask[at : at + 512] = unit[a[at : at + 512]] @ unit[b].T >= similarity
            if same:
                np.fill_diagonal(mask, False)
            links[a] += mask @ weight[b]
            if not same:
                links[b] += mask.T @ weight[a]
            some_a, some_b = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
            if not len(some_a):
                return
            left, right = block_groups(mask[np.ix_(some_a, some_b)])
            nodes, labels = np.concatenate([a[some_a], b[some_b]]), np.concatenate([left, right])
            least = np.full(int(labels.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, labels, ids[nodes])
            np.minimum.at(first, nodes, least[labels])
            found_edges.append((ids[nodes], least[labels]))

        found_edges: list = []
        if len(host) and int(rows["batch"][0].as_py()) == 0:
            compare(host, host, True)
        if len(host) and len(guest):
            compare(guest, host, False)
        some = links > 0
        a = [ids[some]] + [x[0] for x in found_edges]
        count = [links[some]] + [np.zeros(len(x[0]), np.int64) for x in found_edges]
        b = [ids[some]] + [x[1] for x in found_edges]
        return pa.table([np.concatenate(a), np.concatenate(count), np.concatenate(b)], names=["id", "links", "first"])

    return job


def _deal(similarity: float, sent, chunks: dict, batches_of: dict, block: int):
    """Rows of the block products: every vector at home, and in the chunks it visits."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, weight = part.column(0).to_numpy(), part.column(1).to_numpy()
                vectors, lengths = part.column(2), np.asarray(pa.compute.binary_length(part.column(2)))
                rows: list[tuple] = []
                for length in np.unique(lengths).tolist():
                    mine = np.flatnonzero(lengths == length)
                    base, centres = sent.value[length // 8]
                    home, visits = homes_and_visits(unit_rows(vectors.take(pa.array(mine))), centres, similarity)
                    for k, i in enumerate(mine.tolist()):
                        cell = base + int(home[k])
                        own = int(_chunk(ids[i : i + 1], chunks[cell], 1)[0])
                        rows += [(cell, own, b, False, i) for b in range(batches_of[cell])]
                        for other in [cell, *(base + np.flatnonzero(visits[k])).tolist()]:
                            turn = int(_chunk(ids[i : i + 1], batches_of[other], 2)[0])
                            start = own + 1 if other == cell else 0
                            rows += [(other, c, turn, True, i) for c in range(start, chunks[other])]
                if rows:
                    cell, chunk, turn, visitor, source = zip(*rows)
                    take = pa.array(source)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell, pa.int64()), pa.array(chunk, pa.int64()), pa.array(turn, pa.int64()),
                         pa.array(visitor), part.column(0).take(take), part.column(1).take(take), vectors.take(take)],
                        names=["cell", "chunk", "batch", "visitor", "id", "weight", "vector"],
                    )

    return run


def _census(similarity: float, sent):
    """How many vectors live in, and visit, each cell."""

    def run(batches):
        for batch in batches:
            vectors = batch.column(0)
            lengths = np.asarray(pa.compute.binary_length(vectors))
            cells, live, come = [], [], []
            for length in np.unique(lengths).tolist():
                base, centres = sent.value[length // 8]
                chosen = vectors.take(pa.array(np.flatnonzero(lengths == length)))
                home, visits = homes_and_visits(unit_rows(chosen), centres, similarity)
                cells.append(base + np.arange(len(centres)))
                live.append(np.bincount(home, minlength=len(centres)))
                come.append(visits.sum(axis=0))
            if cells:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (cells, live, come)],
                    names=["cell", "live", "come"],
                )

    return run


def near_duplicates(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    similarity: float = SIMILARITY,
    cell_vectors: int = CELL_VECTORS,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    spark = rows.sparkSession
    reach_package(spark)
    source = rows.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    usable = source.filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )
    copies = usable.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))

    def packed(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = np.asarray(lists.flatten()).astype("<f8")
            ends = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.list_value_length(lists)))])
            # scaled by the largest part first: tiny and huge vectors keep their direction
            parts = [flat[a:b] / np.abs(flat[a:b]).max() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["id", "weight", "vector"],
            )

    distinct = materialize(
        copies.select("id", "weight", "v").mapInArrow(packed, "id long, weight long, vector binary"), "vectors"
    )
    lengths = {r[0] // 8: r[1] for r in distinct.groupBy(F.length("vector")).count().collect()}
    centres, base = {}, 0
    for size, n in sorted(lengths.items()):
        cells = int(min(MOST_CELLS, -(-n // cell_vectors)))
        some = distinct.filter(F.length("vector") == 8 * size).orderBy(F.xxhash64("id")).select("vector")
        sample = some.limit(min(SAMPLE, 64 * cells)).toArrow()["vector"].combine_chunks()
        centres[size] = (base, fit_centres(unit_rows(sample), cells))
        base += len(centres[size][1])
    sent = spark.sparkContext.broadcast(centres)  # MOST_CELLS centres for each vector length
    census = (
        distinct.select("vector").mapInArrow(_census(similarity, sent), "cell long, live long, come long")
        .groupBy("cell").agg(F.sum("live").alias("live"), F.sum("come").alias("come")).collect()
    )
    chunks = {r["cell"]: max(1, -(-r["live"] // block)) for r in census}
    batches_of = {r["cell"]: max(1, -(-(r["come"] + r["live"] * (chunks[r["cell"]] > 1)) // block)) for r in census}
    found = materialize(
        distinct.mapInArrow(_deal(similarity, sent, chunks, batches_of, block), TASKS)
        .groupBy("cell", "chunk", "batch").applyInArrow(_multiply(similarity), FOUND),
        "found",
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = components(found.select(F.col("id").alias("a"), F.col("first").alias("b"))).withColumnRenamed("node", "id")
    summary = (
        distinct.select("id", "weight").join(links, "id", "left").join(named, "id", "left")
        .select("id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    )
    owners = usable.select("vec_id", "v").join(copies.filter("weight > 1").select("v", "id"), "v", "left").select(
        "vec_id", F.coalesce("id", "vec_id").alias("id")
    )
    told = owners.join(summary, "id").groupBy("vec_id").agg(F.sum("n").alias("n"), F.min("c").alias("c"))
    return source.select("vec_id").join(told, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "vec_id").cast("long").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("c", "vec_id")).alias("kept"),
    )


def _sql() -> str:
    """Every pair compared; groups by reachability."""
    clean = "embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0"
    return f"""
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v, len(embedding) AS d FROM embeddings WHERE {clean}),
    u AS (SELECT vec_id, v, d, sqrt(list_dot_product(v, v)) AS size FROM v),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND a.d = b.d
      WHERE a.size > 0 AND b.size > 0 AND list_dot_product(a.v, b.v) / (a.size * b.size) >= {SIMILARITY}),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
    c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
    SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
    """


@query("op9_near_vectors", _sql())
def op9_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))
