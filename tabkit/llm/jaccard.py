"""Similarity join of documents by the Jaccard index of their word shingles.

Shingles are hashed into groups.  The counts of its groups make a document a point, and
an R-tree over such points finds partners: the overlap of two sets cannot exceed the sum
of the coordinate minima, nor can that of a set and any point of a box exceed the sum
against the box's upper corner.  Pairs that pass are verified on the shingles.

One R-tree over all documents could not be spread over executors: in so many dimensions
every box meets every query.  The trees are therefore built in blocks that lose no pair.
Linked sets differ in at most a ninth of their summed sizes, and each difference changes
one group; so of twice as many groups half are the same in both.  A hash of a group's
content is a block key, and under any common order of these keys linked sets share one
among the first half.  Groups with many rare shingles come first: passages that recur
hardly ever fill a group alone.  Which shingles are not rare is counted over all
documents, and changes only the speed.
Blocks that share documents are united into families, and each family gets one tree.  A
family too large for a task is dealt into chunks, see ``_large_families``.

The similarity is in percent and links are exact: no pair is dropped, capped or sampled.
Sets are compared as 64-bit hashes of shingles.  An empty set links with nothing.  Rows
without an id keep their count and get a NULL component; rows that share an id are one
node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import U64, SpanHasher, map_text, mix, query, reach_package, released, table, word_hashes
from tabkit.llm.graph import components
from tabkit.session import materialize

WORDS = 5
SIMILARITY = 80
# Shingles one task may hold of a family, or of all the small families dealt to it.
CHUNK_SHINGLES = 1_500_000
# Ids of documents with possible partners that may be broadcast (16 bytes each).
BROADCAST_IDS = 500_000
# Shingles that do not count as rare: at most so many, counted in segments of so many
# occurrences, in each of which at least SEGMENT_LEAST documents must hold them.
FREQUENT = 300_000
SEGMENT = 2_000_000
SEGMENT_LEAST = 4
LEAF = 32
STEP = 0xD6E8FEB86659FD93


# --- sets -----------------------------------------------------------------------------


def shingle_set(hasher: SpanHasher, text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct hashed shingles, ascending; fewer words than one shingle count as one."""
    if not text:
        return np.zeros(0, U64)
    found = word_hashes(hasher, text.encode("utf-8", "surrogatepass").lower())
    if not len(found):
        return found
    length = min(words, len(found))
    with np.errstate(over="ignore"):
        total = np.full(len(found) - length + 1, U64(length))
        for i in range(length):
            total = mix(total * U64(STEP) + found[i : len(found) - length + 1 + i])
    return np.unique(total)


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    with np.errstate(over="ignore"):
        parts = mix(shingles).sum(dtype=U64), mix(shingles ^ U64(STEP)).sum(dtype=U64)
    return tuple(int(x.astype(np.int64)) for x in parts)


def size_classes(similarity: int = SIMILARITY) -> np.ndarray:
    """Upper bounds (exclusive) of the size classes: partners are one class apart at most."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 100 // similarity))
    return np.array(bounds)


def most_apart(upper: int, similarity: int = SIMILARITY) -> int:
    """Shingles in which two linked sets may differ if the smaller has fewer than ``upper``.

    The larger has at most 100 / similarity times as many as the smaller.
    """
    small = upper - 1
    both = small + small * 100 // similarity
    return both * (100 - similarity) // (100 + similarity)


def block_keys(
    shingles: np.ndarray, bounds: np.ndarray, frequent: np.ndarray, similarity: int = SIMILARITY
) -> np.ndarray:
    """Hashes of the contents of a set's groups, for its size class and the one below.

    With ``d`` shingles apart at most, all but d of the groups are the same, so two sets
    share one of the first d + 1 under a common order: by rare shingles in the group,
    then by hash.  ``frequent`` shingles (ascending) are not rare.
    """
    n = len(shingles)
    own = int(np.searchsorted(bounds, n, side="right"))
    rare = np.ones(n, np.int64)
    if n and len(frequent):
        rare[frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles] = 0
    keys = []
    with np.errstate(over="ignore"):
        for index in (own, own - 1):
            apart = most_apart(int(bounds[index]), similarity) if n and index else 0
            if apart < 1:
                continue  # so small a set links with equal ones only
            groups = 2 * apart + 2
            salt = U64(index * STEP % (1 << 64))
            spread = mix(shingles ^ salt)
            group = (spread % U64(groups)).astype(np.int64)
            order = np.argsort(group)
            ids = group[order]
            first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            content = np.add.reduceat(mix(spread[order]), first)
            found = mix(content + mix(ids[first].astype(U64) + salt))
            weight = np.add.reduceat(rare[order], first)
            if len(first) <= apart:  # hardly ever: empty groups count as well
                empty = np.setdiff1d(np.arange(groups), ids)
                found = np.concatenate([found, mix(empty.astype(U64) + salt)])
                weight = np.concatenate([weight, np.full(len(empty), -1)])
            keys.append(found[np.lexsort((found, -weight))[: apart + 1]])
    return np.concatenate(keys) if keys else np.zeros(0, U64)


# --- the tree -------------------------------------------------------------------------


def needed(n, m, similarity: int = SIMILARITY):
    """Least overlap of linked sets of these sizes."""
    return -(-similarity * (n + m) // (100 + similarity))


class CountTree:
    """R-tree over group counts: boxes are kept by their upper corners and size ranges."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray):
        order = self._pack(sizes, points)
        self.order, self.levels = order, []
        corner, low, high = points[order], sizes[order], sizes[order]
        self.levels.append((corner, low, high))
        while len(low) > LEAF:
            cuts = np.arange(0, len(low), LEAF)
            corner = np.maximum.reduceat(corner, cuts, axis=0)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((corner, low, high))

    @staticmethod
    def _pack(sizes: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Sort-tile order: slabs by size, then by the widest coordinate, until leaves are full."""
        parts, done = [np.lexsort((np.arange(len(sizes)), sizes))], []
        while parts:
            part = parts.pop()
            if len(part) <= LEAF:
                done.append(part)
                continue
            block = points[part]
            axis = int(np.argmax(block.max(axis=0).astype(np.int64) - block.min(axis=0)))
            part = part[np.argsort(block[:, axis], kind="stable")]
            half = -(-len(part) // (2 * LEAF)) * LEAF
            parts += [part[half:], part[:half]]
        return np.concatenate(done) if done else np.zeros(0, np.int64)

    def search(self, size: int, point: np.ndarray, similarity: int = SIMILARITY) -> np.ndarray:
        """Places of all points that may be linked with the given one."""
        smallest, largest = -(-similarity * size // 100), size * 100 // similarity
        active = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, low, high = self.levels[depth]
            active = active[(high[active] >= smallest) & (low[active] <= largest)]
            bound = np.minimum(corner[active], point).sum(axis=1, dtype=np.int64)
            active = active[bound >= needed(size, np.maximum(low[active], smallest), similarity)]
            if depth:
                width = len(self.levels[depth - 1][1])
                active = (active[:, None] * LEAF + np.arange(LEAF)).ravel()
                active = active[active < width]
        return self.order[active]


def group_counts(sets: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """The points: as many groups as a quarter of the usual size, within bounds."""
    groups = int(np.clip(1 << int(np.median(sizes) / 4).bit_length(), 8, 1024))
    rows = np.repeat(np.arange(len(sets)), sizes)
    slots = (mix(np.concatenate(sets)) % U64(groups)).astype(np.int64)
    counts = np.bincount(rows * groups + slots, minlength=len(sets) * groups)
    return counts.reshape(len(sets), groups).astype(np.int32)


class Union:
    """Which documents of a task are known to be connected."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = int(self.up[x])
        return x

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up


def link_sets(
    sets: list[np.ndarray], known: np.ndarray, queries: np.ndarray, similarity: int = SIMILARITY
) -> list[tuple[int, int]]:
    """Links that connect all that is connected, leaving out those already implied.

    ``known`` numbers the components found before; only ``queries`` are searched for.
    """
    sizes = np.array([len(s) for s in sets])
    points = group_counts(sets, sizes)
    tree = CountTree(sizes, points)
    values, local = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(values), bool)
    union, links = Union(len(sets)), []
    _, first = np.unique(known, return_index=True)
    union.up = first[np.unique(known, return_inverse=True)[1]]
    for q in queries.tolist():
        found = tree.search(int(sizes[q]), points[q], similarity)
        roots = union.roots()
        found = found[roots[found] != roots[q]]
        if not len(found):
            continue
        mine = local[starts[q] : starts[q + 1]]
        marked[mine] = True
        lengths = sizes[found]
        edges = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        places = np.repeat(starts[found] - edges, lengths) + np.arange(int(lengths.sum()))
        overlap = np.add.reduceat(marked[local[places]].astype(np.int64), edges)
        marked[mine] = False
        linked = found[100 * overlap >= similarity * (sizes[q] + lengths - overlap)]
        for other in linked.tolist():
            a, b = union.root(q), union.root(other)
            if a != b:
                union.up[max(a, b)] = min(a, b)
                links.append((q, other))
    return links


# --- jobs -----------------------------------------------------------------------------


# Set hashes a task remembers, to pass over copies before anything is shuffled.
SEEN_SETS = 200_000


class Seen(set):
    """Whether a set came before in this task, as far as is remembered."""

    def again(self, name: tuple[int, int]) -> bool:
        if name in self:
            return True
        if len(self) >= SEEN_SETS:
            self.clear()
        self.add(name)
        return False


SETS = "doc_id long, n_shingles long, h1 long, h2 long, shingle long, holders long"


def measured(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS) -> DataFrame:
    """A row for every document: ``doc_id``, ``n_shingles`` and the 128-bit hash of its set.

    Besides, rows with ``holders`` name the shingles that several documents of a segment hold.
    """

    def run(batches):
        hasher, seen, waiting, size = SpanHasher(), Seen(), [], 0
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                shingles = shingle_set(hasher, body.as_py(), words)
                name = set_hash(shingles)
                rows.append((doc, len(shingles), *name))
                if len(shingles) and not seen.again(name):
                    waiting.append(shingles)
                    size += len(shingles)
                if size > SEGMENT:
                    yield _frequent(waiting)
                    waiting, size = [], 0
            yield _sets(*zip(*rows))
        if waiting:
            yield _frequent(waiting)

    def _sets(doc, n, h1, h2):
        empty = [None] * len(doc)
        return _batch(doc, n, h1, h2, empty, empty)

    def _frequent(waiting):
        values, counts = np.unique(np.concatenate(waiting), return_counts=True)
        often = counts >= SEGMENT_LEAST
        empty = [None] * int(often.sum())
        return _batch(empty, empty, empty, empty, values[often].view(np.int64), counts[often])

    def _batch(*columns):
        names = [c.split()[0] for c in SETS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")).mapInArrow(released(run), SETS)


def frequent_shingles(sets: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """The ``most`` shingles held most often, ascending: a bounded list for the driver."""
    counted = sets.filter("holders IS NOT NULL").groupBy("shingle").agg(F.sum("holders").alias("n"))
    top = counted.orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toArrow()
    return np.sort(top["shingle"].to_numpy().astype(np.int64).view(U64))


def blocks(docs: DataFrame, frequent: np.ndarray, text: str, key: str, words: int, similarity: int) -> DataFrame:
    """``block`` and ``doc``: a row for every block key of a set, copies in a task once."""
    bounds = size_classes(similarity)
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT numbers

    def run(batches):
        hasher, seen = SpanHasher(), Seen()
        for batch in batches:
            out, owners, size = [], [], 0
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                shingles = shingle_set(hasher, body.as_py(), words)
                if doc is None or not len(shingles) or seen.again(set_hash(shingles)):
                    continue
                keys = block_keys(shingles, bounds, sent.value, similarity)
                out.append(keys)
                owners.append(np.full(len(keys), doc, np.int64))
                size += len(keys)
                if size > 200_000:
                    yield _pairs(out, owners)
                    out, owners, size = [], [], 0
            if out:
                yield _pairs(out, owners)

    def _pairs(keys, owners):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))],
            names=["block", "doc"],
        )

    source = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`"))
    return source.mapInArrow(released(run), "block long, doc long")


def block_links(rows: DataFrame) -> DataFrame:
    """Every document of a block tied to the block's smallest: columns ``a`` and ``b``."""
    least = F.min("doc").over(Window.partitionBy("block"))
    return rows.select(F.col("doc").alias("a"), least.alias("b")).filter("a != b").distinct()


def few(rows: DataFrame) -> DataFrame:
    """Broadcast rows of ids that prove to be few; else Spark joins them by shuffling."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def with_sets(docs: DataFrame, families: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """Shingles, as bytes, of the documents that belong to a family."""
    chosen = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("body"))
    chosen = chosen.join(few(families), "doc")

    def make():
        hasher = SpanHasher()
        return lambda texts: [[shingle_set(hasher, t, words).tobytes() for t in texts]]

    fields = [T.StructField("shingles", T.BinaryType())]
    found = map_text(chosen, "body", ["doc", "family"], fields, make)
    return found.withColumn("size", (F.length("shingles") / 8).cast("long"))


LINKS = "a long, b long, degree long"


def _search(similarity: int):
    """Links within the rows of one task: each family apart, queries against all."""

    def job(rows: pa.Table) -> pa.Table:
        family = rows["family"].to_numpy()
        docs, known = rows["doc"].to_numpy(), rows["known"].to_numpy()
        asks = rows["asks"].to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x.as_buffer(), U64) for x in rows["shingles"]]
        order = np.argsort(family, kind="stable")
        cuts = np.flatnonzero(np.r_[True, family[order][1:] != family[order][:-1], True])
        a, b, degree = [], [], []
        for start, end in zip(cuts[:-1], cuts[1:]):
            part = order[start:end]
            links = link_sets([sets[i] for i in part], known[part], np.flatnonzero(asks[part]), similarity)
            ends = np.bincount(np.array(links, np.int64).ravel(), minlength=len(part))
            for x, y in links:
                a.append(docs[part[x]])
                b.append(docs[part[y]])
                degree.append(ends[x])
                a.append(docs[part[y]])
                b.append(docs[part[x]])
                degree.append(ends[y])
        return pa.table([pa.array(x, pa.int64()) for x in (a, b, degree)], names=["a", "b", "degree"])

    return job


def family_links(sets: DataFrame, chunk: int, similarity: int) -> DataFrame:
    """Verified links among the documents of each family: columns ``a`` and ``b``."""
    sizes = sets.groupBy("family").agg(F.sum("size").alias("total"))
    total = sizes.agg(F.sum("total")).first()[0] or 0
    tasks = int(2 * total // chunk) + 8
    large = materialize(
        sizes.filter(F.col("total") > chunk).select(
            "family", F.ceil(F.col("total") / (chunk // 2)).cast("int").alias("chunks")
        ),
        "large",
    )
    many = large.count()
    small = sets.join(few(large), "family", "left_anti") if many else sets
    found = (
        small.select(
            F.pmod(F.xxhash64("family"), F.lit(tasks)).alias("task"),
            "family", "doc", "shingles", F.col("doc").alias("known"), F.lit(True).alias("asks"),
        )
        .groupBy("task")
        .applyInArrow(_search(similarity), LINKS)
        .select("a", "b")
    )
    if many:
        found = found.unionByName(_large_families(sets.join(few(large), "family"), chunk, similarity))
    return found


def _large_families(rows: DataFrame, chunk: int, similarity: int) -> DataFrame:
    """Links of families that no task could hold.

    First every chunk is searched by itself.  Then each chunk's best connected document
    is searched in all chunks, which unites copies of one original.  What is still apart
    from its family's largest component is searched in all chunks, in blocks: few
    documents as a rule, and if many, a pair of blocks is still one bounded task.
    """
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int"))
    inner = materialize(
        rows.select(
            F.xxhash64("family", "chunk").alias("task"),
            "family", "doc", "shingles", F.col("doc").alias("known"), F.lit(True).alias("asks"),
        )
        .groupBy("task")
        .applyInArrow(_search(similarity), LINKS),
        "inner",
    )
    degrees = inner.groupBy(F.col("a").alias("doc")).agg(F.max("degree").alias("degree"))
    hubs = (
        rows.select("family", "chunk", "doc")
        .join(degrees, "doc", "left")
        .groupBy("family", "chunk")
        .agg(F.max_by("doc", F.struct(F.coalesce("degree", F.lit(0)), -F.col("doc"))).alias("doc"))
    )
    links = inner.select("a", "b")
    links = materialize(links.unionByName(_across(rows, hubs.select("doc"), links, chunk, similarity)), "links")
    state = _labelled(rows, links)
    counted = state.groupBy("family", "known").count()
    largest = counted.groupBy("family").agg(F.max_by("known", "count").alias("known"))
    apart = state.join(largest, ["family", "known"], "left_anti").select("doc")
    return links.unionByName(_across(rows, apart, links, chunk, similarity))


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    named = components(links).withColumnRenamed("node", "doc")
    return rows.select("family", "doc").join(named, "doc", "left").select(
        "family", "doc", F.coalesce("component", "doc").alias("known")
    )


def _across(rows: DataFrame, asking: DataFrame, links: DataFrame, chunk: int, similarity: int) -> DataFrame:
    """Links found by searching ``asking`` in every chunk of their families."""
    known = few(materialize(_labelled(rows, links).select("doc", "known"), "known"))
    all_rows = rows.join(known, "doc")
    asking = all_rows.join(few(materialize(asking.distinct(), "asking")), "doc", "left_semi")
    parts = asking.groupBy("family").agg(F.ceil(F.sum("size") / chunk).cast("int").alias("parts"))
    parts = few(materialize(parts, "parts"))
    part = F.pmod(F.xxhash64("doc", F.lit(1)), F.col("parts")).cast("int").alias("part")
    columns = ["family", "doc", "shingles", "known"]
    left = all_rows.join(parts, "family").select(
        *columns, "chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("asks")
    )
    right = asking.join(parts, "family").select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), part, F.lit(True).alias("asks")
    )
    both = left.unionByName(right).withColumn("task", F.xxhash64("family", "chunk", "part"))
    return both.drop("chunk", "part").groupBy("task").applyInArrow(_search(similarity), LINKS).select("a", "b")


def jaccard_components(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    words: int = WORDS,
    similarity: int = SIMILARITY,
    chunk: int = CHUNK_SHINGLES,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links)."""
    reach_package(docs.sparkSession)
    told = materialize(measured(docs, text, key, words), "sets")
    frequent = frequent_shingles(told)
    sizes = told.filter("n_shingles IS NOT NULL").drop("shingle", "holders")
    copies = (
        sizes.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("n_shingles", "h1", "h2")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("many"))
        .filter("many > 1")
        .drop("many")
    )
    copies = few(materialize(copies, "copies"))
    owners = sizes.join(copies, ["n_shingles", "h1", "h2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).cast("long").alias("first"),
    )
    owners = materialize(owners, "owners")
    near = block_links(blocks(docs, frequent, text, key, words, similarity))
    families = components(near).select(F.col("node").alias("doc"), F.col("component").alias("family"))
    families = materialize(families, "families")
    sets = materialize(with_sets(docs, families, text, key, words), "candidates")
    links = materialize(family_links(sets, chunk, similarity), "pairs")
    # links between copies stand for links between their first documents
    firsts = owners.filter("doc_id IS NOT NULL").select("doc_id", "first").distinct()
    ends = (
        links.join(firsts.select(F.col("doc_id").alias("a"), F.col("first").alias("fa")), "a")
        .join(firsts.select(F.col("doc_id").alias("b"), F.col("first").alias("fb")), "b")
        .select(F.col("fa").alias("a"), F.col("fb").alias("b"))
    )
    # rows that share an id connect their sets
    ends = ends.unionByName(
        firsts.filter("doc_id != first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
        .join(firsts.filter("doc_id = first").select(F.col("doc_id").alias("a")), "a", "left_semi")
    )
    named = few(materialize(components(ends).select(F.col("node").alias("first"), "component"), "named"))
    return owners.join(named, "first", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "first").alias("component_id")
    )


def _sql() -> str:
    """All pairs that share a shingle, compared; groups by reachability."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lowered}, '[^\\x20\\x09-\\x0D]+')"
    following = "".join(f" || ' ' || lead(word, {k}) OVER o" for k in range(1, WORDS))
    return f"""
    WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
    t AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
    g AS (SELECT r, word{following} AS x FROM t WINDOW o AS (PARTITION BY r ORDER BY i)),
    s AS (SELECT DISTINCT r, x FROM g WHERE x IS NOT NULL UNION ALL
      SELECT r, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND {WORDS - 1}),
    sets AS (SELECT r, count(*) AS n, md5(string_agg(x, '|' ORDER BY x)) AS k FROM s GROUP BY r),
    one AS (SELECT min(r) AS c, k, any_value(n) AS n FROM sets GROUP BY k),
    x AS (SELECT c, n, x FROM one JOIN s ON s.r = one.c),
    p AS (SELECT a.c AS a, b.c AS b, a.n + b.n AS total, count(*) AS shared FROM x a JOIN x b ON a.x = b.x AND a.c < b.c
      AND 100 * least(a.n, b.n) >= {SIMILARITY} * greatest(a.n, b.n) GROUP BY ALL),
    l AS (SELECT a, b FROM p WHERE 100 * shared >= {SIMILARITY} * (total - shared)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    reach AS (SELECT c AS a, c AS b FROM one UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
    owners AS (SELECT w.doc_id, coalesce(sets.n, 0) AS n, one.c FROM w LEFT JOIN sets ON sets.r = w.r LEFT JOIN one ON one.k = sets.k),
    least AS (SELECT reach.a AS c, min(o.doc_id) AS d FROM reach JOIN owners o ON o.c = reach.b GROUP BY reach.a)
    SELECT o.doc_id, o.n AS n_shingles, CASE WHEN o.doc_id IS NOT NULL THEN coalesce(d, o.doc_id) END AS component_id
    FROM owners o LEFT JOIN least ON least.c = o.c
    """


@query("op4_jaccard_join", _sql())
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))
