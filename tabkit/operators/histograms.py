"""Regression trees over histograms: columns are binned once, a level of a tree is one pass.

``prepare`` writes the rows with one byte a column.  No tree can tell rows of equal bins apart,
so they are added up first (``cells``): a fit passes over the rows once, a forest once a round
and once more to score them (not if it is of few trees in all), and all levels pass over the cells.  A level of any number of
trees is one scan: every task adds up (weight, sum) by tree, open node, column and bin, a
shuffle of one row a node brings the tasks' histograms together, the best cut of each node is
found there, and the driver sees one row a node.  Trees of several fits (the folds of a
cross-validation) are slots of the same passes and cost no passes of their own.

Bagging draws how often a row counts in a tree from the row's key, so the same rows are
drawn under any layout, and scores every row by the trees that did not draw it (out of bag).
Boosting keeps the sum of the trees so far beside each cell; a round re-bins nothing.

Rows without a target take no part.  A missing value (NULL or NaN) is below all others.
Ties between cuts go to the column named first, then to the lower value.

Spark's own expressions bin the rows and add them up.  Arrow batches and numpy inside the tasks
do the counting by column: an explode over columns and a hash aggregate would handle every
column of a cell as a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.folds import Patience
from tabkit.functions.hashing import hex_cut
from tabkit.operators import sums
from tabkit.session import materialize, reach_workers, small_side, spread

# Bins of a column: as many as fit one byte, and as many as suffice for most columns.
MAX_BINS, BINS = 128, 64
# Tree settings the published metrics were reached with.
FOREST_STEP, FOREST_MAX, FOREST_PATIENCE, FOREST_DEPTH = 10, 400, 5, 10
BOOST_ROUNDS, BOOST_RATE, BOOST_DEPTH, BOOST_PATIENCE = 500, 0.1, 4, 15
GAIN = 1e-4
# Rounds after which the running sums are written, so that no lost executor repeats them all.
CUT_EVERY = 10
# Least likely number of draws that is told from the next larger one: 1 in 2**32.
DRAWS = 12
# Rows that a task looks at together when it adds up equal ones, and rows of a batch it returns.
ROWS_AT_ONCE, BATCH_OUT = 1 << 18, 1 << 14
# Rows that are packed as one value.
ROWS_OF_BLOCK = 1 << 16
# Most trees of a forest of one round whose out-of-bag rows are added up by the trees that left them out.
ALIKE = 4


@dataclass(frozen=True)
class Bins:
    """Columns and their cuts: bin b of a column holds values up to ``edges[b]``."""

    columns: tuple[str, ...]
    edges: tuple[np.ndarray, ...]

    def offsets(self) -> np.ndarray:
        """Where each column's bins begin in a row of all bins; the last entry is their number."""
        return np.concatenate([[0], np.cumsum([len(e) + 1 for e in self.edges])])

    def code(self, i: int, values: np.ndarray) -> np.ndarray:
        clean = np.where(np.isnan(values), -np.inf, values)
        return np.searchsorted(self.edges[i], clean, side="left").astype(np.int8)


def fit_bins(df: DataFrame, columns: Sequence[str], most: int = BINS) -> Bins:
    """Cuts between all values of columns of at most ``most`` values, else at quantiles."""
    if not 2 <= most <= MAX_BINS:
        raise ValueError(f"between 2 and {MAX_BINS} bins")
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    shares = [i / most for i in range(1, most)]
    row = df.agg(*[F.approx_count_distinct(value[c]).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    # columns that may have few values are looked at exactly: at most twice as many rows each
    few = [i for i in range(len(columns)) if row[f"n{i}"] <= 1.2 * most]
    found: dict[int, list[float]] = {}
    if few:
        pairs = F.array(*[F.struct(F.lit(i).alias("i"), value[columns[i]].alias("v")) for i in few])
        for r in df.select(F.explode(pairs).alias("p")).select("p.*").filter("v IS NOT NULL").distinct().collect():
            found.setdefault(r["i"], []).append(r["v"])
    edges = {}
    for i in few:
        values = np.unique(found.get(i, []))
        if 0 < len(values) <= most:
            edges[i] = (values[:-1] + values[1:]) / 2
    # quantiles cost more than any other look at a column, so only those that need them get them
    many = [i for i in range(len(columns)) if i not in edges]
    if many:
        row = df.agg(*[F.percentile_approx(value[columns[i]], shares, 10_000).alias(f"q{i}") for i in many]).first()
        edges |= {i: np.unique(np.array(row[f"q{i}"] or [], float)) for i in many}
    return Bins(tuple(columns), tuple(edges[i] for i in range(len(columns))))


def prepare(
    df: DataFrame, bins: Bins, target: str, keep: Mapping[str, Column], keys: Sequence[str], parts: int | None = None
) -> DataFrame:
    """Written rows: ``_y``, a byte ``_x<i>`` for each column, and the ``keep`` columns."""
    dealt = spread(df.filter(F.col(target).isNotNull()), keys, parts)
    features = {f"_v{i}": F.col(c).cast("double") for i, c in enumerate(bins.columns)}
    source = dealt.select(F.col(target).cast("double").alias("_y"), *[c.alias(n) for n, c in (keep | features).items()])
    coded = with_codes(source, bins, list(features), [f"_x{i}" for i in range(len(features))])
    return materialize(coded.drop(*features), "binned")


def with_codes(df: DataFrame, bins: Bins, values: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``df`` with the bins of its columns ``values`` as bytes, as ``Bins.code`` has them.

    A bin of Spark's begins with its lower edge, one of ours ends with its upper: so the
    negative values are looked up among the negative edges, and counted from the other end.
    """
    codes, splits = {}, {}
    for edges, v, name in zip(bins.edges, values, names):
        value = F.coalesce(F.nanvl(F.col(v), F.lit(-math.inf)), F.lit(-math.inf))
        inner = edges[np.isfinite(edges)]
        codes[name] = F.when(value > -math.inf, F.lit(int((edges == -math.inf).sum()))).otherwise(0)
        if len(inner):
            df = df.withColumn(f"_n{name}", F.lit(0.0) - value)
            splits[f"_n{name}"] = [-math.inf, *(0.0 - inner[::-1]).tolist(), math.inf]
            codes[name] = codes[name] + len(inner) - F.col(f"_b_n{name}").cast("int")
    if splits:
        cut = Bucketizer(splitsArray=list(splits.values()), inputCols=list(splits), outputCols=[f"_b{c}" for c in splits])
        df = cut.transform(df)
    coded = df.withColumns({name: c.cast("byte") for name, c in codes.items()})
    return coded.drop(*splits, *[f"_b{c}" for c in splits])


@dataclass
class Tree:
    """Nodes in the order they were made; the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    weight: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def add(self, value: float, weight: float) -> int:
        for name, new in (("feature", -1), ("cut", 0), ("left", 0), ("value", value), ("weight", weight), ("gain", 0.0)):
            getattr(self, name).append(new)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, gain: float, sides) -> list[int]:
        """Give a node its two children; ``sides`` are their (weight, sum)."""
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        children = [self.add(s / w, w) for w, s in sides]
        self.left[node] = children[0]
        return children

    def depth(self) -> int:
        deep = [0] * len(self.feature)
        for node, f in enumerate(self.feature):
            if f >= 0:
                deep[self.left[node]] = deep[self.left[node] + 1] = deep[node] + 1
        return max(deep)

    def packed(self) -> tuple:
        """Arrays for ``walk``; a leaf leads to itself, as no bin is above its cut."""
        feature, left = np.array(self.feature, np.int32), np.array(self.left, np.int32)
        leaf = feature < 0
        cut = np.where(leaf, MAX_BINS, np.array(self.cut)).astype(np.int16)
        left = np.where(leaf, np.arange(len(left)), left).astype(np.int32)
        return np.where(leaf, 0, feature), cut, left, np.array(self.value), self.depth()


def walk(packed: tuple, x: np.ndarray) -> np.ndarray:
    """The node each row of bins ends in."""
    feature, cut, left, _, depth = packed
    node = np.zeros(len(x), np.int32)
    flat, first = x.ravel(), np.arange(len(x)) * x.shape[1]
    for _ in range(depth):
        node = left.take(node) + (flat.take(first + feature.take(node)) > cut.take(node))
    return node


def _bytes(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
    return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0), np.int8)


def _of_any(table: DataFrame, flags: Sequence[str]) -> DataFrame:
    """The rows that any of the 0/1 columns names."""
    return table.filter(F.greatest(F.lit(0), *[F.col(c) for c in flags]) > 0)


def blocks(rows: DataFrame) -> DataFrame:
    """The rows packed, some at a time, as the bytes of an Arrow stream.

    Cells are read once a level; handing a task many columns of small values, row by row, costs
    more than all it does with them.
    """

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS_OF_BLOCK:
                yield _packed(held)
                held, size = [], 0
        if size:
            yield _packed(held)

    return rows.mapInArrow(run, "block binary")


def _packed(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    whole, sink = pa.Table.from_batches(batches).combine_chunks(), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, whole.schema) as out:
        out.write_table(whole)
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that ``blocks`` packed."""
    for batch in batches:
        for block in batch.column("block"):
            yield from pa.ipc.open_stream(block.as_buffer())


# Count, sum and squares about the mean of the targets of a cell.
MOMENTS = ["_cell_n", "_cell_t", "_cell_q"]


def _merged(codes: np.ndarray, values: np.ndarray, moments: bool) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows of bytes as one, their values added up in the order they come."""
    n, width = codes.shape
    padded = np.zeros((n, 8 * max(1, -(-width // 8))), np.int8)
    padded[:, :width] = codes
    words = padded.view(np.uint64)
    order = np.lexsort(words.T) if words.shape[1] > 1 else np.argsort(words[:, 0], kind="stable")
    words, values = words[order], values[order]
    first = np.r_[True, (words[1:] != words[:-1]).any(axis=1)]
    starts = np.flatnonzero(first)
    added = np.add.reduceat(values, starts, axis=0)
    if moments:
        apart = values[:, 1] / values[:, 0] - (added[:, 1] / added[:, 0])[np.cumsum(first) - 1]
        added[:, 2] += np.add.reduceat(values[:, 0] * apart * apart, starts)
    return codes[order[starts]], added


def _adding(keys: Sequence[str], named: Sequence[str], moments: bool):
    """A task's rows of equal ``keys`` added up, as far as they come near each other."""

    def told(codes, values):
        for i in range(0, len(codes), BATCH_OUT):
            some, v = codes[i : i + BATCH_OUT], values[i : i + BATCH_OUT]
            arrays = [pa.array(np.ascontiguousarray(c)) for c in (*some.T, *v.T)]
            yield pa.RecordBatch.from_arrays(arrays, [*keys, *named])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append((_bytes(batch, keys), np.column_stack([batch.column(c).to_numpy() for c in named])))
                size += batch.num_rows
            if size >= ROWS_AT_ONCE:
                held = [_merged(*map(np.concatenate, zip(*held)), moments)]
                size = len(held[0][0])
                if 2 * size > ROWS_AT_ONCE:  # few are equal: they go on as they are
                    yield from told(*held[0])
                    held, size = [], 0
        if held:
            yield from told(*_merged(*map(np.concatenate, zip(*held)), moments))

    return run


def _moments() -> dict[str, Column]:
    """The ``MOMENTS`` of the target as aggregates."""
    n, y = F.count("_y").cast("double"), F.col("_y")
    return dict(zip(MOMENTS, (n, F.sum(y), F.var_pop(y) * n)))


def cells(
    table: DataFrame, bins: Bins, flags: Sequence[str], figures: Mapping[str, Column] | None = None, also: Sequence[str] = ()
) -> DataFrame:
    """Rows of equal bins and flags as one: ``_x<i>``, the flags, and ``figures``, added up.

    ``figures`` are aggregates, by default the ``MOMENTS`` of the target; others add up as sums
    behind these.  Only rows that a flag names are there; the bytes ``also`` keep rows apart as
    flags do, but name none.  Spark adds up the rows of a partition; a cell of several partitions
    is added up in their order, and may come more than once where it is large.
    """
    reach_workers(table.sparkSession)
    keys = [*[f"_x{i}" for i in range(len(bins.columns))], *flags, *also]
    figures = figures or _moments()
    named, moments = list(figures), list(figures)[:3] == MOMENTS

    fields = [*[T.StructField(c, T.ByteType()) for c in keys], *[T.StructField(c, T.DoubleType()) for c in named]]
    clean = {c: F.coalesce(F.col(c), F.lit(0)).cast("byte") for c in [*flags, *also]}
    source = _of_any(table, flags).withColumns(clean | {"_cell_part": F.spark_partition_id()})
    parts = source.groupBy(*keys, "_cell_part").agg(*[c.alias(n) for n, c in figures.items()])
    met = parts.repartition(*keys).sortWithinPartitions(*keys, "_cell_part").select(*keys, *named)
    return materialize(met.mapInArrow(_adding(keys, named, moments), T.StructType(fields)), "cells")


# A view turns a batch into (tree, weights, weighted sums of targets).  A negative tree carries
# figures to be added up instead: (-1 - tree, None, array of three).
View = Callable[[pa.RecordBatch, np.ndarray], Iterator[tuple[int, np.ndarray | None, np.ndarray]]]

# Histograms of some open nodes of a tree, ``first`` the place of the first among the open ones.
CELLS = "tree int, first int, weights binary, sums binary"
CUTS = "tree int, node int, feature int, cut int, gain double, weight double, total double, w_left double, s_left double"
# Bytes of histograms that tasks may hand to the driver directly; beyond, they are shuffled.
DIRECT_BYTES = 16 << 20
# Open nodes of a tree that go together.
NODES_AT_ONCE = 128


def _added(rows) -> dict[tuple[int, int], list[np.ndarray]]:
    """Histograms of the same nodes added up, in the order of trees and nodes."""
    cells: dict[tuple[int, int], list[np.ndarray]] = {}
    for r in rows:
        both = [np.frombuffer(r[c]) for c in ("weights", "sums")]
        key = (r["tree"], r["first"])
        cells[key] = [a + b for a, b in zip(cells[key], both)] if key in cells else both
    return dict(sorted(cells.items()))


def _best_cuts(cells, open_nodes: Mapping[int, Sequence[int]], offsets: np.ndarray, least: float) -> list[tuple]:
    """A row as in ``CUTS`` for each node that has rows: its best cut, feature -1 if it has none."""
    out = []
    for (t, first), both in cells.items():
        if t < 0:
            out.append((t, 0, -1, 0, 0.0, *both[0][:3].tolist(), 0.0))
            continue
        w, s = (v.reshape(-1, offsets[-1]) for v in both)
        some = np.flatnonzero(w.any(1))
        w, s = w[some], s[some]
        total, whole = w[:, : offsets[1]].sum(1), s[:, : offsets[1]].sum(1)
        best = np.zeros(len(some))
        found = [np.full(len(some), -1), np.zeros(len(some), int), np.zeros(len(some)), np.zeros(len(some))]
        rows = np.arange(len(some))
        for f in range(len(offsets) - 1):
            part = slice(offsets[f], offsets[f + 1])
            wl, sl = np.cumsum(w[:, part], 1)[:, :-1], np.cumsum(s[:, part], 1)[:, :-1]
            if not wl.shape[1]:
                continue
            wr, sr = total[:, None] - wl, whole[:, None] - sl
            fits = (wl >= least) & (wr >= least) & (wl > 0) & (wr > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(fits, sl * sl / wl + sr * sr / wr - (whole * whole / total)[:, None], -np.inf)
            b = gain.argmax(1)
            better = gain[rows, b] > best
            best = np.where(better, gain[rows, b], best)
            for i, new in enumerate((np.full(len(some), f), b, wl[rows, b], sl[rows, b])):
                found[i] = np.where(better, new, found[i])
        columns = [found[0], found[1], best, total, whole, found[2], found[3]]
        nodes = [open_nodes[t][first + i] for i in some.tolist()]
        out += [(t, node, *r) for node, r in zip(nodes, zip(*[c.tolist() for c in columns]))]
    return out


def _cuts_of(open_nodes: Mapping[int, Sequence[int]], offsets: np.ndarray, least: float):
    def run(batches):
        out = _best_cuts(_added(r for batch in batches for r in batch.to_pylist()), open_nodes, offsets, least)
        if out:
            types = [pa.int32()] * 4 + [pa.float64()] * 5
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays(arrays, [p.split()[0] for p in CUTS.split(", ")])

    return run


def level(
    table: DataFrame,
    bins: Bins,
    view: View,
    trees: Mapping[int, Tree],
    open_nodes: Mapping[int, Sequence[int]],
    least: float,
) -> list[tuple]:
    """The best cut of every open node of every tree (as in ``CUTS``), in one pass over ``table``, of ``blocks``."""
    offsets = bins.offsets()
    n, width = len(bins.columns), int(offsets[-1])
    names = [f"_x{i}" for i in range(n)]
    packed = {t: trees[t].packed() for t in open_nodes}
    place = {}
    for t, nodes in open_nodes.items():
        place[t] = np.full(len(trees[t].feature), -1)
        place[t][list(nodes)] = np.arange(len(nodes))

    def run(batches):
        cells: dict[int, list[np.ndarray]] = {}
        for batch in _unpacked(batches):
            x = _bytes(batch, names)
            codes = x.T.copy()
            for t, weights, added in view(batch, x):
                if t < 0:
                    found = [added, added]
                elif t in place:
                    at = place[t][walk(packed[t], x)]
                    rows = np.flatnonzero((at >= 0) & (weights > 0))
                    at, both, many = at[rows], (weights[rows], added[rows]), len(open_nodes[t])
                    found = [np.empty((many, width)), np.empty((many, width))]
                    for f in range(n):
                        bins_of = int(offsets[f + 1] - offsets[f])
                        index = at * bins_of + codes[f][rows]
                        for h, v in zip(found, both):
                            h[:, offsets[f] : offsets[f + 1]] = np.bincount(index, v, many * bins_of).reshape(many, bins_of)
                else:
                    continue
                cells[t] = [a + b for a, b in zip(cells[t], found)] if t in cells else found
        out = []
        for t, both in cells.items():
            for i in range(0, len(open_nodes[t]) if t >= 0 else 1, NODES_AT_ONCE):
                w, h = (v[i : i + NODES_AT_ONCE] if t >= 0 else v for v in both)
                if t < 0 or w.any():
                    out.append((t, i, w.tobytes(), h.tobytes()))
        if out:
            types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["tree", "first", "weights", "sums"])

    parts = table.mapInArrow(run, CELLS)
    tasks = table.rdd.getNumPartitions() if table.storageLevel.useMemory else 1 << 30
    if tasks * sum(map(len, open_nodes.values())) * width * 16 <= DIRECT_BYTES:
        return _best_cuts(_added(parts.collect()), open_nodes, offsets, least)
    return [tuple(r) for r in parts.repartition("tree", "first").mapInArrow(_cuts_of(open_nodes, offsets, least), CUTS).collect()]


def grow(
    table: DataFrame,
    bins: Bins,
    view: View,
    ids: Sequence[int],
    depth: int,
    least: float = 1.0,
    min_gain: float = 0.0,
    judge: Callable[[dict[int, tuple]], set[int]] | None = None,
) -> dict[int, Tree]:
    """Trees of at most ``depth`` levels, all grown by the same passes over ``table``, of ``blocks``.

    A cut needs ``least`` weight on both sides, and must lower the squared error by more
    than ``min_gain`` a unit of the root's weight.  Trees without any row are left out.
    ``judge`` sees the view's own figures after the first level and says which trees go on.
    """
    trees = {t: Tree() for t in ids}
    open_nodes: dict[int, list[int]] = {t: [0] for t in ids}
    for step in range(max(depth, 1)):
        found = level(table, bins, view, trees, open_nodes, least)
        if not step and judge:
            kept = judge({-1 - t: row for t, _, _, _, _, *row in found if t < 0})
            trees = {t: tree for t, tree in trees.items() if t in kept}
        open_nodes = {}
        for t, node, feature, cut, gain, weight, whole, w_left, s_left in sorted(found):
            if t not in trees:
                continue
            tree = trees[t]
            if node == 0:
                tree.value[0], tree.weight[0] = whole / weight, weight
            if depth and feature >= 0 and gain > 1e-12 and gain > min_gain * tree.weight[0]:
                sides = [(w_left, s_left), (weight - w_left, whole - s_left)]
                open_nodes.setdefault(t, []).extend(tree.split(node, feature, cut, gain, sides))
        if not open_nodes:
            break
    return {t: tree for t, tree in trees.items() if tree.weight[0]}


NODES = "tree int, share double, node int, feature int, threshold double, cut int, left int, value double, weight double, gain double"


@dataclass
class Ensemble:
    """A weighted sum of trees on raw columns."""

    bins: Bins
    trees: list[Tree]
    shares: list[float]
    per_tree: bool = True  # importances: each tree counts the same, or by what it gained

    def of_codes(self, codes: np.ndarray) -> np.ndarray:
        """Predictions of binned rows."""
        total = np.zeros(len(codes))
        for tree, share in zip(self.trees, self.shares):
            packed = tree.packed()
            total += share * packed[3][walk(packed, codes)]
        return total

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the prediction, from the columns of the same names."""
        reach_workers(df.sparkSession)
        model = df.sparkSession.sparkContext.broadcast(self)  # as large as the model

        @F.pandas_udf("double")
        def predict(values: pd.DataFrame) -> pd.Series:
            m = model.value
            columns = [values.iloc[:, i].to_numpy(float, na_value=np.nan) for i in range(values.shape[1])]
            return pd.Series(m.of_codes(np.column_stack([m.bins.code(i, v) for i, v in enumerate(columns)])))

        inputs = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(self.bins.columns)]
        return df.withColumn(out, predict(F.struct(*inputs)))

    def importances(self) -> dict[str, float]:
        """Share of each column in what the cuts gained."""
        total = np.zeros(len(self.bins.columns))
        for tree in self.trees:
            gained = np.bincount(
                [f for f in tree.feature if f >= 0], [g for f, g in zip(tree.feature, tree.gain) if f >= 0], len(total)
            )
            total += gained / gained.sum() if self.per_tree and gained.sum() else gained
        total = total / total.sum() if total.sum() else total
        return dict(zip(self.bins.columns, total.tolist()))

    def threshold(self, feature: int, cut: int) -> float:
        return float(self.bins.edges[feature][cut])

    def save(self, spark: SparkSession, path: str) -> str:
        """The model as two Parquet tables: nodes, and columns with their cuts."""
        rows = [
            (t, float(share), i, f, self.threshold(f, c) if f >= 0 else None, c, left, float(value), float(w), float(g))
            for t, (tree, share) in enumerate(zip(self.trees, self.shares))
            for i, (f, c, left, value, w, g) in enumerate(
                zip(tree.feature, tree.cut, tree.left, tree.value, tree.weight, tree.gain)
            )
        ]
        spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        columns = [(i, c, e.tolist(), self.per_tree) for i, (c, e) in enumerate(zip(self.bins.columns, self.bins.edges))]
        named = spark.createDataFrame(columns, "i int, name string, edges array<double>, per_tree boolean")
        named.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
        return path


def load(spark: SparkSession, path: str) -> Ensemble:
    """A model stored by ``Ensemble.save``."""
    columns = sorted(spark.read.parquet(f"{path}/columns").collect(), key=lambda r: r["i"])
    bins = Bins(tuple(r["name"] for r in columns), tuple(np.array(r["edges"], float) for r in columns))
    trees: dict[int, Tree] = {}
    shares: dict[int, float] = {}
    for r in sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: (r["tree"], r["node"])):
        tree = trees.setdefault(r["tree"], Tree([], [], [], [], [], []))
        shares[r["tree"]] = r["share"]
        for name in ("feature", "cut", "left", "value", "weight", "gain"):
            getattr(tree, name).append(r[name])
    return Ensemble(bins, [trees[t] for t in sorted(trees)], [shares[t] for t in sorted(trees)], columns[0]["per_tree"])


def decision_trees(
    table: DataFrame, bins: Bins, slots: Sequence[str], depth: int, least: float, min_gain: float, added: DataFrame | None = None
) -> list[Ensemble]:
    """One tree for each slot, a 0/1 column of the rows to learn from; all in the same passes.

    ``added`` hands in the ``cells`` of the table by these flags or more, if there are any yet.
    """

    def view(batch, x):
        n, t = (batch.column(c).to_numpy() for c in MOMENTS[:2])
        for s, name in enumerate(slots):
            inside = batch.column(name).to_numpy(zero_copy_only=False)
            yield s, inside * n, inside * t

    rows = cells(table, bins, slots) if added is None else _of_any(added, slots)
    rows = rows.select(*[f"_x{i}" for i in range(len(bins.columns))], *MOMENTS[:2], *slots)
    rows = blocks(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trees = grow(rows, bins, view, range(len(slots)), depth, least, min_gain)
    finally:
        rows.unpersist()
    if len(trees) < len(slots):
        raise ValueError("a slot has no rows to learn from")
    return [Ensemble(bins, [trees[s]], [1.0]) for s in range(len(slots))]


def drawn(hashed: Column, tree: int) -> Column:
    """How often a row counts in a tree: Poisson of mean 1, from the row's key hash.

    One md5 serves four trees, eight hex digits each.
    """
    digits, times = _digits(hashed, tree), F.lit(0)
    for cut in draw_cuts():
        times = times + F.when(digits >= cut, 1).otherwise(0)
    return times.cast("byte")


def left_out(hashed: Column, trees: Sequence[int]) -> Column:
    """Whether any of the trees does not draw the row."""
    return F.least(*[_digits(hashed, t) for t in trees], F.lit("g")) < draw_cuts()[0]


def _digits(hashed: Column, tree: int) -> Column:
    return F.substring(F.md5(F.concat(F.lit(f"bag-{tree // 4}-"), hashed)), tree % 4 * 8 + 1, 8)


def draw_cuts() -> list[str]:
    """Hex digits from which on a row is drawn once, twice, ..."""
    reached, cuts = 0.0, []
    for k in range(DRAWS):
        reached += math.exp(-1) / math.factorial(k)
        cuts.append(hex_cut(reached))
    return cuts


def _times(table: DataFrame, key: str, trees: Sequence[int], names: Sequence[str]) -> DataFrame:
    """``table`` with the draws of the trees as ``drawn`` has them, as doubles, each md5 taken once."""
    hashed = {t // 4: F.md5(F.concat(F.lit(f"bag-{t // 4}-"), F.col(key))) for t in trees}
    table = table.withColumns({f"_d{g}": F.coalesce(d, F.lit("0" * 32)) for g, d in hashed.items()})
    table = table.withColumns({f"_8{t}": F.substring(f"_d{t // 4}", t % 4 * 8 + 1, 8) for t in trees})
    cuts, found = draw_cuts(), {}
    for name, t in zip(names, trees):
        found[name] = F.when(F.col(f"_8{t}") < cuts[0], 0.0)
        for k in range(1, DRAWS):
            found[name] = found[name].when(F.col(f"_8{t}") < cuts[k], float(k))
        found[name] = found[name].otherwise(float(DRAWS))
    return table.withColumns(found)


def _digests(key: str, trees: Sequence[int]) -> list[Column]:
    """``_d<g>``: the bytes that four trees' draws are read from; a row without a hash is never drawn."""
    found = {t // 4: F.unhex(F.md5(F.concat(F.lit(f"bag-{t // 4}-"), F.col(key)))) for t in trees}
    return [F.coalesce(d, F.unhex(F.lit("00" * 16))).alias(f"_d{g}") for g, d in found.items()]


def _draws(batch: pa.RecordBatch, trees: Sequence[int], cuts: np.ndarray) -> np.ndarray:
    """How often each row counts in each of the trees, as ``drawn`` has it."""
    out, digits = np.empty((batch.num_rows, len(trees)), np.int8), {}
    for j, t in enumerate(trees):
        if t // 4 not in digits:
            joined = b"".join(batch.column(f"_d{t // 4}").to_pylist())
            digits[t // 4] = np.frombuffer(joined, ">u4").astype(np.uint32).reshape(-1, 4)
        out[:, j] = np.searchsorted(cuts, digits[t // 4][:, t % 4], "right")
    return out


def _explained(n: float, s: float, ss: float, error: float) -> float:
    """R² from the count, sum and squared sum of the targets and the squared error."""
    spread_of = ss - s * s / n if n else 0.0
    return 1.0 - error / spread_of if spread_of > 0 else 0.0


def forests(
    table: DataFrame,
    bins: Bins,
    key: str,
    slots: Sequence[str],
    step: int = FOREST_STEP,
    most: int = FOREST_MAX,
    patience: int = FOREST_PATIENCE,
    depth: int = FOREST_DEPTH,
    least: float = 1.0,
) -> tuple[list[Ensemble], list[tuple[int, int, float]]]:
    """A bagged forest for each slot, grown by ``step`` trees until out-of-bag R² stops gaining.

    ``key`` holds the hash of the row's key.  Every row keeps the sum, and the number, of the
    trees that did not draw it.  Returns the forests at their best size, and (slot, size,
    out-of-bag R²) by round.
    """
    names = [f"_x{i}" for i in range(len(bins.columns))]
    weights, drawn_sums, times = ([f"{c}{j}" for j in range(step)] for c in ("_cell_n", "_cell_t", "_times"))
    states = [c for s in range(len(slots)) for c in (f"_o{s}", f"_m{s}")]
    fixed = ["_y", key, *slots]
    cuts = np.array([int(c, 16) for c in draw_cuts()], np.uint32)
    rows = _of_any(table, slots).select(*names, *fixed, *[F.lit(0.0).alias(c) for c in states])
    schema = rows.schema
    grown: dict[int, list[Tree]] = {s: [] for s in range(len(slots))}
    rules = {s: Patience(patience, GAIN) for s in range(len(slots))}
    alive, records, size = list(range(len(slots))), [], 0
    while alive and size < most:
        ids = range(size, size + step)

        def view(batch, x, alive=tuple(alive)):
            n, t = (_bytes(batch, c) for c in (weights, drawn_sums))
            for s in alive:
                inside = batch.column(slots[s]).to_numpy(zero_copy_only=False)
                for j in range(step):
                    yield s * step + j, inside * n[:, j], inside * t[:, j]

        digests = _digests(key, ids)
        bagged = _times(rows, key, ids, times)
        by_tree = {w: F.sum(c) for w, c in zip(weights, times)} | {t: F.sum(F.col(c) * F.col("_y")) for t, c in zip(drawn_sums, times)}
        alike = size + step >= most and not size and step <= ALIKE
        if alike:  # rows of equal bins that the same trees leave out get the same score
            out = sum((F.when(F.col(c) == 0, 1 << j).otherwise(0) for j, c in enumerate(times)), F.lit(0)).cast("byte")
            left = cells(bagged.withColumn("_out", out), bins, slots, _moments() | by_tree, ["_out"])
            bag = cells(left, bins, slots, {c: F.sum(c) for c in by_tree})
        else:
            bag = cells(bagged, bins, slots, by_tree)
        bag = blocks(bag).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            new = grow(bag, bins, view, [s * step + j for s in alive for j in range(step)], depth, least)
        finally:
            bag.unpersist()
        packed = {s: [new[s * step + j].packed() if s * step + j in new else None for j in range(step)] for s in alive}
        size += step

        def scored(batch, packed=packed, alive=tuple(alive), ids=ids):
            """The sum and number of the trees that did not draw a row, with the new ones."""
            x, times, found = _bytes(batch, names), _draws(batch, ids, cuts), {}
            for s in alive:
                inside = batch.column(slots[s]).to_numpy(zero_copy_only=False) > 0
                total, many = (batch.column(f"{c}{s}").to_numpy().copy() for c in ("_o", "_m"))
                for j, tree in enumerate(packed[s]):
                    if tree is not None:
                        out = np.flatnonzero(inside & (times[:, j] == 0))
                        total[out] += tree[3][walk(tree, x[out])]
                        many[out] += 1
                found[f"_o{s}"], found[f"_m{s}"] = total, many
            return found

        def score(batches, scored=scored):
            for batch in batches:
                columns = {c: batch.column(c) for c in [*names, *fixed, *states]}
                columns |= {c: pa.array(v) for c, v in scored(batch).items()}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        def written(batch):
            return {c: batch.column(c).to_numpy() for c in states}

        def figures(batch, state_of, alive=tuple(alive)):
            y, state, out = batch.column("_y").to_numpy(), state_of(batch), []
            for s in alive:
                total, many = state[f"_o{s}"], state[f"_m{s}"]
                told = many > 0
                t = y[told]
                e = t - total[told] / many[told]
                out += [len(t), t.sum(), (t * t).sum(), (e * e).sum()]
            return np.array(out, float)

        def figures_alike(batch, packed=packed, alive=tuple(alive)):
            x, found = _bytes(batch, names), []
            n, t, q = (batch.column(c).to_numpy() for c in MOMENTS)
            left_out_by = batch.column("_out").to_numpy()
            for s in alive:
                inside = batch.column(slots[s]).to_numpy() > 0
                total, many = np.zeros(len(x)), np.zeros(len(x))
                for j, tree in enumerate(packed[s]):
                    if tree is not None:
                        out = np.flatnonzero(inside & (left_out_by >> j & 1 > 0))
                        total[out] += tree[3][walk(tree, x[out])]
                        many[out] += 1
                told = many > 0
                m, mean = n[told], t[told] / n[told]
                e = mean - total[told] / many[told]
                found += [m.sum(), t[told].sum(), (q[told] + m * mean * mean).sum(), (q[told] + m * e * e).sum()]
            return np.array(found, float)

        drawn_rows = rows.select(*names, *fixed, *states, *digests)
        if alike:
            rows, figures_in = left, figures_alike
        elif size < most:
            rows = materialize(drawn_rows.mapInArrow(score, schema), "bag")
            figures_in = partial(figures, state_of=written)
        else:  # nothing comes after the last trees, so what they add is not written
            rows = drawn_rows
            figures_in = partial(figures, state_of=scored)
        needed = ["_y", *states] if size < most else rows.columns
        found = sums.total(rows, needed, lambda batch, f=figures_in: {0: f(batch)}, 4 * len(alive))
        figures_of = found.get(0, np.zeros(4 * len(alive)))
        for i, s in enumerate(alive):
            grown[s] += [new[s * step + j] for j in range(step) if s * step + j in new]
            records.append((s, size, float(_explained(*figures_of[4 * i : 4 * i + 4]))))
        alive = [s for i, s in enumerate(alive) if rules[s].goes_on(size, records[i - len(alive)][2])]
    models = []
    for s in range(len(slots)):
        trees = grown[s][: rules[s].best_step]
        if not trees:
            raise ValueError("a slot has no rows to learn from")
        models.append(Ensemble(bins, trees, [1.0 / len(trees)] * len(trees)))
    return models, records


def boosted(
    table: DataFrame,
    bins: Bins,
    slots: Sequence[tuple[str, str | None]],
    rounds: int = BOOST_ROUNDS,
    rate: float = BOOST_RATE,
    depth: int = BOOST_DEPTH,
    patience: int = BOOST_PATIENCE,
    least: float = 1.0,
    added: DataFrame | None = None,
) -> tuple[list[Ensemble], list[tuple[int, int, float]]]:
    """Least-squares boosting for each slot, with patience; the best rounds are kept.

    A slot names the 0/1 columns of the rows to learn from and of those to watch (None: no
    watching, all rounds are run).  The loss is the share of the watched rows' variance left
    unexplained, so the gain asked for suits any target.  ``added`` is as for
    ``decision_trees``.  Returns the models, and (slot, round, loss).
    """
    names = [f"_x{i}" for i in range(len(bins.columns))]
    used = sorted({c for pair in slots for c in pair if c})
    columns_of_sums = [f"_s{s}" for s in range(len(slots))]
    ids = range(len(slots))
    rows = cells(table, bins, used) if added is None else _of_any(added, used)
    rows = rows.select(*names, *used, *MOMENTS, *[F.lit(0.0).alias(c) for c in columns_of_sums])
    rows = blocks(rows).persist(StorageLevel.MEMORY_AND_DISK)
    models: list[list[Tree]] = [[] for _ in ids]
    rules = {s: Patience(patience, GAIN) for s in ids}
    recent: dict[int, list[tuple[float, tuple]]] = {s: [] for s in ids}
    alive, records, spreads = list(ids), [], {}

    def current(batch, x, s, recent):
        total = batch.column(f"_s{s}").to_numpy().copy()
        for share, tree in recent[s]:
            total += share * tree[3][walk(tree, x)]
        return total

    try:
        # the first pass finds the means; each later one also tells what its predecessor reached
        for k in range(rounds + 2):
            frozen = {s: list(recent[s]) for s in alive}

            def view(batch, x, alive=tuple(alive), frozen=frozen):
                n, t, q = (batch.column(c).to_numpy() for c in MOMENTS)
                for s in alive:
                    called = current(batch, x, s, frozen)
                    inside = batch.column(slots[s][0]).to_numpy(zero_copy_only=False)
                    yield s, inside * n, inside * (t - n * called)
                    if slots[s][1]:
                        held = batch.column(slots[s][1]).to_numpy(zero_copy_only=False) > 0
                        e, m = (t / n - called)[held], n[held]
                        yield -1 - s, None, np.array([m.sum(), (m * e).sum(), (q[held] + m * e * e).sum()])

            def judge(figures, k=k):
                kept = set(alive)
                for s, (n, e, ee, _) in figures.items():
                    if k == 1:
                        spreads[s] = ee - e * e / n if n else 0.0
                    elif k > 1:
                        loss = float(ee / spreads[s]) if spreads[s] else 0.0
                        records.append((s, k - 1, loss))
                        if not rules[s].goes_on(k - 1, 1.0 - loss):
                            kept.discard(s)
                return kept if k <= rounds else set()

            new = grow(rows, bins, view, alive, depth if k else 0, least, judge=judge)
            if not k and len(new) < len(alive):
                raise ValueError("a slot has no rows to learn from")
            alive = sorted(new)
            for s, tree in new.items():
                models[s].append(tree)
                recent[s].append((rate if k else 1.0, tree.packed()))
            if not alive:
                break
            if len(recent[alive[0]]) >= CUT_EVERY:
                rows = _settled(rows, names, alive, recent, current)
                recent = {s: [] for s in ids}
    finally:
        rows.unpersist()
    kept = [rules[s].best_step if slots[s][1] else len(models[s]) - 1 for s in ids]
    return [
        Ensemble(bins, models[s][: kept[s] + 1], [1.0] + [rate] * kept[s], per_tree=False) for s in ids
    ], records


def _settled(rows, names, alive, recent, current) -> DataFrame:
    """The cells with the recent trees in their sums, written."""
    frozen = {s: list(recent[s]) for s in alive}

    def run(batches, alive=tuple(alive)):
        for batch in _unpacked(batches):
            x = _bytes(batch, names)
            columns = dict(zip(batch.schema.names, batch.columns))
            for s in alive:
                columns[f"_s{s}"] = pa.array(current(batch, x, s, frozen))
            yield _packed([pa.RecordBatch.from_arrays(list(columns.values()), list(columns))])

    after = materialize(rows.mapInArrow(run, rows.schema), "sums").persist(StorageLevel.MEMORY_AND_DISK)
    rows.unpersist()
    return after


def predictions(
    table: DataFrame, model_of: Mapping[int, Sequence[Ensemble]], part: str, keep: Sequence[str], added: DataFrame | None = None
) -> DataFrame:
    """``keep`` columns and ``_p``: one prediction per family, by the models of the row's ``part``.

    ``model_of[part]`` are the models, in the order of the families, for rows of that part.
    ``added`` hands in ``cells`` of all rows: if they have few different bins, these are called
    instead of the rows, which look their predictions up.
    """
    names = [f"_x{i}" for i in range(len(next(iter(model_of.values()))[0].bins.columns))]
    if added is None:
        return _called(table, model_of, part, keep, names)
    places = added.select(*names).distinct().select("*", F.explode(F.array(*[F.lit(p) for p in model_of])).alias(part))
    called = _called(places, model_of, part, names, names)
    by_part = called.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct(part, "_p"))).alias("_by_part"))
    few = small_side(by_part)
    if few is by_part:
        return _called(table, model_of, part, keep, names)
    return table.select(*keep, part, *names).join(few, names).select(*keep, part, F.col("_by_part")[F.col(part)].alias("_p"))


def _called(table: DataFrame, model_of: Mapping[int, Sequence[Ensemble]], part: str, keep: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``predictions`` of each row by itself."""
    reach_workers(table.sparkSession)
    models = table.sparkSession.sparkContext.broadcast(dict(model_of))
    out = T.StructType([*[table.schema[c] for c in [*keep, part]], T.StructField("_p", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            x, parts = _bytes(batch, names), batch.column(part).to_numpy(zero_copy_only=False)
            families = len(next(iter(models.value.values())))
            called = np.zeros((len(x), families))
            for p, fitted in models.value.items():
                mine = np.flatnonzero(parts == p)
                if len(mine):
                    called[mine] = np.column_stack([m.of_codes(x[mine]) for m in fitted])
            ends = pa.array(np.arange(0, called.size + 1, families, dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(called.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in [*keep, part]], lists], out.names)

    return table.select(*dict.fromkeys([*keep, part, *names])).mapInArrow(run, out)
