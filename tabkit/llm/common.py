"""Helpers shared by the operators: tables, row-wise Arrow maps, byte hashing, registry.

Every row-wise operator reads two things only, the columns it keeps and the text,
so extra columns of any name never clash with what it computes.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (reached as pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Text handed to an operator's Python code at once, unless one row alone is longer.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 2048
# Rows of a batch between Spark and Python, unless the session says otherwise: with long
# texts Spark's own 10,000 fill much memory on both sides.
BATCH_KEY, BATCH_ROWS, BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000", "10000"


def query(name: str, sql: str | None = None):
    """Register a query over the given tables, with the SQL that must give the same rows."""

    def register(job):
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package also where it is not installed; keep batches small."""
    if spark.conf.get(BATCH_KEY, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def bucket_of(column: str, modulus: int):
    """Remainder of the CRC-32 of the id as text; NULL ids give NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose text stays near SLICE_BYTES; a longer row comes alone."""
    column = batch.column(text)
    lengths = np.asarray(pa.compute.binary_length(column).fill_null(0), dtype=np.int64)
    start, size = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and (size + n > SLICE_BYTES or i - start >= SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(lengths) > start:
        yield batch.slice(start)


def release() -> None:
    """Give freed memory back to the system: a worker is kept after its task and would hold it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A map over a task's batches that ends with ``release``."""

    def outer(batches):
        yield from run(batches)
        release()

    return outer


def map_text(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[[list], Sequence]],
) -> DataFrame:
    """``keep`` columns as they are, then the columns computed from ``text``.

    ``make`` runs once per task and returns a function from a list of texts (None
    for NULL) to one value list or Arrow array for each of ``fields``.
    """
    reach_package(df.sparkSession)
    names = [f"k{i}" for i in range(len(keep))]
    kept = [df.schema[c] for c in keep]
    source = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col(f"`{text}`").alias("t"))
    schema = T.StructType(
        [T.StructField(n, f.dataType, True) for n, f in zip(names, kept)] + list(fields)
    )
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in fields]
    labels = [*names, *[f.name for f in fields]]

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, len(names)):
                out = work(part.column(len(names)).to_pylist())
                arrays = [
                    x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(out, types)
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *arrays], labels)

    mapped = source.mapInArrow(released(run), schema)
    return mapped.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], *[F.col(f.name) for f in fields]
    )


# Odd multipliers of the polynomial hash and of the mixer: fixed values of our own.
BASE = 0x9E3779B97F4A7C15
MIX_A = 0xBF58476D1CE4E5B9
MIX_B = 0x94D049BB133111EB
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(MIX_A)
    x = x ^ (x >> U64(27))
    x = x * U64(MIX_B)
    return x ^ (x >> U64(31))


class SpanHasher:
    """64-bit hashes of byte spans by prefix sums of a polynomial; tables grow as needed."""

    def __init__(self):
        self.powers = np.ones(1, U64)
        self.inverse = np.ones(1, U64)
        self.undo = U64(pow(BASE, -1, 1 << 64))

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            with np.errstate(over="ignore"):
                steps = np.full(size, U64(BASE))
                steps[0] = 1
                self.powers = np.cumprod(steps, dtype=U64)
                steps[1:] = self.undo
                self.inverse = np.cumprod(steps, dtype=U64)

    def spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start[i]:end[i]] for every i; equal bytes hash equal anywhere."""
        self._reach(len(data) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, U64)
            np.cumsum((data.astype(U64) + U64(1)) * self.powers[: len(data)], out=sums[1:])
            body = (sums[end] - sums[start]) * self.inverse[start]
            return mix(body + (end - start).astype(U64) * U64(MIX_B))


def is_space(data: np.ndarray) -> np.ndarray:
    """ASCII white space: space and the five control characters from tab on."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than ASCII white space."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = is_space(data)
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[0::2], edges[1::2]


# Bytes hashed at once: long texts go through in pieces cut at white space.
PIECE_BYTES = 1 << 20


def word_hashes(hasher: SpanHasher, text: bytes) -> np.ndarray:
    """Hashes of all words of a text, in order, with memory bounded for any length."""
    found, at = [], 0
    while at < len(text):
        stop = min(len(text), at + PIECE_BYTES)
        if stop < len(text):
            data = np.frombuffer(text, np.uint8, stop - at, at)
            blanks = np.flatnonzero(is_space(data))
            # a word longer than a piece is taken whole
            while not len(blanks) and stop < len(text):
                stop = min(len(text), stop + PIECE_BYTES)
                data = np.frombuffer(text, np.uint8, stop - at, at)
                blanks = np.flatnonzero(is_space(data))
            if stop < len(text):
                stop = at + int(blanks[-1]) + 1
        data = np.frombuffer(text, np.uint8, stop - at, at)
        start, end = word_spans(data)
        found.append(hasher.spans(data, start, end))
        at = stop
    return np.concatenate(found) if found else np.zeros(0, U64)
