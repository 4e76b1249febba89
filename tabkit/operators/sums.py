"""Arrays added up over all rows: every task adds its own, Spark adds the tasks'.

For figures of a model's size (gradients, curvatures, histograms): each comes as a few
named arrays.  Few and small ones go to the driver as they are; else the tasks' arrays meet
by name in a shuffle, and the driver sees one array a name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabkit.session import reach_workers

# Bytes that the tasks may hand to the driver directly.
DIRECT_BYTES = 16 << 20
PARTS = "name int, sums binary"


def _as_batches(found: Mapping[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if found:
        names, sums = zip(*[(k, np.ascontiguousarray(v, float).tobytes()) for k, v in sorted(found.items())])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(sums, pa.binary())], ["name", "sums"])


def _added(rows) -> dict[int, np.ndarray]:
    found: dict[int, np.ndarray] = {}
    for name, sums in rows:
        part = np.frombuffer(sums)
        found[name] = found[name] + part if name in found else part
    return found


def total(
    table: DataFrame, needed: Sequence[str], figures: Callable[[pa.RecordBatch], Mapping[int, np.ndarray]], size: int
) -> dict[int, np.ndarray]:
    """The sum of ``figures`` over all batches of ``table``; ``size`` is its number of values."""
    reach_workers(table.sparkSession)

    def run(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for name, part in figures(batch).items():
                    found[name] = found[name] + part if name in found else np.array(part, float)
        yield from _as_batches(found)

    def meet(batches):
        yield from _as_batches(_added((r["name"], r["sums"]) for b in batches for r in b.to_pylist()))

    parts = table.select(*needed).mapInArrow(run, PARTS)
    # only a persisted table tells how many tasks there will be
    tasks = table.rdd.getNumPartitions() if table.storageLevel.useMemory else 1 << 40
    if tasks * size * 8 > DIRECT_BYTES:
        parts = parts.repartition("name").mapInArrow(meet, PARTS)
    return _added((r["name"], r["sums"]) for r in parts.collect())
