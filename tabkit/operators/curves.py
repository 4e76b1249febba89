"""Training-curve rules over histories held as (run, epoch, value) rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.folds import Patience, Plateau
from tabkit.session import reach_workers

# Rows of a result handed on at once.
AT_ONCE = 4096


def _streamed(
    history: DataFrame, run: str, epoch: str, value: str, fields: str, rule: Callable[[], Callable[[int, float | None], Iterator[tuple]]]
) -> DataFrame:
    """What a rule gives for each run, whose epochs pass by in order: no run is ever held.

    ``rule`` starts a run and returns a function from (epoch, value) to rows; it is called
    with (None, None) at the end of the run.  Epochs without a number come first.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    reach_workers(history.sparkSession)
    rows = history.select(F.col(run), F.col(epoch).cast("long"), F.col(value).cast("double"))
    ordered = rows.repartition(run).sortWithinPartitions(run, epoch, value)
    out = T.StructType([rows.schema[0], *T.StructType.fromDDL(fields)])
    schema = to_arrow_schema(out)

    def batches_of(found):
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def go(batches):
        now, step, found = None, None, []
        for batch in batches:
            for name, e, v in zip(*[c.to_pylist() for c in batch.columns]):
                if step is None or name != now:
                    if step is not None:
                        found += [(now, *r) for r in step(None, None)]
                    now, step = name, rule()
                found += [(now, *r) for r in step(e, v)]
                if len(found) >= AT_ONCE:
                    yield from batches_of(found)
                    found = []
        if step is not None:
            found += [(now, *r) for r in step(None, None)]
        yield from batches_of(found)

    return ordered.mapInArrow(go, out)


def early_stop(
    history: DataFrame,
    run: str,
    epoch: str,
    value: str,
    patience: int,
    min_delta: float = 0.0,
    maximize: bool = True,
) -> DataFrame:
    """run, stop_epoch (the last one seen), best_epoch, best_value."""

    def rule():
        watch, state = Patience(patience, min_delta, maximize), [True]

        def step(e, v):
            if e is None and v is None:
                yield watch.last_step, watch.best_step, watch.best
            elif state[0]:
                state[0] = watch.goes_on(e, v)

        return step

    return _streamed(history.filter(F.col(epoch).isNotNull()), run, epoch, value, "stop_epoch long, best_epoch long, best_value double", rule)


def lr_plateau(
    history: DataFrame,
    run: str,
    epoch: str,
    value: str,
    initial: float,
    factor: float = 0.5,
    patience: int = 5,
    floor: float = 1e-6,
    min_delta: float = 1e-4,
) -> DataFrame:
    """run, epoch, lr: the rate used in each epoch; a cut made behind an epoch shows in the next one."""

    def rule():
        plateau = Plateau(initial, factor, patience, floor, min_delta)

        def step(e, v):
            if e is not None:
                yield e, plateau.rate
                plateau.step(e, v)

        return step

    return _streamed(history.filter(F.col(epoch).isNotNull()), run, epoch, value, "epoch long, lr double", rule)


def best_epoch(
    history: DataFrame, run: str, epoch: str, train: str, valid: str, maximize: bool = True
) -> DataFrame:
    """Best validation epoch of each run, and the train-validation gap at its end.

    The first of equally good epochs is the best.  Epochs without a validation
    value are passed over; the gap is that of the last epoch with both values.
    """
    wanted = F.col(valid) if maximize else -F.col(valid)
    order = F.when(F.col(valid).isNotNull(), F.struct(wanted, -F.col(epoch)))
    gap = F.col(train) - F.col(valid)
    return history.groupBy(run).agg(
        F.count(F.lit(1)).alias("n_epochs"),
        F.max_by(epoch, order).alias("best_epoch"),
        F.max_by(valid, order).alias("best_value"),
        F.max_by(gap, F.when(gap.isNotNull(), F.col(epoch))).alias("final_gap"),
    )


def numbered(history: DataFrame, run: str, order: str, epoch: str = "epoch") -> DataFrame:
    """Epoch numbers 1.. per run over an already aggregated history."""
    return history.withColumn(
        epoch, F.row_number().over(Window.partitionBy(run).orderBy(order))
    )
