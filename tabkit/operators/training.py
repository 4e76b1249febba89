"""A training loop over full-batch gradients, with the rules of a long training inside it.

The network is one layer of tanh units under a softmax.  An epoch is one pass: every task
adds up the gradient of its training rows (weighted by class, labels smoothed) and, of the
rows watched, loss and hits.  The driver holds the weights: it moves them by Adam, lowers
the rate when the watched loss stops falling, ends the training when the watched accuracy
stops rising, and gives back the weights of the best epoch.  There is no number of epochs
to run to; ``MOST_EPOCHS`` is a ceiling for safety, and reaching it is told.

First weights are drawn from the hash of their place, so a training is the same anywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.functions.folds import Patience, Plateau
from tabkit.operators import softmax, sums
from tabkit.session import reach_workers

# The rules of the published training.
STOP_PATIENCE, PLATEAU_PATIENCE, FACTOR, FLOOR, SMOOTHING, PLATEAU_GAIN = 50, 5, 0.5, 1e-6, 0.1, 1e-4
MOST_EPOCHS = 100_000
# Fixed values of Adam.
DECAY, DECAY_SQUARES, TINY = 0.9, 0.999, 1e-7


def first_weights(name: str, rows: int, columns: int, reach: float) -> np.ndarray:
    """Weights between -reach and reach, from the md5 of their name and place."""
    draw = [[int(hashlib.md5(f"{name}-{i}-{j}".encode()).hexdigest()[:8], 16) / 2**32 for j in range(columns)] for i in range(rows)]
    return (np.array(draw) * 2 - 1) * reach


@dataclass
class Network:
    """Weights of both layers; the first column of each holds the biases."""

    column: str
    classes: tuple
    inner: np.ndarray
    outer: np.ndarray

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        units = np.hstack([np.ones((len(x), 1)), np.tanh(x @ self.inner.T)])
        return units, softmax.probabilities(units @ self.outer.T)

    def transform(self, df: DataFrame, out: str = "probs") -> DataFrame:
        """``df`` with the classes' probabilities; NULL where the vector cannot be scored."""
        reach_workers(df.sparkSession)
        model = df.sparkSession.sparkContext.broadcast(self)  # as large as the model

        @F.pandas_udf("array<double>")
        def probs(vectors: pd.Series) -> pd.Series:
            x = np.array(vectors.tolist(), float).reshape(len(vectors), -1)
            return pd.Series(list(model.value.forward(np.hstack([np.ones((len(x), 1)), x]))[1]))

        zeros = F.array_repeat(F.lit(0.0), self.inner.shape[1] - 1)
        good = softmax.usable(self.column)
        filled = F.when(good, F.col(self.column).cast("array<double>")).otherwise(zeros)
        return df.withColumn(out, F.when(good, probs(filled)))


@dataclass
class Training:
    """What a training gave: the best weights, every epoch, and how it ended."""

    network: Network
    history: list[tuple] = field(default_factory=list)
    best_epoch: int = 0
    stopped: bool = False

    COLUMNS = "epoch int, rate double, loss double, slope double, watched_loss double, watched_accuracy double"


def train(
    df: DataFrame,
    column: str,
    label: str,
    watched: str,
    units: int = 32,
    rate: float = 0.01,
    smoothing: float = SMOOTHING,
    patience: int = STOP_PATIENCE,
    plateau: int = PLATEAU_PATIENCE,
    weighted: bool = True,
    keys: Sequence[str] = (),
    parts: int | None = None,
    most: int = MOST_EPOCHS,
) -> Training:
    """Train on the rows where the column ``watched`` is false, watching the others.

    An epoch's ``loss`` and ``slope`` (length of the gradient) are those of the training rows
    before its step; the watched figures are those behind the step of the epoch.
    """
    learn = df.filter(~F.col(watched))
    known, classes, width = softmax.learnable(learn, column, label, weighted, keys, parts)
    looked_at = df.filter(F.col(watched) & F.col(label).isin(classes) & softmax.usable(column) & (F.size(column) == width))
    number = F.array_position(F.lit(classes), F.col(label)) - 1
    both = known.withColumn("_v", F.lit(False)).unionByName(
        looked_at.select(F.col(column).cast("array<double>").alias("_x"), number.cast("int").alias("_c"), F.lit(1.0).alias("_w"), F.lit(True).alias("_v"))
    ).persist(StorageLevel.MEMORY_AND_DISK)
    k = len(classes)
    net = Network(
        column, tuple(classes), first_weights("inner", units, width + 1, 1 / np.sqrt(width)), first_weights("outer", k, units + 1, 1 / np.sqrt(units))
    )

    def figures_at(net):
        def figures(batch):
            x, c, w = softmax.vectors_of(batch, width), batch.column("_c").to_numpy(), batch.column("_w").to_numpy()
            held = batch.column("_v").to_numpy(zero_copy_only=False)
            units_out, p = net.forward(x)
            wanted = np.full(p.shape, smoothing / k)
            wanted[np.arange(len(c)), c] += 1 - smoothing
            loss = -(wanted * np.log(np.maximum(p, 1e-300))).sum(1)
            w = np.where(held, 0.0, w)
            off = w[:, None] * (p - wanted)
            back = (off @ net.outer[:, 1:]) * (1 - units_out[:, 1:] ** 2)
            told = [w.sum(), w @ loss, held.sum(), loss[held].sum(), (p[held].argmax(1) == c[held]).sum()]
            return {0: np.array(told, float), 1: (back.T @ x).ravel(), 2: (off.T @ units_out).ravel()}

        return figures

    size = net.inner.size + net.outer.size + 5
    out, best = Training(net), (net.inner, net.outer)
    stop, slow = Patience(patience), Plateau(rate, FACTOR, plateau, FLOOR, PLATEAU_GAIN)
    momentum = [np.zeros_like(net.inner), np.zeros_like(net.outer)]
    squares = [np.zeros_like(net.inner), np.zeros_like(net.outer)]
    try:
        epoch = 0
        while True:
            found = sums.total(both, ["_x", "_c", "_w", "_v"], figures_at(net), size)
            n, loss, n_held, held_loss, hits = found[0]
            slopes = [found[1].reshape(net.inner.shape) / n, found[2].reshape(net.outer.shape) / n]
            if epoch:  # the pass tells what the last step came to
                out.history[-1] += (held_loss / max(n_held, 1), hits / max(n_held, 1))
                on = stop.goes_on(epoch, hits / max(n_held, 1))
                if stop.best_step == epoch:
                    best, out.best_epoch = (net.inner, net.outer), epoch
                rate = slow.step(epoch, held_loss / max(n_held, 1))
                if not on or epoch >= most:
                    out.stopped = not on
                    break
            epoch += 1
            out.history.append((epoch, rate, loss / n, float(np.sqrt(sum((s**2).sum() for s in slopes)))))
            moved = []
            for i, (w, s) in enumerate(zip((net.inner, net.outer), slopes)):
                momentum[i] = DECAY * momentum[i] + (1 - DECAY) * s
                squares[i] = DECAY_SQUARES * squares[i] + (1 - DECAY_SQUARES) * s * s
                m, v = momentum[i] / (1 - DECAY**epoch), squares[i] / (1 - DECAY_SQUARES**epoch)
                moved.append(w - rate * m / (np.sqrt(v) + TINY))
            net = Network(column, tuple(classes), *moved)
    finally:
        both.unpersist()
        known.unpersist()
    out.network = Network(column, tuple(classes), *best)
    return out
