"""a network of one hidden layer trained by data-parallel mini-batches.

Rows are packed into blocks once. An epoch is one pass: every task takes Adam steps over
mini-batches of its blocks, starting from the weights of the last epoch, and the tasks'
weights and moments are averaged by rows, ``trees.FAN_IN`` at a time. So an epoch costs one
job however many mini-batches it has, and what travels is the size of the network. Rows of a
block are shuffled by a seed of epoch and block, which makes a lost task repeat its steps.
Training stops when the mean loss has not fallen by ``tol`` for ``patience`` epochs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .trees import BLOCK_ROWS, add_up, feature_array, open_block, pack_blocks, softmax

SEED = 42
HIST_BYTES = 1 << 20                # sent to the driver by an epoch, whatever the number of tasks
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8


def shapes(d: int, hidden: int, k: int) -> list[tuple[int, ...]]:
    return [(d, hidden), (hidden,), (hidden, k), (k,)]


def first_weights(d: int, hidden: int, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for rows, cols in ((d, hidden), (hidden, k)):
        bound = math.sqrt(6.0 / (rows + cols))
        parts += [rng.uniform(-bound, bound, rows * cols), rng.uniform(-bound, bound, cols)]
    return np.concatenate(parts)


def split(flat: np.ndarray, d: int, hidden: int, k: int) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes(d, hidden, k):
        size = math.prod(shape)
        out.append(flat[at:at + size].reshape(shape))
        at += size
    return out


def gradient(flat: np.ndarray, x: np.ndarray, y: np.ndarray, d: int, hidden: int, k: int, l2: float) -> tuple[float, np.ndarray]:
    """Mean loss of a mini-batch and its gradient."""
    w1, b1, w2, b2 = split(flat, d, hidden, k)
    h = np.maximum(x @ w1 + b1, 0.0)
    p = softmax(h @ w2 + b2)
    n = len(y)
    loss = -np.log(np.maximum(p[np.arange(n), y], 1e-300)).mean() + l2 / (2 * n) * ((w1 * w1).sum() + (w2 * w2).sum())
    p[np.arange(n), y] -= 1
    p /= n
    back = (p @ w2.T) * (h > 0)
    return float(loss), np.concatenate([(x.T @ back + l2 / n * w1).ravel(), back.sum(0), (h.T @ p + l2 / n * w2).ravel(), p.sum(0)])


def _epoch(state: np.ndarray, steps: float, epoch: int, d: int, hidden: int, k: int, batch: int, rate: float, l2: float, seed: int):
    """(rows, steps, loss, weights, first and second moments), all times rows, of a task's blocks."""
    size = len(state) // 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, m, v = (state[i * size:(i + 1) * size].copy() for i in range(3))
        t, rows, total = steps, 0, 0.0
        for arrow in batches:
            for i in range(arrow.num_rows):
                no, x, y = open_block(arrow, i, d)
                order = np.random.default_rng([seed, epoch, no]).permutation(len(y))
                x, y = x[order], y[order].astype(np.int64)
                for lo in range(0, len(y), batch):
                    part = slice(lo, lo + batch)
                    loss, g = gradient(w, x[part], y[part], d, hidden, k, l2)
                    t += 1
                    m = BETA1 * m + (1 - BETA1) * g
                    v = BETA2 * v + (1 - BETA2) * g * g
                    w -= rate * math.sqrt(1 - BETA2 ** t) / (1 - BETA1 ** t) * m / (np.sqrt(v) + EPSILON)
                    total += loss * len(y[part])
                rows += len(y)
        if rows:
            out = np.concatenate([[rows, rows * t, total], rows * w, rows * m, rows * v])
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["i", "v"])
    return run


def fit_network(train: DataFrame, num_classes: int, hidden: int = 100, max_epochs: int = 500, batch: int = 200, rate: float = 1e-3,
                l2: float = 1e-4, tol: float = 1e-4, patience: int = 10, seed: int = SEED, features_col: str = "features") -> dict:
    """Weights, sizes and the loss of each epoch."""
    blocks, d, n = pack_blocks(train, features_col)
    if n == 0:
        raise ValueError("no rows to fit")
    parts = blocks.rdd.getNumPartitions()
    w = first_weights(d, hidden, num_classes, seed)
    state, steps, losses, best, waited = np.concatenate([w, np.zeros(2 * len(w))]), 0.0, [], math.inf, 0
    for epoch in range(max_epochs):
        sums = blocks.mapInArrow(_epoch(state, steps, epoch, d, hidden, num_classes, min(batch, n), rate, l2, seed), "i int, v binary")
        if parts * state.nbytes > HIST_BYTES:          # else the driver adds them up
            sums = add_up(sums, "i", "v", parts, ordered=True)
        total = np.sum([np.frombuffer(bytes(r["v"]), np.float64) for r in sums.collect()], 0)
        steps, loss, state = total[1] / total[0], float(total[2] / total[0]), total[3:] / total[0]
        losses.append(loss)
        waited = waited + 1 if loss > best - tol else 0
        best = min(best, loss)
        if waited >= patience:
            break
    return {"weights": state[:len(w)], "d": d, "hidden": hidden, "k": num_classes, "losses": losses}


def predict_network(model: dict, df: DataFrame, features_col: str = "features", out: str = "_shares") -> DataFrame:
    """``df`` with the class probabilities (array; null for rows without features)."""
    w1, b1, w2, b2 = split(np.asarray(model["weights"], np.float64), model["d"], model["hidden"], model["k"])

    @F.pandas_udf("array<double>")
    def shares(x: pd.Series) -> pd.Series:
        has = np.flatnonzero(x.notna().to_numpy())
        found: list = [None] * len(x)
        for lo in range(0, len(has), BLOCK_ROWS):
            at = has[lo:lo + BLOCK_ROWS]
            rows = np.stack([np.asarray(v, np.float64) for v in x.iloc[at]])
            for i, p in zip(at, softmax(np.maximum(rows @ w1 + b1, 0.0) @ w2 + b2)):
                found[i] = p
        return pd.Series(found, dtype=object)
    return df.withColumn(out, shares(feature_array(df, features_col)))
