"""the linear machines of an SVM, all classes and folds fitted in shared passes.

Every machine is the one that Spark's ``LinearSVC`` fits: hinge loss with a quadratic penalty
on centred features of unit deviation, minimised by the same quasi-Newton steps (OWL-QN without
an L1 term, ten corrections held, Armijo-Wolfe backtracking). What differs is who reads the rows:
the machines move in step, and one job a step takes the losses and gradients of all that are still
moving. So the number of passes is that of the slowest machine, not the sum over classes and folds,
and the rows are held once, not once a machine. A task yields one array of sums, whatever its rows.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .network import HIST_BYTES
from .trees import add_up, open_block

MEMORY, REMEMBERED = 10, 20          # corrections held, values looked back at
SEARCHES, SHRINK, GROW, ARMIJO, WOLFE = 20, 0.5, 2.1, 1e-4, 0.9


class _NoStep(Exception):
    """The history or the line search gives no next step."""


def _direction(g: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    d, kept, scale = g.copy(), [], 1.0
    if steps:
        sy = steps[0] @ changes[0]
        if sy < 0 or math.isnan(sy):
            raise _NoStep
        yy = changes[0] @ changes[0]
        scale = sy / yy if yy else math.nan
    for s, y in zip(steps, changes):
        rho = s @ y
        a = (s @ d) / rho if rho else math.nan
        if math.isnan(a):
            raise _NoStep
        kept.append((a, rho))
        d -= a * y
    d *= scale
    for s, y, (a, rho) in reversed(list(zip(steps, changes, kept))):
        d += (a - (y @ d) / rho) * s
    return np.where(-d * g < 0, -d, 0.0)


def minimise(size: int, max_iter: int, tol: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Yields the points at which value and gradient are wanted, returns the last point reached."""
    x = np.zeros(size)
    f, g = yield x
    first, values, steps, changes, done, failed = f, [math.inf], [], [], 0, False
    while True:
        if done >= max_iter or (len(values) >= 2 and abs(f - max(values)) <= tol * first) \
                or np.linalg.norm(g) <= max(tol * f, 1e-8):
            return x
        try:
            d = _direction(g, steps, changes)
            signs = np.where(x != 0, np.sign(x), np.sign(-g))
            slope, norm = g @ d, np.linalg.norm(g)
            shrink = SHRINK if done else 0.1
            # Spark's search takes the value at its first step for the one it starts from, so that step is always cut
            alpha, tries = ((1.0 if done else 0.5 / norm) * shrink, 1) if slope < 0 else (1.0, 0)
            while True:
                at = x + alpha * d
                at = np.where(np.sign(at) == signs, at, 0.0)
                fa, ga = yield at
                if fa > f + alpha * slope * ARMIJO:
                    by = shrink
                elif ga @ d < WOLFE * slope:
                    by = GROW
                elif ga @ d > -WOLFE * slope:
                    by = shrink
                else:
                    break
                if not 1e-10 <= alpha * by <= 1e10:
                    raise _NoStep
                if tries + 1 >= SEARCHES:                  # the last one tried is taken, as in Spark's search
                    break
                alpha, tries = alpha * by, tries + 1
        except _NoStep:
            if failed:
                return x
            steps, changes, failed = [], [], True
            continue
        steps, changes = [at - x, *steps][:MEMORY], [ga - g, *changes][:MEMORY]
        x, f, g, failed, done = at, fa, ga, False, done + 1
        values = [*values, f][-REMEMBERED:]


def _moments(d: int, folds: int):
    """Rows, means, squared deviations, least and largest values of each fold in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrow in batches:
            for i in range(arrow.num_rows):
                _, rows, _ = open_block(arrow, i, d + 1)
                for k in range(folds):
                    x = rows[rows[:, d] == k, :d]
                    if len(x):
                        m = x.mean(0)
                        v = np.concatenate([m, ((x - m) ** 2).sum(0), x.min(0), x.max(0)])
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(x)], pa.int64()),
                                                          pa.array([v.tobytes()], pa.binary())], names=["fold", "n", "v"])

    def merged(t: pa.Table) -> pa.Table:
        total, v = 0, None
        for n, raw in zip(t.column("n").to_pylist(), t.column("v")):
            total, v = _together(total, v, n, np.frombuffer(raw.as_buffer(), np.float64), d)
        return pa.table({"fold": t.column("fold").slice(0, 1), "n": pa.array([total], pa.int64()), "v": pa.array([v.tobytes()], pa.binary())})
    return run, merged


def _together(n: int, v: np.ndarray | None, m: int, w: np.ndarray, d: int) -> tuple[int, np.ndarray]:
    if v is None:
        return m, w
    apart, total = w[:d] - v[:d], n + m
    return total, np.concatenate([v[:d] + apart * m / total, v[d:2 * d] + w[d:2 * d] + apart * apart * n * m / total,
                                  np.minimum(v[2 * d:3 * d], w[2 * d:3 * d]), np.maximum(v[3 * d:], w[3 * d:])])


def _pass(d: int, coef: np.ndarray, intercept: np.ndarray, classes: np.ndarray, left_out: np.ndarray):
    """For each machine the sums over a task's rows of its loss and of the loss's gradient."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(classes), d + 2))
        for arrow in batches:
            for i in range(arrow.num_rows):
                _, rows, y = open_block(arrow, i, d + 1)
                x = rows[:, :d]
                sign = np.where(y[:, None] == classes, 1.0, -1.0)
                short = 1.0 - sign * (x @ coef.T + intercept)
                short[(rows[:, d:] == left_out) | (short <= 0)] = 0.0
                pull = np.where(short > 0, -sign, 0.0)
                out[:, 0] += short.sum(0)
                out[:, 1] += pull.sum(0)
                out[:, 2:] += pull.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["i", "v"])
    return run


def fit_machines(blocks: DataFrame, d: int, folds: int, machines: list[tuple[int, int]], reg: float,
                 max_iter: int = 100, tol: float = 1e-6) -> tuple[np.ndarray, np.ndarray, int]:
    """Coefficients and intercepts of ``machines`` (the class told from the others, the fold left out or -1),
    and the number of passes. ``blocks`` are those of ``trees.pack_blocks`` with the fold behind ``d`` features."""
    run, merged = _moments(d, folds)
    per = {r["fold"]: (r["n"], np.frombuffer(bytes(r["v"]), np.float64))
           for r in blocks.mapInArrow(run, "fold int, n long, v binary").groupBy("fold").applyInArrow(merged, "fold int, n long, v binary").collect()}
    scale = {}
    for out in {f for _, f in machines}:
        n, v = 0, None
        for k, (m, w) in sorted(per.items()):
            if k != out:
                n, v = _together(n, v, m, w, d)
        std = np.where(v[2 * d:3 * d] == v[3 * d:], 0.0, np.sqrt(v[d:2 * d] / max(1, n - 1)))
        scale[out] = n, v[:d], np.divide(1.0, std, out=np.zeros(d), where=std > 0)

    def plain(m: int, point: np.ndarray) -> tuple[np.ndarray, float]:
        _, mean, inverse = scale[machines[m][1]]
        coef = point[:d] * inverse
        return coef, point[d] - coef @ mean

    parts, passes = blocks.rdd.getNumPartitions(), 0
    solvers = [minimise(d + 1, max_iter, tol) for _ in machines]
    wanted, found = {m: next(s) for m, s in enumerate(solvers)}, {}
    while wanted:
        who = sorted(wanted)
        at = [plain(m, wanted[m]) for m in who]
        sums = blocks.mapInArrow(_pass(d, np.stack([c for c, _ in at]), np.array([b for _, b in at]),
                                       np.array([machines[m][0] for m in who], np.float64),
                                       np.array([machines[m][1] for m in who], np.float64)), "i int, v binary")
        if parts * len(who) * (d + 2) * 8 > HIST_BYTES:    # else the driver adds them up
            sums = add_up(sums, "i", "v", parts, ordered=True)
        total = np.sum([np.frombuffer(bytes(r["v"]), np.float64) for r in sums.collect()], 0).reshape(len(who), d + 2)
        passes += 1
        for m, t in zip(who, total):
            n, mean, inverse = scale[machines[m][1]]
            w = wanted[m][:d]
            g = np.append((t[2:] - mean * t[1]) * inverse / n + reg * w, t[1] / n)
            try:
                wanted[m] = solvers[m].send((t[0] / n + 0.5 * reg * float(w @ w), g))
            except StopIteration as end:
                found[m] = plain(m, end.value)
                del wanted[m]
    return np.stack([found[m][0] for m in range(len(machines))]), np.array([found[m][1] for m in range(len(machines))]), passes


def margins(x: Column, coef: np.ndarray, intercept: np.ndarray) -> Column:
    """The margins (array) that machines give the rows of an array column, one matrix product a batch."""
    coef, intercept = np.asarray(coef, np.float64), np.asarray(intercept, np.float64)

    @F.pandas_udf("array<double>")
    def found(v: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(v.to_list()) @ coef.T + intercept)) if len(v) else pd.Series([], dtype=object)
    return found(x)
