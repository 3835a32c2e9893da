"""Operator 4: quality by positive-unlabelled learning.

Only labelled good documents are trusted; every document stands in the unlabelled
web text. A text becomes shares of its bytes and words (symbols, capitals, marks,
repeats, word lengths, ...), each cut into quantile bins. A first classifier tells
positives from unlabelled text; the *class prior* is the least ratio of the
unlabelled to the positive share above one of its thresholds, with a confidence
margin, counted over all documents. The final classifier minimises the
non-negative unbiased risk with that prior:

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)])

Both are fitted on bounded samples (``max_rows`` positives and as many unlabelled
rows, in hash order); features, prior counts and scores cover all rows.

Defined results: null and empty texts are scored by their (zero) features; rows with
a null label don't train; without positives every score is 0.5; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import PAD, text_blocks
from .shingles import word_hashes

MAX_ROWS, BINS, EPOCHS = 20000, 24, 300
THRESHOLDS = 200
MIN_POSITIVE_SHARE = 0.2            # thresholds above which fewer positives lie don't count for the prior
BLOCK_BYTES = 1 << 18
_CLASSES = ([b"#*$%&<>"[i] for i in range(7)], [ord("|")], [ord("!"), ord("?")], list(range(65, 91)),
            list(range(48, 58)), [10], [9, 11, 12, 13, 32], [ord("."), ord(",")], list(range(128, 256)), [*b"()[]{}\"'=@/\\_+-"])
N_FEATURES = len(_CLASSES) + 8


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Features of every row of a text block."""
    n_rows = len(off) - 1
    body = data[:len(data) - PAD]
    size = np.diff(off)
    per_byte = 1 / np.maximum(1, size)
    out = np.zeros((n_rows, N_FEATURES), np.float32)
    for k, chars in enumerate(_CLASSES):
        lut = np.zeros(256, np.uint8)
        lut[chars] = 1
        sums = np.concatenate([[0], np.cumsum(lut[body], dtype=np.int64)])
        out[:, k] = (sums[off[1:]] - sums[off[:-1]]) * per_byte
    words, first = word_hashes(data, off)
    count = np.diff(first)
    row = np.repeat(np.arange(n_rows), count)
    per_word = 1 / np.maximum(1, count)
    k = len(_CLASSES)

    def distinct(h, r):
        o = np.lexsort((h, r))
        new = np.append(True, (h[o][1:] != h[o][:-1]) | (r[o][1:] != r[o][:-1]))[:len(h)]
        starts = np.flatnonzero(new)
        runs = np.diff(np.append(starts, len(h)))
        top = np.zeros(n_rows)
        np.maximum.at(top, r[o][starts], runs)
        return np.bincount(r[o][starts], minlength=n_rows), top

    kinds, top = distinct(words, row)
    out[:, k] = np.log1p(count)
    out[:, k + 1] = kinds * per_word
    out[:, k + 2] = top * per_word
    twice = np.zeros(len(words), bool)
    if len(words) > 1:
        twice[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    out[:, k + 3] = np.bincount(row, twice, n_rows) * per_word
    pair = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] if len(words) else words
    same = row[:-1] == row[1:] if len(words) else np.zeros(0, bool)
    pairs, _ = distinct(pair[same], row[:-1][same]) if len(words) else (np.zeros(n_rows), None)
    out[:, k + 4] = pairs / np.maximum(1, count - 1)
    out[:, k + 5] = (size - out[:, 11] * size - out[:, 12] * size) * per_word      # mean bytes of a word
    out[:, k + 6] = np.log1p(size)
    out[:, k + 7] = count == 0
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, data, off in text_blocks(batches, "text", BLOCK_BYTES):
        x = features(data, off)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float32()))],
            names=["doc_id", "x"])


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(_featured, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<float>")


def bin_edges(x: np.ndarray) -> np.ndarray:
    """Per feature 0 (most shares are 0 in most texts) and quantiles of the values above it,
    half by rows and half by different values."""
    out = []
    for f in range(x.shape[1]):
        v = x[:, f][x[:, f] > 0]
        v = np.concatenate([v, np.unique(v)]) if len(v) else np.ones(1)
        out.append(np.append(0.0, np.quantile(v, np.arange(1, BINS - 1) / (BINS - 1))))
    return np.stack(out)


class Scorer:
    """Additive model on quantile bins: ``weights[f, bin]`` and an intercept."""

    def __init__(self, edges: np.ndarray):
        self.edges = edges
        self.weights = np.zeros((len(edges), edges.shape[1] + 1))
        self.bias = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], 1)

    def margin(self, b: np.ndarray) -> np.ndarray:
        return self.weights[np.arange(b.shape[1])[None, :], b].sum(1) + self.bias


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _train(model: Scorer, pos: np.ndarray, unl: np.ndarray, grads, epochs: int = EPOCHS, rate: float = 0.05,
           ridge: float = 1e-3) -> Scorer:
    """Adam on ``grads(margin of pos, margin of unl) -> gradients of the risk by margin``."""
    width = model.weights.shape[1]
    at = np.arange(pos.shape[1])[None, :] * width
    ip, iu = (pos + at), (unl + at)
    theta = np.append(model.weights.ravel(), model.bias)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, epochs + 1):
        gp, gu = grads(theta[:-1][ip].sum(1) + theta[-1], theta[:-1][iu].sum(1) + theta[-1])
        g = np.bincount(ip.ravel(), np.repeat(gp, ip.shape[1]), len(theta) - 1)
        g += np.bincount(iu.ravel(), np.repeat(gu, iu.shape[1]), len(theta) - 1)
        g = np.append(g, gp.sum() + gu.sum()) + ridge * theta * (np.arange(len(theta)) < len(theta) - 1)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    model.weights, model.bias = theta[:-1].reshape(model.weights.shape), float(theta[-1])
    return model


def first_classifier(edges: np.ndarray, pos: np.ndarray, unl: np.ndarray) -> Scorer:
    """Logistic regression of positives against unlabelled rows, either weighing one half."""
    model = Scorer(edges)
    p, u = model.bins(pos), model.bins(unl)
    # stopped early: positives it knows by heart would make the prior look smaller
    return _train(model, p, u, lambda a, b: (-_sigmoid(-a) / len(a) / 2, _sigmoid(b) / len(b) / 2), epochs=60)


def nn_pu(edges: np.ndarray, pos: np.ndarray, unl: np.ndarray, prior: float) -> Scorer:
    """Non-negative unbiased risk with the sigmoid loss l(z) = 1 / (1 + e^z)."""
    model = Scorer(edges)
    p, u = model.bins(pos), model.bins(unl)

    def grads(a, b):
        la, lb = _sigmoid(a), _sigmoid(b)
        sa, sb = la * (1 - la) / len(a), lb * (1 - lb) / len(b)
        negative = lb.mean() - prior * la.mean()             # risk of the negatives
        if negative >= 0:
            return -2 * prior * sa, sb
        return prior * sa, -sb                               # it overfits: step back
    return _train(model, p, u, grads)


def class_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least ratio of the shares above a threshold, from histograms over ascending scores."""
    p, u = positives[::-1].cumsum()[::-1], unlabelled[::-1].cumsum()[::-1]
    n, m = p[0], u[0]
    margin = np.sqrt(np.log(2 / 0.05) / 2)
    share_p, share_u = p / n, u / m
    ok = share_p >= MIN_POSITIVE_SHARE
    ratio = (share_u + margin / np.sqrt(m)) / np.maximum(share_p - margin / np.sqrt(n), 1e-9)
    return float(np.clip(ratio[ok].min(), 0.01, 0.99))


def _scored(model: Scorer | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if model is None:
                s = np.full(b.num_rows, 0.5)
            else:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                s = _sigmoid(model.margin(model.bins(x)))
            yield b.select([i for i in range(b.num_columns) if b.schema.names[i] != "x"]).append_column("score", pa.array(s))
    return run


def score_rows(featured: DataFrame, model: Scorer | None) -> DataFrame:
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in featured.schema.fields if f.name != "x")
    return featured.mapInArrow(_scored(model), f"{kinds}, score double")


def fit_pu(featured: DataFrame, max_rows: int = MAX_ROWS) -> tuple[Scorer | None, float]:
    """Fit on a table of ``x`` and ``positive`` (true: trusted; all rows are unlabelled text)."""
    def sample(df):
        rows = df.orderBy(F.xxhash64("x"), "doc_id").select("x").limit(max_rows).toPandas()["x"]
        return np.stack(rows.to_list()).astype(np.float32) if len(rows) else np.zeros((0, N_FEATURES), np.float32)

    pos, unl = sample(featured.filter("positive")), sample(featured)
    if len(pos) == 0:
        return None, 0.5
    edges = bin_edges(np.concatenate([pos, unl]))
    first = first_classifier(edges, pos, unl)
    scored = score_rows(featured.select("x", "positive"), first)
    slot = F.least(F.floor(F.col("score") * THRESHOLDS), F.lit(THRESHOLDS - 1)).cast("int").alias("slot")
    counts = scored.groupBy(slot).agg(F.count("*").alias("u"), F.sum(F.col("positive").cast("long")).alias("p")).collect()
    p, u = np.zeros(THRESHOLDS), np.zeros(THRESHOLDS)
    for r in counts:
        p[r["slot"]], u[r["slot"]] = r["p"] or 0, r["u"]
    prior = class_prior(p, u)
    return nn_pu(edges, pos, unl, prior), prior

