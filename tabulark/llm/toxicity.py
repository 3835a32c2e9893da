"""Operator 3: toxic spans by a linear-chain conditional random field.

Labelled tokens come from labelled documents: every token of a clean document is
clean; in a toxic document those tokens are toxic whose word or stem (its first 4
to 8 letters) stands out there against the clean documents. A stem stands out by
its share of documents and by the different neighbours it occurs between, so that
the words of a toxic text that was copied often don't. The field has two tags,
transition weights and emission weights on a token's word and stems. It is fitted
by gradient ascent on the conditional likelihood.

Whole texts are tagged: forward-backward runs over a batch of documents at a time,
one vector step per token position. The marginals of a document aggregate to its
highest one, the expected number of toxic tokens, of different toxic words, and
their density; a logistic function of these, fitted with the field, is the score.
Spans are runs of tokens whose marginal reaches ``span_min``, as offsets into the text.

All fitting uses a bounded sample of the labelled training documents (about
``max_train_docs`` of each label, by a hash of the text, equal texts once).

Defined results: a null or empty text, or one without letters, gets the score of no
toxic tokens; rows with a null label or id don't train; repeated rows score equal;
without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
import sys
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WORD = re.compile(r"[^\W\d_]+")
AGGREGATES = ("highest", "expected", "words", "density", "length")
STEMS = (4, 5, 6, 7, 8)
MAX_TRAIN_DOCS, MAX_UNITS = 3000, 8000
MIN_CONTEXTS, MIN_LIFT, MIN_GAIN = 5, 4.0, 30.0   # a unit stands out by so much
TRAIN_WINDOW, EPOCHS = 64, 100
TAG_CHARS, CACHE_WORDS = 1 << 22, 300_000          # text tagged at once, words (of 64 letters at most) a worker keeps


def units(word: str) -> list[str]:
    return [word + "$", *(f"^{word[:n]}" for n in STEMS if len(word) >= n)]


def unit_counts(sample: DataFrame) -> DataFrame:
    """``unit, toxic, clean``: documents of either label with a word or stem."""
    w = F.col("w")
    each = F.array(F.concat(w, F.lit("$")), *[F.when(F.length(w) >= n, F.concat(F.lit("^"), F.substr(w, F.lit(1), F.lit(n)))) for n in STEMS])
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    rows = (sample.select("toxic", F.monotonically_increasing_id().alias("row"), F.explode(words).alias("w"))
            .select("toxic", "row", F.explode(each).alias("unit")).filter("unit is not null").distinct())
    return rows.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum(F.lit(1) - F.col("toxic")).alias("clean"))


def standing_out(toxic: float, clean: float, n1: int, n0: int) -> float:
    """Log-likelihood gain of a unit's share in toxic over that in clean documents (signed)."""
    def part(k, n, q):
        return (k * np.log(q) if k else 0.0) + ((n - k) * np.log(1 - q) if n > k else 0.0)
    if n1 < toxic or n0 < clean or not toxic + clean:
        return 0.0
    q = (toxic + clean) / (n1 + n0)
    if q >= 1:
        return 0.0
    gain = 2 * (part(toxic, n1, toxic / n1) + part(clean, n0, clean / n0) - part(toxic, n1, q) - part(clean, n0, q))
    return float(gain if toxic / n1 > clean / n0 else -gain)


class Field:
    """The fitted field: emission weights by unit, log transition weights, and the
    logistic aggregation of a document's marginals."""

    def __init__(self, terms: dict[str, int]):
        self.terms = terms                       # unit -> weight index; index 0 is the bias
        self.weights = np.zeros(len(terms) + 1)
        self.start = np.zeros(2)
        self.move = np.zeros((2, 2))
        self.logit = np.zeros(len(AGGREGATES) + 1)
        self.cache: dict[str, float] = {}

    def features(self, word: str) -> list[int]:
        return [0, *(self.terms[u] for u in units(word) if u in self.terms)]

    def score(self, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(stats @ self.logit[:-1] + self.logit[-1], -30, 30)))

    def emission(self, word: str) -> float:
        e = self.cache.get(word)
        if e is None:
            e = float(self.weights[self.features(word)].sum())
            if len(word) <= 64:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                self.cache[word] = e
        return e


def _lse(a, b):
    return np.logaddexp(a, b)


def marginals(scores: list[np.ndarray], field: Field) -> list[np.ndarray]:
    """Probability of the toxic tag at every token of every sequence."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lens = np.array([len(scores[i]) for i in order], np.int64)
    out: list[np.ndarray] = [np.zeros(0)] * len(scores)
    if len(lens) == 0 or lens[0] == 0:
        return out
    at = np.concatenate([[0], np.cumsum(lens)])
    flat = np.concatenate([scores[i] for i in order])
    fwd, back = np.empty_like(flat), np.zeros_like(flat)
    (m00, m01), (m10, m11) = field.move
    steps = int(lens[0])
    active = len(lens) - np.searchsorted(lens[::-1], np.arange(steps), "right")     # sequences longer than t
    # both passes carry log odds of the toxic tag
    r = flat[at[:active[0]]] + field.start[1] - field.start[0]
    fwd[at[:active[0]]] = r
    for t in range(1, steps):
        r = r[:active[t]]
        i = at[:active[t]] + t
        r = flat[i] + _lse(m01, m11 + r) - _lse(m00, m10 + r)
        fwd[i] = r
    b = np.zeros(0)
    for t in range(steps - 1, 0, -1):
        b = np.concatenate([b, np.zeros(active[t] - len(b))])
        x = flat[at[:active[t]] + t] + b
        b = _lse(m10, m11 + x) - _lse(m00, m01 + x)
        back[at[:active[t]] + t - 1] = b
    p = 1 / (1 + np.exp(-np.clip(fwd + back, -500, 500)))
    for k, i in enumerate(order):
        out[i] = p[at[k]:at[k + 1]]
    return out


def fit_field(sequences: list[list[str]], tags: list[np.ndarray], field: Field, epochs: int = EPOCHS,
              rate: float = 0.25, ridge: float = 1e-4) -> Field:
    """Maximum conditional likelihood by Adam over all sequences (equal lengths by padding)."""
    n, width = len(sequences), max(map(len, sequences))
    known: dict[str, int] = {}
    ids = np.zeros((n, width), np.int64)
    mask, y = np.zeros((n, width), bool), np.zeros((n, width))
    for i, (s, t) in enumerate(zip(sequences, tags)):
        ids[i, :len(s)] = [known.setdefault(w, len(known)) for w in s]
        mask[i, :len(s)], y[i, :len(s)] = True, t
    feats = [field.features(w) for w in known]
    rows = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    cols = np.concatenate([np.array(f) for f in feats])
    theta = np.concatenate([field.weights, np.zeros(3)])       # move: stay clean 0, enter, leave, stay toxic
    theta[-3:] = (-3.0, -0.5, 0.0)
    theta[0] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = mask.sum()
    for epoch in range(1, epochs + 1):
        emit = np.bincount(rows, theta[cols], len(feats))[ids]
        enter, leave, stay = theta[-3:]
        f0, f1 = np.zeros((n, width)), np.zeros((n, width))
        f1[:, 0] = emit[:, 0]
        for t in range(1, width):
            f0[:, t] = np.logaddexp(f0[:, t - 1], f1[:, t - 1] + leave)
            f1[:, t] = emit[:, t] + np.logaddexp(f0[:, t - 1] + enter, f1[:, t - 1] + stay)
        b0, b1 = np.zeros((n, width)), np.zeros((n, width))
        for t in range(width - 2, -1, -1):
            more = mask[:, t + 1]
            b0[:, t] = np.where(more, np.logaddexp(b0[:, t + 1], enter + emit[:, t + 1] + b1[:, t + 1]), 0)
            b1[:, t] = np.where(more, np.logaddexp(leave + b0[:, t + 1], stay + emit[:, t + 1] + b1[:, t + 1]), 0)
        z = np.logaddexp(f0[:, 0] + b0[:, 0], f1[:, 0] + b1[:, 0])[:, None]
        p1 = np.exp(f1 + b1 - z)
        pair = mask[:, 1:]
        into = np.exp(f0[:, :-1] + enter + emit[:, 1:] + b1[:, 1:] - z)
        out = np.exp(f1[:, :-1] + leave + b0[:, 1:] - z)
        keep = np.exp(f1[:, :-1] + stay + emit[:, 1:] + b1[:, 1:] - z)
        err = np.where(mask, y - p1, 0)
        grad = np.zeros_like(theta)
        grad[:-3] = np.bincount(cols, np.bincount(ids.ravel(), err.ravel(), len(feats))[rows], len(theta) - 3)
        a, c = y[:, :-1], y[:, 1:]
        for k, (seen, want) in enumerate(((into, (1 - a) * c), (out, a * (1 - c)), (keep, a * c))):
            grad[len(theta) - 3 + k] = ((want - seen) * pair).sum()
        grad = grad / total * 100 - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + rate * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.999 ** epoch)) + 1e-8)
    field.weights = theta[:-3]
    field.move = np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]])
    return field


def aggregate(words: list[str], p: np.ndarray) -> list[float]:
    """The statistics of one document's marginals that make its score."""
    if len(p) == 0:
        return [0.0, 0.0, 0.0, np.log(0.05 / 20), 0.0]
    best: dict[str, float] = {}
    for i in np.flatnonzero(p > 0.02).tolist():
        if p[i] > best.get(words[i], 0.0):
            best[words[i]] = float(p[i])
    kinds = sum(best.values())
    return [float(p.max()), float(np.log1p(p.sum())), float(np.log1p(kinds)), float(np.log((kinds + 0.05) / (len(p) + 20))),
            float(np.log1p(len(p)))]


def _tagged(texts: list[str | None], field: Field) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(row, words, marginals) of all texts, 4 MB at a time."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size < TAG_CHARS):
            size += len(texts[hi] or "")
            hi += 1
        words = [WORD.findall((t or "").lower()) for t in texts[lo:hi]]
        emission = field.emission
        for i, p in enumerate(marginals([np.fromiter(map(emission, ws), np.float64, len(ws)) for ws in words], field)):
            yield lo + i, words[i], p
        lo = hi


def _stats(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [aggregate(w, p) for _, w, p in _tagged(batch.column("text").to_pylist(), field)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"])
    return run


def fit_logit(x: np.ndarray, y: np.ndarray, prior: float, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, either label weighing one half, then moved to the ``prior``."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    theta = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        g = z.T @ (w * (y - p)) - ridge * theta
        h = (z * (w * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(theta))
        step = np.linalg.solve(h, g)
        theta = theta + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    theta[-1] += np.log(prior / (1 - prior))
    return theta


def fit_toxicity(train: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> Field | None:
    """Fit on ``train`` (``text``, ``toxic`` 0 or 1); null without both labels."""
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    prior = sizes[1] / (sizes[0] + sizes[1])
    million = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    share = F.when(F.col("toxic") == 1, max_train_docs / sizes[1]).otherwise(max_train_docs / sizes[0])
    sample = materialize(train.filter(million < share * 1_000_000).select("text", F.col("toxic").cast("int").alias("toxic"))
                         .dropDuplicates(["text"]))
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n0 or not n1:
        return None
    odds = F.abs(F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5) * (n0 / n1)))
    telling = (unit_counts(sample).filter(F.col("toxic") + F.col("clean") >= 4)
               .orderBy((odds * F.sqrt(F.col("toxic") + F.col("clean"))).desc(), "unit").limit(MAX_UNITS).collect())
    field = Field({r["unit"]: i + 1 for i, r in enumerate(telling)})
    high = {r["unit"] for r in telling if standing_out(r["toxic"], r["clean"], n1, n0) >= MIN_GAIN
            and r["toxic"] / n1 >= MIN_LIFT * r["clean"] / n0}
    seen: dict[str, set] = {u: set() for u in high}
    found = []
    for r in sample.orderBy(F.xxhash64("text")).toLocalIterator():             # bounded by the sample
        text, label = r["text"], r["toxic"]
        words = [sys.intern(w) for w in WORD.findall(text.lower())]
        hits = [(i, [u for u in units(w) if u in high]) for i, w in enumerate(words)] if label else []
        found.append((words, [(i, us) for i, us in hits if us]))
        for i, us in found[-1][1]:
            near = hash((words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
            for u in us:
                if len(seen[u]) < MIN_CONTEXTS:
                    seen[u].add(near)
    bad = {u for u, c in seen.items() if len(c) >= MIN_CONTEXTS}
    sequences, tags = [], []
    for words, hits in found:
        hit = np.zeros(len(words))
        hit[[i for i, us in hits if any(u in bad for u in us)]] = 1
        starts = list(range(0, len(words), TRAIN_WINDOW))
        # windows with toxic tokens and a few others, drawn from the whole text
        starts.sort(key=lambda s: zlib.crc32(" ".join(words[s:s + TRAIN_WINDOW]).encode("utf-8", "surrogatepass")))
        held = [s for s in starts if hit[s:s + TRAIN_WINDOW].any()][:6]
        for s in held + [s for s in starts if s not in held][:2]:
            sequences.append(words[s:s + TRAIN_WINDOW])
            tags.append(hit[s:s + TRAIN_WINDOW])
    del found
    if not sequences:
        return None
    fit_field(sequences, tags, field)
    stats = sample.mapInArrow(_stats(field), "toxic int, x array<double>").toPandas()
    field.logit = fit_logit(np.array(stats["x"].to_list()), stats["toxic"].to_numpy(), prior)
    field.cache.clear()
    return field


def _score(field: Field | None, span_min: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            score, spans = np.zeros(len(texts)), [[] for _ in texts]
            if field is not None:
                x = np.zeros((len(texts), len(AGGREGATES)))
                for i, words, p in _tagged(texts, field):
                    x[i] = aggregate(words, p)
                    if len(p) and p.max() >= span_min:
                        spans[i] = _spans(texts[i], p, span_min)
                score = field.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=["doc_id", "score", "spans"])
    return run


def _spans(text: str, p: np.ndarray, span_min: float) -> list[dict[str, int]]:
    """Character ranges of runs of toxic tokens."""
    out, last = [], -2
    low = text.lower()
    for i, m in enumerate(WORD.finditer(low)):
        if p[i] >= span_min:
            if last == i - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = i
    if len(low) != len(text):                          # some characters have longer small forms
        ends = list(accumulate(len(c.lower()) for c in text))
        for span in out:
            span["start"], span["end"] = bisect_right(ends, span["start"]), bisect_left(ends, span["end"]) + 1
    return out


def toxic_spans(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text",
                span_min: float = 0.5) -> DataFrame:
    """One row per input row: ``doc_id, score`` and the toxic ``spans``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_score(field, span_min), f"doc_id {kind}, score double, spans array<struct<start:int,end:int>>")
