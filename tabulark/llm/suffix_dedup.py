"""Operator 1: exact removal of repeated passages by blockwise suffix sorting.

A byte goes if it lies in a string of ``length`` (50) bytes that also starts in a
document with a smaller id. Only suffixes that can tie on ``length`` bytes have
to meet, so the suffixes are not range-partitioned by their first bytes but by
the *minimizer* of their first ``length`` bytes (the 12-byte string with the
smallest hash, leftmost on ties): equal strings have equal minimizers, and a run
of neighbouring suffixes with one minimizer travels as one short context. Each
bucket of minimizers is then one block of the suffix order:

* contexts are grouped on the minimizer; a group seen in one document ends there;
* equal contexts in different documents settle all of their suffixes at once;
* only suffixes of contexts that differ are sorted: by their first 16 bytes, and
  ties by a difference cover {0,1,3} mod 7. The suffixes at cover positions are
  ranked once; two tied suffixes i, j have an offset d < 7 at which both are
  cover positions, and compare by the ranks at i+d, j+d. Neighbours in that order
  which agree on ``length`` bytes are repeats.

Blocks are sized by bytes; a copy group is collapsed in the map task before the
shuffle (a context whose equal is in a smaller document of the same batch is
settled there). A minimizer with very many different contexts (the edges of a
passage that stands in a large share of all documents, a very frequent string)
would be one block however many there are, so its suffixes travel one by one and
are dealt by their own ``length`` bytes. Which minimizers are that heavy is
estimated from a sample; it decides the way to a block, not the result. The driver
gets one byte count and the hashes of at most ``HEAVY_AT_MOST`` heavy minimizers.

Defined results: a null text is an empty one; texts below ``length`` bytes lose
nothing; a null ``doc_id`` ranks after all ids; rows with one id never remove each
other's bytes (repeated rows get equal results); an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import PAD, U64, bounds, mix64, pack, ragged, text_blocks, unpack

GRAM = 12                    # bytes of a minimizer
COVER, PERIOD = (0, 1, 3), 7  # every difference mod 7 occurs among the cover
NULL_ID = (1 << 63) - 1
BLOCK_BYTES = 1 << 18        # text per minimizer pass (fits a core's cache)
FLUSH_BYTES = 1 << 23        # text per map-side collapse
BUCKET_BYTES = 1 << 22       # text whose contexts share a bucket
WINDOWS_AT_ONCE = 1 << 16    # suffixes sorted at once (in a core's cache)
BATCH_BYTES = 1 << 20        # packed contexts sent at once
HEAVY = 1 << 18              # different contexts of a minimizer that is dealt suffix by suffix
HEAVY_AT_MOST = 100_000
SAMPLE_BYTES = 1 << 28       # text sampled for heavy minimizers, if that finds SAMPLE_HITS of each
SAMPLE_HITS = 50
SURE_BYTES = 1 << 24         # texts this long are always in the sample
LEVEL = 6                    # compression of packed contexts, most of what is shuffled
CONTEXT_BYTES = 16           # text a context stands for, at least, in the size of a map-side collapse


def _view(data: np.ndarray, kind: str, spare: int = 8) -> np.ndarray:
    """Values of ``kind`` at every byte position of padded data."""
    return np.ndarray((len(data) - spare,), kind, data, 0, (1,))


def _gram_hash(data: np.ndarray) -> np.ndarray:
    a = _view(data, "<u8", PAD) * U64(0x9E3779B97F4A7C15)
    b = np.ndarray((len(data) - PAD,), "<u4", data, 8, (1,)).astype(U64) * U64(0xC2B2AE3D27D4EB4F)
    h = a + b
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


def contexts(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one minimizer: (document row, first byte, bytes, minimizer position, hash)."""
    n, w = len(data) - PAD, length - GRAM + 1
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, U64),)
    if n < length:
        return none
    h = _gram_hash(data)
    m = (h & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
    s = 1
    while 2 * s <= w:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    m = np.minimum(m[:len(m) - (w - s)], m[w - s:])[:n - length + 1]
    a = (m & U64(0xFFFFFFFF)).astype(np.int64)
    lens = np.diff(off)
    long = np.flatnonzero(lens >= length)
    if len(long) == 0:
        return none
    firsts, lasts = off[long], off[long + 1] - length      # first and last suffix of a document
    edge = np.zeros(len(a) + 1, bool)
    edge[1:-1] = a[1:] != a[:-1]
    edge[firsts] = True
    edge[lasts + 1] = True
    valid = np.zeros(len(a) + 1, np.int8)
    valid[firsts] += 1
    valid[lasts + 1] -= 1
    inside = np.cumsum(valid)
    p = np.flatnonzero(edge)
    ends = np.append(p[1:], len(a))
    keep = inside[p] > 0
    p, last = p[keep], ends[keep] - 1
    row = np.searchsorted(off, p, "right") - 1
    return row, p, last - p + length, a[p], h[a[p]]


def _apart(data: np.ndarray, found: tuple[np.ndarray, ...], heavy: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``contexts`` with those of heavy minimizers cut into single suffixes, hashed by their own bytes."""
    row, p, ln, a, h = found
    if len(heavy) == 0 or len(h) == 0:
        return found
    hot = heavy[np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)] == h
    if not hot.any():
        return found
    many = ln[hot] - length + 1
    at = ragged(p[hot], many)
    size = np.full(len(at), length, np.int64)
    out = [np.concatenate([x[~hot], y]) for x, y in zip(found, (
        np.repeat(row[hot], many), at, size, np.repeat(a[hot], many), _content_hash(data, at, size, length)))]
    order = np.lexsort((out[1], out[0]))                       # rows together, as before
    return tuple(x[order] for x in out)


def _content_hash(data: np.ndarray, p: np.ndarray, ln: np.ndarray, longest: int) -> np.ndarray:
    w, out = _view(data, "<u8"), mix64(ln.astype(U64))
    for j in range((longest + 7) // 8):
        out = mix64(out + _word(w, p, ln, j) * U64(0x9E3779B97F4A7C15))
    return out


def _word(w: np.ndarray, p: np.ndarray, ln: np.ndarray, j: int) -> np.ndarray:
    """The j-th 8 bytes of every context, zero behind its end."""
    left = np.clip(ln - 8 * j, 0, 8)
    mask = np.where(left == 8, ~U64(0), (U64(1) << (left.astype(U64) * U64(8))) - U64(1))
    return w[np.minimum(p + 8 * j, len(w) - 1)] & mask


def _settled(order, starts, doc, same):
    """Of runs of equal contexts: which lie in a larger document than the run's smallest."""
    low = np.minimum.reduceat(doc[order], starts)
    size = np.diff(np.append(starts, len(order)))
    late = doc[order] > np.repeat(low, size)
    gone = np.zeros(len(order), bool)
    gone[order] = late & same
    return gone


def _merge(doc, th, s, e):
    """Overlapping and touching ranges of one document become one."""
    if len(doc) == 0:
        return doc, th, s, e
    o = np.lexsort((s, th, doc))
    doc, th, s, e = doc[o], th[o], s[o], e[o]
    new = np.append(True, (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]))
    base = np.cumsum(new).astype(np.int64) * (int(e.max()) + 2)   # documents apart on one line
    top = np.maximum.accumulate(base + e)
    cut = np.flatnonzero(np.append(True, (base + s)[1:] > top[:-1]))
    return doc[cut], th[cut], s[cut], (top - base)[np.append(cut[1:] - 1, len(top) - 1)]


def _flush(parts, length, n_buckets):
    """Collapse the copies inside a map batch and pack the rest by bucket."""
    at, cols, datas = 0, [], []
    for ids, ths, data, off, (row, p, ln, a, h) in parts:
        cols.append((ids[row], ths[row], p - off[row], p + at, ln, a - p, h))
        datas.append(data[:-PAD])
        at += len(data) - PAD
    doc, th, rel, p, ln, ao, h = (np.concatenate(x) for x in zip(*cols))
    if len(doc) == 0:
        return
    data = np.concatenate([*datas, np.zeros(PAD, np.uint8)])
    longest = 2 * length - GRAM
    c = _content_hash(data, p, ln, longest)
    order = np.argsort(c)
    starts = bounds(c[order])
    first = np.repeat(order[starts], np.diff(np.append(starts, len(order))))
    same = ln[order] == ln[first]
    again = np.flatnonzero(order != first)                     # verify copies byte by byte
    w = _view(data, "<u8")
    for j in range((longest + 7) // 8):
        x, y = order[again], first[again]
        same[again] &= _word(w, p[x], ln[x], j) == _word(w, p[y], ln[y], j)
    gone = _settled(order, starts, doc, same)
    gd, gt, gs, ge = _merge(doc[gone], th[gone], rel[gone], rel[gone] + ln[gone])
    live = np.flatnonzero(~gone)
    bucket = ((mix64(h[live]) >> U64(20)) % U64(n_buckets)).astype(np.int64)
    live = live[np.argsort(bucket, kind="stable")]
    bucket = np.sort(bucket)
    gb = gs % n_buckets
    cuts, gorder = np.searchsorted(bucket, np.arange(n_buckets + 1)), np.argsort(gb, kind="stable")
    gcuts = np.searchsorted(gb[gorder], np.arange(n_buckets + 1))
    for b in np.union1d(bucket, gb).tolist():
        i, g = live[cuts[b]:cuts[b + 1]], gorder[gcuts[b]:gcuts[b + 1]]
        d, t, r = doc[i], th[i], rel[i]
        new = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]))[:len(i)])
        step = np.diff(r, prepend=0)
        step[new] = r[new]
        yield b, pack([d[new], t[new], np.diff(np.append(new, len(i))).astype("<u4"), step.astype("<i4" if len(i) == 0 or abs(step).max() < 2 ** 31 else "<i8"),
                       ln[i].astype("u1"), ao[i].astype("u1"), data[ragged(p[i], ln[i])], gd[g], gt[g], gs[g], ge[g]], LEVEL)


def _map_contexts(length: int, n_buckets: int, heavy: np.ndarray = np.zeros(0, U64)):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(out):
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())],
                names=["bucket", "blob"])

        def rows(parts):
            out, size = [], 0
            for b, blob in _flush(parts, length, n_buckets):
                out.append((b, blob))
                size += len(blob)
                if size >= BATCH_BYTES:
                    yield batch(out)
                    out, size = [], 0
            if out:
                yield batch(out)

        parts, held = [], 0
        for block, data, off in text_blocks(batches, "text", BLOCK_BYTES):
            ids = block.column("ord").to_numpy().copy()           # a view would hold the batch and its texts
            ths = block.column("th").to_numpy().copy()
            found = _apart(data, contexts(data, off, length), heavy, length)
            parts.append((ids, ths, data, off, found))
            held += max(len(data), CONTEXT_BYTES * len(found[0]))
            if held >= FLUSH_BYTES:
                yield from rows(parts)
                parts, held = [], 0
        if parts:
            yield from rows(parts)
    return run


def _sampled_contexts(length: int):
    """The different contexts of a sample: minimizer's hash, content's hash, rows of the corpus a sampled row stands for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, off in text_blocks(batches, "text", BLOCK_BYTES):
            row, p, ln, _, h = contexts(data, off, length)
            c = _content_hash(data, p, ln, 2 * length - GRAM)
            o = np.lexsort((c, h))
            o = o[np.append(True, (h[o][1:] != h[o][:-1]) | (c[o][1:] != c[o][:-1]))[:len(o)]]
            yield pa.RecordBatch.from_arrays([pa.array(h[o].view(np.int64)), pa.array(c[o].view(np.int64)),
                                              block.column("weight").take(pa.array(row[o]))], names=["h", "c", "weight"])
    return run


def heavy_minimizers(rows: DataFrame, total: int, length: int) -> np.ndarray:
    """Sorted hashes of the minimizers estimated to have ``HEAVY`` different contexts or more."""
    if total < HEAVY:                                          # no text has more contexts than bytes
        return np.zeros(0, U64)
    share = min(1.0, max(SAMPLE_HITS / HEAVY, min(1 / 64, SAMPLE_BYTES / total)))
    drawn = rows.select("text", F.least(F.lit(1.0), F.greatest(F.lit(share), F.octet_length("text") / SURE_BYTES)).alias("q"))
    drawn = drawn.filter(F.rand(7) < F.col("q")).select("text", (1 / F.col("q")).alias("weight"))
    found = (drawn.mapInArrow(_sampled_contexts(length), "h long, c long, weight double")
             .groupBy("h", "c").agg(F.max("weight").alias("weight")).groupBy("h").agg(F.sum("weight").alias("n"))
             .filter(F.col("n") >= HEAVY).orderBy(F.desc("n"), "h").limit(HEAVY_AT_MOST).collect())
    return np.sort(np.array([r["h"] for r in found], np.int64).view(U64))


def _cover_table() -> list[list[int]]:
    return [[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER)
             for b in range(PERIOD)] for a in range(PERIOD)]


def suffix_classes(flat: np.ndarray, pos: np.ndarray, group: np.ndarray, doc: np.ndarray,
                   length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes of one block within ``group``; returns ``(index, class)`` of
    those that agree on ``length`` bytes with a neighbour, classes numbered in order.
    ``flat`` is zero-padded by ``PAD`` bytes."""
    big = _view(flat, ">u8")
    w0, w1 = big[pos].astype(U64), big[pos + 8].astype(U64)
    # suffixes whose group and first bytes have a hash of their own, or of one document, tie with none
    key = mix64((w0 + mix64(group.astype(U64))) * U64(0x9E3779B97F4A7C15) ^ mix64(w1))
    order = np.argsort(key)
    starts = bounds(key[order])
    low, high = np.minimum.reduceat(doc[order], starts), np.maximum.reduceat(doc[order], starts)
    order = order[np.repeat(low != high, np.diff(np.append(starts, len(order))))]
    if len(order) == 0:
        return order, order
    order = order[np.lexsort((w1[order], w0[order], group[order]))]
    g, a, b = group[order], w0[order], w1[order]
    starts = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    low, high = np.minimum.reduceat(doc[order], starts), np.maximum.reduceat(doc[order], starts)
    size = np.diff(np.append(starts, len(order)))
    tied = np.repeat(low != high, size)                       # ties that span documents
    idx, tie = order[tied], np.repeat(np.arange(len(starts)), size)[tied]
    if len(idx) == 0:
        return idx, idx
    p, res = pos[idx], pos[idx] % PERIOD
    sample = np.unique(np.concatenate([(p + d)[np.isin((p + d) % PERIOD, COVER)] for d in range(PERIOD)]))
    keys = [big[sample + 8 * j].astype(U64) for j in range((length + 7) // 8)]
    so = np.lexsort(keys[::-1])
    differs = np.zeros(len(so), bool)
    for k in keys:
        differs[1:] |= k[so][1:] != k[so][:-1]
    rank = np.empty(len(so), np.int64)
    rank[so] = np.cumsum(differs)                              # precomputed ranks of the cover sample
    del keys, so, differs
    many, table = len(sample) + 1, _cover_table()
    before = np.zeros(len(idx), np.int64)
    members = [np.flatnonzero(res == r) for r in range(PERIOD)]
    at = {}
    for r in range(PERIOD):
        for d in {*table[r]}:
            at[r, d] = tie[members[r]] * many + rank[np.searchsorted(sample, p[members[r]] + d)]
    for r in range(PERIOD):
        mine = members[r]
        if len(mine) == 0:
            continue
        for other in range(PERIOD):
            if len(members[other]):
                d = table[r][other]
                theirs = np.sort(at[other, d])
                before[mine] += np.searchsorted(theirs, at[r, d]) - np.searchsorted(theirs, tie[mine] * many)
    o = np.lexsort((before, tie))
    idx, tie = idx[o], tie[o]
    equal = tie[1:] == tie[:-1]
    q = pos[idx]
    for at_byte in [*range(0, length - 7, 8), length - 8]:     # neighbours: compare all bytes
        x = big[q + at_byte]
        equal &= x[1:] == x[:-1]
    return idx, np.cumsum(np.append(True, ~equal))


def _sort_bucket(length: int):
    longest = 2 * length - GRAM
    width = (longest + 7) // 8

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cols, done = [], []
        for blob in pdf["blob"]:
            d, t, many, step, ln, ao, raw, *g = unpack(blob)
            done.append(g)
            n = len(ln)
            ln64 = ln.astype(np.int64)
            total = np.cumsum(step.astype(np.int64))
            new = np.cumsum(np.append([0], many[:-1].astype(np.int64))) if len(many) else np.zeros(0, np.int64)
            rel = total - np.repeat(total[new] - step[new], many)
            cols.append([np.repeat(d, many), np.repeat(t, many), rel, ln64, ao.astype(np.int64), raw])
        doc, th, rel, ln, ao = (np.concatenate([c[i] for c in cols]) for i in range(5))
        flat, at = np.zeros(len(doc) * width * 8 + PAD, np.uint8), 0
        for c in cols:                                # a context each ``width`` words, zero behind its end
            end = at + len(c[3]) * width * 8
            flat[at:end].reshape(-1, width * 8)[np.arange(width * 8) < c[3][:, None]] = c.pop()
            at = end
        del cols
        found = [tuple(np.concatenate(x) for x in zip(*done))]
        if len(doc):
            found += _repeats(flat, width, doc, th, rel, ln, ao, length)
        doc, th, s, e = (np.concatenate(x) for x in zip(*found))
        doc, th, s, e = _merge(doc, th, s, e)
        return pd.DataFrame({"ord": doc, "th": th, "s": s, "e": e})
    return run


def _repeats(flat, width, doc, th, rel, ln, ao, length) -> list[tuple[np.ndarray, ...]]:
    n, size = len(doc), width * 8
    base = np.arange(n) * size
    lo, w = _view(flat, "<u8"), _view(flat, "<u8")
    gram = mix64(lo[base + ao] * U64(0x9E3779B97F4A7C15)
                 + np.ndarray((len(flat) - PAD,), "<u4", flat, 8, (1,))[base + ao].astype(U64))
    order = np.argsort(gram)
    starts = bounds(gram[order])
    low, high = np.minimum.reduceat(doc[order], starts), np.maximum.reduceat(doc[order], starts)
    order = order[np.repeat(low != high, np.diff(np.append(starts, n)))]   # minimizers of two documents
    if len(order) == 0:
        return []
    c = mix64(ln[order].astype(U64))
    for j in range(width):
        c = mix64(c + w[base[order] + 8 * j] * U64(0x9E3779B97F4A7C15))
    o = np.lexsort((th[order], doc[order], c, gram[order]))
    order, c = order[o], c[o]
    g = gram[order]
    run = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])))
    count = np.diff(np.append(run, len(order)))
    head = np.repeat(order[run], count)
    same = np.ones(len(order), bool)
    again = np.flatnonzero(order != head)             # all but a run's first are compared with it
    x, y = order[again], head[again]
    equal = ln[x] == ln[y]
    for j in range(width):
        equal &= w[base[x] + 8 * j] == w[base[y] + 8 * j]
    same[again] = equal
    late = doc[order] > doc[head]
    gone = order[late & same]
    out = [(doc[gone], th[gone], rel[gone], rel[gone] + ln[gone])]
    live = order[~late | ~same]                       # of each run: its smallest document's members
    # a run's suffixes are sorted once, through its first member; the others take over its result
    is_head = (live == np.repeat(order[run], count)[~late | ~same]) | ~same[~late | ~same]
    heads = np.flatnonzero(is_head)
    shared = np.diff(np.append(heads, len(live)))
    rep = live[heads]
    gr = gram[rep]
    gs = bounds(gr)
    per = np.diff(np.append(gs, len(rep)))
    several = np.minimum.reduceat(doc[rep], gs) != np.maximum.reduceat(doc[rep], gs)
    windows = np.add.reduceat(ln[rep] - length + 1, gs)
    picked = np.flatnonzero(several)
    reach = length - GRAM + 1
    jobs, i = [], 0
    while i < len(picked):                            # blocks of a bounded number of suffixes
        k, total = i, 0
        while k < len(picked) and (total == 0 or total + windows[picked[k]] <= WINDOWS_AT_ONCE):
            total += windows[picked[k]]
            k += 1
        members = ragged(gs[picked[i:k]], per[picked[i:k]])
        pieces = 1 if k - i > 1 or total <= WINDOWS_AT_ONCE else min(reach, -(-int(total) // WINDOWS_AT_ONCE))
        jobs += [(members, reach * q // pieces, reach * (q + 1) // pieces) for q in range(pieces)]
        i = k
    for members, r_lo, r_hi in jobs:
        ctx = rep[members]
        # suffixes whose minimizer stands r bytes into them, r in [r_lo, r_hi)
        lo_off = np.maximum(0, ao[ctx] - r_hi + 1)
        hi_off = np.minimum(ln[ctx] - length, ao[ctx] - r_lo)
        many = np.maximum(0, hi_off - lo_off + 1)
        if many.sum() == 0:
            continue
        which = np.repeat(np.arange(len(ctx)), many)
        offs = ragged(lo_off, many)
        gid = np.cumsum(np.append(False, gram[ctx][1:] != gram[ctx][:-1]))[which] * (reach + 1) + (ao[ctx][which] - offs)
        d = doc[ctx][which]
        idx, cls = suffix_classes(flat, base[ctx][which] + offs, gid, d, length)
        if len(idx) == 0:
            continue
        st = bounds(cls)
        least = np.repeat(np.minimum.reduceat(d[idx], st), np.diff(np.append(st, len(idx))))
        hit = np.sort(idx[d[idx] > least])            # suffixes are numbered context by context
        if len(hit) == 0:
            continue
        cut = np.append(True, (hit[1:] != hit[:-1] + 1) | (which[hit[1:]] != which[hit[:-1]]))
        f, l = hit[cut], hit[np.append(np.flatnonzero(cut)[1:] - 1, len(hit) - 1)]
        m = members[which[f]]
        copies = shared[m]
        who = live[ragged(heads[m], copies)]
        s, e = np.repeat(offs[f], copies), np.repeat(offs[l] + length, copies)
        out.append((doc[who], th[who], rel[who] + s, rel[who] + e))
    return out


def _zip_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        texts = b.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b.column("rest"), b.column("ord"), b.column("th"),
             pa.array([z.compress(t) for t in texts], pa.binary())], names=["rest", "ord", "th", "z"])


def _cut(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            out = [[] for _ in range(6)]
            for z, ranges in zip(b.column("z").to_pylist(), b.column("ranges").to_pylist()):
                text = unzip.decompress(z)
                spans = []
                for s, e in sorted((r["s"], r["e"]) for r in ranges or ()):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([s, e])
                rest, at = [], 0
                for s, e in spans:
                    rest.append(text[at:s])
                    at = e
                kept = b"".join([*rest, text[at:]])
                chars = None
                if keep_text:       # characters that lost some of their bytes go as a whole
                    chars = b"".join(x for x in [*rest, text[at:]]).decode("utf-8", "ignore") if spans else text.decode("utf-8", "replace")
                for o, v in zip(out, (len(text), sum(e - s for s, e in spans), len(spans),
                                      hashlib.sha256(kept).hexdigest(), chars,
                                      [{"s": s, "e": e} for s, e in spans])):
                    o.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                     pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [b.column("rest"), *(pa.array(o, k) for o, k in zip(out, kinds))],
                names=["rest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "spans"])
    return run


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's other columns, the id's rank key, a hash that tells rows with one id apart (0 if ids are
    unique, as it travels with every context), and the text as bytes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    shared = docs.groupBy(key.alias("ord")).count().filter("count > 1").limit(1).count()
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("rest")
    return docs.select(rest, key.alias("ord"),
                       (F.xxhash64(text) if shared else F.lit(0).cast("long")).alias("th"), text.cast("binary").alias("text"))


def repeated_ranges(rows: DataFrame, length: int = 50, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(ord, th, s, e)``: byte ranges made of strings of ``length`` bytes that start in a smaller document too."""
    if not 2 * GRAM <= length <= 120:
        raise ValueError(f"length must be {2 * GRAM} to 120 bytes")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = int(max(32, -(-total // bucket_bytes)))
    packed = rows.select("ord", "th", "text").mapInArrow(
        _map_contexts(length, n_buckets, heavy_minimizers(rows, total, length)), "bucket int, blob binary")
    return packed.groupBy("bucket").applyInPandas(_sort_bucket(length), "ord long, th long, s long, e long")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                 keep_text: bool = True, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: ``rest`` (a struct of its columns but the text), ``n_bytes,
    n_removed, n_spans, kept_sha256`` plus ``kept_text`` (null unless ``keep_text``; a
    character that lost some of its bytes goes as a whole) and the removed ``spans`` as
    byte ranges."""
    rows = keyed(docs, id_col, text_col)
    ranges = (repeated_ranges(rows, length, bucket_bytes)
              .groupBy("ord", "th").agg(F.collect_list(F.struct("s", "e")).alias("ranges")))
    kind = rows.schema["rest"].dataType.simpleString()
    texts = rows.mapInArrow(_zip_text, f"rest {kind}, ord long, th long, z binary")
    joined = texts.join(ranges, ["ord", "th"], "left").select("rest", "z", "ranges")
    return joined.mapInArrow(
        _cut(keep_text), f"rest {kind}, n_bytes long, n_removed long, n_spans long, "
        "kept_sha256 string, kept_text string, spans array<struct<s:long,e:long>>")
