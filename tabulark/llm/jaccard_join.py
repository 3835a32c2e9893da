"""Operator 9: exact Jaccard join of word-shingle sets by universe partition.

Sets are banded by size. For the pairs whose smaller set is in a band, the hash
universe is cut into segments. Two sets of Jaccard >= t differ in at most ``H``
elements, so by the pigeonhole principle some segment differs in fewer elements
than its *allowance*, if allowances sum to over ``H``: allowance 1 is an equal
segment (one signature), allowance 2 a segment equal but for one element (the
segment and its one-deletion neighbourhood). Per band the allocation of
allowances is the cheapest under a cost of signatures emitted plus candidates
expected. Empty remainders are never emitted, as they would meet each other all
over the corpus; the allowances they lose come out of a slack in the allocation,
and a set that loses more than the slack also emits a prefix-filter signature per
prefix element, which is complete by itself.

Signatures travel packed, one row per task and bucket. Sets are known by a 128-bit
digest, so copies are one node from the start. A signature that many sets share
(a passage that stands in many texts) need not bring pairs: equal segments have
equal signatures, so dropping it costs each set the same allowance, and a set whose
slack covers all it loses that way still meets every partner elsewhere. Only sets
that lose more (near copies of one text) are compared inside such groups.

A pair is first held against a sketch (how many elements fall into each of 128
cells; the differences bound the symmetric difference from below, so only certain
misses go) and then verified exactly on its shingles. The groups of a family of near
copies hold nearly the same sets, so a group goes by the least hash rank among its
members: groups that agree on it are one, and a set is listed once for each, not once
for every signature it shares. Groups of a family that still differ are then joined, where
that brings no more comparisons than a block or the groups themselves (``families``). ``jaccard_links`` verifies all pairs in a group;
``jaccard_components`` needs connections only. It tests every set
once, against one of those with the same least group; then every set still apart from others of its group is tested against the few
that its sketch holds for nearest, with more a round, until a round leaves no pair of
different components untested. The first rounds stay inside blocks of a group. All of
this works on numbered sets; ids come in at the end, where sets that stand under one id
are joined by edges of their own.

Defined results: null and empty texts have the empty set and link with nothing; a
null ``doc_id`` makes a document of its own, reported with a null component unless
it reaches an id; rows with one id are one document, also if their texts differ
(``jaccard_keepers`` goes by the texts alone); an empty table gives an empty one. Two sets whose 64-bit shingle hashes collide would be taken for closer than
they are (chance about 2**-64 per shingle pair).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .blocks import U64, mix64, pack, ragged, text_blocks, unpack
from .components import components
from .shingles import bounds, digests, shingle_sets

RATIO = 1.5                    # size bands
BLOCK_BYTES = 1 << 18
FLUSH_BYTES = 1 << 24
BUCKET_BYTES = 1 << 24         # text whose signatures share a bucket
SMALL_GROUP = 8                # signatures of more sets are dropped where slack covers that
EXTRA = 0.15                   # slack for dropped signatures, as a share of the allowances needed
CELLS = 128                    # cells of a sketch
BLOCK_MEMBERS = 2048           # members of a large group compared at once
BIN_MEMBERS = 25_000           # members of small groups handed to one call
HELD_PAIRS = 500_000           # pairs a call holds before it makes them distinct
NEAREST, STEP = 2, 4           # partners a set is tested against in the first round, and their growth a round
INSIDE = 2                     # rounds that compare inside blocks only
BROADCAST_NODES = 200_000      # ids sent to all tasks at most (8 bytes each)
_SEG, _ELEM, _RANK = U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3)


# ---- allocation ----------------------------------------------------------------

def band_of(n: int) -> tuple[int, int]:
    lo = 1
    while True:
        hi = max(lo, int(lo * RATIO))
        if n <= hi:
            return lo, hi
        lo = hi + 1


@lru_cache(maxsize=None)
def most_different(n: int, percent: int) -> int:
    """Largest symmetric difference of a set of ``n`` and one no smaller with the similarity."""
    return max(n + m - 2 * -(-percent * (n + m) // (100 + percent)) for m in range(n, 100 * n // percent + 1)) \
        if n < 200 else (n + 100 * n // percent) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def allocate(lo: int, hi: int, percent: int) -> tuple[int, int, int]:
    """(segments with allowance 2, segments with allowance 1, slack) of the least cost.

    An emitted signature of ``j`` elements costs 1 plus the candidates it may bring,
    taken as 3 * 0.3**j."""
    need, best = most_different(hi, percent) + 1, None
    if need <= 2:                     # the whole set and its one-deletion neighbourhood
        return 1, 0, 2 - need
    for twos in range(0, need + 2) if need <= 64 else sorted({0, need // 8, need // 4, need // 2, need}):
        slack = settled = 0
        while not settled and slack < 2 * need:
            ones = max(0, need + slack - 2 * twos)
            m = twos + ones
            lam = lo / m
            lost = (ones + twos * (2 + lam)) * math.exp(-lam)
            want = math.ceil(lost + 2 * math.sqrt(lost)) + max(1, round(EXTRA * need))
            settled, slack = want <= slack, max(want, slack)
        if not settled:
            continue
        price = lambda j: 1 + 3 * 0.3 ** max(j, 0.5)
        cost = ones * price(lam) + twos * (price(lam) + lam * price(lam - 1))
        if best is None or cost < best[0]:
            best = (cost, twos, ones, 2 * twos + ones - need)
    return best[1:] if best else (0, 0, -1)       # none: sets so small have the prefix filter alone


@lru_cache(maxsize=None)
def scheme(lo: int, hi: int, n: int, percent: int) -> tuple[int, int, int, int]:
    """For a set of ``n`` in the scheme of a band: (all segments, segments it emits, twos, slack)."""
    twos, ones, slack = allocate(lo, hi, percent)
    units = most_different(min(n, hi), percent) + 1 + slack
    emits = -(-units // 2) if units <= 2 * twos else twos + units - 2 * twos
    return max(1, twos + ones), min(max(1, emits), max(1, twos + ones)), twos, slack


def signatures(h: np.ndarray, cut: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature) of the sets ``h[cut[i]:cut[i + 1]]``, and the slack each has left."""
    sizes = np.diff(cut)
    spare = np.full(len(sizes), 1 << 30, np.int64)
    rows, plans = [], []
    for n in np.unique(sizes[sizes > 0]).tolist():
        lo, hi = band_of(n)
        own = [(lo, *scheme(lo, hi, n, percent))]
        least = -(-percent * n // 100)
        if least < lo:
            below = band_of(lo - 1)
            own.append((below[0], *scheme(*below, n, percent)))
        who = np.flatnonzero(sizes == n)
        for p in own:
            rows.append(who)
            plans.append(np.tile(np.array(p, np.int64), (len(who), 1)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U64), spare
    rows, plans = np.concatenate(rows), np.concatenate(plans)
    job = np.repeat(np.arange(len(rows)), sizes[rows])
    e = h[ragged(cut[rows], sizes[rows])]
    salt = mix64(plans[:, 0].astype(U64) + _SEG)
    seg = (((mix64(e + salt[job]) >> U64(32)) * plans[job, 1].astype(U64)) >> U64(32)).astype(np.int64)
    use = seg < plans[job, 2]
    job, seg, elem = job[use], seg[use], mix64(e[use] ^ _ELEM)
    order = np.argsort(job * (int(plans[:, 1].max()) + 1) + seg, kind="stable")
    job, seg, elem = job[order], seg[order], elem[order]
    st = np.flatnonzero(np.append(True, (job[1:] != job[:-1]) | (seg[1:] != seg[:-1]))[:len(job)])
    if len(st):
        sums, count = np.add.reduceat(elem, st), np.diff(np.append(st, len(job)))
    else:
        sums, count = np.zeros(0, U64), np.zeros(0, np.int64)
    gj, gs = job[st], seg[st]
    place = mix64(salt[gj] + gs.astype(U64) * U64(0x9E3779B97F4A7C15))
    out_row, out_sig = [rows[gj]], [mix64(sums + place)]
    two = gs < plans[gj, 3]
    pick = np.repeat(two & (count > 1), count)
    group = np.repeat(np.arange(len(st)), count)[pick]
    out_row.append(rows[gj[group]])
    out_sig.append(mix64(sums[group] - elem[pick] + place[group]))          # one element deleted
    # allowances lost to empty remainders
    full = np.bincount(gj, np.where(two, np.where(count > 1, 2, 1), 1), len(rows))
    due = np.minimum(plans[:, 2], plans[:, 3]) + plans[:, 2]
    np.minimum.at(spare, rows, (plans[:, 4] - (due - full)).astype(np.int64))
    weak = np.flatnonzero(spare < 0)
    if len(weak):
        n = sizes[weak]
        prefix = n - -(-percent * n // 100) + 1
        where = np.repeat(weak, n)
        token = mix64(h[ragged(cut[weak], n)] + U64(77))
        o = np.lexsort((token, where))
        rank = np.arange(len(o)) - np.repeat(np.cumsum(n) - n, n)
        first = o[rank < np.repeat(prefix, n)]
        out_row.append(where[first])
        out_sig.append(mix64(token[first] ^ U64(0x5555)))
    return np.concatenate(out_row), np.concatenate(out_sig), spare


def sketches(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Elements per cell of each set, 255 at most."""
    row = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    cell = (h >> U64(20)) % U64(CELLS)
    counts = np.bincount(row * CELLS + cell.astype(np.int64), minlength=(len(cut) - 1) * CELLS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, CELLS)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lower bound of the symmetric difference from sketches (uint8)."""
    return (np.maximum(x, y) - np.minimum(x, y)).sum(-1, dtype=np.int64)


def _may_link(apart: np.ndarray, nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and sketches leave the similarity possible."""
    total = ny.astype(np.int64) + nx
    # common >= percent * total / (100 + percent), apart <= total - 2 * common
    return (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & ((100 + percent) * apart <= (100 - percent) * total)


# ---- tasks ---------------------------------------------------------------------

def _describe(words: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, off in text_blocks(batches, "text", BLOCK_BYTES):
            h, cut = shingle_sets(data, off, words)
            d1, d2 = digests(h, cut)
            cells = pa.array([r.tobytes() for r in sketches(h, cut)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in kept), pa.array(np.diff(cut)), pa.array(d1), pa.array(d2), cells],
                                             names=[*kept, "n_shingles", "d1", "d2", "cells"])
    return run


def _emit(words: int, percent: int, n_buckets: int):
    def flush(held):
        d1, d2, n, spare, rows, sigs, base = [], [], [], [], [], [], 0
        for h, cut in held:
            a, b = digests(h, cut)
            r, s, left = signatures(h, cut, percent)
            d1.append(a), d2.append(b), n.append(np.diff(cut)), rows.append(r + base), sigs.append(s), spare.append(left)
            base += len(a)
        d1, d2, n, spare, rows, sigs = (np.concatenate(x) for x in (d1, d2, n, spare, rows, sigs))
        order = np.lexsort((d2, d1))                       # copies of a batch: one set
        same = (d1[order][1:] == d1[order][:-1]) & (d2[order][1:] == d2[order][:-1])
        extra = np.zeros(len(d1), bool)
        extra[order[1:][same]] = True
        live = ~extra[rows]
        rows, sigs = rows[live], sigs[live]
        bucket = ((sigs >> U64(32)) % U64(n_buckets)).astype(np.int64)
        order = np.lexsort((rows, bucket))
        rows, sigs = rows[order], sigs[order]
        present = bucket[order]
        cuts = np.append(bounds(present), len(present))
        blobs = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            r, s = rows[lo:hi], sigs[lo:hi]
            st = bounds(r)
            own = r[st]
            blobs.append((int(present[lo]), pack([d1[own], d2[own], n[own].astype("<i4"), spare[own].astype("<i4"),
                                                  np.diff(np.append(st, len(r))).astype("<u4"), s])))
        if blobs:
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blobs], pa.int32()),
                                              pa.array([x for _, x in blobs], pa.binary())], names=["bucket", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, data, off in text_blocks(batches, "text", BLOCK_BYTES):
            held.append(shingle_sets(data, off, words))
            size += len(data)
            if size >= FLUSH_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)
    return run


_MET = "gid long, times int, a1 long, a2 long, an int, spare int, b1 long, b2 long"


def _meet(percent: int):
    """Signatures of a bucket -> pairs of small groups (gid null), and the members of large
    ones (b null), each once a least rank, with the number of its signatures there."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(b) for b in pdf["blob"]]
        many = np.concatenate([p[4] for p in parts]).astype(np.int64)
        d1, d2, n, spare = (np.concatenate([p[i] for p in parts]) for i in range(4))
        sig = np.concatenate([p[5] for p in parts])
        del parts
        o = np.lexsort((d2, d1))
        new = np.append(True, (d1[o][1:] != d1[o][:-1]) | (d2[o][1:] != d2[o][:-1]))
        node = np.empty(len(o), np.int64)
        node[o] = np.cumsum(new) - 1
        d1, d2, n, spare = d1[o][new], d2[o][new], n[o][new], spare[o][new]
        who = np.repeat(node, many)
        o = np.argsort(sig)
        sig, who = sig[o], who[o]
        st = bounds(sig)
        size = np.diff(np.append(st, len(sig)))
        shared = np.repeat(size > 1, size)
        sig, who = sig[shared], who[shared]
        o = np.lexsort((who, sig))
        sig, who = sig[o], who[o]
        keep = np.append(True, (sig[1:] != sig[:-1]) | (who[1:] != who[:-1]))[:len(sig)]
        sig, who = sig[keep], who[keep]
        st = bounds(sig)
        size = np.diff(np.append(st, len(sig)))
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(2, SMALL_GROUP + 1):
            m = who[st[size == k][:, None] + np.arange(k)]
            for i in range(k - 1):
                left.append(np.repeat(m[:, i], k - 1 - i)), right.append(m[:, i + 1:].ravel())
        pair = np.unique(np.concatenate(left) * len(d1) + np.concatenate(right))
        a, b = pair // max(1, len(d1)), pair % max(1, len(d1))
        ok = 100 * np.minimum(n[a], n[b]).astype(np.int64) >= percent * np.maximum(n[a], n[b]).astype(np.int64)
        a, b = a[ok], b[ok]
        big = np.flatnonzero(size > SMALL_GROUP)
        mem = who[ragged(st[big], size[big])]
        least = np.zeros(len(mem), U64)
        if len(big):
            rank = mix64(d1.view(U64) ^ _RANK) >> U64(1)   # the same order as a long
            ends = np.cumsum(size[big])
            least = np.repeat(np.minimum.reduceat(rank[mem], ends - size[big]), size[big])
        o = np.lexsort((mem, least))                       # a set once for each least rank
        mem, least = mem[o], least[o]
        first = np.flatnonzero(np.append(True, (mem[1:] != mem[:-1]) | (least[1:] != least[:-1]))[:len(mem)])
        times = np.diff(np.append(first, len(mem)))
        mem, gid = mem[first], least[first].view(np.int64)
        none = lambda x, kind: pd.array([None] * len(x), kind)
        return pd.concat([
            pd.DataFrame({"gid": none(a, "Int64"), "times": none(a, "Int32"), "a1": d1[a], "a2": d2[a], "an": n[a], "spare": spare[a],
                          "b1": pd.array(d1[b], "Int64"), "b2": pd.array(d2[b], "Int64")}),
            pd.DataFrame({"gid": pd.array(gid, "Int64"), "times": pd.array(times, "Int32"),
                          "a1": d1[mem], "a2": d2[mem], "an": n[mem], "spare": spare[mem], "b1": none(mem, "Int64"), "b2": none(mem, "Int64")})])
    return run


def _sketch_filter(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, CELLS) for c in ("ca", "cb"))
            ok = pa.array(_may_link(_apart(x, y), b.column("na").to_numpy(), b.column("nb").to_numpy(), percent))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], names=["a", "b"])
    return run


def _open_pairs(percent: int, nearest: int | None):
    """For the members of a block of a group (or of two blocks) the ``nearest`` others of other components
    that may link, by sketch; all, if None. ``more``: whether a member has others yet.

    Members of the block's commonest component are only sought, as each open pair has an end outside it."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["gid", "i", "j"], kind="stable")
        cells = np.frombuffer(b"".join(pdf["cells"]), np.uint8).reshape(-1, CELLS)
        node, n, comp, own = (pdf[c].to_numpy() for c in ("node", "n", "component", "own"))
        keys = pdf[["gid", "i", "j"]].to_numpy()
        st = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        found, held, more = [], 0, False
        for lo, hi in zip(st, np.append(st[1:], len(node))):
            names, count = np.unique(comp[lo:hi], return_counts=True)
            if len(names) == 1:
                continue
            two = keys[lo, 1] != keys[lo, 2]
            at = np.arange(lo, hi)
            for r in at[comp[lo:hi] != names[count.argmax()]]:
                ok = at[comp[lo:hi] != comp[r]]
                if two:
                    ok = ok[own[ok] != own[r]]
                apart = _apart(cells[r], cells[ok])
                may = _may_link(apart, n[r], n[ok], percent)
                ok, apart = ok[may], apart[may]
                if nearest is not None and len(ok) > nearest:
                    more = True
                    ok = ok[np.lexsort((node[ok], apart / (n[ok] + n[r])))[:nearest]]
                if len(ok):
                    found.append(np.stack([np.minimum(node[r], node[ok]), np.maximum(node[r], node[ok])], 1))
                    held += len(ok)
            if held > HELD_PAIRS:                          # groups share most of their pairs
                found = [np.unique(np.concatenate(found), axis=0)]
                held = 0
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "more": np.full(len(pairs), more)})
    return run


def _zip_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for block, data, off in text_blocks(batches, "text", BLOCK_BYTES):
            d1, d2 = digests(*shingle_sets(data, off, words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(d1), pa.array(d2),
                 pa.array([z.compress(data[off[i]:off[i + 1]].tobytes()) for i in range(len(off) - 1)], pa.binary())],
                names=["d1", "d2", "z"])
    return run


def _verify(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                b = batch.slice(lo, 64)
                sides = []
                for c in ("za", "zb"):
                    texts = [unzip.decompress(z) for z in b.column(c).to_pylist()]
                    data = np.frombuffer(b"".join(texts) + bytes(128), np.uint8)
                    sides.append(shingle_sets(data, np.cumsum([0, *map(len, texts)]), words))
                (ha, ca), (hb, cb) = sides
                common = np.array([len(np.intersect1d(ha[ca[i]:ca[i + 1]], hb[cb[i]:cb[i + 1]], True)) for i in range(b.num_rows)], np.int64)
                union = np.diff(ca) + np.diff(cb) - common
                ok = 100 * common >= percent * union
                yield pa.RecordBatch.from_arrays(
                    [b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok)),
                     pa.array(common[ok]), pa.array(union[ok])], names=["a", "b", "common", "total"])
    return run


# ---- operator ------------------------------------------------------------------

class _Join:
    """The sets of a table, numbered (``rep``), and the steps that connect them."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, row_col: str | None = None):
        if not 50 < percent <= 100:
            raise ValueError("percent must be over 50 and at most 100")
        self.words, self.percent = words, percent
        text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
        doc_id = F.col(id_col).cast("long").alias("doc_id")
        self.rows = docs.select(doc_id, text)
        rows, kept, kinds = self.rows, ["doc_id"], "doc_id long"
        if row_col is not None:
            rows, kept = docs.select(doc_id, F.col(row_col).alias("row"), text), ["doc_id", "row"]
            kinds += f", row {docs.schema[row_col].dataType.simpleString()}"
        self.docs = materialize(rows.mapInArrow(
            _describe(words, kept), f"{kinds}, n_shingles long, d1 long, d2 long, cells binary"))
        first = [F.min(F.struct(F.col("doc_id").isNull().alias("none"), *kept)).alias("first")] if row_col is not None else []
        self.classes = materialize(self.docs.filter("n_shingles > 0").groupBy("d1", "d2").agg(
            F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("cells").alias("cells"), *first)
            .withColumn("rep", F.monotonically_increasing_id()))
        self.sketches = self.classes.select("rep", "n", "cells")

    def meet(self) -> tuple[DataFrame, DataFrame]:
        """Pairs ``a, b`` of small groups, and the members ``gid, node`` of large groups that can't do without them."""
        total = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        n_buckets = int(max(32, -(-total // BUCKET_BYTES)))
        packed = self.rows.mapInArrow(_emit(self.words, self.percent, n_buckets), "bucket int, blob binary")
        met = materialize(packed.groupBy("bucket").applyInPandas(_meet(self.percent), _MET))
        reps = lambda x: self.classes.select(F.col("d1").alias(f"{x}1"), F.col("d2").alias(f"{x}2"), F.col("rep").alias(x))
        pairs = (met.filter("gid is null").select("a1", "a2", "b1", "b2").distinct()
                 .join(reps("a"), ["a1", "a2"]).join(reps("b"), ["b1", "b2"]).select("a", "b"))
        large = met.filter("gid is not null")
        members = (large.groupBy("a1", "a2").agg(F.sum("times").alias("lost"), F.min("spare").alias("spare"), F.collect_set("gid").alias("gids"))
                   .filter("lost > spare").join(reps("a"), ["a1", "a2"]).select(F.explode("gids").alias("gid"), F.col("a").alias("node")))
        return pairs, self.families(materialize(members))

    def families(self, members: DataFrame) -> DataFrame:
        """``members`` with the groups of a family of near copies as one, which lists a set once and not for each of
        them: groups go by the least group that one of their sets is in, if the family fits in a block or
        comparing it whole costs no more than comparing its groups."""
        low = members.groupBy("node").agg(F.min("gid").alias("low"))
        groups = members.join(low, "node").groupBy("gid").agg(F.min("low").alias("family"), F.count("*").cast("double").alias("k"))
        groups = materialize(groups)
        whole = members.join(groups, "gid").select("family", "node").distinct().groupBy("family").agg(F.count("*").cast("double").alias("all"))
        alone = groups.groupBy("family").agg(F.sum(F.col("k") * F.col("k")).alias("alone"))
        one = whole.join(alone, "family").filter((F.col("all") <= BLOCK_MEMBERS) | (F.col("all") * F.col("all") <= F.col("alone")))
        # decided for each group first, as a large family's sets would all meet in one task
        goes = groups.join(one.select("family", F.lit(True).alias("one")), "family", "left").select(
            "gid", F.when(F.col("one"), F.col("family")).otherwise(F.col("gid")).alias("goes"))
        return materialize(members.join(goes, "gid").select(F.col("goes").alias("gid"), "node").distinct())

    def few_against_all(self, members: DataFrame) -> DataFrame:
        """Every member once, with one of those whose least group is its own."""
        own = members.groupBy("node").agg(F.min("gid").alias("gid"))
        centres = own.groupBy("gid").agg(F.min_by("node", F.xxhash64("node")).alias("b"))
        return own.join(centres, "gid").select(F.col("node").alias("a"), "b")

    def open_pairs(self, members: DataFrame, labels: DataFrame | None = None, nearest: int | None = None,
                   turn: int | None = None) -> tuple[DataFrame, bool]:
        """Pairs ``a, b`` of a group's members in different components that sketches don't rule out, and whether
        these are all: with ``nearest``, so many a member and block; with ``turn``, inside that turn's blocks only."""
        at = members.withColumn("component", F.col("node")) if labels is None else members.join(labels, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        groups = at.groupBy("gid").agg(F.count("*").alias("k"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
        left = materialize(at.join(groups, "gid").withColumn("blocks", F.ceil(F.col("k") / BLOCK_MEMBERS).cast("int"))
                           .withColumn("own", F.pmod(F.xxhash64(F.lit(turn or 0), "node"), "blocks").cast("int"))
                           .select("gid", "node", "component", "blocks", "own"))
        seen = left.agg(F.sum("blocks").alias("copies"), F.count("*").alias("rows"), F.max("blocks").alias("most")).first()
        if not seen["rows"]:
            return left.select(F.col("node").alias("a"), F.col("node").alias("b")), True
        other = left.withColumn("o", F.col("own") if turn is not None else F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        cells = self.sketches.select(F.col("rep").alias("node"), "n", "cells")
        met = (other.join(cells, "node").withColumn("i", F.least("own", "o")).withColumn("j", F.greatest("own", "o"))
               .select("gid", "i", "j", "own", "node", "component", "n", "cells"))
        n_bins = int(max(12, -(-(seen["copies"] if turn is None else seen["rows"]) // BIN_MEMBERS)))
        found = materialize(met.groupBy(F.pmod(F.xxhash64("gid", "i", "j"), F.lit(n_bins)).alias("bin"))
                            .applyInPandas(_open_pairs(self.percent, nearest), "a long, b long, more boolean"))
        more = nearest is not None and found.agg(F.max("more")).first()[0]
        return found.select("a", "b").distinct(), not more and (turn is None or seen["most"] == 1)

    def verified(self, pairs: DataFrame, sketched: bool = False) -> DataFrame:
        """Of pairs ``a, b`` of representatives those similar enough, with their counts."""
        if not sketched:
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
            for x in ("a", "b"):
                pairs = pairs.join(self.sketches.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("cells").alias(f"c{x}")), x)
            pairs = pairs.mapInArrow(_sketch_filter(self.percent), "a long, b long")
        pairs = materialize(pairs)
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        few = 2 * pairs.count() <= BROADCAST_NODES
        want = materialize(self.classes.join(F.broadcast(wanted) if few else wanted, self.classes["rep"] == wanted["node"])
                           .select("rep", "d1", "d2", "id"))
        known = want.filter("id is not null").select(F.col("id").alias("doc_id")).distinct()
        rows = self.rows.join(F.broadcast(known) if few else known, "doc_id", "left_semi")
        if want.filter("id is null").limit(1).count():
            rows = rows.unionByName(self.rows.filter("doc_id is null"))
        # an id can have several texts: the set of each decides which it is
        zipped = rows.mapInArrow(_zip_sets(self.words), "d1 long, d2 long, z binary")
        sets = zipped.groupBy("d1", "d2").agg(F.min("z").alias("z")).join(want, ["d1", "d2"]).select("rep", "z")
        sets = materialize(sets)
        a = sets.select(F.col("rep").alias("a"), F.col("z").alias("za"))
        b = sets.select(F.col("rep").alias("b"), F.col("z").alias("zb"))
        return materialize(pairs.join(a, "a").join(b, "b").mapInArrow(
            _verify(self.words, self.percent), "a long, b long, common long, total long"))

    def connected(self) -> DataFrame:
        """All sets with the group their texts connect them to: ``d1, d2, id, group`` and, with row keys, ``first``."""
        pairs, members = self.meet()
        links = self.verified(pairs.union(self.few_against_all(members))).select("a", "b")
        labels, tested, turn, done = components(links), None, 0, False
        while not done:
            pairs, done = self.open_pairs(members, labels, NEAREST * STEP ** turn, turn if turn < INSIDE else None)
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = materialize(pairs)
            if not pairs.isEmpty():
                parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                links = links.union(self.verified(pairs, sketched=True).select("a", "b")).coalesce(parts)
                labels = components(links)
                tested = pairs if tested is None else tested.union(pairs).coalesce(parts)
            turn += 1
        return (self.classes.drop("n", "cells").join(labels, self.classes["rep"] == labels["node"], "left")
                .withColumn("group", F.coalesce("component", "rep")).drop("rep", "node", "component"))

    def one_document_an_id(self, sets: DataFrame) -> DataFrame:
        """``sets`` with the groups joined that share an id."""
        own = self.docs.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "d1", "d2")
        several = materialize(own.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("d1", "d2") for f in (F.min, F.max)])
                              .filter("min_d1 <> max_d1 or min_d2 <> max_d2")
                              .select("doc_id", (-1 - F.monotonically_increasing_id()).alias("hub")))   # no set has a negative number
        if not several.limit(1).count():
            return sets
        edges = (own.join(several, "doc_id").select("hub", "d1", "d2").distinct()
                 .join(sets.select("d1", "d2", "group"), ["d1", "d2"]).select(F.col("group").alias("a"), F.col("hub").alias("b")))
        labels = components(edges)
        return (sets.join(labels, sets["group"] == labels["node"], "left")
                .withColumn("group", F.coalesce("component", "group")).drop("node", "component"))


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                  percent: int = 80) -> DataFrame:
    """All links between different sets: ``a, b`` (smallest ids with each set; equal if one id has both, null in ``b``,
    then in ``a``, for sets without an id), ``common``, ``total``."""
    j = _Join(docs, id_col, text_col, words, percent)
    pairs, members = j.meet()
    links = j.verified(pairs.union(j.open_pairs(members)[0]))
    for x in ("a", "b"):
        links = links.join(j.classes.select(F.col("rep").alias(x), F.col("id").alias(f"id_{x}")), x)
    return links.select(F.least("id_a", "id_b").alias("a"),
                        F.when(F.col("id_a").isNotNull() & F.col("id_b").isNotNull(), F.greatest("id_a", "id_b")).alias("b"),
                        "common", "total")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                       percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id`` (smallest id reachable by links)."""
    j = _Join(docs, id_col, text_col, words, percent)
    sets = materialize(j.one_document_an_id(j.connected()))
    least = sets.groupBy("group").agg(F.min("id").alias("least"))
    out = j.docs.join(sets.join(least, "group").select("d1", "d2", "least"), ["d1", "d2"], "left")
    # rows with one id are one document; a null id stays null unless it reaches one
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def jaccard_keepers(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """``row``: the keys of the rows that stay if one row of each group of near copies does, the one with the
    smallest id (null after all ids), then row key. Groups go by texts alone, so the different texts of one id
    stay; rows with an empty set all stay. ``row_col`` must be unique and the same whenever ``docs`` is read."""
    j = _Join(docs, id_col, text_col, words, percent, row_col)
    best = j.connected().groupBy("group").agg(F.min("first").alias("first"))
    return best.select("first.row").union(j.docs.filter("n_shingles = 0").select("row"))
