"""Operator 8: optimal boundaries and full batches."""
import itertools
import random

import numpy as np

from tabulark.llm.packing import length_buckets, pack_lengths


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rnd = random.Random(1)
    for _ in range(30):
        n = rnd.randint(1, 9)
        lengths = sorted(rnd.sample(range(0, 50), n))
        counts = [rnd.randint(1, 20) for _ in lengths]
        for k in (1, 2, 3, 5):
            ends = length_buckets(np.array(lengths), np.array(counts), k)
            assert len(ends) <= k and ends[-1] == lengths[-1]
            best = min(padding(lengths, counts, [*c, lengths[-1]]) for m in range(min(k, n))
                       for c in itertools.combinations(lengths[:-1], m))
            assert padding(lengths, counts, ends) == best


def test_batches(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join("w" * rnd.randint(1, 9) for _ in range(rnd.choice([0, 1, 5, 5, 5, 17, 60, 250]))), 1) for i in range(300)]
    rows += [(None, None, 1), (301, "", 2), rows[3], rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    out = pack_lengths(df, max_tokens=100, buckets=4, budget=200).collect()
    want = {}
    for d, t, _ in rows:
        want[d] = want.get(d, 0) + len((t or "").split())
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert r.length <= r.bucket_length and r.start == r.part * 100
    assert got == want
    batches = {}
    for r in out:
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (b, k), members in batches.items():
        room = 200 // max(1, members[0].bucket_length)
        assert sorted(m.position for m in members) == list(range(len(members)))
        assert len(members) <= room and (len(members) == room or (b, k + 1) not in batches)


def test_empty_table(spark):
    assert pack_lengths(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rows_of_one_id_spread_over_ranges(spark, monkeypatch):
    from tabulark.llm import numbering
    ranges = []
    old = numbering._number
    monkeypatch.setattr(numbering, "_number", lambda first, group, name: ranges.append(first) or old(first, group, name))
    df = spark.createDataFrame([(None if i % 3 else 7, "w " * (i % 40)) for i in range(6000)], "doc_id long, text string").repartition(4)
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")
    try:
        out = pack_lengths(df)
        assert out.count() == 6000
    finally:
        spark.conf.unset(small)
    spread = out.groupBy("bucket", "batch").count().count()
    assert spread > 1 and len({pid for pid, _ in ranges[0]}) >= 6


def test_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "w " * 300_000), (2, "a b")], "doc_id long, text string")
    out = pack_lengths(df)
    assert out.agg({"length": "sum"}).first()[0] == 300_002 and out.filter("doc_id = 1").count() == -(-300_000 // 2048)
