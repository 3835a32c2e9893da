"""Operator 5: the bytes law, gapless slots, groups of copies and ties."""
import random
import zlib

from tabulark.llm.histogram_shards import histogram_shards


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 0, 5) for d, t in rows], "doc_id long, text string, shard int, key int")
    return histogram_shards(df.repartition(5), **kw).collect()


def check(rows, out, shards=8):
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in out) == sorted(
        (d if d is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    total, per, slots = sum(r.size for r in out), [0] * shards, [[] for _ in range(shards)]
    for r in out:
        per[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for s in slots:
        assert sorted(s) == list(range(len(s)))
    most = max((r.size for r in out), default=0)
    assert all(abs(p - total / shards) <= most + total / shards / 500 for p in per)


def test_bytes(spark):
    rnd = random.Random(1)
    rows = [(i, "ä" * rnd.randint(0, 300)) for i in range(800)]
    rows += [(None, None), (None, "q"), (801, None), (802, ""), rows[5], rows[5]]
    out = run(spark, rows)
    check(rows, out)


def test_hot_text_is_split(spark):
    rows = [(i, "hot text " * 20) for i in range(500)] + [(500 + i, f"t{i}" * 20) for i in range(500)]
    out = run(spark, rows)
    check(rows, out)


def test_repeated_rows_are_split(spark):
    rows = [(7, "same " * 9)] * 300 + [(i, f"{i}") for i in range(8, 50)]
    check(rows, run(spark, rows))


def test_small_tables(spark):
    assert run(spark, []) == []
    check([(1, "a")], run(spark, [(1, "a")]))
    check([(1, "a"), (2, "b" * 90), (3, None)], run(spark, [(1, "a"), (2, "b" * 90), (3, None)], shards=3), 3)
