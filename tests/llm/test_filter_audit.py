"""Operator 13 against running every order of the filters row by row."""
import itertools
import re

import numpy as np
from pyspark.sql import functions as F

from tabulark.llm import queries
from tabulark.llm.filter_audit import audit_filters, contract_orders, document_failures


def brute(rows, names):
    """rows: (part, set of failed filters, first flag, second flag)."""
    out = {}
    parts = sorted({r[0] for r in rows})
    for part in parts:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys(names, 0)
        for order in itertools.permutations(names):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine),
                                                   sum(r[2] for r in gone), sum(r[3] for r in gone), f]
        for k, v in out.items():
            if k[0] == part:
                v[-1] = shapley[v[-1]]
    return out


def test_audit_equals_running_every_order(spark):
    rng = np.random.default_rng(1)
    rows = [(["x", "y", None][rng.integers(3)], *[bool(b) for b in rng.random(4) < 0.35], bool(rng.random() < 0.4), bool(rng.random() < 0.2))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "source string, P boolean, Q boolean, R boolean, S boolean, good boolean, bad boolean")
    got = audit_filters(df, list("PQRS"), F.col("source"), F.col("good"), F.col("bad"))
    want = brute([(r[0] or "", {n for n, f in zip("PQRS", r[1:5]) if f}, r[5], r[6]) for r in rows], "PQRS")
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got.collect()} == want


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def failures(rows):
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, source in rows:
        t = t or ""
        w = words(t)
        yield source or "", {n for n, f in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t])) if f}, i


def test_query_equals_a_plain_version(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "a"), (2, base, "a"), (3, base, "b"), (2, base, "b"), (None, base, "a"), (None, None, None), (4, "", "a"), (5, None, "c"),
            (6, "A B C # d", "a"), (7, base + " É x\x0b" + "ü" * 10, None), (8, base * 3, "c"), (9, "AB " * 4000, "c"), (9, base, "c"),
            (10, "x y", "")] + [(100 + i, base, "hot") for i in range(300)] + [(None, f"{base} {i}", "none") for i in range(50)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (None, 1, 1), (6, 0, 1), (9, 1, 0), (150, 1, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("part", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    good, toxic = {l[0] for l in labels if l[1] == 1} - {None}, {l[0] for l in labels if l[2] == 1} - {None}
    want = brute([(p, f, i in good, i in toxic) for p, f, i in failures(rows)], "ABCDE")
    got = queries.op13(spark, str(tmp_path)).collect()
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got} == want and len(got) == len(want)


def test_a_text_found_everywhere_is_grouped_before_it_is_joined(spark):
    docs = spark.createDataFrame([(i, "same", "p") for i in range(1000)], "doc_id long, text string, source string")
    got = document_failures(docs)
    assert got.filter("E").count() == 999
    twice = document_failures(docs.withColumn("doc_id", F.lit(5).cast("long")))
    assert [(r.n, r.E) for r in twice.collect()] == [(1000, False)]


def test_shares_add_up_and_empty_tables(spark):
    rng = np.random.default_rng(2)
    t = rng.integers(0, 9, (3, 2, 2, 2, 2, 2))
    out = contract_orders({"rows": t, "first": t, "second": t})
    assert (out["kept"][:, :, -1] == t[:, 0, 0, 0, 0, 0][:, None]).all()
    assert (out["removed"].sum(2) + out["kept"][:, :, -1] == t.reshape(3, -1).sum(1)[:, None]).all()
    assert (out["shapley"].sum(2) == out["removed"].sum((1, 2))[:, None]).all()
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert document_failures(none).collect() == []
    assert audit_filters(document_failures(none), list("ABCDE"), F.col("part"), F.lit(True), F.lit(True), F.col("n")).collect() == []
