"""The corpus pipeline: effects of its stages on a small corpus, and its contracts."""
import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")


def corpus():
    rnd = random.Random(1)

    def prose(n):
        return " ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(3, 8))) for _ in range(n)) + "."
    good = ["\n".join(prose(12) for _ in range(7)) for _ in range(12)]
    passage = prose(40)
    rows = [(i, t) for i, t in enumerate(good)]
    rows.append((20, good[0]))                                        # an exact copy
    words = good[1].split(" ")
    words[5] = "changed"
    rows.append((21, " ".join(words)))                                # a near copy
    rows.append((22, prose(60) + "\n" + passage))
    rows.append((23, prose(70) + "\n" + passage))                     # a repeated passage
    rows.append((24, prose(60) + "\nWrite to someone.99@mail2.example.com or 10.20.30.40"))
    rows.append((25, "too short"))
    rows.append((26, "\n".join(" ".join(w + "***" for w in prose(20).split()) for _ in range(6))))
    rows += [(27, None), (28, ""), (None, prose(80))]
    return [(d, t, "en", "s", len(t or ""), 7, "x") for d, t in rows], passage


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality int, rest string"


def test_stages(spark, tmp_path):
    rows, passage = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in pipeline.STAGES:
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.dtypes == before.dtypes
            kept[name] = {r.doc_id: r for r in docs.collect()}
            assert all(r.n_chars == len(r.text) and r.quality == 7 and r.rest == "x" for r in kept[name].values())
    assert set(kept["quality"]) == {*range(12), 20, 21, 22, 23, 24, None}
    assert set(kept["near_copies"]) == {*range(12), 22, 23, 24, None}
    assert set(kept["passages"]) == set(kept["near_copies"])
    assert passage in kept["passages"][22].text and passage not in kept["passages"][23].text
    assert "someone.99@" in kept["passages"][24].text and "someone.99@" not in kept["personal_data"][24].text
    assert "10.20.30.40" not in kept["personal_data"][24].text
    out = docs.collect()
    assert {r.doc_id for r in out} == set(kept["personal_data"])
    assert sum(r.length for r in out) == sum(len(r.text.split()) for r in kept["personal_data"].values())


def test_run(spark, tmp_path):
    rows, _ = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()} == {*range(12), 22, 23, 24, None}


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_copies_by_row(spark, tmp_path):
    """One row of each group stays, also of repeated rows and rows without an id; other texts of an id stay."""
    rnd = random.Random(3)
    a, b, c, d, e = (" ".join(f"{x}{rnd.randrange(10 ** 6)}" for _ in range(60)) for x in "abcde")
    near = lambda t: t + " more"
    rows = [(5, a), (5, a), (5, a), (None, near(a)),                # repeated rows, and a copy without an id
            (None, b), (None, near(b)), (None, b),                  # no id at all
            (8, c), (8, d), (9, near(d)), (4, near(c)),             # two texts of one id
            (None, e), (6, e), (2, near(e)), (None, e), (None, ""), (None, "")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t), 7, "x") for i, t in rows], SCHEMA)
    df.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    for docs in (spark.read.parquet(str(tmp_path / "documents.parquet")), df):
        got = pipeline.near_copies(spark, docs, str(tmp_path))
        assert got.dtypes == df.dtypes
        kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
        unnamed = [t for i, t in kept if i is None]
        assert len(unnamed) == 3 and unnamed.count("") == 2 and set(unnamed) & {b, near(b)}
        assert [k for k in kept if k[0] is not None] == sorted([(5, a), (4, near(c)), (8, d), (2, near(e))], key=str)
