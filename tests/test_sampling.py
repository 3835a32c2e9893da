from pyspark.sql import functions as F

from tabulark.functions.hashing import hash_sql, row_hash
from tabulark.operators import sampling as S


def _frame(spark, n=300, parts=4):
    df = spark.range(n).select(F.col("id"), (F.col("id") % 3).alias("cls"),
                               (F.col("id") % 17).cast("double").alias("date"))
    return df.repartition(parts)


def test_random_sample_exact_and_partition_independent(spark):
    a = {r.id for r in S.random_sample(_frame(spark, parts=2), 37, ["id"]).collect()}
    b = {r.id for r in S.random_sample(_frame(spark, parts=7), 37, ["id"]).collect()}
    assert len(a) == 37 and a == b


def test_random_sample_matches_sorted_hash(spark):
    df = _frame(spark)
    want = [r.id for r in df.orderBy(row_hash(["id"], 42), "id").limit(25).collect()]
    got = {r.id for r in S.random_sample(df, 25, ["id"]).collect()}
    assert got == set(want)


def test_balanced_sample_counts_null_class_in_divisor(spark):
    df = _frame(spark)
    src = df.select("cls").union(spark.createDataFrame([(None,)], "cls bigint"))
    out = S.balanced_sample(df, "cls", 40, ["id"], class_source=src)
    counts = {r.cls: r["count"] for r in out.groupBy("cls").count().collect()}
    assert counts == {0: 10, 1: 10, 2: 10}     # 40 // 4 groups, the null group gives nothing


def test_first_n_takes_exact_copies_exactly(spark):
    rows = [(1, 5.0)] * 4 + [(2, 5.0), (3, 1.0)]
    df = spark.createDataFrame(rows, "id long, v double")
    for n in range(0, 8):
        out = S.take_first(df, [F.col("v")], n, ["id"])
        assert out.count() == min(n, 6)


def test_recent_sample_orders_by_date(spark):
    df = _frame(spark)
    out = S.recent_sample(df, "date", 30, ["id"]).collect()
    dates = sorted((r.date for r in df.collect()), reverse=True)
    assert sorted((r.date for r in out), reverse=True) == dates[:30]


def test_hash_is_sql_portable(spark):
    import duckdb
    for k in (0, 7, 123456789, 9_000_000_000):
        d = duckdb.connect().execute(f"SELECT {hash_sql(['k'], 42)} AS h FROM (SELECT CAST({k} AS BIGINT) AS k)").fetchone()[0]
        s = spark.sql(f"SELECT {hash_sql(['k'], 42)} AS h FROM (SELECT CAST({k} AS BIGINT) AS k)").first()[0]
        assert d == s and 0 <= s < 2147483647


def test_random_sample_holds_and_compares_little(spark, monkeypatch):
    df = spark.range(20000).withColumnRenamed("id", "k")
    held, persist = [], type(df).persist
    monkeypatch.setattr(type(df), "persist", lambda self, *level: (held.append(self.count()), persist(self, *level))[1])
    out = S.random_sample(df, 50, ["k"])
    first = df.orderBy(S.row_hash(["k"]), "k").limit(50)
    assert {r.k for r in out.collect()} == {r.k for r in first.collect()}
    assert held and max(held) < 200                    # rows up to the slice of row 50
    # the hash is written out in the filter at most twice (each ends with this factor)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("69621") <= 2
    assert S.random_sample(df, 20000, ["k"]).count() == 20000 and S.random_sample(df.where("k < 0"), 5, ["k"]).count() == 0
