"""Null classes, mixed types, many classes and levels, hot sampling keys, training chains, saved models."""
import pytest
from pyspark.sql import functions as F

from tabulark.ml import models as M
from tabulark.operators import evaluate as EV
from tabulark.operators import features as FE
from tabulark.operators import profile as P
from tabulark.operators import sampling as S


def test_confusion_keeps_null_pairs_and_mixed_types(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (None, 1.0), (1, None)], "y int, p double")
    cm = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion_matrix(df, "y", "p").collect()}
    assert sum(cm.values()) == 4 and cm[None, 1.0] == 1 and cm[1.0, None] == 1 and len(cm) == 9
    c = EV.fit_confusion(df, "y", "p")
    assert c.total == 4 and sum(c.tp(i) for i in range(c.k)) == 1


def test_many_classes(spark):
    n = 1100
    df = spark.range(n * 2).select((F.col("id") % n).cast("int").alias("y"), (F.col("id") % n).cast("double").alias("p"))
    assert EV.fit_confusion(df, "y", "p").k == n
    few = spark.range(48).select((F.col("id") % 12).cast("int").alias("y"), F.array(*[
        F.when(F.col("id") % 12 == i, 0.9).otherwise(0.1 / 11 * (i + 1) / 12) for i in range(12)]).alias("prob"))
    assert abs(EV.roc_auc(few, "y", "prob") - 1.0) < 1e-9
    assert EV.probability_histogram(few, "y", "prob").agg(F.sum("count")).first()[0] == 48


def test_many_levels_keep_their_codes(spark):
    df = spark.range(60).select(F.format_string("v%03d", F.col("id")).alias("age"))
    out = FE.ordinal_map(df, "age", "o", max_codes=10)
    assert [r["o"] for r in out.orderBy("age").collect()] == [float(i) for i in range(60)]
    big = FE.fit_label_encoders(df, ["age"], max_codes=10)
    assert big.tables and FE.apply_label_encoders(df, big).agg(F.max("age")).first()[0] == 59
    assert FE.fit_one_hot(df, ["age"])["age"][0] == "v000"


def test_group_features_do_not_depend_on_size(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("B", 5.0)], "code_module string, sum_click double")
    out = FE.create_features(df, label="none").df
    assert {"module_avg_clicks", "clicks_vs_module_avg"} <= set(out.columns)
    assert "module_avg_clicks" not in FE.create_features(df, label="none", group_min_rows=1000).df.columns


@pytest.mark.parametrize("n", [1, 150, 333, 334, 600])
def test_hot_sampling_key(spark, n):
    df = spark.range(1000).select(F.when(F.col("id") < 334, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = S.random_sample(df, n, ["k"])
    assert out.count() == n and out.select("v").distinct().count() == n


def test_sample_is_one_pass(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = S.random_sample(df, 100, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Window" not in plan


def test_plain_column_profile(spark):
    df = spark.createDataFrame([(1, None, "a", 2.0), (2, None, "a", float("nan"))], "a int, b int, c string, d double")
    assert P.drop_all_null_columns(df).columns == ["a", "c", "d"]
    assert P.drop_constant_columns(df).columns == ["a"]
    p, q = P.column_profile(df), P.profile(df)
    assert (p.rows, p.nulls, p.constant) == (q.rows, q.nulls, q.constant)


def blobs(spark):
    rows = [(i, float(i % 3 == 0), [float(i % 3) * 4 + (i * 7 % 11) / 10, 100.0 + i % 5, -3.0 * (i % 3 == 0)]) for i in range(90)]
    from pyspark.ml.functions import array_to_vector
    return spark.createDataFrame(rows, "id long, label double, x array<double>").select("id", "label", array_to_vector("x").alias("features"))


def test_training_chain(spark):
    df = blobs(spark)
    over = M.oversampled(df, "id")
    assert {r["label"]: r["count"] for r in over.groupBy("label").count().collect()} == {0.0: 60, 1.0: 60}
    scaled = M.scale_vector(over, M.fit_vector_scale(over))
    s = M.fit_vector_scale(scaled)
    assert all(abs(m) < 1e-9 for m in s["mean"]) and all(abs(v - 1) < 1e-9 for v in s["std"])
    test = df.filter("id % 5 = 0")
    run = M.train_all_models(df.filter("id % 5 <> 0"), test, 3, 2, names=["LogisticRegression", "GaussianNB"], id_col="id")
    assert run.best in run and run["LogisticRegression"]["metrics"]["accuracy"] == 1.0
    assert run["GaussianNB"]["predictions"].count() == test.count()        # test rows are never oversampled


@pytest.mark.parametrize("name", ["LogisticRegression", "LinearDiscriminantAnalysis", "SVM", "AdaBoost"])
def test_saved_models_predict_the_same(spark, tmp_path, name):
    from tabulark.sources.tables import load_model, save_model
    df = blobs(spark)
    fitted = M.fit_chain(name, df, 3, 2, "id", oversample=False)
    save_model(fitted, str(tmp_path / "m"))
    a, b = (M.predict(f, df).select("id", "prediction").collect() for f in (fitted, load_model(str(tmp_path / "m"), spark)))
    assert sorted(a) == sorted(b)


def test_smote_of_a_single_row_class(spark):
    from tabulark.ml.neighbors import smote_oversample
    df = spark.createDataFrame([(i, "a", [float(i), 1.0]) for i in range(6)] + [(9, "b", [5.0, 5.0])], "id long, y string, x array<double>")
    out = smote_oversample(df, "y", "x", "id", k=2)
    assert out.filter(F.exists("x", lambda v: v.isNull())).count() == 0
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {"a": 6, "b": 6}
