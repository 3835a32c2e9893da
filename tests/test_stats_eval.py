import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabulark.functions import stats as ST
from tabulark.operators import evaluate as EV
from tabulark.operators import explore as X

from fixtures import PREDS2, PREDS3


def test_p_value_reproduces_published_h1():
    p = ST.pearson_p_value(-0.03441120871747384, 796818)
    assert math.isclose(p, 2.5511266392832263e-207, rel_tol=1e-8)
    assert math.isclose(ST.pearson_p_value(0.3, 30), 0.10724594805794918, rel_tol=1e-9)


def test_moments_match_pandas(spark):
    rng = np.random.RandomState(3)
    x = rng.gamma(2.0, 3.0, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    m = X.moments(df, ["x"]).first()
    s = pd.Series(x)
    assert math.isclose(m.skewness, s.skew(), rel_tol=1e-9)
    assert math.isclose(m.kurtosis, s.kurt(), rel_tol=1e-9)


def test_histogram_matches_numpy(spark):
    rng = np.random.RandomState(4)
    x = np.concatenate([rng.normal(0, 1, 300), [5.0, 5.0]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    h = sorted((r.bin, r["count"]) for r in X.histogram(df, ["x"], 30).collect())
    counts, _ = np.histogram(x, bins=30)
    assert [c for _, c in h] == list(counts)


def test_multiclass_metrics(spark):
    df = spark.createDataFrame(PREDS3, "y int, p int")
    cm = EV.fit_confusion(df, "y", "p")
    m = EV.classification_metrics(cm)
    y = np.array([a for a, _ in PREDS3]); p = np.array([b for _, b in PREDS3])
    assert math.isclose(m["accuracy"], (y == p).mean())
    prec = [((p == c) & (y == c)).sum() / max(1, (p == c).sum()) for c in range(3)]
    rec = [((p == c) & (y == c)).sum() / (y == c).sum() for c in range(3)]
    assert math.isclose(m["precision_macro"], np.mean(prec)) and math.isclose(m["recall_macro"], np.mean(rec))
    pooled = EV.confusion_counts(cm)
    assert pooled["TP"] == (y == p).sum() and pooled["f1_score_manual"] == 0.0


def _brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    tot = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return tot / (len(pos) * len(neg))


def test_binary_auc_with_ties(spark):
    df = spark.createDataFrame(PREDS2, "y int, p int, s double")
    got = EV.binary_auc(df, F.col("y") == 1, F.col("s"))
    assert math.isclose(got, _brute_auc([r[0] for r in PREDS2], [r[2] for r in PREDS2]))
    cm = EV.fit_confusion(df, "y", "p")
    c = EV.confusion_counts(cm)
    assert (c["TP"], c["FP"], c["TN"], c["FN"]) == (3, 2, 3, 2)


def test_roc_curve_ends_at_one(spark):
    df = spark.createDataFrame(PREDS2, "y int, p int, s double")
    pts = sorted((r.fpr, r.tpr) for r in EV.roc_curve(df, F.col("y") == 1, F.col("s")).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)


def test_target_share_and_crosstab(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "g string, r string")
    shares = {(r.g, r.r): r.share for r in X.crosstab_share(df, "g", "r").collect()}
    assert shares == {("a", "x"): 0.5, ("a", "y"): 0.5, ("b", "x"): 1.0}


def test_describe_text_unique_top_freq_from_one_pass(spark):
    from tabulark.operators import explore as EX
    df = spark.createDataFrame([("a", None, 1.0), ("b", None, 2.0), ("a", None, 3.0), (None, None, 4.0)],
                               "t string, e string, x double")
    rows = {r.variable: r for r in EX.describe_all(df).collect()}
    assert (rows["t"]["count"], rows["t"]["unique"], rows["t"]["top"], rows["t"]["freq"]) == (3, 2, "a", 2)
    assert (rows["e"]["count"], rows["e"]["unique"], rows["e"]["top"]) == (0, 0, None)
    assert rows["x"]["q50"] == 2.5


def test_shared_quartile_fit_gives_same_reports(spark):
    df = spark.createDataFrame([(float(i % 7), float(i * i % 11)) for i in range(40)], "a double, b double")
    q = X.fit_quartiles(df, ["a", "b"])
    assert sorted(X.box_stats(df, ["a", "b"], q).collect()) == sorted(X.box_stats(df, ["a", "b"]).collect())
    assert sorted(X.outlier_report(df, ["a", "b"], q).collect()) == \
        sorted(X.outlier_report(df, ["a", "b"]).collect())
    assert sorted(X.describe_all(df, quartiles=q).collect()) == sorted(X.describe_all(df).collect())
