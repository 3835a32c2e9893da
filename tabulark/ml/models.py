"""Model training and prediction (F7-F24, G13) on Spark ML.

Every fitted model is used through ``predict(model, df)``, which returns the
input with ``prediction`` (double) and ``probability`` (array<double>, null when
the model has none). Forests, extremely randomised trees and multinomial boosting
come from ``trees``. Custom pieces are plain DataFrame code: one-vs-rest
probabilities, random Fourier features for the RBF SVM, linear discriminant
analysis from per-class sums, SAMME boosting over weighted stumps, a seeded
Gaussian random projection.
"""

from __future__ import annotations

import importlib
import json
import math
import time
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import network as NN
from . import svm as SV
from . import trees as TR

SEED = 42


# ----------------------------------------------------------------------------
# fitted model wrapper
# ----------------------------------------------------------------------------
@dataclass
class Fitted:
    name: str
    kind: str                  # "spark", "machines" ("ovr" if saved by an earlier round), "lda", "adaboost", "forest", "boosted", "network"
    model: object
    num_classes: int
    features_col: str = "features"
    extra: dict = field(default_factory=dict)


def _prob_array(col: str = "probability") -> Column:
    return vector_to_array(F.col(col), "float64")


def _softmax(scores: Column) -> Column:
    m = F.array_max(scores)
    ex = F.transform(scores, lambda s: F.exp(s - m))
    tot = F.aggregate(ex, F.lit(0.0), lambda a, b: a + b)
    return F.transform(ex, lambda e: e / tot)


def _argmax(arr: Column) -> Column:
    """0-based index of the first maximum, as double."""
    m = F.array_max(arr)
    return (F.array_position(arr, m) - 1).cast("double")


def predict(fitted: Fitted, df: DataFrame) -> DataFrame:
    """``prediction`` and ``probability`` (array, or null) for every row."""
    if "scale" in fitted.extra:
        plain = Fitted(fitted.name, fitted.kind, fitted.model, fitted.num_classes, fitted.features_col,
                       {k: v for k, v in fitted.extra.items() if k != "scale"})
        scaled = scale_vector(df.withColumn("_raw", F.col(fitted.features_col)), fitted.extra["scale"], fitted.features_col)
        out = predict(plain, scaled)
        return out.select(*[F.col("_raw").alias(c) if c == fitted.features_col else F.col(c) for c in df.columns],
                          "prediction", "probability")
    cols = df.columns
    if fitted.kind == "spark":
        out = fitted.model.transform(df)
        has_prob = "probability" in out.columns and "probability" not in cols
        prob = _prob_array() if has_prob else F.lit(None).cast("array<double>")
        return out.select(*cols, F.col("prediction").cast("double").alias("prediction"), prob.alias("probability"))
    if fitted.kind in ("ovr", "machines"):
        src = rff_features(df, fitted.extra["rff"]) if "rff" in fitted.extra else df
        if fitted.kind == "ovr":
            out = fitted.model.transform(src).withColumn("_margin", vector_to_array(F.col("rawPrediction"), "float64"))
        else:
            out = src.withColumn("_margin", SV.margins(vector_to_array(F.col("rff"), "float64"), fitted.extra["coef"], fitted.extra["intercept"]))
            out = out.withColumn("prediction", _argmax(F.col("_margin")))
        margins = F.col("_margin")
        p = F.array(*[F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(float(a)) * margins[k] + F.lit(float(b))))
                      for k, (a, b) in enumerate(fitted.extra["platt"])])
        tot = F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
        prob = F.transform(p, lambda x: x / tot)
        return out.select(*cols, F.col("prediction").cast("double").alias("prediction"), prob.alias("probability"))
    if fitted.kind == "lda":
        return _lda_predict(fitted, df)
    if fitted.kind == "adaboost":
        return _ada_predict(fitted, df)
    if fitted.kind in ("forest", "boosted", "network"):
        apply = {"forest": TR.predict_forest, "boosted": TR.predict_boosted, "network": NN.predict_network}[fitted.kind]
        out = apply(fitted.model or fitted.extra, df, fitted.features_col, "_shares")
        if fitted.num_classes == 0:
            return out.select(*cols, F.col("_shares")[0].alias("prediction"), F.lit(None).cast("array<double>").alias("probability"))
        return out.select(*cols, _argmax(F.col("_shares")).alias("prediction"), F.col("_shares").alias("probability"))
    raise ValueError(f"unknown model kind {fitted.kind}")


# ----------------------------------------------------------------------------
# built-in estimators
# ----------------------------------------------------------------------------
def random_forest(num_trees: int = 200, seed: int = SEED, **kw):
    """Spark's forest of limited depth, for searches; F7 itself is ``fit_random_forest``."""
    return RandomForestClassifier(numTrees=num_trees, seed=seed, **kw)


def fit_random_forest(train: DataFrame, num_classes: int, num_trees: int = 200, max_depth: int | None = None, seed: int = SEED, **kw) -> Fitted:
    """bootstrapped trees over sqrt(d) features a node, grown to pure leaves unless a depth is given."""
    return Fitted("RandomForest", "forest", TR.fit_forest(train, num_classes, num_trees, max_depth, "sqrt", seed=seed, **kw), num_classes)


def logistic(max_iter: int = 1000, **kw):
    """F8: multinomial logistic regression."""
    return LogisticRegression(maxIter=max_iter, family="multinomial", **kw)


def fit_mlp(train: DataFrame, num_classes: int, hidden: int = 100, max_iter: int = 500, seed: int = SEED, **kw) -> Fitted:
    """one hidden layer (100 units like sklearn's default; the registry used 50), Adam on mini-batches."""
    return Fitted("NeuralNetwork", "network", None, num_classes, extra=NN.fit_network(train, num_classes, hidden, max_iter, seed=seed, **kw))


def gaussian_nb():
    """F12."""
    return NaiveBayes(modelType="gaussian")


def fit_bagging(train: DataFrame, num_classes: int, num_trees: int = 10, max_depth: int | None = None, seed: int = SEED, **kw) -> Fitted:
    """bootstrapped trees over all features at every node."""
    return Fitted("Bagging", "forest", TR.fit_forest(train, num_classes, num_trees, max_depth, None, seed=seed, **kw), num_classes)


def fit_extra_trees(train: DataFrame, num_classes: int, num_trees: int = 100, max_depth: int | None = None, seed: int = SEED,
                    max_features: int | str | None = "sqrt", **kw) -> Fitted:
    """F16: extremely randomised trees: all rows, one seeded uniform cut for each node and drawn feature."""
    return Fitted("ExtraTrees", "forest", TR.fit_forest(train, num_classes, num_trees, max_depth, max_features, bootstrap=False,
                                                        random_cuts=True, seed=seed, **kw), num_classes)


def fit_decision_tree(train: DataFrame, num_classes: int, max_depth: int | None = None, seed: int = SEED, **kw) -> Fitted:
    """One tree over all rows and features."""
    return Fitted("DecisionTree", "forest", TR.fit_forest(train, num_classes, 1, max_depth, None, bootstrap=False, seed=seed, **kw), num_classes)


def fit_spark(name: str, estimator, train: DataFrame, num_classes: int) -> Fitted:
    return Fitted(name, "spark", estimator.fit(train), num_classes)


# ----------------------------------------------------------------------------
# F9 boosting: one softmax model
# ----------------------------------------------------------------------------
def fit_gbt(train: DataFrame, num_classes: int, max_iter: int = 100, max_depth: int | None = 3, step: float = 0.1, **kw) -> Fitted:
    """a tree a class and round on shared softmax residuals."""
    return Fitted("GradientBoosting", "boosted", TR.fit_boosted(train, num_classes, max_iter, max_depth, step, **kw), num_classes)


# ----------------------------------------------------------------------------
# F10 RBF SVM: random Fourier features + one-vs-rest linear SVM
# ----------------------------------------------------------------------------
def rff_params(num_features: int, n_components: int = 100, gamma: float | None = None,
               seed: int = SEED) -> dict:
    """Random Fourier features z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma),
    b ~ U(0, 2 pi): an unbiased approximation of the RBF kernel exp(-gamma |x - y|^2).
    ``gamma`` defaults to 1 / num_features (sklearn's 'scale' on unit-variance data)."""
    gamma = gamma or 1.0 / num_features
    rng = np.random.RandomState(seed)
    return {"w": rng.normal(0.0, math.sqrt(2 * gamma), size=(n_components, num_features)),
            "b": rng.uniform(0.0, 2 * math.pi, size=n_components), "d": num_features}


def rff_features(df: DataFrame, params: dict, input_col: str = "features", output_col: str = "rff") -> DataFrame:
    """Apply the feature map, one matrix product for each Arrow batch."""
    w, b = np.asarray(params["w"]), np.asarray(params["b"])
    scale = math.sqrt(2.0 / len(b))

    @F.pandas_udf("array<double>")
    def mapped(x: pd.Series) -> pd.Series:
        return pd.Series(list(scale * np.cos(np.stack(x.to_list()) @ w.T + b))) if len(x) else pd.Series([], dtype=object)

    return df.withColumn(output_col, array_to_vector(mapped(vector_to_array(F.col(input_col), "float64"))))


def fit_svm(train: DataFrame, num_features: int, num_classes: int, n_components: int = 100,
            reg: float = 0.01, seed: int = SEED, folds: int = 2) -> Fitted:
    """RBF machine on random Fourier features; probabilities by Platt scaling of margins that
    models of the other folds give (folds by a seeded hash of the features). The machines of all
    classes and folds are fitted together."""
    params = rff_params(num_features, n_components, seed=seed)
    fold = F.pmod(F.xxhash64("rff", F.lit(seed)), F.lit(folds))
    data = materialize(rff_features(train, params).withColumn("_fold", fold).select("label", "rff", "_fold"))
    seen = data.agg(F.max("label").alias("top"), F.count_if(F.col("label").isNull()).alias("nulls"), F.count(F.lit(1)).alias("n")).first()
    top = seen["top"]
    if top is None or not 0 <= top < 2 ** 31 or top != int(top) or (num_classes <= 2 and (top > 1 or seen["nulls"])):
        raise ValueError("labels must be class numbers" if num_classes > 2 else "labels must be 0 or 1")
    # two classes take one machine; a row without a label is in none of several
    classes = [1] if num_classes <= 2 else list(range(max(num_classes, int(top) + 1)))
    label = F.coalesce(F.col("label").cast("double"), F.lit(-1.0)).alias("label")
    x = F.concat(vector_to_array(F.col("rff"), "float64"), F.array(F.col("_fold").cast("double"))).alias("features")
    blocks, _, n = TR.pack_blocks(data.select(x, label))
    if n < seen["n"]:
        raise ValueError("features must be finite")
    there = data.select("label", "_fold").distinct().collect()        # a row a class and fold
    left = [i for i in range(folds) if len({r["label"] for r in there if r["_fold"] != i}) >= max(2, num_classes)]   # else the other folds lack a class
    blocks = blocks.persist()
    coef, intercept, _ = SV.fit_machines(blocks, n_components, folds, [(c, i) for i in [-1, *left] for c in classes], reg)
    blocks.unpersist()
    if num_classes <= 2:
        coef, intercept = (np.stack([-v, v], 1).reshape(-1, *v.shape[1:]) for v in (coef, intercept))
    k = len(coef) // (1 + len(left))                   # margins a model
    platt = [(-1.0, 0.0)] * max(2, num_classes)
    if left:
        held = data.where(F.col("_fold").isin(left)).withColumn("_margin", SV.margins(vector_to_array(F.col("rff"), "float64"), coef[k:], intercept[k:]))
        at = F.array_position(F.array(*[F.lit(i).cast("long") for i in left]), F.col("_fold").cast("long")) - 1
        platt = fit_platt(materialize(held.select("label", F.slice("_margin", (at * k + 1).cast("int"), k).alias("_margin"))), max(2, num_classes))
    return Fitted("SVM", "machines", None, num_classes, extra={"platt": platt, "rff": params, "coef": coef[:k], "intercept": intercept[:k]})


def fit_platt(margins: DataFrame, num_classes: int, rounds: int = 50) -> list[tuple[float, float]]:
    """(A, B) of p = 1 / (1 + exp(A m + B)) for each class from ``label, _margin``: Newton steps on the
    log-loss against the smoothed targets (n + 1) / (n + 2) and 1 / (n + 2), all classes in one aggregate."""
    n = margins.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == k).alias(f"n{k}") for k in range(num_classes)]).first()
    high = [(n[f"n{k}"] + 1) / (n[f"n{k}"] + 2) for k in range(num_classes)]
    low = [1 / (n["n"] - n[f"n{k}"] + 2) for k in range(num_classes)]
    found = [[0.0, math.log((n["n"] - n[f"n{k}"] + 1) / (n[f"n{k}"] + 1))] for k in range(num_classes)]
    loss = [math.inf] * num_classes
    step = [[0.0, 0.0] for _ in range(num_classes)]
    open_ = set(range(num_classes))
    for _ in range(rounds):
        aggregates = []
        for k in sorted(open_):
            m = F.col("_margin")[k]
            t = F.when(F.col("label") == k, high[k]).otherwise(low[k])
            z = F.lit(found[k][0]) * m + F.lit(found[k][1])
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(z))
            w = p * (F.lit(1.0) - p)
            aggregates += [F.sum((t - p) * m).alias(f"ga{k}"), F.sum(t - p).alias(f"gb{k}"), F.sum(w * m * m).alias(f"aa{k}"),
                           F.sum(w * m).alias(f"ab{k}"), F.sum(w).alias(f"bb{k}"),
                           F.sum(t * z + F.when(z > 30, F.exp(-z)).otherwise(F.log1p(F.exp(-z)))).alias(f"l{k}")]
        r = margins.agg(*aggregates).first()
        for k in sorted(open_):
            if r[f"l{k}"] > loss[k] + 1e-9:            # too far: half the last step back
                step[k] = [v / 2 for v in step[k]]
                found[k] = [a + v for a, v in zip(found[k], step[k])]
                if max(map(abs, step[k])) < 1e-8:
                    open_.discard(k)
                continue
            loss[k] = r[f"l{k}"]
            ga, gb, aa, ab, bb = (r[f"{c}{k}"] for c in ("ga", "gb", "aa", "ab", "bb"))
            aa, bb = aa + 1e-12, bb + 1e-12
            det = aa * bb - ab * ab
            step[k] = [(bb * ga - ab * gb) / det, (aa * gb - ab * ga) / det] if det > 0 else [0.0, 0.0]
            found[k] = [a - v for a, v in zip(found[k], step[k])]
            if max(map(abs, step[k])) < 1e-7:
                open_.discard(k)
        if not open_:
            break
    return [tuple(v) for v in found]


# ----------------------------------------------------------------------------
# F13 linear discriminant analysis
# ----------------------------------------------------------------------------
def fit_lda(train: DataFrame, num_features: int, num_classes: int, features_col: str = "features") -> Fitted:
    """Class means and pooled within-class covariance from one grouped aggregation
    (per-class count, sum vector, sum of outer products); the d x d solve runs on
    the driver; scores are native dot products."""
    d = num_features

    def moments(batches):
        held: dict[float, np.ndarray] = {}
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for c in np.unique(y):
                rows = x[y == c]
                held[c] = held.get(c, 0.0) + np.concatenate([[len(rows)], rows.sum(0), (rows.T @ rows).ravel()])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.float64()), pa.array([v.tobytes() for v in held.values()], pa.binary())],
                                             names=["label", "v"])
    rows = train.select(F.col("label").cast("double").alias("y"), TR.feature_array(train, features_col).alias("x")).filter("y is not null and x is not null")
    sums = TR.add_up(rows.mapInArrow(moments, "label double, v binary"), "label", "v", rows.rdd.getNumPartitions())
    per = []
    for r in sums.collect():                           # one row a class
        v = np.frombuffer(bytes(r["v"]), np.float64)
        per.append({"label": r["label"], "n": v[0], "s": v[1:d + 1], "oo": v[d + 1:]})
    n_tot = sum(r["n"] for r in per)
    k = len(per)
    sw = np.zeros((d, d))
    means, priors, labels = [], [], []
    for r in sorted(per, key=lambda r: r["label"]):
        n = r["n"]
        mu = r["s"] / n
        sw += r["oo"].reshape(d, d) - n * np.outer(mu, mu)
        means.append(mu)
        priors.append(n / n_tot)
        labels.append(r["label"])
    cov = sw / max(1, n_tot - k)
    inv = np.linalg.pinv(cov)
    coefs = [inv @ mu for mu in means]
    inter = [-0.5 * mu @ inv @ mu + math.log(p) for mu, p in zip(means, priors)]
    return Fitted("LinearDiscriminantAnalysis", "lda", None, num_classes, features_col,
                  extra={"coef": coefs, "intercept": inter, "labels": labels})


def _lda_predict(fitted: Fitted, df: DataFrame) -> DataFrame:
    x = vector_to_array(F.col(fitted.features_col), "float64")
    scores = F.array(*[
        F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in coef]), lambda a, b: a * b),
                    F.lit(0.0), lambda s, v: s + v) + F.lit(float(b))
        for coef, b in zip(fitted.extra["coef"], fitted.extra["intercept"])])
    labels = F.array(*[F.lit(float(v)) for v in fitted.extra["labels"]])
    out = df.withColumn("_sc", scores)
    return out.select(*df.columns, F.element_at(labels, _argmax(F.col("_sc")).cast("int") + 1).alias("prediction"),
                      _softmax(F.col("_sc")).alias("probability"))


# ----------------------------------------------------------------------------
# F14 AdaBoost (SAMME) over weighted decision stumps
# ----------------------------------------------------------------------------
def fit_adaboost(train: DataFrame, num_classes: int, n_estimators: int = 50, learning_rate: float = 1.0,
                 seed: int = SEED, checkpoint_every: int = 5) -> Fitted:
    k = max(2, num_classes)
    data = train.select("features", "label").withColumn("w", F.lit(1.0))
    n = data.count()
    data = data.withColumn("w", F.lit(1.0 / n)).persist()
    held = [data]
    stumps, alphas = [], []
    for m in range(n_estimators):
        stump = DecisionTreeClassifier(maxDepth=1, weightCol="w", seed=seed + m).fit(data)
        scored = stump.transform(data).select("features", "label", "w",
                                              (F.col("prediction") != F.col("label")).cast("double").alias("miss"))
        row = scored.agg(F.sum(F.col("w") * F.col("miss")).alias("e"), F.sum("w").alias("t")).first()
        err = row["e"] / row["t"]
        if err <= 0:
            stumps.append(stump)
            alphas.append(1.0)
            break
        if err >= 1.0 - 1.0 / k:
            if not stumps:
                stumps.append(stump)
                alphas.append(1.0)
            break
        alpha = learning_rate * (math.log((1 - err) / err) + math.log(k - 1))
        stumps.append(stump)
        alphas.append(alpha)
        data = scored.select("features", "label", (F.col("w") * F.exp(F.lit(alpha) * F.col("miss"))).alias("w"))
        tot = data.agg(F.sum("w")).first()[0]
        data = data.withColumn("w", F.col("w") / F.lit(tot))
        if (m + 1) % checkpoint_every == 0:
            data = materialize(data)   # cut the growing lineage
        data = data.persist()          # read by three jobs of the next round
        held.append(data)
        if len(held) > 2:
            held.pop(0).unpersist()
    for h in held:
        h.unpersist()
    return Fitted("AdaBoost", "adaboost", None, num_classes, extra={"stumps": stumps, "alphas": alphas, "k": k})


def _vote(pred_col: str, alpha: float):
    def f(c):
        return F.when(F.col(pred_col) == c.cast("double"), F.lit(alpha)).otherwise(F.lit(0.0))
    return f


def _ada_predict(fitted: Fitted, df: DataFrame) -> DataFrame:
    k = fitted.extra["k"]
    out = df
    votes = None
    for i, (stump, alpha) in enumerate(zip(fitted.extra["stumps"], fitted.extra["alphas"])):
        stump = stump.copy({stump.predictionCol: f"_p{i}", stump.rawPredictionCol: f"_r{i}",
                            stump.probabilityCol: f"_q{i}"})
        out = stump.transform(out).drop(f"_r{i}", f"_q{i}")
        v = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), _vote(f"_p{i}", alpha))
        votes = v if votes is None else F.zip_with(votes, v, lambda a, b: a + b)
    out = out.withColumn("_v", votes)
    # SAMME probabilities: softmax of votes / (k - 1)
    scaled = F.transform(F.col("_v"), lambda s: s / F.lit(float(k - 1)))
    return out.select(*df.columns, _argmax(F.col("_v")).alias("prediction"), _softmax(scaled).alias("probability"))


# ----------------------------------------------------------------------------
# F18 regressors, F19/F20 clustering, F21 grid search, F22 random projection
# ----------------------------------------------------------------------------
def train_regressors(df: DataFrame, label: str, features: list[str], keys: list[str],
                     seed: int = SEED, kind: str = "rf", num_trees: int = 100, max_depth: int | None = None) -> dict:
    """exact 80/20 split by a seeded hash of ``keys`` (F4), random-forest (of any depth, all
    features at a node) or GBT regression, MSE/R^2 and predictions."""
    from ..operators.evaluate import regression_metrics
    from .prep import random_split
    data = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(
        df.select(*keys, F.col(label).cast("double").alias("label"), *features))
    train, test = (materialize(p) for p in random_split(data, keys, 0.2, seed))
    if kind == "rf":
        model = Fitted("RandomForestRegressor", "forest", TR.fit_forest(train, None, num_trees, max_depth, None, seed=seed), 0)
        scored = predict(model, test)
    else:
        model = GBTRegressor(seed=seed).fit(train)
        scored = model.transform(test)
    pred = materialize(scored.select(*keys, F.col("label").alias("y_test"), F.col("prediction").alias("y_pred")))
    m = regression_metrics(pred, "y_test", "y_pred").first()
    return {"model": model, "predictions": pred, "mse": m["mse"], "r2": m["r2"]}


def kmeans_cluster(df: DataFrame, k: int = 3, seed: int = SEED, n_init: int = 10,
                   features_col: str = "features") -> dict:
    """k-means with ``n_init`` seeded restarts, the lowest training cost kept;
    row labels in ``cluster``."""
    best = None
    df = df.persist()
    for i in range(n_init):
        model = KMeans(k=k, seed=seed + i, featuresCol=features_col, predictionCol="cluster").fit(df)
        cost = model.summary.trainingCost
        if best is None or cost < best[1]:
            best = (model, cost)
    model = best[0]
    df.unpersist()
    return {"model": model, "cost": best[1], "labels": model.transform(df)}


def silhouette(labelled: DataFrame, features_col: str = "features", cluster_col: str = "cluster") -> float:
    """mean silhouette with squared Euclidean distances (Spark's distributed
    form; sklearn's default uses plain Euclidean distances, which needs all pairs)."""
    ev = ClusteringEvaluator(featuresCol=features_col, predictionCol=cluster_col,
                             distanceMeasure="squaredEuclidean", metricName="silhouette")
    return ev.evaluate(labelled)


def grid_search(train: DataFrame, estimator, grid: dict, folds: int = 3, seed: int = SEED,
                parallelism: int = 4) -> dict:
    """k-fold cross-validated grid search on weighted F1; best parameters."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(estimator.getParam(param), values)
    maps = builder.build()
    ev = MulticlassClassificationEvaluator(metricName="f1")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev, numFolds=folds,
                        seed=seed, parallelism=parallelism)
    model = cv.fit(train)
    best_i = int(np.argmax(model.avgMetrics))
    best = {p.name: v for p, v in maps[best_i].items()}
    return {"model": model.bestModel, "best_params": best, "scores": list(model.avgMetrics)}


def fit_params(name: str, data: DataFrame, num_features: int, num_classes: int, seed: int = SEED, **params) -> Fitted:
    """``fit_named`` with parameters of the model's own fit function."""
    fits = {"RandomForest": fit_random_forest, "Bagging": fit_bagging, "ExtraTrees": fit_extra_trees, "DecisionTree": fit_decision_tree,
            "NeuralNetwork": fit_mlp}
    if not params:
        return fit_named(name, data, num_features, num_classes, seed)
    if name in fits:
        return fits[name](data, num_classes, seed=seed, **params)
    if name == "GradientBoosting":
        return fit_gbt(data, num_classes, **params)
    if name == "SVM":
        return fit_svm(data, num_features, num_classes, seed=seed, **params)
    if name == "AdaBoost":
        return fit_adaboost(data, num_classes, seed=seed, **params)
    if name == "LogisticRegression":
        return fit_spark(name, logistic(**params), data, num_classes)
    raise ValueError(f"{name} has no parameters to search")


# The two searches of the reference.
GRIDS = {"RandomForest": {"num_trees": [50, 100], "max_depth": [5, 10]}, "GradientBoosting": {"max_iter": [50, 100], "max_depth": [3, 6]}}


def search_chain(name: str, train: DataFrame, keys: list[str], num_features: int, num_classes: int, grid: dict | None = None,
                 folds: int = 3, oversample: bool = True, seed: int = SEED, parallelism: int = 4) -> dict:
    """search over the whole chain. Rows fall into folds by a seeded hash of ``keys``; the rows outside
    a fold are oversampled and scaled once, written, and shared by all settings, which are fitted on them
    and judged on the fold by weighted F1. The best mean (the first on ties) is refitted on all rows.
    ``parallelism`` settings are fitted and judged side by side.

    Returns ``best_params``, ``scores`` (params, fold, rows of the fold, weighted F1) and ``model``."""
    from itertools import product
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    from ..functions.hashing import row_hash
    from ..operators.evaluate import classification_metrics, fit_confusion
    grid = grid if grid is not None else GRIDS[name]
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]
    dealt = materialize(train.withColumn("_fold", (row_hash(keys, seed) % folds).cast("int")))
    sizes = {r["_fold"]: r["count"] for r in dealt.groupBy("_fold").count().collect()}
    id_col = keys[0] if len(keys) == 1 else None

    def prepared(fold: int | None):
        rest = dealt if fold is None else dealt.where(F.col("_fold") != fold).drop("_fold")
        made = materialize(oversampled(rest, id_col, seed) if oversample else rest.select("label", "features"))
        scale = fit_vector_scale(made)
        return materialize(scale_vector(made, scale)), scale

    def judged(i: int, fold: int, made: DataFrame, scale: dict) -> dict:
        fitted = fit_params(name, made, num_features, num_classes, seed, **settings[i])
        fitted.extra["scale"] = scale
        held = dealt.where(F.col("_fold") == fold).drop("_fold")
        f1 = classification_metrics(fit_confusion(predict(fitted, held), "label", "prediction"))["f1_weighted"]
        return {"setting": i, "params": settings[i], "fold": fold, "rows": sizes[fold], "f1_weighted": f1}
    aside = inheritable_thread_target(train.sparkSession)
    ready = [(fold, *prepared(fold)) for fold in sorted(sizes)]
    whole, scale = prepared(None)
    with ThreadPool(parallelism) as pool:
        scores = [w.get() for w in [pool.apply_async(aside(partial(judged, i, *one))) for one in ready for i in range(len(settings))]]
    mean = [float(np.mean([s["f1_weighted"] for s in scores if s["setting"] == i])) for i in range(len(settings))]
    best = settings[int(np.argmax(mean))]
    model = fit_params(name, whole, num_features, num_classes, seed, **best)
    model.extra["scale"] = scale
    return {"best_params": best, "scores": scores, "mean": mean, "model": model}


def random_projection_matrix(num_features: int, n_components: int = 2, seed: int = SEED,
                             kind: str = "gaussian") -> np.ndarray:
    """Seeded projection matrix (n_components x num_features): Gaussian N(0, 1/k) or the
    sparse {-s, 0, +s} form with density 1/sqrt(d)."""
    rng = np.random.RandomState(seed)
    if kind == "gaussian":
        return rng.normal(0.0, 1.0 / math.sqrt(n_components), size=(n_components, num_features))
    density = 1.0 / math.sqrt(num_features)
    s = math.sqrt(1.0 / density) / math.sqrt(n_components)
    u = rng.uniform(size=(n_components, num_features))
    return np.where(u < density / 2, -s, np.where(u < density, s, 0.0))


def random_projection(df: DataFrame, input_col: str, num_features: int, n_components: int = 2,
                      seed: int = SEED, kind: str = "gaussian", output_prefix: str = "rp") -> DataFrame:
    """project an array/vector column to ``n_components`` columns with native
    dot products against the seeded matrix."""
    mat = random_projection_matrix(num_features, n_components, seed, kind)
    dt = df.schema[input_col].dataType.simpleString()
    x = vector_to_array(F.col(input_col), "float64") if dt == "vector" else F.col(input_col).cast("array<double>")
    cols = []
    for j in range(n_components):
        w = F.array(*[F.lit(float(v)) for v in mat[j]])
        cols.append(F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
                    .alias(f"{output_prefix}{j}"))
    return df.select("*", *cols)


# ----------------------------------------------------------------------------
# G13 importance, F24 training loop
# ----------------------------------------------------------------------------
def feature_importance(fitted: Fitted, feature_names: list[str], top_n: int | None = None):
    """(feature, importance, rank) from a tree model, names taken from the
    assembled vector's own order (so they cannot be misaligned)."""
    model = fitted.model
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    if isinstance(model, TR.Forest):
        imp = model.importances()
    elif isinstance(model, TR.Boosted):
        imp = model.importances(len(feature_names))
    elif hasattr(model, "featureImportances"):
        imp = model.featureImportances.toArray()
    else:
        return None
    order = sorted(range(len(imp)), key=lambda i: (-imp[i], i))
    rows = [(feature_names[i], float(imp[i]), r + 1) for r, i in enumerate(order)]
    return rows[:top_n] if top_n else rows


MODEL_NAMES = ["RandomForest", "LogisticRegression", "GradientBoosting", "SVM", "NeuralNetwork"]


def fit_named(name: str, train: DataFrame, num_features: int, num_classes: int, seed: int = SEED) -> Fitted:
    if name == "RandomForest":
        return fit_random_forest(train, num_classes, seed=seed)
    if name == "LogisticRegression":
        return fit_spark(name, logistic(), train, num_classes)
    if name == "GradientBoosting":
        return fit_gbt(train, num_classes)
    if name == "SVM":
        return fit_svm(train, num_features, num_classes, seed=seed)
    if name == "NeuralNetwork":
        return fit_mlp(train, num_classes, seed=seed)
    if name == "GaussianNB":
        return fit_spark(name, gaussian_nb(), train, num_classes)
    if name == "LinearDiscriminantAnalysis":
        return fit_lda(train, num_features, num_classes)
    if name == "AdaBoost":
        return fit_adaboost(train, num_classes, seed=seed)
    if name == "Bagging":
        return fit_bagging(train, num_classes, seed=seed)
    if name == "ExtraTrees":
        return fit_extra_trees(train, num_classes, seed=seed)
    if name == "DecisionTree":
        return fit_decision_tree(train, num_classes, seed=seed)
    raise ValueError(f"unknown model {name}")


class TrainingRun(dict):
    """Results by model name; ``best`` is the first with the highest weighted F1."""

    best: str | None = None


def fit_vector_scale(df: DataFrame, features_col: str = "features") -> dict:
    """Mean and population deviation of every vector component (0 counts as 1)."""
    row = df.select(Summarizer.metrics("count", "mean", "variance").summary(F.col(features_col)).alias("s")).first()["s"]
    n = row["count"]
    std = np.sqrt(np.asarray(row["variance"].toArray()) * (n - 1) / n) if n > 1 else np.zeros(len(row["mean"]))
    return {"mean": [float(v) for v in row["mean"].toArray()], "std": [float(v) or 1.0 for v in std]}


def scale_vector(df: DataFrame, scale: dict, features_col: str = "features") -> DataFrame:
    """(x - mean) / std on a vector column."""
    mean, std = (F.array(*[F.lit(v) for v in scale[k]]) for k in ("mean", "std"))
    x = vector_to_array(F.col(features_col), "float64")
    return df.withColumn(features_col, array_to_vector(F.zip_with(F.zip_with(x, mean, lambda a, m: a - m), std, lambda a, s: a / s)))


def oversampled(train: DataFrame, id_col: str | None = None, seed: int = SEED) -> DataFrame:
    """The train side with every class raised to the majority's count (F5): ``label, features``."""
    from .neighbors import smote_oversample
    if id_col is None:
        id_col = "_id"
        train = train.withColumn(id_col, F.monotonically_increasing_id())
    train = materialize(train.select(id_col, "label", "features"))
    return smote_oversample(train, "label", "features", id_col, seed=seed).select(
        "label", array_to_vector(F.col("features")).alias("features"))


def fit_chain(name: str, train: DataFrame, num_features: int, num_classes: int, id_col: str | None = None,
              oversample: bool = True, seed: int = SEED) -> Fitted:
    """Oversample (train rows only), scale, classify; ``predict`` scales by the fitted values."""
    data = oversampled(train, id_col, seed) if oversample else train.select("label", "features")
    scale = fit_vector_scale(data)
    fitted = fit_named(name, scale_vector(data, scale), num_features, num_classes, seed)
    fitted.extra["scale"] = scale
    return fitted


def train_all_models(train: DataFrame, test: DataFrame, num_features: int, num_classes: int,
                     names: list[str] = MODEL_NAMES, seed: int = SEED, id_col: str | None = None,
                     oversample: bool = True) -> TrainingRun:
    """every model as a chain of oversampling (train rows only), scaling and the
    classifier, timed, applied to the test rows, with the full metrics:
    {name: {model, metrics, predictions, train_time}} and ``best``. The oversampled and
    scaled rows are the same for all models, so they are made once; each model's time
    includes them, as the reference's does."""
    from ..operators.evaluate import best_model, metrics_dict
    t0 = time.time()
    data = oversampled(train, id_col, seed) if oversample else train.select("label", "features")
    data = materialize(data)
    scale = fit_vector_scale(data)
    data = materialize(scale_vector(data, scale)).persist()
    prepared = time.time() - t0
    test = test.persist()
    results = TrainingRun()
    for name in names:
        t0 = time.time()
        fitted = fit_named(name, data, num_features, num_classes, seed)
        fitted.extra["scale"] = scale
        took = time.time() - t0 + prepared
        pred = predict(fitted, test).persist()
        metrics = metrics_dict(pred, "label", "prediction", "probability")
        pred.unpersist()
        results[name] = {"model": fitted, "metrics": metrics, "predictions": pred, "train_time": took}
    data.unpersist()
    test.unpersist()
    results.best = best_model(results) if results else None
    return results


# ----------------------------------------------------------------------------
# Any fitted model, with its scaling
# ----------------------------------------------------------------------------
def _plain(v):
    if isinstance(v, np.ndarray):
        return v.tolist()
    if isinstance(v, dict):
        return {k: _plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    return v.item() if isinstance(v, np.generic) else v


def save_fitted(fitted: Fitted, path: str) -> None:
    """Parameters as one JSON row in ``fitted``, Spark models beside it."""
    from pyspark.sql import SparkSession
    own = fitted.kind in ("forest", "boosted")
    if own:
        TR.save_trees(fitted.model, f"{path}/trees")
    parts = {"model": fitted.model} if fitted.model is not None and not own else {}
    parts.update({f"stump{i}": m for i, m in enumerate(fitted.extra.get("stumps", []))})
    for name, model in parts.items():
        model.write().overwrite().save(f"{path}/{name}")
    meta = {"name": fitted.name, "kind": fitted.kind, "num_classes": fitted.num_classes, "features_col": fitted.features_col,
            "parts": {n: f"{type(m).__module__}.{type(m).__name__}" for n, m in parts.items()},
            "extra": {k: _plain(v) for k, v in fitted.extra.items() if k != "stumps"}}
    SparkSession.active().createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").parquet(f"{path}/fitted")


def is_fitted(spark, path: str) -> bool:
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(f"{path}/fitted")
    except AnalysisException:
        return False
    return True


def load_fitted(spark, path: str) -> Fitted:
    meta = json.loads(spark.read.parquet(f"{path}/fitted").first()["meta"])
    parts = {}
    for name, cls in meta["parts"].items():
        module, _, kind = cls.rpartition(".")
        parts[name] = getattr(importlib.import_module(module), kind).load(f"{path}/{name}")
    extra = meta["extra"]
    stumps = [parts[f"stump{i}"] for i in range(sum(n.startswith("stump") for n in parts))]
    if stumps:
        extra["stumps"] = stumps
    model = TR.load_trees(spark, f"{path}/trees") if meta["kind"] in ("forest", "boosted") else parts.get("model")
    return Fitted(meta["name"], meta["kind"], model, meta["num_classes"], meta["features_col"], extra)
