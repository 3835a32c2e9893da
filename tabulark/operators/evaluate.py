"""Evaluation and reporting from a (label, prediction[, probability]) frame.

Every count-based metric derives from the confusion matrix, which is one
partial aggregation into at most k x k rows; only those rows reach the driver.
Score-based metrics (ROC-AUC, ROC curve) aggregate per distinct score first and
then use a range-partitioned running sum, so no task holds all scores.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cumulative import running_totals
from .explore import histogram

MAX_CLASSES = 1_000             # class tables up to this size are broadcast


# ---------------------------------------------------------------------- G1
def class_labels(df: DataFrame, label: str, pred: str) -> list:
    """Sorted union of the classes seen in either column (sklearn ``unique_labels``).
    Nulls, if any, are a class of their own, the last one."""
    a, b = _common(df, label, pred)
    vals = df.select(a.alias("c")).union(df.select(b.alias("c"))).distinct().collect()   # one row per class
    seen = [r["c"] for r in vals]
    return sorted(c for c in seen if c is not None) + [None] * (None in seen)


def _common(df: DataFrame, label: str, pred: str) -> tuple[Column, Column]:
    """Label and prediction in one type: as they are, as doubles, or as text."""
    kinds = [df.schema[c].dataType for c in (label, pred)]
    if kinds[0] == kinds[1]:
        return F.col(label), F.col(pred)
    kind = "double" if all(isinstance(k, T.NumericType) for k in kinds) else "string"
    return F.col(label).cast(kind), F.col(pred).cast(kind)


def _pair_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    a, b = _common(df, label, pred)
    return df.groupBy(a.alias("label"), b.alias("prediction")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: list | None = None) -> DataFrame:
    """G1: (label, prediction, n) for every pair of the class union, zeros kept."""
    spark = df.sparkSession
    classes = classes if classes is not None else class_labels(df, label, pred)
    counts = _pair_counts(df, label, pred)
    ltype = counts.schema["label"].dataType
    one = spark.createDataFrame([(c,) for c in classes], T.StructType([T.StructField("c", ltype)]))
    scaffold = one.select(F.col("c").alias("label"), F.explode(F.array(*[
        F.lit(c).cast(ltype) for c in classes]) if classes else F.array().cast(T.ArrayType(ltype))).alias("prediction"))
    hit = counts.select(F.col("label").alias("_l"), F.col("prediction").alias("_p"), "n")
    return (scaffold.join(hit, scaffold["label"].eqNullSafe(hit["_l"]) & scaffold["prediction"].eqNullSafe(hit["_p"]), "left")
            .select("label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


@dataclass
class Confusion:
    """What the metrics need of the confusion matrix: three sums a class, in class order."""

    classes: list
    hits: list[int]
    supports: list[int]
    predictions: list[int]

    @property
    def k(self):
        return len(self.classes)

    @property
    def total(self):
        return sum(self.supports)

    def tp(self, i):
        return self.hits[i]

    def support(self, i):
        return self.supports[i]

    def predicted(self, i):
        return self.predictions[i]


def fit_confusion(df: DataFrame, label: str, pred: str) -> Confusion:
    """One aggregation by (label, prediction), then one by class: a row a class reaches the driver."""
    pairs = _pair_counts(df, label, pred)
    same = F.col("label").eqNullSafe(F.col("prediction"))
    sides = F.array(F.struct(F.col("label").alias("c"), F.col("n").alias("s"), F.lit(0).cast("bigint").alias("p"), F.when(same, F.col("n")).otherwise(0).alias("t")),
                    F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("s"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("t")))
    rows = pairs.select(F.explode(sides).alias("e")).groupBy("e.c").agg(*[F.sum(f"e.{x}").alias(x) for x in "spt"]).collect()
    rows = sorted((r for r in rows if r["c"] is not None), key=lambda r: r["c"]) + [r for r in rows if r["c"] is None]
    return Confusion([r["c"] for r in rows], *[[r[x] for r in rows] for x in "tsp"])


# ------------------------------------------------------------------ G2-G5, G8
def _div(a, b):
    return a / b if b else 0.0


def per_class(cm: Confusion) -> list[tuple]:
    """(class, precision, recall, f1, support) with 0 on zero division."""
    out = []
    for i, c in enumerate(cm.classes):
        p = _div(cm.tp(i), cm.predicted(i))
        r = _div(cm.tp(i), cm.support(i))
        f = _div(2 * p * r, p + r)
        out.append((c, p, r, f, cm.support(i)))
    return out


def classification_metrics(cm: Confusion) -> dict:
    """Accuracy, macro and support-weighted precision / recall / F1."""
    pcs = per_class(cm)
    n = cm.total
    k = len(pcs)
    acc = _div(sum(cm.tp(i) for i in range(cm.k)), n)
    out = {"accuracy": acc}
    for j, name in ((1, "precision"), (2, "recall"), (3, "f1")):
        out[f"{name}_macro"] = _div(sum(p[j] for p in pcs), k)
        out[f"{name}_weighted"] = _div(sum(p[j] * p[4] for p in pcs), n)
    return out


def binary_average(cm: Confusion, pos_index: int = 1) -> dict:
    """Precision/recall/F1 of the positive class (the old API's ``average='binary'``)."""
    pcs = per_class(cm)
    c, p, r, f, _ = pcs[pos_index]
    return {"precision": p, "recall": r, "f1": f}


def confusion_counts(cm: Confusion) -> dict:
    """TP/FP/TN/FN and the manual F1.

    2 classes: the 2x2 cells (positive = the larger class). More classes: the
    reference's pooled form TP = trace, FP = sum of column off-diagonals,
    FN = sum of row off-diagonals, TN = total - (FP + FN + TP), manual F1 = 0."""
    if cm.k == 2:
        tn, tp = cm.tp(0), cm.tp(1)
        fp, fn = cm.support(0) - tn, cm.support(1) - tp
        p = _div(tp, tp + fp)
        r = _div(tp, tp + fn)
        return {"TP": tp, "FP": fp, "TN": tn, "FN": fn, "f1_score_manual": _div(2 * p * r, p + r)}
    if cm.k > 2:
        tp = sum(cm.tp(i) for i in range(cm.k))
        fp = sum(cm.predicted(i) - cm.tp(i) for i in range(cm.k))
        fn = sum(cm.support(i) - cm.tp(i) for i in range(cm.k))
        return {"TP": tp, "FP": fp, "TN": cm.total - (fp + fn + tp), "FN": fn, "f1_score_manual": 0.0}
    return {"TP": 0, "FP": 0, "TN": 0, "FN": 0, "f1_score_manual": 0.0}


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision / recall / f1-score / support, then accuracy, macro
    avg and weighted avg rows (the accuracy row repeats the accuracy, as the
    transposed sklearn dict does)."""
    cm = fit_confusion(df, label, pred)
    pcs = per_class(cm)
    met = classification_metrics(cm)
    n = float(cm.total)
    rows = [(str(c), p, r, f, float(s)) for c, p, r, f, s in pcs]
    a = met["accuracy"]
    rows.append(("accuracy", a, a, a, a))
    rows.append(("macro avg", met["precision_macro"], met["recall_macro"], met["f1_macro"], n))
    rows.append(("weighted avg", met["precision_weighted"], met["recall_weighted"], met["f1_weighted"], n))
    return df.sparkSession.createDataFrame(
        rows, "class string, precision double, recall double, f1_score double, support double")


def normalized_confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Confusion counts divided by the row (true class) total."""
    cm = confusion_matrix(df, label, pred)
    return cm.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("label")))


# ----------------------------------------------------------------------- G6
def regression_metrics(df: DataFrame, y: str, p: str, prefix: str = "") -> DataFrame:
    """MSE and R^2 of numeric codes in one aggregation (sklearn's R^2: a constant
    target gives 1.0 for a perfect fit, else 0.0)."""
    yy, pp = F.col(y).cast("double"), F.col(p).cast("double")
    one = df.agg(F.avg((yy - pp) ** 2).alias("mse"), F.sum((yy - pp) ** 2).alias("sse"),
                 (F.var_pop(yy) * F.count(yy)).alias("sst"))
    r2 = F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst")).when(F.col("sse") == 0, 1.0).otherwise(0.0)
    return one.select(F.col("mse").alias(f"mse{prefix}"), r2.alias(f"r2{prefix}"))


# ----------------------------------------------------------------------- G7
def binary_auc(df: DataFrame, positive: Column, score: Column) -> float | None:
    """Exact ROC-AUC with ties counted half (Mann-Whitney), None if one class is absent."""
    res = auc_by_group(df.select(F.lit(0).alias("_g"), positive.alias("_p"), score.alias("_s")),
                       "_g", F.col("_p"), F.col("_s"))
    return res.get(0)


def auc_by_group(df: DataFrame, group: str, positive: Column, score: Column) -> dict:
    """Exact ROC-AUC per group value: {group: auc or None}."""
    counts = (df.select(F.col(group), score.cast("double").alias("score"), positive.cast("int").alias("_pos"))
              .where(F.col("score").isNotNull() & F.col("_pos").isNotNull())
              .groupBy(group, "score")
              .agg(F.sum("_pos").cast("bigint").alias("pos"), F.sum(1 - F.col("_pos")).cast("bigint").alias("neg")))
    cum = running_totals(counts, "score", ["neg"], by=[group])
    # negatives strictly below = cumulative (inclusive) minus this score's own negatives
    contrib = cum.groupBy(group).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * 0.5)).alias("u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    out = {}
    for r in contrib.collect():
        out[r[group]] = (r["u"] / (r["P"] * r["N"])) if r["P"] and r["N"] else None
    return out


def roc_auc(df: DataFrame, label: str, probability: str | None = None, pred: str | None = None,
            classes: list | None = None) -> float | None:
    """Binary AUC on the positive-class probability, one-vs-rest macro AUC for
    more classes; with no probabilities, the binary AUC of the hard predictions
    (the reference's fallback); None when it cannot be computed."""
    if classes is None:
        classes = sorted(r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().collect())
    if len(classes) < 2:
        return None
    if probability is None:
        if pred is None or len(classes) != 2:
            return None
        return binary_auc(df, F.col(label) == F.lit(classes[1]), F.col(pred))
    prob = F.col(probability)
    if len(classes) == 2:
        return binary_auc(df, F.col(label) == F.lit(classes[1]), prob.getItem(1))
    long = df.select(F.posexplode(prob).alias("_k", "_s"), F.col(label).alias("_y"))
    names = df.sparkSession.createDataFrame(list(enumerate(classes)), T.StructType([
        T.StructField("_k", T.IntegerType()), T.StructField("_cls", df.schema[label].dataType)]))
    long = long.join(F.broadcast(names) if len(classes) <= MAX_CLASSES else names, "_k")
    per = auc_by_group(long, "_k", F.col("_y") == F.col("_cls"), F.col("_s"))
    vals = [per.get(i) for i in range(len(classes))]
    if any(v is None for v in vals):
        return None
    return sum(vals) / len(vals)


def roc_curve(df: DataFrame, positive: Column, score: Column) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, descending, plus the
    (inf, 0, 0) start; intermediate collinear points are kept."""
    counts = (df.select(score.cast("double").alias("score"), positive.cast("int").alias("_pos"))
              .where(F.col("score").isNotNull() & F.col("_pos").isNotNull())
              .groupBy("score").agg(F.sum("_pos").cast("bigint").alias("pos"),
                                    F.sum(1 - F.col("_pos")).cast("bigint").alias("neg")))
    tot = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = tot["P"] or 0, tot["N"] or 0
    cum = running_totals(counts, "score", ["pos", "neg"], descending=True)
    curve = cum.select(F.col("score").alias("threshold"),
                       (F.col("cum_neg") / F.lit(N) if N else F.lit(None).cast("double")).alias("fpr"),
                       (F.col("cum_pos") / F.lit(P) if P else F.lit(None).cast("double")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(curve)


# ------------------------------------------------------------------- G11, G12
def residual_table(df: DataFrame, y: str, p: str) -> DataFrame:
    """Y, prediction and residual y - prediction."""
    return df.select(F.col(y).alias("y_test"), F.col(p).alias("y_pred"),
                     (F.col(y).cast("double") - F.col(p).cast("double")).alias("residual"))


def residual_histogram(df: DataFrame, y: str, p: str, bins: int = 20) -> DataFrame:
    return histogram(residual_table(df, y, p), ["residual"], bins)


def probability_histogram(df: DataFrame, label: str, probability: str, bins: int = 20) -> DataFrame:
    """For each class i, the distribution of p(class i) among rows
    of that class, ``bins`` bins over its own range: (class, bin, bin_start, bin_end, count)."""
    from .explore import grouped_histogram
    classes = sorted(r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().collect())
    places = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(classes)], T.StructType([
        T.StructField("_c", df.schema[label].dataType), T.StructField("_i", T.IntegerType())]))
    own = (df.select(F.col(label).alias("_y"), F.col(probability).alias("_p"))
           .join(F.broadcast(places) if len(classes) <= MAX_CLASSES else places, F.col("_y") == F.col("_c"))
           .select(F.col("_y").cast("string").alias("class"),
                   F.get(F.col("_p"), F.col("_i")).cast("double").alias("p")))
    return grouped_histogram(own, "class", "p", bins)


# ----------------------------------------------------------------------- G14
def validate_predictions(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row: counts, nulls, distinct values and the verdict (no nulls)."""
    one = df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.count_if(F.col(y).isNull()).cast("bigint").alias("nulls_test"),
                 F.count_if(F.col(p).isNull()).cast("bigint").alias("nulls_pred"),
                 F.count_distinct(y).cast("bigint").alias("distinct_test"),
                 F.count_distinct(p).cast("bigint").alias("distinct_pred"))
    return one.withColumn("valid", (F.col("nulls_test") == 0) & (F.col("nulls_pred") == 0))


# ------------------------------------------------------------------- G16-G18
METRICS_SCHEMA = T.StructType([
    T.StructField("TP", T.LongType()), T.StructField("FP", T.LongType()), T.StructField("TN", T.LongType()),
    T.StructField("FN", T.LongType()), T.StructField("f1_score_manual", T.DoubleType()),
    T.StructField("precision_macro", T.DoubleType()), T.StructField("recall_macro", T.DoubleType()),
    T.StructField("f1_macro", T.DoubleType()), T.StructField("accuracy", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()), T.StructField("precision_weighted", T.DoubleType()),
    T.StructField("recall_weighted", T.DoubleType()), T.StructField("f1_weighted", T.DoubleType()),
    T.StructField("mse", T.DoubleType()), T.StructField("r2", T.DoubleType()),
    T.StructField("msePI2", T.DoubleType()), T.StructField("r2PI2", T.DoubleType()),
])


def metrics_dict(df: DataFrame, label: str, pred: str, probability: str | None = None,
                 research: tuple | None = None) -> dict:
    cm = fit_confusion(df, label, pred)
    out = dict(confusion_counts(cm))
    out.update(classification_metrics(cm))
    out["roc_auc"] = roc_auc(df, label, probability, pred)
    reg = regression_metrics(df, label, pred).first()
    out["mse"], out["r2"] = reg["mse"], reg["r2"]
    if research is not None:
        rdf, ry, rp = research
        r2 = regression_metrics(rdf, ry, rp).first()
        out["msePI2"], out["r2PI2"] = r2["mse"], r2["r2"]
    else:
        out["msePI2"], out["r2PI2"] = None, None
    return out


def complete_metrics(df: DataFrame, label: str, pred: str, probability: str | None = None,
                     research: tuple | None = None) -> DataFrame:
    """The one-row metrics table."""
    d = metrics_dict(df, label, pred, probability, research)
    return df.sparkSession.createDataFrame([tuple(d.get(f.name) for f in METRICS_SCHEMA.fields)], METRICS_SCHEMA)


COMPARISON_SCHEMA = ("Model string, Accuracy double, F1_Macro double, F1_Weighted double, Precision_Macro double, "
                     "Recall_Macro double, ROC_AUC double, MSE double, R2 double, Train_Time double")


def model_comparison(spark, results: dict) -> DataFrame:
    """One row per model, sorted by weighted F1 (descending; ties keep input order)."""
    rows = []
    for order, (name, r) in enumerate(results.items()):
        m = r["metrics"]
        rows.append((order, (name, m["accuracy"], m["f1_macro"], m["f1_weighted"], m["precision_macro"],
                             m["recall_macro"], m.get("roc_auc"), m["mse"], m["r2"], r.get("train_time"))))
    rows.sort(key=lambda t: (-(t[1][3] or 0.0), t[0]))
    return spark.createDataFrame([r for _, r in rows], COMPARISON_SCHEMA)


def best_model(results: dict) -> str | None:
    """First model with the highest weighted F1 (the reference keeps the first on ties)."""
    best, score = None, None
    for name, r in results.items():
        f = r["metrics"]["f1_weighted"]
        if score is None or f > score:
            best, score = name, f
    return best


def project_summary(spark, records: int, features: int, minutes: float, results: dict | None,
                    missing_values: int | None = None) -> DataFrame:
    """(Metric, Value) rows of the final report."""
    best = best_model(results) if results else None
    f1 = results[best]["metrics"]["f1_weighted"] if best else 0.0
    rows = [("Records Processed", f"{records:,}"), ("Features Generated", str(features)),
            ("Execution Time (min)", f"{minutes:.1f}"), ("Best Model", best or "N/A"),
            ("Best F1-Score", f"{f1:.3f}")]
    if missing_values is not None:
        rows.append(("Missing Values", str(missing_values)))
    return spark.createDataFrame(rows, "Metric string, Value string")


def save_predictions(df: DataFrame, y: str, p: str, path: str, fmt: str = "parquet") -> None:
    """Row-level (y_test, y_pred) written by the executors."""
    df.select(F.col(y).alias("y_test"), F.col(p).alias("y_pred")).write.mode("overwrite").format(fmt) \
        .option("header", True).save(path)
