"""Registered queries: evaluation and reporting.

Predictions are derived deterministically from the tables so the metrics can be
checked by SQL: label = alphabetical code of o_orderstatus, prediction =
l_linenumber % 3, binary label = (o_orderstatus = 'F') with l_discount as its
score, class probabilities = normalised (l_discount + .01, l_tax + .01, l_quantity / 50).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import features as FE
from . import frames as FR
from .registry import r6, register, rounded

A = FR.ACTIVITY_SQL
PROB_PARTS = ["l_discount + 0.01", "l_tax + 0.01", "l_quantity / 50"]
PSUM = "(" + " + ".join(f"({p})" for p in PROB_PARTS) + ")"

EVAL_CTE = f"""a AS ({A}),
mc AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
       FROM (SELECT DISTINCT COALESCE(o_orderstatus, 'nan') AS v FROM a) x),
e AS (SELECT a.l_orderkey, a.l_linenumber, CAST(mc.code AS INTEGER) AS y,
             CAST(a.l_linenumber % 3 AS INTEGER) AS pred, CAST(a.l_suppkey % 3 AS INTEGER) AS pred_b,
             CAST(a.l_partkey % 3 AS INTEGER) AS pred_c,
             CAST(a.o_orderstatus = 'F' AS INTEGER) AS yb, CAST(a.l_linenumber % 2 AS INTEGER) AS pb,
             a.l_discount AS score,
             {", ".join(f"({p}) / {PSUM} AS p{i}" for i, p in enumerate(PROB_PARTS))}
      FROM a JOIN mc ON COALESCE(a.o_orderstatus, 'nan') = mc.v)"""


def eval_frame(spark, sf):
    a = FR.activity(spark, sf)
    coded, _ = FE.label_encode(a.withColumn("y", F.col("o_orderstatus")), ["y"])
    parts = [F.col("l_discount") + 0.01, F.col("l_tax") + 0.01, F.col("l_quantity") / 50]
    total = parts[0] + parts[1] + parts[2]
    return coded.select(
        "l_orderkey", "l_linenumber", F.col("y").cast("int").alias("y"),
        (F.col("l_linenumber") % 3).cast("int").alias("pred"),
        (F.col("l_suppkey") % 3).cast("int").alias("pred_b"),
        (F.col("l_partkey") % 3).cast("int").alias("pred_c"),
        (F.col("o_orderstatus") == "F").cast("int").alias("yb"),
        (F.col("l_linenumber") % 2).cast("int").alias("pb"),
        F.col("l_discount").alias("score"),
        F.array(*[p / total for p in parts]).alias("probability"))


def _cm_cte(y: str, p: str, tag: str = "") -> str:
    return f"""cls{tag} AS (SELECT DISTINCT {y} AS c FROM e UNION SELECT DISTINCT {p} FROM e),
cm{tag} AS (SELECT l.c AS label, q.c AS prediction, CAST(COUNT(e.{y}) AS BIGINT) AS n
       FROM cls{tag} l CROSS JOIN cls{tag} q LEFT JOIN e ON e.{y} = l.c AND e.{p} = q.c GROUP BY 1, 2),
pc{tag} AS (SELECT c, SUM(n) FILTER (WHERE label = c AND prediction = c) AS tp,
              SUM(n) FILTER (WHERE prediction = c) AS predicted, SUM(n) FILTER (WHERE label = c) AS support
       FROM cls{tag}, cm{tag} GROUP BY c),
pr{tag} AS (SELECT c, support, tp, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM pc{tag}),
f{tag} AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pr{tag}),
agg{tag} AS (SELECT SUM(tp) / SUM(support) AS accuracy, AVG(p) AS precision_macro, AVG(r) AS recall_macro,
              AVG(f1) AS f1_macro, SUM(p * support) / SUM(support) AS precision_weighted,
              SUM(r * support) / SUM(support) AS recall_weighted, SUM(f1 * support) / SUM(support) AS f1_weighted
       FROM f{tag}),
reg{tag} AS (SELECT AVG((y - {p}) * (y - {p})) AS mse,
              1 - SUM((y - {p}) * (y - {p})) / (VAR_POP(y) * COUNT(y)) AS r2 FROM e)"""


def _auc_sql(pos: str, score: str) -> str:
    return f"""(SELECT (SUM(CASE WHEN pos = 1 THEN rk + (ties - 1) / 2.0 END) - SUM(pos) * (SUM(pos) + 1) / 2.0)
        / (SUM(pos) * (COUNT(*) - SUM(pos)))
 FROM (SELECT pos, rank() OVER (ORDER BY s) AS rk, COUNT(*) OVER (PARTITION BY s) AS ties
       FROM (SELECT CAST({pos} AS INTEGER) AS pos, {score} AS s FROM e) z) w)"""


OVR_SQL = "(" + " + ".join(_auc_sql(f"y = {i}", f"p{i}") for i in range(3)) + ") / 3"


@register("confusion_matrix", f"WITH {EVAL_CTE}, {_cm_cte('y', 'pred')} SELECT CAST(label AS INTEGER) AS label, "
          "CAST(prediction AS INTEGER) AS prediction, n FROM cm")
def q_confusion(spark, sf):
    return EV.confusion_matrix(eval_frame(spark, sf), "y", "pred")


@register("accuracy", f"WITH {EVAL_CTE}, {_cm_cte('y', 'pred')} SELECT {r6('accuracy')} AS accuracy FROM agg")
def q_accuracy(spark, sf):
    cm = EV.fit_confusion(eval_frame(spark, sf), "y", "pred")
    return rounded(spark.createDataFrame([(EV.classification_metrics(cm)["accuracy"],)], "accuracy double"))


PRF = ["precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted"]


@register("precision_recall_f1", f"WITH {EVAL_CTE}, {_cm_cte('y', 'pred')} SELECT "
          + ", ".join(f"{r6(c)} AS {c}" for c in PRF) + " FROM agg")
def q_prf(spark, sf):
    m = EV.classification_metrics(EV.fit_confusion(eval_frame(spark, sf), "y", "pred"))
    return rounded(spark.createDataFrame([tuple(m[c] for c in PRF)], ", ".join(f"{c} double" for c in PRF)))


@register("binary_counts_f1", f"""WITH {EVAL_CTE},
c AS (SELECT SUM(CASE WHEN yb = 1 AND pb = 1 THEN 1 ELSE 0 END) AS tp, SUM(CASE WHEN yb = 0 AND pb = 1 THEN 1 ELSE 0 END) AS fp,
             SUM(CASE WHEN yb = 0 AND pb = 0 THEN 1 ELSE 0 END) AS tn, SUM(CASE WHEN yb = 1 AND pb = 0 THEN 1 ELSE 0 END) AS fn FROM e),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM c)
SELECT CAST(tp AS BIGINT) AS TP, CAST(fp AS BIGINT) AS FP, CAST(tn AS BIGINT) AS TN, CAST(fn AS BIGINT) AS FN,
       {r6("CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END")} AS f1_score_manual FROM pr""")
def q_binary_counts(spark, sf):
    d = EV.confusion_counts(EV.fit_confusion(eval_frame(spark, sf), "yb", "pb"))
    return rounded(spark.createDataFrame([(d["TP"], d["FP"], d["TN"], d["FN"], d["f1_score_manual"])],
                                         "TP bigint, FP bigint, TN bigint, FN bigint, f1_score_manual double"))


@register("multiclass_pooled_counts", f"""WITH {EVAL_CTE}, {_cm_cte('y', 'pred')},
t AS (SELECT SUM(n) FILTER (WHERE label = prediction) AS tp, SUM(n) FILTER (WHERE label <> prediction) AS off,
             SUM(n) AS total FROM cm)
SELECT CAST(tp AS BIGINT) AS TP, CAST(off AS BIGINT) AS FP, CAST(total - (off + off + tp) AS BIGINT) AS TN,
       CAST(off AS BIGINT) AS FN, CAST(0.0 AS DOUBLE) AS f1_score_manual FROM t""")
def q_pooled(spark, sf):
    d = EV.confusion_counts(EV.fit_confusion(eval_frame(spark, sf), "y", "pred"))
    return spark.createDataFrame([(d["TP"], d["FP"], d["TN"], d["FN"], d["f1_score_manual"])],
                                 "TP bigint, FP bigint, TN bigint, FN bigint, f1_score_manual double")


@register("regression_metrics", f"WITH {EVAL_CTE}, {_cm_cte('y', 'pred')} SELECT {r6('mse')} AS mse, {r6('r2')} AS r2 FROM reg")
def q_regression(spark, sf):
    return rounded(EV.regression_metrics(eval_frame(spark, sf), "y", "pred"))


@register("roc_auc", f"WITH {EVAL_CTE} SELECT {r6(_auc_sql('yb', 'score'))} AS roc_auc_binary, "
          f"{r6(OVR_SQL)} AS roc_auc_ovr")
def q_roc_auc(spark, sf):
    e = eval_frame(spark, sf)
    b = EV.binary_auc(e, F.col("yb") == 1, F.col("score"))
    m = EV.roc_auc(e, "y", "probability")
    return rounded(spark.createDataFrame([(b, m)], "roc_auc_binary double, roc_auc_ovr double"))


@register("classification_report", f"""WITH {EVAL_CTE}, {_cm_cte('y', 'pred')}
SELECT CAST(c AS VARCHAR) AS class, {r6('p')} AS precision, {r6('r')} AS recall, {r6('f1')} AS f1_score,
       CAST(support AS DOUBLE) AS support FROM f
UNION ALL SELECT 'accuracy', {r6('accuracy')}, {r6('accuracy')}, {r6('accuracy')}, {r6('accuracy')} FROM agg
UNION ALL SELECT 'macro avg', {r6('precision_macro')}, {r6('recall_macro')}, {r6('f1_macro')},
                 (SELECT CAST(COUNT(*) AS DOUBLE) FROM e) FROM agg
UNION ALL SELECT 'weighted avg', {r6('precision_weighted')}, {r6('recall_weighted')}, {r6('f1_weighted')},
                 (SELECT CAST(COUNT(*) AS DOUBLE) FROM e) FROM agg""")
def q_class_report(spark, sf):
    return rounded(EV.classification_report(eval_frame(spark, sf), "y", "pred"))


@register("roc_curve", f"""WITH {EVAL_CTE},
c AS (SELECT score, SUM(yb) AS pos, SUM(1 - yb) AS neg FROM e GROUP BY score),
t AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM c),
w AS (SELECT score, SUM(pos) OVER (ORDER BY score DESC) AS cp, SUM(neg) OVER (ORDER BY score DESC) AS cn FROM c)
SELECT score AS threshold, {r6('cn / N')} AS fpr, {r6('cp / P')} AS tpr FROM w, t
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def q_roc_curve(spark, sf):
    e = eval_frame(spark, sf)
    return rounded(EV.roc_curve(e, F.col("yb") == 1, F.col("score")))


@register("normalized_confusion", f"""WITH {EVAL_CTE}, {_cm_cte('y', 'pred')}
SELECT CAST(label AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction, n,
       {r6('n / SUM(n) OVER (PARTITION BY label)')} AS share FROM cm""")
def q_norm_confusion(spark, sf):
    return rounded(EV.normalized_confusion(eval_frame(spark, sf), "y", "pred"))


@register("residual_table", f"""WITH {EVAL_CTE}
SELECT y AS y_test, pred AS y_pred, CAST(y AS DOUBLE) - CAST(pred AS DOUBLE) AS residual FROM e""")
def q_residuals(spark, sf):
    return EV.residual_table(eval_frame(spark, sf), "y", "pred")


def _hist_of(sub: str, col: str, bins: int, by: str | None = None) -> str:
    from .queries_stats import _hist_sql
    return _hist_sql(sub, col, bins, by)


@register("residual_histogram", f"""WITH {EVAL_CTE} SELECT * FROM ({_hist_of(
    "(SELECT CAST(y AS DOUBLE) - CAST(pred AS DOUBLE) AS residual FROM e) q", "residual", 20)}) h""")
def q_residual_hist(spark, sf):
    return rounded(EV.residual_histogram(eval_frame(spark, sf), "y", "pred", 20))


@register("probability_histogram", f"""WITH {EVAL_CTE} SELECT * FROM ({_hist_of(
    "(SELECT CAST(y AS VARCHAR) AS class, CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS p FROM e) q",
    "p", 20, "class")}) h""")
def q_prob_hist(spark, sf):
    return rounded(EV.probability_histogram(eval_frame(spark, sf), "y", "probability", 20))


@register("validate_predictions", f"""WITH {EVAL_CTE}
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) - COUNT(y) AS BIGINT) AS nulls_test,
       CAST(COUNT(*) - COUNT(pred) AS BIGINT) AS nulls_pred, CAST(COUNT(DISTINCT y) AS BIGINT) AS distinct_test,
       CAST(COUNT(DISTINCT pred) AS BIGINT) AS distinct_pred, COUNT(*) = COUNT(y) AND COUNT(*) = COUNT(pred) AS valid
FROM e""")
def q_validate(spark, sf):
    return EV.validate_predictions(eval_frame(spark, sf), "y", "pred")


@register("complete_metrics", f"""WITH {EVAL_CTE}, {_cm_cte('y', 'pred')},
t AS (SELECT SUM(n) FILTER (WHERE label = prediction) AS tp, SUM(n) FILTER (WHERE label <> prediction) AS off,
             SUM(n) AS total FROM cm)
SELECT CAST(tp AS BIGINT) AS TP, CAST(off AS BIGINT) AS FP, CAST(total - (off + off + tp) AS BIGINT) AS TN,
       CAST(off AS BIGINT) AS FN, CAST(0.0 AS DOUBLE) AS f1_score_manual,
       {", ".join(f"{r6(c)} AS {c}" for c in ["precision_macro", "recall_macro", "f1_macro", "accuracy"])},
       {r6(OVR_SQL)} AS roc_auc,
       {", ".join(f"{r6(c)} AS {c}" for c in ["precision_weighted", "recall_weighted", "f1_weighted", "mse", "r2"])},
       CAST(NULL AS DOUBLE) AS msePI2, CAST(NULL AS DOUBLE) AS r2PI2
FROM t, agg, reg""")
def q_complete(spark, sf):
    return rounded(EV.complete_metrics(eval_frame(spark, sf), "y", "pred", "probability"))


MODELS = {"ModelA": "pred", "ModelB": "pred_b", "ModelC": "pred_c"}


@register("model_comparison", f"WITH {EVAL_CTE}, " + ", ".join(
    _cm_cte("y", p, f"_{k}") for k, p in MODELS.items()) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{k}' AS Model, {r6('accuracy')} AS Accuracy, {r6('f1_macro')} AS F1_Macro, "
    f"{r6('f1_weighted')} AS F1_Weighted, {r6('precision_macro')} AS Precision_Macro, "
    f"{r6('recall_macro')} AS Recall_Macro, CAST(NULL AS DOUBLE) AS ROC_AUC, {r6('mse')} AS MSE, "
    f"{r6('r2')} AS R2, CAST(NULL AS DOUBLE) AS Train_Time FROM agg_{k}, reg_{k}" for k in MODELS))
def q_model_comparison(spark, sf):
    e = eval_frame(spark, sf).persist()
    results = {k: {"metrics": EV.metrics_dict(e, "y", p), "train_time": None} for k, p in MODELS.items()}
    return rounded(EV.model_comparison(spark, results))


# width of eval_frame: l_orderkey l_linenumber y pred pred_b pred_c yb pb score probability
EVAL_WIDTH = 10


@register("project_summary", f"WITH {EVAL_CTE}, " + ", ".join(
    _cm_cte("y", p, f"_{k}") for k, p in MODELS.items()) + """,
m AS (""" + " UNION ALL ".join(f"SELECT '{k}' AS model, {i} AS ord, f1_weighted FROM agg_{k}"
                               for i, k in enumerate(MODELS)) + """),
b AS (SELECT model, f1_weighted FROM m ORDER BY f1_weighted DESC, ord LIMIT 1)
SELECT 'Records Processed' AS Metric, format('{:,}', (SELECT COUNT(*) FROM e)) AS Value
UNION ALL SELECT 'Features Generated', '""" + str(EVAL_WIDTH) + """'
UNION ALL SELECT 'Execution Time (min)', '0.0'
UNION ALL SELECT 'Best Model', model FROM b
UNION ALL SELECT 'Best F1-Score', printf('%.3f', f1_weighted) FROM b""")
def q_project_summary(spark, sf):
    e = eval_frame(spark, sf)
    width = len(e.columns)
    e = e.select("y", *MODELS.values()).persist(StorageLevel.MEMORY_AND_DISK)      # read by every metric of every model
    n = e.count()
    results = {k: {"metrics": EV.metrics_dict(e, "y", p)} for k, p in MODELS.items()}
    e.unpersist()
    return EV.project_summary(spark, n, width, 0.0, results)
