"""Registered queries: model preparation, models, neighbours, IO round trips (F, A4-A7, G13, G15).

Models train on ``embeddings`` (64-d vectors, 10 classes) or on the activity
analogue; their outputs are rows-only checks (no SQL oracle can train a
model), while the deterministic preparation steps have SQL oracles.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.hashing import MODULUS, hash_sql, row_hash
from ..ml import models as M
from ..ml import neighbors as NB
from ..ml import prep as PR
from ..operators import evaluate as EV
from ..session import ensure_checkpoint_dir, materialize
from ..sources import tables as IO
from . import frames as FR
from .registry import r6, register, rounded

A = FR.ACTIVITY_SQL
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]
KEYS = ["l_orderkey", "l_linenumber"]


def emb(spark, sf):
    e = IO.read_table(spark, "embeddings", sf)
    return e.select("vec_id", F.col("label").cast("double").alias("label"),
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def emb_split(spark, sf):
    """Stratified 80/20 split, checkpointed: every model iterates over it."""
    train, test = PR.stratified_split(emb(spark, sf), "label", ["vec_id"], 0.2, 42)
    return materialize(train), materialize(test)


# ---------------------------------------------------------------- F1-F4, F6
PM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "empty_col", "mostly_null"]


@register("prepare_matrix", f"""WITH d AS ({FR.DIRTY_SQL}),
m AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
      FROM (SELECT DISTINCT COALESCE(o_orderstatus, 'nan') AS v FROM d) x)
SELECT d.l_orderkey, d.l_linenumber, CAST(m.code AS DOUBLE) AS label,
       {", ".join(f"COALESCE(CAST(d.{c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM d)) AS {c}" for c in PM_COLS)}
FROM d JOIN m ON COALESCE(d.o_orderstatus, 'nan') = m.v""")
def q_prepare(spark, sf):
    d = FR.dirty(spark, sf).select(*KEYS, "o_orderstatus", *PM_COLS).persist(StorageLevel.MEMORY_AND_DISK)
    return PR.prepare_matrix(d, "o_orderstatus", keys=KEYS, assemble=False).df


@register("select_k_best", f"""WITH a AS ({A}),
p AS (SELECT o_orderstatus, COUNT(*) AS n, {", ".join(f"AVG({c}) AS m{i}, VAR_POP({c}) AS v{i}" for i, c in enumerate(NUM))}
      FROM a GROUP BY o_orderstatus),
g AS (SELECT {", ".join(f"SUM(n * m{i}) / SUM(n) AS g{i}" for i in range(len(NUM)))} FROM p),
fs AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS idx, (SUM(n * (m{i} - g{i}) * (m{i} - g{i})) / (COUNT(*) - 1)) / (SUM(n * v{i}) / (SUM(n) - COUNT(*))) AS f FROM p, g" for i, c in enumerate(NUM))})
SELECT feature FROM fs ORDER BY f DESC, idx LIMIT 3""")
def q_select_k(spark, sf):
    a = FR.activity(spark, sf)
    chosen = PR.select_k_best(a, "o_orderstatus", NUM, 3)
    return spark.createDataFrame([(c,) for c in chosen], "feature string") if chosen else None


H = hash_sql(KEYS, 42)


@register("stratified_split", f"""WITH a AS ({A}),
c AS (SELECT o_orderstatus, COUNT(*) AS n FROM a GROUP BY o_orderstatus),
t AS (SELECT CAST(ceil(0.2 * SUM(n)) AS BIGINT) AS nt, SUM(n) AS total FROM c),
e AS (SELECT o_orderstatus, nt * n / total AS ex, CAST(floor(nt * n / total) AS BIGINT) AS fl, nt FROM c, t),
r AS (SELECT *, row_number() OVER (ORDER BY ex - fl DESC, o_orderstatus) AS rr,
             nt - SUM(fl) OVER () AS leftover FROM e),
q AS (SELECT o_orderstatus, fl + CASE WHEN rr <= leftover THEN 1 ELSE 0 END AS quota FROM r),
s AS (SELECT a.l_orderkey, a.l_linenumber, a.o_orderstatus,
             row_number() OVER (PARTITION BY a.o_orderstatus ORDER BY {H}, a.l_orderkey, a.l_linenumber) AS rn
      FROM a)
SELECT s.l_orderkey, s.l_linenumber, s.o_orderstatus FROM s JOIN q USING (o_orderstatus) WHERE rn <= quota""")
def q_split(spark, sf):
    a = FR.activity(spark, sf).select(*KEYS, "o_orderstatus")
    train, test = PR.stratified_split(a, "o_orderstatus", KEYS, 0.2, 42)
    return test


@register("random_split", f"""WITH a AS ({A}),
s AS (SELECT l_orderkey, l_linenumber, o_orderstatus,
             row_number() OVER (ORDER BY {H}, l_orderkey, l_linenumber) AS rn FROM a)
SELECT l_orderkey, l_linenumber, o_orderstatus FROM s
WHERE rn <= (SELECT CAST(ceil(0.2 * COUNT(*)) AS BIGINT) FROM a)""")
def q_random_split(spark, sf):
    a = FR.activity(spark, sf).select(*KEYS, "o_orderstatus")
    train, test = PR.random_split(a, KEYS, 0.2, 42)
    return test


@register("standard_scale", f"""WITH a AS ({A}),
s AS (SELECT {", ".join(f"AVG({c}) AS m{i}, STDDEV_POP({c}) AS s{i}" for i, c in enumerate(NUM))} FROM a)
SELECT l_orderkey, l_linenumber, {", ".join(r6(f"({c} - m{i}) / s{i}") + f" AS {c}" for i, c in enumerate(NUM))}
FROM a, s""")
def q_scale(spark, sf):
    a = FR.activity(spark, sf).select(*KEYS, *NUM)
    return rounded(PR.apply_standard_scale(a, PR.fit_standard_scale(a, NUM)))


# ------------------------------------------------------------------ F5, F17
SMOTE_X = ["CAST(o_totalprice AS DOUBLE) / 1000", "CAST(month(o_orderdate) AS DOUBLE)", "CAST(dayofyear(o_orderdate) AS DOUBLE)"]


@register("smote_oversample", f"""WITH o AS (SELECT o_orderkey, o_orderstatus, {", ".join(f"{e} AS x{i}" for i, e in enumerate(SMOTE_X))} FROM orders),
c AS (SELECT o_orderstatus, COUNT(*) AS n, (SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_orderstatus) t) - COUNT(*) AS need
      FROM orders GROUP BY o_orderstatus),
r AS (SELECT o.*, n, need, row_number() OVER (PARTITION BY o.o_orderstatus ORDER BY {hash_sql(["o_orderkey"], 42)}, o_orderkey) AS rn
      FROM o JOIN c ON o.o_orderstatus = c.o_orderstatus WHERE need > 0),
m AS (SELECT *, need // n + CASE WHEN rn <= need % n THEN 1 ELSE 0 END AS m FROM r),
d AS (SELECT a.o_orderkey, {", ".join(f"b.x{i} AS y{i}" for i in range(3))}, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY
        sqrt({" + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(3))}), b.o_orderkey) AS rank
      FROM m a JOIN o b ON a.o_orderstatus = b.o_orderstatus AND a.o_orderkey <> b.o_orderkey WHERE a.m > 0),
k AS (SELECT o_orderkey, COUNT(*) AS size FROM d WHERE rank <= 5 GROUP BY o_orderkey),
g AS (SELECT m.*, unnest(range(1, CAST(m AS BIGINT) + 1)) AS s FROM m WHERE m > 0),
h AS (SELECT g.*, {hash_sql(["o_orderkey", "s"], 42)} % size + 1 AS pick, CAST({hash_sql(["o_orderkey", "s"], 43)} AS DOUBLE) / {float(MODULUS)!r} AS u
      FROM (SELECT g.*, k.size FROM g JOIN k ON g.o_orderkey = k.o_orderkey) g)
SELECT o_orderstatus, FALSE AS synthetic, {", ".join(r6(f"x{i}") + f" AS x{i}" for i in range(3))} FROM o
UNION ALL SELECT o_orderstatus, TRUE, {", ".join(r6(f"x{i} + u * (y{i} - x{i})") for i in range(3))}
FROM h JOIN d ON h.o_orderkey = d.o_orderkey AND d.rank = h.pick""")
def q_smote(spark, sf):
    o = IO.read_table(spark, "orders", sf)
    x = o.select("o_orderkey", "o_orderstatus", F.array(*[F.expr(e) for e in SMOTE_X]).alias("x"))
    out = NB.smote_oversample(x, "o_orderstatus", "x", "o_orderkey", k=5, seed=42)
    return rounded(out.select("o_orderstatus", "synthetic", *[F.col("x")[i].alias(f"x{i}") for i in range(3)]))


EMB_SPLIT_SQL = f"""e AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
ec AS (SELECT label, COUNT(*) AS n FROM e GROUP BY label),
et AS (SELECT CAST(ceil(0.2 * SUM(n)) AS BIGINT) AS nt, SUM(n) AS total FROM ec),
ee AS (SELECT label, nt * n / total AS ex, CAST(floor(nt * n / total) AS BIGINT) AS fl, nt FROM ec, et),
er AS (SELECT *, row_number() OVER (ORDER BY ex - fl DESC, label) AS rr, nt - SUM(fl) OVER () AS leftover FROM ee),
eq AS (SELECT label, fl + CASE WHEN rr <= leftover THEN 1 ELSE 0 END AS quota FROM er),
es AS (SELECT e.*, row_number() OVER (PARTITION BY label ORDER BY {hash_sql(["vec_id"], 42)}, vec_id) AS rn FROM e),
train AS (SELECT es.vec_id, es.label, x FROM es JOIN eq ON es.label = eq.label WHERE rn > quota),
test AS (SELECT es.vec_id, es.label, x FROM es JOIN eq ON es.label = eq.label WHERE rn <= quota)"""


@register("knn_classify", f"""WITH {EMB_SPLIT_SQL},
p AS (SELECT t.vec_id, t.label, r.label AS near, row_number() OVER (PARTITION BY t.vec_id ORDER BY
        sqrt(list_sum(list_transform(list_zip(t.x, r.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))), r.vec_id) AS rank
      FROM test t, train r),
v AS (SELECT vec_id, label, near, COUNT(*) AS votes FROM p WHERE rank <= 5 GROUP BY vec_id, label, near),
w AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, near) AS place FROM v)
SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(near AS DOUBLE) AS prediction, CAST(votes / 5 AS DOUBLE) AS share FROM w WHERE place = 1""")
def q_knn(spark, sf):
    train, test = emb_split(spark, sf)
    pred = NB.knn_classify(train, test, k=5, id_col="vec_id", vec_col="features", label_col="label")
    return pred.select("vec_id", "label", "prediction", F.array_max("probability").alias("share"))


# ------------------------------------------------------------ F7-F16, F23
def _predictions(spark, sf, name):
    """A row for each test row: the fitted model's class and the probability it gives it."""
    train, test = emb_split(spark, sf)
    return _shown(M.predict(M.fit_named(name, train, 64, 10), test))


def _shown(pred):
    return pred.select("vec_id", "label", "prediction", F.array_max("probability").alias("share"))


for _key, _name in [("train_random_forest", "RandomForest"), ("train_logistic", "LogisticRegression"), ("train_svm", "SVM"),
                    ("train_mlp", "NeuralNetwork"), ("train_adaboost", "AdaBoost"), ("train_bagging", "Bagging")]:
    register(_key)(lambda spark, sf, _n=_name: _predictions(spark, sf, _n))


@register("predict")
def q_predict(spark, sf):
    train, test = emb_split(spark, sf)
    return _shown(M.predict(M.fit_chain("LogisticRegression", train, 64, 10, id_col="vec_id"), test))


@register("train_gaussian_nb", f"""WITH {EMB_SPLIT_SQL},
v AS (SELECT vec_id, label, unnest(x) AS x, unnest(range(0, 64)) AS f FROM train),
g AS (SELECT max(s) * 1e-9 AS eps FROM (SELECT var_pop(x) AS s FROM v GROUP BY f) t),
m AS (SELECT label, f, avg(x) AS mu, var_pop(x) + eps AS s FROM v, g GROUP BY label, f, eps),
p AS (SELECT label, ln(COUNT(*)) - ln((SELECT COUNT(*) FROM train)) AS p FROM train GROUP BY label),
t AS (SELECT vec_id, label, unnest(x) AS x, unnest(range(0, 64)) AS f FROM test),
l AS (SELECT t.vec_id, t.label, m.label AS guess, SUM(-0.5 * (ln(2 * pi() * s) + (x - mu) * (x - mu) / s)) AS l
      FROM t JOIN m ON t.f = m.f GROUP BY t.vec_id, t.label, m.label),
j AS (SELECT vec_id, l.label, guess, l + p AS l FROM l JOIN p ON l.guess = p.label),
b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY l DESC) AS place, max(l) OVER (PARTITION BY vec_id) AS top FROM j),
n AS (SELECT vec_id, SUM(exp(l - top)) AS total FROM b GROUP BY vec_id)
SELECT b.vec_id, CAST(label AS DOUBLE) AS label, CAST(guess AS DOUBLE) AS prediction, {r6("1 / total")} AS share
FROM b JOIN n ON b.vec_id = n.vec_id WHERE place = 1""")
def q_gaussian_nb(spark, sf):
    return rounded(_predictions(spark, sf, "GaussianNB"))


LDA = ["l_quantity", "l_extendedprice"]


@register("train_lda_classifier", f"""WITH a AS (SELECT l_orderkey, l_linenumber, o_orderstatus, row_number() OVER () AS rid, CAST(l_quantity AS DOUBLE) / 50 AS x, CAST(l_extendedprice AS DOUBLE) / 50000 AS y,
       {H} AS h FROM ({A}) a),
train AS (SELECT * FROM a WHERE h % 5 <> 0), test AS (SELECT * FROM a WHERE h % 5 = 0),
c AS (SELECT o_orderstatus, COUNT(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) * COUNT(*) AS xx, var_pop(y) * COUNT(*) AS yy,
             covar_pop(x, y) * COUNT(*) AS xy FROM train GROUP BY o_orderstatus),
w AS (SELECT SUM(xx) / (SUM(n) - COUNT(*)) AS a, SUM(xy) / (SUM(n) - COUNT(*)) AS b, SUM(yy) / (SUM(n) - COUNT(*)) AS d, SUM(n) AS total FROM c),
i AS (SELECT d / (a * d - b * b) AS ia, -b / (a * d - b * b) AS ib, a / (a * d - b * b) AS id, total FROM w),
k AS (SELECT o_orderstatus, ia * mx + ib * my AS cx, ib * mx + id * my AS cy,
             -0.5 * (mx * (ia * mx + ib * my) + my * (ib * mx + id * my)) + ln(n / total) AS c0 FROM c, i),
s AS (SELECT rid, l_orderkey, l_linenumber, k.o_orderstatus AS guess, cx * x + cy * y + c0 AS s FROM test, k),
b AS (SELECT *, max(s) OVER (PARTITION BY rid) AS top, row_number() OVER (PARTITION BY rid ORDER BY s DESC) AS place FROM s),
n AS (SELECT rid, SUM(exp(s - top)) AS total FROM b GROUP BY rid)
SELECT b.l_orderkey, b.l_linenumber, guess AS prediction, {r6("1 / total")} AS share
FROM b JOIN n ON b.rid = n.rid WHERE place = 1""")
def q_lda(spark, sf):
    a = FR.activity(spark, sf)
    names = ["F", "O", "P"]
    label = F.coalesce(*[F.when(F.col("o_orderstatus") == c, F.lit(float(i))) for i, c in enumerate(names)])
    rows = materialize(a.select(*KEYS, label.alias("label"), row_hash(KEYS, 42).alias("h"), array_to_vector(F.array(
        F.col("l_quantity").cast("double") / 50, F.col("l_extendedprice").cast("double") / 50000)).alias("features")))
    fitted = M.fit_lda(rows.where("h % 5 <> 0"), 2, 3)
    pred = M.predict(fitted, rows.where("h % 5 = 0"))
    name = F.array(*[F.lit(c) for c in names])
    return rounded(pred.select(*KEYS, F.element_at(name, F.col("prediction").cast("int") + 1).alias("prediction"),
                               F.array_max("probability").alias("share")))


ET_TREES, ET_DRAWN = 100, 8


@register("train_extra_trees", f"""WITH {EMB_SPLIT_SQL},
v AS (SELECT label, unnest(x) AS x, CAST(unnest(range(0, 64)) AS BIGINT) AS f FROM train),
r AS (SELECT f, min(x) AS low, max(x) AS high FROM v GROUP BY f),
t AS (SELECT CAST(unnest(range(0, {ET_TREES})) AS BIGINT) AS tree),
h AS (SELECT tree, f, low, high, {hash_sql(["tree", "1", "f"], 42)} AS u, {hash_sql(["tree", "1", "f"], 43)} AS d FROM t, r),
o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY d) AS place FROM h WHERE high > low),
c AS (SELECT tree, f, low + u / {float(MODULUS)!r} * (high - low) AS cut FROM o WHERE place <= {ET_DRAWN}),
k AS (SELECT tree, c.f, cut, label, SUM(CASE WHEN x <= cut THEN 1 ELSE 0 END) AS l, SUM(CASE WHEN x <= cut THEN 0 ELSE 1 END) AS g
      FROM c JOIN v ON c.f = v.f GROUP BY tree, c.f, cut, label),
q AS (SELECT tree, f, cut, CAST(SUM(l * l) AS DOUBLE) / SUM(l) + CAST(SUM(g * g) AS DOUBLE) / SUM(g) AS score
      FROM k GROUP BY tree, f, cut HAVING SUM(l) > 0 AND SUM(g) > 0),
b AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY score DESC, f) AS place FROM q)
SELECT CAST(tree AS INTEGER) AS tree, CAST(f AS INTEGER) AS feature, {r6("cut")} AS cut, {r6("score")} AS score FROM b WHERE place = 1""")
def q_extra_trees(spark, sf):
    """The first cut of each fitted tree and its score."""
    train, _ = emb_split(spark, sf)
    fitted = M.fit_named("ExtraTrees", train, 64, 10)
    return rounded(spark.createDataFrame(fitted.model.first_splits(), "tree int, feature int, cut double, score double"))


GBT = ["l_discount", "l_tax", "l_quantity"]


def _gbt_sql(depth: int) -> str:
    """First-round trees by SQL: cells of equal features, split level by level."""
    cells = f"""a AS ({A}),
x AS (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(GBT))}, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y FROM a),
p AS (SELECT y AS k, COUNT(*) / (SELECT COUNT(*) FROM x) AS p FROM x GROUP BY y),
z AS (SELECT k, p, x0, x1, x2, 1 AS node, COUNT(*) AS n, SUM(CASE WHEN y = k THEN 1 ELSE 0 END) - p * COUNT(*) AS g, p * (1 - p) * COUNT(*) AS h
      FROM x, p GROUP BY k, p, x0, x1, x2),
top AS (SELECT max(x0) AS t0, max(x1) AS t1, max(x2) AS t2 FROM x)"""
    out, last = [cells], "z"
    for level in range(depth):
        v = f"v{level}"
        out.append(f"{v} AS (" + " UNION ALL ".join(
            f"SELECT k, node, {i} AS f, x{i} AS cut, x{i} < t{i} AS inside, SUM(n) AS n, SUM(g) AS g FROM {last}, top WHERE node >= {2 ** level} GROUP BY k, node, x{i}, t{i}"
            for i in range(3)) + ")")
        out.append(f"""s{level} AS (SELECT *, SUM(n) OVER (PARTITION BY k, node, f ORDER BY cut) AS ln, SUM(g) OVER (PARTITION BY k, node, f ORDER BY cut) AS lg,
             SUM(n) OVER (PARTITION BY k, node, f) AS tn, SUM(g) OVER (PARTITION BY k, node, f) AS tg FROM {v})""")
        out.append(f"""b{level} AS (SELECT * FROM (SELECT k, node, f, cut, row_number() OVER (PARTITION BY k, node ORDER BY
             lg * lg / ln + (tg - lg) * (tg - lg) / (tn - ln) DESC, f, cut) AS place FROM s{level} WHERE tn > ln AND inside) t WHERE place = 1)""")
        nxt = f"z{level}"
        out.append(f"""{nxt} AS (SELECT z.k, z.p, x0, x1, x2, CASE WHEN b.f IS NULL THEN z.node
             WHEN (CASE b.f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END) <= b.cut THEN 2 * z.node ELSE 2 * z.node + 1 END AS node, n, g, h
             FROM {last} z LEFT JOIN b{level} b ON z.k = b.k AND z.node = b.node)""")
        last = nxt
    return "WITH " + ",\n".join(out) + f"""
SELECT CAST(k AS INTEGER) AS class, CAST(node AS INTEGER) AS node, CAST(SUM(n) AS BIGINT) AS n, {r6("2.0 / 3 * SUM(g) / SUM(h)")} AS value
FROM {last} GROUP BY k, node"""


@register("train_gbt", _gbt_sql(3))
def q_gbt(spark, sf):
    """The leaves of the first round's trees of a fitted model: nodes are numbered 1, 2n, 2n + 1."""
    names = ["F", "O", "P"]
    label = F.coalesce(*[F.when(F.col("o_orderstatus") == c, F.lit(float(i))) for i, c in enumerate(names)])
    rows = materialize(FR.activity(spark, sf).select(label.alias("label"), F.array(*[F.col(c).cast("double") for c in GBT]).alias("features")))
    fitted = M.fit_named("GradientBoosting", rows, 3, 3)
    leaves = []
    for k, flat in enumerate(fitted.model.rounds[0]):
        number = {0: 1}
        for i, f in enumerate(flat.feature):
            if f >= 0:
                number[int(flat.left[i])], number[int(flat.right[i])] = 2 * number[i], 2 * number[i] + 1
            else:
                leaves.append((k, number[i], int(round(flat.stats[i, 2])), float(flat.stats[i, 0])))
    return rounded(spark.createDataFrame(leaves, "class int, node int, n long, value double"))


# --------------------------------------------------------------- F18-F22
@register("train_regressors")
def q_regressors(spark, sf):
    a = FR.activity(spark, sf)
    res = M.train_regressors(a, "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "o_totalprice"],
                             KEYS)
    return spark.createDataFrame([(res["mse"], res["r2"])], "mse double, r2 double")


@register("kmeans_cluster")
def q_kmeans(spark, sf):
    res = M.kmeans_cluster(emb(spark, sf), k=3, n_init=10)
    return res["labels"].select("vec_id", "cluster")


@register("silhouette")
def q_silhouette(spark, sf):
    res = M.kmeans_cluster(emb(spark, sf), k=3, n_init=10)
    return spark.createDataFrame([(M.silhouette(res["labels"]),)], "silhouette_sq_euclidean double")


@register("grid_search")
def q_grid(spark, sf):
    """Both searches of the reference over the whole chain: every setting's score on every fold."""
    train, _ = emb_split(spark, sf)
    rows = []
    for name in M.GRIDS:
        res = M.search_chain(name, train, ["vec_id"], 64, 10)
        rows += [(name, *[int(v) for _, v in sorted(s["params"].items(), reverse=True)], s["fold"], s["rows"], float(s["f1_weighted"]),
                  s["params"] == res["best_params"]) for s in res["scores"]]
    return spark.createDataFrame(rows, "model string, trees int, max_depth int, fold int, fold_rows long, f1_weighted double, best boolean")


RP = M.random_projection_matrix(64, 2, 42)


@register("random_projection", "SELECT vec_id, " + ", ".join(
    r6("(" + " + ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) * {float(RP[j][i])!r}" for i in range(64)) + ")")
    + f" AS rp{j}" for j in range(2)) + " FROM embeddings")
def q_rp(spark, sf):
    e = IO.read_table(spark, "embeddings", sf)
    return rounded(M.random_projection(e, "embedding", 64, 2, 42).select("vec_id", "rp0", "rp1"))


# ------------------------------------------------------------- F24, G13
@register("train_all_models")
def q_all_models(spark, sf):
    train, test = emb_split(spark, sf)
    res = M.train_all_models(train, test, 64, 10, id_col="vec_id")
    return EV.model_comparison(spark, res).drop("Train_Time")


@register("feature_importance")
def q_importance(spark, sf):
    feats = ["l_quantity", "l_discount", "l_tax", "o_totalprice", "l_extendedprice"]
    mat = PR.prepare_matrix(FR.activity(spark, sf).select(*KEYS, "o_orderstatus", *feats), "o_orderstatus",
                            keys=KEYS)
    fitted = M.fit_random_forest(mat.df, 3)
    rows = M.feature_importance(fitted, mat.features)
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


# ------------------------------------------------------- A4-A7, G15 round trips
def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("read_activity_csv", "SELECT * FROM lineitem")
def q_csv(spark, sf):
    li = IO.read_table(spark, "lineitem", sf)
    base, _, name = _scratch(spark, "csv").rpartition("/")
    IO.write_report_csv(li, f"{base}/{name}", one_file=False)
    return IO.read_activity_csv(spark, base, name, schema=li.schema)


@register("write_table", "SELECT * FROM orders")
def q_write_table(spark, sf):
    o = IO.read_table(spark, "orders", sf)
    path = _scratch(spark, "tbl")
    IO.write_table(o, path, "replace")
    return spark.read.parquet(path)


@register("save_predictions", f"""SELECT CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS y_test,
       CAST(l_linenumber % 2 AS INTEGER) AS y_pred FROM ({A}) a""")
def q_save_predictions(spark, sf):
    a = FR.activity(spark, sf).select((F.col("o_orderstatus") == "F").cast("int").alias("y"),
                                      (F.col("l_linenumber") % 2).cast("int").alias("p"))
    path = _scratch(spark, "pred")
    EV.save_predictions(a, "y", "p", path)
    return spark.read.parquet(path)


SAVED = ("LogisticRegression", "LinearDiscriminantAnalysis", "SVM", "AdaBoost")


@register("save_model", " UNION ALL ".join(
    f"SELECT '{n}' AS model, CAST(ceil(0.2 * COUNT(*)) AS BIGINT) AS n, CAST(0 AS BIGINT) AS changed FROM embeddings" for n in SAVED))
def q_save_model(spark, sf):
    train, test = emb_split(spark, sf)
    out = None
    for name in SAVED:
        fitted = M.fit_chain(name, train, 64, 10, oversample=False)
        path = _scratch(spark, "model")
        IO.save_model(fitted, path)
        a = M.predict(fitted, test).select("vec_id", F.col("prediction").alias("a"))
        b = M.predict(IO.load_model(path, spark), test).select("vec_id", F.col("prediction").alias("b"))
        one = a.join(b, "vec_id").agg(F.lit(name).alias("model"), F.count(F.lit(1)).cast("bigint").alias("n"),
                                      F.count_if(F.col("a") != F.col("b")).cast("bigint").alias("changed"))
        out = one if out is None else out.unionByName(one)
    return out


@register("list_tables")
def q_list_tables(spark, sf):
    for t in ("lineitem", "orders", "events"):
        IO.read_table(spark, t, sf).createOrReplaceTempView(t)
    names = IO.list_tables(spark)
    return spark.createDataFrame([(n,) for n in names], "table_name string")


@register("read_assessment_csv", "SELECT * FROM orders")
def q_csv_assess(spark, sf):
    o = IO.read_table(spark, "orders", sf)
    base, _, name = _scratch(spark, "csv").rpartition("/")
    IO.write_report_csv(o, f"{base}/{name}", one_file=False)
    return IO.read_assessment_csv(spark, base, name, schema=o.schema)


@register("write_report_csv", """SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n
FROM orders GROUP BY o_orderstatus""")
def q_report_csv(spark, sf):
    from ..operators.sampling import class_counts
    rep = class_counts(IO.read_table(spark, "orders", sf), "o_orderstatus")
    path = _scratch(spark, "report")
    IO.write_report_csv(rep, path)
    return IO.read_csv_latin1(spark, path, rep.schema)


@register("load_model")
def q_load_model(spark, sf):
    from pyspark.ml import Pipeline
    train, test = emb_split(spark, sf)
    path = _scratch(spark, "model")
    IO.save_model(Pipeline(stages=[M.gaussian_nb()]).fit(train), path)
    return IO.load_model(path).transform(test).select("vec_id", "label", "prediction")
