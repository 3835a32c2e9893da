"""Machines fitted in shared passes: the same as Spark's one by one, in as many jobs as the slowest needs."""
import numpy as np
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulark.ml import models as M
from tabulark.ml import svm as SV
from tabulark.ml import trees as TR


def _rows(spark, n=400, d=6, k=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[:, 0] = 2.5                                      # no deviation
    y = np.argmax(x[:, 1:k + 1] + rng.normal(size=(n, k)) * 0.7, 1)
    df = spark.createDataFrame([(i, [float(v) for v in r], float(c)) for i, (r, c) in enumerate(zip(x, y))], "id int, v array<double>, label double")
    return df.withColumn("_fold", F.pmod(F.hash("id"), F.lit(2)).cast("long"))


def test_machines_are_those_of_spark_in_shared_passes(spark):
    df = _rows(spark)
    blocks, width, n = TR.pack_blocks(df.select(F.concat("v", F.array(F.col("_fold").cast("double"))).alias("features"), "label"), rows=64)
    assert (width, n) == (7, 400)
    machines = [(0, -1), (2, 1), (1, 0), (1, -1)]
    coef, intercept, passes = SV.fit_machines(blocks, 6, 2, machines, 0.01, max_iter=15)
    data = df.select(array_to_vector("v").alias("rff"), "label", "_fold")
    for (c, f), w, b in list(zip(machines, coef, intercept))[:2]:
        one = data.where(F.col("_fold") != f).withColumn("label", (F.col("label") == c).cast("double")).coalesce(1)
        m = LinearSVC(featuresCol="rff", regParam=0.01, maxIter=15).fit(one)
        assert np.allclose(w, m.coefficients.toArray(), atol=1e-6) and abs(b - m.intercept) < 1e-6
    assert passes < 45                                 # one by one: four times as many


def test_jobs_are_those_of_the_slowest_machine(spark):
    df = _rows(spark, n=60).select(array_to_vector("v").alias("features"), F.when(F.col("id") % 10 > 0, F.col("label")).alias("label"))
    spark.sparkContext.setJobGroup("svm", "fit")
    f = M.fit_svm(df, 6, 3, n_components=5)            # a row without a label counts against every class
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("svm")
    spark.sparkContext.setJobGroup("", "")
    assert 0 < len(jobs) < 700                         # machine by machine: over 1,000
    rows = M.predict(f, df).where("label is not null").collect()
    assert all(len(r["probability"]) == 3 and abs(sum(r["probability"]) - 1) < 1e-9 for r in rows)
    assert np.mean([r["prediction"] == r["label"] for r in rows]) > 0.6


def test_a_search_without_an_end_takes_its_last_step():
    moving = SV.minimise(1, 1, 1e-6)                   # |x - 0.3| has no slope that the search would stop at
    x = next(moving)
    try:
        while True:
            x = moving.send((abs(x[0] - 0.3), np.where(x < 0.3, -1.0, 1.0)))
    except StopIteration as end:
        assert 0 < end.value[0] < 0.6
