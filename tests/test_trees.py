"""Trees grown by Spark: splits against brute force, depth, random cuts, boosting."""
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulark.ml import models as M
from tabulark.ml import trees as TR
from tabulark.ml.trees import Rule, best_splits, fit_boosted, fit_forest, grow, hashed, predict_forest


def frame(spark, x, y):
    df = spark.createDataFrame([(i, [float(v) for v in r], float(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, v array<double>, label double")
    return df.select("id", array_to_vector("v").alias("features"), "label").repartition(4)


def rings(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 4))
    return x, (np.floor((x[:, 0] ** 2 + x[:, 1] ** 2) * 3).clip(0, 3)).astype(int)


def brute_split(x, s, rule):
    best = (-np.inf, None)
    for f in range(x.shape[1]):
        v = np.unique(x[:, f])
        for a, b in zip(v[:-1], v[1:]):
            left = s[x[:, f] <= a].sum(0)
            score = float(rule.quality(left) + rule.quality(s.sum(0) - left))
            if score > best[0] + 1e-12:
                best = (score, (f, a, b))
    return best


@pytest.mark.parametrize("kind", ["gini", "mse", "newton"])
def test_best_split_equals_brute_force(kind):
    rng = np.random.default_rng(3)
    for _ in range(20):
        x = rng.integers(0, 8, (60, 3)).astype(float)
        y = rng.integers(0, 3, 60)
        s = np.eye(3)[y] if kind == "gini" else np.stack([np.ones(60), y, y * y], 1) if kind == "mse" else np.stack([y - 1.0, np.ones(60), np.ones(60)], 1)
        rule = Rule(kind)
        node = rng.integers(0, 2, 60)
        stats = np.stack([s[node == k].sum(0) for k in (0, 1)])
        order = [np.argsort(x[:, f], kind="stable") for f in range(3)]
        place = np.stack([np.argsort(o) for o in order], 1)
        f, cut, left = best_splits(x, s, place, order, np.arange(60), node, stats, np.array([1, 2]), rule, 0)
        for k in (0, 1):
            score, (bf, a, b) = brute_split(x[node == k], s[node == k], rule)
            got = float(rule.quality(left[k]) + rule.quality(stats[k] - left[k]))
            assert abs(got - score) < 1e-9 and a <= (cut[k] if f[k] == bf else a) < b


def test_local_trees_are_pure_and_depth_is_an_argument():
    x, y = rings()
    s = np.eye(4)[y]
    flat = grow(x, s, Rule(), 0)
    leaf = flat.stats[flat.feature < 0]
    assert ((leaf > 0).sum(1) == 1).all() and (flat.stats[flat.leaves(x)].argmax(1) == y).all()
    assert len(grow(x, s, Rule(max_depth=2), 0).feature) <= 7
    xor = np.array([[0, 0], [0, 1], [1, 0], [1, 1]] * 3, float)
    flat = grow(xor, np.eye(2)[(xor.sum(1) == 1).astype(int)], Rule(), 0)
    assert (flat.stats[flat.leaves(xor)].max(1) == flat.stats[flat.leaves(xor)].sum(1)).all()


@pytest.mark.parametrize("row_bound", [50, 100_000])
@pytest.mark.parametrize("random_cuts", [False, True])
def test_forests_learn_with_and_without_top_levels(spark, row_bound, random_cuts):
    x, y = rings(900)
    train = frame(spark, x, y)
    forest = fit_forest(train, 4, 25, bootstrap=not random_cuts, random_cuts=random_cuts, row_bound=row_bound)
    assert (sum(len(t.feature) for t in forest.tops.values()) > 25) == (row_bound == 50)
    if not random_cuts:
        depth = [r["d"] for r in forest.subtrees.select(F.length("feature").alias("d")).collect()]
        assert max(depth) > 4
    fresh, truth = rings(400, 1)
    out = M.predict(M.Fitted("f", "forest", forest, 4), frame(spark, fresh, truth)).collect()
    assert np.mean([r.prediction == r.label for r in out]) > 0.75 and all(abs(sum(r.probability) - 1) < 1e-9 for r in out)
    fit = M.predict(M.Fitted("f", "forest", forest, 4), train).collect()
    assert np.mean([r.prediction == r.label for r in fit]) > (0.999 if random_cuts else 0.97)


def test_one_deep_tree_is_pure_through_the_top_levels(spark):
    x, y = rings(800)
    train = frame(spark, x, y)
    f = M.fit_decision_tree(train, 4, row_bound=60)
    assert all(r.prediction == r.label and max(r.probability) == 1 for r in M.predict(f, train).collect())
    shallow = M.fit_decision_tree(train, 4, max_depth=2, row_bound=60)
    assert sum(1 for r in M.predict(shallow, train).select("probability").distinct().collect()) <= 4


def test_a_lost_task_or_other_partitions_change_nothing(spark):
    x, y = rings(300)
    train = frame(spark, x, y).coalesce(1).sortWithinPartitions("id")
    a, b = (M.predict(M.fit_random_forest(train, 4, 5), train).orderBy("id").select("probability").collect() for _ in range(2))
    assert a == b


def test_portions_and_saving(spark, tmp_path, monkeypatch):
    x, y = rings(400)
    train = frame(spark, x, y)
    f = M.fit_random_forest(train, 4, 6, row_bound=80)
    before = M.predict(f, train).orderBy("id").select("probability").collect()
    monkeypatch.setattr(TR, "PORTION_BYTES", 2000)
    assert len(list(f.model.portions())) > 3
    after = M.predict(f, train).orderBy("id").select("probability").collect()
    assert np.allclose([r.probability for r in before], [r.probability for r in after])
    M.save_fitted(f, f"{tmp_path}/m")
    back = M.load_fitted(spark, f"{tmp_path}/m")
    assert M.predict(back, train).orderBy("id").select("probability").collect() == after
    assert np.allclose(back.model.importances(), f.model.importances())
    imp = f.model.importances()
    assert abs(imp.sum() - 1) < 1e-9 and imp[:2].sum() > 0.7


def test_large_forests_meet_rows_in_tasks(spark, monkeypatch):
    x, y = rings(500)
    train = frame(spark, x, y)
    extra = spark.createDataFrame([(900, None, 1.0)], "id long, features array<double>, label double")
    rows = train.select("id", M.vector_to_array("features").alias("features"), "label").unionByName(extra)
    for f in (M.fit_random_forest(train, 4, 6, row_bound=120), M.fit_extra_trees(train, 4, 5)):
        before = M.predict(f, train).orderBy("id").select("probability").collect()
        splits = f.model.first_splits()
        with monkeypatch.context() as m:
            m.setattr(TR, "PORTION_BYTES", 3000)
            m.setattr(TR, "CHUNK_BYTES", 4000)
            m.setattr(TR, "BLOCK_ROWS", 70)
            m.setattr(TR.Forest, "portions", None)                    # no subtree comes to the driver
            after = predict_forest(f.model, rows).orderBy("id").select("_votes").collect()
        assert after[-1]["_votes"] is None and len(after) == 501
        assert np.allclose([r.probability for r in before], [r["_votes"] for r in after[:-1]])
        flats = next(f.model.portions())
        assert [(t, int(flat.feature[0]), float(flat.threshold[0])) for t, (flat, _) in enumerate(flats)] == [s[:3] for s in splits]


def test_rows_of_a_block_go_out_tree_by_tree(spark):
    x, y = rings(64)
    blocks, d, _ = TR.pack_blocks(frame(spark, x, y).coalesce(1))
    scan = TR.Scan(blocks, d, TR.class_stats(4, False, 0), [])
    empty = TR.Flat(np.array([-1]), np.zeros(1), np.array([-1]), np.array([-1]), np.zeros((1, 4)))
    held_at_once = []

    def make(held, end):
        held_at_once.append(len(held))
        held.clear()
        return iter(())
    run = scan.by_node({t: empty for t in range(9)}, [(t, 0) for t in range(9)], lambda i, x, b, s, so_far: s, make)
    list(run(iter(blocks.toArrow().to_batches())))
    assert max(held_at_once) == 1


def test_numbers_travel_narrow_and_whole():
    import pyarrow as pa
    for a, size in ((np.arange(6.0), 7), (np.array([0.5, -1.25]), 9), (np.array([0.1, 1e300]), 17), (np.array([-0.0, 1.0]), 17)):
        sent = TR.packed(a[:, None])
        assert len(sent) == size and np.array_equal(TR.unpacked(pa.py_buffer(sent), 1).ravel().view(np.int64), a.view(np.int64))


def test_random_cuts_are_the_hash(spark):
    x, y = rings(200)
    forest = fit_forest(frame(spark, x, y), 4, 3, bootstrap=False, random_cuts=True, max_features=None, max_depth=1)
    for t in range(3):
        u = hashed(42, t, 1, np.arange(4)) / TR.MODULUS
        cuts = x.min(0) + u * (x.max(0) - x.min(0))
        scores = [sum(np.sum(np.bincount(y[side], minlength=4) ** 2.0) / max(1, side.sum()) for side in (x[:, f] <= cuts[f], x[:, f] > cuts[f])) for f in range(4)]
        flat = next(forest.portions())[t][0]
        assert flat.feature[0] == int(np.argmax(scores)) and abs(flat.threshold[0] - cuts[flat.feature[0]]) < 1e-12


def test_boosting_lowers_the_loss_each_round(spark):
    x, y = rings(700)
    train = frame(spark, x, y)
    f = M.fit_gbt(train, 4, max_iter=23)
    losses = f.model.losses
    assert all(b < a for a, b in zip(losses, losses[1:])) and losses[-1] < 0.5 * losses[0]
    shares = np.bincount(y) / len(y)
    assert abs(losses[0] + np.log(shares[y]).mean()) < 1e-9
    fresh, truth = rings(300, 1)
    out = M.predict(f, frame(spark, fresh, truth)).collect()
    assert np.mean([r.prediction == r.label for r in out]) > 0.75 and all(abs(sum(r.probability) - 1) < 1e-9 for r in out)


def test_small_and_distributed_rounds_agree(spark, monkeypatch):
    x, y = rings(400)
    train = frame(spark, x, y)
    small = fit_boosted(train, 4, 12, max_depth=2)
    monkeypatch.setattr(TR, "BLOCK_ROWS", 64)                # more rows than a block: every level is a pass
    spread = fit_boosted(train, 4, 12, max_depth=2)
    assert np.allclose(small.losses, spread.losses)
    fresh, _ = rings(100, 5)
    assert np.allclose(small.scores(fresh), spread.scores(fresh))


def test_boosting_over_cells_equals_boosting_over_rows(spark, monkeypatch):
    x, y = rings(500)
    train = frame(spark, np.floor(x * 4), y)
    whole = fit_boosted(train, 4, 6, max_depth=3)
    passes = []
    old = TR._level_sums
    monkeypatch.setattr(TR, "_level_sums", lambda *a: passes.append(1) or old(*a))
    monkeypatch.setattr(TR, "BLOCK_ROWS", 400)                # 500 rows are more than a block
    monkeypatch.setattr(TR, "CELLS", 4 * 8 ** 4)
    narrow = frame(spark, np.floor(x[:, :2] * 4), y)
    cells = fit_boosted(narrow, 4, 6, max_depth=3)
    assert not passes                                         # 256 cells at most need no pass a level
    monkeypatch.setattr(TR, "CELLS", 0)
    rows = fit_boosted(narrow, 4, 6, max_depth=3)
    assert passes and np.allclose(cells.losses, rows.losses)
    grid = np.floor(x[:, :2] * 4)
    assert np.allclose(cells.scores(grid), rows.scores(grid))
    assert [int(t.stats[0, 2]) for t in cells.rounds[0]] == [500] * 4
    monkeypatch.setattr(TR, "CELLS", 1 << 20)
    monkeypatch.setattr(TR, "BLOCK_ROWS", 50)                 # more cells than a block: weighted passes
    spread = fit_boosted(train, 4, 6, max_depth=3)
    assert np.allclose(whole.losses, spread.losses)


def test_first_round_leaf_values(spark):
    x, y = rings(500)
    model = fit_boosted(frame(spark, x, y), 4, 1, max_depth=2)
    p = np.bincount(y) / len(y)
    for k, flat in enumerate(model.rounds[0]):
        leaf = flat.leaves(x)
        for node in np.unique(leaf):
            r = (y[leaf == node] == k) - p[k]
            want = 3 / 4 * r.sum() / (np.abs(r) * (1 - np.abs(r))).sum()
            assert abs(flat.stats[node, 0] - want) < 1e-9


def test_values_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 1, (500, 3))
    y = np.floor(x[:, 0] * 5) + 10 * (x[:, 1] > 0.5)
    df = frame(spark, x, y)
    odd = spark.createDataFrame([(900, None, 1.0), (901, [math.nan, 0.0, 0.0], 1.0), (902, [0.5, 0.5, 0.5], None)], "id long, features array<double>, label double")
    arrays = frame(spark, x, y).select("id", M.vector_to_array("features").alias("features"), "label").union(odd)
    forest = fit_forest(arrays, None, 10, bootstrap=False, max_features=None, row_bound=100)
    out = predict_forest(forest, arrays).collect()
    assert all(abs(r["_votes"][0] - r.label) < 1e-9 for r in out if r.id < 900) and [r["_votes"] for r in out if r.id == 900] == [None]
    one = fit_forest(df.limit(1), None, 2, bootstrap=False)
    assert one.subtrees is None
    with pytest.raises(ValueError):
        fit_forest(df.limit(0), None, 2)


def test_blocks_of_one_partition_are_work_for_all_cores(spark):
    n = 3 * TR.BLOCK_ROWS + 5
    one = spark.range(n).select(F.array(F.col("id").cast("double")).alias("features"), (F.col("id") % 2).cast("double").alias("label")).coalesce(1)
    blocks, d, rows = TR.pack_blocks(one)
    assert (d, rows) == (1, n)
    numbers = sorted(r.no for r in blocks.select("no").collect())
    assert len(numbers) > 1 and numbers == list(range(len(numbers)))
    assert blocks.rdd.getNumPartitions() == min(len(numbers), spark.sparkContext.defaultParallelism)


def largest_sent(monkeypatch, frames):
    """The largest binary value that a collect of rows (i, v) brings to the driver."""
    sent = [0]
    old = frames.collect

    def collect(self):
        rows = old(self)
        sent.extend(len(r["v"]) for r in rows if set(self.columns) == {"i", "v"})
        return rows
    monkeypatch.setattr(frames, "collect", collect)
    return sent


@pytest.mark.parametrize("random_cuts", [False, True])
def test_cuts_are_chosen_in_tasks(spark, monkeypatch, random_cuts):
    x, y = rings(500)
    train = frame(spark, x, y).persist()
    near = fit_forest(train, 4, 3, row_bound=60, random_cuts=random_cuts)          # the driver adds the sums up
    monkeypatch.setattr(TR, "DRIVER_BYTES", 0, raising=False)
    sent = largest_sent(monkeypatch, type(train))
    far = fit_forest(train, 4, 3, row_bound=60, random_cuts=random_cuts)
    assert 0 < max(sent) <= 8 * (2 + 2 * 4)                                        # feature, cut and both sides of a node
    for t in range(3):
        a, b = near.tops[t].flat(), far.tops[t].flat()
        assert len(a.feature) > 3 and all(np.array_equal(getattr(a, c), getattr(b, c)) for c in ("feature", "threshold", "left", "right", "stats"))
    train.unpersist()


def test_boosting_cuts_are_chosen_in_tasks(spark, monkeypatch):
    x, y = rings(400)
    train = frame(spark, x, y)
    near = fit_boosted(train, 4, 3, max_depth=3)
    monkeypatch.setattr(TR, "BLOCK_ROWS", 64)
    monkeypatch.setattr(TR, "CELLS", 0)
    monkeypatch.setattr(TR, "DRIVER_BYTES", 0, raising=False)
    monkeypatch.setattr(TR, "HIST_BYTES", 0)
    sent = largest_sent(monkeypatch, type(train))
    far = fit_boosted(train, 4, 3, max_depth=3)
    assert 0 < max(sent) <= 8 * (3 + 2 + 2 * 3)
    assert np.allclose(near.losses, far.losses) and np.allclose(near.scores(x), far.scores(x))
