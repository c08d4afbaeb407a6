"""Histogram boosting: single fits against a plain version, tasks against each other, growth rules."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensity.operators import boosting as bo


def data_of(n=600, p=4, seed=0, nominal=1, missing=8, val=0.3):
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, missing + 1, (n, p)).astype(np.uint8)
    signal = codes[:, 0] * 0.5 - (codes[:, 1] == missing) * 2.0 + np.isin(codes[:, p - 1], [1, 4, 6]) * 1.5 - 2.5
    target = (rng.random(n) < 1 / (1 + np.exp(-signal))).astype(np.int8)
    kinds = np.zeros(p, bool)
    kinds[p - nominal:] = nominal > 0
    rows = bo.Rows(codes, target, (rng.random(n) < val).astype(np.int8), rng.integers(0, 1 << 60, n), missing)
    rows.nominal = kinds
    return rows


def alone(data, *params, budget=bo.PASS_NODES):
    """Fits on one task's rows, without Spark."""
    trees = [[] for _ in params]
    data.margins.clear()
    data.weights.clear()
    fits = [bo.boost(p, data.nominal, trees[i].append, lambda: budget) for i, p in enumerate(params)]
    return bo.drive(fits, lambda wanted: {i: data.answer(i, r, lambda f, a, b: trees[f][a:b]) for i, r in wanted.items()})


def plain_split(codes, g, h, kinds, missing, p):
    """The best split of one node by trying all of them."""
    best = (0.0, None)

    def score(mask):
        t = np.sign(g[mask].sum()) * max(abs(g[mask].sum()) - p.alpha, 0)
        return t * t / max(h[mask].sum() + p.lam, 1e-12)

    every = np.ones(len(g), bool)
    for c in range(codes.shape[1]):
        if kinds[c]:
            def ratio(v, c=c):
                m = codes[:, c] == v
                return g[m].sum() / (h[m].sum() + p.lam + 1 / bo.ONE)
            order = sorted((v for v in range(missing + 1) if (codes[:, c] == v).any()), key=ratio)
            options = [set(order[:k]) for k in range(1, len(order))]
        else:
            options = [set(range(t + 1)) | extra for t in range(missing) for extra in (set(), {missing})]
        for left in options:
            m = np.isin(codes[:, c], list(left))
            if min(m.sum(), (~m).sum()) >= max(1, p.min_rows) and min(h[m].sum(), h[~m].sum()) >= p.min_hessian:
                gain = score(m) + score(~m) - score(every)
                if gain > best[0] + 1e-9:
                    best = (gain, m)
    return best


def plain_leafwise(data, p):
    """Margins of the training rows after each tree."""
    keep = data.role == bo.TRAIN
    codes, y = data.codes[keep], data.target[keep].astype(float)
    share = y.mean()
    margin, out = np.full(len(y), math.log(share / (1 - share))), []
    for _ in range(p.rounds):
        prob = 1 / (1 + np.exp(-margin))
        g, h = np.rint((prob - y) * bo.ONE) / bo.ONE, np.rint(prob * (1 - prob) * bo.ONE) / bo.ONE
        leaves = [np.arange(len(y))]
        while len(leaves) < p.num_leaves:
            found = [plain_split(codes[r], g[r], h[r], data.nominal, data.missing, p) for r in leaves]
            k = max(range(len(leaves)), key=lambda i: found[i][0])
            if found[k][0] <= bo.MIN_GAIN:
                break
            r = leaves.pop(k)
            leaves += [r[found[k][1]], r[~found[k][1]]]
        step = np.zeros(len(y))
        for r in leaves:
            step[r] = bo.leaf_value(g[r].sum(), h[r].sum(), p)
        margin = margin + step
        out.append(margin)
    return out


@pytest.mark.parametrize("alpha,lam,min_rows", [(0.0, 0.0, 1), (0.7, 2.0, 5)])
def test_two_trees_equal_the_plain_version(alpha, lam, min_rows):
    data = data_of()
    p = bo.Params(2, 0.3, num_leaves=7, alpha=alpha, lam=lam, min_rows=min_rows)
    fit = alone(data, p)[0]
    model = bo.BoostedModel(None, fit.base, fit.trees, [], {})
    want = plain_leafwise(data, p)[fit.best - 1]
    got = model.margins(data.codes[data.role == bo.TRAIN])
    assert np.allclose(got, want, atol=1e-9)
    assert all((t.feature < 0).sum() == 7 for t in fit.trees)


def test_measuring_ahead_changes_nothing(monkeypatch):
    data, p = data_of(2000, 6, 1), bo.Params(4, 0.2, num_leaves=25, min_rows=5)
    found = []
    for ahead, budget in ((1, 512), (3, 512), (50, 512), (50, 2)):
        monkeypatch.setattr(bo, "AHEAD", ahead)
        found.append(alone(data, p, budget=budget)[0])
    for other in found[1:]:
        for a, b in zip(found[0].trees, other.trees):
            assert sorted(a.value[a.feature < 0]) == sorted(b.value[b.feature < 0])
        assert [h["val"] for h in other.history] == [h["val"] for h in found[0].history]


def test_depth_and_leaf_limits():
    data = data_of(3000, 6, 2)
    deep, wide = alone(data, bo.Params(3, 0.3, max_depth=3, min_hessian=1), bo.Params(3, 0.3, num_leaves=2))
    assert all((t.feature < 0).sum() <= 8 for t in deep.trees) and all((t.feature < 0).sum() == 2 for t in wide.trees)


def test_patience_and_best_round():
    data = data_of(500, 5, 3)
    fit = alone(data, bo.Params(400, 0.5, max_depth=6, patience=7))[0]
    losses = [h["val"]["logloss"] for h in fit.history]
    assert len(losses) < 400 and fit.best == len(fit.trees) == int(np.argmin(losses)) + 1 and len(losses) == fit.best + 7
    by_auc = alone(data, bo.Params(400, 0.1, max_depth=3, patience=7, stop_on="roc_auc"))[0]
    aucs = [h["val"]["roc_auc"] for h in by_auc.history]
    assert by_auc.best == int(np.argmax(aucs)) + 1


def test_step_auc_equals_pairs():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 5, (2, 16))
    neg, pos = (np.repeat(np.arange(16), c) for c in counts)
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert bo.step_auc(counts) == pytest.approx(want)
    assert bo.step_auc(np.zeros((2, 4))) is None


def test_auc_of_a_slow_fit_has_resolution():
    """Scores that lie close together still have steps of their own: a low rate measures the AUC of the same trees."""
    data = data_of(4000, 6, 8)
    slow = alone(data, bo.Params(60, 1e-3, max_depth=3, patience=20, stop_on="roc_auc"))[0]
    rows = data.role == bo.VAL
    model = bo.BoostedModel(None, slow.base, slow.trees, [], {})
    score, y = model.margins(data.codes[rows]), data.target[rows]
    pos, neg = score[y == 1], score[y == 0]
    exact = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert slow.aucs["val"] == pytest.approx(exact, abs=1e-3) and slow.history[slow.best - 1]["val"]["roc_auc"] == pytest.approx(exact, abs=3e-3)


def test_samples_of_rows_and_columns():
    data = data_of(4000, 6, 5)
    a, b = alone(data, bo.Params(5, 0.1, max_depth=3, rows=0.5, rows_every=2, columns=0.5), bo.Params(5, 0.1, max_depth=3))
    assert all(len(set(t.feature[t.feature >= 0])) <= 3 for t in a.trees)
    assert a.history[-1]["val"]["logloss"] != b.history[-1]["val"]["logloss"]
    share = (bo.hashed(data.key, 9) < 0.5).mean()
    assert 0.45 < share < 0.55


def test_bins_of_nulls_and_new_levels():
    bins = bo.Bins(["a"], ["c"], {"a": [1.0, 2.0]}, {"c": ["x", "y"]})
    frame = pd.DataFrame({"a": [0.5, 1.0, 1.5, 3.0, None], "c": ["x", "y", "z", None, "x"]})
    assert bins.missing == 3 and bins.codes(frame).tolist() == [[0, 0], [0, 1], [1, 3], [2, 3], [3, 0]]


@pytest.fixture(scope="module")
def coded(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(rng.normal()), None if i % 7 == 0 else float(rng.integers(0, 5)), ["r", "s", "t", None][i % 4]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string").withColumn(
        "target", (F.col("a") + F.when(F.col("c") == "s", 1.0).otherwise(0.0) + F.coalesce("b", F.lit(4.0)) * 0.2 > 1).cast("int"))
    bins = bo.fit_bins(df, ["a", "b"], ["c"])
    return df, bins, bo.code_rows(df, bins, F.xxhash64("id"), F.col("target"), (F.col("id") % 5 == 0).cast("int"))


def test_same_trees_for_any_number_of_tasks(spark, coded, monkeypatch):
    df, bins, rows = coded
    params = [bo.Params(12, 0.2, num_leaves=9, rows=0.7), bo.Params(8, 0.3, max_depth=4, columns=0.7, stop_on="roc_auc")]
    one, four = bo.fit_many(rows, bins, params, 1), bo.fit_many(rows, bins, params, 4)
    for a, b in zip(one, four):
        assert a.history == b.history and a.aucs == b.aucs
        assert all(np.array_equal(x.value, y.value) and np.array_equal(x.feature, y.feature) for x, y in zip(a.trees, b.trees))
    assert one[0].aucs["val"] > 0.95
    monkeypatch.setattr(bo, "MERGE_ROUNDS", 3)
    monkeypatch.setattr(bo, "PASS_BYTES", 1)  # sums added up in a tree of tasks
    merged = bo.fit_many(rows, bins, params, 3)
    assert [m.history for m in merged] == [m.history for m in one]
    again = bo.BoostedModel.from_bytes(one[0].to_bytes())
    scored = {r["id"]: r["p"] for r in df.select("id", again.proba().alias("p")).collect()}
    codes = bins.codes(df.toPandas().sort_values("id"))
    want = 1 / (1 + np.exp(-one[0].margins(codes)))
    assert np.allclose([scored[i] for i in range(3000)], want)


def test_margins_start_anew_where_a_worker_has_none():
    data, p = data_of(800, 5, 7), bo.Params(6, 0.3, max_depth=3)
    want = alone(data, p)[0]
    trees = []

    def forgetful(wanted):
        data.margins.clear()
        data.weights.clear()
        return {i: data.answer(i, r, lambda f, a, b: trees[a:b]) for i, r in wanted.items()}

    got = bo.drive([bo.boost(p, data.nominal, trees.append)], forgetful)[0]
    assert got.history == want.history and got.aucs == want.aucs


def test_one_class_and_no_rows(spark, coded):
    _, bins, rows = coded
    model = bo.fit_many(rows.where("target = 1"), bins, [bo.Params(3, 0.1, max_depth=2)], 2)[0]
    assert all((t.feature < 0).all() for t in model.trees)
    with pytest.raises(ValueError):
        bo.fit_many(rows.limit(0), bins, [bo.Params(3, 0.1, max_depth=2)], 2)


def test_a_leafwise_tree_takes_a_pass_per_level():
    data, trees, passes = data_of(20_000, 8, 9, missing=40), [], []

    def ask(wanted):
        passes.extend(r.done for r in wanted.values() if r.nodes)
        return {i: data.answer(i, r, lambda f, a, b: trees[a:b]) for i, r in wanted.items()}

    bo.drive([bo.boost(bo.Params(6, 0.2, num_leaves=40, min_rows=5, patience=None), data.nominal, trees.append)], ask)
    for k, tree in enumerate(trees):
        level = np.zeros(len(tree.feature), int)
        for i in np.flatnonzero(tree.feature >= 0):
            level[tree.left[i]] = level[tree.right[i]] = level[i] + 1
        assert passes.count(k) <= level.max() + 1


def test_histograms_of_more_rows_than_fit_one_sum():
    n, quarter = 80_000, bo.ONE // 4  # the largest hessian there is
    at = np.arange(n) % 3 - 1
    weights = (np.full(n, -float(bo.ONE)), np.full(n, float(quarter)), np.ones(n))
    got = bo.histograms(np.ones((n, 2), np.uint8), np.array([1]), at, 2, weights, 4)
    want = [[-bo.ONE * int((at == k).sum()), quarter * int((at == k).sum()), int((at == k).sum())] for k in (0, 1)]
    assert got.shape == (2, 1, 4, 3) and got[:, 0, 1].tolist() == want and not got[:, 0, [0, 2, 3]].any()


def test_margins_are_kept_beside_the_rows(coded):
    """Trees are added to persisted blocks once, and what lies there is let go of at the end."""
    _, bins, rows = coded
    sc = rows.sparkSession.sparkContext
    before = set(sc._jsc.getPersistentRDDs().keySet())
    added, own = [], type(sc).broadcast
    sc.broadcast = lambda value: (added.append({i: (first, len(trees)) for i, (first, trees) in value.items()}), own(sc, value))[1]
    try:
        bo.fit_many(rows, bins, [bo.Params(5, 0.2, num_leaves=4, patience=None)], 2)
    finally:
        del sc.broadcast
    assert added == [{0: (k, 1)} for k in range(5)]
    assert set(sc._jsc.getPersistentRDDs().keySet()) == before


def test_tasks_of_a_pass_follow_the_work(spark):
    """One fit of few rows takes few tasks, many fits or many rows take all slots."""
    df, slots = spark.range(1), spark.sparkContext.defaultParallelism
    assert bo.tasks_for(df, 1000) == min(2, slots)
    assert bo.tasks_for(df, 2 * bo.ROWS_PER_TASK) == min(2, slots) <= bo.tasks_for(df, 2 * bo.ROWS_PER_TASK, slots) == slots
    assert bo.ROWS_PER_TASK > 20_000 and bo.tasks_for(df, 100 * slots * bo.ROWS_PER_TASK) >= slots


def test_rows_off_the_way_to_the_asked_leaves_are_dropped():
    """a deep leaf costs a walk of the rows that come near it, and gradients of the rows that come to it."""
    data = data_of(3000, 6, 11, missing=20)
    tree = alone(data, bo.Params(1, 0.3, num_leaves=25, patience=None))[0].trees[0]
    leaves, every = np.flatnonzero(tree.feature < 0), np.arange(3000)
    want = tree.leaves(data.codes)
    for nodes in ((int(leaves[-1]),), tuple(int(i) for i in leaves[::3]), tuple(int(i) for i in leaves)):
        for own in (every, every[::7], every[:0]):
            rows, at = tree.reach(data.codes, own, nodes)
            assert sorted(rows.tolist()) == [i for i in own if want[i] in nodes]
            assert (np.array(nodes, int)[at] == want[rows]).all()
    rows, at = bo.ROOT.reach(data.codes, every[::2], (0,))
    assert rows.tolist() == every[::2].tolist() and not at.any()
    asked, own = [], data.gradients
    data.gradients = lambda rows, margin: (asked.append(len(rows)), own(rows, margin))[1]
    alone(data, bo.Params(3, 0.3, num_leaves=25, patience=None))
    assert asked[0] == (data.role == bo.TRAIN).sum() and min(asked) < asked[0] / 4


def test_whole_rows_answer_like_blocks():
    """a task with all rows keeps gradients and leaves between passes; the sums are those of rows that keep nothing."""
    data = data_of(5000, 6, 12, missing=30)
    whole = bo.WholeRows(data.codes, data.target, data.role, data.key, data.missing)
    whole.nominal = data.nominal
    params = [bo.Params(6, 0.2, num_leaves=25, min_rows=5, rows=0.6, rows_every=3, columns=0.5), bo.Params(5, 0.3, max_depth=5, stop_on="roc_auc")]
    for budget in (bo.PASS_NODES, 2):
        for a, b in zip(alone(data, *params, budget=budget), alone(whole, *params, budget=budget)):
            assert a.history == b.history and a.aucs == b.aucs and len(a.trees) == len(b.trees)
            assert all(np.array_equal(x.value, y.value) and np.array_equal(x.feature, y.feature) for x, y in zip(a.trees, b.trees))


def test_few_rows_take_a_task_per_fit(spark, coded, monkeypatch):
    """passes of a few rows are nearly all overhead, so a fit is one task; more rows are read in passes."""
    _, bins, rows = coded
    params = [bo.Params(12, 0.2, num_leaves=9, rows=0.7), bo.Params(8, 0.3, max_depth=4, columns=0.7, stop_on="roc_auc")]
    tracker, ended = spark.sparkContext.statusTracker(), []
    before = len(tracker.getJobIdsForGroup(None))
    whole = bo.fit_many(rows, bins, params, finished=lambda i, model: ended.append((i, len(model.trees))))
    assert len(tracker.getJobIdsForGroup(None)) - before <= 10  # the passes of 12 rounds are more than 40
    monkeypatch.setattr(bo, "WHOLE_BYTES", 0)
    passes = bo.fit_many(rows, bins, params)
    assert len(tracker.getJobIdsForGroup(None)) - before > 40
    assert sorted(ended) == [(i, len(m.trees)) for i, m in enumerate(whole)]
    for a, b in zip(whole, passes):
        assert a.history == b.history and a.aucs == b.aucs and a.base == b.base
        assert all(np.array_equal(x.value, y.value) and np.array_equal(x.left_codes, y.left_codes) for x, y in zip(a.trees, b.trees))
