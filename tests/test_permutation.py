"""Permutation importance by one join against a plain version."""
import numpy as np
from propensity.operators import boosting as bo
from propensity.operators import search as se


def test_equals_a_plain_version(spark):
    rng = np.random.default_rng(0)
    n = 500
    codes = rng.integers(0, 6, (n, 3)).astype(np.uint8)
    target = (codes[:, 0] + codes[:, 1] * 0.3 + rng.normal(size=n) > 3.2).astype(int)
    bins = bo.Bins(["a", "b", "c"], [], {c: [0.0, 1.0, 2.0, 3.0, 4.0] for c in "abc"}, {})
    rows = [(i + 1, int(t), 0, bytes(c.tolist())) for i, (c, t) in enumerate(zip(codes, target))]
    df = spark.createDataFrame(rows, "key long, target int, role int, codes binary")
    model = bo.fit_many(df, bins, [bo.Params(10, 0.3, max_depth=2, patience=None)], 2)[0]
    found = {(r["repeat"], r["column"], r["step"]): (r["pos"], r["neg"]) for r in se.permuted_scores(df, model, n, 3, 42).collect()}

    def counts(c):
        step = np.minimum((bo.FINE_STEPS / (1 + np.exp(-model.margins(c)))).astype(int), bo.FINE_STEPS - 1)
        return {s: (int(((step == s) & (target == 1)).sum()), int(((step == s) & (target == 0)).sum())) for s in set(step.tolist())}

    want = {(-1, -1, s): v for s, v in counts(codes).items()}
    for k, (a, b) in enumerate(se._steps(n, 3, 42)):
        source = (a * np.arange(n) + b) % n
        for c in range(3):
            moved = codes.copy()
            moved[:, c] = codes[source, c]
            want |= {(k, c, s): v for s, v in counts(moved).items()}
    assert found == want


def test_importance_ranks_the_signal(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(x), float(z), 1.0, int(x + 0.3 * e > 0)) for i, (x, z, e) in enumerate(rng.normal(size=(1200, 3)))]
    df = spark.createDataFrame(rows, "id long, x double, z double, k double, target int")
    got = {r["feature"]: r for r in se.permutation_importance(df.where("id % 3 > 0"), df.where("id % 3 = 0"), ["x", "z", "k"], n_estimators=10).collect()}
    assert got["x"]["pfi_mean"] > 0.3 > 0.05 > abs(got["z"]["pfi_mean"]) and got["k"]["pfi_mean"] == got["k"]["pfi_std"] == 0.0
    assert [r["feature"] for r in se.top_n_pfi(spark.createDataFrame(list(got.values())), 1).collect()] == ["x"]


def test_parts_of_trees_add_up_to_the_same_bits():
    """A column's margins come from the parts of all trees, walked anew only where a tree splits on the column."""
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 5, (300, 3)).astype(np.uint8)
    target = (codes[:, 0] * codes[:, 1] > rng.integers(0, 9, 300)).astype(np.int8)
    rows, trees = bo.Rows(codes, target, np.zeros(300, np.int8), np.arange(300), 5), []
    fit = bo.drive([bo.boost(bo.Params(9, 0.3, max_depth=3, patience=None), np.zeros(3, bool), trees.append)],
                   lambda wanted: {i: rows.answer(i, r, lambda f, a, b: trees[a:b]) for i, r in wanted.items()})[0]
    model = bo.BoostedModel(None, fit.base, fit.trees, [], {})
    assert np.array_equal(model.total(model.parts(codes), 300), model.margins(codes))
    assert bo.BoostedModel(None, 0.5, [], [], {}).total(bo.BoostedModel(None, 0.5, [], [], {}).parts(codes), 300).tolist() == [0.5] * 300
