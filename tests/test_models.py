"""Model round trip and calibration invariants (small data, few iterations)."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL


def test_save_load_scores_identical(spark):
    df = E.queries()["save_load_roundtrip"](spark, SMALL)
    assert df.count() > 0 and df.filter(~F.col("same")).count() == 0


def test_isotonic_is_monotone(spark):
    df = E.queries()["isotonic"](spark, SMALL).filter(F.col("model") == "m1_isotonic")
    rows = df.groupBy("id").agg(F.first("proba").alias("p")).count()
    assert rows > 0
    from propensity.sources import campaign as cf
    raw = cf.scores_table(spark, SMALL).filter(F.col("model") == "m1").select("id", F.col("proba").alias("raw"))
    pairs = sorted((r.raw, r.proba) for r in raw.join(df, "id").collect())
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(pairs, pairs[1:]))


def test_permutation_importance_shape(spark):
    pfi = E.queries()["permutation_importance"](spark, SMALL).collect()
    assert len(pfi) == 19
    assert all(r.pfi_std is not None and r.pfi_std >= 0 for r in pfi)


def test_gbt_early_stopping_uses_validation_rows(spark):
    from propensity.operators import features as fe
    from propensity.operators import models as md
    from propensity.session import materialize
    from propensity.sources import campaign as cf
    frame = materialize(cf.labelled_and_test(spark, SMALL))
    train, val = frame.filter(F.col("split") == "train"), frame.filter(F.col("split") == "val")
    pre = fe.fit_preprocessor(train)
    fitted = md.fit_model("gbt_depthwise", pre, train, {"n_estimators": 30}, early_stop=val, validation_tol=0.05)
    assert 1 <= len(fitted.boosted.trees) <= 30


def _frame(spark):
    from propensity.operators import features as fe
    from propensity.session import materialize
    from propensity.sources import campaign as cf
    frame = materialize(cf.labelled_and_test(spark, SMALL))
    return frame, fe.fit_preprocessor(frame.filter(F.col("split") == "train"))


def test_stop_waits_for_patience():
    from propensity.operators import models as md
    assert md.best_round([1.0, 0.9, 0.95, 0.8, 0.85, 0.9], 3) == (4, False)
    assert md.best_round([1.0, 0.9, 0.95, 0.96, 0.8], 2) == (2, True)
    assert md.best_round([1.0 - 1e-6 * i for i in range(500)], 50) == (500, False)
    assert md.best_round([1.0, 0.99, 0.985, 0.98], 2, tol=0.05) == (1, True)


def test_low_rate_fit_keeps_many_trees(spark):
    """The kept trees are those up to the best validation round; the last round's loss is the saved model's."""
    from propensity.operators import models as md
    frame, pre = _frame(spark)
    train, val = frame.filter(F.col("split") == "train"), frame.filter(F.col("split") == "val")
    fitted = md.fit_model("gbt_leafwise", pre, train, {"n_estimators": 60, "learning_rate": 0.003, "num_leaves": 4}, early_stop=val)
    kept = len(fitted.boosted.trees)
    assert kept > 20
    history = md.staged_history(fitted, pre, frame.filter(F.col("split") != "test")).collect()
    loss = {r["iteration"]: r["value"] for r in history if r["split"] == "val" and r["metric"] == "logloss"}
    assert sorted(loss) == list(range(1, kept + 1)) and min(loss.values()) == loss[kept]
    p = F.least(F.greatest(F.col("proba"), F.lit(1e-15)), F.lit(1 - 1e-15))
    last = fitted.score(pre, val).agg(F.avg(-F.when(F.col("target") == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]
    assert loss[kept] == pytest.approx(last, abs=1e-5)


def test_histories_come_from_trained_models(spark):
    """H2, H3, E13 on models fitted on the frame: every round measured, the kept model ends at its best round."""
    from propensity.operators import models as md
    from propensity.operators import runs as rn
    q = E.queries()
    history = q["trained_history"](spark, SMALL)
    rows = history.collect()
    assert {r["model"] for r in rows} == set(md.STAGED)
    best = {(r["model"], r["metric"]): r for r in rn.best_iteration(history).collect()}
    gaps = {r["model"]: r for r in rn.loss_curve_gap(history).collect()}
    for name in [m for m in md.STAGED if m.startswith("gbt")]:
        loss = {(r["split"], r["iteration"]): r["value"] for r in rows if r["model"] == name and r["metric"] == "logloss"}
        n = max(i for _, i in loss)
        assert len(loss) == 2 * n and n > 1
        stops_on = "logloss" if name == "gbt_leafwise" else "roc_auc"
        last = {(r["split"], r["metric"]): r["value"] for r in rows if r["model"] == name and r["iteration"] == n}
        assert best[name, stops_on]["best_value"] == last["val", stops_on] and loss["val", n] == gaps[name]["val_final"]
        assert gaps[name]["train_final"] == loss["train", n] < loss["train", 1]
    curves = rn.all_curves(history)
    assert curves.count() == len(rows) and curves.filter("metric = 'accuracy' and value between 0 and 1").count() == len(rows) // 3
    assert all(n in q for n in ("trained_best_iteration", "trained_loss_curve_gap", "trained_all_curves"))


def test_importance_comes_from_the_runs(spark, monkeypatch):
    """G13, H4 read the importance tables that the run wrote, one per booster."""
    from propensity.operators import runs as rn
    from propensity.operators import search as se
    from propensity.plans import catalog
    monkeypatch.setattr(se, "SPACES", {"gbt_leafwise": {"n_estimators": ("int", 5, 5, 1)}, "gbt_depthwise": {"n_estimators": ("int", 4, 4, 1)}})
    table = catalog._run_importance(spark, SMALL, n_trials=1, use_pfi=False)
    rows = table.collect()
    runs = {r["run_id"] for r in rows}
    assert sorted(r.split("_", 2)[2] for r in runs) == ["gbt_depthwise_search", "gbt_leafwise_search"]
    for run in runs:
        assert sum(r["importance_pct"] for r in rows if r["run_id"] == run) == pytest.approx(100.0, abs=0.2)
    wide = rn.importance_across_runs(table)
    assert set(wide.columns) == {"feature", *runs} and wide.count() == len({r["feature"] for r in rows})
    assert {"trained_importance_across_runs", "trained_top_n_importance"} <= set(E.queries())


def test_whole_run_covers_every_trainer():
    from propensity.operators import models as md
    from propensity.plans.pipeline import RunConfig
    assert RunConfig().models == tuple(md.TRAINERS)


def test_network_stops_on_validation_and_has_a_history(spark):
    from propensity.operators import models as md
    frame, pre = _frame(spark)
    train, val = frame.filter(F.col("split") == "train"), frame.filter(F.col("split") == "val")
    fitted = md.fit_model("mlp", pre, train, {"hidden_size": 8, "max_iter": 40}, early_stop=val)
    history = md.staged_history(fitted, pre, frame.filter(F.col("split") != "test")).collect()
    loss = {r["iteration"]: r["value"] for r in history if r["split"] == "val" and r["metric"] == "logloss"}
    assert sorted(loss) == [n for n, _ in fitted.steps] and len(loss) > 1 and max(loss) <= 40
    p = F.least(F.greatest(F.col("proba"), F.lit(1e-15)), F.lit(1 - 1e-15))
    own = fitted.score(pre, val).agg(F.avg(-F.when(F.col("target") == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]
    assert own == pytest.approx(min(loss.values()), abs=1e-5)
    best = min(loss, key=lambda n: (loss[n], n))
    assert max(loss) == 40 or max(loss) - best == md.MLP_PATIENCE


def test_fourier_features_equal_the_formula(spark):
    """Computed in Arrow batches, not in a lambda per entry; a missing value gives NaN throughout its row."""
    import math
    import numpy as np
    from pyspark.ml.functions import vector_to_array
    from propensity.operators import models as md
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1300, 4))
    w, b = md.fourier_weights(4, 7, "matern", 2.0)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double, d double")
    out = md.fourier_features(df, ["a", "b", "c", "d"], w, b)
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
    got = np.array([r[0] for r in out.orderBy("id").select(vector_to_array("features")).collect()])
    assert np.allclose(got, math.sqrt(2 / 7) * np.cos(x @ w.T + b), atol=1e-12)
    assert np.array_equal(md.fourier_values(x[:1], w, b)[0], md.fourier_values(x, w, b)[0])
    assert np.isnan(md.fourier_values(np.array([[1.0, np.nan, 0.0, 0.0]]), w, b)).all()


def test_training_tasks_grow_with_the_features(spark, monkeypatch):
    from propensity.operators import models as md
    assert md.feature_count("svc_poly", {"degree": 2}, 19) == 209 and md.feature_count("svc_linear", {}, 19) == 19
    df = spark.range(1000).coalesce(2).withColumn("x", F.lit(1.0))
    assert md.spread(df, 1000, 209).rdd.getNumPartitions() == 2  # small: as it is
    monkeypatch.setattr(md, "TASK_BYTES", 100_000)
    dealt = md.spread(df, 1000, 209)
    assert dealt.rdd.getNumPartitions() == 17 and dealt.count() == 1000


def test_boosters_share_their_passes_and_keep_their_trees(spark, monkeypatch):
    """Fitted side by side, on rows binned once, both boosters are what they are alone."""
    import pickle
    from propensity.operators import models as md
    frame, pre = _frame(spark)
    train, val = frame.filter(F.col("split") == "train"), frame.filter(F.col("split") == "val")
    names = [n for n in md.STAGED if n.startswith("gbt")]
    monkeypatch.setattr(md, "DEFAULT_PARAMS", md.DEFAULT_PARAMS | {n: {**md.DEFAULT_PARAMS[n], "n_estimators": 3} for n in names})
    both = md.fit_boosters(names, pre, train, val)
    assert list(both) == names
    alone = md.fit_model(names[0], pre, train, early_stop=val)
    assert both[names[0]].boosted.history == alone.boosted.history and both[names[0]].params == alone.params
    assert pickle.dumps(both[names[0]].boosted.trees) == pickle.dumps(alone.boosted.trees)


def test_history_of_a_network_reads_its_rows_once(spark):
    """The plan has as many reads however many steps there are."""
    from dataclasses import replace
    from propensity.operators import models as md
    frame, pre = _frame(spark)
    train, val = frame.filter(F.col("split") == "train"), frame.filter(F.col("split") == "val")
    fitted = md.fit_model("mlp", pre, train, {"hidden_size": 4, "max_iter": 15}, early_stop=val)
    reads = []
    for steps in (fitted.steps[:1], fitted.steps):
        plan = md.staged_history(replace(fitted, steps=steps), pre, val)._jdf.queryExecution().analyzed().toString()
        reads.append(plan.count("Relation ") + plan.count("LogicalRDD"))
    assert len(fitted.steps) > 1 and reads[0] == reads[1] > 0
