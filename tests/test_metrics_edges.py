"""Hand-computed metric cases: ties, single class, exact threshold edges, zero denominators."""
import pytest
from pyspark.sql import functions as F

from propensity.operators import metrics as mx

TOY = [(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 1), (0.6, 0), (0.4, 0), (0.3, 1), (0.1, 0)]


def frame(spark, rows, model="m"):
    return spark.createDataFrame([(model, "val", i, t, float(p)) for i, (p, t) in enumerate(rows)],
                                 "model string, split string, id long, target int, proba double")


def rank(spark, rows):
    hist = mx.score_histogram(frame(spark, rows), ["model"])
    return mx.ranking_metrics(hist, ["model"]).first()


def test_toy_auc_ap_ks(spark):
    r = rank(spark, TOY)
    assert r.roc_auc == pytest.approx(0.6875)
    assert r.pr_auc == pytest.approx(0.767857, abs=1e-6)
    assert r.ks_statistic == pytest.approx(0.5)
    assert r.gini == pytest.approx(2 * 0.6875 - 1)


def test_auc_of_complement(spark):
    a = rank(spark, TOY).roc_auc
    b = rank(spark, [(1 - p, t) for p, t in TOY]).roc_auc
    assert a == pytest.approx(1 - b)


def test_all_tied(spark):
    r = rank(spark, [(0.5, t) for _, t in TOY])
    assert r.roc_auc == pytest.approx(0.5)
    assert r.ks_statistic == pytest.approx(0.0)


def test_single_class_is_null(spark):
    r = rank(spark, [(p, 1) for p, _ in TOY])
    assert r.roc_auc is None and r.ks_statistic is None
    assert r.brier_score == pytest.approx(sum((p - 1) ** 2 for p, _ in TOY) / len(TOY))


def test_threshold_edges_are_exact(spark):
    # 0.29 * 100 = 28.999999999999996: a floor-based bucket would miss the edge
    rows = [(0.29, 1), (0.2899999, 0), (0.10, 1), (0.0999999, 0), (0.9, 1), (1.0, 0)]
    sweep = mx.threshold_sweep(mx.score_histogram(frame(spark, rows), ["model"]), ["model"])
    got = {round(r.threshold, 2): r.n_predicted_positive for r in sweep.collect()}
    assert len(got) == 81
    for t, n in got.items():
        assert n == sum(1 for p, _ in rows if p >= t), t


def test_sweep_monotone_and_zero_division(spark):
    rows = [(0.05, 0), (0.06, 1), (0.07, 0)]  # nothing reaches 0.10: no predicted positives anywhere
    sweep = mx.threshold_sweep(mx.score_histogram(frame(spark, rows), ["model"]), ["model"]).orderBy("threshold").collect()
    assert all(r.n_predicted_positive == 0 and r.precision == 0.0 and r.f1 == 0.0 for r in sweep)
    toy = mx.threshold_sweep(mx.score_histogram(frame(spark, TOY), ["model"]), ["model"]).orderBy("threshold").collect()
    counts = [r.n_predicted_positive for r in toy]
    assert counts == sorted(counts, reverse=True)


def test_best_threshold_lowest_on_ties(spark):
    sweep = mx.threshold_sweep(mx.score_histogram(frame(spark, [(0.5, 1), (0.5, 0)]), ["model"]), ["model"])
    best = mx.best_threshold(sweep, ["model"]).first()
    assert best.threshold == pytest.approx(0.10)
    assert best.n_candidates == 81
    with pytest.raises(ValueError):
        mx.best_threshold(sweep, ["model"], secondary="nope")


def test_ece_skips_empty_bins(spark):
    rows = [(0.05, 0), (0.05, 1), (0.95, 1), (0.95, 1)]
    hist = mx.score_histogram(frame(spark, rows), ["model"])
    bins = {r.bin: r.n for r in mx.calibration_table(hist, ["model"]).collect()}
    assert bins == {0: 2, 9: 2} | {b: 0 for b in range(1, 9)}  # every bin is listed, empty ones weigh nothing
    ece = mx.expected_calibration_error(hist, ["model"]).first().ece
    assert ece == pytest.approx(0.5 * abs(0.05 - 0.5) + 0.5 * abs(0.95 - 1.0))


def test_calibration_bin_edges(spark):
    # the inner edges are i * 0.1 as doubles: 0.3 itself falls below 0.30000000000000004
    rows = [(0.3, 0), (0.30000000000000004, 1), (1.0, 1), (0.0, 0)]
    hist = mx.score_histogram(frame(spark, rows), ["model"])
    got = {round(r.mean_proba, 17): r.bin for r in mx.calibration_table(hist, ["model"]).collect() if r.n}
    assert got[0.3] == 2 and got[0.30000000000000004] == 3 and got[1.0] == 9 and got[0.0] == 0


def test_many_groups_one_job(spark):
    df = frame(spark, TOY, "a").unionByName(frame(spark, [(1 - p, t) for p, t in TOY], "b"))
    out = {r.model: r.roc_auc for r in mx.ranking_metrics(mx.score_histogram(df, ["model"]), ["model"]).collect()}
    assert out["a"] == pytest.approx(1 - out["b"])
