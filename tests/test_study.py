"""Samplers and study tables."""
import uuid

import numpy as np
import pytest

from propensity.operators import search as se
from propensity.operators import study
from propensity.session import shared_path

SPACE = {"x": ("float", 1e-3, 10.0, True), "y": ("float", -5.0, 5.0, False), "n": ("int", 10, 200, 10), "kind": ("choice", ["a", "b", "c"]),
         "degree": ("int", 2, 5, 1, {"kind": "b"}), "scale": ("float", 0.1, 1.0, False, {"kind": "c"})}


def worth(p):
    return float(-(np.log(p["x"]) - 1) ** 2 - (p["y"] - 2) ** 2 - abs(p["n"] - 150) / 50 + (2.0 if p["kind"] == "b" else 0.0) - abs(p.get("degree", 5) - 3))


def run(sampler, n=60, batch=10, done=()):
    done = list(done)
    while len(done) < n:
        first = len(done) - len(done) % batch
        for i, p in enumerate(sampler.draw(done[:first], first, batch)[len(done) - first:]):
            done.append(study.Trial(len(done), p, worth(p), 0.0, 0.0))
    return done


def test_draws_are_in_their_ranges_and_conditions_hold():
    for t in run(study.Parzen(SPACE, 1)) + run(study.Independent(SPACE, 1)):
        p = t.params
        assert 1e-3 <= p["x"] <= 10 and -5 <= p["y"] <= 5 and p["n"] in range(10, 201, 10) and isinstance(p["n"], int)
        assert ("degree" in p) == (p["kind"] == "b") and ("scale" in p) == (p["kind"] == "c")


def test_parzen_beats_independent_draws():
    best = [np.mean([max(t.value for t in run(cls(SPACE, s))) for s in range(8)]) for cls in (study.Parzen, study.Independent)]
    assert best[0] > best[1] + 0.3


def test_a_resumed_study_equals_an_uninterrupted_one():
    whole = run(study.Parzen(SPACE, 3))
    for cut in (4, 10, 37):
        assert run(study.Parzen(SPACE, 3), done=whole[:cut]) == whole


def test_pending_trials_spread():
    done = run(study.Parzen(SPACE, 5), n=30)
    drawn = study.Parzen(SPACE, 5).draw(done, 30, 10)
    assert len({round(p["y"], 6) for p in drawn}) == 10


def test_search_goes_on_from_its_table(spark, monkeypatch):
    monkeypatch.setitem(se.SPACES, "svc_linear", SPACE)
    monkeypatch.setattr(se, "evaluate_trial", lambda name, pre, train, val, params, columns=None: (worth(params), {}))
    path, other = (shared_path(spark, "study", uuid.uuid4().hex) for _ in range(2))
    frame = spark.range(1)
    se.search("svc_linear", None, frame, frame, 12, path=path)
    best, trials = se.search("svc_linear", None, frame, frame, 25, path=path)
    want, plain = se.search("svc_linear", None, frame, frame, 25, path=other)
    assert best == want and study.read(spark, path).count() == 25
    key = lambda df: [(r["number"], r["value"], r["params"]) for r in df.orderBy("number").collect()]
    assert key(trials) == key(plain)


def test_a_failed_trial_is_recorded(spark, monkeypatch):
    monkeypatch.setitem(se.SPACES, "svc_linear", SPACE)

    def sometimes(name, pre, train, val, params, columns=None):
        if params["kind"] == "a":
            raise RuntimeError("no")
        return worth(params), {}

    monkeypatch.setattr(se, "evaluate_trial", sometimes)
    _, trials = se.search("svc_linear", None, spark.range(1), spark.range(1), 20)
    states = {r["state"]: r["n"] for r in trials.groupBy("state").agg({"number": "count"}).withColumnRenamed("count(number)", "n").collect()}
    assert states["COMPLETE"] + states.get("FAIL", 0) == 20
    assert trials.filter("state = 'FAIL' and value is not null").count() == 0


def test_one_choice_and_narrow_range():
    space = {"k": ("choice", ["only"]), "n": ("int", 5, 5, 1)}
    assert all(t == {"k": "only", "n": 5} for t in study.Parzen(space, 0).draw([study.Trial(i, {"k": "only", "n": 5}, 1.0, 0, 0) for i in range(12)], 12, 3))


def test_folds_run_side_by_side_and_keep_their_order(spark, monkeypatch):
    """two folds are fitted at once; a fit that waits for another one ends."""
    from threading import Barrier
    from types import SimpleNamespace
    both, rows = Barrier(2), spark.range(48).selectExpr("id", "cast(id % 4 = 0 as int) AS target", "'train' AS split")

    def fit(name, pre, train, params, early_stop):
        both.wait(60)
        held = sorted(r["id"] for r in early_stop.collect())
        assert len(held) == 12 and train.filter(train["id"].isin(held)).isEmpty()
        return SimpleNamespace(score=lambda pre, df: min(held))

    monkeypatch.setattr(se.md, "fit_model", fit)
    monkeypatch.setattr(se, "auc_by_split", lambda smallest: {"val": 0.5 + smallest / 100, "train": 0.9})
    value, per = se.cv_objective("svc_linear", None, rows, {}, k=4)
    assert [p["fold"] for p in per] == [0, 1, 2, 3] and len({p["val_auc"] for p in per}) == 4
    mean = sum(p["val_auc"] for p in per) / 4
    assert value == pytest.approx(mean - 0.5 * (0.9 - mean))
