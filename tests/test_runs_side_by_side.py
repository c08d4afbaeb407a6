"""Whole runs: models side by side, what the trials of a search share."""
import uuid
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from propensity.operators import features as fe
from propensity.operators import models as md
from propensity.operators import search as se
from propensity.plans import pipeline as pl
from propensity.session import shared_path


@pytest.fixture(scope="module")
def frame(spark):
    """Campaign columns of 400 made-up orders; the target follows from two of them."""
    df = spark.range(400).select(
        "id", F.element_at(F.array(*map(F.lit, "ABC")), (F.col("id") % 3 + 1).cast("int")).alias("segment"),
        F.element_at(F.array(*map(F.lit, "XY")), (F.col("id") % 2 + 1).cast("int")).alias("region"),
        F.element_at(F.array(F.lit("1-URGENT"), F.lit("2-HIGH"), F.lit("4-NOT SPECIFIED")), (F.col("id") % 3 + 1).cast("int")).alias("priority"),
        *[((F.col("id") * k) % 97).cast("double").alias(c) for k, c in enumerate(("total_price", "acct_bal", "n_lines", "qty", "disc", "gross", "net", "previous"), 5)],
        (F.col("id") % 11 - 1).cast("int").alias("days_since"))
    return df.withColumn("target", (F.col("total_price") + F.col("qty") > 100).cast("int")).withColumn(
        "split", F.when(F.col("id") % 5 == 0, "val").otherwise("train"))


def test_scaled_rows_of_a_search_are_written_once(spark, frame, monkeypatch):
    """every trial used to derive its rows from the campaign columns again."""
    train, val = frame.filter("split = 'train'"), frame.filter("split = 'val'")
    pre, written, own = fe.fit_preprocessor(train), [], md.materialize
    params = {"kernel": "rbf", "length_scale": 2.0, "reg": 0.01}
    monkeypatch.setitem(md.DEFAULT_PARAMS, "rff_logistic", {**params, "n_features": 20, "max_iter": 5})
    want = se.evaluate_trial("rff_logistic", pre, train, val, params)
    monkeypatch.setattr(md, "materialize", lambda df: (written.append(df.columns), own(df))[1])
    _, trials = se.search("rff_logistic", pre, train, val, 3, parallelism=3)
    assert trials.filter("state = 'COMPLETE'").count() == 3 and len(written) == 2
    got = se.evaluate_trial("rff_logistic", md.ScaledRows(pre, train, val, None), train, val, params)
    assert got[0] == pytest.approx(want[0], abs=1e-6) and got[1] == pytest.approx(want[1], abs=1e-6)


def test_two_models_of_a_run_are_trained_side_by_side(spark, frame, monkeypatch):
    """a model that waits for another one ends; a failed one is logged, ids are in the models' order."""
    both = Barrier(2)

    def search(name, pre, train, val, n_trials, parallelism, columns, batch, path):
        both.wait(60)
        if name == "svc_linear":
            raise RuntimeError("no")
        params = {"n_estimators": 3}
        return params, spark.createDataFrame([(0, 0.5, None, None, 0.0, {"n": "3"}, "COMPLETE")], se.TRIALS)

    monkeypatch.setattr(pl.cf, "labelled_and_test", lambda spark, sf: frame)
    monkeypatch.setattr(pl.se, "search", search)
    out = shared_path(spark, "side", uuid.uuid4().hex)
    names = ("gbt_leafwise", "svc_linear", "gbt_depthwise", "svc_linear")
    found = pl.run_pipeline(spark, "", pl.RunConfig(models=names[:2], use_pfi=False, out_dir=out))
    assert {(r["run_name"], r["status"]) for r in found["runs"].collect()} == {("gbt_leafwise", "FINISHED"), ("svc_linear", "FAILED")}
    out = shared_path(spark, "side", uuid.uuid4().hex)
    found = pl.run_pipeline(spark, "", pl.RunConfig(models=("gbt_leafwise", "gbt_depthwise"), use_pfi=False, out_dir=out))
    assert [r["run_name"] for r in found["runs"].orderBy("run_id").collect()] == ["gbt_leafwise", "gbt_depthwise"]
    assert spark.read.parquet(f"{out}/importance").select("run_id").distinct().count() == 2
    assert {r["model"] for r in found["scores"].select("model").distinct().collect()} == {"gbt_leafwise", "gbt_depthwise"}
    assert found["evaluation"].count() == 2 * found["evaluation"].filter("model = 'gbt_leafwise'").count()


def test_boosters_are_fitted_beside_the_other_trainers(spark, frame, monkeypatch):
    """the boosters' fits and the first of the others wait for each other; every trainer is fitted once."""
    from propensity.plans import catalog as cat
    both, fitted = Barrier(2), []

    def boosters(names, pre, train, val):
        both.wait(60)
        assert train.count() == 320 and val.count() == 80
        return {n: f"fit of {n}" for n in names}

    def other(name, frame, pre):
        if not fitted:
            both.wait(60)
        fitted.append(name)
        return f"fit of {name}"

    monkeypatch.setattr(md, "fit_boosters", boosters)
    monkeypatch.setattr(cat, "_fit", other)
    found = cat._fit_all(md.TRAINERS, frame, None)
    assert found == {n: f"fit of {n}" for n in md.TRAINERS} and fitted == [n for n in md.TRAINERS if not n.startswith("gbt")]
