"""NULL and NaN in every role: no row, level or column may vanish or change meaning."""
import math

import pytest
from pyspark.sql import functions as F

from propensity.functions.quantiles import exact_quantiles
from propensity.operators import features as fe
from propensity.operators import metrics as mx
from propensity.operators import models as md
from propensity.operators import profile as pf
from propensity.operators import runs as rn
from propensity.operators import search as se
from propensity.operators import select as sl
from propensity.session import ensure_checkpoint_dir
from propensity.sources import campaign as cf
from propensity.sources.tables import normalise

NAN = float("nan")


def test_null_nominal_is_all_zeros(spark):
    levels = {"c": ["a", "b", "d"]}
    df = spark.createDataFrame([("a",), ("b",), (None,), ("new",)], "c string")
    rows = df.select(*[e.alias(n) for n, e in fe.one_hot_exprs(levels).items()]).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_colliding_levels_keep_their_own_dummies():
    levels = {"c": ["A", "B C", "B_C", "B-C"]}
    names = list(fe.one_hot_exprs(levels))
    assert len(names) == len(set(names)) == 3
    assert fe.expand_to_columns(["c"], levels) == names
    assert fe.columns_to_originals(names, levels) == ["c"]


def test_many_levels_are_no_error(spark):
    df = spark.createDataFrame([(f"v{i:04d}",) for i in range(1500)], "c string")
    assert len(fe.fit_levels(df, ["c"])["c"]) == 1500


def test_null_classes_stay_in_split_and_folds(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(100)], "id long, target int")
    split = cf.stratified_split(df)
    assert split.count() == 100 and split.filter("target is null and split = 'val'").count() == 4
    folds = fe.stratified_kfold(df, 5)
    assert folds.count() == 100
    assert {r["count"] for r in folds.filter("target is null").groupBy("fold").count().collect()} == {4}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, NAN), (3, 3.0), (4, None)], "id long, x double")
    assert normalise(df).filter("x is null").count() == 2
    assert exact_quantiles(df, ["x"], [0.5], ["m"]).first()["m"] == 2.0
    row = pf.profile_numeric(df, ["x"]).first()
    assert (row["n_missing"], row["mean"], row["median"]) == (2, 2.0, 2.0)
    ranks = {r["value"]: r["avg_rank"] for r in sl.value_ranks(df, ["x"]).collect()}
    assert ranks == {1.0: 1.0, 3.0: 2.0}


def test_wide_nominal_column_trains(spark):
    """More levels than the default bins of a tree."""
    rows = [(i, "train" if i % 4 else "val", i % 2, f"n{i % 150}", "r", None if i % 7 == 0 else "2-HIGH", float(i % 11), 1.0, 2, 3.0, 0.1, 4.0, None if i % 9 == 0 else 5.0, 1,
             -1 if i % 3 == 0 else i % 30) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, split string, target int, segment string, region string, priority string, total_price double, acct_bal double, "
                                     "n_lines long, qty double, disc double, gross double, net double, previous int, days_since int")
    pre = fe.fit_preprocessor(df.filter("split = 'train'"))
    for columns in (None, ["qty", "total_price", *[c for c in pre.numeric_columns if c.startswith("segment_")][:2]]):
        fitted = md.fit_model("gbt_depthwise", pre, df.filter("split = 'train'"), {"n_estimators": 3, "max_depth": 3}, columns=columns)
        assert fitted.score(pre, df).filter("proba is null").count() == 0
        assert math.isclose(sum(v for _, v in md.feature_importance(fitted)), 100.0, abs_tol=0.2)
    assert "segment" in fitted.input_cols and "net" not in fitted.input_cols and len(fitted.boosted.bins.levels["segment"]) == 150


def test_continuous_scores(spark):
    """A million distinct scores, all under 1e-5: ranks stay exact and no score bucket takes all."""
    from propensity.functions.order import score_bucket
    n = 1_000_000
    df = spark.range(n).select(F.lit("m").alias("model"), F.lit("val").alias("split"), "id",
                               (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias("target"), (F.col("id") * 1e-11).alias("proba"))
    most = df.groupBy(score_bucket(F.col("proba"))).count().agg(F.max("count")).first()[0]
    assert most < 0.1 * n
    hist = mx.score_histogram(df, ["model"])
    got = mx.ranking_metrics(hist, ["model"]).first()
    pdf = df.select("target", "proba").toPandas()
    ranks = pdf["proba"].rank()
    pos = int(pdf["target"].sum())
    auc = (ranks[pdf["target"] == 1].sum() - pos * (pos + 1) / 2) / (pos * (n - pos))
    assert got["roc_auc"] == pytest.approx(auc, abs=1e-9)
    bins = mx.calibration_table(mx.labelled_rows(df, ["model"]), ["model"]).collect()
    assert len(bins) == 10 and sum(r["n"] for r in bins) == n


def test_score_buckets_are_monotone(spark):
    from propensity.functions.order import score_bucket
    values = [-1e9, -3.5, -1.0, -1e-9, 0.0, 1e-300, 1e-12, 3e-6, 1e-5, 0.2, 0.5, 0.99999, 1 - 1e-9, 1 - 1e-14, 1.0, 1 + 1e-9, 2.5, 1e7]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [tuple(r["b"]) for r in df.select("p", score_bucket(F.col("p")).alias("b")).orderBy("p").collect()]
    assert got == sorted(got)


def test_decisions_do_not_shuffle_by_model(spark):
    df = spark.createDataFrame([("m", "val", 1, 1, 0.7), ("k", "val", 2, 0, 0.2)], "model string, split string, id long, target int, proba double")
    plan = mx.decide(df, spark.createDataFrame([("m", 0.5), ("k", 0.1)], "model string, threshold double"))
    assert "Exchange hashpartitioning(model" not in plan._jdf.queryExecution().executedPlan().toString()


def test_constant_column_has_no_importance(spark):
    rows = [(i, "train" if i % 3 else "val", int(i % 10 > 4), float(i % 10), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, split string, target int, x double, k double")
    got = {r["feature"]: r for r in se.permutation_importance(df.filter("split = 'train'"), df.filter("split = 'val'"), ["x", "k"], n_estimators=3).collect()}
    assert got["k"]["pfi_mean"] == 0.0 and got["k"]["pfi_std"] == 0.0 and got["x"]["pfi_mean"] > 0.3


def test_unknown_variant_raises(spark):
    fitted = md.FittedModel("x", {}, None, [], "raw")
    with pytest.raises(ValueError, match="variant"):
        fitted.prepare(None, spark.range(1))


def test_all_trials_failing_raises(spark, monkeypatch):
    def broken(*a, **b):
        raise RuntimeError("no")
    monkeypatch.setattr(se, "evaluate_trial", broken)
    with pytest.raises(RuntimeError, match="all 2 trials"):
        se.random_search("svc_linear", None, spark.range(1), spark.range(1), 2)


def test_run_ids_sort_by_time():
    from datetime import datetime
    a, b = rn.run_id("zz", at=datetime(2026, 1, 2, 3, 4, 5)), rn.run_id("aa", at=datetime(2026, 1, 2, 3, 4, 6))
    assert a < b and a.startswith("20260102_030405_")


def test_cluster_without_shared_folder_raises(spark, monkeypatch):
    class Conf:
        def get(self, *a):
            return None

    class Defined:
        def isDefined(self):
            return False

    class Sc:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                return type("S", (), {"getCheckpointDir": lambda self: Defined()})()

        def getConf(self):
            return Conf()

    fake = type("Spark", (), {"sparkContext": Sc(), "conf": Conf()})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)
