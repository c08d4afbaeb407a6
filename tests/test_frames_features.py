"""Frames, split and feature engineering on the smallest tables."""
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from propensity.operators import features as fe
from propensity.sources import campaign as cf


@pytest.fixture(scope="module")
def framed(spark):
    from propensity.session import materialize
    frame = materialize(cf.labelled_and_test(spark, SMALL))
    pre = fe.fit_preprocessor(frame.filter(F.col("split") == "train"))
    return frame, pre


def test_split_disjoint_exhaustive_stratified(spark, framed):
    frame, _ = framed
    n_orders = spark.read.parquet(f"{SMALL}/orders.parquet").count()
    assert frame.count() == n_orders == frame.select("id").distinct().count()
    per = {(r.target, r.split): r["count"] for r in frame.filter(F.col("split") != "test").groupBy("target", "split").count().collect()}
    for t in (0, 1):
        n = per.get((t, "val"), 0) + per.get((t, "train"), 0)
        assert per.get((t, "val"), 0) == (n * 20 + 99) // 100


def test_split_independent_of_partitioning(spark):
    a = cf.labelled_and_test(spark, SMALL).select("id", "split")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        b = cf.labelled_and_test(spark, SMALL).select("id", F.col("split").alias("s2"))
        assert a.join(b, "id").filter(F.col("split") != F.col("s2")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_scaled_train_is_standardised(spark, framed):
    frame, pre = framed
    chk = fe.scale_check(pre.scaled(frame.filter(F.col("split") == "train")), pre.numeric_columns).first()
    assert chk.max_abs_mean < 1e-9 and chk.max_abs_std_dev < 1e-9


def test_one_hot_drops_first_level_and_unseen_are_zero(spark, framed):
    _, pre = framed
    assert "segment_AUTOMOBILE" not in pre.numeric_columns and "segment_BUILDING" in pre.numeric_columns
    new = spark.createDataFrame([(1, "NEWLEVEL", "ASIA", "2-HIGH", cf.SENTINEL_VALUE)], "id long, segment string, region string, priority string, days_since int")
    row = pre.numeric(new.select("id", "segment", "region", "priority", "days_since"), keep=["id"]).first()
    assert all(row[c] == 0.0 for c in pre.numeric_columns if c.startswith("segment_"))
    assert row["region_ASIA"] == 1.0 and row["priority"] == 1.0
    assert row["had_prior_order"] == 0 and row["days_since"] == pre.medians["days_since"]


def test_align_fills_missing_with_zero(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "id long, a double, b double")
    row = fe.align_columns(df, ["b", "c", "a"], keep=["id"]).first()
    assert row.asDict() == {"id": 1, "b": None, "c": 0.0, "a": 2.0}


def test_manifest_roundtrip(spark, framed, tmp_path):
    _, pre = framed
    pre.save(spark, str(tmp_path / "pre"))
    back = fe.Preprocessor.load(spark, str(tmp_path / "pre"))
    assert back.numeric_columns == pre.numeric_columns and back.levels == pre.levels
    assert back.medians == pre.medians and {k: tuple(v) for k, v in back.scaler.items()} == pre.scaler
    with pytest.raises(FileNotFoundError):
        spark.createDataFrame([("spec", "", 0, "{}")], "kind string, feature string, position int, value string") \
            .write.parquet(str(tmp_path / "broken"))
        fe.Preprocessor.load(spark, str(tmp_path / "broken"))


def test_subsample_bigger_than_table_keeps_all(spark, framed):
    frame, _ = framed
    train = frame.filter(F.col("split") == "train")
    assert fe.stratified_subsample(train, 10 ** 9).count() == train.count()
    small = fe.stratified_subsample(train, 50)
    assert small.count() == 50 and small.filter("target = 1").count() >= 1


def test_sweep_and_auc_identical_for_1_and_64_shuffle_partitions(spark):
    from propensity.operators import metrics as mx
    res = []
    for n in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            scores = cf.scores_table(spark, SMALL)
            hist = mx.score_histogram(scores, ["model", "split"])
            sweep = sorted(tuple(r) for r in mx.threshold_sweep(hist, ["model", "split"]).collect())
            auc = sorted(tuple(r) for r in mx.ranking_metrics(hist, ["model", "split"], 10).collect())
            res.append((sweep, auc))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1]
