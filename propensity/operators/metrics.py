"""Metrics and thresholds (F1–F15) for many models at once.

Ranking metrics start from the score histogram, one row per (group, distinct score) with its positive and
negative counts (partial aggregation runs map-side, so a score shared by a third of the rows costs nothing
extra), and need running sums in score order; those come from ``cumulative_within``, which never puts a whole
group into one task. Threshold and calibration metrics don't need distinct scores: given the narrow
``labelled_rows`` they aggregate on 82 threshold steps, 10 bins or 4 cells per group before the shuffle, so
continuous scores move no more rows than coarse ones. Both inputs have the same columns.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.functions.exprs import (
    CALIBRATION_BINS,
    THRESHOLD_K_MAX,
    THRESHOLD_K_MIN,
    calibration_bin,
    rnd,
    safe_div,
    threshold_index,
)
from propensity.functions.order import cumulative_within, score_bucket
from propensity.functions.sizing import small_table

DEFAULT_TOLERANCE = 0.02
MAX_THRESHOLDS = 100_000  # one row per model (and run)
SWEEP_METRICS = ("accuracy", "precision", "recall", "specificity", "f1", "youden_index")


def score_histogram(scores: DataFrame, group_cols: Sequence[str], target: str = "target", proba: str = "proba") -> DataFrame:
    """``(group..., proba, pos, neg)`` over labelled rows."""
    return (
        scores.filter(F.col(target).isNotNull())
        .groupBy(*group_cols, F.col(proba).alias("proba"))
        .agg(F.sum(F.col(target)).cast("long").alias("pos"),
             F.sum(1 - F.col(target)).cast("long").alias("neg"))
    )


def labelled_rows(scores: DataFrame, group_cols: Sequence[str], target: str = "target", proba: str = "proba") -> DataFrame:
    """``(group..., proba, pos, neg)`` with one row per labelled row: a projection, no shuffle."""
    return scores.filter(F.col(target).isNotNull()).select(
        *group_cols, F.col(proba).alias("proba"), F.col(target).cast("long").alias("pos"), (1 - F.col(target)).cast("long").alias("neg"))


def group_totals(hist: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return hist.groupBy(*group_cols).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def roc_table(hist: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Histogram plus running counts in descending score order: ``ct`` positives and ``cf`` negatives
    with score >= this one, and the group totals ``n_pos``, ``n_neg``."""
    cum = cumulative_within(hist, group_cols, "proba", score_bucket(F.col("proba")),
                            {"ct": "pos", "cf": "neg"}, descending=True)
    return cum.join(group_totals(hist, group_cols), list(group_cols))


def ranking_metrics(hist: DataFrame, group_cols: Sequence[str], decimals: int | None = None) -> DataFrame:
    """ROC AUC (tie-aware), Gini, KS, average precision, Brier and ECE per group (unrounded unless
    ``decimals``). Single-class groups give NULL for the ranking metrics."""
    g = list(group_cols)
    roc = roc_table(hist, g)
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    ranked = roc.groupBy(*g).agg(
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
        F.sum(F.col("neg") * (F.col("ct") - F.col("pos") / 2.0)).alias("_auc_num"),
        F.max(F.try_divide(F.col("ct"), F.col("n_pos")) - F.try_divide(F.col("cf"), F.col("n_neg"))).alias("_ks"),
        F.sum(F.try_divide(F.col("pos"), F.col("n_pos")) * (F.col("ct") / (F.col("ct") + F.col("cf")))).alias("_ap"),
        F.sum(F.col("pos") * F.pow(F.col("proba") - 1.0, 2) + F.col("neg") * F.pow(F.col("proba"), 2)).alias("_sq"),
    )
    auc = F.when(both, F.col("_auc_num") / (F.col("n_pos") * F.col("n_neg")))
    out = ranked.select(
        *g,
        auc.alias("roc_auc"),
        (auc * 2.0 - 1.0).alias("gini"),
        F.when(both, F.greatest(F.col("_ks"), F.lit(0.0))).alias("ks_statistic"),
        F.when(F.col("n_pos") > 0, F.col("_ap")).alias("pr_auc"),
        (F.col("_sq") / (F.col("n_pos") + F.col("n_neg"))).alias("brier_score"),
    ).join(expected_calibration_error(hist, g), g)
    if decimals is not None:
        out = out.select(*g, *[rnd(c, decimals).alias(c) for c in out.columns if c not in g])
    return out


def calibration_table(hist: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Per (group, bin): count, mean score, fraction positive (reliability diagram data, F8). Every group has all
    bins; an empty one has count 0 and NULL means."""
    g = list(group_cols)
    n = F.col("pos") + F.col("neg")
    bins = (
        hist.withColumn("bin", calibration_bin(F.col("proba")))
        .groupBy(*g, "bin")
        .agg(F.sum(n).alias("n"), F.sum(F.col("proba") * n).alias("_sum_p"), F.sum("pos").alias("_sum_y"))
    )
    filled = bins.groupBy(*g).agg(F.collect_list(F.struct("bin", "n", "_sum_p", "_sum_y")).alias("_have"))  # ten at most
    every = F.transform(F.sequence(F.lit(0), F.lit(CALIBRATION_BINS - 1)), lambda b: F.struct(
        b.alias("bin"), F.get(F.filter("_have", lambda x: x["bin"] == b), F.lit(0)).alias("x")))
    return filled.select(*g, F.inline(every)).select(
        *g, "bin", F.coalesce("x.n", F.lit(0)).alias("n"),
        (F.col("x._sum_p") / F.col("x.n")).alias("mean_proba"), (F.col("x._sum_y") / F.col("x.n")).alias("frac_positive"))


def expected_calibration_error(hist: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """ECE (F7): bins weighted by their share of rows; empty bins weigh nothing."""
    g = list(group_cols)
    bins = calibration_table(hist, g)
    w = F.col("n") * F.abs(F.col("mean_proba") - F.col("frac_positive"))
    return bins.groupBy(*g).agg((F.sum(w) / F.sum("n")).alias("ece"))


def roc_points(hist: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """ROC curve points (F4): one point per distinct score plus the origin (threshold NULL)."""
    g = list(group_cols)
    roc = roc_table(hist, g)
    pts = roc.select(*g, F.col("proba").alias("threshold"),
                     safe_div(F.col("cf"), F.col("n_neg")).alias("fpr"),
                     safe_div(F.col("ct"), F.col("n_pos")).alias("tpr"))
    origin = hist.select(*g).distinct().select(*g, F.lit(None).cast("double").alias("threshold"),
                                               F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def _rates(tp: Column, fp: Column, fn: Column, tn: Column, decimals: int) -> dict[str, Column]:
    n = tp + fp + fn + tn
    sens = safe_div(tp, tp + fn)
    spec = safe_div(tn, tn + fp)
    return {
        "accuracy": rnd(safe_div(tp + tn, n), decimals),
        "precision": rnd(safe_div(tp, tp + fp), decimals),
        "recall": rnd(sens, decimals),
        "specificity": rnd(spec, decimals),
        "f1": rnd(safe_div(tp * 2, tp * 2 + fp + fn), decimals),
        "youden_index": rnd(sens + spec - 1.0, decimals),
        "n_predicted_positive": (tp + fp).cast("long"),
        "positive_rate": rnd(safe_div(tp + fp, n), decimals),
    }


def threshold_sweep(hist: DataFrame, group_cols: Sequence[str], decimals: int = 4) -> DataFrame:
    """All 81 thresholds 0.10 … 0.90 per group (F11): histogram per threshold step, then a reverse
    running sum over at most 82 steps per group."""
    g = list(group_cols)
    steps = (
        hist.withColumn("k", threshold_index(F.col("proba")))
        .groupBy(*g, "k").agg(F.sum("pos").alias("pos_k"), F.sum("neg").alias("neg_k"))
    )
    grid = group_totals(hist, g).select(
        *g, "n_pos", "n_neg", F.explode(F.sequence(F.lit(THRESHOLD_K_MIN), F.lit(THRESHOLD_K_MAX))).alias("k")
    )
    above = Window.partitionBy(*g).orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    joined = grid.join(steps.filter(F.col("k") >= THRESHOLD_K_MIN), [*g, "k"], "left").fillna(0, ["pos_k", "neg_k"])
    cum = joined.withColumns({"tp": F.sum("pos_k").over(above), "fp": F.sum("neg_k").over(above)})
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("n_pos") - tp, F.col("n_neg") - fp
    return cum.select(
        *g, (F.col("k").cast("double") / F.lit(100.0)).alias("threshold"),
        *[c.alias(name) for name, c in _rates(tp, fp, fn, tn, decimals).items()],
    )


def best_threshold(sweep: DataFrame, group_cols: Sequence[str], secondary: str = "accuracy",
                   tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """Youden band selection (F12): keep thresholds whose (rounded) Youden is within ``tolerance`` of the
    group maximum, take the best ``secondary`` metric, lowest threshold on ties."""
    if secondary not in sweep.columns:
        raise ValueError(f"unknown metric {secondary!r}; choose one of {[c for c in SWEEP_METRICS]}")
    g = list(group_cols)
    per = Window.partitionBy(*g)
    band = (
        sweep.withColumn("best_youden", F.max("youden_index").over(per))
        .filter(F.col("youden_index") >= F.col("best_youden") - F.lit(tolerance))
        .withColumn("n_candidates", F.count(F.lit(1)).over(per))
    )
    pick = Window.partitionBy(*g).orderBy(F.col(secondary).desc(), F.col("threshold").asc())
    return (
        band.withColumn("_r", F.row_number().over(pick)).filter("_r = 1")
        .select(*g, "threshold", "youden_index", secondary, "best_youden", F.col("n_candidates").cast("long"))
    )


def threshold_band(sweep: DataFrame, group_cols: Sequence[str], secondary: str = "accuracy",
                   tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """Threshold selection series (H6): the sweep with the band flag and the chosen point."""
    g = list(group_cols)
    best = best_threshold(sweep, g, secondary, tolerance).select(*g, F.col("threshold").alias("_chosen"), "best_youden")
    return (
        sweep.join(best, g)
        .withColumn("in_band", F.col("youden_index") >= F.col("best_youden") - F.lit(tolerance))
        .withColumn("chosen", F.col("threshold") == F.col("_chosen"))
        .drop("_chosen")
    )


def confusion_at(hist: DataFrame, thresholds: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    """tn, fp, fn, tp per group at a threshold per ``key_cols`` (F9), from the histogram."""
    g = list(group_cols)
    decided = hist.join(small_table(thresholds, MAX_THRESHOLDS), list(key_cols)).withColumn("_yes", F.col("proba") >= F.col("threshold"))
    return decided.groupBy(*g, "threshold").agg(
        F.sum(F.when(~F.col("_yes"), F.col("neg")).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(F.col("_yes"), F.col("neg")).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(~F.col("_yes"), F.col("pos")).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when(F.col("_yes"), F.col("pos")).otherwise(0)).cast("long").alias("tp"),
    )


EVAL_COLUMNS = [
    "model", "threshold", "split", "roc_auc", "gini", "ks_statistic", "pr_auc", "brier_score", "ece",
    "accuracy", "precision", "recall", "f1", "n_samples", "n_positive", "positive_rate",
]


def perf_rows(scores: DataFrame, thresholds: DataFrame, decimals: int = 4, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Labelled splits (F13): ranking metrics plus decision metrics at each model's threshold.
    ``n_positive`` counts predicted positives, as in the reference. ``keys`` identify a model (and run)."""
    k = list(keys)
    g = [*k, "split"]
    hist = score_histogram(scores, g)
    conf = confusion_at(labelled_rows(scores, g), thresholds, g, k)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = _rates(tp, fp, fn, tn, decimals)
    dec = conf.select(*g, rnd("threshold", decimals).alias("threshold"),
                      *[rates[m].alias(m) for m in ("accuracy", "precision", "recall", "f1", "positive_rate")],
                      (tp + fp + fn + tn).cast("long").alias("n_samples"), (tp + fp).cast("long").alias("n_positive"))
    rank = ranking_metrics(hist, g)
    out = dec.join(rank, g).select(
        *k, "threshold", "split",
        rnd("roc_auc", decimals).alias("roc_auc"), rnd("gini", decimals).alias("gini"),
        rnd("ks_statistic", decimals).alias("ks_statistic"), rnd("pr_auc", decimals).alias("pr_auc"),
        rnd("brier_score", decimals).alias("brier_score"), rnd("ece", decimals).alias("ece"),
        "accuracy", "precision", "recall", "f1", "n_samples", "n_positive", "positive_rate",
    )
    return out.select(*[c for c in k if c != "model"], *EVAL_COLUMNS)


def test_rows(scores: DataFrame, thresholds: DataFrame, split: str = "test", decimals: int = 4,
              keys: Sequence[str] = ("model",)) -> DataFrame:
    """Unlabelled split (F14): counts only; every label-based metric is NULL."""
    k = list(keys)
    rows = scores.filter(F.col("split") == split).join(small_table(thresholds, MAX_THRESHOLDS), k)
    agg = rows.groupBy(*k, "threshold").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum(F.when(F.col("proba") >= F.col("threshold"), 1).otherwise(0)).cast("long").alias("n_positive"),
    )
    nulls = {c: F.lit(None).cast("double") for c in EVAL_COLUMNS[3:13]}
    return agg.select(
        *k, rnd("threshold", decimals).alias("threshold"), F.lit(split).alias("split"),
        *[v.alias(c) for c, v in nulls.items()],
        "n_samples", "n_positive", rnd(safe_div(F.col("n_positive"), F.col("n_samples")), decimals).alias("positive_rate"),
    ).select(*[c for c in k if c != "model"], *EVAL_COLUMNS)


def decide(scores: DataFrame, thresholds: DataFrame, proba: str = "proba") -> DataFrame:
    """Decision at threshold (F15): ``proba >= t`` as 0/1, per row; a narrow projection."""
    return scores.join(small_table(thresholds, MAX_THRESHOLDS), "model").withColumn("decision", (F.col(proba) >= F.col("threshold")).cast("int"))
