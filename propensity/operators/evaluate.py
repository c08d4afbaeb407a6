"""Evaluation and run comparison (G1–G9) over the long scores table.

Every function takes the scores table ``(model, split, id, target, proba)`` (plus small per-model tables)
and measures all models and splits in the same jobs; nothing loops over models on the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions.exprs import rnd
from propensity.functions.sizing import small_table
from propensity.operators.metrics import (
    DEFAULT_TOLERANCE,
    EVAL_COLUMNS,
    MAX_THRESHOLDS,
    best_threshold,
    labelled_rows,
    perf_rows,
    test_rows,
    threshold_sweep,
)

LABELLED_METRICS = ["roc_auc", "gini", "ks_statistic", "pr_auc", "accuracy", "precision", "recall", "f1"]
COUNT_COLUMNS = ["n_samples", "n_positive", "positive_rate"]
OVERFIT_GAP = 0.02


def chosen_thresholds(scores: DataFrame, split: str = "val", secondary: str = "accuracy",
                      tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """Best threshold per model on one labelled split: ``(model, threshold, youden_index, best_youden)``."""
    rows = labelled_rows(scores.filter(F.col("split") == split), ["model"])
    best = best_threshold(threshold_sweep(rows, ["model"]), ["model"], secondary, tolerance)
    return best.select("model", "threshold", "youden_index", "best_youden", "n_candidates")


def evaluate_all(scores: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """Models × splits table (G1, G2): labelled splits get every metric, the test split counts only."""
    thr = thresholds if thresholds is not None else chosen_thresholds(scores)
    thr = small_table(thr.select("model", "threshold"), MAX_THRESHOLDS)  # once for all splits
    labelled = scores.filter(F.col("split") != "test")
    return perf_rows(labelled, thr).unionByName(test_rows(scores, thr)).select(*EVAL_COLUMNS)


def long_to_wide(evaluation: DataFrame, include_calibration: bool = False) -> DataFrame:
    """One row per model (G4): ``model, threshold``, then val_*, train_*, test_* in that order.
    Brier and ECE are left out unless ``include_calibration``."""
    labelled = LABELLED_METRICS + (["brier_score", "ece"] if include_calibration else [])
    per_split = {"val": labelled + COUNT_COLUMNS, "train": labelled + COUNT_COLUMNS, "test": COUNT_COLUMNS}
    aggs = [F.first(F.when(F.col("split") == s, F.col(m)), ignorenulls=True).alias(f"{s}_{m}")
            for s, ms in per_split.items() for m in ms]
    return evaluation.groupBy("model").agg(
        F.first(F.when(F.col("split") == "val", F.col("threshold")), ignorenulls=True).alias("threshold"), *aggs)


def run_metrics(evaluation: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Flat per-model metrics (G3): val/train pairs, threshold, Youden and the AUC overfit gap."""
    pairs = [("auc", "roc_auc"), ("accuracy", "accuracy"), ("precision", "precision"), ("recall", "recall"),
             ("ks", "ks_statistic"), ("gini", "gini"), ("brier", "brier_score"), ("ece", "ece")]
    cols = []
    for short, src in pairs:
        for s in ("val", "train"):
            cols.append(F.first(F.when(F.col("split") == s, F.col(src)), ignorenulls=True).alias(f"{s}_{short}"))
    flat = evaluation.groupBy("model").agg(*cols)
    thr = thresholds.select("model", rnd("threshold").alias("threshold"), rnd("youden_index").alias("youden_index"),
                            rnd("best_youden").alias("best_youden"))
    return flat.join(thr, "model").withColumn("overfit_gap_auc", rnd(F.col("train_auc") - F.col("val_auc")))


def overfit_summary(evaluation: DataFrame, gap: float = OVERFIT_GAP) -> DataFrame:
    """Per-model val/train AUC with the overfit flag (G8): train - val AUC above ``gap``."""
    wide = long_to_wide(evaluation)
    diff = rnd(F.col("train_roc_auc") - F.col("val_roc_auc"))
    return wide.select("model", "threshold", "val_roc_auc", "train_roc_auc", "val_accuracy", "train_accuracy",
                       diff.alias("auc_gap"), (diff > F.lit(gap)).alias("overfit"))


def best_model(evaluation: DataFrame) -> DataFrame:
    """The model with the highest validation AUC (ties: lowest model name), with its accuracy.
    A global ``min_by`` aggregate: partial results per task, one row out."""
    val = evaluation.filter(F.col("split") == "val")
    key = F.struct(F.coalesce(-F.col("roc_auc"), F.lit(float("inf"))), F.col("model"))
    picked = val.agg(F.min_by(F.struct("model", "threshold", "roc_auc", "accuracy"), key).alias("b"))
    return picked.select("b.model", "b.threshold", "b.roc_auc", "b.accuracy")


def best_submission(scores: DataFrame, evaluation: DataFrame, split: str = "test") -> DataFrame:
    """Decisions of the best model (G9, A8): ``(id, target)`` with target = ``proba >= threshold``."""
    best = best_model(evaluation).select("model", "threshold")  # one row
    rows = scores.filter(F.col("split") == split).join(F.broadcast(best), "model")
    return rows.select("id", (F.col("proba") >= F.col("threshold")).cast("int").alias("target"))


def report_interleaved(evaluation: DataFrame) -> DataFrame:
    """Run report table (G7): per model, val and train of each metric side by side."""
    wide = long_to_wide(evaluation)
    cols = ["model", "threshold"]
    for m in LABELLED_METRICS:
        cols += [f"val_{m}", f"train_{m}"]
    return wide.select(*cols)
