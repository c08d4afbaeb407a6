"""Run tracking and comparison (A4–A7, G5, G6, G10–G13) and the tables behind the charts (H1–H7).

A run is a row of the ``runs`` table ``(run_id, run_name, ts, params map, metrics map)``; its per-split
evaluation, scores, history and importances are tables keyed by ``run_id``. Comparisons across runs are
window and pivot queries over those tables, never loops over folders.
"""
from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.functions.exprs import rnd, safe_corr
from propensity.functions.sizing import broadcast_if_bounded, small_table
from propensity.operators import evaluate as ev
from propensity.operators import metrics as mx

MAX_RUNS_BROADCAST = 100_000
RUN_KEYS = ["run_id", "model"]


def run_id(model: str, tag: str = "search", at: datetime | None = None) -> str:
    """``<yyyymmdd_hhmmss>_<model>_<tag>``: sorts by time as a string."""
    return f"{at or datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{model}_{tag}"


def runs_descriptor(spark: SparkSession, runs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(run_id, model, threshold_split)`` for the runs to evaluate."""
    return spark.createDataFrame(list(runs), "run_id string, model string, threshold_split string")


def run_thresholds(scores: DataFrame, runs: DataFrame, secondary: str = "accuracy") -> DataFrame:
    """Best threshold of each run on the split the run tunes on."""
    rows = mx.labelled_rows(scores.filter(F.col("split") != "test"), ["model", "split"])
    best = mx.best_threshold(mx.threshold_sweep(rows, ["model", "split"]), ["model", "split"], secondary)
    return best.join(broadcast_if_bounded(runs, MAX_RUNS_BROADCAST),
                     (best.model == runs.model) & (best.split == runs.threshold_split)) \
        .select("run_id", best.model, "threshold", "youden_index", "best_youden")


def run_scores(scores: DataFrame, runs: DataFrame) -> DataFrame:
    """Scores tagged with every run of their model: ``(run_id, model, split, id, target, proba)``."""
    return scores.join(broadcast_if_bounded(runs.select("run_id", "model"), MAX_RUNS_BROADCAST), "model") \
        .select("run_id", "model", "split", "id", "target", "proba")


def run_evaluation(rscores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Per run, model and split: the evaluation row (G1, G2) with ``run_id`` in front."""
    thr = small_table(thresholds.select(*RUN_KEYS, "threshold"), MAX_RUNS_BROADCAST)
    labelled = rscores.filter(F.col("split") != "test")
    return mx.perf_rows(labelled, thr, keys=RUN_KEYS).unionByName(mx.test_rows(rscores, thr, keys=RUN_KEYS))


def runs_table(evaluation: DataFrame, thresholds: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per run with its parameters and flat metrics as maps (NULL metrics are not logged)."""
    flat = ev.run_metrics(evaluation.drop("model").withColumnRenamed("run_id", "model"),
                          thresholds.drop("model").withColumnRenamed("run_id", "model")).withColumnRenamed("model", "run_id")
    names = [c for c in flat.columns if c != "run_id"]
    metrics = F.map_filter(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c))]), lambda k, v: v.isNotNull())
    params = F.create_map(F.lit("threshold_split"), F.col("threshold_split"),
                          F.lit("secondary_metric"), F.lit("accuracy"), F.lit("tolerance"), F.lit("0.02"))
    return flat.join(runs, "run_id").select(
        "run_id", F.col("model").alias("run_name"), F.substring("run_id", 1, 15).alias("ts"),
        params.alias("params"), metrics.alias("metrics"))


def runs_flat(runs: DataFrame) -> DataFrame:
    """``param_*`` and metric columns, missing → NULL (explode the maps, pivot back)."""
    p = runs.select("run_id", F.explode("params").alias("k", "v")).withColumn("k", F.concat(F.lit("param_"), "k"))
    m = runs.select("run_id", F.explode("metrics").alias("k", "v"))
    pk = sorted(r[0] for r in p.select("k").distinct().collect())
    mk = sorted(r[0] for r in m.select("k").distinct().collect())
    pw = p.groupBy("run_id").pivot("k", pk).agg(F.first("v"))
    mw = m.groupBy("run_id").pivot("k", mk).agg(F.first("v"))
    return runs.select("run_id", "run_name", "ts").join(pw, "run_id", "left").join(mw, "run_id", "left")


def runs_comparison(flat: DataFrame) -> DataFrame:
    """The comparison table of runs."""
    cols = ["val_auc", "train_auc", "val_accuracy", "train_accuracy", "overfit_gap_auc", "threshold"]
    return flat.select("run_id", "run_name", *[F.col(c) if c in flat.columns else F.lit(None).cast("double").alias(c) for c in cols])


def latest_evaluation(evaluation: DataFrame) -> DataFrame:
    """The latest run's row per (model, split) by run id (time-ordered), then wide."""
    w = Window.partitionBy("model", "split").orderBy(F.col("run_id").desc())
    latest = evaluation.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "run_id")
    return ev.long_to_wide(latest)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest run id per model."""
    return runs.groupBy("model").agg(F.max("run_id").alias("run_id"))


def combined_roc(rscores: DataFrame, runs: DataFrame) -> DataFrame:
    """ROC points and area of every model's latest run, scores joined to labels by id."""
    latest = latest_runs(runs)
    val = rscores.filter(F.col("split") == "val").join(small_table(latest, MAX_RUNS_BROADCAST), RUN_KEYS)
    hist = mx.score_histogram(val, RUN_KEYS)
    auc = mx.ranking_metrics(hist, RUN_KEYS).select(*RUN_KEYS, rnd("roc_auc").alias("roc_auc"))
    pts = mx.roc_points(hist, RUN_KEYS)
    return pts.join(auc, RUN_KEYS).select(*RUN_KEYS, "threshold", rnd("fpr", 8).alias("fpr"), rnd("tpr", 8).alias("tpr"),
                                          "roc_auc")


# ── importances ───────────────────────────────────────────────────────────────────────────────────

def score_input_importance(rscores: DataFrame, frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """Model-agnostic importance per run: ``|corr(feature, proba)|`` on validation rows, as a percentage
    of the run's total; a feature without a defined correlation (constant score) is not reported."""
    val = rscores.filter(F.col("split") == "val").join(frame.select("id", *features), "id")
    wide = val.groupBy("run_id").agg(*[F.abs(safe_corr(F.col(f).cast("double"), F.col("proba"))).alias(f) for f in features])
    items = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("imp")) for f in features])
    long = wide.select("run_id", F.inline(items)).filter(F.col("imp").isNotNull())
    total = long.groupBy("run_id").agg(F.sum("imp").alias("_t"))
    return long.join(total, "run_id").select("run_id", "feature", rnd(F.col("imp") / F.col("_t") * 100.0, 4).alias("importance_pct"))


def importance_across_runs(importance: DataFrame, run_ids: Sequence[str] | None = None) -> DataFrame:
    """Features × runs, missing = 0 (a full outer join expressed as one pivot). ``run_ids`` lists the
    runs to show (a run without any reported feature gets a column of zeros)."""
    run_ids = sorted(run_ids or [r[0] for r in importance.select("run_id").distinct().collect()])
    return importance.groupBy("feature").pivot("run_id", run_ids).agg(F.first("importance_pct")).na.fill(0.0)


def top_n_per_group(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """H4/H5: top n rows per group by ``order`` desc (ties: feature name)."""
    w = Window.partitionBy(group).orderBy(F.col(order).desc(), F.col("feature").asc())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


# ── training history (E13, E14, H2, H3) ───────────────────────────────────────────────────────────

def history_path(scores: DataFrame, iterations: int = 20) -> DataFrame:
    """A made-up path for the SQL checks (trained models: ``models.staged_history``): iteration i predicts ``0.5 + (score - 0.5) * i / 10`` clipped to
    [0.001, 0.999] (under-fit early, over-confident late). Long form ``(model, iteration, split, metric,
    value)`` with log-loss and error, computed from the per-score histogram (never rows × iterations)."""
    hist = mx.score_histogram(scores.filter(F.col("split") != "test"), ["model", "split"])
    staged = hist.select("model", "split", "pos", "neg", "proba",
                         F.explode(F.sequence(F.lit(1), F.lit(iterations))).alias("iteration"))
    p = F.least(F.greatest(F.lit(0.5) + (F.col("proba") - 0.5) * F.col("iteration").cast("double") / F.lit(10.0),
                           F.lit(0.001)), F.lit(0.999))
    staged = staged.withColumn("p", p)
    agg = staged.groupBy("model", "split", "iteration").agg(
        (-F.sum(F.col("pos") * F.log("p") + F.col("neg") * F.log(1 - F.col("p"))) / F.sum(F.col("pos") + F.col("neg"))).alias("logloss"),
        (F.sum(F.when(F.col("p") >= 0.5, F.col("neg")).otherwise(F.col("pos"))) / F.sum(F.col("pos") + F.col("neg"))).alias("error"))
    items = F.array(F.struct(F.lit("logloss").alias("metric"), rnd("logloss", 6).alias("value")),
                    F.struct(F.lit("error").alias("metric"), rnd("error", 6).alias("value")))
    return agg.select("model", "iteration", "split", F.inline(items))


def best_iteration(history: DataFrame, keys: Sequence[str] = ("model",), split: str = "val") -> DataFrame:
    """Iteration with the best validation metric: argmin for loss/error, argmax otherwise; the
    first iteration wins ties."""
    k = list(keys)
    v = history.filter(F.col("split") == split)
    lower = F.col("metric").isin("logloss", "error")
    key = F.struct(F.when(lower, F.col("value")).otherwise(-F.col("value")), F.col("iteration"))
    return v.groupBy(*k, "metric").agg(F.min_by(F.struct("iteration", "value"), key).alias("b")).select(
        *k, "metric", F.col("b.iteration").alias("best_iteration"), F.col("b.value").alias("best_value"))


def loss_curve_gap(history: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """H2: final log-loss per split (value at the last iteration) and the val - train gap."""
    k = list(keys)
    ll = history.filter(F.col("metric") == "logloss")
    last = ll.groupBy(*k, "split").agg(F.max_by("value", "iteration").alias("final"))
    wide = last.groupBy(*k).agg(F.first(F.when(F.col("split") == "train", F.col("final")), ignorenulls=True).alias("train_final"),
                                F.first(F.when(F.col("split") == "val", F.col("final")), ignorenulls=True).alias("val_final"))
    return wide.withColumn("gap", rnd(F.col("val_final") - F.col("train_final"), 6))


def all_curves(history: DataFrame) -> DataFrame:
    """H3: every curve, error flipped to accuracy (``1 - error``)."""
    return history.select(*[c for c in history.columns if c not in ("metric", "value")],
                          F.when(F.col("metric") == "error", F.lit("accuracy")).otherwise(F.col("metric")).alias("metric"),
                          F.when(F.col("metric") == "error", rnd(1 - F.col("value"), 6)).otherwise(F.col("value")).alias("value"))
