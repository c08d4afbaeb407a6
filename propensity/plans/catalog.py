"""Registered queries: one Spark plan per operator, each paired with its SQL check when SQL can
express it. ``__spark_entry__`` only re-exports this registry."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity import oracle as Q
from propensity.functions.exprs import rnd
from propensity.operators import evaluate as ev
from propensity.operators import metrics as mx
from propensity.session import materialize
from propensity.sources import campaign as cf

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ── frames ─────────────────────────────────────────────────────────────────────────────────────────

@query("campaign_frame", Q.with_base() + " SELECT * FROM campaign")
def q_campaign_frame(spark, sf):
    return cf.campaign_frame(spark, sf)


@query("stratified_split", Q.with_base() + " SELECT id, target, split FROM frame")
def q_stratified_split(spark, sf):
    return cf.labelled_and_test(spark, sf).select("id", "target", "split")


@query("scores_table", Q.with_base() + " SELECT model, split, id, target, proba FROM scores")
def q_scores_table(spark, sf):
    return cf.scores_table(spark, sf)


# ── metrics (F) ────────────────────────────────────────────────────────────────────────────────────

def _hist(spark, sf):
    return mx.score_histogram(cf.scores_table(spark, sf), ["model", "split"])


def _rows(spark, sf):
    return mx.labelled_rows(cf.scores_table(spark, sf), ["model", "split"])


@query("threshold_sweep", Q.metric_stack() + " SELECT * FROM sweep")
def q_threshold_sweep(spark, sf):
    return mx.threshold_sweep(_rows(spark, sf), ["model", "split"])


@query("best_threshold", Q.metric_stack() + " SELECT * FROM best")
def q_best_threshold(spark, sf):
    return mx.best_threshold(q_threshold_sweep(spark, sf), ["model", "split"])


@query("threshold_band", Q.metric_stack() + """
  SELECT s.*, b.best_youden, s.youden_index >= b.best_youden - 0.02 AS in_band, s.threshold = b.threshold AS chosen
  FROM sweep s JOIN best b USING (model, split)""")
def q_threshold_band(spark, sf):
    return mx.threshold_band(q_threshold_sweep(spark, sf), ["model", "split"])


def _rank(spark, sf):
    return mx.ranking_metrics(_hist(spark, sf), ["model", "split"])


@query("roc_auc", Q.metric_stack() + " SELECT model, split, " + Q.r4("roc_auc") + " AS roc_auc FROM rank_metrics")
def q_roc_auc(spark, sf):
    return _rank(spark, sf).select("model", "split", rnd("roc_auc").alias("roc_auc"))


@query("gini", Q.metric_stack() + " SELECT model, split, " + Q.r4("(roc_auc * 2.0 - 1.0)") + " AS gini FROM rank_metrics")
def q_gini(spark, sf):
    return _rank(spark, sf).select("model", "split", rnd("gini").alias("gini"))


@query("ks", Q.metric_stack() + " SELECT model, split, " + Q.r4("ks_statistic") + " AS ks_statistic FROM rank_metrics")
def q_ks(spark, sf):
    return _rank(spark, sf).select("model", "split", rnd("ks_statistic").alias("ks_statistic"))


@query("average_precision", Q.metric_stack() + " SELECT model, split, " + Q.r4("pr_auc") + " AS pr_auc FROM rank_metrics")
def q_average_precision(spark, sf):
    return _rank(spark, sf).select("model", "split", rnd("pr_auc").alias("pr_auc"))


@query("brier", Q.metric_stack() + " SELECT model, split, " + Q.r4("brier_score") + " AS brier_score FROM rank_metrics")
def q_brier(spark, sf):
    return _rank(spark, sf).select("model", "split", rnd("brier_score").alias("brier_score"))


@query("ece", Q.metric_stack() + " SELECT model, split, " + Q.r4("ece") + " AS ece FROM ece")
def q_ece(spark, sf):
    return mx.expected_calibration_error(_rows(spark, sf), ["model", "split"]).select(
        "model", "split", rnd("ece").alias("ece"))


@query("reliability_bins", Q.metric_stack() + " SELECT model, split, bin, CAST(coalesce(n, 0) AS BIGINT) AS n, "
       + Q.r4("mean_proba", 9) + " AS mean_proba, " + Q.r4("frac_positive", 9) + """ AS frac_positive
  FROM (SELECT g.model, g.split, CAST(b AS INTEGER) AS bin FROM (SELECT DISTINCT model, split FROM hist) g, range(10) t(b)) LEFT JOIN cal USING (model, split, bin)""")
def q_reliability_bins(spark, sf):
    t = mx.calibration_table(_rows(spark, sf), ["model", "split"])
    return t.select("model", "split", "bin", F.col("n").cast("long").alias("n"),
                    rnd("mean_proba", 9).alias("mean_proba"), rnd("frac_positive", 9).alias("frac_positive"))


@query("roc_points", Q.metric_stack() + """
  SELECT model, split, proba AS threshold, """ + Q.r4(Q.sdiv("cf", "n_neg"), 8) + " AS fpr, " + Q.r4(Q.sdiv("ct", "n_pos"), 8)
       + """ AS tpr FROM roc
  UNION ALL SELECT DISTINCT model, split, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM hist""")
def q_roc_points(spark, sf):
    pts = mx.roc_points(_hist(spark, sf), ["model", "split"])
    return pts.select("model", "split", "threshold", rnd("fpr", 8).alias("fpr"), rnd("tpr", 8).alias("tpr"))


@query("confusion", Q.metric_stack() + """
  SELECT model, split, threshold, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
         CAST(tp AS BIGINT) AS tp FROM conf""")
def q_confusion(spark, sf):
    scores = cf.scores_table(spark, sf)
    thr = ev.chosen_thresholds(scores).select("model", "threshold")
    return mx.confusion_at(mx.labelled_rows(scores, ["model", "split"]), thr, ["model", "split"], ["model"])


@query("perf_rows", Q.metric_stack() + " SELECT * FROM perf")
def q_perf_rows(spark, sf):
    scores = cf.scores_table(spark, sf)
    thr = ev.chosen_thresholds(scores).select("model", "threshold")
    return mx.perf_rows(scores.filter(F.col("split") != "test"), thr)


@query("test_rows", Q.metric_stack() + " SELECT * FROM testrows")
def q_test_rows(spark, sf):
    scores = cf.scores_table(spark, sf)
    return mx.test_rows(scores, ev.chosen_thresholds(scores).select("model", "threshold"))


@query("decide", Q.metric_stack() + """
  SELECT s.model, s.split, s.id, CAST(s.proba >= t.threshold AS INTEGER) AS decision FROM scores s JOIN thr t USING (model)""")
def q_decide(spark, sf):
    scores = cf.scores_table(spark, sf)
    thr = ev.chosen_thresholds(scores).select("model", "threshold")
    return mx.decide(scores, thr).select("model", "split", "id", "decision")


# ── evaluation (G) ─────────────────────────────────────────────────────────────────────────────────

def _evaluation(spark, sf):
    return ev.evaluate_all(cf.scores_table(spark, sf))


@query("evaluate_all", Q.metric_stack() + " SELECT * FROM evaluation")
def q_evaluate_all(spark, sf):
    return _evaluation(spark, sf)


# ── profiling (B) ──────────────────────────────────────────────────────────────────────────────────

from propensity.operators import profile as pf  # noqa: E402


def _profile_frame(spark, sf):
    return cf.campaign_frame(spark, sf).drop("id")


def _wrap(sql: str) -> str:
    return Q.with_base() + " SELECT * FROM (" + sql + ")"


@query("profile_numeric", _wrap(Q.profile_numeric_sql()))
def q_profile_numeric(spark, sf):
    return pf.profile_numeric(_profile_frame(spark, sf))


@query("profile_numeric_approx")
def q_profile_numeric_approx(spark, sf):
    """Sketch-based profile (rows-only: approximate distinct counts and quantiles)."""
    return pf.profile_numeric_approx(_profile_frame(spark, sf))


@query("profile_categorical", _wrap(Q.profile_categorical_sql()))
def q_profile_categorical(spark, sf):
    return pf.profile_categorical(_profile_frame(spark, sf))


@query("describe", _wrap(Q.describe_sql()))
def q_describe(spark, sf):
    return pf.describe(_profile_frame(spark, sf))


_MISSING_COLS = ["target", "status", "segment", "region", "priority", "total_price", "acct_bal", "n_lines", "qty",
                 "disc", "gross", "net", "previous", "days_since", "score"]


@query("missing", _wrap(Q.missing_sql(_MISSING_COLS)))
def q_missing(spark, sf):
    return pf.missing(_profile_frame(spark, sf))


@query("value_counts", _wrap(Q.value_counts_sql()))
def q_value_counts(spark, sf):
    return pf.value_counts(_profile_frame(spark, sf))


@query("histogram40", _wrap(Q.histogram_sql()))
def q_histogram40(spark, sf):
    return pf.histograms(_profile_frame(spark, sf))


@query("target_distribution", Q.with_base() + " SELECT target, count(*) AS count, "
       + Q.r4("CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM campaign) AS DOUBLE)") + " AS share FROM campaign GROUP BY target")
def q_target_distribution(spark, sf):
    return pf.target_distribution(_profile_frame(spark, sf))


@query("corr_with_target", _wrap(Q.corr_sql()))
def q_corr_with_target(spark, sf):
    return pf.corr_with_target(_profile_frame(spark, sf))


@query("target_rate_by_category", _wrap(Q.target_rate_sql()))
def q_target_rate_by_category(spark, sf):
    return pf.target_rate_by_category(_profile_frame(spark, sf))


@query("sentinel_share", Q.with_base() + " SELECT 'days_since' AS feature, CAST(-1 AS DOUBLE) AS sentinel, "
       "CAST(sum(CASE WHEN days_since = -1 THEN 1 ELSE 0 END) AS BIGINT) AS n_sentinel, "
       + Q.pct("sum(CASE WHEN days_since = -1 THEN 1 ELSE 0 END)", "count(*)") + " AS pct_sentinel FROM campaign")
def q_sentinel_share(spark, sf):
    return pf.sentinel_share(_profile_frame(spark, sf), cf.SENTINEL_COL, cf.SENTINEL_VALUE)


# ── evaluation tables (G) ──────────────────────────────────────────────────────────────────────────

@query("eval_wide", Q.eval_wide_sql() + " SELECT * FROM wide")
def q_eval_wide(spark, sf):
    return ev.long_to_wide(_evaluation(spark, sf))


@query("run_metrics", Q.run_metrics_sql())
def q_run_metrics(spark, sf):
    scores = cf.scores_table(spark, sf)
    thr = ev.chosen_thresholds(scores)
    return ev.run_metrics(ev.evaluate_all(scores, thr), thr)


@query("overfit_flag", Q.overfit_sql())
def q_overfit_flag(spark, sf):
    return ev.overfit_summary(_evaluation(spark, sf))


@query("report_interleaved", Q.report_interleaved_sql())
def q_report_interleaved(spark, sf):
    return ev.report_interleaved(_evaluation(spark, sf))


@query("best_model", Q.metric_stack() + "," + Q.best_model_cte() + " SELECT * FROM bestm")
def q_best_model(spark, sf):
    return ev.best_model(_evaluation(spark, sf))


@query("best_submission", Q.best_submission_sql())
def q_best_submission(spark, sf):
    scores = cf.scores_table(spark, sf)
    return ev.best_submission(scores, ev.evaluate_all(scores))


# ── feature engineering (C) ────────────────────────────────────────────────────────────────────────

from propensity.operators import features as fe  # noqa: E402


def _split_frame(spark, sf):
    return cf.labelled_and_test(spark, sf)


def _fitted(spark, sf):
    """Split frame checkpointed once (the fit reads it several times), plus the fitted state."""
    frame = _split_frame(spark, sf)  # already a stage table
    return frame, fe.fit_preprocessor(frame.filter(F.col("split") == "train"))


@query("sentinel_flag", Q.features_sql("SELECT id, days_since, had_prior_order FROM eng"))
def q_sentinel_flag(spark, sf):
    return fe.engineer(_split_frame(spark, sf)).select("id", "days_since", "had_prior_order")


@query("ordinal_encode", Q.features_sql("SELECT id, priority FROM eng"))
def q_ordinal_encode(spark, sf):
    return fe.engineer(_split_frame(spark, sf)).select("id", "priority")


@query("one_hot", Q.features_sql("SELECT id, " + ", ".join(d[2] for d in Q.DUMMIES) + " FROM num"))
def q_one_hot(spark, sf):
    frame, pre = _fitted(spark, sf)
    dummies = fe.one_hot_exprs(pre.levels)
    return frame.select("id", *[e.alias(n) for n, e in dummies.items()])


@query("median_impute", Q.features_sql("SELECT id, split, " + Q.round_cols(Q.NUMERIC_COLUMNS) + " FROM imp"))
def q_median_impute(spark, sf):
    frame, pre = _fitted(spark, sf)
    num = pre.numeric(frame, keep=["id", "split"])
    return num.select("id", "split", *[rnd(c, 6).alias(c) for c in pre.numeric_columns])


@query("standard_scale", Q.features_sql("SELECT id, split, " + Q.round_cols(Q.NUMERIC_COLUMNS) + " FROM scaled"))
def q_standard_scale(spark, sf):
    frame, pre = _fitted(spark, sf)
    sc = pre.scaled(frame, keep=["id", "split"])
    return sc.select("id", "split", *[rnd(c, 6).alias(c) for c in pre.numeric_columns])


@query("scale_check", Q.features_sql(
    "SELECT " + Q.r4("greatest(" + ", ".join(f"abs(avg({c}))" for c in Q.NUMERIC_COLUMNS) + ")", 6) + " AS max_abs_mean, "
    + Q.r4("greatest(" + ", ".join(f"abs(stddev_pop({c}) - 1.0)" for c in Q.NUMERIC_COLUMNS) + ")", 6)
    + " AS max_abs_std_dev FROM scaled WHERE split = 'train'"))
def q_scale_check(spark, sf):
    frame, pre = _fitted(spark, sf)
    return fe.scale_check(pre.scaled(frame.filter(F.col("split") == "train")), pre.numeric_columns)


@query("align_columns", Q.features_sql(
    "SELECT id, " + ", ".join(Q.NUMERIC_COLUMNS) + " FROM num WHERE split = 'test'"))
def q_align_columns(spark, sf):
    """Test rows one-hot encoded with their own levels (as the reference does per file), then aligned to
    the training column list."""
    frame, pre = _fitted(spark, sf)
    test = fe.engineer(frame.filter(F.col("split") == "test"))
    own = fe.fit_levels(test, list(pre.levels))
    test_num = test.select("id", *[F.col(c).cast("double").alias(c) for c in Q.BASE_NUMERIC],
                           *[e.alias(n) for n, e in fe.one_hot_exprs(own).items()])
    return fe.align_columns(test_num, pre.numeric_columns, keep=["id"])


@query("stratified_kfold", Q.with_base() + """
  SELECT id, target, CAST((row_number() OVER (PARTITION BY target ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) - 1) % 5
         AS INTEGER) AS fold FROM frame WHERE split <> 'test'""")
def q_stratified_kfold(spark, sf):
    labelled = _split_frame(spark, sf).filter(F.col("split") != "test")
    return fe.stratified_kfold(labelled, 5).select("id", "target", "fold")


SUBSAMPLE_N = 2000


@query("stratified_subsample", Q.with_base() + f"""
, tr AS (SELECT id, target FROM frame WHERE split = 'train'),
st AS (SELECT count(*) AS n, sum(target) AS p FROM tr),
k AS (SELECT greatest(1, CAST(floor({SUBSAMPLE_N} * (CAST(p AS DOUBLE) / CAST(n AS DOUBLE))) AS BIGINT)) AS n_pos FROM st),
rk AS (SELECT id, target, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) AS r FROM tr)
SELECT id, target FROM rk, k WHERE (target = 1 AND r <= k.n_pos) OR (target = 0 AND r <= {SUBSAMPLE_N} - k.n_pos)""")
def q_stratified_subsample(spark, sf):
    train = _split_frame(spark, sf).filter(F.col("split") == "train")
    return fe.stratified_subsample(train, SUBSAMPLE_N).select("id", "target")


@query("preprocess_report", Q.preprocess_report_sql())
def q_preprocess_report(spark, sf):
    frame, pre = _fitted(spark, sf)
    return fe.preprocess_report(pre, frame.filter(F.col("split") == "train"))


# ── feature selection (D) ──────────────────────────────────────────────────────────────────────────

from propensity.operators import select as sl  # noqa: E402
from propensity.operators import nearest  # noqa: E402

MI_TOP_K_CAMPAIGN = 12  # the campaign frame has 19 model columns; keep 12 by MI


def _train_numeric(spark, sf, impute=True):
    frame, pre = _fitted(spark, sf)
    train = frame.filter(F.col("split") == "train")
    return materialize(pre.numeric(train, keep=["id", "target"], impute=impute)), pre.numeric_columns


@query("drop_high_missing", Q.features_sql(
    "SELECT * FROM (" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {Q.r4(f'CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 6)} AS missing_rate, "
        f"CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) <= 0.5 AS kept FROM num WHERE split = 'train'"
        for c in Q.NUMERIC_COLUMNS) + ")"))
def q_drop_high_missing(spark, sf):
    num, cols = _train_numeric(spark, sf, impute=False)
    rates = sl.missing_rates(num, cols)
    return rates.select("feature", rnd("missing_rate", 6).alias("missing_rate"),
                        (F.col("missing_rate") <= sl.MISSING_THRESHOLD).alias("kept"))


@query("spearman_matrix", Q.selection_sql("SELECT a, b, " + Q.r4("corr", 6) + " AS corr FROM sp"))
def q_spearman_matrix(spark, sf):
    num, cols = _train_numeric(spark, sf)
    return sl.correlation_pairs(num, cols, "spearman").select("a", "b", rnd("corr", 6).alias("corr"))


@query("pearson_matrix", Q.features_sql("SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{Q.NUMERIC_COLUMNS[i]}' AS a, '{Q.NUMERIC_COLUMNS[j]}' AS b, "
    f"{Q.r4(Q.scorr(Q.NUMERIC_COLUMNS[i], Q.NUMERIC_COLUMNS[j]), 6)} AS corr FROM imp WHERE split = 'train'"
    for j in range(len(Q.NUMERIC_COLUMNS)) for i in range(j)) + ")"))
def q_pearson_matrix(spark, sf):
    num, cols = _train_numeric(spark, sf)
    return sl.correlation_pairs(num, cols, "pearson").select("a", "b", rnd("corr", 6).alias("corr"))


@query("mutual_info", Q.selection_sql("SELECT feature, position, " + Q.r4("mi", 6) + " AS mi FROM mi"))
def q_mutual_info(spark, sf):
    num, cols = _train_numeric(spark, sf)
    return sl.mutual_information(num, cols).select("feature", "position", rnd("mi", 6).alias("mi"))


@query("knn_mutual_info", Q.knn_mi_sql())
def q_knn_mutual_info(spark, sf):
    num, cols = _train_numeric(spark, sf)
    return nearest.knn_mutual_information(num, cols).select("feature", "position", rnd("mi", 6).alias("mi"))


@query("top_k_mi", Q.selection_sql("SELECT feature, position, mi6 AS mi FROM mi6 ORDER BY mi6 DESC, position LIMIT 12"))
def q_top_k_mi(spark, sf):
    num, cols = _train_numeric(spark, sf)
    mi = sl.mutual_information(num, cols).select("feature", "position", rnd("mi", 6).alias("mi"))
    return sl.top_k_by_mi(mi, MI_TOP_K_CAMPAIGN)


@query("drop_correlated", Q.selection_sql("SELECT feature, kept FROM s2"))
def q_drop_correlated(spark, sf):
    num, cols = _train_numeric(spark, sf)
    _, survivors, _ = sl.select_features(num, cols, mi_top_k=MI_TOP_K_CAMPAIGN)
    kept = set(survivors["stage2_correlation"])
    return spark.createDataFrame([(c, c in kept) for c in cols], "feature string, kept boolean")


@query("selection_report", Q.selection_report_sql())
def q_selection_report(spark, sf):
    num, cols = _train_numeric(spark, sf)
    _, _, report = sl.select_features(num, cols, mi_top_k=MI_TOP_K_CAMPAIGN)
    return report


# ── runs and chart tables (A4–A7, G5, G6, G10–G13, H) ──────────────────────────────────────────────

from propensity.operators import runs as rn  # noqa: E402

# The demo runs evaluated from the scores table (run id, model, split the threshold is
# tuned on); the first is an older run of m1 tuned on the training split.
RUNS = [
    ("20261130_090000_m1_search", "m1", "train"),
    ("20261201_080000_m1_search", "m1", "val"),
    ("20261201_081500_m2_search", "m2", "val"),
    ("20261201_083000_m3_search", "m3", "val"),
    ("20261201_084500_m4_search", "m4", "val"),
]


def _run_parts(spark, sf):
    scores = materialize(cf.scores_table(spark, sf))
    runs = rn.runs_descriptor(spark, RUNS)
    thr = rn.run_thresholds(scores, runs)
    rsc = rn.run_scores(scores, runs)
    return scores, runs, thr, rsc


@query("runs_flat", Q.runs_flat_sql(RUNS))
def q_runs_flat(spark, sf):
    scores, runs, thr, rsc = _run_parts(spark, sf)
    table = rn.runs_table(rn.run_evaluation(rsc, thr), thr, runs)
    return rn.runs_flat(table)


@query("runs_comparison", Q.runs_comparison_sql(RUNS))
def q_runs_comparison(spark, sf):
    return rn.runs_comparison(q_runs_flat(spark, sf))


@query("eval_latest", Q.eval_latest_sql(RUNS))
def q_eval_latest(spark, sf):
    scores, runs, thr, rsc = _run_parts(spark, sf)
    return rn.latest_evaluation(rn.run_evaluation(rsc, thr))


@query("combined_roc", Q.combined_roc_sql(RUNS))
def q_combined_roc(spark, sf):
    scores, runs, thr, rsc = _run_parts(spark, sf)
    return rn.combined_roc(rsc, runs)


def _importance(spark, sf):
    scores, runs, thr, rsc = _run_parts(spark, sf)
    return rn.score_input_importance(rsc, cf.campaign_frame(spark, sf), Q.IMPORTANCE_FEATURES)


@query("importance_across_runs", Q.importance_across_sql(RUNS))
def q_importance_across_runs(spark, sf):
    return rn.importance_across_runs(_importance(spark, sf), [r[0] for r in RUNS])


@query("top_n_importance", Q.importance_sql(RUNS) + """
  SELECT * FROM (SELECT run_id, feature, importance_pct,
                        row_number() OVER (PARTITION BY run_id ORDER BY importance_pct DESC, feature ASC) AS rank FROM imp)
  WHERE rank <= 3""")
def q_top_n_importance(spark, sf):
    return rn.top_n_per_group(_importance(spark, sf), "run_id", "importance_pct", 3).withColumn("rank", F.col("rank").cast("long"))


def _history(spark, sf):
    return rn.history_path(cf.scores_table(spark, sf))


@query("training_history", Q.history_sql("SELECT * FROM history"))
def q_training_history(spark, sf):
    return _history(spark, sf)


@query("best_iteration", Q.history_sql("""
  SELECT model, metric, iteration AS best_iteration, value AS best_value FROM (
    SELECT *, row_number() OVER (PARTITION BY model, metric ORDER BY CASE WHEN metric IN ('logloss', 'error')
           THEN value ELSE -value END, iteration) AS r FROM history WHERE split = 'val') WHERE r = 1"""))
def q_best_iteration(spark, sf):
    return rn.best_iteration(_history(spark, sf))


@query("loss_curve_gap", Q.history_sql("""
  , fin AS (SELECT model, split, value FROM (SELECT *, row_number() OVER (PARTITION BY model, split ORDER BY iteration DESC) AS r
            FROM history WHERE metric = 'logloss') WHERE r = 1)
  SELECT model, max(CASE WHEN split = 'train' THEN value END) AS train_final, max(CASE WHEN split = 'val' THEN value END) AS val_final,
         """ + Q.r4("(max(CASE WHEN split = 'val' THEN value END) - max(CASE WHEN split = 'train' THEN value END))", 6)
    + " AS gap FROM fin GROUP BY model").replace(" \n  , fin", ", fin"))
def q_loss_curve_gap(spark, sf):
    return rn.loss_curve_gap(_history(spark, sf))


@query("all_curves", Q.history_sql("""
  SELECT model, iteration, split, CASE WHEN metric = 'error' THEN 'accuracy' ELSE metric END AS metric,
         CASE WHEN metric = 'error' THEN """ + Q.r4("(1 - value)", 6) + " ELSE value END AS value FROM history"))
def q_all_curves(spark, sf):
    return rn.all_curves(_history(spark, sf))


# ── models, search, importance, calibration, scoring (rows-only checks) ────────────────────────────

import uuid  # noqa: E402
from concurrent.futures import ThreadPoolExecutor  # noqa: E402

from propensity.operators import calibrate as cal  # noqa: E402
from propensity.operators import models as md  # noqa: E402
from propensity.operators import score as sc  # noqa: E402
from propensity.operators import search as se  # noqa: E402
from propensity.session import shared_path  # noqa: E402

SEARCH_TRIALS = 30
SEARCH_PARALLELISM = 3


def _fit(name, frame, pre):
    """Fit on the training rows; boosting stops early on the validation rows."""
    return md.fit_model(name, pre, frame.filter(F.col("split") == "train"), early_stop=frame.filter(F.col("split") == "val"))


def _fit_all(names, frame, pre):
    """The trainers' fits by name: boosters share their passes, the others are fitted one after the other beside them."""
    train, val = frame.filter(F.col("split") == "train"), frame.filter(F.col("split") == "val")
    boosters = [n for n in names if md.TRAINERS[n].variant == "tree"]
    with ThreadPoolExecutor(max_workers=2) as pool:  # a pass of boosting leaves slots free, the others' iterations take them
        others = pool.submit(lambda: {n: _fit(n, frame, pre) for n in names if n not in boosters})
        return md.fit_boosters(boosters, pre, train, val) | others.result()


def _model_scores(name):
    def run(spark, sf):
        frame, pre = _fitted(spark, sf)
        return _fit(name, frame, pre).score(pre, frame)
    run.__name__ = f"q_{name}"
    return run


for _name in md.TRAINERS:
    query(_name)(_model_scores(_name))


@query("model_evaluation")
def q_model_evaluation(spark, sf):
    """Every trainer measured like the stand-in scores: thresholds on val, every metric per split."""
    frame, pre = _fitted(spark, sf)
    fits, scores = _fit_all(md.TRAINERS, frame, pre), None
    for name in md.TRAINERS:
        s = fits[name].score(pre, frame)
        scores = s if scores is None else scores.unionByName(s)
    return ev.evaluate_all(materialize(scores))


@query("feature_importance")
def q_feature_importance(spark, sf):
    frame, pre = _fitted(spark, sf)
    fitted = _fit("gbt_leafwise", frame, pre)
    return spark.createDataFrame(md.feature_importance(fitted), "feature string, importance_pct double")


@query("gbt_history")
def q_gbt_history(spark, sf):
    frame, pre = _fitted(spark, sf)
    fitted = _fit("gbt_depthwise", frame, pre)
    return md.staged_history(fitted, pre, frame.filter(F.col("split") != "test"))


def _trained_history(spark, sf):
    """E14 of every trainer with staged rounds, fitted on the campaign frame; written once, a row per (model,
    iteration, split, metric)."""
    frame, pre = _fitted(spark, sf)
    labelled, out = frame.filter(F.col("split") != "test"), None
    fits = _fit_all(md.STAGED, frame, pre)
    for name in md.STAGED:
        rows = md.staged_history(fits[name], pre, labelled).select(F.lit(name).alias("model"), "iteration", "split", "metric", "value")
        out = rows if out is None else out.unionByName(rows)
    return materialize(out)


@query("trained_history")
def q_trained_history(spark, sf):
    return _trained_history(spark, sf)


@query("trained_best_iteration")
def q_trained_best_iteration(spark, sf):
    return rn.best_iteration(_trained_history(spark, sf))


@query("trained_loss_curve_gap")
def q_trained_loss_curve_gap(spark, sf):
    return rn.loss_curve_gap(_trained_history(spark, sf))


@query("trained_all_curves")
def q_trained_all_curves(spark, sf):
    return rn.all_curves(_trained_history(spark, sf))


def _pfi(spark, sf):
    frame, pre = _fitted(spark, sf)
    num = materialize(pre.numeric(frame.filter(F.col("split") != "test"), keep=["id", "split", "target"]))
    return se.permutation_importance(num.filter(F.col("split") == "train"), num.filter(F.col("split") == "val"),
                                     pre.numeric_columns)


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    return _pfi(spark, sf)


@query("top_n_pfi")
def q_top_n_pfi(spark, sf):
    return se.top_n_pfi(_pfi(spark, sf), 10)


@query("random_search")
def q_random_search(spark, sf):
    frame, pre = _fitted(spark, sf)
    _, trials = se.random_search("gbt_depthwise", pre, frame.filter(F.col("split") == "train"),
                                 frame.filter(F.col("split") == "val"), SEARCH_TRIALS, parallelism=SEARCH_PARALLELISM)
    return trials


@query("cv_objective")
def q_cv_objective(spark, sf):
    frame, pre = _fitted(spark, sf)
    value, per = se.cv_objective("svc_linear", pre, frame.filter(F.col("split") != "test"), {})
    return spark.createDataFrame([(p["fold"], p["val_auc"], p["train_auc"], value) for p in per],
                                 "fold int, val_auc double, train_auc double, objective double")


@query("select_pipeline")
def q_select_pipeline(spark, sf):
    """All four stages, the last one permutation importance on a baseline booster."""
    frame, pre = _fitted(spark, sf)
    num = materialize(pre.numeric(frame.filter(F.col("split") != "test"), keep=["id", "split", "target"]))
    train, val = num.filter(F.col("split") == "train"), num.filter(F.col("split") == "val")
    pfi = (lambda cols: se.permutation_importance(train, val, cols))
    _, _, report = sl.select_features(train, pre.numeric_columns, mi_top_k=MI_TOP_K_CAMPAIGN, pfi=pfi, pfi_top_n=8)
    return report


def _trained_run(spark, sf):
    frame, pre = _fitted(spark, sf)
    fitted = _fit("gbt_leafwise", frame, pre)
    val_scores = fitted.score(pre, frame.filter(F.col("split") == "val"))
    thr = mx.best_threshold(mx.threshold_sweep(mx.labelled_rows(val_scores, ["model"]), ["model"]), ["model"]).first()
    path = shared_path(spark, "runs", f"{uuid.uuid4().hex}_gbt_leafwise")
    sc.save_run(spark, path, pre, fitted, float(thr["threshold"]))
    return frame, pre, fitted, path


@query("score_new")
def q_score_new(spark, sf):
    """Save a trained run, load it back and score the unlabelled orders with the saved threshold."""
    frame, _, _, path = _trained_run(spark, sf)
    run = sc.load_run(spark, path)
    return sc.score_new(run, frame.filter(F.col("split") == "test").drop("target", "split"))


@query("save_load_roundtrip")
def q_save_load_roundtrip(spark, sf):
    """Scores of the reloaded run equal the in-memory model's scores (column ``same``)."""
    frame, pre, fitted, path = _trained_run(spark, sf)
    mem = fitted.score(pre, frame, keep=["id"]).select("id", F.col("proba").alias("proba_mem"))
    run = sc.load_run(spark, path)
    disk = run.model.score(run.pre, frame, keep=["id"]).select("id", F.col("proba").alias("proba_loaded"))
    return mem.join(disk, "id").withColumn("same", F.col("proba_mem") == F.col("proba_loaded"))


def _cal_input(spark, sf):
    return materialize(cf.scores_table(spark, sf))


@query("platt")
def q_platt(spark, sf):
    return cal.platt(_cal_input(spark, sf))


@query("isotonic", Q.isotonic_sql())
def q_isotonic(spark, sf):
    return cal.isotonic(_cal_input(spark, sf)).withColumn("proba", rnd("proba", 6))


@query("isotonic_blocks", Q.isotonic_blocks_sql())
def q_isotonic_blocks(spark, sf):
    return cal.isotonic_blocks(_cal_input(spark, sf)).select("model", "block", "lo", "hi", "pos", "n", rnd("rate", 6).alias("rate"))


@query("calibrated_threshold")
def q_calibrated_threshold(spark, sf):
    scores = _cal_input(spark, sf)
    return cal.rethreshold(cal.platt(scores).unionByName(cal.isotonic(scores)))


@query("stream_score")
def q_stream_score(spark, sf):
    """Unlabelled orders arrive as Parquet files; a Structured Streaming query scores them with the saved
    run into a Parquet sink (availableNow trigger); the sink is read back."""
    from propensity.streaming.scoring import stream_scores
    frame, _, _, path = _trained_run(spark, sf)
    base = shared_path(spark, "streams", uuid.uuid4().hex)
    src = frame.filter(F.col("split") == "test").drop("target", "split")
    src.write.mode("overwrite").parquet(f"{base}/in")
    run = sc.load_run(spark, path)
    q = stream_scores(spark, run, f"{base}/in", src.schema, f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


# ── second labelled frame: documents ⋈ labels ───────────────────────────────────────────────────────

DOCS = """WITH docs AS (SELECT d.doc_id AS id, d.n_chars, d.lang, d.source, CAST(l.{t} AS INTEGER) AS target
                  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


@query("docs_target_rate", DOCS.format(t="quality") + " SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {c} AS value, {Q.r4('avg(target)')} AS target_rate, count(*) AS count "
    f"FROM docs WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("lang", "source")) + ")")
def q_docs_target_rate(spark, sf):
    return pf.target_rate_by_category(cf.documents_frame(spark, sf, "quality"), "target", ["lang", "source"])


@query("docs_toxic_ranking", DOCS.format(t="toxic") + """,
scores AS (SELECT 'length' AS model, 'all' AS split, id, target,
                  CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + CAST(1000 AS DOUBLE)) AS proba FROM docs)""" + "," +
       Q.HIST + "," + Q.ECE + "," + Q.RANK + """
SELECT model, split, """ + ", ".join(f"{Q.r4(c)} AS {c}" for c in ("roc_auc", "ks_statistic", "pr_auc", "brier_score"))
       + ", " + Q.r4("e.ece") + " AS ece FROM rank_metrics JOIN ece e USING (model, split)")
def q_docs_toxic_ranking(spark, sf):
    """High-imbalance case: a length score against the toxic label."""
    docs = cf.documents_frame(spark, sf, "toxic")
    n = F.col("n_chars").cast("double")
    scores = docs.select(F.lit("length").alias("model"), F.lit("all").alias("split"), "id", "target",
                         (n / (n + F.lit(1000.0))).alias("proba"))
    r = mx.ranking_metrics(mx.score_histogram(scores, ["model", "split"]), ["model", "split"])
    return r.select("model", "split", *[rnd(c).alias(c) for c in ("roc_auc", "ks_statistic", "pr_auc", "brier_score", "ece")])


@query("selected_variant", Q.selection_sql(
    ", allrows AS (SELECT * FROM imp) SELECT id, split, feature, " + Q.r4("value", 6) + " AS value FROM (SELECT id, split, "
    + ", ".join(Q.NUMERIC_COLUMNS) + " FROM allrows) UNPIVOT (value FOR feature IN (" + ", ".join(Q.NUMERIC_COLUMNS)
    + ")) WHERE feature IN (SELECT feature FROM s3)"))
def q_selected_variant(spark, sf):
    """Every row of the numeric variant sliced to the MI-stage survivors, in long form."""
    frame, pre = _fitted(spark, sf)
    train = materialize(pre.numeric(frame.filter(F.col("split") == "train"), keep=["id", "target"]))
    selected, _, _ = sl.select_features(train, pre.numeric_columns, mi_top_k=MI_TOP_K_CAMPAIGN)
    sliced = fe.slice_variant(pre.numeric(frame, keep=["id", "split"]), selected, keep=["id", "split"])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in selected])
    return sliced.select("id", "split", F.inline(items)).select("id", "split", "feature", rnd("value", 6).alias("value"))


@query("select_raw")
def q_select_raw(spark, sf):
    """D9 (``on="raw"``): selection on the tree variant before imputation — real missing shares, pairwise-
    complete correlations among numeric columns only, nominal columns indexed (alphabetical) so MI can rank them
    with everything else; the importance stage permutes the same columns with medians filled in."""
    from pyspark.ml.feature import StringIndexer
    frame, pre = _fitted(spark, sf)
    labelled = frame.filter(F.col("split") != "test")
    tree = pre.tree(labelled, keep=["id", "split", "target"])
    nominal = list(pre.spec.nominal)
    idx = StringIndexer(inputCols=nominal, outputCols=[f"{c}__i" for c in nominal], stringOrderType="alphabetAsc",
                        handleInvalid="keep").fit(tree.filter(F.col("split") == "train"))
    raw = idx.transform(tree).drop(*nominal)
    raw = materialize(raw.select("id", "split", "target", *[F.col(c).cast("double").alias(c.removesuffix("__i")) for c in raw.columns
                                                            if c not in ("id", "split", "target")]))
    cols = [c for c in raw.columns if c not in ("id", "split", "target")]
    filled = raw.select("id", "split", "target", *[F.coalesce(F.col(c), F.lit(float(pre.medians.get(c) or 0.0))).alias(c) for c in cols])
    pfi = (lambda own: se.permutation_importance(filled.filter(F.col("split") == "train"), filled.filter(F.col("split") == "val"), own))
    _, _, report = sl.select_features(raw.filter(F.col("split") == "train").drop("split"), cols, mi_top_k=MI_TOP_K_CAMPAIGN, pfi=pfi,
                                      pfi_top_n=8, corr_cols=[c for c in cols if c not in nominal])
    return report


# ── whole runs ─────────────────────────────────────────────────────────────────────────────────────

def _eda_tables(spark, sf):
    from propensity.plans.eda import run_eda
    out = shared_path(spark, "eda", uuid.uuid4().hex)
    run_eda(_profile_frame(spark, sf), out, "target", (cf.SENTINEL_COL, cf.SENTINEL_VALUE))
    return out


@query("eda_run", _wrap(Q.value_counts_sql()))
def q_eda_run(spark, sf):
    """The whole profiling plan, written; one of its tables read back (A3)."""
    return spark.read.parquet(f"{_eda_tables(spark, sf)}/value_counts")


@query("processed_frame", Q.features_sql("SELECT split, count(*) AS n, " + ", ".join(
    f"{Q.r4(f'sum({c})', 2)} AS {c}" for c in ("qty", "priority", "days_since")) + " FROM imp GROUP BY split"))
def q_processed_frame(spark, sf):
    """A2, A5: the imputed variant written by split with its column manifest, read back in manifest order."""
    from propensity.sources import io
    frame, pre = _fitted(spark, sf)
    base, run = shared_path(spark, "processed", uuid.uuid4().hex), rn.run_id("processed")
    io.save_processed(pre.numeric(frame, keep=["id", "split", "target"]), f"{base}/frame")
    io.write_manifest(spark, f"{base}/manifest", run, "numeric", pre.numeric_columns)
    names = io.read_manifest(spark, f"{base}/manifest", run, "numeric")
    parts = [io.load_processed(spark, f"{base}/frame", s).select("split", *names) for s in ("train", "val", "test")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), *[rnd(F.sum(c), 2).alias(c) for c in ("qty", "priority", "days_since")])


@query("csv_round_trip", Q.with_base() + " SELECT id, segment, region, target FROM campaign")
def q_csv_round_trip(spark, sf):
    """A1, A3: the campaign frame as header CSV and back through the labelled-table reader."""
    from propensity.sources import io
    from propensity.sources.tables import read_labelled_csv
    path = shared_path(spark, "csv", uuid.uuid4().hex)
    frame = cf.campaign_frame(spark, sf)
    io.write_table(frame, path, "csv")
    return read_labelled_csv(spark, path, frame.schema).select("id", "segment", "region", "target")


@query("submission_file", Q.best_submission_sql())
def q_submission_file(spark, sf):
    """The best model's decisions as header CSV, read back."""
    path = shared_path(spark, "submission", uuid.uuid4().hex)
    decisions = q_best_submission(spark, sf)
    sc.write_submission(decisions, path)
    return spark.read.option("header", True).schema(decisions.select("id", "target").schema).csv(path)


@query("full_run")
def q_full_run(spark, sf):
    """§3.1: select, search, train with early stopping on the selected columns, evaluate, log. One row per model of
    the run's own log."""
    from propensity.plans.pipeline import RunConfig, run_pipeline
    out = shared_path(spark, "full_run", uuid.uuid4().hex)
    return run_pipeline(spark, sf, RunConfig(mi_top_k=MI_TOP_K_CAMPAIGN, pfi_top_n=8, out_dir=out))["runs"]


def _run_importance(spark, sf, **changes):
    """The importance table that whole runs write. Only boosters have one, so only they are run."""
    from propensity.plans.pipeline import RunConfig, run_pipeline
    out = shared_path(spark, "run_importance", uuid.uuid4().hex)
    boosters = tuple(n for n in md.TRAINERS if n.startswith("gbt"))
    cfg = {"mi_top_k": MI_TOP_K_CAMPAIGN, "pfi_top_n": 8} | changes
    run_pipeline(spark, sf, RunConfig(models=boosters, out_dir=out, **cfg))
    return spark.read.parquet(f"{out}/importance").select("run_id", "feature", "importance_pct")


@query("trained_importance_across_runs")
def q_trained_importance_across_runs(spark, sf):
    return rn.importance_across_runs(_run_importance(spark, sf))


@query("trained_top_n_importance")
def q_trained_top_n_importance(spark, sf):
    return rn.top_n_per_group(_run_importance(spark, sf), "run_id", "importance_pct", 3).withColumn("rank", F.col("rank").cast("long"))
