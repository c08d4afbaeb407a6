"""Plain SQL (DuckDB dialect) for every operator that SQL can express.

These strings are the independent check of the Spark operators: each one recomputes an operator's
result directly from the input tables with ordinary whole-table windows and aggregates. Building blocks
are CTE strings composed in Python.
"""
from __future__ import annotations

from propensity.functions.exprs import calibration_edges


def r4(expr: str, d: int = 4) -> str:
    """Same rounding as ``functions.exprs.rnd``: half away from zero on the binary value."""
    s = f"{float(10 ** d)!r}"
    return f"CAST(sign({expr}) * floor(abs({expr}) * {s} + 0.5) / {s} AS DOUBLE)"


def scorr(x: str, y: str) -> str:
    """Same as ``functions.exprs.safe_corr``: pairwise-complete, NULL for a constant side."""
    return (f"(covar_pop({x}, {y}) / nullif(stddev_pop(CASE WHEN {y} IS NOT NULL THEN {x} END) * "
            f"stddev_pop(CASE WHEN {x} IS NOT NULL THEN {y} END), 0))")


def sdiv(num: str, den: str) -> str:
    return f"(CASE WHEN coalesce({den}, 0) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END)"


CAMPAIGN = """
li AS (
  SELECT l_orderkey, count(*) AS n_lines, round(sum(l_quantity), 2) AS qty, round(avg(l_discount), 6) AS disc,
         round(sum(l_extendedprice), 2) AS gross, round(sum(l_extendedprice * (1 - l_discount)), 4) AS net,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS any_return
  FROM lineitem GROUP BY l_orderkey),
o AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS previous,
         lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_date
  FROM orders),
campaign AS (
  SELECT o.o_orderkey AS id,
    CAST(CASE WHEN o.o_totalprice > 300000 AND coalesce(li.any_return, 0) = 1 THEN 1 ELSE 0 END AS INTEGER) AS target,
    o.o_orderstatus AS status, c.c_mktsegment AS segment, r.r_name AS region, o.o_orderpriority AS priority,
    o.o_totalprice AS total_price, c.c_acctbal AS acct_bal, li.n_lines, li.qty, li.disc, li.gross, li.net,
    CAST(o.previous AS INTEGER) AS previous,
    CAST(CASE WHEN o.prev_date IS NULL THEN -1
              ELSE date_diff('day', o.prev_date, o.o_orderdate) END AS INTEGER) AS days_since,
    CAST(floor(o.o_totalprice / 500) AS DOUBLE) / CAST(1000 AS DOUBLE) AS score
  FROM o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey)"""

SPLIT = """
labelled AS (
  SELECT campaign.*, CASE WHEN row_number() OVER (PARTITION BY target ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id)
       <= (count(*) OVER (PARTITION BY target) * 20 + 99) // 100 THEN 'val' ELSE 'train' END AS split
  FROM campaign WHERE status <> 'P'),
frame AS (
  SELECT * FROM labelled
  UNION ALL BY NAME
  SELECT * REPLACE (CAST(NULL AS INTEGER) AS target), 'test' AS split FROM campaign WHERE status = 'P')"""

SCORES = """
scores AS (
  SELECT 'm1' AS model, split, id, target, CAST(score AS DOUBLE) AS proba FROM frame
  UNION ALL SELECT 'm2', split, id, target, CAST(1.0 AS DOUBLE) - score FROM frame
  UNION ALL SELECT 'm3', split, id, target, least(CAST(1.0 AS DOUBLE), coalesce(qty, CAST(0 AS DOUBLE)) / CAST(350 AS DOUBLE)) FROM frame
  UNION ALL SELECT 'm4', split, id, target, CAST(0.5 AS DOUBLE) FROM frame)"""

BASE = "WITH" + CAMPAIGN + "," + SPLIT + "," + SCORES


def with_base(*ctes: str) -> str:
    extra = "".join("," + c for c in ctes)
    return BASE + extra


HIST = """
hist AS (
  SELECT model, split, proba, CAST(sum(target) AS BIGINT) AS pos, CAST(sum(1 - target) AS BIGINT) AS neg
  FROM scores WHERE target IS NOT NULL GROUP BY model, split, proba),
roc AS (
  SELECT *, sum(pos) OVER w AS ct, sum(neg) OVER w AS cf,
         sum(pos) OVER (PARTITION BY model, split) AS n_pos, sum(neg) OVER (PARTITION BY model, split) AS n_neg
  FROM hist WINDOW w AS (PARTITION BY model, split ORDER BY proba DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _bin_expr(p: str) -> str:
    return "(" + " + ".join(f"(CASE WHEN {p} >= CAST({e!r} AS DOUBLE) THEN 1 ELSE 0 END)" for e in calibration_edges()) + ")"


ECE = f"""
cal AS (
  SELECT model, split, {_bin_expr('proba')} AS bin, sum(pos + neg) AS n,
         sum(proba * (pos + neg)) / sum(pos + neg) AS mean_proba, sum(pos) / sum(pos + neg) AS frac_positive
  FROM hist GROUP BY ALL),
ece AS (
  SELECT model, split, sum(n * abs(mean_proba - frac_positive)) / sum(n) AS ece FROM cal GROUP BY model, split)"""

RANK = """
rank_metrics AS (
  SELECT model, split, max(n_pos) AS n_pos, max(n_neg) AS n_neg,
    CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(neg * (ct - pos / 2.0)) / (max(n_pos) * max(n_neg)) END AS roc_auc,
    CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN greatest(max(ct / n_pos - cf / n_neg), 0.0) END AS ks_statistic,
    CASE WHEN max(n_pos) > 0 THEN sum(pos / n_pos * (ct / (ct + cf))) END AS pr_auc,
    sum(pos * pow(proba - 1.0, 2) + neg * pow(proba, 2)) / (max(n_pos) + max(n_neg)) AS brier_score
  FROM roc GROUP BY model, split)"""


def rates(tp: str, fp: str, fn: str, tn: str) -> dict[str, str]:
    n = f"({tp} + {fp} + {fn} + {tn})"
    sens = sdiv(tp, f"({tp} + {fn})")
    spec = sdiv(tn, f"({tn} + {fp})")
    return {
        "accuracy": r4(sdiv(f"({tp} + {tn})", n)),
        "precision": r4(sdiv(tp, f"({tp} + {fp})")),
        "recall": r4(sens),
        "specificity": r4(spec),
        "f1": r4(sdiv(f"2 * {tp}", f"(2 * {tp} + {fp} + {fn})")),
        "youden_index": r4(f"({sens} + {spec} - 1.0)"),
        "n_predicted_positive": f"CAST({tp} + {fp} AS BIGINT)",
        "positive_rate": r4(sdiv(f"({tp} + {fp})", n)),
    }


SWEEP = """
grid AS (SELECT CAST(k AS INTEGER) AS k, CAST(k AS DOUBLE) / 100.0 AS threshold FROM range(10, 91) t(k)),
sweep_counts AS (
  SELECT h.model, h.split, g.threshold,
         sum(CASE WHEN h.proba >= g.threshold THEN h.pos ELSE 0 END) AS tp,
         sum(CASE WHEN h.proba >= g.threshold THEN h.neg ELSE 0 END) AS fp,
         sum(CASE WHEN h.proba < g.threshold THEN h.pos ELSE 0 END) AS fn,
         sum(CASE WHEN h.proba < g.threshold THEN h.neg ELSE 0 END) AS tn
  FROM hist h, grid g GROUP BY h.model, h.split, g.threshold),
sweep AS (
  SELECT model, split, threshold, """ + ", ".join(f"{v} AS {k}" for k, v in rates("tp", "fp", "fn", "tn").items()) + """
  FROM sweep_counts)"""

BEST = """
band AS (
  SELECT *, max(youden_index) OVER (PARTITION BY model, split) AS best_youden FROM sweep),
cands AS (
  SELECT *, count(*) OVER (PARTITION BY model, split) AS n_candidates,
         row_number() OVER (PARTITION BY model, split ORDER BY accuracy DESC, threshold ASC) AS rk
  FROM band WHERE youden_index >= best_youden - 0.02),
best AS (
  SELECT model, split, threshold, youden_index, accuracy, best_youden, CAST(n_candidates AS BIGINT) AS n_candidates
  FROM cands WHERE rk = 1)"""

EVAL_COLUMNS = ("model, threshold, split, roc_auc, gini, ks_statistic, pr_auc, brier_score, ece, accuracy, precision, "
                "recall, f1, n_samples, n_positive, positive_rate")

_conf_rates = rates("tp", "fp", "fn", "tn")
EVAL = """
thr AS (SELECT model, threshold FROM best WHERE split = 'val'),
conf AS (
  SELECT h.model, h.split, t.threshold,
         sum(CASE WHEN h.proba >= t.threshold THEN h.pos ELSE 0 END) AS tp,
         sum(CASE WHEN h.proba >= t.threshold THEN h.neg ELSE 0 END) AS fp,
         sum(CASE WHEN h.proba < t.threshold THEN h.pos ELSE 0 END) AS fn,
         sum(CASE WHEN h.proba < t.threshold THEN h.neg ELSE 0 END) AS tn
  FROM hist h JOIN thr t USING (model) GROUP BY ALL),
perf AS (
  SELECT c.model, """ + r4("c.threshold") + """ AS threshold, c.split,
    """ + r4("m.roc_auc") + """ AS roc_auc, """ + r4("(m.roc_auc * 2.0 - 1.0)") + """ AS gini,
    """ + r4("m.ks_statistic") + """ AS ks_statistic, """ + r4("m.pr_auc") + """ AS pr_auc,
    """ + r4("m.brier_score") + """ AS brier_score, """ + r4("e.ece") + """ AS ece,
    """ + ", ".join(f"{_conf_rates[k]} AS {k}" for k in ("accuracy", "precision", "recall", "f1")) + """,
    CAST(tp + fp + fn + tn AS BIGINT) AS n_samples, CAST(tp + fp AS BIGINT) AS n_positive,
    """ + _conf_rates["positive_rate"] + """ AS positive_rate
  FROM conf c JOIN rank_metrics m USING (model, split) JOIN ece e USING (model, split)),
testrows AS (
  SELECT s.model, """ + r4("t.threshold") + """ AS threshold, 'test' AS split,
    CAST(NULL AS DOUBLE) AS roc_auc, CAST(NULL AS DOUBLE) AS gini, CAST(NULL AS DOUBLE) AS ks_statistic,
    CAST(NULL AS DOUBLE) AS pr_auc, CAST(NULL AS DOUBLE) AS brier_score, CAST(NULL AS DOUBLE) AS ece,
    CAST(NULL AS DOUBLE) AS accuracy, CAST(NULL AS DOUBLE) AS precision, CAST(NULL AS DOUBLE) AS recall,
    CAST(NULL AS DOUBLE) AS f1, CAST(count(*) AS BIGINT) AS n_samples,
    CAST(sum(CASE WHEN s.proba >= t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS n_positive,
    """ + r4(sdiv("sum(CASE WHEN s.proba >= t.threshold THEN 1 ELSE 0 END)", "count(*)")) + """ AS positive_rate
  FROM scores s JOIN thr t USING (model) WHERE s.split = 'test' GROUP BY s.model, t.threshold),
evaluation AS (
  SELECT """ + EVAL_COLUMNS + """ FROM perf UNION ALL SELECT """ + EVAL_COLUMNS + """ FROM testrows)"""


def metric_stack() -> str:
    """All metric CTEs over the scores table."""
    return with_base(HIST, ECE, RANK, SWEEP, BEST, EVAL)


# ── profiling (B) ─────────────────────────────────────────────────────────────────────────────────

PROFILE_NUMERIC = [("target", "int"), ("total_price", "double"), ("acct_bal", "double"), ("n_lines", "bigint"),
                   ("qty", "double"), ("disc", "double"), ("gross", "double"), ("net", "double"),
                   ("previous", "int"), ("days_since", "int"), ("score", "double")]
PROFILE_STRING = [("status", "string"), ("segment", "string"), ("region", "string"), ("priority", "string")]


def pct(part: str, whole: str, d: int = 2) -> str:
    return r4(f"CAST({part} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({whole} AS DOUBLE)", d)


def profile_numeric_sql(table: str = "campaign") -> str:
    parts = []
    for c, dt in PROFILE_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS feature, '{dt}' AS dtype, count(*) AS n_rows, count(DISTINCT {x}) AS n_unique,
  count(*) - count({x}) AS n_missing, {pct(f'count(*) - count({x})', 'count(*)')} AS pct_missing,
  CAST(sum(CASE WHEN {x} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zeros, {r4(f'avg({x})', 6)} AS mean,
  {r4(f'stddev_samp({x})', 6)} AS std, min({x}) AS min, {r4(f'quantile_cont({x}, 0.25)', 6)} AS q25,
  {r4(f'quantile_cont({x}, 0.5)', 6)} AS median, {r4(f'quantile_cont({x}, 0.75)', 6)} AS q75, max({x}) AS max,
  {r4(f'skewness({x})', 6)} AS skew FROM {table}""")
    return "\nUNION ALL\n".join(parts)


def _mode_cte(c: str, table: str) -> str:
    return (f"(SELECT {c} AS v, count(*) AS k FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY k DESC, v ASC LIMIT 1)")


def profile_categorical_sql(table: str = "campaign") -> str:
    parts = []
    for c, dt in PROFILE_STRING:
        parts.append(f"""SELECT '{c}' AS feature, '{dt}' AS dtype, (SELECT count(*) FROM {table}) AS n_rows,
  (SELECT count(DISTINCT {c}) FROM {table}) AS n_unique,
  (SELECT count(*) - count({c}) FROM {table}) AS n_missing,
  (SELECT {pct(f'count(*) - count({c})', 'count(*)')} FROM {table}) AS pct_missing,
  CAST(0 AS BIGINT) AS n_zeros, m.v AS top_value, CAST(m.k AS BIGINT) AS top_count,
  (SELECT {pct('m.k', 'count(*)')} FROM {table}) AS top_pct
  FROM {_mode_cte(c, table)} m""")
    return "\nUNION ALL\n".join(parts)


def describe_sql(table: str = "campaign") -> str:
    num = f"""SELECT feature, n_rows - n_missing AS count, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top,
  CAST(NULL AS BIGINT) AS freq, mean, std, min, q25 AS p25, median AS p50, q75 AS p75, max FROM ({profile_numeric_sql(table)})"""
    cat = f"""SELECT feature, n_rows - n_missing AS count, n_unique AS "unique", top_value AS top, top_count AS freq,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25,
  CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75, CAST(NULL AS DOUBLE) AS max FROM ({profile_categorical_sql(table)})"""
    return num + "\nUNION ALL\n" + cat


def missing_sql(cols: list[str], table: str = "campaign") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_missing, {pct(f'count(*) - count({c})', 'count(*)')} AS pct_missing FROM {table}"
        for c in cols)


def value_counts_sql(table: str = "campaign") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {c} AS value, count(*) AS count, {pct('count(*)', f'(SELECT count(*) FROM {table})')} AS pct "
        f"FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}" for c, _ in PROFILE_STRING)


def histogram_sql(bins: int = 40, table: str = "campaign") -> str:
    parts = []
    for c, _ in PROFILE_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS feature, g.bin, {r4(f'(r.lo + (r.hi - r.lo) * CAST(g.bin AS DOUBLE) / CAST({bins} AS DOUBLE))', 6)} AS bin_lo,
  {r4(f'(r.lo + (r.hi - r.lo) * CAST(g.bin + 1 AS DOUBLE) / CAST({bins} AS DOUBLE))', 6)} AS bin_hi,
  CAST(coalesce(cnt.n, 0) AS BIGINT) AS count
  FROM (SELECT min({x}) AS lo, max({x}) AS hi FROM {table}) r
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(0, {bins})) g
  LEFT JOIN (
    SELECT CAST(CASE WHEN r2.hi = r2.lo THEN 0 ELSE least(floor(({x} - r2.lo) * CAST({bins} AS DOUBLE) / (r2.hi - r2.lo)), {bins - 1}) END AS INTEGER) AS bin,
           count(*) AS n
    FROM {table}, (SELECT min({x}) AS lo, max({x}) AS hi FROM {table}) r2 WHERE {x} IS NOT NULL GROUP BY 1) cnt ON cnt.bin = g.bin
  WHERE r.lo IS NOT NULL""")
    return "\nUNION ALL\n".join(parts)


def corr_sql(table: str = "campaign") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {r4(scorr(f'CAST({c} AS DOUBLE)', 'CAST(target AS DOUBLE)'), 6)} AS corr FROM {table}"
        for c, _ in PROFILE_NUMERIC if c != "target")


def target_rate_sql(table: str = "campaign") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {c} AS value, {r4('avg(target)')} AS target_rate, count(*) AS count "
        f"FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}" for c, _ in PROFILE_STRING)


# ── evaluation tables (G) ─────────────────────────────────────────────────────────────────────────

LABELLED = ["roc_auc", "gini", "ks_statistic", "pr_auc", "accuracy", "precision", "recall", "f1"]
COUNTS = ["n_samples", "n_positive", "positive_rate"]


def pick(split: str, col: str) -> str:
    return f"max(CASE WHEN split = '{split}' THEN {col} END)"


def eval_wide_sql() -> str:
    cols = [f"{pick('val', 'threshold')} AS threshold"]
    for s, ms in (("val", LABELLED + COUNTS), ("train", LABELLED + COUNTS), ("test", COUNTS)):
        cols += [f"{pick(s, m)} AS {s}_{m}" for m in ms]
    return metric_stack() + ", wide AS (SELECT model, " + ", ".join(cols) + " FROM evaluation GROUP BY model)"


def run_metrics_sql() -> str:
    pairs = [("auc", "roc_auc"), ("accuracy", "accuracy"), ("precision", "precision"), ("recall", "recall"),
             ("ks", "ks_statistic"), ("gini", "gini"), ("brier", "brier_score"), ("ece", "ece")]
    cols = [f"{pick(s, src)} AS {s}_{short}" for short, src in pairs for s in ("val", "train")]
    return (metric_stack() + ", flat AS (SELECT model, " + ", ".join(cols) + " FROM evaluation GROUP BY model) "
            "SELECT f.*, " + r4("b.threshold") + " AS threshold, " + r4("b.youden_index") + " AS youden_index, "
            + r4("b.best_youden") + " AS best_youden, " + r4("(f.train_auc - f.val_auc)") + " AS overfit_gap_auc "
            "FROM flat f JOIN best b ON b.model = f.model AND b.split = 'val'")


def overfit_sql() -> str:
    gap = r4("(train_roc_auc - val_roc_auc)")
    return (eval_wide_sql() + " SELECT model, threshold, val_roc_auc, train_roc_auc, val_accuracy, train_accuracy, "
            f"{gap} AS auc_gap, {gap} > 0.02 AS overfit FROM wide")


def report_interleaved_sql() -> str:
    cols = ["model", "threshold"] + [f"{s}_{m}" for m in LABELLED for s in ("val", "train")]
    return eval_wide_sql() + " SELECT " + ", ".join(cols) + " FROM wide"


def best_model_cte() -> str:
    return """
bestm AS (
  SELECT model, threshold, roc_auc, accuracy FROM evaluation WHERE split = 'val'
  ORDER BY roc_auc DESC NULLS LAST, model ASC LIMIT 1)"""


def best_submission_sql() -> str:
    return (metric_stack() + "," + best_model_cte() +
            " SELECT s.id, CAST(s.proba >= b.threshold AS INTEGER) AS target FROM scores s JOIN bestm b USING (model) "
            "WHERE s.split = 'test'")


# ── feature engineering (C) ───────────────────────────────────────────────────────────────────────

DUMMIES = [("segment", "BUILDING", "segment_BUILDING"), ("segment", "FURNITURE", "segment_FURNITURE"),
           ("segment", "HOUSEHOLD", "segment_HOUSEHOLD"), ("segment", "MACHINERY", "segment_MACHINERY"),
           ("region", "AMERICA", "region_AMERICA"), ("region", "ASIA", "region_ASIA"),
           ("region", "EUROPE", "region_EUROPE"), ("region", "MIDDLE EAST", "region_MIDDLE_EAST")]
BASE_NUMERIC = ["priority", "total_price", "acct_bal", "n_lines", "qty", "disc", "gross", "net", "previous",
                "days_since", "had_prior_order"]
NUMERIC_COLUMNS = BASE_NUMERIC + [d[2] for d in DUMMIES]

ENG = """
eng AS (
  SELECT id, split, target, segment, region,
    CASE priority WHEN '1-URGENT' THEN CAST(0 AS DOUBLE) WHEN '2-HIGH' THEN CAST(1 AS DOUBLE)
                  WHEN '3-MEDIUM' THEN CAST(2 AS DOUBLE) WHEN '5-LOW' THEN CAST(3 AS DOUBLE) END AS priority,
    total_price, acct_bal, n_lines, qty, disc, gross, net, previous,
    CASE WHEN days_since <> -1 THEN days_since END AS days_since,
    CAST(CASE WHEN days_since <> -1 THEN 1 ELSE 0 END AS INTEGER) AS had_prior_order
  FROM frame),
num AS (
  SELECT id, split, target, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in BASE_NUMERIC) + ", " + ", ".join(
    f"CAST(coalesce({c} = '{lv}', false) AS DOUBLE) AS {name}" for c, lv, name in DUMMIES) + """ FROM eng),
med AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.5) FILTER (WHERE split = 'train') AS {c}" for c in NUMERIC_COLUMNS) + """ FROM num),
imp AS (SELECT n.id, n.split, n.target, """ + ", ".join(f"coalesce(n.{c}, m.{c}) AS {c}" for c in NUMERIC_COLUMNS) + """ FROM num n, med m),
sc AS (SELECT """ + ", ".join(
    f"avg({c}) FILTER (WHERE split = 'train') AS {c}__m, stddev_pop({c}) FILTER (WHERE split = 'train') AS {c}__s"
    for c in NUMERIC_COLUMNS) + """ FROM imp),
scaled AS (SELECT i.id, i.split, i.target, """ + ", ".join(
    f"(i.{c} - s.{c}__m) / (CASE WHEN coalesce(s.{c}__s, 0) = 0 THEN 1.0 ELSE s.{c}__s END) AS {c}"
    for c in NUMERIC_COLUMNS) + """ FROM imp i, sc s)"""


def features_sql(select: str) -> str:
    return with_base(ENG) + " " + select


def round_cols(cols: list[str], d: int = 6, prefix: str = "") -> str:
    return ", ".join(f"{r4(prefix + c, d)} AS {c}" for c in cols)


def preprocess_report_sql() -> str:
    parts = ["SELECT 'days_since' AS feature, 'sentinel_to_null' AS transformation, 'n_sentinel_replaced' AS stat, "
             "CAST(sum(CASE WHEN days_since = -1 THEN 1 ELSE 0 END) AS DOUBLE) AS value FROM frame WHERE split = 'train'",
             "SELECT 'priority', 'ordinal_encode', 'n_unknown_to_null', CAST(sum(CASE WHEN priority IS NOT NULL AND priority "
             "NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') THEN 1 ELSE 0 END) AS DOUBLE) FROM frame WHERE split = 'train'",
             "SELECT 'segment', 'one_hot_drop_first', 'n_levels', CAST(count(DISTINCT segment) AS DOUBLE) FROM frame WHERE split = 'train'",
             "SELECT 'region', 'one_hot_drop_first', 'n_levels', CAST(count(DISTINCT region) AS DOUBLE) FROM frame WHERE split = 'train'"]
    for c in NUMERIC_COLUMNS:
        if c in BASE_NUMERIC:
            parts.append(f"SELECT '{c}', 'median_impute', 'median', {r4(c, 6)} FROM med")
        parts.append(f"SELECT '{c}', 'standard_scale', 'mean', {r4(c + '__m', 6)} FROM sc")
        parts.append(f"SELECT '{c}', 'standard_scale', 'std', {r4(f'(CASE WHEN coalesce({c}__s, 0) = 0 THEN 1.0 ELSE {c}__s END)', 6)} FROM sc")
    return features_sql("SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ")")


# ── feature selection (D) ─────────────────────────────────────────────────────────────────────────

POSITIONS = "positions AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', {i})" for i, c in enumerate(NUMERIC_COLUMNS)) + ") t(feature, position))"

SEL = """
trn AS (SELECT * FROM imp WHERE split = 'train'),
""" + POSITIONS + """,
rk AS (SELECT id, """ + ", ".join(
    f"CAST(rank() OVER (ORDER BY {c}) AS DOUBLE) + (CAST(count(*) OVER (PARTITION BY {c}) AS DOUBLE) - 1) / 2.0 AS {c}"
    for c in NUMERIC_COLUMNS) + """ FROM trn),
ml AS (SELECT feature, value, target FROM (SELECT target, """ + ", ".join(NUMERIC_COLUMNS) + """ FROM trn)
       UNPIVOT (value FOR feature IN (""" + ", ".join(NUMERIC_COLUMNS) + """))),
vc AS (SELECT feature, value, count(*) AS cnt FROM ml GROUP BY feature, value),
vr AS (SELECT *, sum(cnt) OVER (PARTITION BY feature ORDER BY value) - cnt AS below,
              count(*) OVER (PARTITION BY feature) AS nd, sum(cnt) OVER (PARTITION BY feature) AS n FROM vc),
vb AS (SELECT feature, value, CASE WHEN nd <= 32 THEN value ELSE CAST(floor(below * 32 / n) AS DOUBLE) END AS bin FROM vr),
cell AS (SELECT m.feature, b.bin, m.target, count(*) AS n_by FROM ml m JOIN vb b USING (feature, value) GROUP BY ALL),
cell2 AS (SELECT *, sum(n_by) OVER (PARTITION BY feature, bin) AS n_b, sum(n_by) OVER (PARTITION BY feature, target) AS n_y,
                 sum(n_by) OVER (PARTITION BY feature) AS n FROM cell),
mi AS (SELECT p.feature, p.position, greatest(coalesce(x.mi, 0.0), 0.0) AS mi FROM positions p LEFT JOIN (
         SELECT feature, sum(CAST(n_by AS DOUBLE) / CAST(n AS DOUBLE) * ln(CAST(n_by AS DOUBLE) * CAST(n AS DOUBLE)
                / (CAST(n_b AS DOUBLE) * CAST(n_y AS DOUBLE)))) AS mi FROM cell2 GROUP BY feature) x USING (feature)),
mi6 AS (SELECT feature, position, """ + r4("mi", 6) + """ AS mi6 FROM mi),
sp AS (""" + "\nUNION ALL ".join(
    f"SELECT '{NUMERIC_COLUMNS[i]}' AS a, '{NUMERIC_COLUMNS[j]}' AS b, {i} AS pos_a, {j} AS pos_b, "
    f"{scorr(NUMERIC_COLUMNS[i], NUMERIC_COLUMNS[j])} AS corr FROM rk"
    for j in range(len(NUMERIC_COLUMNS)) for i in range(j)) + """),
cand AS (SELECT row_number() OVER (ORDER BY s.pos_b, s.pos_a) AS step, s.a, s.b, ma.mi6 AS mi_a, mb.mi6 AS mi_b
         FROM sp s JOIN mi6 ma ON ma.feature = s.a JOIN mi6 mb ON mb.feature = s.b WHERE abs(s.corr) > 0.9),
walk(step, dropped) AS (
  SELECT 0, CAST([] AS VARCHAR[])
  UNION ALL
  SELECT w.step + 1, CASE WHEN list_contains(w.dropped, c.a) OR list_contains(w.dropped, c.b) THEN w.dropped
                          WHEN c.mi_b >= c.mi_a THEN list_append(w.dropped, c.a) ELSE list_append(w.dropped, c.b) END
  FROM walk w JOIN cand c ON c.step = w.step + 1),
s2 AS (SELECT p.feature, p.position, NOT list_contains((SELECT dropped FROM walk ORDER BY step DESC LIMIT 1), p.feature) AS kept
       FROM positions p),
s3 AS (SELECT m.feature FROM mi6 m JOIN s2 USING (feature) WHERE s2.kept ORDER BY m.mi6 DESC, m.position ASC LIMIT 12),
both_pairs AS (SELECT a AS feature, b AS partner, pos_b AS ppos, abs(corr) AS c FROM sp
               UNION ALL SELECT b, a, pos_a, abs(corr) FROM sp),
bestp AS (SELECT feature, partner, c FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY c DESC, ppos ASC) AS r
          FROM both_pairs WHERE c IS NOT NULL) WHERE r = 1)"""


def selection_sql(select: str) -> str:
    return with_base(ENG, SEL).replace("WITH", "WITH RECURSIVE", 1) + " " + select


def _psi(x: str) -> str:
    y = f"(CAST({x} AS DOUBLE) + 6.0)"
    return (f"(ln({y}) - 1.0 / (2.0 * {y}) - 1.0 / (12.0 * {y} * {y}) + 1.0 / (120.0 * pow({y}, 4)) - 1.0 / (252.0 * pow({y}, 6))"
            + "".join(f" - 1.0 / (CAST({x} AS DOUBLE) + {i}.0)" for i in range(6)) + ")")


def knn_mi_sql(k: int = 3) -> str:
    """Every row's distance list from its k rows before and after in its class, interval counts by ASOF joins."""
    dist = ", ".join(f"value - lag(value, {i}) OVER w, lead(value, {i}) OVER w - value" for i in range(1, k + 1))
    return selection_sql(f"""
, kd AS (SELECT feature, value, target, nc, least({k}, nc - 1) AS kk, list_sort(list_filter(ds, lambda x: x IS NOT NULL))[least({k}, nc - 1)] AS r
         FROM (SELECT feature, value, target, count(*) OVER (PARTITION BY feature, target) AS nc, [{dist}] AS ds
               FROM ml WINDOW w AS (PARTITION BY feature, target ORDER BY value)) WHERE nc > 1),
kc AS (SELECT feature, value, count(*) AS cnt FROM kd GROUP BY feature, value),
kr AS (SELECT *, sum(cnt) OVER (PARTITION BY feature ORDER BY value) AS upto FROM kc),
kh AS (SELECT d.*, coalesce(h.upto, 0) AS n_hi FROM (SELECT *, value + r AS hi, value - r AS lo FROM kd) d
       ASOF LEFT JOIN kr h ON h.feature = d.feature AND d.hi > h.value),
kl AS (SELECT d.*, coalesce(l.upto, 0) AS n_lo FROM kh d ASOF LEFT JOIN kr l ON l.feature = d.feature AND d.lo >= l.value),
km AS (SELECT d.feature, d.nc, d.kk, CASE WHEN d.r = 0 THEN c.cnt ELSE d.n_hi - d.n_lo END AS m FROM kl d JOIN kc c USING (feature, value)),
kmi AS (SELECT feature, {_psi('count(*)')} + sum({_psi('kk')} - {_psi('nc')} - {_psi('m')}) / count(*) AS mi FROM km GROUP BY feature)
SELECT p.feature, p.position, {r4('greatest(coalesce(x.mi, 0.0), 0.0)', 6)} AS mi FROM positions p LEFT JOIN kmi x USING (feature)""")


_ISOTONIC = """
ih AS (SELECT model, proba, pos, pos + neg AS n, row_number() OVER w AS i, sum(pos) OVER w AS cp, sum(pos + neg) OVER w AS cn
       FROM (SELECT model, proba, CAST(sum(target) AS BIGINT) AS pos, CAST(sum(1 - target) AS BIGINT) AS neg
             FROM scores WHERE split = 'val' AND target IS NOT NULL GROUP BY model, proba) WINDOW w AS (PARTITION BY model ORDER BY proba)),
im AS (SELECT x.model, x.i AS a, y.i AS b, min(CAST(y.cp - x.cp + x.pos AS DOUBLE) / CAST(y.cn - x.cn + x.n AS DOUBLE)) OVER (
         PARTITION BY x.model, x.i ORDER BY y.i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS m
       FROM ih x JOIN ih y ON y.model = x.model AND y.i >= x.i),
iv AS (SELECT model, b AS i, max(m) AS v FROM im GROUP BY model, b),
ik AS (SELECT ih.*, v, lead(proba) OVER w AS np, lead(v) OVER w AS nv, first_value(v) OVER w AS v0
       FROM ih JOIN iv USING (model, i) WINDOW w AS (PARTITION BY model ORDER BY i))"""


def isotonic_sql() -> str:
    """Largest over the starts before it of the smallest mean to an end after it, then straight lines between scores."""
    value = "CASE WHEN k.i IS NULL THEN f.v WHEN s.proba = k.proba OR k.np IS NULL THEN k.v " \
            "ELSE k.v + (k.nv - k.v) * ((s.proba - k.proba) / (k.np - k.proba)) END"
    return with_base(_ISOTONIC) + f""" SELECT s.model || '_isotonic' AS model, s.split, s.id, s.target, {r4(value, 6)} AS proba
FROM scores s ASOF LEFT JOIN ik k ON s.model = k.model AND s.proba >= k.proba
LEFT JOIN (SELECT model, v FROM ik WHERE i = 1) f ON f.model = s.model"""


def isotonic_blocks_sql() -> str:
    return with_base(_ISOTONIC) + f""" SELECT model, row_number() OVER (PARTITION BY model ORDER BY min(proba)) AS block, min(proba) AS lo, max(proba) AS hi,
  CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(n) AS BIGINT) AS n, {r4('v', 6)} AS rate FROM ik GROUP BY model, v"""


def selection_report_sql() -> str:
    return selection_sql("""
SELECT p.feature, CAST(0.0 AS DOUBLE) AS missing_pct, """ + r4("m.mi") + """ AS mi_score,
  coalesce(""" + r4("b.c") + """, 0.0) AS max_corr_with_other, coalesce(b.partner, '') AS max_corr_partner,
  TRUE AS stage1_missing, s2.kept AS stage2_correlation, s3.feature IS NOT NULL AS stage3_mi,
  s3.feature IS NOT NULL AS stage4_pfi,
  CASE WHEN NOT s2.kept THEN 'stage2_correlation' WHEN s3.feature IS NULL THEN 'stage3_mi' ELSE 'selected' END AS dropped_at,
  CASE WHEN NOT s2.kept THEN 'spearman corr with ' || b.partner WHEN s3.feature IS NULL THEN 'mi below top-k' ELSE '' END AS drop_reason,
  s3.feature IS NOT NULL AS selected
FROM positions p JOIN mi m USING (feature) JOIN s2 USING (feature) LEFT JOIN bestp b USING (feature)
LEFT JOIN s3 USING (feature)""")


# ── runs (A4–A7, G5, G6, G10–G13) and chart tables (H) ───────────────────────────────────────────

def runs_values(runs: list[tuple[str, str, str]]) -> str:
    return "runs AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in runs) + \
           ") t(run_id, model, threshold_split))"


def run_stack(runs: list[tuple[str, str, str]]) -> str:
    """Metric CTEs plus per-run thresholds and evaluation rows."""
    return metric_stack() + "," + runs_values(runs) + """,
rbest AS (SELECT r.run_id, b.model, b.threshold, b.youden_index, b.best_youden
          FROM best b JOIN runs r ON r.model = b.model AND r.threshold_split = b.split),
rconf AS (
  SELECT t.run_id, h.model, h.split, t.threshold,
         sum(CASE WHEN h.proba >= t.threshold THEN h.pos ELSE 0 END) AS tp,
         sum(CASE WHEN h.proba >= t.threshold THEN h.neg ELSE 0 END) AS fp,
         sum(CASE WHEN h.proba < t.threshold THEN h.pos ELSE 0 END) AS fn,
         sum(CASE WHEN h.proba < t.threshold THEN h.neg ELSE 0 END) AS tn
  FROM hist h JOIN rbest t USING (model) GROUP BY ALL),
rperf AS (
  SELECT c.run_id, c.model, """ + r4("c.threshold") + """ AS threshold, c.split,
    """ + r4("m.roc_auc") + """ AS roc_auc, """ + r4("(m.roc_auc * 2.0 - 1.0)") + """ AS gini,
    """ + r4("m.ks_statistic") + """ AS ks_statistic, """ + r4("m.pr_auc") + """ AS pr_auc,
    """ + r4("m.brier_score") + """ AS brier_score, """ + r4("e.ece") + """ AS ece,
    """ + ", ".join(f"{_conf_rates[k]} AS {k}" for k in ("accuracy", "precision", "recall", "f1")) + """,
    CAST(tp + fp + fn + tn AS BIGINT) AS n_samples, CAST(tp + fp AS BIGINT) AS n_positive,
    """ + _conf_rates["positive_rate"] + """ AS positive_rate
  FROM rconf c JOIN rank_metrics m USING (model, split) JOIN ece e USING (model, split)),
rtest AS (
  SELECT t.run_id, s.model, """ + r4("t.threshold") + """ AS threshold, 'test' AS split,
    CAST(NULL AS DOUBLE) AS roc_auc, CAST(NULL AS DOUBLE) AS gini, CAST(NULL AS DOUBLE) AS ks_statistic,
    CAST(NULL AS DOUBLE) AS pr_auc, CAST(NULL AS DOUBLE) AS brier_score, CAST(NULL AS DOUBLE) AS ece,
    CAST(NULL AS DOUBLE) AS accuracy, CAST(NULL AS DOUBLE) AS precision, CAST(NULL AS DOUBLE) AS recall,
    CAST(NULL AS DOUBLE) AS f1, CAST(count(*) AS BIGINT) AS n_samples,
    CAST(sum(CASE WHEN s.proba >= t.threshold THEN 1 ELSE 0 END) AS BIGINT) AS n_positive,
    """ + r4(sdiv("sum(CASE WHEN s.proba >= t.threshold THEN 1 ELSE 0 END)", "count(*)")) + """ AS positive_rate
  FROM scores s JOIN rbest t USING (model) WHERE s.split = 'test' GROUP BY t.run_id, s.model, t.threshold),
reval AS (SELECT run_id, """ + EVAL_COLUMNS + """ FROM rperf UNION ALL SELECT run_id, """ + EVAL_COLUMNS + """ FROM rtest),
rflat AS (SELECT run_id, """ + ", ".join(
        f"{pick(s, src)} AS {s}_{short}" for short, src in
        [("auc", "roc_auc"), ("accuracy", "accuracy"), ("precision", "precision"), ("recall", "recall"),
         ("ks", "ks_statistic"), ("gini", "gini"), ("brier", "brier_score"), ("ece", "ece")]
        for s in ("val", "train")) + """ FROM reval GROUP BY run_id),
rmetrics AS (SELECT f.*, """ + r4("b.threshold") + " AS threshold, " + r4("b.youden_index") + " AS youden_index, " \
        + r4("b.best_youden") + " AS best_youden, " + r4("(f.train_auc - f.val_auc)") + """ AS overfit_gap_auc
  FROM rflat f JOIN rbest b USING (run_id))"""


RUN_METRIC_KEYS = sorted([f"{s}_{m}" for m in ("auc", "accuracy", "precision", "recall", "ks", "gini", "brier", "ece")
                          for s in ("val", "train")] + ["threshold", "youden_index", "best_youden", "overfit_gap_auc"])


def runs_flat_sql(runs) -> str:
    return run_stack(runs) + """
SELECT m.run_id, r.model AS run_name, substr(m.run_id, 1, 15) AS ts, 'accuracy' AS param_secondary_metric,
  r.threshold_split AS param_threshold_split, '0.02' AS param_tolerance, """ + ", ".join(f"m.{k}" for k in RUN_METRIC_KEYS) + """
FROM rmetrics m JOIN runs r USING (run_id)"""


def runs_comparison_sql(runs) -> str:
    return run_stack(runs) + """
SELECT m.run_id, r.model AS run_name, val_auc, train_auc, val_accuracy, train_accuracy, overfit_gap_auc, threshold
FROM rmetrics m JOIN runs r USING (run_id)"""


def eval_latest_sql(runs) -> str:
    cols = [f"{pick('val', 'threshold')} AS threshold"]
    for s, ms in (("val", LABELLED + COUNTS), ("train", LABELLED + COUNTS), ("test", COUNTS)):
        cols += [f"{pick(s, m)} AS {s}_{m}" for m in ms]
    return run_stack(runs) + """,
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, split ORDER BY run_id DESC) AS rn FROM reval) WHERE rn = 1)
SELECT model, """ + ", ".join(cols) + " FROM latest GROUP BY model"


def combined_roc_sql(runs) -> str:
    return run_stack(runs) + """,
lr AS (SELECT model, max(run_id) AS run_id FROM runs GROUP BY model),
pts AS (SELECT model, proba AS threshold, """ + r4(sdiv("cf", "n_neg"), 8) + " AS fpr, " + r4(sdiv("ct", "n_pos"), 8) + """ AS tpr
        FROM roc WHERE split = 'val'
        UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM hist WHERE split = 'val')
SELECT lr.run_id, p.model, p.threshold, p.fpr, p.tpr, """ + r4("m.roc_auc") + """ AS roc_auc
FROM pts p JOIN lr USING (model) JOIN rank_metrics m ON m.model = p.model AND m.split = 'val'"""


IMPORTANCE_FEATURES = ["total_price", "acct_bal", "n_lines", "qty", "disc", "gross", "net", "previous", "days_since"]


def importance_sql(runs) -> str:
    return run_stack(runs) + """,
vj AS (SELECT r.run_id, s.proba, """ + ", ".join(f"c.{f}" for f in IMPORTANCE_FEATURES) + """
       FROM scores s JOIN runs r USING (model) JOIN campaign c USING (id) WHERE s.split = 'val'),
imp_long AS (SELECT * FROM (SELECT run_id, """ + ", ".join(
        f"abs({scorr(f'CAST({f} AS DOUBLE)', 'proba')}) AS {f}" for f in IMPORTANCE_FEATURES) + """ FROM vj GROUP BY run_id)
    UNPIVOT (imp FOR feature IN (""" + ", ".join(IMPORTANCE_FEATURES) + """))),
imp_f AS (SELECT * FROM imp_long WHERE imp IS NOT NULL),
imp AS (SELECT run_id, feature, """ + r4("imp / sum(imp) OVER (PARTITION BY run_id) * 100.0") + """ AS importance_pct FROM imp_f)"""


def importance_across_sql(runs) -> str:
    ids = sorted(r[0] for r in runs)
    return importance_sql(runs) + " SELECT feature, " + ", ".join(
        f"coalesce(max(CASE WHEN run_id = '{i}' THEN importance_pct END), 0.0) AS \"{i}\"" for i in ids) + \
        " FROM imp GROUP BY feature"


HISTORY = """
hpath AS (
  SELECT h.model, h.split, g.iteration, h.pos, h.neg,
         least(greatest(0.5 + (h.proba - 0.5) * CAST(g.iteration AS DOUBLE) / 10.0, 0.001), 0.999) AS p
  FROM hist h, (SELECT CAST(range AS INTEGER) AS iteration FROM range(1, 21)) g WHERE h.split <> 'test'),
hagg AS (
  SELECT model, split, iteration,
         -sum(pos * ln(p) + neg * ln(1 - p)) / sum(pos + neg) AS logloss,
         sum(CASE WHEN p >= 0.5 THEN neg ELSE pos END) / sum(pos + neg) AS error
  FROM hpath GROUP BY model, split, iteration),
history AS (
  SELECT model, iteration, split, 'logloss' AS metric, """ + r4("logloss", 6) + """ AS value FROM hagg
  UNION ALL SELECT model, iteration, split, 'error', """ + r4("error", 6) + """ FROM hagg)"""


def history_sql(select: str) -> str:
    return metric_stack() + "," + HISTORY + " " + select
