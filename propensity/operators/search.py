"""Hyper-parameter search (E8–E12) and permutation importance.

Trials are drawn from a declared space in batches (``operators.study``). Boosting trials of a batch share their passes
over the rows; others run as concurrent Spark jobs from a thread pool, measured by the metric operators.
"""
from __future__ import annotations

import math
import random
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions.order import hash_bucket, row_number_within
from propensity.operators import boosting as bo
from propensity.operators import metrics as mx
from propensity.operators import models as md
from propensity.operators import study
from propensity.operators.features import Preprocessor, stratified_kfold
from propensity.session import materialize

OVERFIT_PENALTY = 0.5
FOLDS_AT_ONCE = 2  # fixed value: an iteration's driver side leaves slots free; each fit keeps its fold's rows in memory
BASELINE_TREES = 200  # fixed value: trees of the permutation-importance baseline

# Search ranges, ("int", low, high, step) | ("float", low, high, log) | ("choice", options); a last entry
# {parameter: value} makes the parameter conditional.
SPACES = {
    "gbt_leafwise": {"n_estimators": ("int", 100, 2000, 50), "learning_rate": ("float", 1e-3, 0.3, True),
                     "num_leaves": ("int", 20, 300, 10), "min_child_samples": ("int", 10, 200, 10),
                     "feature_fraction": ("float", 0.4, 1.0, False), "bagging_fraction": ("float", 0.4, 1.0, False),
                     "bagging_freq": ("int", 1, 10, 1), "reg_alpha": ("float", 1e-8, 10.0, True), "reg_lambda": ("float", 1e-8, 10.0, True)},
    "gbt_depthwise": {"n_estimators": ("int", 100, 2000, 50), "max_depth": ("int", 3, 10, 1), "eta": ("float", 1e-3, 0.3, True),
                      "subsample": ("float", 0.4, 1.0, False), "colsample_bytree": ("float", 0.3, 1.0, False),
                      "min_child_weight": ("int", 1, 50, 1), "reg_alpha": ("float", 1e-8, 10.0, True),
                      "reg_lambda": ("float", 1e-8, 10.0, True)},
    "mlp": {"n_layers": ("int", 1, 3, 1), "hidden_size": ("choice", [64, 128, 256]), "step_size": ("float", 1e-4, 1e-2, True)},
    "svc_linear": {"C": ("float", 1e-2, 100.0, True)},
    "svc_poly": {"C": ("float", 1e-2, 100.0, True), "degree": ("int", 2, 5, 1)},
    "svc_rff": {"C": ("float", 1e-2, 100.0, True), "kernel": ("choice", ["rbf", "matern", "rq"]),
                "length_scale": ("float", 0.5, 5.0, True)},
    "rff_logistic": {"kernel": ("choice", ["rbf", "matern", "rq"]), "length_scale": ("float", 0.5, 5.0, True),
                     "reg": ("float", 1e-4, 1e-1, True)},
}


def objective(val_auc: float, train_auc: float, penalty: float = OVERFIT_PENALTY) -> float:
    """Validation AUC minus half the positive train-validation gap."""
    return val_auc - penalty * max(0.0, train_auc - val_auc)


def auc_by_split(scores: DataFrame) -> dict[str, float]:
    hist = mx.score_histogram(scores, ["split"])
    return {r["split"]: r["roc_auc"] for r in mx.ranking_metrics(hist, ["split"]).select("split", "roc_auc").collect()}


def evaluate_trial(name: str, pre: Preprocessor | md.ScaledRows, train: DataFrame, val: DataFrame, params: dict,
                   columns: Sequence[str] | None = None) -> tuple[float, dict]:
    """One trial: fit (a boosting model stops early on the validation rows) and measure both splits. The scaled rows of a
    search stand for the preprocessing that gives them."""
    if isinstance(pre, md.ScaledRows):
        rows, held, cols = pre.rows()
        aucs = auc_by_split(md.fit_scaled(name, params, rows, cols, held, columns=columns).score_scaled(rows.unionByName(held)))
    else:
        fitted = md.fit_model(name, pre, train, params, early_stop=val, columns=columns)
        aucs = auc_by_split(fitted.score(pre, train.unionByName(val)))
    return objective(aucs["val"], aucs["train"]), aucs


def cv_objective(name: str, pre: Preprocessor, labelled: DataFrame, params: dict, k: int = 5,
                 parallelism: int = FOLDS_AT_ONCE) -> tuple[float, list[dict]]:
    """Folds over train+val (``fold`` column, written once); mean validation AUC minus the penalty on the *mean* gap.
    Folds are fitted and measured as concurrent jobs, ``parallelism`` at once."""
    folds = materialize(stratified_kfold(labelled, k))

    def measure(f: int) -> dict:
        tr = folds.filter(F.col("fold") != f).drop("fold").withColumn("split", F.lit("train"))
        va = folds.filter(F.col("fold") == f).drop("fold").withColumn("split", F.lit("val"))
        fitted = md.fit_model(name, pre, tr, params, early_stop=va)
        aucs = auc_by_split(fitted.score(pre, tr.unionByName(va)))
        return {"fold": f, "val_auc": aucs["val"], "train_auc": aucs["train"]}

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        per = list(pool.map(measure, range(k)))
    mv = sum(p["val_auc"] for p in per) / k
    mt = sum(p["train_auc"] for p in per) / k
    return mv - OVERFIT_PENALTY * max(0.0, mt - mv), per


TRIALS = "number int, value double, datetime_start timestamp, datetime_complete timestamp, duration double, params map<string,string>, state string"
BATCH = 10  # trials drawn and run together; the sampler's first draws (STARTUP) make one batch


def _run_boosting(name: str, coded: DataFrame, bins, drawn: Sequence[dict], record) -> None:
    """Trials of a boosting trainer side by side; AUCs by ``boosting.FINE_STEPS`` score steps of the rounds kept."""
    start = time.time()

    def finished(i: int, model) -> None:
        value = None if model.aucs.get("val") is None else objective(model.aucs["val"], model.aucs["train"])
        record(i, value, start, None if value is not None else ValueError("a split has one class only"))

    bo.fit_many(coded, bins, [md.boosting_params(name, d) for d in drawn], finished=finished)


def search(name: str, pre: Preprocessor, train: DataFrame, val: DataFrame, n_trials: int = 30, seed: int = 42, parallelism: int = 4,
           columns: Sequence[str] | None = None, path: str | None = None, sampler=None, batch: int = BATCH) -> tuple[dict, DataFrame]:
    """Trials drawn by ``sampler`` (tree-structured Parzen densities by default) in batches; returns the best
    parameters and the trials table ``(number, value, datetime_start, datetime_complete, duration, params, state)``.

    Boosting trials of a batch share their passes over the rows, others run as concurrent jobs on scaled rows that are
    written once. With ``path`` every
    trial is appended to the study table there as its batch ends, and a study found there goes on where it stopped:
    draws depend on the seed, the trial's number and the trials before its batch only. A trial that fails is recorded
    as such and the study goes on; a study without any complete trial raises the first failure."""
    spark = train.sparkSession
    sampler = sampler or study.Parzen(SPACES[name], seed)
    done: list[study.Trial] = study.load(spark, path) if path else []
    rows = [t.row() for t in done[:n_trials]]
    failures: list[Exception] = []
    prepared, scaled = None, md.ScaledRows(pre, train, val, columns)
    while len(done) < n_trials:
        first = len(done) - len(done) % batch  # a batch that was cut off is drawn as it was
        drawn = sampler.draw(done[:first], first, min(batch, n_trials - first))[len(done) - first:]
        got: dict[int, study.Trial] = {}
        base = len(done)

        def record(i: int, value: float | None, start: float, failure: Exception | None = None) -> None:
            if failure is not None:
                failures.append(failure)
            got[i] = study.Trial(base + i, drawn[i], value, start, time.time())

        if md.TRAINERS[name].variant == "tree":
            prepared = prepared or md.coded_input(pre, train, val, columns)
            _run_boosting(name, *prepared, drawn, record)
        else:
            def run(i: int) -> None:
                start = time.time()
                try:
                    record(i, evaluate_trial(name, scaled, train, val, drawn[i], columns)[0], start)
                except Exception as e:  # noqa: BLE001 - recorded in the table, raised below if nothing worked
                    record(i, None, start, e)

            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                list(pool.map(run, range(len(drawn))))
        new = [got[i] for i in range(len(drawn))]
        if path:
            study.append(spark, path, new)
        done += new
        rows += [t.row() for t in new]
    complete = [t for t in done[:n_trials] if t.value is not None]
    if not complete:
        raise RuntimeError(f"all {n_trials} trials of {name} failed") from (failures[0] if failures else None)
    best = max(complete, key=lambda t: (t.value, -t.number))
    return best.params, spark.createDataFrame(rows, TRIALS)


def random_search(name: str, pre: Preprocessor, train: DataFrame, val: DataFrame, n_trials: int = 30, seed: int = 42,
                  parallelism: int = 4, columns: Sequence[str] | None = None) -> tuple[dict, DataFrame]:
    """A search by independent seeded draws, all in one batch."""
    return search(name, pre, train, val, n_trials, seed, parallelism, columns, sampler=study.Independent(SPACES[name], seed), batch=n_trials)


# ── permutation importance (D6, D7) ───────────────────────────────────────────────────────────────

BASELINE = bo.Params(BASELINE_TREES, 0.1, max_depth=4, lam=1.0, patience=None)


def _steps(n: int, repeats: int, seed: int) -> list[tuple[int, int]]:
    """One affine permutation ``(a * i + b) mod n`` of 0 … n-1 per repeat (a coprime to n, not 1 where possible)."""
    rng, out = random.Random(seed), []
    while len(out) < repeats:
        a, b = rng.randrange(1, max(2, n)), rng.randrange(max(1, n))
        if math.gcd(a, n) == 1 and (a != 1 or n < 4):
            out.append((a, b))
    return out


_COUNTS = "repeat int, column int, step int, pos long, neg long"


def permuted_scores(ranked: DataFrame, model: bo.BoostedModel, n: int, repeats: int, seed: int) -> DataFrame:
    """(repeat, column, step, pos, neg): rows by target and score step when a column's values come from other rows.

    ``ranked`` holds (key, target, codes) with the ranks 1 to ``n`` as keys. Repeat k gives the row at rank i the values
    of rank ``(a_k * i + b_k) mod n``: one join brings the partner's codes, and every column is swapped in turn inside
    the batch. Repeat -1 are the rows as they are."""
    steps = F.array(*[F.struct(F.lit(k).alias("repeat"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                      for k, (a, b) in enumerate(_steps(n, repeats, seed))])
    asked = ranked.select("key", "target", "codes", F.inline(steps)).withColumn("_from", (F.col("a") * (F.col("key") - 1) + F.col("b")) % F.lit(n) + 1)
    paired = asked.join(ranked.select(F.col("key").alias("_from"), F.col("codes").alias("other")), "_from").select("repeat", "target", "codes", "other")
    width = len(model.bins.columns)
    uses = [[bool((t.feature == c).any()) for t in model.trees] for c in range(width)]
    schema = pa.schema([("repeat", pa.int32()), ("column", pa.int32()), ("step", pa.int32()), ("pos", pa.int64()), ("neg", pa.int64())])

    def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeat, target = (batch.column(c).to_numpy().astype(np.int64) for c in ("repeat", "target"))
            codes, other = matrix(batch, "codes"), matrix(batch, "other")
            base = model.parts(codes)
            margins = model.total(base, len(codes))
            places = [(np.where(repeat == 0, -1, -2), -1, margins)]  # the rows as they are, once
            for c in range(width):
                moved = np.flatnonzero(codes[:, c] != other[:, c])
                margin = margins.copy()
                if len(moved) and any(uses[c]):
                    changed = codes[moved].copy()
                    changed[:, c] = other[moved, c]
                    # only trees that split on the column can change
                    margin[moved] = model.total((t.value[t.leaves(changed)] if own else part[moved] for t, own, part in zip(model.trees, uses[c], base)), len(moved))
                places.append((repeat, c, margin))
            for own, c, margin in places:
                step = np.minimum((bo.FINE_STEPS / (1 + np.exp(-margin))).astype(np.int64), bo.FINE_STEPS - 1)
                kept = own >= -1
                cells, n_rows = np.unique((own[kept] + 1) * (2 * bo.FINE_STEPS) + 2 * step[kept] + target[kept], return_counts=True)
                cells = np.stack([cells // (2 * bo.FINE_STEPS) - 1, cells // 2 % bo.FINE_STEPS, cells % 2])
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in (
                    (cells[0], np.int32), (np.full(len(n_rows), c), np.int32), (cells[1], np.int32), (n_rows * cells[2], np.int64), (n_rows * (1 - cells[2]), np.int64))], schema=schema)

    return paired.mapInArrow(count, _COUNTS).groupBy("repeat", "column", "step").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def permutation_importance(train: DataFrame, val: DataFrame, cols: Sequence[str], repeats: int = 5, n_estimators: int = BASELINE_TREES,
                           seed: int = 42, id_col: str = "id") -> DataFrame:
    """Drop in validation AUC (``boosting.FINE_STEPS`` score steps) when one column is shuffled, mean and population
    std over repeats. The baseline is a boosted model; validation rows are ranked once in md5 order (a random order)
    and written as codes. One AUC per column and repeat reaches the driver."""
    cols = list(cols)
    bins = bo.fit_bins(train, cols, [])
    model = bo.fit_many(bo.code_rows(train, bins, F.xxhash64(id_col), F.col("target"), F.lit(bo.TRAIN)), bins, [replace(BASELINE, rounds=n_estimators, seed=seed)])[0]
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))
    rows = row_number_within(val.select(id_col, "target", *cols).withColumn("_h", key), [], [F.col("_h"), F.col(id_col)], hash_bucket(F.col("_h")), out="_rank")
    ranked = bo.code_rows(rows, bins, F.col("_rank"), F.col("target"), F.lit(bo.VAL))
    counts = permuted_scores(ranked, model, ranked.count(), repeats, seed)
    hist = counts.withColumn("proba", F.col("step") / F.lit(float(bo.FINE_STEPS)))
    found = mx.ranking_metrics(hist, ["repeat", "column"]).select("repeat", "column", "roc_auc").collect()  # columns x repeats
    aucs = {(r["repeat"], r["column"]): round(r["roc_auc"], 12) for r in found}
    out = []
    for k, c in enumerate(bins.columns):
        gaps = [aucs[-1, -1] - aucs[r, k] for r in range(repeats)]
        mean = math.fsum(gaps) / len(gaps)
        out.append((c, mean, math.sqrt(math.fsum((x - mean) ** 2 for x in gaps) / len(gaps))))
    return train.sparkSession.createDataFrame(out, "feature string, pfi_mean double, pfi_std double")


def top_n_pfi(pfi: DataFrame, n: int = 15) -> DataFrame:
    """The n columns with the largest mean AUC drop (a top-n report)."""
    return pfi.orderBy(F.col("pfi_mean").desc(), F.col("feature").asc()).limit(n)
