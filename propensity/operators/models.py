"""Classifiers (E1–E5, E13–E18) as Spark ML pipelines.

Every other model is a ``Pipeline`` fitted on the training split and persisted with the ML writers. The
single-machine learners of the reference are re-aimed at their distributed Spark counterparts:

* leaf-wise and depth-wise boosting → ``operators.boosting`` (histogram passes over binned columns, missing values and
  levels of nominal columns split by the trees themselves);
* feed-forward network → ``MultilayerPerceptronClassifier``;
* kernel margin classifier → ``LinearSVC`` on the raw, polynomial or random-Fourier feature space, with a
  Platt (logistic) layer on the margin for probabilities;
* Gaussian process → random Fourier features of the same kernel + ``LogisticRegression`` on all rows.

Scores come out as the long ``(model, split, id, target, proba)`` table, so every metric operator
applies unchanged.
"""
from __future__ import annotations

import math
import threading
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions.exprs import rnd
from propensity.operators import boosting as bo
from propensity.operators.features import Preprocessor, columns_to_originals
from propensity.session import materialize

SEED = 42
TASK_BYTES = 256 << 20  # of the feature vectors of a training task
FOURIER_ROWS = 512  # rows whose features are computed together


# ── model inputs ──────────────────────────────────────────────────────────────────────────────────

KEEP = ("id", "split", "target")


def tree_columns(pre: Preprocessor, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """(ordinal/numeric columns, nominal columns) of the tree variant. ``columns`` (selected model columns, dummies
    included) maps back to the columns they come from."""
    wanted = set(columns_to_originals(columns, pre.levels)) if columns is not None else None
    every = pre.spec.tree_columns()
    own = [c for c in every if wanted is None or c in wanted]
    return [c for c in own if c not in pre.spec.nominal], [c for c in own if c in pre.spec.nominal]


def tree_input(pre: Preprocessor, df: DataFrame, keep: Sequence[str] = KEEP, columns: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Tree variant: ordinal/numeric columns as they are (trees have a side for missing values) and the raw nominal
    strings."""
    base, nominal = tree_columns(pre, columns)
    raw = pre.numeric(df, keep=[*keep, *nominal], impute=False)
    return raw.select(*keep, *[F.col(c).cast("double").alias(c) for c in base], *nominal), base


def scaled_input(pre: Preprocessor, df: DataFrame, keep: Sequence[str] = KEEP, columns: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    own = list(pre.numeric_columns) if columns is None else [c for c in pre.numeric_columns if c in set(columns)]
    return pre.scaled(df, keep=list(keep)).select(*keep, *own), own


class ScaledRows:
    """Scaled training and validation rows for all fits of a search, written once, when the first of them asks."""

    def __init__(self, pre: Preprocessor, train: DataFrame, val: DataFrame, columns: Sequence[str] | None):
        self.given, self.columns, self.asking, self.written = (pre, train, val), columns, threading.Lock(), None

    def rows(self) -> tuple[DataFrame, DataFrame, list[str]]:
        """(training rows, validation rows, input columns)."""
        pre, train, val = self.given
        with self.asking:
            if self.written is None:
                (inp, own), held = scaled_input(pre, train, KEEP, self.columns), scaled_input(pre, val, KEEP, self.columns)[0]
                self.written = materialize(inp), materialize(held), own
        return self.written


def with_label(df: DataFrame, target: str = "target") -> DataFrame:
    return df.withColumn("label", F.col(target).cast("double"))


def positive_proba(col: str = "probability") -> Column:
    """P(class 1) from any probabilistic classifier."""
    return vector_to_array(F.col(col)).getItem(1)


# ── random Fourier features (kernel re-aim) ───────────────────────────────────────────────────────

def fourier_weights(n_inputs: int, n_features: int, kernel: str, length_scale: float, seed: int = SEED,
                    nu: float = 1.5, alpha: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Spectral draws (Rahimi & Recht): normal for RBF, Student-t (2ν degrees of freedom) for Matérn,
    gamma-mixed normal for rational quadratic. Small (n_features × n_inputs), drawn on the driver."""
    rng = np.random.default_rng(seed)
    if kernel == "rbf":
        w = rng.standard_normal((n_features, n_inputs))
    elif kernel == "matern":
        w = rng.standard_t(2 * nu, size=(n_features, n_inputs))
    elif kernel == "rq":
        tau = rng.gamma(alpha, 1.0 / alpha, size=(n_features, 1))
        w = rng.standard_normal((n_features, n_inputs)) * np.sqrt(tau)
    else:
        raise ValueError(f"unknown kernel {kernel!r}")
    return w / length_scale, rng.uniform(0.0, 2 * math.pi, n_features)


def fourier_values(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``sqrt(2/D) * cos(W x + b)`` of the rows of ``x``; columns are added one after the other, so a row's values don't
    depend on the rows beside it. Missing values give NaN."""
    out, scale = np.empty((len(x), len(b))), math.sqrt(2.0 / len(b))
    for at in range(0, len(x), FOURIER_ROWS):
        part = x[at:at + FOURIER_ROWS]
        z = np.zeros((len(part), len(b)))
        for j in range(x.shape[1]):
            z += part[:, j:j + 1] * w[:, j]
        out[at:at + FOURIER_ROWS] = np.cos(z + b) * scale
    return out


def fourier_features(df: DataFrame, cols: Sequence[str], w: np.ndarray, b: np.ndarray, out: str = "features") -> DataFrame:
    """The Fourier features of Arrow batches as one array, then a vector. Never one column per feature: the plan would
    explode."""
    @F.arrow_udf("array<double>")
    def features(x: pa.Array) -> pa.Array:
        values = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(cols))
        found = fourier_values(values, w, b)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(b)), pa.array(found.ravel()))

    return df.withColumn(out, array_to_vector(features(F.array(*[F.col(c).cast("double") for c in cols]))))


# ── trainers ──────────────────────────────────────────────────────────────────────────────────────

@dataclass(frozen=True)
class Trainer:
    name: str
    variant: str  # "tree" or "scaled"


TRAINERS = {
    "gbt_leafwise": Trainer("gbt_leafwise", "tree"),
    "gbt_depthwise": Trainer("gbt_depthwise", "tree"),
    "mlp": Trainer("mlp", "scaled"),
    "svc_linear": Trainer("svc_linear", "scaled"),
    "svc_poly": Trainer("svc_poly", "scaled"),
    "svc_rff": Trainer("svc_rff", "scaled"),
    "rff_logistic": Trainer("rff_logistic", "scaled"),
}

DEFAULT_PARAMS = {
    "gbt_leafwise": {"num_leaves": 31, "learning_rate": 0.1, "n_estimators": 100, "feature_fraction": 1.0,
                     "bagging_fraction": 1.0, "bagging_freq": 1, "min_child_samples": 20, "reg_alpha": 0.0, "reg_lambda": 0.0},
    "gbt_depthwise": {"max_depth": 6, "eta": 0.1, "n_estimators": 100, "subsample": 1.0, "colsample_bytree": 1.0,
                      "min_child_weight": 1, "reg_alpha": 0.0, "reg_lambda": 1.0},
    "mlp": {"n_layers": 1, "hidden_size": 64, "max_iter": 50, "step_size": 0.01},
    "svc_linear": {"C": 1.0, "max_iter": 50},
    "svc_poly": {"C": 1.0, "degree": 2, "max_iter": 50},
    "svc_rff": {"C": 1.0, "kernel": "rbf", "length_scale": 3.0, "n_features": 100, "max_iter": 50},
    "rff_logistic": {"kernel": "rbf", "length_scale": 3.0, "n_features": 100, "reg": 0.001, "max_iter": 50},
}

STAGED = (*(n for n in TRAINERS if n.startswith("gbt")), "mlp")  # trainers whose rounds can be measured one by one


PATIENCE = bo.PATIENCE
MLP_STEP, MLP_PATIENCE = 5, 10  # fixed values: iterations between two looks at the validation loss; without a better one


def boosting_params(name: str, params: dict, tol: float = 0.0) -> bo.Params:
    """The leaf-wise preset stops on log-loss, the depth-wise one on AUC."""
    p = {**DEFAULT_PARAMS[name], **params}
    shared = {"rounds": int(p["n_estimators"]), "alpha": float(p["reg_alpha"]), "lam": float(p["reg_lambda"]), "tolerance": tol, "seed": SEED}
    if name == "gbt_leafwise":
        return bo.Params(rate=float(p["learning_rate"]), num_leaves=int(p["num_leaves"]), min_rows=int(p["min_child_samples"]),
                         columns=float(p["feature_fraction"]), rows=float(p["bagging_fraction"]), rows_every=int(p["bagging_freq"]), **shared)
    return bo.Params(rate=float(p["eta"]), max_depth=int(p["max_depth"]), min_hessian=float(p["min_child_weight"]),
                     columns=float(p["colsample_bytree"]), rows=float(p["subsample"]), stop_on="roc_auc", **shared)


def build_pipeline(name: str, params: dict, input_cols: Sequence[str], n_rows: int) -> Pipeline:
    """Stages from the model input columns to a ``probability`` column."""
    p = {**DEFAULT_PARAMS[name], **params}
    if name == "mlp":
        layers = [len(input_cols), *[int(p["hidden_size"])] * int(p["n_layers"]), 2]
        return Pipeline(stages=[VectorAssembler(inputCols=list(input_cols), outputCol="features"),
                                MultilayerPerceptronClassifier(layers=layers, maxIter=int(p["max_iter"]),
                                                               stepSize=float(p["step_size"]), seed=SEED)])
    reg = 1.0 / (float(p.get("C", 1.0)) * max(1, n_rows))
    svc_head = [LinearSVC(regParam=reg, maxIter=int(p["max_iter"]), rawPredictionCol="svm_raw",
                          predictionCol="svm_pred"),
                VectorSlicer(inputCol="svm_raw", outputCol="svm_margin", indices=[1]),
                LogisticRegression(featuresCol="svm_margin", maxIter=50)]  # Platt layer on the margin
    if name == "svc_linear":
        return Pipeline(stages=[VectorAssembler(inputCols=list(input_cols), outputCol="features"), *svc_head])
    if name == "svc_poly":
        return Pipeline(stages=[VectorAssembler(inputCols=list(input_cols), outputCol="raw_features"),
                                PolynomialExpansion(degree=int(p["degree"]), inputCol="raw_features", outputCol="features"),
                                *svc_head])
    if name == "svc_rff":
        return Pipeline(stages=svc_head)  # Fourier features are added before the pipeline
    if name == "rff_logistic":
        return Pipeline(stages=[LogisticRegression(regParam=float(p["reg"]), maxIter=int(p["max_iter"]))])
    raise ValueError(f"unknown model {name!r}")


def feature_count(name: str, params: dict, inputs: int) -> int:
    """Entries of a row's feature vector."""
    if name == "svc_poly":
        return math.comb(inputs + int(params["degree"]), inputs) - 1
    return int(params["n_features"]) if name in ("svc_rff", "rff_logistic") else inputs


def spread(inp: DataFrame, rows: int, features: int) -> DataFrame:
    """Training rows in so many tasks that the feature vectors of one, which the fit keeps and reads in every iteration,
    have TASK_BYTES or so. Dealt anew, before the features are made, only where the input has fewer tasks."""
    tasks = -(-rows * features * 8 // TASK_BYTES)
    return inp.repartition(tasks, "id") if tasks > max(1, inp.rdd.getNumPartitions()) else inp


@dataclass
class FittedModel:
    name: str
    params: dict
    pipeline: PipelineModel | None  # None: boosted
    input_cols: list[str]
    variant: str
    fourier: tuple[np.ndarray, np.ndarray] | None = None
    columns: list[str] | None = None  # selected model columns; None: all
    steps: list[tuple[int, PipelineModel]] = field(default_factory=list)  # network fitted with early stopping: (iterations, model), not saved
    boosted: bo.BoostedModel | None = None

    def prepare(self, pre: Preprocessor, df: DataFrame, keep: Sequence[str] = ("id", "split", "target")) -> DataFrame:
        if self.variant not in ("tree", "scaled"):
            raise ValueError(f"unknown variant {self.variant!r}; a run is saved as 'tree' or 'scaled'")
        inp = (tree_input if self.variant == "tree" else scaled_input)(pre, df, keep, self.columns)[0]
        if self.fourier is not None:
            inp = fourier_features(inp, self.input_cols, *self.fourier)
        return inp

    def score(self, pre: Preprocessor, df: DataFrame, keep: Sequence[str] = ("id", "split", "target")) -> DataFrame:
        """``(model, keep..., proba)``: one narrow stage, no shuffle."""
        x = self.prepare(pre, df, keep)
        if self.boosted is not None:
            return x.select(F.lit(self.name).alias("model"), *keep, self.boosted.proba().alias("proba"))
        return self._proba(x, keep)

    def score_scaled(self, scaled: DataFrame, keep: Sequence[str] = ("id", "split", "target")) -> DataFrame:
        """The same, of rows that are scaled (``scaled_input``)."""
        return self._proba(scaled if self.fourier is None else fourier_features(scaled, self.input_cols, *self.fourier), keep)

    def _proba(self, x: DataFrame, keep: Sequence[str]) -> DataFrame:
        out = self.pipeline.transform(x)
        return out.select(F.lit(self.name).alias("model"), *keep, positive_proba().alias("proba"))

    def save(self, path: str) -> None:
        if self.boosted is not None:
            rows = [(self.boosted.to_bytes(),)]
            SparkSession.active().createDataFrame(rows, "model binary").coalesce(1).write.mode("overwrite").parquet(path)
            return
        self.pipeline.write().overwrite().save(path)


def best_round(losses: Sequence[float], patience: int, tol: float = 0.0) -> tuple[int, bool]:
    """(round with the best loss, whether ``patience`` rounds without an improvement ended the fit there). An
    improvement is more than ``tol`` of the loss; later rounds than the stop aren't looked at."""
    best, at = math.inf, 0
    for m, loss in enumerate(losses, 1):
        if at == 0 or best - loss > tol * max(loss, 0.01):
            best, at = loss, m
        elif m - at >= patience:
            return at, True
    return at, False


def _log_loss(target: Column, proba: Column) -> Column:
    p = F.least(F.greatest(proba, F.lit(1e-15)), F.lit(1 - 1e-15))
    return F.avg(-(target * F.log(p) + (1 - target) * F.log(1 - p)))


def _fit_network(pipe: Pipeline, train: DataFrame, val: DataFrame, max_iter: int, tol: float) -> tuple[PipelineModel, list[tuple[int, PipelineModel]]]:
    """A network trained MLP_STEP iterations at a time, each step from the weights of the one before, up to ``max_iter``
    iterations or MLP_PATIENCE without a better validation loss: (the best step's model, every step)."""
    steps, losses, done = [], [], 0
    best, stopped = 0, False
    network = pipe.getStages()[-1]
    while done < max_iter and not stopped:
        network.setMaxIter(min(MLP_STEP, max_iter - done))
        done += network.getMaxIter()
        model = pipe.fit(train)
        network.setInitialWeights(model.stages[-1].weights)
        steps.append((done, model))
        losses.append(model.transform(val).agg(_log_loss(F.col("label"), positive_proba())).first()[0])
        best, stopped = best_round(losses, MLP_PATIENCE // MLP_STEP, tol)
    return steps[best - 1][1], steps


def coded_input(pre: Preprocessor, train: DataFrame, val: DataFrame | None, columns: Sequence[str] | None = None) -> tuple[DataFrame, bo.Bins]:
    """Binned rows of boosting fits, written once: bins from the training rows, validation rows marked."""
    rows, base = tree_input(pre, train, KEEP, columns)
    bins = bo.fit_bins(rows, base, tree_columns(pre, columns)[1])
    rows = rows.withColumn("_val", F.lit(bo.TRAIN))
    if val is not None:
        rows = rows.unionByName(tree_input(pre, val, KEEP, columns)[0].withColumn("_val", F.lit(bo.VAL)))
    return bo.code_rows(rows, bins, F.xxhash64("id"), F.col("target"), F.col("_val")), bins


def boosted_model(name: str, params: dict, model: bo.BoostedModel, columns: Sequence[str] | None) -> FittedModel:
    return FittedModel(name, {**DEFAULT_PARAMS[name], **params}, None, model.bins.columns, TRAINERS[name].variant,
                       columns=None if columns is None else list(columns), boosted=model)


def fit_boosters(names: Sequence[str], pre: Preprocessor, train: DataFrame, early_stop: DataFrame | None = None) -> dict[str, FittedModel]:
    """Boosting trainers with their default parameters, side by side: rows are binned once and a pass serves all fits."""
    coded, bins = coded_input(pre, train, early_stop)
    fits = bo.fit_many(coded, bins, [boosting_params(n, {}) for n in names])
    return {n: boosted_model(n, {}, m, None) for n, m in zip(names, fits)}


def fit_model(name: str, pre: Preprocessor, train: DataFrame, params: dict | None = None,
              early_stop: DataFrame | None = None, validation_tol: float = 0.0, columns: Sequence[str] | None = None) -> FittedModel:
    """Fit one trainer on the training rows (``train`` holds raw campaign columns), on the selected model ``columns``
    if they are given.

    E13: with ``early_stop`` (validation rows) a boosting model ends after PATIENCE trees without a validation loss
    better by more than ``validation_tol`` (a share of the loss; 0: any improvement counts) and keeps the trees up to
    its best round; the network (E3) is the one after the step with the best validation loss. Validation rows are
    measured only, never fitted."""
    tr = TRAINERS[name]
    p = {**DEFAULT_PARAMS[name], **(params or {})}
    if tr.variant == "tree":
        coded, bins = coded_input(pre, train, early_stop, columns)
        return boosted_model(name, p, bo.fit_many(coded, bins, [boosting_params(name, p, validation_tol)])[0], columns)
    inp, cols = scaled_input(pre, train, KEEP, columns)
    held = None if early_stop is None else scaled_input(pre, early_stop, KEEP, columns)[0]
    return fit_scaled(name, p, inp, cols, held, validation_tol, columns)


def fit_scaled(name: str, params: dict, inp: DataFrame, cols: list[str], held: DataFrame | None = None, validation_tol: float = 0.0,
               columns: Sequence[str] | None = None) -> FittedModel:
    """``fit_model`` of a trainer that isn't boosted, on scaled training rows and ``held`` validation rows."""
    p = {**DEFAULT_PARAMS[name], **params}
    fourier, n_rows = None, 1
    if name.startswith("svc") or name == "rff_logistic":
        n_rows = inp.count()
        inp = spread(inp, n_rows, feature_count(name, p, len(cols)))
    if name in ("svc_rff", "rff_logistic"):
        fourier = fourier_weights(len(cols), int(p["n_features"]), p["kernel"], float(p["length_scale"]), SEED)
        inp = fourier_features(inp, cols, *fourier)
    pipe = build_pipeline(name, p, cols, n_rows)
    steps = []
    if held is not None and name in STAGED:
        model, steps = _fit_network(pipe, with_label(inp), with_label(held), int(p["max_iter"]), validation_tol)
    else:
        model = pipe.fit(with_label(inp))
    return FittedModel(name, p, model, cols, TRAINERS[name].variant, fourier, None if columns is None else list(columns), steps)


def feature_importance(fitted: FittedModel) -> list[tuple[str, float]]:
    """Tree importances as percentages (2 dp) over the input columns, sorted desc: the number of splits (leaf-wise)
    or the mean gain of a split (depth-wise)."""
    n, gain = fitted.boosted.splits()
    imp = n if fitted.name == "gbt_leafwise" else gain / np.maximum(n, 1)
    total = float(imp.sum()) or 1.0
    rows = [(c, round(float(v) / total * 100.0, 2)) for c, v in zip(fitted.boosted.bins.columns, imp)]
    return sorted(rows, key=lambda r: (-r[1], r[0]))


def staged_history(fitted: FittedModel, pre: Preprocessor, df: DataFrame, target: str = "target") -> DataFrame:
    """Per boosting round kept (network: step, up to the stop) and split, log-loss, error and AUC of the staged model.

    Boosting measures every round while it fits, on the rows it was given (AUC by ``boosting.STEPS`` score steps); the
    network's steps are measured on ``df``."""
    if fitted.boosted is not None:
        model = fitted.boosted
        rows = [(k, split, m, None if v is None else round(v, 6)) for k, found in enumerate(model.history[:len(model.trees)], 1)
                for split, measured in found.items() for m, v in measured.items()]
        return df.sparkSession.createDataFrame(rows, "iteration int, split string, metric string, value double")
    if not fitted.steps:
        raise ValueError(f"{fitted.name!r} has no staged history: it wasn't fitted with early stopping here")
    x = fitted.steps[0][1].stages[0].transform(fitted.prepare(pre, df))  # read once for all steps
    for n, model in fitted.steps:
        network = model.stages[-1].copy().setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"_step_{n}")
        x = network.transform(x)
    staged = F.array(*[F.struct(F.lit(n).alias("iteration"), positive_proba(f"_step_{n}").alias("proba")) for n, _ in fitted.steps])
    return _history_rows(x.select("split", F.col(target).cast("int").alias("target"), F.inline(staged)))


def _history_rows(staged: DataFrame) -> DataFrame:
    """(iteration, split, metric, value) of (split, target, iteration, proba)."""
    from propensity.operators.metrics import ranking_metrics, score_histogram
    loss = staged.groupBy("split", "iteration").agg(
        _log_loss(F.col("target"), F.col("proba")).alias("logloss"),
        F.avg(((F.col("proba") >= 0.5).cast("int") != F.col("target")).cast("double")).alias("error"))
    auc = ranking_metrics(score_histogram(staged, ["split", "iteration"]), ["split", "iteration"]).select(
        "split", "iteration", "roc_auc")
    wide = loss.join(auc, ["split", "iteration"])
    items = F.array(*[F.struct(F.lit(m).alias("metric"), rnd(F.col(m), 6).alias("value")) for m in ("logloss", "error", "roc_auc")])
    return wide.select("iteration", "split", F.inline(items))
