"""Score calibration (I4–I6): fitted on the validation split, applied to every split.

Platt scaling is a two-parameter logistic regression on the logit of the score. Isotonic calibration pools adjacent
violators of all models at once: tasks hold ascending score ranges and reduce them to blocks of increasing rate, and
neighbouring ranges are merged in a tree until one list of blocks is left per model. Nothing of it passes through the
driver. Re-thresholding reruns the sweep on the calibrated validation scores.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions.order import cumulative_within, score_bucket
from propensity.functions.sizing import broadcast_if_bounded
from propensity.operators import metrics as mx
from propensity.operators.models import positive_proba
from propensity.session import materialize

EPS = 1e-6
MERGE_FACTOR = 16  # score ranges merged into one per step of the tree
MAP_BROADCAST_ROWS = 200_000  # of 30 bytes or so each
BLOCK_SCHEMA = "model string, lo double, hi double, pos long, n long"


def _logit(df: DataFrame) -> DataFrame:
    p = F.least(F.greatest(F.col("proba"), F.lit(EPS)), F.lit(1 - EPS))
    return VectorAssembler(inputCols=["_logit"], outputCol="_cal_x").transform(
        df.withColumn("_logit", F.log(p / (1 - p))))


def _weighted(rows: DataFrame, fit_split: str) -> DataFrame:
    """Fit rows: one per distinct score and label, weighted by its count (map-side combined), so a fit reads as
    many rows as there are scores."""
    hist = mx.score_histogram(rows.filter(F.col("split") == fit_split), [])
    both = F.array(F.struct(F.lit(1.0).alias("label"), F.col("pos").cast("double").alias("weight")),
                   F.struct(F.lit(0.0).alias("label"), F.col("neg").cast("double").alias("weight")))
    return hist.select("proba", F.inline(both)).filter(F.col("weight") > 0)


def platt(scores: DataFrame, fit_split: str = "val", suffix: str = "_platt") -> DataFrame:
    """I4: per model, logistic regression of the target on logit(score), fitted on ``fit_split``."""
    out = None
    for (model,) in scores.select("model").distinct().collect():  # one small fit per model
        rows = scores.filter(F.col("model") == model)
        fit = _logit(_weighted(rows, fit_split))
        lr = LogisticRegression(featuresCol="_cal_x", labelCol="label", weightCol="weight", maxIter=100).fit(fit)
        cal = lr.transform(_logit(rows)).select(F.lit(model + suffix).alias("model"), "split", "id", "target",
                                        positive_proba().alias("proba"))
        out = cal if out is None else out.unionByName(cal)
    return out


def _pool(blocks: Iterable[tuple]) -> list[tuple]:
    """Pool adjacent violators over ascending (lo, hi, pos, n); rates are compared as whole-number products."""
    out: list[tuple] = []
    for lo, hi, pos, n in blocks:
        while out and out[-1][2] * n >= pos * out[-1][3]:
            low, _, p, c = out.pop()
            lo, pos, n = low, pos + p, n + c
        out.append((lo, hi, pos, n))
    return out


def _pool_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of a task's score range, given in order of (model, lo). Only the blocks of one model are held."""
    model, held = None, []

    def frame() -> pd.DataFrame:
        return pd.DataFrame([(model, *b) for b in held], columns=["model", "lo", "hi", "pos", "n"])

    for batch in batches:
        for name, rows in batch.groupby("model", sort=False):
            if name != model:
                if held:
                    yield frame()
                model, held = name, []
            held = _pool([*held, *zip(rows.lo.tolist(), rows.hi.tolist(), rows.pos.tolist(), rows.n.tolist())])
    if held:
        yield frame()


def _number_blocks(blocks: pd.DataFrame) -> pd.DataFrame:
    """Last step of the tree for one model: blocks numbered from 1, each with its rate and what follows it."""
    blocks = blocks.sort_values("lo")
    rows = zip(blocks.lo.tolist(), blocks.hi.tolist(), blocks.pos.tolist(), blocks.n.tolist())
    out = pd.DataFrame(_pool(rows), columns=["lo", "hi", "pos", "n"])
    out["rate"] = out.pos / out.n
    return out.assign(model=blocks.model.iloc[0], block=range(1, len(out) + 1), next_lo=out.lo.shift(-1), next_rate=out.rate.shift(-1))


def isotonic_blocks(scores: DataFrame, fit_split: str = "val", ranges: int | None = None) -> DataFrame:
    """The fitted step maps: (model, block, lo, hi, pos, n, rate, next_lo, next_rate), blocks ascending from 1, one row per
    block of scores ``lo`` to ``hi``; ``pos`` of their ``n`` rows are positive and ``rate`` increases strictly.

    Blocks have different fractions with denominators that add up to the number of rows N, so a model has at most in the
    order of N^(2/3) blocks however many scores there are; that bounds the last step of the tree. NULL scores and
    targets take no part; a model without labelled rows in ``fit_split`` has no block."""
    spark = scores.sparkSession
    rows = scores.filter((F.col("split") == fit_split) & F.col("proba").isNotNull() & F.col("model").isNotNull())
    level = mx.score_histogram(rows, ["model"]).select(
        "model", F.col("proba").alias("lo"), F.col("proba").alias("hi"), "pos", (F.col("pos") + F.col("neg")).alias("n"))
    level = materialize(level)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    while ranges > 1:
        level = materialize(level.repartitionByRange(ranges, "model", "lo").sortWithinPartitions("model", "lo").mapInPandas(
            _pool_ranges, BLOCK_SCHEMA))
        ranges //= MERGE_FACTOR
    return materialize(level.groupBy("model").applyInPandas(
        _number_blocks, BLOCK_SCHEMA + ", rate double, block long, next_lo double, next_rate double"))


def isotonic(scores: DataFrame, fit_split: str = "val", suffix: str = "_isotonic") -> DataFrame:
    """Per model, a monotone map from score to observed rate, fitted on ``fit_split``.

    Scores inside a block get its rate, scores between two blocks lie on the straight line between their ends, and scores
    outside all blocks get the rate of the nearest one. A NULL score, or a model without blocks, gives NULL.

    Distinct scores find their block by a running count of block starts; rows then join the map of distinct scores."""
    blocks = isotonic_blocks(scores, fit_split)
    starts = blocks.select("model", F.col("lo").alias("proba"), F.lit(1).alias("start"))
    line = scores.filter(F.col("proba").isNotNull()).select("model", "proba", F.lit(0).alias("start")).unionByName(starts)
    line = line.groupBy("model", "proba").agg(F.max("start").alias("start"))
    placed = cumulative_within(line, ["model"], "proba", score_bucket(F.col("proba")), {"block": "start"})
    placed = placed.withColumn("block", F.greatest(F.col("block"), F.lit(1)))
    placed = placed.join(broadcast_if_bounded(blocks, MAP_BROADCAST_ROWS), ["model", "block"])
    between = F.col("rate") + (F.col("next_rate") - F.col("rate")) * ((F.col("proba") - F.col("hi")) / (F.col("next_lo") - F.col("hi")))
    value = F.when((F.col("proba") <= F.col("hi")) | F.col("next_lo").isNull(), F.col("rate")).otherwise(between)
    steps = materialize(placed.select("model", "proba", value.alias("_cal")))
    return scores.join(broadcast_if_bounded(steps, MAP_BROADCAST_ROWS), ["model", "proba"], "left").select(
        F.concat("model", F.lit(suffix)).alias("model"), "split", "id", "target", F.col("_cal").alias("proba"))


def rethreshold(calibrated: DataFrame, split: str = "val") -> DataFrame:
    """Sweep and Youden-band choice on calibrated validation scores."""
    rows = mx.labelled_rows(calibrated.filter(F.col("split") == split), ["model"])
    return mx.best_threshold(mx.threshold_sweep(rows, ["model"]), ["model"])
