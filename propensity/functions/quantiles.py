"""Exact quantiles that scale.

The built-in exact ``percentile`` keeps a value→count map per group and merges a global aggregate in one
task; for a high-cardinality column of a large table that map does not fit. Here the work is a shuffle:
values are counted per (feature, value), bucketed by approximate quantile edges (``percentile_approx``
is bounded-memory), and exact ranks come from running counts per bucket plus bucket offsets. The value
at rank r is the smallest value whose running count reaches r; quantiles interpolate linearly between
ranks ``floor(h)+1`` and ``floor(h)+2`` with ``h = (n - 1) * q`` (pandas / numpy "linear").
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions.order import cumulative_within

MIN_EDGES = 32  # approximate-quantile edges per column


def edge_count(df: DataFrame) -> int:
    """Rank buckets follow the session's shuffle parallelism, which is set for the data's size, so a bucket stays a
    task-sized piece of work; pass ``edges`` to choose another number."""
    return max(MIN_EDGES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def number(col: str):
    """The column as a double, NaN as NULL."""
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def long_values(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to ``(feature, value[, extra...])`` with value as double (NULLs dropped)."""
    items = F.array(*[
        F.struct(F.lit(c).alias("feature"), number(c).alias("value"),
                 *[F.col(e).alias(e) for e in extra])
        for c in cols
    ])
    return df.select(F.inline(items)).filter(F.col("value").isNotNull())


def value_counts_with_buckets(df: DataFrame, cols: Sequence[str], edges: int | None = None) -> DataFrame:
    """``(feature, value, cnt, bkt)``: distinct values per column with a rank-balanced bucket."""
    cols = list(cols)
    edges = edges or edge_count(df)
    probs = [i / edges for i in range(1, edges)]
    # edges only need to balance buckets roughly: accuracy 2 * edges keeps the sketch small
    approx = df.agg(*[F.percentile_approx(number(c), probs, 2 * edges).alias(c) for c in cols]).first()
    splits = []
    for c in cols:
        inner = sorted({float(v) for v in (approx[c] or []) if v is not None}) or [0.0]
        splits.append([float("-inf"), *inner, float("inf")])
    buck = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[f"_b_{c}" for c in cols], handleInvalid="keep")
    staged = buck.transform(df.select(*[number(c).alias(c) for c in cols]))
    items = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(f"_b_{c}").cast("int").alias("bkt"))
        for c in cols
    ])
    return (
        staged.select(F.inline(items)).filter(F.col("value").isNotNull())
        .groupBy("feature", "bkt", "value").agg(F.count(F.lit(1)).alias("cnt"))
    )


def quantiles_from_counts(counts: DataFrame, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """One row per feature with the exact linear-interpolated quantiles and ``n`` (non-null count)."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    cum = cumulative_within(counts, ["feature"], "value", F.col("bkt"), {"cum": "cnt"})
    n = counts.groupBy("feature").agg(F.sum("cnt").alias("n"))
    staged = cum.join(n, "feature")
    aggs = [F.first("n").alias("n")]
    for p, name in zip(probs, names):
        h = (F.col("n") - 1) * F.lit(float(p))
        lo_rank = F.floor(h) + 1
        hi_rank = F.least(lo_rank + 1, F.col("n"))
        aggs += [
            F.min(F.when(F.col("cum") >= lo_rank, F.col("value"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("cum") >= hi_rank, F.col("value"))).alias(f"_hi_{name}"),
            F.first(h - F.floor(h)).alias(f"_d_{name}"),
        ]
    out = staged.groupBy("feature").agg(*aggs)
    return out.select(
        "feature", "n",
        *[(F.col(f"_lo_{m}") + (F.col(f"_hi_{m}") - F.col(f"_lo_{m}")) * F.col(f"_d_{m}")).alias(m) for m in names],
    )


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    return quantiles_from_counts(value_counts_with_buckets(df, cols), probs, names)
