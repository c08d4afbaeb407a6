"""Global order without a single-task window.

A window with a coarse ``partitionBy`` (one class, one model, one customer) sends the whole group to
one task. These helpers split every group into ordered sub-buckets: a bucket column that never
decreases along the requested order. Bucket sizes (or sums) are aggregated into a small table, a
window over that table gives each bucket the total of the buckets before it, and the fine window runs
per (group, bucket) with that offset added. The result equals the single-window answer exactly.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BUCKET_DIGITS = 4  # 16^4 = 65,536 buckets for md5-ordered ranks
SCORE_BUCKETS = 65536  # buckets over [0, 1] for score-ordered cumulative sums


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL equals NULL; the keys appear once."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = [left[k].eqNullSafe(named[f"_right_{k}"]) for k in keys]
    return left.join(named, cond).drop(*[f"_right_{k}" for k in keys])


def md5_key(id_col: str, seed: int) -> Column:
    """Deterministic shuffle key: md5 of ``<id>-<seed>`` (same hex string in Spark and DuckDB)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def hash_bucket(key: Column, digits: int = HASH_BUCKET_DIGITS) -> Column:
    """Leading hex digits of an md5 string: monotone in the string order."""
    return F.substring(key, 1, digits)


def score_bucket(score: Column, buckets: int = SCORE_BUCKETS) -> Column:
    """Monotone bucket of any real score, as a struct compared field by field: equal-width steps of [0, 1], then
    binary magnitude (sixteen steps an octave) of the distance from 0 and from 1. Scores that crowd near 0 or
    near 1, and raw margins outside [0, 1], are spread instead of piling up in an end bucket."""
    step = F.least(F.greatest(F.floor(score * F.lit(float(buckets))), F.lit(0)), F.lit(buckets)).cast("long")

    def octave(x: Column) -> Column:  # grows with x, NULL-free
        return F.when(x > 0, F.floor(F.log2(F.greatest(x, F.lit(1e-300))) * 16.0)).when(
            x < 0, -F.floor(F.log2(F.greatest(-x, F.lit(1e-300))) * 16.0) - 40_000).otherwise(F.lit(-20_000)).cast("long")

    return F.struct(step.alias("step"), octave(score).alias("low"), (-octave(F.lit(1.0) - score)).alias("high"))


def row_number_within(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    bucket: Column,
    out: str = "rn",
    lag_of: str | None = None,
    lag_out: str | None = None,
) -> DataFrame:
    """``row_number() over (partition by group_cols order by order_cols)`` computed per sub-bucket.

    ``bucket`` must be non-decreasing along ``order_cols`` inside a group. The order must be total
    (end it with a unique key) so the numbering is deterministic. With ``lag_of`` the same pass also
    returns ``lag(lag_of)``; that column must be non-decreasing along the order (e.g. the ordering
    date), so the predecessor of a bucket's first row carries the maximum of the previous bucket.
    """
    group_cols = list(group_cols)
    staged = df.withColumn("_bkt", bucket)
    stats = [F.count(F.lit(1)).alias("_n")]
    if lag_of:
        stats.append(F.max(lag_of).alias("_last"))
    sizes = staged.groupBy(*group_cols, "_bkt").agg(*stats)
    by_bucket = Window.partitionBy(*group_cols).orderBy("_bkt")
    cols = [*group_cols, "_bkt",
            F.coalesce(F.sum("_n").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")]
    if lag_of:
        cols.append(F.lag("_last").over(by_bucket).alias("_carry"))
    offsets = sizes.select(*cols)
    fine = Window.partitionBy(*group_cols, "_bkt").orderBy(*order_cols)
    res = join_null_safe(staged, offsets, [*group_cols, "_bkt"]).withColumn(out, F.row_number().over(fine) + F.col("_off"))
    if lag_of:
        res = res.withColumn(lag_out or f"prev_{lag_of}", F.coalesce(F.lag(lag_of).over(fine), F.col("_carry")))
        res = res.drop("_carry")
    return res.drop("_bkt", "_off")


def cumulative_within(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    bucket: Column,
    sums: dict[str, str],
    descending: bool = False,
) -> DataFrame:
    """Running sums ``sum(src) over (partition by group order by order_col rows unbounded preceding)``.

    ``df`` must hold one row per (group, order value), e.g. a per-distinct-score aggregate, so the
    running sum is the same for ROWS and RANGE frames. ``sums`` maps output name → source column.
    """
    group_cols = list(group_cols)
    staged = df.withColumn("_bkt", bucket)
    totals = staged.groupBy(*group_cols, "_bkt").agg(*[F.sum(src).alias(f"_t_{out}") for out, src in sums.items()])
    bkt_order = F.col("_bkt").desc() if descending else F.col("_bkt").asc()
    before = Window.partitionBy(*group_cols).orderBy(bkt_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group_cols,
        "_bkt",
        *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_o_{out}") for out in sums],
    )
    val_order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    fine = Window.partitionBy(*group_cols, "_bkt").orderBy(val_order).rowsBetween(Window.unboundedPreceding, 0)
    out = join_null_safe(staged, offsets, [*group_cols, "_bkt"])
    out = out.withColumns({name: F.sum(src).over(fine) + F.col(f"_o_{name}") for name, src in sums.items()})
    return out.drop("_bkt", *[f"_o_{name}" for name in sums])


def day_bucket(ts: Column) -> Column:
    """Day number of a date or timestamp: a monotone bucket along ``(date, key)``. A customer has at most one
    bucket per day of history (a few thousand), however many orders they own."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
