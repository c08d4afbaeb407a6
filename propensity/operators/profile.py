"""Column profiling.

The reference scans a table once per column and statistic; here one wide aggregate computes every
moment of every column in a single pass, and one unpivot + ``groupBy(feature, value)`` gives exact
distinct counts, modes, value counts and (via ``functions.quantiles``) exact quantiles for all columns
at once. Results are long tables keyed by ``feature``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.functions.exprs import rnd, safe_corr
from propensity.functions.quantiles import long_values, number, quantiles_from_counts, value_counts_with_buckets
from propensity.functions.sizing import small_table
from propensity.session import materialize

HIST_BINS = 40
MAX_CLASSES = 10_000
STAT_DECIMALS = 6


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, string) column names in table order."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.NumericType):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat


def _dtypes(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def _pct(part: Column, whole: Column, decimals: int = 2) -> Column:
    return rnd(part.cast("double") * F.lit(100.0) / whole.cast("double"), decimals)


def moments(df: DataFrame, num: Sequence[str], cat: Sequence[str]) -> DataFrame:
    """One pass over the table → long ``(feature, dtype, n_rows, n_nonnull, n_zeros, mean, std, min, max,
    skew)``. Skew is the bias-corrected sample skewness (Spark's ``skewness`` times
    ``sqrt(n(n-1))/(n-2)``); ``std`` is the sample standard deviation."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in num:
        x = number(c)
        aggs += [
            F.count(x).alias(f"{c}__cnt"),
            F.sum(F.when(x == 0, 1).otherwise(0)).cast("long").alias(f"{c}__zeros"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
            F.skewness(x).alias(f"{c}__skew"),
        ]
    for c in cat:
        aggs.append(F.count(F.col(c)).alias(f"{c}__cnt"))
    wide = df.agg(*aggs)
    dt = _dtypes(df)
    nul = F.lit(None).cast("double")

    def row(c: str, numeric: bool) -> Column:
        n = F.col(f"{c}__cnt").cast("double")
        skew = F.col(f"{c}__skew") * F.sqrt(n * (n - 1)) / (n - 2)
        return F.struct(
            F.lit(c).alias("feature"), F.lit(dt[c]).alias("dtype"), F.col("__n").alias("n_rows"),
            F.col(f"{c}__cnt").alias("n_nonnull"),
            (F.col(f"{c}__zeros") if numeric else F.lit(0).cast("long")).alias("n_zeros"),
            (F.col(f"{c}__mean") if numeric else nul).alias("mean"),
            (F.col(f"{c}__std") if numeric else nul).alias("std"),
            (F.col(f"{c}__min") if numeric else nul).alias("min"),
            (F.col(f"{c}__max") if numeric else nul).alias("max"),
            (F.when(n > 2, skew) if numeric else nul).alias("skew"),
        )

    items = [row(c, True) for c in num] + [row(c, False) for c in cat]
    return wide.select(F.inline(F.array(*items)))


def string_counts(df: DataFrame, cat: Sequence[str], nulls: bool = False) -> DataFrame:
    """``(feature, value, count)`` for every string column in one unpivot + aggregate; with ``nulls`` NULL counts as
    a value, so a column's counts add up to all rows."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in cat])
    long = df.select(F.inline(items))
    return (long if nulls else long.filter(F.col("value").isNotNull())).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))


def profile_numeric_approx(df: DataFrame, cols: Sequence[str] | None = None, accuracy: int = 10000) -> DataFrame:
    """The same profile in one pass with sketches: ``approx_count_distinct`` and ``percentile_approx``
    (relative rank error 1/accuracy) instead of the exact distinct/quantile shuffles."""
    num = list(cols) if cols is not None else column_kinds(df)[0]
    mom = moments(df, num, [])
    sk = df.agg(*[F.struct(F.approx_count_distinct(F.col(c)).alias("u"),
                           F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75], accuracy).alias("q")).alias(c)
                  for c in num])
    sk = sk.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}.u").alias("n_unique"),
                                               F.col(f"{c}.q").alias("q")) for c in num])))
    d = STAT_DECIMALS
    return mom.join(sk, "feature").select(
        "feature", "dtype", "n_rows", F.col("n_unique").cast("long").alias("n_unique"),
        (F.col("n_rows") - F.col("n_nonnull")).alias("n_missing"),
        _pct(F.col("n_rows") - F.col("n_nonnull"), F.col("n_rows")).alias("pct_missing"),
        "n_zeros", rnd("mean", d).alias("mean"), rnd("std", d).alias("std"), "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"), "max",
        rnd("skew", d).alias("skew"))


def profile_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """B1 for numeric columns: counts, missing, zeros, mean, std, min, quartiles, max, skew."""
    num = list(cols) if cols is not None else column_kinds(df)[0]
    df = materialize(df.select(*num))  # read for edges, counts and moments
    mom = moments(df, num, [])
    counts = materialize(value_counts_with_buckets(df, num))  # one row per distinct value
    q = quantiles_from_counts(counts, [0.25, 0.5, 0.75], ["q25", "median", "q75"])
    uniq = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"))
    d = STAT_DECIMALS
    return mom.join(uniq, "feature", "left").join(q.drop("n"), "feature", "left").select(
        "feature", "dtype", "n_rows", F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"),
        (F.col("n_rows") - F.col("n_nonnull")).alias("n_missing"),
        _pct(F.col("n_rows") - F.col("n_nonnull"), F.col("n_rows")).alias("pct_missing"),
        "n_zeros", rnd("mean", d).alias("mean"), rnd("std", d).alias("std"), "min",
        rnd("q25", d).alias("q25"), rnd("median", d).alias("median"), rnd("q75", d).alias("q75"), "max",
        rnd("skew", d).alias("skew"),
    )


def top_values(counts: DataFrame) -> DataFrame:
    """Mode per feature: highest count, lowest value on ties."""
    return counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_unique"),
        F.min_by(F.struct("value", "count"), F.struct(-F.col("count"), F.col("value"))).alias("_top"),
    ).select("feature", "n_unique", F.col("_top.value").alias("top_value"), F.col("_top.count").alias("top_count"))


def profile_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """B1 for string columns: counts, missing, mode with its count and share of all rows."""
    cat = list(cols) if cols is not None else column_kinds(df)[1]
    mom = moments(df, [], cat)
    top = top_values(string_counts(df, cat))
    return mom.join(top, "feature", "left").select(
        "feature", "dtype", "n_rows", F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"),
        (F.col("n_rows") - F.col("n_nonnull")).alias("n_missing"),
        _pct(F.col("n_rows") - F.col("n_nonnull"), F.col("n_rows")).alias("pct_missing"),
        "n_zeros", "top_value", F.col("top_count").cast("long").alias("top_count"),
        _pct(F.col("top_count"), F.col("n_rows")).alias("top_pct"),
    )


def describe(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """B2, ``describe(include='all')`` transposed: count (non-null), unique/top/freq for strings,
    mean/std/min/quartiles/max for numbers."""
    num, cat = column_kinds(df, exclude)
    pn = profile_numeric(df, num).select(
        "feature", (F.col("n_rows") - F.col("n_missing")).alias("count"),
        F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
        F.lit(None).cast("long").alias("freq"), "mean", "std", "min",
        F.col("q25").alias("p25"), F.col("median").alias("p50"), F.col("q75").alias("p75"), "max")
    pc = profile_categorical(df, cat).select(
        "feature", (F.col("n_rows") - F.col("n_missing")).alias("count"), F.col("n_unique").alias("unique"),
        F.col("top_value").alias("top"), F.col("top_count").alias("freq"),
        *[F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])
    return pn.unionByName(pc)


def missing(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Missing count and percentage per column (one aggregate), sorted by count desc."""
    cols = [c for c in df.columns if c not in exclude]
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(c) for c in cols])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col("__n") - F.col(c)).alias("n_missing"),
                               F.col("__n").alias("_n")) for c in cols])
    return wide.select(F.inline(items)).select(
        "feature", "n_missing", _pct(F.col("n_missing"), F.col("_n")).alias("pct_missing")
    ).orderBy(F.col("n_missing").desc(), "feature")


def value_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per string column and value, count and percentage of all rows (NULLs not listed)."""
    cat = list(cols) if cols is not None else column_kinds(df)[1]
    counts = string_counts(df, cat, nulls=True)
    rows = F.broadcast(counts.groupBy("feature").agg(F.sum("count").alias("_n")))  # one row per column
    return counts.filter(F.col("value").isNotNull()).join(rows, "feature").select(
        "feature", "value", F.col("count").cast("long").alias("count"), _pct(F.col("count"), F.col("_n")).alias("pct"))


def histograms(df: DataFrame, cols: Sequence[str] | None = None, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histograms between each column's min and max (max falls in the last bin); every
    bin is emitted, empty ones with count 0."""
    num = list(cols) if cols is not None else column_kinds(df)[0]
    rng = df.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(c)
                   for c in num])
    ranges = rng.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}.lo").alias("lo"),
                                                    F.col(f"{c}.hi").alias("hi")) for c in num])))
    ranges = F.broadcast(ranges)  # one row per column
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) * F.lit(float(bins)) / width), F.lit(bins - 1))).cast("int")
    counts = long_values(df, num).join(ranges, "feature").groupBy("feature", b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    grid = ranges.filter(F.col("lo").isNotNull()).select(
        "feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edge = lambda k: F.col("lo") + width * k.cast("double") / F.lit(float(bins))
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", rnd(edge(F.col("bin")), STAT_DECIMALS).alias("bin_lo"),
        rnd(edge(F.col("bin") + 1), STAT_DECIMALS).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def target_distribution(df: DataFrame, target: str = "target") -> DataFrame:
    """Rows per class and their share."""
    counts = small_table(df.groupBy(target).agg(F.count(F.lit(1)).alias("count")), MAX_CLASSES)
    n = F.lit(counts.agg(F.sum("count")).first()[0])  # the sum of the class counts
    return counts.select(F.col(target).alias("target"), "count", rnd(F.col("count") / n).alias("share"))


def corr_with_target(df: DataFrame, target: str = "target", cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric column with the target, in one aggregate."""
    num = [c for c in (cols if cols is not None else column_kinds(df)[0]) if c != target]
    wide = df.agg(*[safe_corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in num])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in num])
    return wide.select(F.inline(items)).select("feature", rnd("corr", STAT_DECIMALS).alias("corr")).orderBy("corr")


def target_rate_by_category(df: DataFrame, target: str = "target", cols: Sequence[str] | None = None) -> DataFrame:
    """Per string column and value, mean target (4 dp) and row count; one unpivot, one aggregate."""
    cat = list(cols) if cols is not None else column_kinds(df)[1]
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in cat])
    long = df.select(F.col(target).alias("_y"), F.inline(items)).filter(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(
        rnd(F.avg("_y")).alias("target_rate"), F.count(F.lit(1)).alias("count")
    ).orderBy("feature", F.col("target_rate").desc(), "value")


def sentinel_share(df: DataFrame, col: str, value: float) -> DataFrame:
    """Rows equal to a sentinel value, count and percentage."""
    return df.agg(F.count(F.lit(1)).alias("_n"), F.sum(F.when(F.col(col) == value, 1).otherwise(0)).alias("n_sentinel")).select(
        F.lit(col).alias("feature"), F.lit(float(value)).alias("sentinel"), F.col("n_sentinel").cast("long").alias("n_sentinel"),
        _pct(F.col("n_sentinel"), F.col("_n")).alias("pct_sentinel"))
