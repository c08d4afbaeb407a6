"""Feature engineering.

Fitting reads the training split only and returns small driver-side state (levels, medians, means,
standard deviations); applying that state is a narrow projection with literal values, so the same
fitted state transforms batch or streaming frames without a shuffle. The state persists as a small
manifest table (A5/A6).
"""
from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions.exprs import py_rnd, rnd
from propensity.functions.order import hash_bucket, md5_key, row_number_within
from propensity.functions.quantiles import exact_quantiles
from propensity.sources import campaign as cf


@dataclass(frozen=True)
class FeatureSpec:
    """Semantic roles of the raw columns (the reference fixes these by constants)."""
    id: str = "id"
    target: str = "target"
    nominal: tuple[str, ...] = tuple(cf.NOMINAL)
    ordinal: dict[str, list[str]] = field(default_factory=lambda: {cf.ORDINAL: list(cf.PRIORITY_ORDER)})
    sentinels: dict[str, tuple[float, str]] = field(
        default_factory=lambda: {cf.SENTINEL_COL: (cf.SENTINEL_VALUE, cf.SENTINEL_FLAG)})
    numeric: tuple[str, ...] = tuple(cf.NUMERIC)
    leaky: tuple[str, ...] = tuple(cf.LEAKY)
    drop_leaky: bool = False

    def tree_columns(self) -> list[str]:
        """Tree-variant column order: ordinal and numeric columns in table order, flags, nominals."""
        cols = list(self.ordinal) + [c for c in self.numeric if not (self.drop_leaky and c in self.leaky)]
        return cols + [flag for _, flag in self.sentinels.values()] + list(self.nominal)


CAMPAIGN_SPEC = FeatureSpec()


def sentinel_flag(df: DataFrame, col: str, value: float, flag: str) -> DataFrame:
    """``flag = (col != value)``, and the sentinel becomes NULL."""
    return df.withColumns({flag: (F.col(col) != F.lit(value)).cast("int"),
                           col: F.when(F.col(col) != F.lit(value), F.col(col))})


def ordinal_expr(col: str, order: Sequence[str]) -> Column:
    """Position of the value in ``order`` as a double; anything else (``unknown``) is NULL."""
    m = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(float(i)))])
    return m[F.col(col)]


def engineer(df: DataFrame, spec: FeatureSpec = CAMPAIGN_SPEC) -> DataFrame:
    """Tree variant (C1, C2, C4): sentinels split into NULL + flag, ordinals encoded, nominals kept as
    strings, leaky columns kept unless ``drop_leaky``."""
    out = df
    for col, (value, flag) in spec.sentinels.items():
        out = sentinel_flag(out, col, value, flag)
    out = out.withColumns({c: ordinal_expr(c, order) for c, order in spec.ordinal.items()})
    if spec.drop_leaky:
        out = out.drop(*spec.leaky)
    return out


def dummy_name(col: str, level: str) -> str:
    return f"{col}_{re.sub(r'[^0-9A-Za-z]+', '_', level)}"


def dummy_names(levels: dict[str, list[str]]) -> dict[tuple[str, str], str]:
    """Column name of every (nominal, level) but the base levels. Levels that clean up to one name (``B C``,
    ``B-C``) are numbered in level order, so no dummy hides another."""
    names: dict[tuple[str, str], str] = {}
    taken: set[str] = set()
    for c, lvs in levels.items():
        for lv in lvs[1:]:
            name, n = dummy_name(c, lv), 1
            while name in taken:
                n += 1
                name = f"{dummy_name(c, lv)}__{n}"
            taken.add(name)
            names[c, lv] = name
    return names


def fit_levels(train: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct levels per nominal column from the training rows, all columns in one aggregate. One-hot
    makes a model column per level, so the levels are as many as the model has columns."""
    if not cols:
        return {}
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in cols])
    found = train.select(F.inline(items)).where(F.col("level").isNotNull()).distinct()
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in found.collect():
        levels[r["feature"]].append(r["level"])
    return {c: sorted(lvs) for c, lvs in levels.items()}


def one_hot_exprs(levels: dict[str, list[str]]) -> dict[str, Column]:
    """K-1 dummy columns per nominal column; the alphabetically first train level is the base.
    Levels unseen in training and NULL give all zeros."""
    return {name: F.coalesce(F.col(c).cast("string") == F.lit(lv), F.lit(False)).cast("double")
            for (c, lv), name in dummy_names(levels).items()}


def fit_medians(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact median per column on the training rows (scalable exact quantiles)."""
    rows = exact_quantiles(train, list(cols), [0.5], ["median"]).collect()
    got = {r["feature"]: r["median"] for r in rows}
    return {c: got.get(c) for c in cols}


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, one aggregate; zero std scales by 1."""
    row = train.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]).first()
    out = {}
    for c in cols:
        m, s = row[c]["m"], row[c]["s"]
        out[c] = (float(m or 0.0), float(s) if s else 1.0)
    return out


@dataclass
class Preprocessor:
    """Fitted preprocessing state (C12): everything comes from the training rows."""
    spec: FeatureSpec
    levels: dict[str, list[str]]
    medians: dict[str, float | None]
    scaler: dict[str, tuple[float, float]]
    numeric_columns: list[str]

    def tree(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        eng = engineer(df, self.spec)
        return eng.select(*keep, *self.spec.tree_columns())

    def numeric(self, df: DataFrame, keep: Sequence[str] = (), impute: bool = True) -> DataFrame:
        """Numeric variant: one-hot + median impute, in the train column order."""
        eng = engineer(df, self.spec)
        dummies = one_hot_exprs(self.levels)
        cols = []
        for c in self.numeric_columns:
            e = dummies[c] if c in dummies else (F.col(c).cast("double") if c in eng.columns else F.lit(0.0))
            if impute and c in self.medians and self.medians[c] is not None:
                e = F.coalesce(e, F.lit(float(self.medians[c])))
            cols.append(e.alias(c))
        return eng.select(*keep, *cols)

    def scaled(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Scaled variant: ``(x - mean) / std`` with train statistics."""
        num = self.numeric(df, keep)
        return num.select(*keep, *[((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, (m, s) in self.scaler.items()])

    def manifest_rows(self) -> list[tuple]:
        """``(kind, feature, position, value)`` rows: the persisted form."""
        rows = [("spec", "", 0, json.dumps({"drop_leaky": self.spec.drop_leaky}))]
        rows += [("column", c, i, "") for i, c in enumerate(self.numeric_columns)]
        rows += [("level", c, i, lv) for c, lvs in self.levels.items() for i, lv in enumerate(lvs)]
        rows += [("median", c, 0, json.dumps(v)) for c, v in self.medians.items()]
        rows += [("scaler", c, 0, json.dumps(list(v))) for c, v in self.scaler.items()]
        return rows

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.manifest_rows(), "kind string, feature string, position int, value string") \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: FeatureSpec = CAMPAIGN_SPEC) -> "Preprocessor":
        rows = spark.read.parquet(path).orderBy("kind", "feature", "position").collect()
        levels: dict[str, list[str]] = {}
        medians, scaler, cols = {}, {}, []
        for r in rows:
            if r.kind == "column":
                cols.append((r.position, r.feature))
            elif r.kind == "level":
                levels.setdefault(r.feature, []).append(r.value)
            elif r.kind == "median":
                medians[r.feature] = json.loads(r.value)
            elif r.kind == "scaler":
                scaler[r.feature] = tuple(json.loads(r.value))
        missing = [k for k, v in (("column", cols), ("scaler", scaler)) if not v]
        if missing:
            raise FileNotFoundError(f"preprocessing manifest at {path} lacks {missing}; fit and save it first")
        return cls(spec, levels, medians, scaler, [c for _, c in sorted(cols)])


def fit_preprocessor(train: DataFrame, spec: FeatureSpec = CAMPAIGN_SPEC) -> Preprocessor:
    """Fit levels, medians and scaler on the training rows only."""
    eng = engineer(train, spec)
    levels = fit_levels(eng, list(spec.nominal))
    base = [c for c in spec.tree_columns() if c not in spec.nominal]
    dummies = list(one_hot_exprs(levels))
    numeric_columns = base + dummies
    num_no_impute = Preprocessor(spec, levels, {}, {}, numeric_columns).numeric(train, impute=False)
    medians = fit_medians(num_no_impute, base)  # dummies are never NULL
    pre = Preprocessor(spec, levels, medians, {}, numeric_columns)
    pre.scaler = fit_scaler(pre.numeric(train), numeric_columns)
    return pre


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project onto the training column list: missing columns are 0, extra columns dropped,
    existing columns pass unchanged (their NULLs stay NULL)."""
    have = set(df.columns)
    return df.select(*keep, *[(F.col(c).cast("double") if c in have else F.lit(0.0)).alias(c) for c in columns])


def scale_check(scaled_train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Largest |mean| and largest |population std - 1| over the scaled training columns."""
    stats = scaled_train.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols])
    return stats.select(
        rnd(F.greatest(*[F.abs(F.col(f"{c}.m")) for c in cols]), 6).alias("max_abs_mean"),
        rnd(F.greatest(*[F.abs(F.col(f"{c}.s") - 1.0) for c in cols]), 6).alias("max_abs_std_dev"),
    )


def expand_to_columns(originals: Sequence[str], levels: dict[str, list[str]]) -> list[str]:
    """C14: original names → model columns (a nominal expands to its exact dummy list)."""
    out, names = [], dummy_names(levels)
    for c in originals:
        out += [names[c, lv] for lv in levels[c][1:]] if c in levels else [c]
    return out


def columns_to_originals(columns: Sequence[str], levels: dict[str, list[str]]) -> list[str]:
    """Model columns → original names, first occurrence wins."""
    back = {name: c for (c, _), name in dummy_names(levels).items()}
    seen: list[str] = []
    for c in columns:
        o = back.get(c, c)
        if o not in seen:
            seen.append(o)
    return seen


def slice_variant(df: DataFrame, selected: Sequence[str], keep: Sequence[str] = ("id", "split", "target")) -> DataFrame:
    """Project a variant onto the selected model columns (column pruning reaches the scan)."""
    return df.select(*[c for c in keep if c in df.columns], *selected)


def stratified_kfold(df: DataFrame, k: int = 5, id_col: str = "id", target: str = "target", seed: int = cf.SPLIT_SEED) -> DataFrame:
    """``fold = (rank in class by md5(id-seed) - 1) % k``: class shares equal in every fold."""
    ranked = row_number_within(df.withColumn("_h", md5_key(id_col, seed)), [target], [F.col("_h"), F.col(id_col)],
                               hash_bucket(F.col("_h")), out="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_h", "_rank")


def stratified_subsample(df: DataFrame, n: int, rate: float | None = None, id_col: str = "id", target: str = "target",
                         seed: int = cf.SPLIT_SEED) -> DataFrame:
    """``n_pos = max(1, int(n * rate))`` positives and ``n - n_pos`` negatives, first by md5 rank;
    ``n >= rows`` keeps everything. ``rate`` defaults to the table's positive rate."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target)).alias("p")).first()
    total, positives = int(stats["n"]), int(stats["p"] or 0)
    if n >= total:
        return df
    r = rate if rate is not None else positives / total
    n_pos = max(1, int(n * r))
    n_neg = n - n_pos
    ranked = row_number_within(df.withColumn("_h", md5_key(id_col, seed)), [target], [F.col("_h"), F.col(id_col)],
                               hash_bucket(F.col("_h")), out="_rank")
    keep = F.when(F.col(target) == 1, F.col("_rank") <= n_pos).otherwise(F.col("_rank") <= n_neg)
    return ranked.filter(keep).drop("_h", "_rank")


def preprocess_report(pre: Preprocessor, train: DataFrame) -> DataFrame:
    """``(feature, transformation, stat, value)`` from the fitted state and one aggregate."""
    spark = train.sparkSession
    spec = pre.spec
    aggs = []
    for col, (value, _flag) in spec.sentinels.items():
        aggs.append(F.sum(F.when(F.col(col) == value, 1).otherwise(0)).cast("double").alias(f"s__{col}"))
    for col, order in spec.ordinal.items():
        aggs.append(F.sum(F.when(F.col(col).isNotNull() & ~F.col(col).isin(*order), 1).otherwise(0))
                    .cast("double").alias(f"o__{col}"))
    counts = train.agg(*aggs).first() if aggs else None
    rows = []
    for col in spec.sentinels:
        rows.append((col, "sentinel_to_null", "n_sentinel_replaced", counts[f"s__{col}"]))
    for col in spec.ordinal:
        rows.append((col, "ordinal_encode", "n_unknown_to_null", counts[f"o__{col}"]))
    for col, lvs in pre.levels.items():
        rows.append((col, "one_hot_drop_first", "n_levels", float(len(lvs))))
    for col, m in pre.medians.items():
        rows.append((col, "median_impute", "median", None if m is None else py_rnd(float(m), 6)))
    for col, (m, s) in pre.scaler.items():
        rows.append((col, "standard_scale", "mean", py_rnd(m, 6)))
        rows.append((col, "standard_scale", "std", py_rnd(s, 6)))
    return spark.createDataFrame(rows, "feature string, transformation string, stat string, value double")
