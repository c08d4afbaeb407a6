"""Profiling plan (B6 + target analysis): every table of the exploratory report from one stage table."""
from __future__ import annotations

from pyspark.sql import DataFrame

from propensity.operators import profile as pf
from propensity.session import materialize
from propensity.sources.io import write_table


def run_eda(df: DataFrame, out_dir: str | None = None, target: str | None = "target",
            sentinel: tuple[str, float] | None = None) -> dict[str, DataFrame]:
    """Profile, describe, missing, value counts, histograms and (with a target) distribution, correlation
    and per-category rates. Tables are written under ``out_dir`` when given."""
    cached = materialize(df)
    tables = {
        "profile_numeric": pf.profile_numeric(cached),
        "profile_categorical": pf.profile_categorical(cached),
        "describe": pf.describe(cached),
        "missing": pf.missing(cached),
        "value_counts": pf.value_counts(cached),
        "histograms": pf.histograms(cached),
    }
    if target and target in df.columns:
        tables["target_distribution"] = pf.target_distribution(cached, target)
        tables["corr_with_target"] = pf.corr_with_target(cached, target)
        tables["target_rates"] = pf.target_rate_by_category(cached, target)
    if sentinel:
        tables["sentinel_share"] = pf.sentinel_share(cached, *sentinel)
    if out_dir:
        for name, t in tables.items():
            write_table(t, f"{out_dir.rstrip('/')}/{name}")
    return tables
