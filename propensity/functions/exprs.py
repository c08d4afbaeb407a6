"""Small column-expression helpers shared by the operators (all JVM-side, no UDFs)."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The threshold grid 0.10 … 0.90 in steps of 0.01, i.e. k / 100 for k = 10 … 90.
THRESHOLD_K_MIN, THRESHOLD_K_MAX = 10, 90
# Calibration bins are ten equal-width bins over [0, 1]; the inner edges are i * 0.1.
CALIBRATION_BINS = 10
DECIMALS = 4


def calibration_edges(n_bins: int = CALIBRATION_BINS) -> list[float]:
    """Inner bin edges ``i * (1 / n_bins)`` as doubles (0.30000000000000004, not 0.3)."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def rnd(c: Column | str, decimals: int = DECIMALS) -> Column:
    """Round half away from zero on the binary value: ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.

    Written with plain IEEE operations so every engine gives the same bits (built-in ``round`` differs
    between engines on exact halves)."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** decimals)
    return (F.signum(c) * F.floor(F.abs(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def py_rnd(x: float, decimals: int = DECIMALS) -> float:
    """Driver-side twin of ``rnd`` for values already collected (same IEEE steps)."""
    scale = float(10 ** decimals)
    return math.copysign(math.floor(abs(x) * scale + 0.5) / scale, x) if x else 0.0


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are non-NULL; NULL (not an error, not NaN) when either
    side is constant. ``covar_pop / (stddev_pop * stddev_pop)`` on the same pairs."""
    xs = F.when(y.isNotNull(), x)
    ys = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(xs) * F.stddev_pop(ys))


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` with 0 for a zero (or NULL) denominator, as the reference's zero_division=0."""
    return F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def threshold_index(p: Column) -> Column:
    """Largest k in [10, 90] with ``k / 100.0 <= p`` (9 when p < 0.10), exact at the edges.

    ``floor(p * 100)`` alone is wrong at edges (0.29 * 100 = 28.999…), so it is corrected by comparing
    with the double ``k / 100.0`` itself."""
    k0 = F.floor(p * F.lit(100.0)).cast("int")
    k = (
        k0
        - F.when(p < k0.cast("double") / F.lit(100.0), 1).otherwise(0)
        + F.when(p >= (k0 + 1).cast("double") / F.lit(100.0), 1).otherwise(0)
    )
    return F.least(F.greatest(k, F.lit(THRESHOLD_K_MIN - 1)), F.lit(THRESHOLD_K_MAX))


def calibration_bin(p: Column, n_bins: int = CALIBRATION_BINS) -> Column:
    """Bin index in [0, n_bins-1]: number of inner edges ``<= p`` (lower edge inclusive, last bin closed)."""
    terms = [F.when(p >= F.lit(e), 1).otherwise(0) for e in calibration_edges(n_bins)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out.cast("int")
