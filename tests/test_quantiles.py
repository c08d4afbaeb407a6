import random

import numpy as np
import pytest

from propensity.functions.quantiles import exact_quantiles


def test_exact_quantiles_equal_numpy_linear(spark):
    rng = random.Random(11)
    vals = [5.0] * 700 + [rng.gauss(0, 3) for _ in range(600)] + [float(rng.randrange(10)) for _ in range(300)]
    rows = [(v, float(i % 7) if i % 5 else None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {r.feature: r for r in exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75]).collect()}
    for col, data in (("a", [r[0] for r in rows]), ("b", [r[1] for r in rows if r[1] is not None])):
        for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            assert got[col][name] == pytest.approx(float(np.quantile(data, q)), rel=1e-12, abs=1e-12)
        assert got[col].n == len(data)
