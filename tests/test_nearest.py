import math
import random

import pytest

from propensity.operators import nearest


def psi(n):
    return -0.5772156649015329 + sum(1.0 / i for i in range(1, n))


def plain(rows, k):
    """Ross' estimate over (value, class) pairs, every distance computed."""
    rows = [(v, c) for v, c in rows if v is not None and v == v and c is not None]
    size = {}
    for _, c in rows:
        size[c] = size.get(c, 0) + 1
    rows = [(v, c) for v, c in rows if size[c] > 1]
    if not rows:
        return 0.0
    total = 0.0
    for i, (v, c) in enumerate(rows):
        need = min(k, size[c] - 1)
        r = sorted(abs(v - w) for j, (w, d) in enumerate(rows) if d == c and j != i)[need - 1]
        m = sum(v - r < w < v + r for w, _ in rows) if r > 0 else sum(w == v for w, _ in rows)
        total += psi(need) - psi(size[c]) - psi(m)
    return max(psi(len(rows)) + total / len(rows), 0.0)


def table(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        y = rnd.choice([0, 0, 1])
        out.append((i, y, float(rnd.randint(0, 40)), rnd.gauss(2.0 * y, 1.0), rnd.choice([0.0, 1e9, -1e-9, 3.5]),
                    None if i % 7 == 0 else float("nan") if i % 11 == 0 else rnd.random(), 1.0))
    return out


NAMES = ["ties", "shift", "wide", "gaps", "constant"]
SCHEMA = "id long, target int, ties double, shift double, wide double, gaps double, constant double"


@pytest.mark.parametrize("k,options", [(3, {}), (5, {"edges": 4, "steps": 2}), (1, {"edges": 2, "steps": 1000})])
def test_equals_all_distances(spark, k, options):
    rows = table(2000, 7)
    got = {r.feature: r for r in nearest.knn_mutual_information(spark.createDataFrame(rows, SCHEMA), NAMES, k=k, **options).collect()}
    for i, name in enumerate(NAMES):
        assert got[name].position == i
        assert got[name].mi == pytest.approx(plain([(r[2 + i], r[1]) for r in rows], k), abs=1e-8)
    assert got["shift"].mi > 0.2 > got["ties"].mi


def test_small_classes_and_empty_tables(spark):
    rows = [(1, 0, 1.0), (2, 0, 2.0), (3, 0, 2.0), (4, 1, 5.0), (5, 1, 9.0), (6, 2, 3.0), (7, None, 4.0), (8, 1, None)]
    df = spark.createDataFrame(rows, "id long, target int, x double")
    got = nearest.knn_mutual_information(df, ["x"]).first().mi  # class 2 has one row and is left out
    assert got == pytest.approx(plain([(r[2], r[1]) for r in rows], 3), abs=1e-8)
    for none in (df.filter("id < 0"), df.filter("id = 1"), df.filter("x is null")):
        assert [tuple(r) for r in nearest.knn_mutual_information(none, ["x"]).collect()] == [("x", 0, 0.0)]


def test_digamma(spark):
    from pyspark.sql import functions as F
    for r in spark.range(1, 300).select("id", nearest.digamma(F.col("id")).alias("v")).collect():
        assert math.isclose(r.v, psi(r.id), abs_tol=1e-9)


def test_few_values_leave_their_block(spark):
    """intervals are counted inside their block; at most k values of a class on each side need another one."""
    rows = [(i, i % 3 == 0, random.Random(i).gauss(0.0, 1.0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "__class int, y boolean, x double").select("y", "x").withColumnRenamed("y", "__class")
    splits, k = nearest._splits(df, ["x"], 8, 1), 3
    counts = nearest._counts(df, ["x"], splits)
    sizes = counts.groupBy("column", "class").sum("cnt").withColumnRenamed("sum(cnt)", "n_class")
    blocks = nearest._blocks(counts.join(sizes, ["column", "class"]))
    cells = nearest._near(blocks.join(nearest._halo(blocks, k), ["column", "block"], "left"), [splits["x"]], k).collect()
    assert len(cells) == 3000
    assert 0 < sum(c.m is None for c in cells) <= 2 * k * 2 * 8
    values = sorted(r[2] for r in rows)
    for c in cells[::97]:
        near = sorted(abs(c.value - v) for _, y, v in rows if y == c["class"])[k]
        assert c.r == near
        assert c.m in (None, sum(c.value - c.r < v < c.value + c.r for v in values))
