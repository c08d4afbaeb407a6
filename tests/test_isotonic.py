import random
from fractions import Fraction

import pytest

from propensity.operators import calibrate as cal

SCHEMA = "model string, split string, id long, target int, proba double"


def plain(points):
    """points: {score: (pos, n)}; the largest over starts of the smallest mean over ends."""
    xs = sorted(points)
    fit = {}
    for i in range(len(xs)):
        best = None
        for a in range(i + 1):
            low = None
            for b in range(i, len(xs)):
                mean = Fraction(sum(points[x][0] for x in xs[a:b + 1]), sum(points[x][1] for x in xs[a:b + 1]))
                low = mean if low is None or mean < low else low
            best = low if best is None or low > best else best
        fit[xs[i]] = best
    return fit


def make(seed, n, digits):
    rnd = random.Random(seed)
    rows = []
    for model in ("a", "b"):
        for i in range(n):
            p = round(rnd.random(), digits)
            y = int(rnd.random() < (p if model == "a" else 1 - p))
            rows.append((model, "val" if i % 3 else "test", i, None if i % 17 == 0 else y, p))
    return rows


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_blocks_equal_the_plain_fit(spark, ranges):
    rows = make(3, 90, 2)
    blocks = cal.isotonic_blocks(spark.createDataFrame(rows, SCHEMA), ranges=ranges).collect()
    for model in ("a", "b"):
        points = {}
        for m, split, _, y, p in rows:
            if m == model and split == "val" and y is not None:
                pos, n = points.get(p, (0, 0))
                points[p] = (pos + y, n + 1)
        want = plain(points)
        mine = sorted((b for b in blocks if b.model == model), key=lambda b: b.block)
        assert [b.block for b in mine] == list(range(1, len(mine) + 1))
        for x, v in want.items():
            (hit,) = [b for b in mine if b.lo <= x <= b.hi]
            assert Fraction(hit.pos, hit.n) == v
        assert sum(b.n for b in mine) == sum(n for _, n in points.values())
        assert all(x.rate < y.rate and x.hi < y.lo for x, y in zip(mine, mine[1:]))


def test_map_ends_gaps_and_nulls(spark):
    rows = [("a", "val", 1, 0, 0.2), ("a", "val", 2, 1, 0.6), ("a", "test", 3, None, 0.1), ("a", "test", 4, None, 0.4),
            ("a", "test", 5, 1, 0.9), ("a", "test", 6, 0, None), ("c", "test", 7, 1, 0.5)]
    got = {r.id: r for r in cal.isotonic(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: got[i].proba for i in (1, 2, 3, 5, 6, 7)} == {1: 0.0, 2: 1.0, 3: 0.0, 5: 1.0, 6: None, 7: None}
    assert got[4].proba == pytest.approx(0.5) and got[4].model == "a_isotonic"
    empty = spark.createDataFrame([], SCHEMA)
    assert cal.isotonic(empty).count() == 0 and cal.isotonic_blocks(empty).count() == 0


def test_blocks_are_few(spark):
    rows = make(9, 3000, 6)
    blocks = cal.isotonic_blocks(spark.createDataFrame(rows, SCHEMA)).groupBy("model").count().collect()
    assert all(b["count"] <= 2 * 2000 ** (2 / 3) for b in blocks)
