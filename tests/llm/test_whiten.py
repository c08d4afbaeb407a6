from collections import Counter

import numpy as np
import pytest

from propensity.llm import whiten

DDL = "vec_id long, embedding array<float>, label int, component string, x string, dim string"


def frame(spark, data):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in data], DDL)


def plain(data, components=8):
    """vec_id → (deviation, whitened row) of the vectors of one dimension, by an eigenvalue decomposition."""
    ok = [(i, v) for i, v in data if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in ok], np.int64)
    n, s = len(x), x.sum(0)
    centred = x.astype(np.float64) - s / n
    e, w = np.linalg.eigh(centred.T @ centred / n)
    e, w = e[::-1], w[:, ::-1]
    deviation = [sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, s)) for row in x]
    return [i for i, _ in ok], deviation, centred @ w[:, :components] / np.sqrt(e[:components]), e[:components] / e.sum()


def check(found, data, components=8):
    ids, deviation, white, share = plain(data, components)
    width = white.shape[1]
    seen = Counter()

    def place(r):  # copies of a row one after the other
        key = (-1 if r["vec_id"] is None else r["vec_id"], r["deviation"])
        seen[key, r["component"]] += 1
        return (*key, seen[key, r["component"]], r["component"])

    found = sorted(found, key=place)
    order = sorted(range(len(ids)), key=lambda k: (-1 if ids[k] is None else ids[k], deviation[k]))
    assert len(found) == len(ids) * width
    got = np.array([r["whitened"] for r in found]).reshape(-1, width)
    want = white[order]
    signs = np.sign((got * want).sum(0))
    assert np.allclose(got, want * signs, atol=1e-6)
    for k, i in enumerate(order):
        for c in range(width):
            r = found[k * width + c]
            assert (r["vec_id"], r["component"], r["n"], r["deviation"]) == (ids[i], c + 1, len(ids), deviation[i])
            assert r["explained"] == pytest.approx(share[c], rel=1e-6)
            assert r["identity_error"] < 1e-9


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.normal(size=(12, 12)))[0] * np.geomspace(1, 1e-2, 12)
    data = [(i, [float(np.float32(c)) for c in rng.normal(size=12) @ turn + 3]) for i in range(400)]
    data += [(7, data[7][1]), (7, data[7][1]), (None, data[3][1]), (900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (904, [])]
    check(whiten.whiten(frame(spark, data)).collect(), [d for d in data if d[1] != []])


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(np.float32(c)) for c in rng.normal(size=3)]) for i in range(50)]
    check(whiten.whiten(frame(spark, data)).collect(), data)


def test_without_variance(spark):
    rng = np.random.default_rng(2)
    two = [[float(c) for c in np.float32(rng.normal(size=2))] for _ in range(60)]
    found = whiten.whiten(frame(spark, [(i, [a, b, a, 1.0]) for i, (a, b) in enumerate(two)])).collect()  # rank 2 of 4
    by = {}
    for r in found:
        by.setdefault(r["component"], []).append(r)
    assert sorted(by) == [1, 2, 3, 4] and all(len(v) == 60 for v in by.values())
    assert all(r["whitened"] is None and r["explained"] == 0 for c in (3, 4) for r in by[c])
    for c in (1, 2):
        w = np.array([r["whitened"] for r in by[c]])
        assert abs(w.mean()) < 1e-9 and abs((w ** 2).mean() - 1) < 1e-9
    same = whiten.whiten(frame(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])])).collect()
    assert len(same) == 4 and all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] == 0 for r in same)


def test_dimensions_apart_large_values_and_empty(spark):
    rng = np.random.default_rng(3)
    a = [(i, [float(c) for c in np.float32(rng.normal(size=2))]) for i in range(30)]
    b = [(100 + i, [float(c) for c in np.float32(rng.normal(size=3))]) for i in range(30)]
    found = whiten.whiten(frame(spark, a + b)).collect()
    check([r for r in found if r["vec_id"] < 100], a)
    check([r for r in found if r["vec_id"] >= 100], b)
    huge = whiten.whiten(frame(spark, [(1, [3e38]), (2, [-3e38]), (3, [0.0])])).collect()
    assert [r["deviation"] for r in huge if r["vec_id"] == 1] == [None] and all(np.isfinite(r["whitened"]) for r in huge)
    assert whiten.whiten(frame(spark, [])).collect() == []


def test_ill_conditioned_rows_become_orthonormal(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 1)) * 3000
    data = [(i, [float(np.float32(c)) for c in (row + e)]) for i, (row, e) in enumerate(zip(base, rng.normal(size=(300, 6)) * 1e-2))]
    found = whiten.whiten(frame(spark, data)).collect()
    w = np.array([r["whitened"] for r in sorted(found, key=lambda r: (r["vec_id"], r["component"]))]).reshape(-1, 6)
    assert np.abs(w.T @ w / 300 - np.eye(6)).max() < 1e-8 and found[0]["identity_error"] < 1e-8


def test_sums_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(np.float32(c)) for c in rng.normal(size=4)]) for i in range(200)]
    rows = [sorted(((r["vec_id"], r["component"]), r["deviation"], round(r["whitened"], 9)) for r in whiten.whiten(frame(spark, data).repartition(k)).collect()) for k in (1, 7)]
    assert rows[0] == rows[1]
