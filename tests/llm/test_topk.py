import numpy as np

from propensity.llm import topk

DDL = "vec_id long, embedding array<float>, label int, score string, rank int"


def brute(data, k=5, every=50):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in data
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in ok:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, qv in asked.items():
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


def run(spark, data, **options):
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in data], DDL)
    return sorted(tuple(r) for r in topk.top_k(df, **options).collect())


def test_edge_cases(spark):
    f32 = lambda v: [float(np.float32(x)) for x in v]
    rng = np.random.default_rng(0)
    data = [(i, f32(rng.normal(size=6))) for i in range(120)]
    data += [(0, f32(rng.normal(size=6))), (7, data[7][1]), (7, data[7][1]), (None, f32(np.ones(6))), (200, None), (201, []),
             (202, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (203, [float("nan")] * 6), (204, [float("inf")] * 6), (250, f32([1, 2])), (251, f32([3, 4])), (300, [0.0] * 6)]
    assert run(spark, data) == brute(data)


def test_large_values_stay_exact(spark):
    data = [(i, [float(np.float32(v)) for v in ((i % 7 - 3) * 1e5, i * 3e4, -i * 1e5)]) for i in range(60)]
    assert run(spark, data) == brute(data)


def test_ties_and_few_rows(spark):
    assert run(spark, [(i, [1.0, 1.0]) for i in range(0, 200, 20)]) == brute([(i, [1.0, 1.0]) for i in range(0, 200, 20)])
    assert run(spark, [(50, [1.0])]) == []
    assert run(spark, []) == []


def test_many_blocks_and_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK_BYTES", 8 * 6 * 3)
    rng = np.random.default_rng(1)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * rng.choice([0.1, 1, 5])]) for i in range(900)]
    assert run(spark, data) == brute(data)


def offered(v, queries, step=500):
    turn = np.linalg.svd(v.astype(float), full_matrices=False)[2].T
    block = topk.QueryBlock(np.arange(queries), v[:queries], turn, 5)
    for a in range(0, len(v), step):
        block.offer(np.arange(a, min(len(v), a + step)), v[a:a + step])
    exact = v[:queries] @ v.T
    np.fill_diagonal(exact, -(1 << 60))
    for q in range(queries):
        own = block.best[0] == q
        want = np.lexsort((np.arange(len(v)), -exact[q]))[:5]
        assert sorted(zip(-block.best[2][own], block.best[1][own])) == [(-exact[q, i], i) for i in want]
    return block


def test_bounds_prune(monkeypatch):
    """Few pairs reach an exact product when lengths differ or a few directions carry most of the lengths."""
    monkeypatch.setattr(topk, "TRIAL_PAIRS", 0)
    rng = np.random.default_rng(2)
    lengths = np.floor(rng.normal(size=(4000, 64)) * rng.lognormal(0, 1, (4000, 1)) * 40).astype(np.int64)
    flat = np.floor(rng.normal(size=(4000, 64)) * np.geomspace(400, 1, 64)).astype(np.int64)
    for v in (lengths, flat):
        monkeypatch.setattr(topk, "USEFUL", 1.1)  # every cut is made
        block = offered(v[np.argsort(-(v ** 2).sum(1), kind="stable")], 50)
        assert block.left[-2] < 0.2 * 50 * 4000


def test_cuts_that_rule_nothing_out_are_left_out(monkeypatch):
    monkeypatch.setattr(topk, "TRIAL_PAIRS", 1)
    rng = np.random.default_rng(3)
    v = rng.integers(-300, 300, (6000, 64))
    block = offered(v[np.argsort(-(v ** 2).sum(1), kind="stable")], 40)
    assert block.tested[0] < 0.5 * 40 * 6000


def test_ties_inside_and_across_blocks():
    v = np.tile(np.arange(1, 65, dtype=np.int64), (300, 1))
    offered(v, 20, step=40)
