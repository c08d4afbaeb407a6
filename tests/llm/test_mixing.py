import math
import re

import pytest
from pyspark.sql import functions as F

from propensity.llm import mixing


def targets(sizes):
    """sizes: {source: size}; water filling done the slow way."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        lam = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * lam > 2 * sizes[s]}
        if not over:
            return out | {s: weight[s] * lam for s in open_}
        for s in over:
            out[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
        open_ -= over
    return out


def check(df, block=mixing.BLOCK_WORDS, **options):
    got = mixing.mix_sources(df, block=block, **options).collect()
    want = {}
    for r in df.select("doc_id", "source", "text").collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        want[r.source] = want.get(r.source, 0) + n
    assert len(got) == df.count()
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    aim = targets(want)
    by = {}
    src = {(r.doc_id): r.source for r in df.select("doc_id", "source").collect()}
    for r in got:
        s = src[r.doc_id]
        assert r.source_size == want[s] and math.isclose(r.target, aim[s], rel_tol=1e-9, abs_tol=1e-6)
        by[s] = by.get(s, 0) + r.taken
    return by, aim, got


def test_small_tables(documents):
    by, aim, got = check(documents)
    assert all(abs(by[s] - aim[s]) <= 2 * mixing.BLOCK_WORDS + 0.01 * aim[s] for s in aim)
    again = mixing.mix_sources(documents.repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_many_shards(documents):
    by, aim, _ = check(documents, shard_words=500)
    assert all(abs(by[s] - aim[s]) <= 0.05 * aim[s] + 64 for s in aim)


def test_capped_sources(spark):
    rows = [(i, "w " * n, s, None) for i, (n, s) in enumerate([(5000, "a"), (10, "b"), (700, "c"), (3, "Z"), (900, None), (0, "e"), (40, "ß")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target double")
    by, aim, _ = check(df, block=1)
    assert any(math.isclose(aim[s], 2 * n) for s, n in (("Z", 3), ("b", 10)))
    assert all(abs(by[s] - aim[s]) <= 2 for s in aim)


def test_seats_are_the_highest_quotients(spark):
    import heapq
    votes = {"a": 533.0, "b": 271.5, "c": 12.0, "d": 99.5, "e": 0.0, "f": 333.25}
    df = spark.createDataFrame([(s, int(v), v) for s, v in votes.items()], "source string, source_size long, target double")
    got = {r.source: r.quota for r in mixing.source_quotas(df, block=10).collect()}
    house = math.floor(sum(votes.values()) / 10 + 0.5)
    best = heapq.nlargest(house, ((v / (2 * k + 1), s) for s, v in votes.items() for k in range(200)))
    assert got == {s: sum(x[1] == s for x in best) for s in votes}


def test_edges(odd_documents, no_documents):
    df = odd_documents.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))
    got = mixing.mix_sources(odd_documents).collect()
    assert len(got) == odd_documents.count() and all(r.taken == 0 for r in got if r.size == 0)
    assert df.count() == len(got)
    assert mixing.mix_sources(no_documents).count() == 0
    assert mixing.apply_mix(no_documents).count() == 0


@pytest.mark.parametrize("block", [1, 16])
def test_applied_mix_has_the_taken_words(documents, odd_documents, block):
    for docs in (documents, odd_documents.dropDuplicates(["doc_id"])):
        plan = {r.doc_id: r.taken for r in mixing.mix_sources(docs, block=block).collect() if r.taken}
        out = mixing.apply_mix(docs, block=block)
        assert out.columns == docs.columns
        found = {}
        for r in out.select("doc_id", "text", "n_chars").collect():
            assert r.n_chars == len(r.text)
            found[r.doc_id] = found.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert found == plan


def test_small_sources_come_near_their_targets(spark):
    sizes = [(115, "a"), (115, "b"), (115, "c"), (3000, "d"), (40_000, "e")]
    rows = [(100 * j + i, "w " * (n // 5), s) for j, (n, s) in enumerate(sizes) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    by, aim, _ = check(df)
    assert all(abs(by[s] - aim[s]) <= max(0.01 * aim[s], 1) for s in aim)


def test_small_blocks_have_the_highest_quotients(spark):
    import heapq
    votes = {"a": 53_300.0, "b": 2710.0, "c": 120.0}
    df = spark.createDataFrame([(s, int(v), v) for s, v in votes.items()], "source string, source_size long, target double")
    got = {r.source: (r.block, r.quota) for r in mixing.source_quotas(df, block=16, least=1000).collect()}
    block = {"a": 16, "b": 2, "c": 1}
    house = math.floor(sum(v / block[s] for s, v in votes.items()) + 0.5)
    best = heapq.nlargest(house, ((v / block[s] / (2 * k + 1), s) for s, v in votes.items() for k in range(4000)))
    assert got == {s: (block[s], sum(x[1] == s for x in best)) for s in votes}


def test_reruns_of_repeated_ids_cut_the_same_texts(spark):
    rows = [(i % 3, " ".join(f"t{i}w{j}" for j in range(37)), "ab"[i % 2], 37, "en" if i < 30 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, lang string")
    runs = [sorted(map(repr, mixing.apply_mix(df.repartition(n)).collect())) for n in (1, 2, 3)]
    assert runs[0] == runs[1] == runs[2]
