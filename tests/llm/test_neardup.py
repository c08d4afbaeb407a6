import random
import re

import pytest

from propensity.llm import neardup
from propensity.llm.components import components


def sets_of(docs, words):
    out = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        n = min(words, len(w))
        out.append((i, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()))
    return out


def brute(docs, words):
    sets = sets_of(docs, words)
    parent = {i: i for i, _ in sets if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                p, q = top(i), top(j)
                parent[max(p, q)] = min(p, q)
    return sorted(((i, len(s), top(i) if i is not None else None, i is None or top(i) == i) for i, s in sets), key=repr)


def texts(rng, n):
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for family in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 8, 30, 120]))]
        for _ in range(rng.choice([1, 1, 2, 3, 30])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            out.append(rng.choice([" ", "\n", "  "]).join(t))
    return out


def run(spark, docs, words):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, n string, component_id string")
    return sorted((tuple(r) for r in neardup.near_duplicates(df, words).collect()), key=repr)


@pytest.mark.parametrize("words,chunk,bucket", [(2, 400_000, 4096), (2, 600, 8), (5, 400_000, 4096)])
def test_against_all_pairs(spark, monkeypatch, words, chunk, bucket):
    """Also with small chunks and buckets, so that groups are split into pairs of chunks."""
    monkeypatch.setattr(neardup, "CHUNK_SHINGLES", chunk)
    monkeypatch.setattr(neardup, "BUCKET_ROWS", bucket)
    rng = random.Random(words)
    docs = list(enumerate(texts(rng, 60)))
    rng.shuffle(docs)
    docs += [(docs[0][0], docs[0][1]), (None, docs[1][1]), (None, None), (900, None), (901, ""), (902, " \n\t"), (903, "solo"), (904, "SOLO"), (905, "\x1csolo")]
    assert run(spark, docs, words) == brute(docs, words)


def test_template_beyond_the_bound_links_nothing(spark, monkeypatch):
    """Unlike texts of one template fill a bucket of many chunks: the signature check holds there too. Copies of one of
    them with a word changed are found."""
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 20)
    rng = random.Random(4)
    template = [f"t{k}" for k in range(60)]
    docs = [(i, " ".join(template + [f"x{i}y{k}" for k in range(36)])) for i in range(600)]
    signed = neardup.signatures(spark.createDataFrame(docs, "doc_id long, text string"), 1)
    bands = signed.selectExpr("explode(bands) as key").groupBy("key").count().agg({"count": "max"}).first()[0]
    assert bands > 100
    assert neardup.bucket_forest(signed).count() == 0
    copies = [(1000 + k, docs[7][1].replace("t3 ", f"z{k} ").replace("t40 ", f"v{k} ")) for k in range(150)]
    every = docs + copies
    rng.shuffle(every)
    classes = {r[0]: r[2] for r in run(spark, every, 1)}
    assert all(classes[i] == i for i, _ in docs) and all(classes[i] == 7 for i, _ in copies)


def test_same_id_with_other_text_links(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = [(5, a), (5, b), (3, a), (9, b), (1, "else where")]
    got = {(r[0], r[2]) for r in run(spark, docs, 2)}
    assert got == {(5, 3), (3, 3), (9, 3), (1, 1)}


def test_empty(spark):
    assert run(spark, [], 2) == []


def test_drop(odd_documents):
    kept = neardup.drop_near_duplicates(odd_documents, words=2)
    assert kept.columns == odd_documents.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 9, 11] and ids.count(None) == 2


def test_signature_estimates_similarity():
    rng = random.Random(1)
    import numpy as np
    hasher, gap = neardup.MinMax(), []
    for _ in range(30):
        common = np.array(sorted(rng.sample(range(1 << 60), 400)), np.uint64) * np.uint64(7)
        a, b = common[:360], common[40:]
        s = [np.frombuffer(hasher.short(*hasher.ends(np.sort(x))), np.uint8) for x in (a, b)]
        gap.append((s[0] == s[1]).mean() - 0.8)
    assert abs(sum(gap) / len(gap)) < 0.02


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (5, 5)], "a long, b long")
    assert {(r.id, r.component) for r in components(edges).collect()} == {(i, 1) for i in range(1, 61)} | {(100, 100), (101, 100)}


def test_drop_keeps_unlike_rows_of_one_id(spark):
    """A hot id with unlike texts loses only its near copies; the smallest id of a class stays."""
    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))
    rows = [(5, text("a")), (5, text("b")), (5, text("b") + " end"), (5, text("c")), (5, text("c")), (5, None), (5, ""), (9, text("a")), (3, text("c")),
            (7, text("d")), (None, text("a")), (None, text("a"))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.text) for r in neardup.drop_near_duplicates(df).collect()), key=repr)
    want = [(5, text("a")), (5, text("b")), (5, None), (5, ""), (3, text("c")), (7, text("d")), (None, text("a")), (None, text("a"))]
    assert got == sorted(want, key=repr)
