import hashlib
import random

import numpy as np
import pytest

from propensity.llm import repeats


def brute(docs, length=50):
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k:k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if i is not None:
            for k in range(len(b) - length + 1):
                if first[b[k:k + length]] < i:
                    gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, docs, **options):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, pack string, kept int")
    return sorted((tuple(r) for r in repeats.remove_repeats(df, **options).collect()), key=repr)


def texts(rng, n):
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([48, 49, 50, 51, 60, 130, 400]))) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else "".join(rng.choice("efgh \n中") for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(0, 7))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("hot,pack", [(256, 4 << 20), (1, 700), (256, 700)])
def test_against_all_windows(spark, monkeypatch, hot, pack):
    """Small packs send phrases between packs; hot_packs=1 deals every shared trigger window by window."""
    monkeypatch.setattr(repeats, "PACK_BYTES", pack)
    rng = random.Random(pack + hot)
    docs = list(enumerate(texts(rng, 120)))
    rng.shuffle(docs)
    docs += [(docs[0][0], docs[0][1]), (docs[1][0], docs[2][1]), (None, docs[3][1]), (None, None), (500, None), (501, ""), (502, "a" * 49), (503, "a" * 50),
             (504, "a" * 51), (505, "ab" * 400), (506, "ab" * 40), (-7, docs[4][1])]
    assert run(spark, docs, hot_packs=hot) == brute(docs)


def test_edges(spark, odd_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect() if r.doc_id not in (5, 10)]
    got = run(spark, docs)
    assert got == brute(docs)
    full = {r.doc_id: r for r in repeats.remove_repeats(odd_documents, with_text=True).collect()}
    assert full[10].n_removed > 500_000 and len(full[10].kept) == full[10].n_bytes - full[10].n_removed
    assert run(spark, []) == []


def test_equal_windows_have_equal_triggers():
    rng = np.random.default_rng(0)
    body = rng.integers(97, 101, 3000).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 101, 77).astype(np.uint8), body])
    b = np.concatenate([rng.integers(97, 101, 501).astype(np.uint8), body])
    found = []
    for data in (a, b):
        p = repeats.Parse(data, np.array([len(data)]), np.array([True]))
        assert p.windows.max() <= repeats.REACH and p.windows.sum() == len(data) - repeats.LENGTH + 1
        found.append({(bytes(data[s + k:s + k + 50]), t, k - w) for s, w, t in zip(p.start, p.windows, p.trigger) for k in range(w)})
    first = {(x[0], x[1]) for x in found[0]} & {(x[0], x[1]) for x in found[1]}
    assert len(first) >= len({bytes(body[k:k + 50]) for k in range(len(body) - 49)})


def test_segments_change_nothing(monkeypatch, spark):
    docs = list(enumerate(texts(random.Random(9), 60)))
    want = run(spark, docs)
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    assert run(spark, docs) == want == brute(docs)
