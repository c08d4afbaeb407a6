import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from propensity.llm import spelling


def plain_words(docs):
    n = Counter()
    for doc, text in docs:
        lower = (text or "").translate(str.maketrans(spelling.UPPER, spelling.LOWER))
        for run in regex.findall("[a-z\u00c0-\u00ff]+", lower):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(vocab):
    links = {w: [v for v in vocab if near(w, v)] for w in vocab}
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 5 * vocab[w] else None
    out = []
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, vocab[w], len(links[w]), vocab.get(form[w])))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=str)


def test_odd_documents(spark, odd_documents, no_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert found(spelling.spelling_variants(odd_documents)) == plain(plain_words(docs))
    assert found(spelling.spelling_variants(no_documents)) == []


def made_up(seed, words=120):
    rng = np.random.default_rng(seed)
    letters = list("abcdeé\u00ff")
    base = {"".join(rng.choice(letters, rng.integers(6, 9))) for _ in range(words)}
    vocab = {}
    for w in base:
        vocab[w] = int(rng.integers(5, 4000))
        for _ in range(rng.integers(0, 4)):
            i, c = int(rng.integers(0, len(w))), str(rng.choice(letters))
            v = [w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]][rng.integers(0, 3)]
            if len(v) >= 6:
                vocab.setdefault(v, int(rng.integers(5, 60)))
    return vocab


@pytest.mark.parametrize("group_bytes", [1 << 20, 256])
def test_vocabulary_in_one_and_in_many_groups(spark, group_bytes):
    vocab = made_up(1) | {"a" * 6: 5, "a" * 7: 25, "a" * 8: 125, "a" * 9: 3125, "b" * 90: 10, "b" * 91: 50, "b" * 50 + "c" + "b" * 40: 60, "zzzzzz": 7, "zzzzzy": 7, "zzzzzx": 35, "zzzzzw": 35}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert found(spelling.group_variants(df, group_bytes=group_bytes)) == plain(vocab)


def test_neighbours_cross_chunks(monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 5)
    vocab = made_up(2, 40)
    words = list(vocab)
    sizes = {n: 4 for n in {min(len(w), spelling.LENGTHS) for w in words}}
    letters = spelling.Letters(words)
    masks = {n: np.zeros((4, 8), np.uint64) for n in sizes}
    h = spelling.mixed(letters.hashes)
    for k, w in enumerate(words):
        block = int(spelling.block_of(h[k:k + 1], 4)[0])
        for cell, bit in spelling.bits_of(h[k:k + 1]):
            masks[len(w)][block, cell[0]] |= bit[0]
    probe = spelling.Probe(sizes, {n: (0, m) for n, m in masks.items()})
    got = [(words[k], v) for k, v in spelling.probable_neighbours(words, probe)]
    assert len(got) == len(set(got))
    real = {frozenset(p) for p in got if p[1] in vocab}
    assert real == {frozenset((a, b)) for a in words for b in words if near(a, b)}
    # hardly anything but links comes through a filter with room
    assert all(near(a, b) for a, b in got)


def test_groups_cover_all_blocks():
    sizes = {6: 10, 7: 3, 64: 25}
    parts = spelling.groups(sizes, 64 * 8)
    seen = [(n, b) for g in parts for n, (a, z) in g.items() for b in range(a, z)]
    assert sorted(seen) == [(n, b) for n in sizes for b in range(sizes[n])] and all(sum(z - a for a, z in g.values()) <= 8 for g in parts)


def test_letters_out_of_noise(spark):
    """Noise takes the letter that the checksum names, also from letters beyond ASCII."""
    docs = [(i, "Été" + w) for i in range(400) for w in ("ñandúes", "garçons")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter(r["word"] for r in spelling.noisy_words(df).collect())
    assert {w: k for w, k in got.items() if k >= 5} == plain_words(docs) and len(got) > 2
