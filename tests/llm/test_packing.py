import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from propensity.llm import packing
from propensity.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def check(found, docs, tokenizer, context=2048, end_id=1):
    """Every id of every document in exactly one piece, sequences gapless, checksums and counts of the ids."""
    want = []
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        want.append((doc, np.array(ids, "<u4")))
    by_row = defaultdict(list)
    for r in found:
        by_row[r["document"]].append(r)
    left = defaultdict(list)
    for doc, ids in want:
        left[doc].append(ids)
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r["start"])
        doc = pieces[0]["doc_id"]
        match = next(k for k, ids in enumerate(left[doc]) if len(ids) == pieces[0]["doc_tokens"]
                     and all(zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for p in pieces))
        ids = left[doc].pop(match)
        at = 0
        for p in pieces:
            assert p["doc_id"] == doc and p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            at += p["length"]
        assert at == len(ids)
    assert not any(left.values())
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= context and at & (at - 1) == 0 and {p["context"] for p in pieces} == {at} and len({p["step"] for p in pieces}) == 1
    return sequences


def test_documents(spark, documents, tokenizer):
    found = packing.pack_documents(documents.repartition(3), tokenizer_path(), step_tokens=1 << 14).collect()
    sequences = check(found, [(r["doc_id"], r["text"]) for r in documents.collect()], tokenizer)
    steps = defaultdict(int)
    for pieces in sequences.values():
        steps[pieces[0]["step"]] += pieces[0]["context"]
    assert sorted(steps) == list(range(len(steps)))
    assert max(steps.values()) - min(steps.values()) <= 2 * sum(1 << k for k in range(12))  # a sequence of each length more or less


def test_odd_rows(spark, odd_documents, no_documents, tokenizer):
    found = packing.pack_documents(odd_documents, tokenizer_path()).collect()
    check(found, [(r["doc_id"], r["text"]) for r in odd_documents.collect()], tokenizer)
    out = packing.pack_documents(no_documents, tokenizer_path())
    assert out.collect() == [] and "sequence_id" in out.columns


def test_special_strings_and_one_row(spark, tokenizer):
    docs = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(packing.pack_documents(df, tokenizer_path()).collect(), docs, tokenizer)
    check(packing.pack_documents(df.limit(1), tokenizer_path()).collect(), docs[:1], tokenizer)


def run_packer(lengths, pool=1 << 20, contexts=packing.CONTEXTS):
    packer, out = packing.Packer(contexts, pool), []
    for row, n in enumerate(lengths):
        out += packer.add(row, row, np.arange(n, dtype="<u4").tobytes())
    return out + list(packer.close())


@pytest.mark.parametrize("lengths", [
    [1], [2048], [2049], [5000, 1, 1], [1500] * 100, [1025] * 7, [3] * 1000, [127, 129, 255, 257, 511, 513, 1023, 1024] * 20, list(range(1, 700))])
@pytest.mark.parametrize("pool", [1, 5000, 1 << 20])
def test_every_token_once_and_full_windows(lengths, pool):
    out = run_packer(lengths, pool)
    got = defaultdict(list)
    for length, pieces in out:
        assert sum(map(packing.size, pieces)) == length and length & (length - 1) == 0 and length <= 2048
        for row, doc, start, ids, tokens in pieces:
            assert tokens == lengths[row] and np.array_equal(np.frombuffer(ids, "<u4"), np.arange(start, start + len(ids) // 4))
            got[row] += range(start, start + len(ids) // 4)
    assert {r: sorted(v) for r, v in got.items()} == {r: list(range(n)) for r, n in enumerate(lengths)}


def test_short_pieces_fill_the_gaps_of_long_windows():
    out = run_packer([2000, 48, 1000, 24, 500, 12])
    assert [(n, sorted(map(packing.size, p), reverse=True)) for n, p in out] == [(2048, [2000, 48]), (1024, [1000, 24]), (512, [500, 12])]


def test_documents_stay_whole_as_a_rule():
    lengths = np.maximum(1, np.random.default_rng(0).lognormal(6, 1, 5000).astype(int)).tolist()
    cuts = sum(p[2] % 2048 > 0 for _, pieces in run_packer(lengths) for p in pieces)
    assert cuts < 0.25 * len(lengths)


def test_contexts_must_be_powers_of_two():
    with pytest.raises(ValueError):
        packing.Packer((2048, 1000))
