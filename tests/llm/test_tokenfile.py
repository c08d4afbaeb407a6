import io
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from propensity.llm import tokenfile as t
from propensity.llm.queries import tokenizer_path
from propensity.session import shared_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=400), st.booleans(), st.integers(1, 64))
def test_file_round_trip(ids, bits, block):
    sink = io.BytesIO()
    out = t.Writer(sink, block, bits)
    raw = np.array(ids, "<u4").tobytes()
    cuts = sorted(random.Random(len(ids)).choices(range(len(ids) + 1), k=3))
    parts = [raw[4 * a:4 * b] for a, b in zip([0, *cuts], [*cuts, len(ids)])]
    for doc, part in zip([None, -5, 2**62, 0], parts):
        out.add(doc, part)
    assert out.close() == (4, len(ids))
    reader = t.Reader(sink, len(sink.getvalue()))
    assert reader.ids(0, len(ids)).tolist() == ids
    for a, b in zip(cuts, cuts[1:]):
        assert reader.ids(a, b).tolist() == ids[a:b]
    found = list(reader.documents())
    assert [f[0] for f in found] == [None, -5, 2**62, 0]
    assert [f[3] for f in found] == [zlib.crc32(p) for p in parts]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Zé'sreллт²3_ \n\t\r ,.!$-\xa0 \x1c\x85ʰ中ñ|\"<|endoftext|>"), max_size=30))
def test_encode_equals_library(text):
    own = np.frombuffer(t.encode(text, tokenizer_path()), "<u4").tolist()
    assert own == Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids if "<" in text else True
    assert own == _shared().encode(text, add_special_tokens=False).ids


_HELD = []


def _shared():
    if not _HELD:
        _HELD.append(Tokenizer.from_file(tokenizer_path()))
    return _HELD[0]


def brute(docs, tokenizer):
    out, start = [], 0
    for doc, text in docs:
        ids = (tokenizer.encode(text, add_special_tokens=False).ids if text else []) + [2]
        out.append((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_small_cache_changes_nothing(documents, tokenizer):
    texts = [r.text for r in documents.limit(20).collect()]
    cache = t._Pieces(tokenizer, 10)
    for text in texts:
        assert np.frombuffer(cache.of(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [False, True])
def test_query_against_library(documents, tokenizer, bits):
    want = brute([(r.doc_id, r.text) for r in documents.select("doc_id", "text").orderBy("doc_id").collect()], tokenizer)
    got = t.token_files(documents.repartition(7), tokenizer_path(), bits=bits, block_ids=1000).orderBy("start").collect()
    assert [tuple(r) for r in got] == want


def test_edges(odd_documents, no_documents, tokenizer):
    got = [tuple(r) for r in t.token_files(odd_documents, tokenizer_path()).orderBy("start").collect()]
    ids = [g[0] for g in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert [g[1] for g in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))]
    lengths = sorted((d or -1, n, c) for d, _, n, c in got)
    want = brute([(r.doc_id, r.text) for r in odd_documents.collect()], tokenizer)
    assert lengths == sorted((d or -1, n, c) for d, _, n, c in want)
    assert t.token_files(no_documents, tokenizer_path()).count() == 0


def test_rewriting_gives_the_same_files(spark, documents):
    import pathlib
    data = []
    for name in ("a", "b"):
        folder = shared_path(spark, f"token-rerun-{name}")
        folder = folder if folder.startswith("file:") else f"file://{folder}"
        t.write_token_files(documents, folder, tokenizer_path())
        files = sorted(pathlib.Path(folder.removeprefix("file:").replace("//", "/")).glob("*.tid"))
        data.append([(f.name, f.read_bytes()) for f in files])
    assert data[0] == data[1] and data[0]


TEXTS = ["Éé, word word. ça!&& ", None, "", " lead", "one", "two  spaces", "a b,c word.\nNext, é\nÉé,été лл, x\n\ny", "<|endoftext|> word.", "word. word. word."]


@pytest.mark.parametrize("limit", [t.CACHE_BYTES, 1000])
@pytest.mark.parametrize("slice_bytes", [1, 40, t.SLICE_BYTES])
def test_rows_equal_library(tokenizer, limit, slice_bytes):
    for rows in (TEXTS, TEXTS[3:], [None], []):
        got = list(t.encode_rows(pa.array(rows, pa.string()), tokenizer_path(), limit, slice_bytes))
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(r or "", add_special_tokens=False).ids for r in rows]


def test_distinct_words_are_looked_up_once(monkeypatch):
    """op7_token_files: a word and its punctuation isn't kept, but asked for once a slice, however often it comes."""
    asked, missing = [], t._Pieces.__missing__
    monkeypatch.setattr(t._Pieces, "__missing__", lambda self, key: asked.append(key) or missing(self, key))
    list(t.encode_rows(pa.array(["x wörd, wörd, word. word."] * 50), tokenizer_path(), 4321))
    assert asked.count("wörd,") == asked.count("word.") == 1
