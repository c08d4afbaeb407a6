"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Text and items are lower-cased (A-Z) and cut into words; every window of ``window`` consecutive item words (the
whole item, if shorter) is a pattern. Patterns of equal length form one searcher: a table from blocks of two
words to shifts lets the scan skip positions that can't end a pattern, a block with shift 0 selects the bucket of
patterns that end in it, and direct comparison of the words confirms an occurrence. Items that are shorter than
the window have a searcher per length, so they don't shorten the skips of the others.

Documents are scanned where they lie: no shuffle. Items are read in blocks of at most ``block_windows`` patterns
(one block for any usual benchmark), each block is one scan of all documents whose hits are carried along as a
column, so the driver and the workers never hold more than a block however large the benchmark grows.

Edge cases: null and empty texts have no words and are not contaminated; items that are null, have no words or
have a null id hit nothing; an item id on several rows is one item; null and repeated document ids are kept, each
row counts by itself; ties don't arise; empty tables give an empty result or no hits; other columns are carried
only by ``drop_contaminated``, in a struct, so their names can't clash.
"""
from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import utf8_rows
from propensity.session import materialize

WINDOW = 10
BLOCK_WINDOWS = 200_000

# Word bytes: 0-9, a-z and all of 0x80-0xFF; A-Z become lower case, the rest white space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Searcher:
    """Wu-Manber search for word sequences of one length."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], frozenset], vocabulary: int):
        self.length, self.patterns, self.base = length, patterns, vocabulary + 1
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list] = defaultdict(list)
        for p, items in patterns.items():
            for end in range(self.block, length + 1):
                code = self._code(p, end - 1)
                self.shift[code] = min(self.shift.get(code, self.default), length - end)
            self.bucket[self._code(p, length - 1)].append((list(p), items))

    def _code(self, ids, i: int) -> int:
        return ids[i - 1] * self.base + ids[i] if self.block == 2 else ids[i]

    def search(self, ids: list[int]) -> Iterator[tuple[int, frozenset]]:
        """(start, items) of every occurrence; id 0 is a word of no pattern."""
        length, shift, bucket, base, default = self.length, self.shift, self.bucket, self.base, self.default
        i, n, pair = length - 1, len(ids), self.block == 2
        while i < n:
            last = ids[i]
            if not last:  # no pattern has this word
                i += length
                continue
            code = ids[i - 1] * base + last if pair else last
            step = shift.get(code, default)
            if step:
                i += step
                continue
            start = i - length + 1
            found = ids[start:i + 1]
            for pattern, items in bucket[code]:
                if pattern == found:
                    yield start, items
            i += 1


class Searchers:
    """All searchers of a block of items: [(item_id, words)]."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, words in items:
            ids = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1):
                by_length[size][tuple(ids[i:i + size])].add(item)
        self.searchers = [Searcher(n, {p: frozenset(s) for p, s in ps.items()}, len(self.ids)) for n, ps in sorted(by_length.items()) if n]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word ranges [start, end) covered by occurrences, and the items that occur."""
        get, items, spans = self.ids.get, set(), []
        ids = [get(w, 0) for w in words]
        for s in self.searchers:
            for start, owners in s.search(ids):
                items |= owners
                spans.append((start, start + s.length))
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(benchmark: DataFrame, window: int, block_windows: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items with words, in blocks of about ``block_windows`` patterns; one block is in memory at a time."""
    block, count = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t"))
    for row in rows.where("i is not null and t is not null").toLocalIterator():
        words = words_of(row["t"].encode())
        if not words:
            continue
        block.append((row["i"], words))
        count += max(1, len(words) - window + 1)
        if count >= block_windows:
            yield block
            block, count = [], 0
    if block:
        yield block


_STATE = "array<struct<s: bigint, e: bigint>>"


def _scan(rows: DataFrame, items: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """``rows`` (doc, text, n_words, spans, items) with the hits of one block of items added."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = Searchers(items, window)
        for batch in batches:
            n_words, spans, found = [], [], []
            old_spans, old_items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            column = batch.column("text")
            for i in range(len(column)):
                words = words_of(utf8_rows(column.slice(i, 1))[0])
                hit, owners = searchers.hits(words)
                before = [(x["s"], x["e"]) for x in old_spans[i]]
                n_words.append(len(words))
                spans.append([{"s": a, "e": b} for a, b in merged(before + hit)])
                found.append(sorted(owners.union(old_items[i])))
            columns = {"n_words": n_words, "spans": spans, "items": found}
            names = batch.schema.names
            arrays = [pa.array(columns[c], batch.schema.field(c).type) if c in columns else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return rows.mapInArrow(scan, rows.schema)


def find_contamination(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``rows`` must have a ``text`` column; adds n_words, spans (merged word ranges that are hit) and items."""
    state = rows.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast(_STATE), "items": F.array().cast("array<string>")})
    blocks = item_blocks(benchmark, window, block_windows)
    block = next(blocks, [])
    while True:
        state = _scan(state, block, window)
        block = next(blocks, None)
        if block is None:
            return state
        state = materialize(state)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items."""
    state = find_contamination(docs.select("doc_id", "text"), benchmark, window, block_windows)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["e"] - x["s"])
    return state.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                        "spans", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns kept."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["text"].alias("text"))
    state = find_contamination(rows, benchmark, window, block_windows)
    return state.where(F.size("spans") == 0).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
