"""Hashed subword features and additive token scores, shared by the two text classifiers.

A token's features are itself and the character n-grams of it between boundary marks, hashed into buckets; pairs of
neighbouring tokens may be features too, in buckets of their own. A document's representation is the average of its
features' vectors, so any linear score of it is a sum of token and pair scores over a count of features: a token is
scored once and looked up afterwards. The lookup table is bounded and begun anew when full; that changes no result.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import xxhash

TABLE_TOKENS = 300_000
SLICE_CHARS = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)


def token_hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))


def pair_ids(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the pairs of neighbouring tokens, from the tokens' hashes in order."""
    with np.errstate(over="ignore"):
        return (((hashes[:-1] * _MUL ^ hashes[1:]) * _MUL >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


class Features:
    """Feature ids of tokens: vectorised over a list of tokens."""

    def __init__(self, buckets: int, n_min: int, n_max: int, words: bool):
        self.buckets, self.n_min, self.n_max, self.words = buckets, n_min, n_max, words

    def of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all features, position of the token of each). A token "" has no features."""
        tokens = list(tokens)
        text = "".join([f"\x02{t}\x03" for t in tokens])
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(t) + 2 for t in tokens], np.int64)
        ends = np.repeat(np.cumsum(lengths), lengths)
        owner = np.repeat(np.arange(len(tokens)), lengths)
        filled = np.repeat(lengths > 2, lengths)
        ids, owners = [], []
        h = np.zeros(len(chars), np.uint64)
        with np.errstate(over="ignore"):
            for n in range(1, self.n_max + 1):
                size = len(chars) - n + 1
                if size <= 0:
                    break
                h = (h[:size] + chars[n - 1:]) * _MUL
                h ^= h >> _SHIFT
                if n < self.n_min:
                    continue
                at = np.flatnonzero((np.arange(size) + n <= ends[:size]) & filled[:size])
                if n == 1:
                    at = at[chars[at] > 3]
                ids.append(((h[at] + np.uint64(n)) * _MUL >> np.uint64(20)) % np.uint64(self.buckets))
                owners.append(owner[at])
        if self.words:
            hashed = np.array([xxhash.xxh64_intdigest(t) % self.buckets for t in tokens], np.uint64)
            full = np.flatnonzero(lengths > 2)
            ids.append(hashed[full])
            owners.append(full)
        if not ids:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(ids).astype(np.int64), np.concatenate(owners)

    def counts(self, tokens: Counter) -> tuple[np.ndarray, np.ndarray]:
        """(bucket ids, counts) of a bag of tokens."""
        keys = list(tokens)
        ids, owner = self.of(keys)
        weights = np.array([tokens[k] for k in keys], np.float64)
        unique, place = np.unique(ids, return_inverse=True)
        return unique, np.bincount(place, weights[owner], len(unique)) if len(unique) else np.empty(0)


def token_slices(text: str, size: int = SLICE_CHARS) -> Iterator[list[str]]:
    """The white-space separated tokens of a text, in slices, so that a very long text isn't one list."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and not text[end].isspace():
            end += 1
        yield (text if at == 0 and end == len(text) else text[at:end]).split()
        at = end


class TokenScores:
    """Sums of feature scores by token, looked up in a bounded table; ``pairs`` holds the scores of token pairs."""

    def __init__(self, features: Features, weights: np.ndarray, clean: Callable[[str], str] | None = None, limit: int = TABLE_TOKENS,
                 pairs: np.ndarray | None = None):
        self.features, self.weights, self.clean, self.limit = features, np.ascontiguousarray(weights, np.float32), clean, limit
        self.pairs = pairs
        self._begin()

    def _begin(self) -> None:
        self.rows: dict[str, int] = {}
        self.sums = np.zeros((1024, self.weights.shape[1]), np.float64)
        self.sizes = np.zeros(1024, np.int64)
        self.hashes = np.zeros(1024, np.uint64)

    def _learn(self, tokens: set[str]) -> None:
        new = tokens.difference(self.rows)
        if not new:
            return
        if self.rows and len(self.rows) + len(new) > self.limit:
            self._begin()
            new = tokens
        new = sorted(new)
        start, end = len(self.rows), len(self.rows) + len(new)
        if end > len(self.sizes):
            size = max(end, 2 * len(self.sizes))
            self.sums = np.resize(self.sums, (size, self.sums.shape[1]))
            self.sizes = np.resize(self.sizes, size)
            self.hashes = np.resize(self.hashes, size)
        if self.pairs is not None:
            self.hashes[start:end] = [token_hash(t) for t in new]
        for a in range(0, len(new), 65536):
            part = new[a:a + 65536]
            ids, owner = self.features.of([self.clean(t) for t in part] if self.clean else part)
            for k in range(self.weights.shape[1]):
                self.sums[start + a:start + a + len(part), k] = np.bincount(owner, self.weights[ids, k], len(part))
            self.sizes[start + a:start + a + len(part)] = np.bincount(owner, minlength=len(part))
        self.rows.update(zip(new, range(start, end)))

    def documents(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, int, int]]:
        """Per text: score sums, features, tokens."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= SLICE_CHARS):
                size += len(texts[end] or "")
                end += 1
            if end - at == 1 and size > SLICE_CHARS:
                yield self._long(texts[at])
            else:
                lists = [(t or "").split() for t in texts[at:end]]
                self._learn(set().union(*lists))
                for tokens in lists:
                    yield self._sum(tokens)
            at = end

    def _long(self, text: str) -> tuple[np.ndarray, int, int]:
        total, last = (np.zeros(self.weights.shape[1]), 0, 0), None
        for tokens in token_slices(text):
            if not tokens:
                continue
            self._learn(set(tokens))
            total = tuple(x + y for x, y in zip(total, self._sum(tokens, last)))
            last = tokens[-1]
        return total

    def _sum(self, tokens: list[str], before: str | None = None) -> tuple[np.ndarray, int, int]:
        at = np.fromiter(map(self.rows.__getitem__, tokens), np.int64, len(tokens))
        sums, size = self.sums[at].sum(0), int(self.sizes[at].sum())
        if self.pairs is not None:
            hashes = self.hashes[at]
            if before is not None:
                hashes = np.append(np.uint64(token_hash(before)), hashes)
            if len(hashes) > 1:
                sums = sums + self.pairs[pair_ids(hashes, len(self.pairs))].sum(0, dtype=np.float64)
                size += len(hashes) - 1
        return sums, size, len(at)
