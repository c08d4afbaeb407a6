"""Removal of repeated byte strings by prefix-free parsing and suffix arrays.

A byte is removed if a ``LENGTH``-byte string that covers it also starts in a document with a smaller id.

Parsing: every ``LENGTH``-byte window has a trigger, the position in it whose ``GRAM``-byte rolling hash is smallest
(leftmost on ties). It depends on the window's bytes alone, so equal windows anywhere have equal triggers at equal
places. Consecutive windows with one trigger form a phrase; phrases overlap by ``LENGTH - 1`` bytes, and no window
crosses documents. The distinct phrases are the dictionary, their order in the documents is the parse.

1. Documents are packed into compressed packs of about ``PACK_BYTES``. Every pack sends the distinct trigger hashes
   that it has to hash buckets, which answer which of them another pack has too. A trigger that only one document
   of the whole corpus has can't be part of a repeat, so its phrases go no further.
2. Packs send their distinct phrases of the remaining triggers, each with its smallest document, to buckets again. A
   bucket holds the whole dictionary of its triggers. Phrases whose trigger has several contexts are ordered by a
   suffix array of their window starts (byte order, to window length); neighbours that agree in all bytes
   are one string, and the smallest document of the string is joined back to every phrase that has it.
3. Each pack combines the answers with its parse: a phrase's windows are repeats if the string has a smaller
   document, in other packs or in its own.

Everything is combined per pack before it is sent, so a line or copy that a third of all documents share costs each
bucket one row per pack. A trigger that more than ``HOT_PACKS`` packs have (the edge of such a line, with as many
contexts as documents) is dealt window by window, by the window's content, so its contexts spread over all buckets.
Buckets grow in number with the input; a worker holds one pack or one bucket.

Edge cases: null and empty texts have no bytes; texts shorter than a window lose nothing; rows with a null id take
no part and stay whole; rows of equal id don't remove each other; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import record_batch, utf8_rows
from propensity.session import materialize

LENGTH, GRAM = 50, 24
REACH = LENGTH - GRAM + 1  # positions in a window where its trigger can be: a phrase has at most as many windows
PACK_BYTES, SEGMENT, BUCKET_BYTES = 4 << 20, 1 << 18, 32 << 20
HOT_PACKS, SORT_ENTRIES = 256, 1 << 15
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
_NONE = np.iinfo(np.int64).max


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * _M1) ^ (b * _M2)
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` bytes at every position, by doubling."""
    power = {1: (data.astype(np.uint64) + np.uint64(1)) * _M2}
    n = 1
    while 2 * n <= size:
        h = power[n]
        power[2 * n] = _join(h[:-n], h[n:])
        n *= 2
    out, done = power[n], n
    for step in (n >> k for k in range(1, n.bit_length())):
        if done + step <= size:
            tail = power[step][done:]
            m = min(len(out), len(tail))
            out, done = _join(out[:m], tail[:m]), done + step
    out = out * _M1
    return out ^ (out >> np.uint64(32))


class Parse:
    """Phrases of a pack, in order: trigger hash, first window, windows, row."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, known: np.ndarray):
        ends = np.cumsum(lengths)
        # a window may start where LENGTH bytes of the same row follow; rows without an id have none
        parts: list[tuple] = []
        for s in range(0, max(len(data) - LENGTH + 1, 0), SEGMENT):
            e = min(s + SEGMENT, len(data) - LENGTH + 1)
            parts.append(self._segment(data[s:e + LENGTH - 1], s, ends, known))
        columns = [np.concatenate([p[k] for p in parts]) if parts else np.empty(0, t) for k, t in
                   enumerate((np.uint64, np.int64, np.int64, np.int64))]
        self.trigger, self.start, self.windows, self.row = columns

    @staticmethod
    def _segment(data: np.ndarray, at: int, ends: np.ndarray, known: np.ndarray) -> tuple:
        h = gram_hashes(data, GRAM)
        key = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
        n = 1
        while 2 * n <= REACH:
            key = np.minimum(key[:-n], key[n:])
            n *= 2
        if REACH > n:
            key = np.minimum(key[:len(key) - (REACH - n)], key[REACH - n:])
        place = (key & _LOW).astype(np.int64)
        count = len(data) - LENGTH + 1
        position = np.arange(at, at + count)
        row = np.searchsorted(ends, position, "right")
        fine = (position + LENGTH <= ends[np.minimum(row, len(ends) - 1)]) & known[np.minimum(row, len(ends) - 1)]
        keep = np.flatnonzero(fine)
        if not len(keep):
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        place, row = place[:count][keep], row[keep]
        fresh = np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
        first = np.flatnonzero(fresh)
        return h[place[first]], position[keep][first], np.diff(np.append(first, len(keep))), row[first]


# ---------------------------------------------------------------- packs

_PACK_DDL = "pack long, ids binary, known binary, lengths binary, data binary"
_PACK_SCHEMA = pa.schema([("pack", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("lengths", pa.binary()), ("data", pa.binary())])


def make_packs(docs: DataFrame) -> DataFrame:
    """Documents packed in the order they are read; a document beyond the pack size is a pack of its own."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=1)
        ids, texts, size = [], [], 0

        def emit() -> pa.RecordBatch:
            return record_batch(_PACK_SCHEMA, {
                "pack": [number], "ids": [np.array([i or 0 for i in ids], "<i8").tobytes()],
                "known": [np.array([i is not None for i in ids], np.uint8).tobytes()],
                "lengths": [np.array([len(t) for t in texts], "<i8").tobytes()], "data": [squeeze.compress(b"".join(texts))]})

        for batch in batches:
            column = batch.column("text")
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                text = utf8_rows(column.slice(i, 1))[0] or b""
                if ids and size + len(text) > PACK_BYTES:
                    yield emit()
                    number += 1
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if ids:
            yield emit()

    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, _PACK_DDL))


class Pack:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.known = np.frombuffer(row["known"], np.uint8).astype(bool)
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        raw = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=int(self.lengths.sum()) + 1)
        self.data = np.frombuffer(raw, np.uint8)
        self.parse = Parse(self.data, self.lengths, self.known)
        self.doc = self.ids[self.parse.row]

    def triggers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct trigger hashes, whether several rows have it, index of each phrase's trigger)."""
        unique, place = np.unique(self.parse.trigger, return_inverse=True)
        low, high = np.full(len(unique), len(self.ids)), np.full(len(unique), -1)
        np.minimum.at(low, place, self.parse.row)
        np.maximum.at(high, place, self.parse.row)
        return unique, low < high, place

    def keep(self, live: np.ndarray, hot: np.ndarray) -> None:
        """Leave only the phrases marked live; hot ones become one phrase per window, keyed by its content."""
        p = self.parse
        plain, at = np.flatnonzero(live & ~hot), np.flatnonzero(live & hot)
        n = p.windows[at]
        start = _ranges(p.start[at], n)
        key = np.empty(0, np.uint64)
        if len(start):
            key = content_keys(self.data, start, np.ones(len(start), np.int64))[0]
        p.trigger = np.concatenate([p.trigger[plain], key])
        p.row = np.concatenate([p.row[plain], np.repeat(p.row[at], n)])
        p.windows = np.concatenate([p.windows[plain], np.ones(len(start), np.int64)])
        p.start = np.concatenate([p.start[plain], start])
        self.doc = self.ids[p.row]

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases: (the one of the smallest document for each, the number of every phrase's)."""
        a, b = content_keys(self.data, self.parse.start, self.parse.windows)
        order = np.lexsort((self.parse.start, self.doc, b, a))
        a, b = a[order], b[order]
        fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(order) else np.empty(0, bool)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(fresh) - 1
        return order[fresh], group


def content_keys(data: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit digest of each phrase's bytes, as two columns."""
    import xxhash
    view, size = memoryview(data), LENGTH - 1
    out = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[s:s + n + size]) for s, n in zip(start.tolist(), windows.tolist())]), np.uint64)
    return out[0::2], out[1::2]


def _buckets(trigger: np.ndarray, count: int) -> np.ndarray:
    return ((trigger >> np.uint64(8)) % np.uint64(count)).astype(np.int64)


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices in it), indices ascending."""
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]])) if len(order) else []
    for s, e in zip(first, [*first[1:], len(order)]):
        yield int(bucket[order[s]]), order[s:e]


_BLOB_DDL = "pack long, bucket int, blob binary"
_BLOB_SCHEMA = pa.schema([("pack", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary())])


def _blob(pack: int, bucket: int, *arrays: np.ndarray) -> tuple[int, int, bytes]:
    body = b"".join(np.array([len(a.tobytes())], "<i8").tobytes() + a.tobytes() for a in arrays)
    return pack, bucket, zstandard.ZstdCompressor(level=1).compress(body)


def _parts(blob: bytes) -> list[bytes]:
    body, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(body):
        n = int(np.frombuffer(body, "<i8", 1, at)[0])
        out.append(body[at + 8:at + 8 + n])
        at += 8 + n
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return record_batch(_BLOB_SCHEMA, dict(zip(_BLOB_SCHEMA.names, zip(*rows))))


def _by_bucket(blobs: DataFrame, count: int, answer) -> DataFrame:
    """Hand all blobs of one bucket to ``answer(packs, blobs)``, which gives one blob per pack."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        last = None

        def done() -> pa.RecordBatch:
            return _batch([(p, last, b) for (p, _), b in zip(held, answer([b for _, b in held]))])

        for batch in batches:
            for pack, bucket, blob in zip(*(batch.column(c).to_pylist() for c in _BLOB_SCHEMA.names)):
                if held and bucket != last:
                    yield done()
                    held = []
                held.append((pack, blob))
                last = bucket
        if held:
            yield done()

    return blobs.repartition(count, "bucket").sortWithinPartitions("bucket", "pack").mapInArrow(work, _BLOB_DDL)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


# ---------------------------------------------------------------- step 1: triggers

def _send_triggers(packs: DataFrame, count: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _pack_rows(batches):
            unique, _, _ = Pack(row).triggers()
            rows = []
            for b, at in _split(_buckets(unique, count)):
                # 48 bits, ascending, as differences: a clash only keeps a phrase that could have gone
                short = unique[at] >> np.uint64(16)
                gaps = np.diff(short, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                rows.append(_blob(row["pack"], b, np.ascontiguousarray(gaps.T)))
            if rows:
                yield _batch(rows)

    return packs.mapInArrow(send, _BLOB_DDL)


def _shared(blobs: list[bytes], hot_packs: int) -> Iterator[bytes]:
    """For every pack's triggers two bits: whether another pack has it, and whether more than ``hot_packs`` do."""
    lists = []
    for blob in blobs:
        planes = np.frombuffer(_parts(blob)[0], np.uint8).reshape(6, -1)
        gaps = np.zeros((planes.shape[1], 8), np.uint8)
        gaps[:, :6] = planes.T
        lists.append(np.cumsum(gaps.view("<u8").reshape(-1), dtype=np.uint64))
    # a pack's list may hold a 48-bit value twice; once per pack counts
    own = [np.unique(x) for x in lists]
    every = np.sort(np.concatenate(own))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    many = np.unique(every[hot_packs:][every[hot_packs:] == every[:-hot_packs]])
    for x in lists:
        yield _blob(0, 0, np.packbits(_among(x, twice)), np.packbits(_among(x, many)))[2]


def _among(x: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the ascending ``some``; costs by the size of ``x``, not of ``some``."""
    if not len(some):
        return np.zeros(len(x), bool)
    return some[np.minimum(np.searchsorted(some, x), len(some) - 1)] == x


# ---------------------------------------------------------------- step 2: dictionary

def _reduce(pack: Pack, answers: list | None, count: int) -> Pack:
    """Leave only the phrases whose trigger several documents of the corpus have."""
    unique, several, place = pack.triggers()
    found, hot = several.copy(), np.zeros(len(unique), bool)
    bits = {a["bucket"]: a["blob"] for a in answers or []}
    for b, at in _split(_buckets(unique, count)):
        shared, many = (np.unpackbits(np.frombuffer(x, np.uint8))[:len(at)].astype(bool) for x in _parts(bits[b]))
        found[at] |= shared
        hot[at] = many
    pack.keep(found[place], hot[place])
    return pack


def _send_phrases(joined: DataFrame, count: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _pack_rows(batches):
            pack = _reduce(Pack(row), row["answers"], count)
            first, _ = pack.phrases()
            rows = []
            for b, at in _split(_buckets(pack.parse.trigger[first], count)):
                p = first[at]
                start, windows = pack.parse.start[p], pack.parse.windows[p]
                data = pack.data[_ranges(start, windows + LENGTH - 1)]
                rows.append(_blob(row["pack"], b, pack.parse.trigger[p].astype("<u8"), pack.doc[p].astype("<i8"), windows.astype(np.uint8), data))
            if rows:
                yield _batch(rows)

    return joined.mapInArrow(send, _BLOB_DDL)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indices of the ranges [start, start + size), one range after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def suffix_order(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the positions ``at`` by their first LENGTH bytes, and for each place in it the number of its
    string (equal strings have one number)."""
    words = np.zeros((len(at), -(-LENGTH // 8) * 8), np.uint8)
    for k in range(LENGTH):
        words[:, k] = data[at + k]
    keys = words.view(">u8").astype(np.uint64)
    order = np.lexsort(keys.T[::-1])
    ordered = keys[order]
    fresh = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(1)]) if len(at) else np.empty(0, bool)
    return order, np.cumsum(fresh) - 1


def _repeats(blobs: list[bytes]) -> Iterator[bytes]:
    """For every phrase that a pack sent: a bit per window, whether its string has a smaller document."""
    trigger, doc, windows, data, sizes = [], [], [], [], []
    for blob in blobs:
        t, d, w, raw = _parts(blob)
        trigger.append(np.frombuffer(t, "<u8"))
        doc.append(np.frombuffer(d, "<i8"))
        windows.append(np.frombuffer(w, np.uint8).astype(np.int64))
        data.append(np.frombuffer(raw, np.uint8))
        sizes.append(len(trigger[-1]))
    trigger, doc, windows, data = (np.concatenate(x) for x in (trigger, doc, windows, data))
    start = np.cumsum(windows + LENGTH - 1) - (windows + LENGTH - 1)
    k1, k2 = content_keys(data, start, windows)
    # dictionary: distinct phrases with their smallest document
    order = np.lexsort((doc, k2, k1, trigger))
    fresh = np.concatenate([[True], (trigger[order][1:] != trigger[order][:-1]) | (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])])
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(fresh) - 1
    chosen = order[fresh]
    smallest = doc[chosen]
    # entries whose trigger has several contexts: order their suffixes
    t = trigger[chosen]
    edge = np.concatenate([[True], t[1:] != t[:-1]])
    groups = np.cumsum(edge) - 1
    several = np.bincount(groups)[groups] > 1
    full = (np.uint64(1) << windows[chosen].astype(np.uint64)) - np.uint64(1)
    mask = np.where(smallest[entry] < doc, full[entry], np.uint64(0))
    picked = np.flatnonzero(several)
    for a, b in _runs(groups[picked], SORT_ENTRIES):
        part = picked[a:b]
        at = _ranges(start[chosen[part]], windows[chosen[part]])
        owner = np.repeat(part, windows[chosen[part]])
        bit = (at - start[chosen[owner]]).astype(np.uint64)
        # a string lies at one distance from its trigger, but sorting all bytes needs no such key
        suffixes, number = suffix_order(data, at)
        least = np.full(int(number[-1]) + 1 if len(number) else 0, _NONE)
        np.minimum.at(least, number, smallest[owner[suffixes]])
        older = np.empty(len(at), np.int64)
        older[suffixes] = least[number]
        hit = older < smallest[owner]
        extra = np.zeros(len(chosen), np.uint64)
        np.bitwise_or.at(extra, owner[hit], np.uint64(1) << bit[hit])
        mask |= np.where(smallest[entry] == doc, extra[entry], np.uint64(0))
    done = 0
    for n in sizes:
        yield _blob(0, 0, mask[done:done + n].astype("<u4"))[2]
        done += n


def _runs(groups: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` entries that don't cut a group."""
    a = 0
    while a < len(groups):
        b = min(a + limit, len(groups))
        b = int(np.searchsorted(groups, groups[b - 1], "right"))
        yield a, b
        a = b


# ---------------------------------------------------------------- step 3: documents

_OUT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_OUT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def removed_bytes(pack: Pack, masks: list | None, count: int) -> np.ndarray:
    """Marks the bytes of a reduced pack that repeats cover."""
    first, group = pack.phrases()
    mask = np.zeros(len(first), np.uint64)
    answers = {m["bucket"]: m["blob"] for m in masks or []}
    for b, own in _split(_buckets(pack.parse.trigger[first], count)):
        mask[own] = np.frombuffer(_parts(answers[b])[0], "<u4")
    start, windows = pack.parse.start, pack.parse.windows
    full = (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1)
    # a phrase of a later document than the pack's first with it repeats that one
    bits = np.where(pack.doc > pack.doc[first][group], full, mask[group])
    cover = np.zeros(len(pack.data) + 1, np.int64)
    for k in range(REACH):
        s = start[(bits >> np.uint64(k)) & np.uint64(1) > 0] + k
        np.add.at(cover, s, 1)
        np.add.at(cover, s + LENGTH, -1)
    return np.cumsum(cover[:-1]) > 0


def _finish(joined: DataFrame, count: int, with_text: bool) -> DataFrame:
    schema = _OUT_SCHEMA.append(pa.field("kept", pa.binary())) if with_text else _OUT_SCHEMA

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _pack_rows(batches):
            pack = _reduce(Pack(row), row["answers"], count)
            gone = removed_bytes(pack, row["masks"], count)
            out: dict[str, list] = {f.name: [] for f in schema}
            end = 0
            for doc, known, n in zip(pack.ids.tolist(), pack.known.tolist(), pack.lengths.tolist()):
                start, end = end, end + n
                cut = gone[start:end]
                kept = pack.data[start:end][~cut].tobytes()
                out["doc_id"].append(doc if known else None)
                out["n_bytes"].append(n)
                out["n_removed"].append(int(cut.sum()))
                out["n_spans"].append(int(cut[:1].sum() + (cut[1:] & ~cut[:-1]).sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["kept"].append(kept)
            yield record_batch(schema, out)

    return joined.mapInArrow(finish, _OUT_DDL + (", kept binary" if with_text else ""))


def remove_repeats(docs: DataFrame, with_text: bool = False, hot_packs: int = HOT_PACKS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes)."""
    packs = make_packs(docs)
    total = packs.select(F.sum(F.length("data"))).first()[0] or 0
    count = max(8, int(total * 2 // BUCKET_BYTES) + 1)

    def answers(blobs: DataFrame, name: str) -> DataFrame:
        return blobs.groupBy(F.col("pack").alias(f"_{name}")).agg(F.collect_list(F.struct("bucket", "blob")).alias(name))

    def join(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
        return left.join(right, left["pack"] == right[f"_{name}"], "left").drop(f"_{name}")

    def shared(blobs: list[bytes]) -> Iterator[bytes]:
        return _shared(blobs, hot_packs)

    known = join(packs, materialize(answers(_by_bucket(_send_triggers(packs, count), count, shared), "answers")), "answers")
    masks = materialize(answers(_by_bucket(_send_phrases(known, count), count, _repeats), "masks"))
    return _finish(join(known, masks, "masks"), count, with_text)
