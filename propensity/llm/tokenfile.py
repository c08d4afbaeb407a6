"""Token-id files: bit-plane or byte-plane shuffled blocks, zstandard, and a chunk index.

Layout of a file (little-endian): magic; the planes of one block after the other; the document table (doc ids, a
validity byte each, token counts), compressed; the chunk index (per block: offset, ids in it, and the compressed
size of each plane); a trailer with the places of table and index and the magic again. A block is a fixed number
of unsigned 32-bit ids, the last one shorter. Byte planes put the n-th bytes of all ids together, bit planes the
n-th bits; each plane is compressed by itself. A plane of zeros only has size 0. With the index a reader
fetches any id range, and of each block only what it needs.

Documents are dealt by ranges of (doc_id, hash of the text), so the files in order hold ascending ids and a
repeated or null id can still be spread over many tasks; each task encodes its range and writes one file into the
shared folder, under a temporary name that is renamed when complete, so a lost or repeated task leaves the same
file. Pieces that a text is cut into at boundaries which the tokenizer's own splitting always has are encoded once
and kept in a bounded cache; of the rows of a slice each distinct word is looked up once.

Edge cases: null and empty texts have only the end id; null ids come first, as Spark sorts them; rows with equal
id are ordered by text; an empty table gives files without documents; only doc_id and text are read.
"""
from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.functions.sizing import small_table
from propensity.llm.common import record_batch, slices
from propensity.session import materialize, shared_path

MAGIC = b"TIDPLN01"
TRAILER = "<QQQQI4x8s"  # table place, table size, index place, index size, flags, magic
BLOCK_IDS = 1 << 16
END_ID = 2
CACHE_BYTES = 128 << 20
ENTRY_BYTES = 200  # of a dictionary's slot, a string and a bytes object
SLICE_BYTES = 8 << 20  # of texts whose words are looked up together
MAX_FILES = 1_000_000  # rows of the table of file offsets that may go to every executor


# ---------------------------------------------------------------- planes

def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of a block of uint32 ids: 4 byte planes, or 32 bit planes (lowest first)."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [raw[:, k].tobytes() for k in range(4)]
    cells = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(cells[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], count: int, bits: bool) -> np.ndarray:
    if not bits:
        raw = np.empty((count, 4), np.uint8)
        for k, p in enumerate(planes):
            raw[:, k] = np.frombuffer(p, np.uint8)
    else:
        cells = np.empty((count, 32), np.uint8)
        for k, p in enumerate(planes):
            cells[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:count]
        raw = np.packbits(cells, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class Writer:
    """Appends documents to one file; holds at most a block of ids and the document table."""

    def __init__(self, sink, block_ids: int = BLOCK_IDS, bits: bool = False, level: int = 3):
        self.sink, self.block_ids, self.bits = sink, block_ids, bits
        self.pack = zstandard.ZstdCompressor(level=level)
        self.place = 0
        self.rest = bytearray()
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        self.index: list[tuple] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.place += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian uint32 ids."""
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.rest += ids
        size = 4 * self.block_ids
        at = 0
        while len(self.rest) - at >= size:
            self._block(bytes(self.rest[at:at + size]))
            at += size
        if at:
            del self.rest[:at]

    def _block(self, raw: bytes) -> None:
        start, sizes = self.place, []
        for plane in to_planes(np.frombuffer(raw, "<u4"), self.bits):
            data = self.pack.compress(plane) if any(plane) else b""
            sizes.append(len(data))
            self._put(data)
        self.index.append((start, len(raw) // 4, *sizes))

    def close(self) -> tuple[int, int]:
        """Write table, index and trailer; (documents, ids) of the file."""
        if self.rest:
            self._block(bytes(self.rest))
            self.rest = bytearray()
        known = np.array([d is not None for d in self.docs], np.uint8)
        ids = np.array([d or 0 for d in self.docs], "<i8")
        table = self.pack.compress(struct.pack("<Q", len(ids)) + ids.tobytes() + known.tobytes() + np.array(self.counts, "<u8").tobytes())
        table_at = self.place
        self._put(table)
        index = np.array(self.index, "<u8").tobytes()
        index_at = self.place
        self._put(index)
        self._put(struct.pack(TRAILER, table_at, len(table), index_at, len(index), int(self.bits), MAGIC))
        return len(ids), sum(self.counts)


class Reader:
    """Reads one file through a seekable source."""

    def __init__(self, source, size: int):
        self.source = source
        self.unpack = zstandard.ZstdDecompressor()
        tail = struct.calcsize(TRAILER)
        table_at, table_size, index_at, index_size, bits, magic = struct.unpack(TRAILER, self._get(size - tail, tail))
        if magic != MAGIC or self._get(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token-id file")
        self.bits = bool(bits)
        table = self.unpack.decompress(self._get(table_at, table_size))
        n = struct.unpack_from("<Q", table)[0]
        ids = np.frombuffer(table, "<i8", n, 8)
        known = np.frombuffer(table, np.uint8, n, 8 + 8 * n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.counts = np.frombuffer(table, "<u8", n, 8 + 9 * n).astype(np.int64)
        self.index = np.frombuffer(self._get(index_at, index_size), "<u8").reshape(-1, 2 + (32 if self.bits else 4)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.index[:, 1])])

    def _get(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def block(self, k: int) -> np.ndarray:
        at, count, *sizes = (int(x) for x in self.index[k])
        data, planes = self._get(at, sum(sizes)), []
        width = -(-count // 8) if self.bits else count
        for size in sizes:
            planes.append(self.unpack.decompress(data[:size], max_output_size=width) if size else bytes(width))
            data = data[size:]
        return from_planes(planes, count, self.bits)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Any range of ids, through the chunk index."""
        parts = []
        for k in range(int(np.searchsorted(self.first, start, "right")) - 1, len(self.index)):
            if self.first[k] >= stop:
                break
            parts.append(self.block(k)[max(0, start - self.first[k]):stop - self.first[k]])
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, start in the file, ids, crc32) of every document, block after block."""
        k, used, block, start = 0, 0, np.empty(0, "<u4"), 0
        for doc, count in zip(self.doc_ids, self.counts):
            left, crc = int(count), 0
            while left:
                if used == len(block):
                    block, used, k = self.block(k), 0, k + 1
                part = block[used:used + left]
                crc = zlib.crc32(part.tobytes(), crc)
                used += len(part)
                left -= len(part)
            yield doc, start, int(count), crc
            start += int(count)


# ---------------------------------------------------------------- encoding

# Unicode White_Space, which byte-level splitting calls \s.
_WS = "\t-\r \x85\xa0  -     　"
_WHITE = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{_WS}]", c))
_SPACED = re.compile(f" [{_WS}]")
# Pieces end where the byte-level splitting pattern always ends a match: letters before plain punctuation or white
# space, and any run without white space (with one space before it) at its end.
_LETTERS, _PLAIN = "A-Za-zÀ-ÖØ-öø-ʯ", ".,;:!?$%&*#()|/-"
_PIECES = re.compile(
    rf" ?[{_LETTERS}]+(?=[\t-\r {_PLAIN}]|\Z)| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
# The usual keys that aren't one word: a word and plain punctuation, or words with one line end between them.
_TAILED = re.compile(rf"([{_LETTERS}]+)([{_PLAIN}][^{_WS}]*)")
_BROKEN = re.compile(rf"([^{_WS}]+)(\n)([^{_WS}]+)")


def _byte_letters() -> list[str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()
_ENDS = frozenset(".,;:!?")
_SPACE = _BYTE_LETTERS[0x20]
_letter = _BYTE_LETTERS.__getitem__


class _Pieces(dict):
    """Ids of pieces as bytes, looked up by the text between two spaces. Two generations bound its size: ``limit``
    bytes, half of it each; what is still in use moves from the old one to the new one.

    A key stands for a space and itself. Unknown keys are cut at the tokenizer's own boundaries, so a word with
    its punctuation or line end costs one encoding of the word."""

    def __init__(self, tokenizer, limit: int):
        self.tokenizer, self.tokenize, self.old = tokenizer, tokenizer.model.tokenize, {}
        self.limit, self.used = limit // 2, 0

    def raw(self, piece: str) -> bytes:
        """One match of the splitting pattern, or several in a row, straight to the library's merge model."""
        if (piece[1:] if piece[0] == " " else piece).isalpha():
            letters = "".join(map(_letter, piece.encode()))
            return array("I", [t.id for t in self.tokenize(letters)]).tobytes()
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def of(self, text: str) -> bytes:
        """Ids of any text, piece by piece."""
        return b"".join([self[p[1:]] if p[0] == " " and len(p) > 1 and p[1] not in _WHITE else self.part(p) for p in _PIECES.findall(text)])

    def part(self, piece: str) -> bytes:
        """A piece without a space before it is kept under a key that no split text gives."""
        return self[" " + piece]

    def start(self, word: str) -> bytes:
        """Ids of a word without a space before it."""
        if word.isalpha():
            return self[" " + word]
        tailed = _TAILED.fullmatch(word)
        return self[" " + tailed[1]] + self[" " + tailed[2]] if tailed else self.of(word)

    def __missing__(self, key: str) -> bytes:
        if key[-1:] in _ENDS and key.isascii() and key[:-1].isalpha():  # put together each time, not kept
            return self[key[:-1]] + self[" " + key[-1]]
        ids = self.old.get(key)
        if ids is None:
            if key[0] == " ":
                ids = self.raw(key[1:])
            elif key.isascii() and key.isalpha():
                ids = array("I", [t.id for t in self.tokenize(_SPACE + key)]).tobytes()
            elif key.isalpha():
                ids = self.raw(" " + key)
            elif tailed := _TAILED.fullmatch(key):
                return self[tailed[1]] + self[" " + tailed[2]]
            elif broken := _BROKEN.fullmatch(key):
                ids = self[broken[1]] + self[" \n"] + self.start(broken[3])
            else:
                cut = _PIECES.findall(" " + key)
                ids = self.raw(cut[0]) if len(cut) == 1 else self[cut[0][1:]] + b"".join(map(self.part, cut[1:]))
        if len(key) <= 64 and (key[0] == " " or "\n" not in key):  # words around a line end rarely come again
            if self.used >= self.limit:
                self.old = dict(self)
                self.clear()
                self.used = 0
            self[key] = ids
            self.used += ENTRY_BYTES + 4 * len(key) + len(ids)
        return ids


@lru_cache(maxsize=2)
def _encoder(path: str, limit: int):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    spec = json.loads(tokenizer.to_str())
    split = spec["pre_tokenizer"] or {}
    known = (spec["normalizer"] is None and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
             and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space"))
    return tokenizer, _Pieces(tokenizer, limit) if known else None, added


def encode(text: str, path: str, limit: int = CACHE_BYTES) -> bytes:
    """Ids of ``text`` as little-endian uint32, equal to encoding it in one call."""
    tokenizer, pieces, added = _encoder(path, limit)
    if pieces is None or any(t in text for t in added):  # another kind of tokenizer, or a special string
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    if _SPACED.search(text) or text[-1:] == " ":
        return pieces.of(text)
    first, *rest = text.split(" ")  # every space starts a piece
    head = pieces.of(first) if first else b""
    return head + b"".join([pieces[p] for p in rest])


def encode_rows(texts: pa.Array, path: str, limit: int = CACHE_BYTES, slice_bytes: int = SLICE_BYTES) -> Iterator[bytes]:
    """``encode`` of every row, no ids for a null: of a slice of the rows each distinct word is looked up once."""
    _, pieces, added = _encoder(path, limit)
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for start, stop in slices(lengths, lengths, slice_bytes):
        part = texts.slice(start, stop - start)
        rows = part.to_pylist()
        plain = [bool(pieces is not None and r and r[-1] != " " and not any(t in r for t in added) and not _SPACED.search(r)) for r in rows]
        words = pc.split_pattern(part.filter(pa.array(plain, pa.bool_())), " ")  # every space starts a piece
        ends = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False)).tolist()
        coded = words.flatten().dictionary_encode()
        places = coded.indices.to_numpy(zero_copy_only=False)
        inner = np.ones(len(places), bool)
        inner[[0, *ends[:-1]] if ends else []] = False  # a text's first word has no space before it
        asked = np.zeros(len(coded.dictionary), bool)
        asked[places[inner]] = True
        found = np.empty(len(asked), object)
        found[asked] = [pieces[w] for w in coded.dictionary.to_numpy(zero_copy_only=False)[asked].tolist()]
        ids, at, bounds = found[places].tolist(), 0, iter(ends)
        for row, simple in zip(rows, plain):
            if not simple:
                yield encode(row, path, limit) if row else b""
                continue
            first, end = row.partition(" ")[0], next(bounds)
            yield (pieces.of(first) if first else b"") + b"".join(ids[at + 1:end])
            at = end


# ---------------------------------------------------------------- Spark

_MANIFEST = "file string, part int, n_docs long, n_ids long"
_MANIFEST_SCHEMA = pa.schema([("file", pa.string()), ("part", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
_DOCS = "part int, doc_id long, at long, n_tokens long, ids_crc32 long"
_DOCS_SCHEMA = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                      bits: bool = False, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Encode every text and write files of ascending doc_id into ``folder`` (a URI that all executors share).
    Returns the manifest (file, part, n_docs, n_ids), one row per file."""
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name, trial = f"{base}/part-{part:06d}.tid", f"{base}/.part-{part:06d}.{uuid.uuid4().hex}"
        with files.open_output_stream(trial) as sink:
            out = Writer(sink, block_ids, bits)
            for batch in batches:
                for doc, ids in zip(batch.column("doc_id").to_pylist(), encode_rows(batch.column("text"), tokenizer_path, cache_bytes)):
                    out.add(doc, ids + end)
            n_docs, n_ids = out.close()
        files.move(trial, name)
        yield record_batch(_MANIFEST_SCHEMA, {"file": [f"part-{part:06d}.tid"], "part": [part], "n_docs": [n_docs], "n_ids": [n_ids]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("_h"))
    dealt = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")
    return materialize(dealt.mapInArrow(write, _MANIFEST))


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for part, name in zip(batch.column("part").to_pylist(), batch.column("file").to_pylist()):
                size = files.get_file_info(f"{base}/{name}").size
                with files.open_input_file(f"{base}/{name}") as source:
                    rows: list[tuple] = []
                    for row in Reader(source, size).documents():
                        rows.append((part, *row))
                        if len(rows) >= 8192:
                            yield record_batch(_DOCS_SCHEMA, dict(zip(_DOCS_SCHEMA.names, zip(*rows))))
                            rows = []
                    if rows:
                        yield record_batch(_DOCS_SCHEMA, dict(zip(_DOCS_SCHEMA.names, zip(*rows))))

    # one row per file: offsets are a running sum over files, never over documents
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = small_table(manifest.select(F.col("part"), F.coalesce(before, F.lit(0)).alias("_before")), MAX_FILES)
    full = manifest.where("n_docs > 0")
    spread = full.repartition(max(1, full.count()), "part")  # a task per file or so
    found = spread.select("file", "part").mapInArrow(read, _DOCS)
    return found.join(offsets, "part").select("doc_id", (F.col("at") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as token-id files and read them back."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens", spark.sparkContext.applicationId, uuid.uuid4().hex)
    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + os.path.abspath(folder)
    return read_token_files(spark, folder, write_token_files(docs, folder, tokenizer_path, **options))
