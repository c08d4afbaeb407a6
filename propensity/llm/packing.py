"""Hierarchical multi-length packing of tokenised documents.

Documents are routed to tiers of context sizes: whole windows of the longest context are cut off a long document,
what remains goes to the shortest tier that holds it. Every tier is packed into windows of its own size, from the
longest tier down: a window's gap takes the longest waiting piece of the same or a shorter tier that fits (best fit)
until nothing fits. Windows that still have a gap are filled by the emptiest ones, whose pieces are cut for it, so all
windows but the last of a task end exactly full. The last one of a task is cut at powers of two. A sequence of a
tier's length needs no padding; only lengths that aren't a power of two are padded to the longest context.

Sequences are then dealt to step groups: the n-th sequence of a tier goes to group floor(n * groups / sequences of
the tier), so every group has each tier's share to within one sequence and all groups are equally long.

Spark runs a task per split of the input; no text or id is shuffled. A task holds a pool of at most POOL_TOKENS
tokens besides one document's ids; ids leave the task as pieces' checksums, the plan itself is a table of pieces.
Numbers of sequences over all tasks come from a table of one row per task and tier. Which documents share a sequence
depends on the splits; the same files split alike give the same packing.

Edge cases: null and empty texts are documents of only the end id; a null id stays null; repeated rows are documents
of their own, told apart by ``document``; a document longer than the context is cut as often as needed; ties in the
best fit go to the piece that waited longest; an empty table gives no pieces; only doc_id and text are read.
"""
from __future__ import annotations

import struct
import zlib
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.functions.sizing import small_table
from propensity.llm.common import record_batch
from propensity.llm.tokenfile import encode_rows
from propensity.session import materialize

CONTEXTS = (2048, 1024, 512, 256, 128)
END_ID = 1
POOL_TOKENS = 1 << 20
STEP_TOKENS = 1 << 19
MAX_OFFSETS = 1_000_000  # rows (tasks x lengths) of the table of numbers that may go to every executor
DOC_BITS = 33  # rows of a task that ``document`` has room for

#: A piece: (document row in the task, doc id, start, ids as little-endian uint32, ids of the whole document).
Piece = tuple[int, int | None, int, memoryview, int]

_OUT = "task int, document long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, context int, number long, offset long"
_SCHEMA = pa.schema([("task", pa.int32()), ("document", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("context", pa.int32()), ("number", pa.int64()), ("offset", pa.int64())])


def split(piece: Piece, at: int) -> tuple[Piece, Piece]:
    row, doc, start, ids, tokens = piece
    return (row, doc, start, ids[:4 * at], tokens), (row, doc, start + at, ids[4 * at:], tokens)


def size(piece: Piece) -> int:
    return len(piece[3]) // 4


class Waiting:
    """Pieces by length. A bit per length that has pieces finds the longest one within a limit."""

    def __init__(self):
        self.queues: dict[int, deque[Piece]] = {}
        self.have = 0
        self.tokens = 0

    def add(self, piece: Piece) -> None:
        n = size(piece)
        self.queues.setdefault(n, deque()).append(piece)
        self.have |= 1 << n
        self.tokens += n

    def take(self, limit: int) -> Piece | None:
        """The longest piece of at most ``limit`` ids, the one that waited longest among equals."""
        n = (self.have & ((2 << limit) - 1)).bit_length() - 1
        if n < 1:
            return None
        queue = self.queues[n]
        piece = queue.popleft()
        if not queue:
            self.have &= ~(1 << n)
        self.tokens -= n
        return piece


class Gap:
    """A window with what it holds so far."""
    __slots__ = ("context", "held", "pieces")

    def __init__(self, context: int, piece: Piece):
        self.context, self.held, self.pieces = context, size(piece), [piece]

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.held += size(piece)


class Packer:
    """Packs a stream of documents; holds at most a pool of waiting tokens."""

    def __init__(self, contexts: Sequence[int] = CONTEXTS, pool_tokens: int = POOL_TOKENS):
        self.contexts = sorted(set(contexts), reverse=True)
        if any(c < 1 or c & (c - 1) for c in self.contexts):
            raise ValueError("contexts must be powers of two")
        self.pool_tokens = pool_tokens
        self.waiting = Waiting()

    def add(self, row: int, doc: int | None, ids: bytes) -> Iterator[tuple[int, list[Piece]]]:
        """Take a document in; yields (length, pieces) of the sequences that are full."""
        longest, view, tokens = self.contexts[0], memoryview(ids), len(ids) // 4
        whole = tokens - tokens % longest
        for start in range(0, whole, longest):
            yield longest, [(row, doc, start, view[4 * start:4 * (start + longest)], tokens)]
        if whole < tokens:
            self.waiting.add((row, doc, whole, view[4 * whole:], tokens))
        if self.waiting.tokens >= self.pool_tokens:
            yield from self.pack()

    def tier(self, n: int) -> int:
        """The shortest context that holds ``n`` ids."""
        return next(c for c in reversed(self.contexts) if c >= n)

    def pack(self) -> Iterator[tuple[int, list[Piece]]]:
        """Pack what waits; pieces that fill no window wait on."""
        open_windows: list[Gap] = []
        while (piece := self.waiting.take(self.contexts[0])) is not None:  # longest first, so tier by tier downwards
            window = Gap(self.tier(size(piece)), piece)
            while window.held < window.context and (more := self.waiting.take(window.context - window.held)) is not None:
                window.add(more)
            if window.held == window.context:
                yield window.context, window.pieces
            else:
                open_windows.append(window)
        open_windows.sort(key=lambda w: (w.context - w.held, -w.context))
        donors = deque(open_windows)
        while donors:
            window = donors.popleft()  # the smallest gap
            while window.held < window.context and donors:
                donor = donors[-1]  # the largest one
                piece = donor.pieces.pop()
                room = window.context - window.held
                if size(piece) > room:
                    piece, rest = split(piece, room)
                    donor.pieces.append(rest)
                donor.held -= size(piece)
                window.add(piece)
                if not donor.pieces:
                    donors.pop()
            if window.held == window.context:
                yield window.context, window.pieces
            else:
                for piece in window.pieces:
                    self.waiting.add(piece)

    def close(self) -> Iterator[tuple[int, list[Piece]]]:
        """Pack the rest; the last window is cut at powers of two, the largest first."""
        yield from self.pack()
        left = []
        while (piece := self.waiting.take(self.contexts[0])) is not None:
            left.append(piece)
        total = sum(map(size, left))
        left.reverse()
        while total:
            length, pieces, room = 1 << (total.bit_length() - 1), [], 1 << (total.bit_length() - 1)
            while room:
                piece = left.pop()
                if size(piece) > room:
                    piece, rest = split(piece, room)
                    left.append(rest)
                room -= size(piece)
                pieces.append(piece)
            yield length, pieces
            total -= length


def pack_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, contexts: Sequence[int] = CONTEXTS, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """The packing by tasks: a row per piece, with the sequence's number among those of its task and length."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, packer = TaskContext.get().partitionId(), Packer(contexts, pool_tokens)
        numbers: dict[int, int] = {}
        rows: list[tuple] = []

        def emit(sequences: Iterator[tuple[int, list[Piece]]]) -> None:
            for length, pieces in sequences:
                number, offset = numbers.get(length, 0), 0
                numbers[length] = number + 1
                for row, doc, start, ids, tokens in pieces:
                    n = len(ids) // 4
                    rows.append((task, (task << DOC_BITS) | row, doc, start, n, zlib.crc32(ids), tokens, length, number, offset))
                    offset += n

        def batch_of() -> pa.RecordBatch:
            out = record_batch(_SCHEMA, dict(zip(_SCHEMA.names, zip(*rows))))
            rows.clear()
            return out

        row = 0
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode_rows(batch.column("text"), tokenizer_path)):
                emit(packer.add(row, doc, ids + end))
                row += 1
                if len(rows) >= 8192:
                    yield batch_of()
        emit(packer.close())
        if rows:
            yield batch_of()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _OUT)


def pack_documents(docs: DataFrame, tokenizer_path: str, step_tokens: int = STEP_TOKENS, **options) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step, document: a row per piece."""
    pieces = materialize(pack_pieces(docs, tokenizer_path, **options))
    counts = pieces.where("offset = 0").groupBy("context", "task").agg(F.count(F.lit(1)).alias("_n"))  # a row per task and length
    counts = materialize(counts)
    longest = Window.orderBy(F.desc("context"))
    # a row per length: at most one for each power of two up to the longest context
    tiers = counts.groupBy("context").agg(F.sum("_n").alias("_all")).withColumn("_longer", F.sum("_all").over(longest) - F.col("_all"))
    tokens = F.sum(F.col("context").cast("long") * F.col("_all")).over(Window.partitionBy(F.lit(0)))
    tiers = tiers.withColumn("_steps", F.greatest(F.lit(1), F.ceil(tokens / F.lit(step_tokens))))
    before = F.sum("_n").over(Window.partitionBy("context").orderBy("task")) - F.col("_n")
    offsets = counts.withColumn("_before", before).join(F.broadcast(tiers), "context").drop("_n")
    placed = pieces.join(small_table(offsets, MAX_OFFSETS), ["context", "task"]).withColumn("_n", F.col("_before") + F.col("number"))
    step = F.floor(F.col("_n") * F.col("_steps") / F.col("_all")).cast("long")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_longer") + F.col("_n")).alias("sequence_id"),
                         "offset", "context", step.alias("step"), "document")
