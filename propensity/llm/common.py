"""Helpers shared by the operators of this package."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

from propensity.session import ensure_checkpoint_dir

#: Runs of anything but the six ASCII white-space characters (fixed by the contracts).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session needs of this package: the shared folder, and Arrow batches that whole texts fit into (ten thousand
    documents are more than a Python worker should hold). A batch size that the session sets itself is kept."""
    ensure_checkpoint_dir(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def utf8_rows(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def slices(rows: list, sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes each (a longer row is a range of its own)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(rows):
        yield start, len(rows)


def record_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
