"""Exact top-k inner products: norm-sorted candidates, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Vectors are scaled to integers, ``floor(scale * x)``. Candidates are range-partitioned by descending length and
packed into blocks. Queries are packed into blocks of bounded size too; for each of them one pass over the candidate
blocks keeps, per task, the best ``k`` of every query. A query is skipped for a whole candidate block when
``|q| * (longest candidate)`` can't reach its threshold; otherwise the rotated coordinates up to each cut give a partial
sum, ``|q_rest| * |c_rest|`` bounds the remainder, and only what the bounds leave gets the exact integer product. Thresholds start from the longest candidates and rise inside each task. The rotation is the
right singular basis of a bounded sample of candidates; it affects speed only, never results.

Bounds are compared with a margin above their rounding error, and scores are computed in whole numbers: double
products where they are exact, 64-bit integers beyond that.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a
null id; vectors are compared with those of their own dimension only; repeated rows are separate candidates, but
no row with the query's own id is its candidate; a query id on several rows asks with its smallest vector; ties go
to the smaller id; components beyond the 64-bit range saturate; fewer than k candidates give fewer rows; an empty table gives an empty result.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.llm.common import record_batch
from propensity.session import materialize, shared_path

K, SCALE, QUERY_EVERY = 5, 256, 50
BLOCK_ROWS, QUERY_BLOCK_BYTES, SAMPLE_ROWS, SEED_ROWS = 4096, 8 << 20, 8192, 4096
CUTS = (16, 32, 48)  # rotated coordinates after which pairs are ruled out
TRIAL_PAIRS, USEFUL, RETRY = 1 << 22, 0.6, 32  # a cut that leaves more than this share is tried once in so many blocks
QUERY_ROWS, PAIRWISE = 512, 0.02
EXACT = float(1 << 52)

_BLOCK_SCHEMA = pa.schema([("longest", pa.float64()), ("n", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])
_BLOCK_DDL = "longest double, n long, ids binary, vectors binary"
_QUERY_SCHEMA = pa.schema([("n", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])
_QUERY_DDL = "n long, ids binary, vectors binary"
_HIT_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_HIT_DDL = "query_id long, vec_id long, score long"


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, dim, norm): valid vectors as whole numbers."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    v = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    rows = embeddings.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double"))
    return rows.select("vec_id", "v", F.size("v").alias("dim"), F.sqrt(square).alias("norm"))


def pack(vectors: DataFrame) -> DataFrame:
    """Blocks of up to BLOCK_ROWS candidates by descending length."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, norms, held = [], [], [], 0

        def emit() -> pa.RecordBatch:
            v = np.concatenate(rows)
            return record_batch(_BLOCK_SCHEMA, {"longest": [max(norms)], "n": [held], "ids": [np.concatenate(ids).tobytes()], "vectors": [v.tobytes()]})

        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(batch.num_rows, -1)
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = flat[a:a + BLOCK_ROWS]
                if held and held + len(part) > BLOCK_ROWS:
                    yield emit()
                    ids, rows, norms, held = [], [], [], 0
                ids.append(batch.column("vec_id").to_numpy()[a:a + BLOCK_ROWS].astype("<i8"))
                rows.append(part)
                norms.append(batch.column("norm")[a].as_py())
                held += len(part)
        if held:
            yield emit()

    dealt = vectors.repartitionByRange(F.col("norm").desc(), F.xxhash64("vec_id")).sortWithinPartitions(F.col("norm").desc(), "vec_id")
    return dealt.select("vec_id", "v", "norm").mapInArrow(blocks, _BLOCK_DDL)


def rotation(vectors: DataFrame, dim: int, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Right singular vectors of a sample of at most ``rows`` candidates."""
    sample = vectors.select("v", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(rows).collect()
    if not sample:
        return np.eye(dim)
    return np.linalg.svd(np.array([r["v"] for r in sample], np.float64), full_matrices=True)[2].T if len(sample) < dim else \
        np.linalg.eigh((lambda m: m.T @ m)(np.array([r["v"] for r in sample], np.float64)))[1][:, ::-1]


class QueryBlock:
    """Queries with rotated coordinates, current best k each, and thresholds.

    A block of candidates is cut down in steps: after the first 16, 32, 48 rotated coordinates the partial sums plus
    the Cauchy-Schwarz bound of the rest rule pairs out, and candidates and queries without a pair left drop out of
    the block. What is left is finished pair by pair if little is, as one block product otherwise. A cut that has
    ruled out little so far is only tried now and then: it decides the work, never the result."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.vectors, self.turn, self.k = ids, vectors, turn, k
        self.values = vectors.astype(np.float64)
        self.norm = np.sqrt((self.values ** 2).sum(1))
        self.cuts = [c for c in CUTS if c < vectors.shape[1]]
        self.rotated, self.rests = self._turned(self.values)
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor
        self.tested, self.left, self.offers = np.zeros(len(self.cuts) + 1), np.zeros(len(self.cuts) + 1), 0
        empty = np.empty(0, np.int64)
        self.best = (empty, empty, empty)  # query position, vec_id, score

    def _turned(self, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rotated coordinates and, per cut, the length of what comes after it."""
        rotated = values @ self.turn
        return rotated, [np.sqrt((rotated[:, c:] ** 2).sum(1)) for c in self.cuts]

    def scores(self, at: np.ndarray, rows: np.ndarray, c: np.ndarray, exact: bool) -> np.ndarray:
        """Integer products of pairs (query, candidate row)."""
        out = np.empty(len(at), np.int64)
        q, v = (self.values, c.astype(np.float64)) if exact else (self.vectors, c)
        for a in range(0, len(at), 1 << 15):
            part = slice(a, a + (1 << 15))
            out[part] = np.einsum("ij,ij->i", q[at[part]], v[rows[part]])
        return out

    def offer(self, ids: np.ndarray, c: np.ndarray) -> None:
        """Take one block of candidates in."""
        values = c.astype(np.float64)
        lengths = np.sqrt((values ** 2).sum(1))
        slack = 1e-9 * (self.norm * lengths.max() + 1) + 0.25
        live = np.flatnonzero(self.norm * lengths.max() + slack >= self.floor)
        if not len(live):
            return
        self.offers += 1
        retry = self.offers % RETRY == 0
        use = [k for k in range(len(self.cuts)) if retry or self.tested[k] < TRIAL_PAIRS or self.left[k] < USEFUL * self.tested[k]]
        rotated, rests = self._turned(values) if use else (None, None)
        exact = self.norm[live].max() * lengths.max() < EXACT
        for a in range(0, len(live), QUERY_ROWS):
            self._offer(live[a:a + QUERY_ROWS], ids, c, values, lengths, rotated, rests, slack, use, exact)

    def _offer(self, rows, ids, c, values, lengths, rotated, rests, slack, use, exact) -> None:
        floor = self.floor[rows] - slack[rows]
        # row-level stop: a candidate that is too short for every query of the part
        columns = np.flatnonzero(np.isneginf(floor).any() | (lengths >= (floor / np.maximum(self.norm[rows], 1e-300)).min()))
        total, done, near = None, 0, None
        for k in use:
            if not len(columns):
                return
            to = self.cuts[k]
            step = self.rotated[rows, done:to] @ rotated[columns, done:to].T
            total, done = step if total is None else total + step, to
            near = total + self.rests[k][rows, None] * rests[k][None, columns] >= floor[:, None]
            self.tested[k] += near.size
            keep_rows, keep_columns = near.any(1), near.any(0)
            self.left[k] += int(near.sum())
            if not keep_rows.all() or not keep_columns.all():
                rows, columns, floor = rows[keep_rows], columns[keep_columns], floor[keep_rows]
                total, near = total[np.ix_(keep_rows, keep_columns)], near[np.ix_(keep_rows, keep_columns)]
        if not len(rows) or not len(columns):
            return
        self.tested[-1] += len(rows) * len(columns)
        if not exact or (near is not None and near.mean() < PAIRWISE):
            q, row = np.nonzero(near if near is not None else np.ones((len(rows), len(columns)), bool))
            q, row = rows[q], columns[row]
            score = self.scores(q, row, c, exact)
            other = self.ids[q] != ids[row]
            self._enter(q[other], ids[row[other]], score[other])
            return
        product = self.values[rows] @ values[columns].T
        own = np.flatnonzero(np.isin(ids[columns], self.ids[rows]))  # a query is no candidate of its own
        product[:, own] = np.where(self.ids[rows, None] == ids[None, columns[own]], -np.inf, product[:, own])
        least = self.floor[rows]
        if product.shape[1] > self.k and np.isneginf(least).any():  # the k-th best of the block is a threshold already
            least = np.maximum(least, np.partition(product, -self.k, axis=1)[:, -self.k])
        q, row = np.nonzero((product >= least[:, None]) & (product > -np.inf))
        self._enter(rows[q], ids[columns[row]], product[q, row].astype(np.int64))

    def _enter(self, q: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        better = score >= self.floor[q]
        if better.any():
            self.left[-1] += int(better.sum())
            self._merge(q[better], vec[better], score[better])

    def _merge(self, q: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        old = np.isin(self.best[0], q)
        kept = tuple(b[~old] for b in self.best)
        q, vec, score = (np.concatenate([b[old], n]) for b, n in zip(self.best, (q, vec, score)))
        order = np.lexsort((vec, -score, q))
        q, vec, score = q[order], vec[order], score[order]
        first = np.concatenate([[0], np.flatnonzero(q[1:] != q[:-1]) + 1])
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        kth = place == self.k - 1
        self.floor[q[kth]] = np.maximum(self.floor[q[kth]], score[kth])
        top = place < self.k
        self.best = tuple(np.concatenate([a, b[top]]) for a, b in zip(kept, (q, vec, score)))


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["vectors"], "<i8").reshape(len(ids), -1)


def pack_queries(vectors: DataFrame, every: int, dim: int) -> DataFrame:
    """Blocks of queries, packed where their rows are: (n, ids, vectors), each at most QUERY_BLOCK_BYTES."""
    limit = max(1, QUERY_BLOCK_BYTES // (8 * dim))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = np.empty(0, "<i8"), np.empty((0, dim), "<i8")
        for batch in batches:
            ids = np.concatenate([ids, batch.column("vec_id").to_numpy().astype("<i8")])
            rows = np.concatenate([rows, batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(batch.num_rows, dim)])
            while len(ids) >= limit:
                yield record_batch(_QUERY_SCHEMA, {"n": [limit], "ids": [ids[:limit].tobytes()], "vectors": [rows[:limit].tobytes()]})
                ids, rows = ids[limit:], rows[limit:]
        if len(ids):
            yield record_batch(_QUERY_SCHEMA, {"n": [len(ids)], "ids": [ids.tobytes()], "vectors": [rows.tobytes()]})

    asked = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    return asked.mapInArrow(blocks, _QUERY_DDL)


def _groups(blocks: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query blocks joined up to QUERY_BLOCK_BYTES; a block at a time reaches the driver."""
    held, size = [], 0
    for r in blocks.toLocalIterator():
        if held and size + len(r["vectors"]) > QUERY_BLOCK_BYTES:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
        held.append(_unpack(r))
        size += len(r["vectors"])
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _pass(spark: SparkSession, blocks: DataFrame, ids: np.ndarray, queries: np.ndarray, turn: np.ndarray, floor: np.ndarray, k: int) -> DataFrame:
    sent = spark.sparkContext.broadcast((ids, queries, turn, floor))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, turn, floor = sent.value
        own = QueryBlock(ids, queries, turn, k, floor.copy())
        for batch in batches:
            for i in range(batch.num_rows):
                own.offer(*_unpack({c: batch.column(c)[i].as_py() for c in ("ids", "vectors")}))
        q, vec, score = own.best
        yield record_batch(_HIT_SCHEMA, {"query_id": own.ids[q], "vec_id": vec, "score": score})

    return blocks.select("ids", "vectors").mapInArrow(search, _HIT_DDL)


def top_k(embeddings: DataFrame, k: int = K, every: int = QUERY_EVERY, scale: int = SCALE) -> DataFrame:
    """Per query (vec_id divisible by ``every``) its k highest integer products: query_id, rank, vec_id, score."""
    spark = embeddings.sparkSession
    vectors = materialize(integer_vectors(embeddings, scale))
    found = shared_path(spark, "stage", spark.sparkContext.applicationId, uuid.uuid4().hex)  # one table for all passes
    spark.createDataFrame([], _HIT_DDL).write.parquet(found)
    for (dim,) in vectors.select("dim").distinct().toLocalIterator():
        own = vectors.where(F.col("dim") == dim)
        turn = rotation(own, dim)
        blocks, asked = materialize(pack(own)), materialize(pack_queries(own, every, dim))
        longest = [_unpack(r) for r in blocks.orderBy(F.desc("longest")).limit(max(1, SEED_ROWS // BLOCK_ROWS)).collect()]
        for ids, queries in _groups(asked):
            # thresholds from the longest candidates: real scores of real candidates, so safe lower bounds
            seed = QueryBlock(ids, queries, turn, k)
            for block_ids, block in longest:
                seed.offer(block_ids, block)
            _pass(spark, blocks, ids, queries, turn, seed.floor, k).write.mode("append").parquet(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = spark.read.schema(_HIT_DDL).parquet(found).withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
