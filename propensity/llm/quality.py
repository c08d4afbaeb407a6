"""Quality classifier: supervised subword embeddings.

Every word, its character n-grams and every pair of neighbouring words have learned vectors in a hashed table; a
document is the average of its features' vectors, a softmax over two classes reads it. The model is trained by
stochastic gradient descent in numpy on at most ``train_docs`` labelled documents (those with the smallest hashes of
their ids; a documented bound, all of them if there are fewer); features of the sample are counted on the executors,
the driver gets their hashed counts. Scoring covers every whole text and moves no rows.

Averages are linear, so the two class scores of a document are sums over its words and pairs; see ``subword``.

Edge cases: null and empty texts get the score of the bias alone; labels that are null or belong to no document
teach nothing, an id labelled twice takes its highest label; without any labels every score is 0.5; null ids are
scored but never learned from; repeated rows are scored alike; other columns are not read, and ``keep_good``
carries them unchanged.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.subword import Features, TokenScores, pair_ids, token_hash, token_slices

BUCKETS, PAIR_BUCKETS, DIM = 1 << 16, 1 << 17, 12
N_MIN, N_MAX = 3, 4
TRAIN_DOCS, EPOCHS, SEED = 3000, 6, 5
#: Step sizes of the softmax layer and, as a multiple, of the vectors (a feature's share of a document is small).
RATE, VECTOR_RATE = 0.5, 4.0
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def bag(text: str, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, counts) of a text; pairs come after the ``BUCKETS`` ids of words and character n-grams."""
    tokens, pairs, last = Counter(), np.zeros(PAIR_BUCKETS, np.int64), None
    for part in token_slices(text):
        tokens.update(part)
        hashes = np.array([token_hash(t) for t in ([last] if last is not None else []) + part], np.uint64)
        if len(hashes) > 1:
            pairs += np.bincount(pair_ids(hashes, PAIR_BUCKETS), minlength=PAIR_BUCKETS)
        last = part[-1] if part else last
    ids, counts = features.counts(tokens)
    found = np.flatnonzero(pairs)
    return np.concatenate([ids, found + BUCKETS]), np.concatenate([counts, pairs[found]])


def gradients(vectors: np.ndarray, out: np.ndarray, bias: np.ndarray, ids: np.ndarray, counts: np.ndarray, label: int):
    """(loss, d loss / d vectors[ids], d loss / d out, d loss / d bias) of one document's log-loss."""
    share = (counts / max(counts.sum(), 1)).astype(vectors.dtype)
    mean = share @ vectors[ids] if len(ids) else np.zeros(len(out), vectors.dtype)
    z = mean @ out + bias
    p = np.exp(z - z.max())
    p /= p.sum()
    loss = -np.log(np.maximum(p[label], 1e-30))
    p[label] -= 1
    return loss, np.outer(share, out @ p), np.outer(mean, p), p


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = SEED, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """(class scores of every feature [BUCKETS + PAIR_BUCKETS, 2], biases) from (ids, counts, label) samples."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.1 / DIM, 0.1 / DIM, (BUCKETS + PAIR_BUCKETS, DIM)).astype(np.float32)
    out, bias = rng.uniform(-0.5, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    if not samples:
        return np.zeros((len(vectors), 2), np.float32), bias
    steps, step = epochs * len(samples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            ids, counts, label = samples[k]
            lr = np.float32(rate * (1 - step / steps))
            step += 1
            _, d_vectors, d_out, d_bias = gradients(vectors, out, bias, ids, counts, label)
            vectors[ids] -= lr * np.float32(VECTOR_RATE) * d_vectors
            out -= lr * d_out
            bias -= lr * np.float32(0.1) * d_bias
    return (vectors @ out).astype(np.float32), bias


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Learn from the labelled documents outside the held-out fold."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    marks = marks.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    marks = marks.where(~held_out(F.col("doc_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    # labels may be shared with other tables: only those of documents with text count for the bound
    marks = marks.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = marks.withColumn("_h", F.xxhash64("doc_id", F.lit(SEED))).orderBy("_h", "doc_id").limit(train_docs).drop("_h")
    texts = texts.join(F.broadcast(chosen), "doc_id")  # at most train_docs rows
    features = Features(BUCKETS, N_MIN, N_MAX, words=True)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for text in batch.column("text"):
                i, c = bag(text.as_py(), features)
                ids.append(i.astype("<u4").tobytes())
                counts.append(c.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                                             names=["doc_id", "label", "ids", "counts"])

    rows = texts.select("doc_id", "label", "text").mapInArrow(count, "doc_id long, label int, ids binary, counts binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["ids"]))
    samples = []
    for r in rows:
        samples.append((np.frombuffer(r["ids"], "<u4").astype(np.int64), np.frombuffer(r["counts"], "<f4"), r["label"]))
    return train(samples)


def score_texts(scores: TokenScores, bias: np.ndarray, texts: list[str | None]) -> np.ndarray:
    """Probability of label 1."""
    out = []
    for sums, n, _ in scores.documents(texts):
        z = bias + (sums / n if n else 0.0)
        out.append(1 / (1 + np.exp(np.clip(z[0] - z[1], -700, 700))))
    return np.array(out, np.float64)


def _scorer(weights: np.ndarray):
    return TokenScores(Features(BUCKETS, N_MIN, N_MAX, words=True), weights[:BUCKETS], pairs=weights[BUCKETS:])


def score_quality(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    weights, bias = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(weights)
        for batch in batches:
            p = score_texts(scores, bias, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns kept."""
    weights, bias = model
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(weights)
        for batch in batches:
            p = score_texts(scores, bias, batch.column(at).to_pylist())
            yield batch.filter(pa.array(p >= threshold))

    return docs.mapInArrow(keep, docs.schema)
