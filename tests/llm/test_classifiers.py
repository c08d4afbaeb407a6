"""Held-out accuracy, rows, and edge cases of the two classifiers."""
import zlib

import numpy as np
from pyspark.sql import functions as F

from propensity.llm import langid, quality

MEDIUM = "/root/testdata/sf0.01"


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score_quality(docs, quality.fit(docs, labels))
    rows = found.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.9
    assert sum(r.predicted == 1 for r in held if r.quality == 1) > 0.97 * len(good)


def test_quality_edges(spark, odd_documents, no_documents, documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (99, 1), (7, 5)], "doc_id long, quality int")
    model = quality.fit(odd_documents, labels)
    found = quality.score_quality(odd_documents, model).collect()
    assert len(found) == odd_documents.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (3, 4, 6)}) == 1
    assert quality.keep_good(odd_documents, model, 0.0).columns == odd_documents.columns
    assert quality.keep_good(odd_documents, model, 0.0).count() == len(found)
    assert quality.score_quality(no_documents, model).count() == 0
    untaught = quality.fit(documents, labels.limit(0))
    assert {r.score for r in quality.score_quality(documents, untaught).collect()} == {0.5}


def test_slices_change_no_score(spark, monkeypatch):
    from propensity.llm import subword
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").limit(40).collect()] + [None, "", "a a a b b"]
    weights, bias = quality.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    whole = quality.score_texts(quality._scorer(weights), bias, texts)
    monkeypatch.setattr(subword, "SLICE_CHARS", 300)
    monkeypatch.setattr(subword, "TABLE_TOKENS", 50)
    scorer = quality._scorer(weights)
    scorer.limit = 50
    parts = quality.score_texts(scorer, bias, texts)
    assert abs(whole - parts).max() < 1e-9


def test_quality_plain_scorer(spark):
    """Scores equal a plain average of feature weights, one feature at a time."""
    from collections import Counter

    from propensity.llm.subword import Features, pair_ids, token_hash
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    weights, bias = quality.fit(docs, labels)
    features = Features(quality.BUCKETS, quality.N_MIN, quality.N_MAX, words=True)
    found = {r.doc_id: r.score for r in quality.score_quality(docs, (weights, bias)).collect()}
    for r in docs.collect():
        words = (r.text or "").split()
        rows = []
        for w in words:
            rows += [weights[i] for i in features.of([w])[0]]
        for a, b in zip(words, words[1:]):
            rows.append(weights[quality.BUCKETS + pair_ids(np.array([token_hash(a), token_hash(b)], np.uint64), quality.PAIR_BUCKETS)[0]])
        z = bias + (np.sum(rows, 0, dtype=np.float64) / len(rows) if rows else 0)
        assert abs(found[r.doc_id] - 1 / (1 + np.exp(z[0] - z[1]))) < 1e-6


def test_quality_gradient():
    """The step is the gradient of the log-loss: finite differences in doubles."""
    rng = np.random.default_rng(1)
    vectors, out, bias = rng.normal(size=(7, 3)), rng.normal(size=(3, 2)), rng.normal(size=2)
    ids, counts = np.array([1, 4, 5]), np.array([1.0, 3.0, 2.0])
    _, d_vectors, d_out, d_bias = quality.gradients(vectors, out, bias, ids, counts, 1)

    def check(table, at, want):
        step = 1e-6
        table[at] += step
        high = quality.gradients(vectors, out, bias, ids, counts, 1)[0]
        table[at] -= 2 * step
        low = quality.gradients(vectors, out, bias, ids, counts, 1)[0]
        table[at] += step
        assert abs((high - low) / (2 * step) - want) < 1e-6

    for k, i in enumerate(ids):
        for j in range(3):
            check(vectors, (i, j), d_vectors[k, j])
    for at in np.ndindex(3, 2):
        check(out, at, d_out[at])
    for j in range(2):
        check(bias, j, d_bias[j])


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    found = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    known = [r for r in found if r.held_out and r.lang is not None and any(c.isalpha() for c in r.text or "")]
    assert sum(r.lang == r.lang_pred for r in known) > 0.97 * len(known)


def test_language_edges(spark, odd_documents, no_documents):
    model = langid.fit(odd_documents)
    found = langid.identify(odd_documents, model).collect()
    assert len(found) == odd_documents.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in found if r.doc_id in (3, 4, 6))
    assert all(r.lang_pred != "und" for r in found if r.doc_id in (1, 2, 5, 7, 9, 11))
    assert langid.identify(no_documents, model).count() == 0
    none = langid.fit(odd_documents.withColumn("lang", F.lit(None).cast("string")))
    assert none is None and {r.lang_pred for r in langid.identify(odd_documents, none).collect()} == {"und"}
    one = langid.fit(odd_documents.withColumn("lang", F.lit("xx")))
    assert {r.lang_pred for r in langid.identify(odd_documents, one).collect()} == {"xx", "und"}
    digits = spark.createDataFrame([(1, "123 456 !! ² ½ _"), (2, "ſ")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in langid.identify(digits, one).orderBy("doc_id").collect()] == [True, False]


def test_quality_labels_of_other_tables_take_no_sample(spark):
    """Thousands of labels belong to no document or to one without text: the sample is still full."""
    texts = [(i, f"good clean words number {i}" if i % 2 else f"bad spam junk number {i}") for i in range(40)]
    docs = spark.createDataFrame([*texts, *[(i, None) for i in range(40, 80)]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    alone, shared = quality.fit(docs, labels.where("doc_id < 40"), train_docs=20), quality.fit(docs, labels, train_docs=20)
    assert (alone[0] == shared[0]).all() and (alone[1] == shared[1]).all()
    assert len({r.score for r in quality.score_quality(docs.where("text is not null"), shared).collect()}) > 1


def test_every_language_is_sampled(spark):
    """More languages than any fixed number; a large one is thinned to about its share."""
    docs = spark.range(36_000).selectExpr("id as doc_id", "case when id % 2 = 0 then 'en' else concat('l', id) end as lang", "'some text' as text")
    learned = docs.where(~langid.held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in langid.sample(docs, 400).groupBy("lang").count().collect()}
    want = {r["lang"] for r in learned.select("lang").distinct().collect()}
    assert len(want) > 10_000 and set(counts) == want
    assert 300 < counts.pop("en") < 500 and set(counts.values()) == {1}
