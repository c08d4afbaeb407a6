"""Every stage on the output of the one before, against plain versions."""
import re

import corpus_pipeline
from propensity.llm import mixing, quality
from propensity.session import materialize
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_neardup import brute as classes
from tests.llm.test_tokenfile import brute as tokens

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "near_duplicates", "decontamination", "mixing", "token_ids"]
    stage = dict(corpus_pipeline.STAGES)
    good = materialize(stage["quality_classifier"](spark, documents, SMALL))
    scores = quality.score_quality(documents, quality.fit(documents, spark.read.parquet(f"{SMALL}/labels.parquet"))).collect()
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in scores if r.predicted)

    single = materialize(stage["near_duplicates"](spark, good, SMALL))
    want = {c[0] for c in classes([(r.doc_id, r.text) for r in good.collect()], 5) if c[3]}
    assert sorted(r.doc_id for r in single.collect()) == sorted(want)

    clean = materialize(stage["decontamination"](spark, single, SMALL))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = {c[0] for c in contamination([(r.doc_id, r.text) for r in single.collect()], items) if not c[5]}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(want)

    mixed = materialize(stage["mixing"](spark, clean, SMALL))
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(clean).collect() if r.taken}
    found = {}
    for r in mixed.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert found == taken
    for df in (good, single, clean, mixed):
        assert df.columns == documents.columns

    from tokenizers import Tokenizer
    from propensity.llm.queries import tokenizer_path
    out = sorted(tuple(r) for r in stage["token_ids"](spark, mixed, SMALL).collect())
    plain = tokens([(r.doc_id, r.text) for r in mixed.collect()], Tokenizer.from_file(tokenizer_path()))
    assert sorted((d, n, c) for d, _, n, c in out) == sorted((d, n, c) for d, _, n, c in plain)
    assert out[0][1] == 0 and [r[0] for r in sorted(out, key=lambda r: r[1])] == sorted(r[0] for r in out)


def test_empty_and_odd_tables(spark, no_documents, odd_documents):
    for docs, empty in ((no_documents, True), (odd_documents, False)):
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, docs, SMALL))
            if name != "token_ids":
                assert out.columns == docs.columns
            assert (out.count() == 0) == empty
            # what the classifier keeps of the odd rows is its own affair; the others see all of them
            docs = docs if name == "quality_classifier" else out
