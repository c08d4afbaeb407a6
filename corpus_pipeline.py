"""Training-corpus pipeline: five stages over ``documents``, each the operator of ``propensity.llm`` for its step.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the
shared folder and reads it back as the next stage's documents. All stages but the last return the columns of
documents. Edge cases are those of the operators; an empty table stays empty through all stages."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propensity.llm import decontaminate, mixing, neardup, quality, tokenfile
from propensity.llm.common import prepare
from propensity.llm.queries import tokenizer_path
from propensity.session import materialize
from propensity.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of this stage's documents."""
    prepare(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles, similarity 0.8 or more)."""
    prepare(spark)
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document once per time that its words are taken."""
    prepare(spark)
    return mixing.apply_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix, read back: doc_id, start, n_tokens, ids_crc32 per copy."""
    prepare(spark)
    return tokenfile.token_files(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: A learned classifier isn't SQL; the tests hold every stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return materialize(STAGES[-1][1](spark, docs, sf_dir))
