"""Registered queries of this package and their SQL twins (DuckDB), where SQL can express them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propensity.llm import (decontaminate, langid, mixing, neardup, packing, quality, repeats, secrets, spelling, tokenfile,
                            topk, warc, whiten)
from propensity.llm.common import prepare
from propensity.sources.tables import table

NEAR_DUP_WORDS = 2  # the contract of op4
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf_dir, name)


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "items")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), words=NEAR_DUP_WORDS)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.warc_round_trip(_table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_files(_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.scan_secrets(_table(spark, sf_dir, "documents")))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(_table(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {f.__name__: f for f in (
    op1_top_k, op2_quality, op3_decontaminate, op4_near_duplicates, op5_warc, op6_language, op7_token_files, op8_mixing,
    op9_secrets, op10_repeats, op11_spelling, op12_whitening, op13_packing)}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')"
_ALNUM = _WORDS.format(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPACED = _WORDS.format(r"[^\x20\x09-\x0D]+")

SQL = {
    "op1_top_k": topk.SQL,
    "op3_decontaminate": f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (SELECT item, least(10, len(w)) AS m, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i, w FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item, m, array_to_string(w[i + 1 : i + m], ' ') AS p FROM win),
pos AS (SELECT doc_id, w, m, unnest(range(0, len(w) - m + 1)) AS i FROM d, (SELECT DISTINCT m FROM pat) WHERE len(w) >= m),
hit AS (SELECT doc_id, i, pat.m, item FROM pos JOIN pat ON pat.m = pos.m AND pat.p = array_to_string(w[i + 1 : i + pos.m], ' ')),
words AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op4_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
             ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id)
SELECT doc_id, n AS n_shingles, min(c) AS component_id, min(c) = doc_id AS kept FROM n JOIN r ON r.id = doc_id GROUP BY doc_id, n
""",
    "op5_warc": """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
""",
    "op11_spelling": spelling.SQL,
}
