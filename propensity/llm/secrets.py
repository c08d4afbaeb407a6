"""Secret scanning with an incremental blob ledger.

Every historical version of every path is content-addressed by the SHA-256 of its UTF-8 bytes. The ledger holds
one row per (blob, rule version) with the findings, empty ones included. A run scans only the pairs that the
ledger hasn't seen, appends them, and joins findings back to all paths that ever held the blob.

Texts are reduced to one copy per blob with map-side combining before they move, so copies of one text shared
by a large part of the rows cost one row per task. Findings join narrow (path, blob) rows; a blob with very many
paths is a skewed key that Spark splits.

Spans are code points, end exclusive, of the whole match. Per rule, matches are leftmost and non-overlapping;
matches that fail the rule's length test are dropped after matching. The ledger method adds no spans of its own.

Edge cases: a null text is the empty blob; null and repeated ids are paths like any other, each row counts by
itself; a text without findings has empty spans; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import record_batch
from propensity.session import shared_path


@dataclass(frozen=True)
class Rule:
    """A named pattern; ``group`` of a match must have ``least`` characters."""
    kind: str
    pattern: str
    group: int
    least: int
    any_case: bool = False

    @property
    def version(self) -> str:
        spec = f"{self.kind}\n{self.pattern}\n{self.group}\n{self.least}\n{self.any_case}"
        return hashlib.sha256(spec.encode()).hexdigest()[:16]

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The rules of the contract, in its order.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)

FOUND_SCHEMA = pa.schema([
    ("blob", pa.binary()), ("rule_version", pa.string()), ("kind", pa.string()),
    ("findings", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
FOUND_DDL = "blob binary, rule_version string, kind string, findings array<struct<start: bigint, end: bigint>>"


def find(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in compiled.finditer(text) if len(m.group(rule.group)) >= rule.least]


def _fast(rule: Rule) -> re.Pattern:
    """A run of one class is maximal either way, so the length test of such a rule can move into the pattern."""
    if rule.group == 0 and rule.pattern.endswith("]+") and rule.pattern.startswith("["):
        return re.compile(rule.pattern[:-1] + "{%d,}" % rule.least, re.ASCII | (re.IGNORECASE if rule.any_case else 0))
    return rule.compiled()


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """Ledger rows of (blob, text, todo) rows; ``todo`` lists the rule versions to run."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {r.version: (r, _fast(r)) for r in rules}
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in FOUND_SCHEMA}
            todo = batch.column("todo").to_pylist()
            for i, blob in enumerate(batch.column("blob").to_pylist()):
                text = batch.column("text")[i].as_py()
                for version in todo[i]:
                    rule, compiled = ready[version]
                    out["blob"].append(blob)
                    out["rule_version"].append(version)
                    out["kind"].append(rule.kind)
                    out["findings"].append([{"start": a, "end": b} for a, b in find(rule, compiled, text)])
            yield record_batch(FOUND_SCHEMA, out)

    return blobs.select("blob", "text", "todo").mapInArrow(scan, FOUND_DDL)


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger at ``path``; empty if nothing was written there yet."""
    try:
        return spark.read.schema(FOUND_DDL).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FOUND_DDL)


def addressed(docs: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(path_col).alias("path"), F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))


def update_ledger(docs: DataFrame, ledger_path: str, rules=RULES, path_col: str = "doc_id", text_col: str = "text") -> None:
    """Scan the unseen (blob, rule version) pairs of ``docs`` and append their rows to the ledger."""
    spark = docs.sparkSession
    versions = F.array(*[F.lit(r.version) for r in rules])
    seen = read_ledger(spark, ledger_path).groupBy("blob").agg(F.collect_set("rule_version").alias("seen"))
    blobs = addressed(docs, path_col, text_col).select("blob", "text").dropDuplicates(["blob"])
    todo = F.when(F.col("seen").isNull(), versions).otherwise(F.array_except(versions, "seen"))
    unseen = blobs.join(seen, "blob", "left").withColumn("todo", todo).where(F.size("todo") > 0)
    scan_blobs(unseen, rules).write.mode("append").parquet(ledger_path)


def join_findings(docs: DataFrame, ledger: DataFrame, rules=RULES, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, findings) for every row of ``docs``: findings (start, rank, kind, end) by start, then rule order."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))])
    rows = ledger.where(F.col("rule_version").isin([r.version for r in rules]) & (F.size("findings") > 0))
    rows = rows.dropDuplicates(["blob", "rule_version"]).select(
        "blob", F.transform("findings", lambda f: F.struct(
            f["start"].alias("start"), rank[F.col("rule_version")].alias("rank"), F.col("kind").alias("kind"),
            f["end"].alias("end"))).alias("found"))
    per_blob = rows.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("findings"))
    paths = addressed(docs, path_col, text_col).select("path", "blob")
    return paths.join(per_blob, "blob", "left").select("path", "findings")


def scan_secrets(docs: DataFrame, ledger_path: str | None = None, rules=RULES) -> DataFrame:
    """Findings of every path. ``ledger_path`` continues an existing ledger; unset, a new one is begun in the
    shared folder."""
    import uuid
    spark = docs.sparkSession
    fresh_path = shared_path(spark, "ledger", spark.sparkContext.applicationId, uuid.uuid4().hex)
    path = ledger_path or fresh_path
    update_ledger(docs, path, rules)
    return join_findings(docs, read_ledger(spark, path), rules)


def digest_columns(found: DataFrame, rules=RULES) -> DataFrame:
    """The contract's columns: counts by kind, the digest of the joined spans and the spans."""
    findings = F.coalesce("findings", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>"))
    spans = F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("path").alias("doc_id"), *[count(r.kind) for r in rules], F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))
