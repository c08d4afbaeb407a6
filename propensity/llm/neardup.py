"""Near-duplicate classes by min-max hashing, banding, and confirmation on full sets.

Per document: the set of distinct ``words``-word shingles as 64-bit hashes. Under every random permutation both the
smallest and the largest value are kept, so ``PERMUTATIONS`` hash evaluations give twice as many signature values;
values of equal kind form bands of ``ROWS``. With 240 values in 48 bands of 5, a pair at similarity 0.8 shares no
band with probability 5e-9.

1. Documents with equal sets collapse to their smallest id (aggregated with map-side combining).
2. Representatives that share a band key form a bucket, dealt in chunks of about ``BUCKET_ROWS``. In each chunk,
   representatives whose signatures agree in a share of ``NEAR`` or more (six standard deviations below the threshold)
   are joined by a spanning forest. In a bucket of several chunks, what is joined by then carries its component; rows
   outside the bucket's largest component are compared with all rows of other components, in blocks of a chunk and a
   part of them. Near copies are one component by then and need no more work, whatever their number; many unlike
   texts in one bucket cost the square of their number. Only forest edges leave a task.
3. Connected components of the forest are clusters: no two documents of different clusters are linked.
4. Inside a cluster links are confirmed on the full sets, exactly, and again reduced to a forest. A cluster with
   more than ``CHUNK_SHINGLES`` shingles is dealt in chunks, and each pair of chunks is one group, so no task
   holds more than two chunks whatever the size of the cluster.
5. Components of the confirmed forest are the classes.

Edge cases: null and empty texts (and texts of white space only) have an empty set and are linked with nothing; a
text with fewer words than a shingle is one shingle; rows of equal id are one vertex, linked by any of their texts;
rows with a null id are linked with nothing and kept; an empty table gives an empty result; other columns are
not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions.sizing import broadcast_if_bounded
from propensity.llm.common import record_batch, utf8_rows
from propensity.llm.components import components
from propensity.session import materialize

WORDS, PERCENT = 5, 80
PERMUTATIONS, ROWS, SEED = 120, 5, 3
NEAR = 0.65
BUCKET_ROWS, CHUNK_SHINGLES, MAX_CACHED_WORDS = 1024, 100_000, 100_000
STEP = 2048
MAX_BROADCAST_ROWS = 1_000_000  # of 32 bytes

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: bytes | None, words: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    if not text:
        return np.empty(0, np.uint64)
    tokens = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII white-space characters
    if not tokens:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    n = min(words, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - n + 1, np.uint64(n))
        for k in range(n):
            h = (h ^ w[k:len(w) - n + 1 + k]) * _A
            h ^= h >> np.uint64(32)
        h *= _B
        h ^= h >> np.uint64(29)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) > 1 else h


class MinMax:
    """Min-max signatures: both ends of the set under each permutation."""

    def __init__(self, permutations: int = PERMUTATIONS, rows: int = ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 32, permutations, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 1 << 32, permutations, dtype=np.uint64).astype(np.uint32)[:, None]
        self.rows = rows

    def ends(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        low = high = None
        for s in range(0, len(x), STEP):
            m = self.a * x[None, s:s + STEP] + self.b
            lo, hi = m.min(1), m.max(1)
            low, high = (lo, hi) if low is None else (np.minimum(low, lo), np.maximum(high, hi))
        return low, high

    def bands(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """One 64-bit key per band; bands hold minima only or maxima only."""
        parts = np.concatenate([low, high]).reshape(-1, self.rows).astype(np.uint64)
        with np.errstate(over="ignore"):
            key = np.arange(1, len(parts) + 1, dtype=np.uint64) * _B
            for k in range(self.rows):
                key = (key ^ parts[:, k]) * _A
                key ^= key >> np.uint64(32)
        return key.astype(np.int64)

    @staticmethod
    def short(low: np.ndarray, high: np.ndarray) -> bytes:
        """One byte per value for comparing signatures."""
        return np.concatenate([low, high]).astype(np.uint8).tobytes()


_SIG_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])
_SIG_DDL = "doc_id long, n long, digest binary, sig binary, bands array<bigint>"


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, digest, sig, bands) for every row; digest, sig and bands are null for an empty set or null id."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hasher = _Words(), MinMax()
        for batch in batches:
            column, ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for a in range(0, len(ids), 1024):
                out: dict[str, list] = {f.name: [] for f in _SIG_SCHEMA}
                for i in range(a, min(a + 1024, len(ids))):
                    h = shingles(utf8_rows(column.slice(i, 1))[0], words, known)
                    out["doc_id"].append(ids[i])
                    out["n"].append(len(h))
                    if len(h) and ids[i] is not None:
                        low, high = hasher.ends(h)
                        out["digest"].append(xxhash.xxh3_128_digest(h.tobytes()))
                        out["sig"].append(hasher.short(low, high))
                        out["bands"].append(hasher.bands(low, high))
                    else:
                        for c in ("digest", "sig", "bands"):
                            out[c].append(None)
                yield record_batch(_SIG_SCHEMA, out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, _SIG_DDL)


_EDGE_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest(n: int, near) -> list[tuple[int, int]]:
    """Spanning forest of the graph in which ``near(i, rest)`` marks the neighbours of i among ``rest``. Each vertex
    is compared with the vertices that aren't reached yet."""
    rest, edges = np.arange(n), []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            found = rest[hit]
            rest = rest[~hit]
            edges += [(i, int(j)) for j in found]
            queue += found.tolist()
    return edges


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for s, e in zip(starts, starts[1:]):
            key = tuple(c[s] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _edges_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return record_batch(_EDGE_SCHEMA, {"a": [e[0] for e in edges], "b": [e[1] for e in edges]})


def _signed(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    group = group.sort_by("doc_id")
    ids = group.column("doc_id").to_numpy()
    return ids, np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)


def _link_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of near signatures in each (key, chunk), as stars around their smallest ids: the buckets of a group of
    copies agree in most of their edges."""
    edges: list[tuple[int, int]] = []
    for group in _groups(batches, ["key", "chunk"]):
        ids, sig = _signed(group)
        least, first = NEAR * sig.shape[1], np.arange(len(ids))
        for i, j in _forest(len(ids), lambda i, rest: (sig[rest] == sig[i]).sum(1) >= least):
            first[j] = first[i]  # the forest's trees begin at their smallest ids
            edges.append((int(ids[first[j]]), int(ids[j])))
        if len(edges) > 20_000:
            yield _edges_batch(sorted(set(edges)))
            edges = []
    yield _edges_batch(sorted(set(edges)))


def _link_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between near signatures of different labels, probes against the rest, in each (key, chunk, part). A label
    that an edge reaches becomes the probe's, so two labels are joined once."""
    edges: list[tuple[int, int]] = []
    for group in _groups(batches, ["key", "chunk", "part"]):
        ids, sig = _signed(group)
        label = np.unique(group.column("label").to_numpy(), return_inverse=True)[1]
        probe = group.column("probe").to_numpy(zero_copy_only=False).astype(bool)
        least, others = NEAR * sig.shape[1], np.flatnonzero(~probe)
        for i in np.flatnonzero(probe):
            rest = others[label[others] != label[i]]
            hit = rest[(sig[rest] == sig[i]).sum(1) >= least]
            for at in np.unique(label[hit], return_index=True)[1]:
                j = hit[at]
                edges.append((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
            label[np.isin(label, label[hit])] = label[i]
        if len(edges) > 20_000:
            yield _edges_batch(sorted(set(edges)))
            edges = []
    yield _edges_batch(sorted(set(edges)))


def _grouped(rows: DataFrame, keys: list[str], link) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(link, "a long, b long").distinct()


def bucket_forest(reps: DataFrame) -> DataFrame:
    """Edges (a, b) between representatives whose signatures are near; in every bucket, near ones are connected."""
    exploded = reps.select("doc_id", F.explode("bands").alias("key"))
    shared = exploded.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    # powers of two, and one of two dealings by key: near copies meet in two companies, which joins the chunks of a group,
    # and bands whose buckets differ a little still agree in their edges
    chunks = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("c") / BUCKET_ROWS, F.lit(1.0))))).cast("long")
    members = exploded.join(shared, "key").select("key", "doc_id", chunks.alias("chunks"))
    members = materialize(members.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.pmod("key", F.lit(2))), F.col("chunks"))))
    sigs = reps.select("doc_id", "sig")
    first = materialize(_grouped(members.select("key", "chunk", "doc_id").join(sigs, "doc_id"), ["key", "chunk"], _link_chunks))
    wide = materialize(members.where("chunks > 1").distinct())
    if wide.isEmpty():
        return first
    joined = materialize(components(first).withColumnRenamed("id", "doc_id"))
    wide = materialize(wide.join(joined, "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component"))
    sizes = wide.groupBy("key", "label").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "label"))
    per = sizes.groupBy("key").agg(largest["label"].alias("top"), (F.sum("n") - largest["n"]).alias("others")).where("others > 0")
    rows = wide.join(per, "key").withColumn("parts", F.ceil(F.col("others") / BUCKET_ROWS).cast("long"))
    rows = materialize(rows.withColumn("part", F.pmod(F.xxhash64("key", "doc_id"), F.col("parts"))))

    def copies(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    rest = rows.select("key", "chunk", copies("parts").alias("part"), "doc_id", "label", F.lit(False).alias("probe"))
    probes = rows.where("label <> top").select("key", copies("chunks").alias("chunk"), "part", "doc_id", "label", F.lit(True).alias("probe"))
    more = _grouped(rest.union(probes).join(sigs, "doc_id"), ["key", "chunk", "part"], _link_parts)
    return joined.where("component <> doc_id").select(F.col("component").alias("a"), F.col("doc_id").alias("b")).union(more)


def _confirmed(n: np.ndarray, owner: np.ndarray, hashes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the exact links between the sets (owner[k] has hashes[k])."""
    order = np.argsort(hashes, kind="stable")
    sorted_hashes, posting = hashes[order], owner[order]
    fresh = np.concatenate([[True], sorted_hashes[1:] != sorted_hashes[:-1]]) if len(order) else np.empty(0, bool)
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(order)))
    term = np.empty(len(order), np.int64)
    term[order] = np.cumsum(fresh) - 1
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))])
    by_owner = np.argsort(owner, kind="stable")

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        terms = term[by_owner[first[i]:first[i + 1]]]
        terms = terms[sizes[terms] > 1]
        count = sizes[terms]
        at = np.repeat(starts[terms] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        common = np.bincount(posting[at], minlength=len(n))[rest]
        return 100 * common >= percent * (n[i] + n[rest] - common)

    return _forest(len(n), near)


def confirmed_links(docs: DataFrame, clusters: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (a, b) of exact links inside clusters (id, component, n), a spanning forest per group of chunks."""
    sizes = clusters.groupBy("component").agg(F.sum("n").alias("_total"))
    chunks = F.greatest(F.ceil(F.col("_total") / CHUNK_SHINGLES), F.lit(1)).cast("long")
    sizes = sizes.select("component", chunks.alias("chunks"))
    dealt = clusters.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    # texts move only if there are more candidates than can be sent to every executor
    rows = texts.join(broadcast_if_bounded(dealt.select("id", "component", "chunk", "chunks"), MAX_BROADCAST_ROWS), "id")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            column = batch.column("text")
            sets = [shingles(utf8_rows(column.slice(i, 1))[0], words, known).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "component", "chunk", "chunks")] + [pa.array(sets, pa.binary())],
                                             names=["id", "component", "chunk", "chunks", "hashes"])

    sets = rows.select("id", "component", "chunk", "chunks", "text").mapInArrow(to_sets, "id long, component long, chunk long, chunks long, hashes binary")
    # a single chunk is one group; of several, every pair of chunks is one
    other = F.when(F.col("chunks") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda j: j != F.col("chunk")))
    paired = sets.withColumn("_j", F.explode(other)).select(
        "component", F.least("chunk", "_j").alias("lo"), F.greatest("chunk", "_j").alias("hi"), "id", "hashes")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[int, int]] = []
        for group in _groups(batches, ["component", "lo", "hi"]):
            ids = group.column("id").to_numpy()
            sets = [np.frombuffer(h, np.uint64) for h in group.column("hashes").to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            owner = np.repeat(np.arange(len(sets)), n)
            edges += [(int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))) for i, j in _confirmed(n, owner, np.concatenate(sets), percent)]
            if len(edges) > 20_000:
                yield _edges_batch(sorted(set(edges)))
                edges = []
        yield _edges_batch(sorted(set(edges)))

    keys = ["component", "lo", "hi"]
    return paired.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest reachable id), kept."""
    signed = materialize(signatures(docs, words))
    full = signed.where("digest is not null")
    # equal sets: one representative; rows of one id that differ stay linked through the id
    reps = materialize(full.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"),
                                                  F.min(F.struct("sig", "bands")).alias("_s")).select("digest", "doc_id", "n", "_s.sig", "_s.bands"))
    near = components(bucket_forest(reps))
    clusters = near.join(reps.groupBy(F.col("doc_id").alias("id")).agg(F.sum("n").alias("n")), "id")
    confirmed = confirmed_links(docs, materialize(clusters), words, percent)
    copies = full.join(reps.select("digest", F.col("doc_id").alias("rep")), "digest").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    classes = components(materialize(confirmed.union(copies)))
    out = signed.select("doc_id", "n").join(classes, signed["doc_id"] == classes["id"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each class stays (the smallest id, then the smallest text), all columns kept. Rows that repeat an
    id are documents of their own, one per text (equal rows of one id and text stay once): unlike texts stay, linked ones
    don't. Rows with a null id stay."""
    names = docs.columns
    rows = docs.select(F.col("doc_id").cast("long").alias("_key"), F.struct(*[docs[c] for c in names]).alias("_doc"))
    repeated = materialize(rows.where("_key is not null").groupBy("_key").count().where("count > 1").select(F.col("_key").alias("_again")))
    if repeated.isEmpty():
        gone = near_duplicates(docs.select("doc_id", "text"), words, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
        rows = rows.join(gone, rows["_key"] == gone["_gone"], "left_anti")
        return rows.select(*[F.col("_doc").getField(c).alias(c) for c in names])
    # a vertex per id and text: the id, or for a repeated id a 64-bit hash as for shingles
    rows = rows.join(broadcast_if_bounded(repeated, MAX_BROADCAST_ROWS), rows["_key"] == repeated["_again"], "left")
    node = F.when(F.col("_again").isNotNull(), F.xxhash64("_key", "_doc.text", F.lit(SEED))).otherwise(F.col("_key"))
    rows = rows.select(node.alias("_node"), "_key", F.col("_again").isNotNull().alias("_many"), "_doc")
    found = materialize(near_duplicates(rows.select(F.col("_node").alias("doc_id"), F.col("_doc.text").alias("text")), words, percent)
                        .where("doc_id is not null").select(F.col("doc_id").alias("id"), "component_id").distinct())
    # classes of one vertex need no choice
    groups = found.groupBy("component_id").count().where("count > 1").select("component_id")
    members = found.join(groups, "component_id").join(rows.select(F.col("_node").alias("id"), "_key", F.when(F.col("_many"), F.col("_doc.text")).alias("text")), "id")
    first = members.groupBy("component_id").agg(F.min_by("id", F.struct("_key", "text", "id")).alias("_stays"))
    gone = members.join(first, "component_id").where("id <> _stays").select(F.col("id").alias("_gone")).distinct()
    rows = rows.join(materialize(gone), F.col("_node") == F.col("_gone"), "left_anti")
    once = rows.where("_many").groupBy("_node").agg(F.min_by("_doc", F.xxhash64(F.to_json("_doc"))).alias("_doc")).select("_doc")
    return once.union(rows.where("not _many").select("_doc")).select(*[F.col("_doc").getField(c).alias(c) for c in names])
