"""Grouping of spelling variants through Bloom-guided neighbourhoods.

Words are counted over the whole texts; the vocabulary is every word with enough letters and occurrences. Its words
go into blocked Bloom filters, one per word length (a block of 512 bits holds all bits of a word): tasks build
partial blocks, Spark's bit_or merges them. Every word then generates the words one edit away, deletions and
replacements by a later letter (the other direction of a link is the other word's own edit, an insertion is the
deletion seen from the longer word), and probes the filter of their length, which is broadcast. Only positives leave
the task; an exact join with the vocabulary removes the false ones. Edits are hashed without being spelled out: a
word's hash is a polynomial in its letters, so an edit changes one term or shifts a suffix.

A filter group that goes to the executors has at most GROUP_BYTES; a larger vocabulary is probed in rounds, one
group of blocks each, so what is broadcast doesn't grow with the data. A word has a bounded number of edits, hence
of neighbours, and rows per key stay few; chains of forms end quickly as counts grow ``ratio``-fold along them.

Edge cases: null and empty texts have no words; a null id counts as an empty string in the noise of
``noisy_words``; repeated rows count again; words of any length take part (lengths from LENGTHS on share a filter); ties between
forms go to the smaller word in code-point order; an empty table gives an empty result; only the id and the text
are read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm.common import record_batch
from propensity.session import materialize

# Letters of a word, after lower-casing A-Z.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"a-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO, NOISE = 6, 5, 5, 199

LENGTHS = 64  # word lengths with a filter of their own; longer words share the last one
BITS_PER_WORD, PROBES, BLOCK_BITS = 16, 6, 512
GROUP_BYTES = 32 << 20
CHUNK = 1 << 14  # letters whose edits are held at once

_TURN = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BACK = np.uint64(pow(int(_TURN), -1, 1 << 64))
_MASKS = [f"m{k}" for k in range(BLOCK_BITS // 64)]
_BLOCKS = "length int, block long, " + ", ".join(f"{m} long" for m in _MASKS)
_BLOCKS_SCHEMA = pa.schema([("length", pa.int32()), ("block", pa.int64()), *((m, pa.int64()) for m in _MASKS)])
_HITS = "word string, n long, other string"
_HITS_SCHEMA = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string())])


# ---------------------------------------------------------------- vocabulary

def noisy_words(docs: DataFrame, min_length: int = MIN_LENGTH, noise: int = NOISE) -> DataFrame:
    """(word) per occurrence: lower-cased runs of letters; where ``noise`` divides the checksum of id and run, a
    letter of the run is left out. Runs that are too short to give a word are dropped early."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("_run"))
    h = F.crc32(F.concat("_id", F.lit(":"), "_run"))
    at = (h % F.length("_run")).cast("int")
    left = F.concat(F.expr("left(_run, _at)"), F.expr("substring(_run, _at + 2)"))
    hashed = found.select("_run", h.alias("_h"), at.alias("_at"))
    return hashed.select(F.when(F.col("_h") % noise == 0, left).otherwise(F.col("_run")).alias("word")).where(F.length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- hashes and filters

class Letters:
    """Code points of many words one after the other, with polynomial hashes modulo 2^64."""

    def __init__(self, words: list[str]):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]) if len(words) else np.empty(0, np.int64)
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        longest = int(self.lengths.max(initial=0))
        self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(longest, _TURN, np.uint64))])
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(self.codes)) - self.starts[self.word]
        self.terms = self.codes * self.powers[self.place]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.terms)])
        self.hashes = sums[self.starts + self.lengths] - sums[self.starts]
        self.before = sums[:-1] - sums[self.starts][self.word]  # of the letters before each place


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def block_of(h: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.asarray(blocks, np.uint64)) >> np.uint64(32)).astype(np.int64)


def bits_of(h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word of the block, bit of that word) for every probe."""
    again = mixed(h + _TURN)
    for k in range(PROBES):
        bit = (again >> np.uint64(9 * k)) & np.uint64(BLOCK_BITS - 1)
        yield (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


def filter_of(length: np.ndarray) -> np.ndarray:
    return np.minimum(length, LENGTHS)


def filter_sizes(vocab: DataFrame) -> dict[int, int]:
    """Blocks of every length's filter; at most LENGTHS entries."""
    length = F.least(F.length("word"), F.lit(LENGTHS)).alias("length")
    return {r["length"]: max(1, -(-r["n"] * BITS_PER_WORD // BLOCK_BITS)) for r in vocab.groupBy(length).agg(F.count(F.lit(1)).alias("n")).collect()}


def build_filters(vocab: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(length, block, m0..m7): the blocks of all filters."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = Letters(batch.column("word").to_pylist())
            h, length = mixed(letters.hashes), filter_of(letters.lengths)
            count = np.zeros(LENGTHS + 1, np.uint64)
            for at, n in sizes.items():
                count[at] = n
            block = block_of(h, count[length])
            places, which = np.unique(np.stack([length, block]), axis=1, return_inverse=True)
            masks = np.zeros((places.shape[1], len(_MASKS)), np.uint64)
            for cell, bit in bits_of(h):
                np.bitwise_or.at(masks, (which.reshape(-1), cell), bit)
            yield record_batch(_BLOCKS_SCHEMA, {"length": places[0].astype(np.int32), "block": places[1]} | {m: masks[:, k].view(np.int64) for k, m in enumerate(_MASKS)})

    parts = vocab.select("word").mapInArrow(build, _BLOCKS)
    return parts.groupBy("length", "block").agg(*[F.bit_or(m).alias(m) for m in _MASKS])


def groups(sizes: dict[int, int], group_bytes: int = GROUP_BYTES) -> list[dict[int, tuple[int, int]]]:
    """Ranges of blocks per length, at most ``group_bytes`` together."""
    room = max(1, group_bytes * 8 // BLOCK_BITS)
    out, now, used = [], {}, 0
    for length in sorted(sizes):
        at = 0
        while at < sizes[length]:
            take = min(room - used, sizes[length] - at)
            now[length] = (at, at + take)
            at, used = at + take, used + take
            if used == room:
                out.append(now)
                now, used = {}, 0
    return out + [now] if now else out


def collect_group(filters: DataFrame, group: dict[int, tuple[int, int]]) -> dict[int, tuple[int, np.ndarray]]:
    """Filter blocks of one group: length → (first block, masks). Its size is the group's bound."""
    out = {length: (a, np.zeros((b - a, len(_MASKS)), np.uint64)) for length, (a, b) in group.items()}
    wanted = F.lit(False)
    for length, (a, b) in group.items():
        wanted = wanted | ((F.col("length") == length) & (F.col("block") >= a) & (F.col("block") < b))
    packed = F.concat(*[F.to_binary(F.lpad(F.hex(m), 16, "0"), F.lit("hex")) for m in _MASKS])
    for batch in filters.where(wanted).select("length", "block", packed.alias("masks")).toArrow().to_batches():
        length, block = batch.column("length").to_numpy(), batch.column("block").to_numpy()
        masks = np.frombuffer(b"".join(batch.column("masks").to_pylist()), ">u8").reshape(-1, len(_MASKS))
        for at, (a, place) in out.items():
            own = length == at
            place[block[own] - a] = masks[own]
    return out


# ---------------------------------------------------------------- probing

class Probe:
    """Looks edits up in one group of filters."""

    def __init__(self, sizes: dict[int, int], filters: dict[int, tuple[int, np.ndarray]]):
        rows, first = [], 0
        self.total = np.zeros(LENGTHS + 1, np.uint64)  # blocks of the whole filter of a length
        self.low, self.high, self.shift = (np.zeros(LENGTHS + 1, np.int64) for _ in range(3))
        for length, n in sizes.items():
            self.total[length] = n
        for length, (a, masks) in sorted(filters.items()):
            self.low[length], self.high[length], self.shift[length] = a, a + len(masks), first - a
            rows.append(masks)
            first += len(masks)
        self.masks = np.concatenate(rows).reshape(-1)

    def __call__(self, raw: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Positions of the edits that may be words; ``length`` is the edits' length."""
        at = filter_of(length)
        h = mixed(raw)
        block = block_of(h, self.total[at])
        live = np.flatnonzero((block >= self.low[at]) & (block < self.high[at]))
        base = (block[live] + self.shift[at[live]]) * len(_MASKS)
        again = mixed(h[live] + _TURN)
        for k in range(PROBES):
            bit = (again >> np.uint64(9 * k)) & np.uint64(BLOCK_BITS - 1)
            hit = (self.masks[base + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
            live, base, again = live[hit], base[hit], again[hit]
        return live


ALPHABET = np.array([*map(ord, LOWER), *range(0xC0, 0x100)], np.uint64)


def probable_neighbours(words: list[str], probe: Probe) -> Iterator[tuple[int, str]]:
    """(position of the word, edit): edits that the filters don't rule out, each once per word."""
    letters = Letters(words)
    n = len(letters.codes)
    for a in range(0, n, CHUNK):
        part = slice(a, min(n, a + CHUNK))
        word, place, code = letters.word[part], letters.place[part], letters.codes[part]
        length, whole, power = letters.lengths[word], letters.hashes[word], letters.powers[letters.place[part]]
        # a deletion moves the letters after it one place down; of a run of equal letters the first one goes
        before = letters.before[part]
        gone = before + (whole - before - letters.terms[part]) * _BACK
        run = np.zeros(len(code), bool)
        run[1:] = (code[1:] == code[:-1]) & (place[1:] > 0)
        if a and place[0] > 0:
            run[0] = code[0] == letters.codes[a - 1]
        for k in probe(gone, length - 1):
            if not run[k]:
                w, i = words[word[k]], int(place[k])
                yield int(word[k]), w[:i] + w[i + 1:]
        for letter in ALPHABET:
            later = np.flatnonzero(letter > code)
            if len(later):
                changed = whole[later] + (letter - code[later]) * power[later]
                for k in later[probe(changed, length[later])]:
                    w, i = words[word[k]], int(place[k])
                    yield int(word[k]), w[:i] + chr(int(letter)) + w[i + 1:]


def probable_links(spark: SparkSession, vocab: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame | None:
    """(word, n, other): edits that are words or false positives; None without words."""
    sizes = filter_sizes(vocab)
    filters = materialize(build_filters(vocab, sizes))
    out = None
    for group in groups(sizes, group_bytes):
        sent = spark.sparkContext.broadcast((sizes, collect_group(filters, group)))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            probe = Probe(*sent.value)
            for batch in batches:
                words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
                at, others = [], []
                for k, other in probable_neighbours(words, probe):
                    at.append(k)
                    others.append(other)
                    if len(at) >= 1 << 15:
                        yield record_batch(_HITS_SCHEMA, {"word": [words[k] for k in at], "n": n[at], "other": others})
                        at, others = [], []
                if at:
                    yield record_batch(_HITS_SCHEMA, {"word": [words[k] for k in at], "n": n[at], "other": others})

        # dealt anew, as a small file of words is a lot of work
        part = materialize(vocab.repartition(F.xxhash64("word")).mapInArrow(search, _HITS))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- groups

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by doubling steps until no chain goes on."""
    now = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("_w"), F.col("root").alias("_next"))
        joined = now.join(step, F.col("root") == F.col("_w"), "left")
        now = materialize(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if now.where("_moved").limit(1).count() == 0:
            return now.drop("_moved")
        now = now.drop("_moved")


def group_variants(vocab: DataFrame, ratio: int = RATIO, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n for a vocabulary (word, n) of distinct words."""
    spark = vocab.sparkSession
    vocab = materialize(vocab.select("word", "n"))
    hits = probable_links(spark, vocab, group_bytes)
    if hits is None:
        return spark.createDataFrame([], "word string, form string, root string, n long, n_near long, form_n long")
    real = hits.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    ends: Column = F.array(F.struct(F.col("word"), F.col("n"), F.col("other"), F.col("other_n")),
                           F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    links = real.select(F.inline(ends))
    best = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("k"), F.col("other").alias("w"))).alias("b"), F.first("n").alias("n"))
    strong = -F.col("b.k") >= F.lit(ratio) * F.col("n")
    near = materialize(best.select("word", "n_near", F.when(strong, F.col("b.w")).alias("form"), F.when(strong, -F.col("b.k")).alias("form_n")))
    ends_of = roots(near.where(F.col("form").isNotNull()))
    out = vocab.join(near, "word", "left").join(ends_of, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Variants among the words of ``docs`` (doc_id, text)."""
    return group_variants(vocabulary(noisy_words(docs)))


SQL = """
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]{6,}')) AS run FROM documents),
once AS (SELECT id, run, count(*) AS k FROM runs GROUP BY ALL),
bytes AS (SELECT run, k, flatten(list_transform(string_split(id || ':' || run, ''),
           lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 | (unicode(x)::BIGINT >> 6), 128 | (unicode(x)::BIGINT & 63)] END)) AS b FROM once),
hashed AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) AS h FROM bytes, crc),
noisy AS (SELECT k, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substring(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM hashed),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM noisy WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
same AS (SELECT word, n, i, left(word, i - 1) || '*' || substring(word, i + 1) AS p FROM cut),
less AS (SELECT DISTINCT word, n, left(word, i - 1) || substring(word, i + 1) AS p FROM cut),
longer AS (SELECT less.word AS a, less.n AS an, v.word AS b, v.n AS bn FROM less JOIN v ON v.word = less.p),
link AS (SELECT a, an, b, bn FROM longer UNION ALL SELECT b, bn, a, an FROM longer
         UNION ALL SELECT x.word, x.n, y.word, y.n FROM same x JOIN same y ON x.p = y.p AND x.word <> y.word),
best AS (SELECT a AS word, any_value(an) AS n, count(*) AS n_near, max(bn) AS top FROM link GROUP BY a),
form AS (SELECT best.word, min(link.b) AS form, any_value(top) AS form_n FROM best JOIN link ON link.a = best.word AND link.bn = best.top WHERE top >= 5 * best.n GROUP BY best.word),
chain AS (SELECT word, form AS root, 1 AS d FROM form UNION ALL SELECT chain.word, form.form, d + 1 FROM chain JOIN form ON form.word = chain.root),
root AS (SELECT word, arg_max(root, d) AS root FROM chain GROUP BY word)
SELECT v.word, form.form, coalesce(root.root, v.word) AS root, v.n, coalesce(best.n_near, 0) AS n_near, form.form_n
FROM v LEFT JOIN best USING (word) LEFT JOIN form USING (word) LEFT JOIN root USING (word)
"""
