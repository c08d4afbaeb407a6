"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets: sources in code-point order (null last) weigh 3, 1, 2, 3, 1, 2, …; together they take ``share`` of
all words; a target stops at ``cap`` times its source's size and the excess is shared again by weight.

Apportionment: the mix consists of blocks of ``block`` words; a source whose target or size is under
``1000 * block`` words has smaller blocks, down to one word, so that a short last block stays within 0.2 % of its
target. The block count is dealt to the sources by the highest quotients ``target / block / (2k + 1)``, and each
source's quota is dealt to its shards in the same way by
shard size. A shard is a hash range of the source's documents, so a source with a third of all rows is many
shards. Inside a shard the documents lie end to end in seeded order and are cut into blocks; a quota of ``q``
over ``nb`` blocks takes every block ``q div nb`` times and the ``q mod nb`` blocks that a seeded permutation
puts first once more. The permutation is arithmetic, so no block is ever a row.

Edge cases: null and empty texts have size 0 and take nothing; a null source is a source of its own, last in
order; null and repeated ids are kept, each row counts by itself; rows of one id and size are told apart by their
text and then by all other columns when texts are cut, so that reruns agree (rows equal throughout are
interchangeable); an empty table gives an empty result; other columns may have any name.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import WORD_PATTERN
from propensity.session import materialize

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
BLOCK_WORDS = 16
BLOCKS_LEAST = 1000  # a source's size and target are at least this many of its blocks, as far as one word allows
SHARD_WORDS, MAX_SHARDS = 1_000_000, 4096
SEED = 17
#: Multipliers of the block permutation: primes, so the first that doesn't divide the block count is coprime to it.
PRIMES = (1_000_003, 1_000_033, 1_000_037)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target), one row per source.

    The level ``w * lam`` rises as capped sources give their excess back; each round is one aggregate over the
    table of sources, and only three numbers reach the driver."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    src = materialize(src.withColumn("weight", weight))
    total, wsum = src.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * float(total or 0)
    lam, capped = (total / wsum if wsum else 0.0), -1
    while True:
        over = F.col("weight") * F.lit(lam) > cap * F.col("source_size")
        n, given, left = src.agg(
            F.sum(over.cast("int")), F.sum(F.when(over, cap * F.col("source_size"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if not n or n == capped or not left:
            break
        capped, lam = n, max(total - float(given), 0.0) / left
    target = F.least(F.col("weight") * F.lit(lam), cap * F.col("source_size")).cast("double")
    return src.withColumn("target", target)


def _extra_seats(base: DataFrame, group: list[str], key: str, votes: Column, diff: Column, span: Column) -> DataFrame:
    """Correction of rounded seats to the exact house: the ``diff`` highest quotients not yet seated get a seat,
    or the ``-diff`` lowest seated ones lose theirs."""
    steps = base.withColumns({"_v": votes, "_d": diff, "_s": span}).where("_d <> 0")
    steps = steps.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_s").cast("int"))))
    seat = F.when(F.col("_d") > 0, F.col("seats") + F.col("_j")).otherwise(F.col("seats") - 1 - F.col("_j"))
    steps = steps.withColumn("_seat", seat).where("_seat >= 0").withColumn("_q", F.col("_v") / (2 * F.col("_seat") + 1))
    part = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    order = part.orderBy(F.when(F.col("_d") > 0, -F.col("_q")).otherwise(F.col("_q")), F.col(key).asc_nulls_last(), "_seat")
    picked = steps.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= F.abs("_d"))
    return picked.groupBy(*group, key).agg(F.sum(F.signum("_d").cast("long")).alias("_extra"))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def block_size(block: int = BLOCK_WORDS, least: int = BLOCKS_LEAST) -> Column:
    """Words in a block of a source: ``block``, or fewer where its size or target is under ``least`` such blocks."""
    fits = F.floor(F.least(F.col("source_size").cast("double"), F.col("target")) / F.lit(float(least)))
    return F.greatest(F.lit(1), F.least(F.lit(block), fits)).cast("long")


def source_quotas(targets: DataFrame, block: int = BLOCK_WORDS, least: int = 1) -> DataFrame:
    """(source, source_size, target, block, quota): highest quotients ``target / block / (2k + 1)`` for
    ``round(sum of target / block)`` seats."""
    votes = F.col("target") / F.col("block")
    first = targets.withColumn("block", block_size(block, least))
    first = materialize(first.withColumn("seats", F.floor(votes + 0.5).cast("long")))
    n, seated, house = first.agg(F.count("*"), F.sum("seats"), F.floor(F.sum(votes) + 0.5)).first()
    if not n:
        return first.withColumnRenamed("seats", "quota")
    diff, houses = int(house) - int(seated), max(int(house), 1)
    # the divisor moves by at most n / 2 seats in `house`, so a source's seats move by at most this many
    span = F.ceil(F.col("seats") * F.lit(float(n) / houses)) + 1
    extra = _extra_seats(first, [], "source", votes, F.lit(diff), span)
    return _null_safe(first, extra, ["source"]).select(
        "source", "source_size", "target", "block", (F.col("seats") + F.coalesce("_extra", F.lit(0))).alias("quota"))


def shard_quotas(shards: DataFrame) -> DataFrame:
    """Deal each source's quota to its shards (source, shard, shard_size, source_size, quota) by shard size."""
    ideal = F.when(F.col("source_size") > 0, F.col("quota") * F.col("shard_size") / F.col("source_size")).otherwise(0.0)
    first = shards.withColumn("seats", F.floor(ideal + 0.5).cast("long"))
    per = first.groupBy("source").agg(F.sum("seats").alias("_seated"), F.count("*").alias("_n"))
    first = materialize(_null_safe(first, per, ["source"]))
    span = F.ceil(F.col("seats") * F.col("_n") / F.greatest(F.col("quota"), F.lit(1))) + 1
    extra = _extra_seats(first, ["source"], "shard", F.col("shard_size"), F.col("quota") - F.col("_seated"), span)
    return _null_safe(first, extra, ["source", "shard"]).select(
        "source", "shard", "shard_size", (F.col("seats") + F.coalesce("_extra", F.lit(0))).alias("seats"))


def _mod_mul(a: Column, b: Column, m: Column) -> Column:
    return (a * b) % m


def times_of_block(b: Column, quota: Column, blocks: Column, shift: Column) -> Column:
    """How often block ``b`` of a shard is taken: ``quota div blocks`` times, once more if its place in the seeded
    permutation ``(prime * b + shift) mod blocks`` is under ``quota mod blocks``."""
    step = F.lit(PRIMES[-1]).cast("long")
    for p in reversed(PRIMES[:-1]):
        step = F.when(blocks % p != 0, F.lit(p).cast("long")).otherwise(step)
    place = (_mod_mul(step % blocks, b, blocks) + shift) % blocks
    return F.least(F.floor(quota / blocks) + F.when(place < quota % blocks, 1).otherwise(0), F.lit(2))


def plan_mix(docs: DataFrame, share: float = SHARE, cap: float = CAP, weights=WEIGHTS, block: int = BLOCK_WORDS,
             shard_words: int = SHARD_WORDS, max_shards: int = MAX_SHARDS, seed: int = SEED,
             row_key: str | None = None, tie: str | None = None, blocks_least: int = BLOCKS_LEAST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and ``_at`` (first word's place in its
    shard), ``_block``, ``_quota``, ``_blocks``, ``_shift`` for cutting texts. ``row_key`` names a column to carry
    along, ``tie`` one that orders rows of equal id and size."""
    cols = [F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size")]
    if row_key:
        cols.append(F.col(row_key).alias("_row"))
    if tie:
        cols.append(F.col(tie).alias("_tie"))
    sizes = materialize(docs.select(*cols))
    quotas = source_quotas(source_targets(sizes, share, cap, weights), block, blocks_least)
    quotas = quotas.withColumnRenamed("block", "_block")
    count = F.least(F.ceil(F.col("source_size") / shard_words), F.lit(max_shards))
    quotas = materialize(quotas.withColumn("_shards", F.greatest(count, F.lit(1)).cast("long")))
    key = F.xxhash64(F.col("doc_id"), F.col("size"), F.lit(seed))  # the size spreads null ids
    placed = _null_safe(sizes, quotas, ["source"]).withColumn("_key", key)
    placed = placed.withColumn("shard", F.pmod(F.xxhash64(F.col("_key"), F.lit(seed + 1)), F.col("_shards")))
    shards = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"), F.first("quota").alias("quota"))
    seats = materialize(shard_quotas(materialize(shards)))
    placed = _null_safe(placed, seats, ["source", "shard"])
    order = Window.partitionBy("source", "shard").orderBy("_key", "doc_id", "size", *["_tie"] * bool(tie))
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = F.greatest(F.ceil(F.col("shard_size") / F.col("_block")), F.lit(1)).cast("long")
    shift = F.pmod(F.xxhash64(F.lit(seed), F.col("source"), F.col("shard")), F.col("_blocks"))
    placed = placed.withColumn("_at", before).withColumn("_blocks", blocks).withColumn("_shift", shift)
    placed = placed.withColumn("_quota", F.least(F.col("seats"), 2 * F.col("_blocks")))
    start, end, width = F.col("_at"), F.col("_at") + F.col("size"), F.col("_block")
    block_ids = F.sequence(F.floor(start / width), F.floor((end - 1) / width))

    def add(acc: Column, b: Column) -> Column:
        words = F.least(end, (b + 1) * width) - F.greatest(start, b * width)
        return acc + words * times_of_block(b, F.col("_quota"), F.col("_blocks"), F.col("_shift"))

    taken = F.when(F.col("size") > 0, F.aggregate(block_ids, F.lit(0).cast("long"), add)).otherwise(F.lit(0))
    return placed.withColumn("taken", taken.cast("long"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """Words that the mix takes of every document: doc_id, size, source_size, target, taken."""
    return plan_mix(docs, **options).select(
        "doc_id", "size", F.col("source_size").cast("long"), F.col("target").cast("double"), "taken")


def apply_mix(docs: DataFrame, block: int = BLOCK_WORDS, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: every document once per time its words are taken.

    A copy of which all blocks are taken keeps its text; of the others, the taken words are joined by single
    spaces. ``n_chars`` follows the text where the table has it."""
    names = docs.columns
    held = docs.select(F.monotonically_increasing_id().alias("_mix_row"), F.struct(*[docs[c] for c in names]).alias("_doc"))
    held = materialize(held)
    rest = F.to_json(F.struct(*[F.col("_doc").getField(c).alias(f"c{i}") for i, c in enumerate(names) if c != "text"]))
    tie = F.struct(F.xxhash64(F.col("_doc.text")), F.xxhash64(rest))
    plan = plan_mix(held.select(F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.source").alias("source"),
                                F.col("_doc.text").alias("text"), "_mix_row", tie.alias("_mix_tie")),
                    block=block, row_key="_mix_row", tie="_mix_tie", **options)
    plan = plan.where("taken > 0").select(F.col("_row").alias("_mix_row"), "size", "taken", "_at", "_block", "_quota",
                                          "_blocks", "_shift")
    rows = held.join(plan, "_mix_row")
    rows = rows.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.least(F.lit(1), F.col("taken") - 1).cast("int"))))
    words = F.regexp_extract_all(F.col("_doc.text"), F.lit(f"({WORD_PATTERN})"), F.lit(1))

    def wanted(_: Column, i: Column) -> Column:
        b = F.floor((F.col("_at") + i) / F.col("_block"))
        return times_of_block(b, F.col("_quota"), F.col("_blocks"), F.col("_shift")) > F.col("_pass")

    least_times = F.floor(F.col("_quota") / F.col("_blocks"))
    whole = (F.col("_pass") < least_times) | (F.col("taken") == F.col("size") * (F.col("_pass") + 1))
    text = F.when(whole, F.col("_doc.text")).otherwise(F.array_join(F.filter(words, wanted), " "))
    rows = rows.withColumn("_text", text).where(F.length("_text") > 0)
    out = []
    for c in names:
        field = F.col("_doc").getField(c)
        if c == "text":
            field = F.col("_text")
        elif c == "n_chars":
            field = F.length("_text").cast(docs.schema[c].dataType)
        out.append(field.alias(c))
    return rows.select(*out)
