"""Nearest-neighbour mutual information between numeric columns and a class.

For a value ``v`` of class ``c`` (``N_c`` rows, at least two) let ``r`` be the distance to its ``min(k, N_c - 1)``-th nearest
row of the same class, and ``m`` the number of rows of any class strictly inside ``(v - r, v + r)``, itself included; for
``r = 0`` the rows of equal value. The estimate is ``psi(n) + mean(psi(min(k, N_c - 1)) - psi(N_c) - psi(m))``, not below 0.
No noise is added, so equal rows are neighbours at distance 0 and the result is the same in every run.

Plan: rows collapse to (column, value, class) counts, and the counts of a range of values to one sorted block. In one
dimension the neighbours of a value are the ``k`` distinct values before and after it, so a block finds them by itself
once it has the ``k`` values of each class on either side of it. Those are found among the first and last ``k`` values
of all blocks, a table bounded by the number of blocks. An interval that stays inside its block is counted there. At
most ``k`` values of a class leave their block on each side; the ends of theirs are ranked by the blocks they fall
into, and totals of the blocks before are added.

NULL and NaN values, and rows without class, take no part; classes of one row are left out; a column without any
remaining row has estimate 0.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from propensity.functions.quantiles import number
from propensity.functions.sizing import broadcast_if_bounded
from propensity.session import materialize

NEIGHBOURS = 3
EDGES, BLOCK_ROWS = 128, 250_000  # approximate quantile edges a column, at least; rows of a block or so
SMALL_ROWS = 100_000


def digamma(x: Column) -> Column:
    """psi of a whole number of at least 1: recurrence up six steps, then the asymptotic series (error below 1e-9)."""
    y = x.cast("double") + 6.0
    series = F.log(y) - 1.0 / (2.0 * y) - 1.0 / (12.0 * y * y) + 1.0 / (120.0 * F.pow(y, 4)) - 1.0 / (252.0 * F.pow(y, 6))
    for i in range(6):
        series = series - 1.0 / (x.cast("double") + float(i))
    return series


def _splits(df: DataFrame, cols: Sequence[str], edges: int, steps: int) -> dict[str, list[float]]:
    """Ascending borders of each column's blocks: approximate quantiles, equal steps between two of them."""
    probs = [i / edges for i in range(1, edges)]
    found = df.agg(*[F.percentile_approx(number(c), probs, 2 * edges).alias(c) for c in cols]).first()
    out = {}
    for c in cols:
        own = sorted({float(v) for v in (found[c] or []) if math.isfinite(v)}) or [0.0]
        own += [a + (b - a) * i / steps for a, b in zip(own, own[1:]) for i in range(1, steps)]
        out[c] = sorted({v for v in own if math.isfinite(v)})
    return out


def _counts(rows: DataFrame, cols: Sequence[str], splits: dict[str, list[float]]) -> DataFrame:
    """(column, block, value, class, cnt): rows per column, value and class."""
    wide = rows.select("__class", *[number(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    inputs, outputs = [f"_v{i}" for i in range(len(cols))], [f"_b{i}" for i in range(len(cols))]
    wide = Bucketizer(splitsArray=[[-math.inf, *splits[c], math.inf] for c in cols], inputCols=inputs, outputCols=outputs,
                      handleInvalid="keep").transform(wide)
    items = F.array(*[F.struct(F.lit(i).alias("column"), F.col(b).cast("int").alias("block"), F.col(v).alias("value"),
                               F.col("__class").alias("class")) for i, (v, b) in enumerate(zip(inputs, outputs))])
    long = wide.select(F.inline(items)).filter(F.col("value").isNotNull())
    return long.groupBy("column", "block", "value", "class").agg(F.count(F.lit(1)).alias("cnt"))


def _blocks(counts: DataFrame) -> DataFrame:
    """One row per (column, block) with its counts as lists in order of the values."""
    names = ("value", "class", "cnt", "n_class")
    kind = dict(counts.dtypes)
    schema = "column int, block int, total long, " + ", ".join(f"{n} array<{kind[n]}>" for n in names)
    out = to_arrow_schema(counts.sparkSession.createDataFrame([], schema).schema)

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("value", "ascending"), ("class", "ascending")]).combine_chunks()
        ends = pa.array([0, group.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, group[n].combine_chunks() if isinstance(group[n], pa.ChunkedArray) else group[n]) for n in names]
        first = [group["column"].slice(0, 1).to_pylist(), group["block"].slice(0, 1).to_pylist(), [int(np.sum(group["cnt"].to_numpy()))]]
        arrays = [pa.array(v, f.type) for v, f in zip(first, out)] + [a.cast(f.type) for a, f in zip(lists, list(out)[3:])]
        return pa.Table.from_arrays(arrays, names=out.names)

    return counts.groupBy("column", "block").applyInArrow(pack, schema)


def _halo(blocks: DataFrame, k: int) -> DataFrame:
    """(column, block, before, after): the ``k`` values of each class of the block on either side of it."""
    kind = dict(blocks.dtypes)
    schema = f"column int, block int, class {kind['class'][6:-1]}, at int, last boolean, value double, cnt long"
    out = to_arrow_schema(blocks.sparkSession.createDataFrame([], schema).schema)

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                value, cnt, codes, names = _block_of(batch, i)
                for code, own in _by_class(codes, len(names)):
                    at = np.unique(np.concatenate([np.arange(min(k, len(own))), np.arange(max(0, len(own) - k), len(own))]))
                    m, rows = len(at), own[at]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch["column"][i].as_py()] * m, out.field("column").type), pa.array([batch["block"][i].as_py()] * m, out.field("block").type),
                        names.take(pa.array([code] * m)).cast(out.field("class").type), pa.array(at, out.field("at").type),
                        pa.array(at == len(own) - 1), pa.array(value[rows]), pa.array(cnt[rows], pa.int64())], schema=out)

    found = blocks.select("column", "block", "value", "class", "cnt").mapInArrow(border, schema)
    across = Window.partitionBy("column", "class").orderBy("value")
    pair = F.struct("value", "class", "cnt")
    near = found.select("column", "block", "at", "last", F.collect_list(pair).over(across.rowsBetween(-k, -1)).alias("before"),
                        F.collect_list(pair).over(across.rowsBetween(1, k)).alias("after"))
    return near.groupBy("column", "block").agg(F.flatten(F.collect_list(F.when(F.col("at") == 0, F.col("before")))).alias("before"),
                                               F.flatten(F.collect_list(F.when(F.col("last"), F.col("after")))).alias("after"))


def _block_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(values, counts, class codes, classes by code) of a block."""
    value, cnt = batch["value"][i].values.to_numpy(), batch["cnt"][i].values.to_numpy()
    coded = batch["class"][i].values.dictionary_encode()
    return value, cnt, coded.indices.to_numpy(), coded.dictionary


def _by_class(codes: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(code, places of its values in order) of every class."""
    order = np.argsort(codes, kind="stable")
    yield from enumerate(np.split(order, np.cumsum(np.bincount(codes, minlength=n))[:-1]))


def _radii(value: np.ndarray, cnt: np.ndarray, need: np.ndarray, before: list, after: list, k: int) -> np.ndarray:
    """Distance of each of a class's ascending values to its ``need``-th nearest other row; ``before`` and ``after`` are
    (value, cnt) pairs beyond the two ends."""
    low, high = np.array(before, float).reshape(-1, 2), np.array(after, float).reshape(-1, 2)
    pad = k - len(low), k - len(high)  # fewer rows exist on that side
    v = np.concatenate([np.full(pad[0], -np.inf), low[:, 0], value, high[:, 0], np.full(pad[1], np.inf)])
    c = np.concatenate([np.zeros(pad[0], np.int64), low[:, 1].astype(np.int64), cnt, high[:, 1].astype(np.int64), np.zeros(pad[1], np.int64)])
    left = need - cnt + 1
    out = np.zeros(len(value))
    ask = np.flatnonzero(left > 0)
    beside = np.concatenate([np.arange(-k, 0), np.arange(1, k + 1)])
    for at in range(0, len(ask), 1 << 16):
        some = ask[at:at + (1 << 16)]
        places = some[:, None] + k + beside
        with np.errstate(invalid="ignore"):
            d = np.abs(v[places] - value[some][:, None])
        order = np.argsort(d, axis=1, kind="stable")
        reached = np.cumsum(np.take_along_axis(c[places], order, 1), axis=1) >= left[some][:, None]
        nearest = np.take_along_axis(order, np.argmax(reached, axis=1)[:, None], 1)
        out[some] = np.take_along_axis(d, nearest, 1)[:, 0]
    return out


def _ends(value, r):
    """The interval's two ends and whether rows equal to the end count as below it."""
    zero = r == 0
    return (np.where(zero, value, value - r), ~zero), (np.where(zero, value, value + r), zero)


def _below(value: np.ndarray, sums: np.ndarray, x: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Rows of a block below each ``x``, those equal to it included where asked."""
    return sums[np.where(equal, np.searchsorted(value, x, "right"), np.searchsorted(value, x, "left"))]


def _near(blocks: DataFrame, splits: list[list[float]], k: int) -> DataFrame:
    """Every count with its radius, and ``m`` where the interval stays in the block."""
    kind = dict(blocks.dtypes)["class"][6:-1]
    schema = f"column int, block int, class {kind}, value double, cnt long, n_class long, r double, m long"
    out = to_arrow_schema(blocks.sparkSession.createDataFrame([], schema).schema)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                value, cnt, codes, names = _block_of(batch, i)
                n_class = batch["n_class"][i].values.to_numpy()
                sides = [{}, {}]
                for side, column in zip(sides, ("before", "after")):
                    for row in batch[column][i].as_py() or []:
                        side.setdefault(row["class"], []).append((row["value"], row["cnt"]))
                r = np.zeros(len(value))
                for code, own in _by_class(codes, len(names)):
                    before, after = (side.get(names[code].as_py(), []) for side in sides)
                    r[own] = _radii(value[own], cnt[own], np.minimum(k, n_class[own] - 1), before, after, k)
                column, block = batch["column"][i].as_py(), batch["block"][i].as_py()
                borders = [-math.inf, *splits[column], math.inf]
                sums = np.concatenate([[0], np.cumsum(cnt)])
                (low, low_equal), (high, high_equal) = _ends(value, r)
                m = _below(value, sums, high, high_equal) - _below(value, sums, low, low_equal)
                last = block == len(borders) - 2
                inside = (low >= borders[block]) & ((high < borders[block + 1]) | last)
                same = [pa.array(np.full(len(value), x, np.int32)) for x in (column, block)]
                whole = pa.RecordBatch.from_arrays([
                    *same, batch["class"][i].values.cast(out.field("class").type), pa.array(value), pa.array(cnt), pa.array(n_class), pa.array(r),
                    pa.array(m, pa.int64(), mask=~inside)], schema=out)
                for at in range(0, whole.num_rows, 1 << 16):
                    yield whole.slice(at, 1 << 16)

    return blocks.drop("total").mapInArrow(near, schema)


def _ranks(blocks: DataFrame, probes: DataFrame) -> DataFrame:
    """(column, x, equal, below): rows of the column below each probe (column, block, x, equal)."""
    schema = "column int, block int, x double, equal boolean, below long"
    out = to_arrow_schema(blocks.sparkSession.createDataFrame([], schema).schema)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                value, cnt = batch["value"][i].values.to_numpy(), batch["cnt"][i].values.to_numpy()
                asked = batch["probes"][i].as_py()
                x, equal = np.array([p["x"] for p in asked], float), np.array([p["equal"] for p in asked], bool)
                found = _below(value, np.concatenate([[0], np.cumsum(cnt)]), x, equal)
                same = [pa.array(np.full(len(x), batch[n][i].as_py(), np.int32)) for n in ("column", "block")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(x), pa.array(equal), pa.array(found, pa.int64())], schema=out)

    key = ["column", "block"]
    probes = probes.distinct()
    lists = probes.groupBy(*key).agg(F.collect_list(F.struct("x", "equal")).alias("probes"))
    local = blocks.select(*key, "value", "cnt").join(lists, key).mapInArrow(rank, schema)
    # a probe's block may hold no rows: totals run over the blocks that rows or probes have
    before = Window.partitionBy("column").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.select(*key, "total").unionByName(probes.select(*key, F.lit(0).cast("long").alias("total")).distinct())
    offsets = totals.groupBy(*key).agg(F.sum("total").alias("total")).select(*key, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("_before"))
    found = probes.join(offsets, key).join(local, [*key, "x", "equal"], "left")
    return found.select("column", "x", "equal", (F.coalesce("below", F.lit(0)) + F.col("_before")).alias("below"))


def neighbour_cells(df: DataFrame, cols: Sequence[str], target: str = "target", k: int = NEIGHBOURS,
                    edges: int | None = None, steps: int = 1) -> DataFrame:
    """One row per (feature, value, class): ``cnt`` rows, class size ``n_class``, ``need`` = min(k, n_class - 1), radius
    ``r`` and ``m``, the rows of any class inside it."""
    cols = list(cols)
    rows = df.filter(F.col(target).isNotNull()).select(F.col(target).alias("__class"), *cols)
    splits = _splits(rows, cols, edges or max(EDGES, rows.count() // BLOCK_ROWS), steps)
    counts = materialize(_counts(rows, cols, splits))
    classes = counts.groupBy("column", "class").agg(F.sum("cnt").alias("n_class")).filter("n_class > 1")
    blocks = materialize(_blocks(counts.join(broadcast_if_bounded(classes, SMALL_ROWS), ["column", "class"])))
    borders = [splits[c] for c in cols]
    cells = materialize(_near(blocks.join(_halo(blocks, k), ["column", "block"], "left"), borders, k))
    # ends of the few intervals that leave their block
    found = df.sparkSession.createDataFrame(list(enumerate(borders)), "column int, edges array<double>")
    zero = F.col("r") == 0
    ends = F.array(F.struct((F.col("value") - F.col("r")).alias("x"), (~zero).alias("equal"), F.lit(-1).alias("sign")),
                   F.struct((F.col("value") + F.col("r")).alias("x"), zero.alias("equal"), F.lit(1).alias("sign")))
    left = cells.filter("m is null").drop("m", "block")
    probes = left.select("column", "class", "value", F.inline(ends)).join(F.broadcast(found), "column")
    probes = materialize(probes.withColumn("block", F.size(F.filter("edges", lambda e: e <= F.col("x")))).drop("edges"))
    ranks = probes.drop("block").join(_ranks(blocks, probes.select("column", "block", "x", "equal")), ["column", "x", "equal"])
    inside = ranks.groupBy("column", "class", "value").agg(F.sum(F.col("sign") * F.col("below")).alias("m"))
    every = cells.filter("m is not null").drop("block").unionByName(left.join(inside, ["column", "class", "value"]))
    names = F.array(*[F.lit(c) for c in cols])
    return every.withColumn("need", F.least(F.lit(k), F.col("n_class") - 1)).withColumn("feature", F.get(names, F.col("column"))).drop("column")


def knn_mutual_information(df: DataFrame, cols: Sequence[str], target: str = "target", k: int = NEIGHBOURS,
                           **options) -> DataFrame:
    """``(feature, position, mi)`` in nats for every column."""
    cells = neighbour_cells(df, cols, target, k, **options)
    term = F.col("cnt") * (digamma(F.col("need")) - digamma(F.col("n_class")) - digamma(F.col("m")))
    n = F.sum("cnt")
    mi = cells.groupBy("feature").agg((digamma(n) + F.sum(term) / n).alias("mi"))
    order = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position")) for i, c in enumerate(cols)])
    positions = df.sparkSession.range(1).select(F.inline(order))
    return positions.join(mi, "feature", "left").select(
        "feature", "position", F.greatest(F.coalesce("mi", F.lit(0.0)), F.lit(0.0)).alias("mi"))
