"""Gradient boosting on histograms.

Columns are binned once into bytes (numeric: quantile edges; nominal: levels; the last code is "missing") and written
as a stage table. Growth is directed from the driver, which sees sums only: a pass over the rows adds up gradient and
hessian histograms of the tree nodes that are asked for, per task in numpy, then over the tasks; the next splits
follow from them. One pass serves all fits of a search, each at its own round and level.

* leaf-wise: the leaf of the highest gain is split next until ``num_leaves``; the most promising leaves are measured
  ahead, several in one pass, which changes the work but not the tree;
* depth-wise: all nodes of a level at once, down to ``max_depth``;
* only the smaller child of a split is added up, its sibling is the difference to the parent;
* second-order gains with L1 and L2 terms; missing values go to the side with the higher gain; levels of a nominal
  column are split into two sets along their gradient order;
* gradients are whole multiples of 2^-24, so sums are exact and a fit doesn't depend on how rows are dealt to tasks;
* row and column samples come from hashes of the row key and the round, for the same reason;
* a round's margins follow from the trees before it. They lie beside the rows in a persisted RDD of blocks; finished
  trees are added to it once, where the blocks are, and its lineage is cut by a checkpoint now and then. A pass streams
  the blocks, so a Python worker holds one block and the sums, however many rows there are, and any worker may take any
  partition.

A pass's sums have at most PASS_NODES histograms; those of few tasks go to the driver as they are, those of many are
added up in a tree of tasks first.

A pass costs more than its work while rows are few. Rows that with a fit's own arrays take WHOLE_BYTES at most are
broadcast instead, and a fit is one task that answers itself; fits run side by side. The sums are exact, so the trees
are the same.
"""
from __future__ import annotations

import heapq
import io
import itertools
import json
import math
import threading
from collections.abc import Callable, Generator, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.session import ensure_checkpoint_dir, materialize

MAX_BINS = 64  # of a numeric column
MAX_CODES = 255  # value codes of any column; the code after the last one is "missing"
ONE = 1 << 24  # gradients are multiples of 1 / ONE
STEPS, FINE_STEPS = 1024, 1 << 14  # score steps of a round's AUC and of a finished fit's
AHEAD = 128  # leaves measured ahead by leaf-wise growth, at most
PASS_NODES = 2048  # histograms of a pass
PASS_BYTES = 256 << 20  # of a pass's sums that may reach the driver unadded, before compression
BLOCK_ROWS = 30_000  # of a block; under 2^15, see histograms
ROWS_PER_TASK = 1 << 15  # rows times fits: a smaller task costs more to start than to run
WHOLE_BYTES, FIT_BYTES = 96 << 20, 64  # of rows that one task may hold; bytes a row beside its codes that a fit takes there
MERGE_ROUNDS = 40  # times that trees are added to the margins between two checkpoints
PATIENCE = 50  # fixed value: rounds without a better validation measure that end a fit
TRAIN, VAL = 0, 1


# ── bins ──────────────────────────────────────────────────────────────────────────────────────────

@dataclass(frozen=True)
class Bins:
    """Codes of the input columns: edges of numeric ones (a code per interval that ends at an edge, one more above),
    levels of nominal ones (levels that weren't there when fitted count as missing)."""
    numeric: list[str]
    nominal: list[str]
    edges: dict[str, list[float]]
    levels: dict[str, list[str]]

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.nominal]

    @property
    def missing(self) -> int:
        """Code of missing values: the same for all columns, after every value code."""
        return max([2, *(len(self.edges[c]) + 1 for c in self.numeric), *(len(self.levels[c]) for c in self.nominal)])

    def codes(self, frame: pd.DataFrame) -> np.ndarray:
        """Rows x columns codes of a frame with these columns."""
        out = np.full((len(frame), len(self.columns)), self.missing, np.uint8)
        for k, c in enumerate(self.numeric):
            v = frame[c].to_numpy(np.float64, na_value=np.nan)
            known = ~np.isnan(v)
            out[known, k] = np.searchsorted(np.array(self.edges[c]), v[known], "left")
        for k, c in enumerate(self.nominal, len(self.numeric)):
            found = pd.Index(self.levels[c]).get_indexer(pd.Index(frame[c].astype(object)))
            out[found >= 0, k] = found[found >= 0]
        return out


def fit_bins(df: DataFrame, numeric: Sequence[str], nominal: Sequence[str], bins: int = MAX_BINS) -> Bins:
    """Edges at quantiles of the non-missing values (one aggregate for all columns), the most frequent levels."""
    shares = [k / (bins - 1) for k in range(bins - 1)]
    edges: dict[str, list[float]] = {}
    if numeric:
        row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), shares, 10000).alias(c) for c in numeric]).first()
        edges = {c: sorted(set(row[c] or [])) for c in numeric}
    levels = {}
    for c in nominal:
        top = df.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(MAX_CODES).collect()
        levels[c] = sorted(r[c] for r in top)
    return Bins(list(numeric), list(nominal), edges, levels)


_CODED = "key long, target byte, role byte, codes binary"


def code_rows(df: DataFrame, bins: Bins, key: Column, target: Column, role: Column) -> DataFrame:
    """(key, target, role, codes): the binned rows, written once. Samples of rows go by the key, a long."""
    schema = pa.schema([("key", pa.int64()), ("target", pa.int8()), ("role", pa.int8()), ("codes", pa.binary())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = bins.codes(batch.to_pandas())
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_target"), batch.column("_role"),
                                              pa.array([r.tobytes() for r in found], pa.binary())], schema=schema)

    rows = df.select(key.cast("long").alias("_key"), target.cast("byte").alias("_target"), role.cast("byte").alias("_role"),
                     *[F.col(c).cast("double").alias(c) for c in bins.numeric], *[F.col(c).cast("string").alias(c) for c in bins.nominal])
    return materialize(rows.mapInArrow(code, _CODED))


# ── one fit ───────────────────────────────────────────────────────────────────────────────────────

@dataclass(frozen=True)
class Params:
    """A fit's parameters. ``num_leaves`` makes it leaf-wise, ``max_depth`` depth-wise; ``stop_on`` is the validation
    measure that patience looks at."""
    rounds: int
    rate: float
    num_leaves: int | None = None
    max_depth: int | None = None
    min_rows: int = 1
    min_hessian: float = 1e-3
    alpha: float = 0.0
    lam: float = 0.0
    columns: float = 1.0
    rows: float = 1.0
    rows_every: int = 1
    seed: int = 42
    patience: int | None = PATIENCE
    tolerance: float = 0.0
    stop_on: str = "logloss"


@dataclass
class Tree:
    """Nodes in arrays; ``feature`` -1 marks a leaf. Codes whose bit is set in ``left_codes`` go left."""
    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    left_codes: np.ndarray  # nodes x width, bool

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        at, width, p = np.zeros(len(codes), np.int64), self.left_codes.shape[1], codes.shape[1]
        inner = self.feature >= 0
        if not inner[0]:
            return at
        feature = np.where(inner, self.feature, 0).astype(np.int64)
        child = np.where(self.left_codes, self.left[:, None], self.right[:, None]).astype(np.int64).ravel()
        flat, live, node = codes.ravel(), np.arange(len(codes)), at
        while len(live):
            node = child.take(node * width + flat.take(live * p + feature.take(node)))
            at[live] = node
            on = inner.take(node)
            live, node = live[on], node[on]
        return at

    def reach(self, codes: np.ndarray, rows: np.ndarray, nodes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """(those of ``rows`` that come to one of the leaves ``nodes``, the leaf's place among them), in any order. A row is
        dropped where it leaves the ways to these leaves, so a deep leaf doesn't cost a walk of all rows down the tree."""
        width, p, goal = self.left_codes.shape[1], codes.shape[1], np.full(len(self.feature), -1)
        goal[list(nodes)] = np.arange(len(nodes))
        inner = np.flatnonzero(self.feature >= 0)
        if not len(inner):
            return (rows, np.zeros(len(rows), np.int64)) if goal[0] == 0 else (rows[:0], rows[:0])
        parent, way, up = np.full(len(goal), -1), np.zeros(len(goal), bool), np.asarray(nodes)
        parent[self.left[inner]] = parent[self.right[inner]] = inner
        while len(up):
            up = parent[up]
            up = up[up >= 0]
            way[up] = True
        # where a code leads: an inner node on a way, the place of a leaf asked for (below -1), or out (-1)
        place = np.where(goal >= 0, -2 - goal, np.where(way, np.arange(len(goal)), -1))
        child = np.where(self.left_codes, place[self.left][:, None], place[self.right][:, None]).ravel()
        feature = np.where(self.feature >= 0, self.feature, 0).astype(np.int64)
        flat, live, node, found = codes.ravel(), rows, np.zeros(len(rows), np.int64), []
        while len(live):
            node = child.take(node * width + flat.take(live * p + feature.take(node)))
            there = np.flatnonzero(node < -1)
            found.append((live.take(there), -2 - node.take(there)))
            on = np.flatnonzero(node >= 0)
            live, node = live.take(on), node.take(on)
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (rows, rows)


def hashed(key: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers in [0, 1) of row keys."""
    with np.errstate(over="ignore"):
        h = key.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _score(g: np.ndarray, h: np.ndarray, p: Params) -> np.ndarray:
    t = np.maximum(np.abs(g) - p.alpha, 0.0) if p.alpha else g
    return t * t / np.maximum(h + p.lam, 1e-12)


def leaf_value(g: float, h: float, p: Params) -> float:
    t = math.copysign(max(abs(g) - p.alpha, 0.0), g)
    return -p.rate * t / max(h + p.lam, 1e-12)


def best_splits(hists: np.ndarray, nominal: np.ndarray, p: Params) -> list[tuple[float, int, np.ndarray, np.ndarray]]:
    """Per histogram (nodes x columns x width x 3): (gain, column, codes that go left, sums of the left side).

    A numeric split sends codes up to a limit left, missing values to the better side (right when equal). A nominal
    split sends a prefix of the codes, ordered by gradient per hessian, left. Ties go to the first column and limit."""
    k, c, w, _ = hists.shape
    order = np.broadcast_to(np.arange(w), (k, c, w)).copy()
    if nominal.any():
        part = hists[:, nominal].astype(np.float64)
        ratio = np.where(part[..., 2] > 0, part[..., 0] / (part[..., 1] + p.lam * ONE + 1.0), np.inf)
        order[:, nominal] = np.argsort(ratio, axis=-1, kind="stable")
    sums = np.cumsum(np.take_along_axis(hists, order[..., None], 2) if nominal.any() else hists, axis=2)
    total, last = sums[:, 0, -1, :], hists[:, :, -1:, :]
    # without the last place everything would be left; of a numeric column that place is the missing code
    left = sums[:, :, :-1, :]
    best, at, sides = None, None, [left]
    if (last[:, ~nominal, :, 2] > 0).any():
        sides.append(np.where(nominal[None, :, None, None], left, left + last))
    whole = _score(total[:, 0] / ONE, total[:, 1] / ONE, p)
    for side in sides:
        g, h, n = (side[..., i] for i in range(3))
        gl, hl = g / ONE, h / ONE
        gr, hr = total[:, None, None, 0] / ONE - gl, total[:, None, None, 1] / ONE - hl
        gain = _score(gl, hl, p) + _score(gr, hr, p) - whole[:, None, None]
        fine = (n >= max(1, p.min_rows)) & (total[:, None, None, 2] - n >= max(1, p.min_rows)) & (hl >= p.min_hessian) & (hr >= p.min_hessian)
        gain = np.where(fine, gain, -np.inf).reshape(k, -1)
        place = gain.argmax(1)
        top = gain[np.arange(k), place]
        if best is None:
            best, at, which = top, place, np.zeros(k, int)
        else:
            better = (top > best) | ((top == best) & (place < at) & (top > -np.inf))
            best, at, which = np.where(better, top, best), np.where(better, place, at), np.where(better, 1, which)
    out = []
    for i in range(k):
        column, limit = divmod(int(at[i]), w - 1)
        codes = np.zeros(w, bool)
        codes[order[i, column, :limit + 1]] = True
        if which[i] and not nominal[column]:
            codes[-1] = True
        out.append((float(best[i]), column, codes, sides[which[i]][i, column, limit]))
    return out


@dataclass
class _Node:
    sums: np.ndarray
    depth: int
    hist: np.ndarray | None = None
    split: tuple | None = None
    children: tuple[int, int] | None = None


@dataclass
class Request:
    """What a fit asks of a pass. Margins are those after ``done`` trees from ``base``."""
    base: float
    done: int
    params: Params
    columns: np.ndarray | None = None
    tree: Tree | None = None  # the tree so far
    nodes: tuple[int, ...] = ()  # its leaves whose histograms are wanted
    counts: bool = False  # rows by role and target
    steps: int = 0  # measures with so many score steps
    span: tuple[float, float] = (0.0, 0.0)  # bounds of the margins, which the score steps divide

    def answers(self) -> int:
        """Arrays that it is answered with."""
        return 1 if self.counts else bool(self.nodes) + bool(self.steps)


MIN_GAIN = 1e-10
Ask = Generator[Request, list, object]  # yields what it wants, is sent the sums over all rows


def _chosen(nodes: list[_Node], p: Params) -> tuple[list[int], list[int]]:
    """Best-first growth over what is measured so far: (inner nodes of the tree, leaves to measure next).

    Growth goes on past leaves whose children aren't known, as if those had no gain: children that turn up can only push
    others back, so whatever isn't reached now can't be part of the tree. All that is reached is measured in one pass,
    and a tree takes as many passes as it has levels."""
    inner, ahead, grown, leaves = [], [], 1, [(-nodes[0].split[0], 0)]
    while leaves and grown < p.num_leaves:
        gain, best = heapq.heappop(leaves)
        if -gain <= MIN_GAIN:
            break
        grown += 1
        if nodes[best].children is None:
            ahead.append(best)
            continue
        inner.append(best)
        for i in nodes[best].children:
            heapq.heappush(leaves, (-nodes[i].split[0], i))
    return inner, ahead[:AHEAD]


def grow(nodes: list[_Node], columns: np.ndarray, nominal: np.ndarray, base: float, done: int, p: Params, budget: Callable[[], int]) -> Ask:
    """The rest of a tree whose root is measured; returns the Tree."""
    width = nodes[0].hist.shape[1]
    nodes[0].split = best_splits(nodes[0].hist[None], nominal, p)[0]
    while True:
        if p.num_leaves is not None:
            ask = _chosen(nodes, p)[1]
        else:
            ask = [i for i, n in enumerate(nodes) if n.children is None and n.depth < p.max_depth and n.split[0] > MIN_GAIN]
        if not ask:
            break
        last = p.max_depth is not None and all(nodes[i].depth + 1 >= p.max_depth for i in ask)
        ask = ask if last else ask[:max(1, budget())]
        new, small = [], []
        for i in ask:
            n = nodes[i]
            n.children = a, b = (len(nodes), len(nodes) + 1)
            nodes += [_Node(n.split[3], n.depth + 1), _Node(n.sums - n.split[3], n.depth + 1)]
            small.append(a if nodes[a].sums[2] <= nodes[b].sums[2] else b)
            new += [a, b]
        if last:  # nothing is split below: their sums are enough
            for i in new:
                nodes[i].split = (-math.inf,)
            continue
        tree = _tree(nodes, {i for i, n in enumerate(nodes) if n.children}, columns, width, p, False)
        total = (yield Request(base, done, p, columns, tree, tuple(small)))[0]
        for i, s, h in zip(ask, small, total):
            a, b = nodes[i].children
            nodes[s].hist, nodes[a + b - s].hist = h, nodes[i].hist - h
            nodes[i].hist = None
        for i, split in zip(new, best_splits(np.stack([nodes[i].hist for i in new]), nominal, p)):
            nodes[i].split = split
    inner = set(_chosen(nodes, p)[0]) if p.num_leaves is not None else {i for i, n in enumerate(nodes) if n.children}
    return _tree(nodes, inner, columns, width, p, True)


def _tree(nodes: list[_Node], inner: set[int], columns: np.ndarray, width: int, p: Params, packed: bool) -> Tree:
    """The tree of the ``inner`` nodes. ``packed``: without the nodes that aren't part of it, else in their numbers and
    without values."""
    kept, at = [0] if packed else list(range(len(nodes))), 0
    while packed and at < len(kept):
        if kept[at] in inner:
            kept += nodes[kept[at]].children
        at += 1
    place = {i: k for k, i in enumerate(kept)}
    m = len(kept)
    tree = Tree(np.full(m, -1, np.int16), np.zeros(m, np.int32), np.zeros(m, np.int32), np.zeros(m), np.zeros(m), np.zeros((m, width), bool))
    for k, i in enumerate(kept):
        n = nodes[i]
        if i in inner:
            tree.feature[k], tree.left_codes[k], tree.gain[k] = columns[n.split[1]], n.split[2], n.split[0]
            tree.left[k], tree.right[k] = place[n.children[0]], place[n.children[1]]
        elif packed:
            tree.value[k] = leaf_value(n.sums[0] / ONE, n.sums[1] / ONE, p)
    return tree


# ── rows of a task ────────────────────────────────────────────────────────────────────────────────

@dataclass
class Rows:
    """A task's rows; margins of the fits and the rows in their rounds as far as they are known here."""
    codes: np.ndarray
    target: np.ndarray
    role: np.ndarray
    key: np.ndarray
    missing: int
    margins: dict[int, tuple[int, np.ndarray]] = field(default_factory=dict)
    weights: dict[int, tuple[int, np.ndarray]] = field(default_factory=dict)  # rows of weight 1 in a round; others have 0

    def margin(self, fit: int, r: Request, trees: Callable[[int, int, int], Sequence[Tree]]) -> np.ndarray:
        """Margins after ``r.done`` trees; those of an earlier round than the known one start anew."""
        k, margin = self.margins.get(fit, (0, None))
        if margin is None or k > r.done:
            k, margin = 0, np.full(len(self.target), r.base)
        if k < r.done:
            margin = margin.copy()
            for tree in trees(fit, k, r.done):
                margin += tree.value[tree.leaves(self.codes)]
        self.margins[fit] = (r.done, margin)
        return margin

    def bag(self, fit: int, r: Request) -> np.ndarray:
        """The rows that are part of a round."""
        p, k = r.params, r.done - r.done % r.params.rows_every
        if self.weights.get(fit, (-1,))[0] != k:
            own = self.role == TRAIN
            if p.rows < 1:
                own = own & (hashed(self.key, p.seed + 1 + k) < p.rows)
            self.weights[fit] = (k, np.flatnonzero(own))
        return self.weights[fit][1]

    def gradients(self, rows: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(gradient, hessian) of ``rows`` in whole numbers."""
        proba = 1.0 / (1.0 + np.exp(-margin.take(rows)))
        return np.rint((proba - self.target.take(rows)) * ONE), np.rint(proba * (1 - proba) * ONE)

    def answer(self, fit: int, r: Request, trees: Callable[[int, int, int], Sequence[Tree]]) -> list[np.ndarray]:
        """This task's part of what a fit asks for."""
        if r.counts:
            return [np.bincount(self.role.astype(np.int64) * 2 + self.target, minlength=4).astype(np.int64)]
        out, margin = [], self.margin(fit, r, trees)
        if r.nodes:
            out.append(self.sums(fit, r, margin))
        if r.steps:
            out.append(_measures(self, margin, r.steps, r.span))
        return out

    def sums(self, fit: int, r: Request, margin: np.ndarray) -> np.ndarray:
        """Histograms of the nodes asked for."""
        rows, at = r.tree.reach(self.codes, self.bag(fit, r), r.nodes)
        weights = (*self.gradients(rows, margin), np.ones(len(rows)))
        return histograms(self.codes.take(rows, 0), r.columns, at, len(r.nodes), weights, self.missing + 1)

    @staticmethod
    def of(block: tuple, p: int, missing: int) -> Rows:
        codes, target, role, key, margins = block
        return Rows(np.frombuffer(codes, np.uint8).reshape(-1, p), np.frombuffer(target, np.int8), np.frombuffer(role, np.int8),
                    np.frombuffer(key, np.int64), missing, {i: (done, np.frombuffer(m)) for i, (done, m) in margins.items()})


@dataclass
class WholeRows(Rows):
    """All rows of a table in one task, which answers every pass of a fit: a round's gradients and the rows of its tree's
    leaves are kept from pass to pass, so a pass costs the rows of the leaves that are split."""
    by_column: np.ndarray | None = None
    rounds: dict[int, tuple[int, dict[int, np.ndarray], np.ndarray, np.ndarray]] = field(default_factory=dict)

    def sums(self, fit: int, r: Request, margin: np.ndarray) -> np.ndarray:
        if self.by_column is None:
            self.by_column = np.ascontiguousarray(self.codes.T)
        if self.rounds.get(fit, (-1,))[0] != r.done:
            bag, n = self.bag(fit, r), len(self.target)
            gradient, both = np.empty(n), np.empty(n)
            gradient[bag], hessian = self.gradients(bag, margin)
            both[bag] = hessian + float(1 << 37)
            self.rounds[fit] = (r.done, {0: bag}, gradient, both)
        _, held, gradient, both = self.rounds[fit]
        parent = {}
        for i in np.flatnonzero(r.tree.feature >= 0).tolist():
            parent[int(r.tree.left[i])] = parent[int(r.tree.right[i])] = i

        def rows_of(node: int) -> np.ndarray:
            if node not in held:
                above = parent[node]
                rows = rows_of(above)
                left = r.tree.left_codes[above].take(self.by_column[r.tree.feature[above]].take(rows))
                held[int(r.tree.left[above])], held[int(r.tree.right[above])] = rows[left], rows[~left]
                del held[above]
            return held[node]

        parts = [rows_of(i) for i in r.nodes]
        rows = np.concatenate(parts) if len(parts) > 1 else parts[0]
        at = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        out = np.zeros((len(parts), len(r.columns), self.missing + 1, 3), np.int64)
        for start in range(0, len(rows), BLOCK_ROWS):
            own = rows[start:start + BLOCK_ROWS]
            _add_sums(out, (self.by_column[c].take(own) for c in r.columns), at[start:start + BLOCK_ROWS], gradient.take(own), both.take(own))
        return out


def histograms(codes: np.ndarray, columns: np.ndarray, at: np.ndarray, nodes: int, weights: tuple[np.ndarray, np.ndarray, np.ndarray], width: int) -> np.ndarray:
    """nodes x columns x width x (gradient, hessian, rows) sums of the rows at a node (``at`` >= 0), in whole numbers.

    Hessians are at most ONE / 4, so those of fewer than 2^15 rows add up to less than 2^37 and share a double with the
    number of rows."""
    out = np.zeros((nodes, len(columns), width, 3), np.int64)
    every = np.flatnonzero((at >= 0) & (weights[2] > 0))
    for start in range(0, len(every), BLOCK_ROWS):
        rows = every[start:start + BLOCK_ROWS]
        own = np.ascontiguousarray(codes.take(rows, 0).T)  # a column's codes lie together
        _add_sums(out, (own[c] for c in columns), at.take(rows), weights[0].take(rows), weights[1].take(rows) + float(1 << 37))
    return out


def _add_sums(out: np.ndarray, columns: Iterable[np.ndarray], at: np.ndarray, gradient: np.ndarray, both: np.ndarray) -> None:
    """Adds at most BLOCK_ROWS rows to histograms; ``both`` is the hessian, and 2^37 for the row."""
    nodes, _, width, _ = out.shape
    node = at * width
    for k, codes in enumerate(columns):
        cell = node + codes
        out[:, k, :, 0] += np.bincount(cell, gradient, nodes * width).astype(np.int64).reshape(nodes, width)
        sums = np.bincount(cell, both, nodes * width).astype(np.int64).reshape(nodes, width)
        out[:, k, :, 1] += sums & ((1 << 37) - 1)
        out[:, k, :, 2] += sums >> 37


def step_counts(data: Rows, margin: np.ndarray, steps: int, span: tuple[float, float]) -> np.ndarray:
    """Rows by (role, target, score step); steps divide the span of the margins, however narrow it is."""
    low, high = span
    step = np.clip(((margin - low) * (steps / (high - low) if high > low else 0.0)).astype(np.int64), 0, steps - 1)
    return np.bincount((data.role.astype(np.int64) * 2 + data.target) * steps + step, minlength=4 * steps).reshape(2, 2, steps)


def step_auc(counts: np.ndarray) -> float | None:
    """AUC of (target, score step) counts; rows of one step are ties."""
    neg, pos = counts[0].astype(np.float64), counts[1].astype(np.float64)
    if not neg.sum() or not pos.sum():
        return None
    below = np.cumsum(neg) - neg
    return float((pos * (below + neg / 2)).sum() / (neg.sum() * pos.sum()))


def _measures(data: Rows, margin: np.ndarray, steps: int, span: tuple[float, float]) -> np.ndarray:
    """Per role: sum of log-losses, wrong decisions, rows, and the step counts, in whole numbers."""
    proba = 1.0 / (1.0 + np.exp(-margin))
    held = np.clip(proba, 1e-15, 1 - 1e-15)
    yes, loss = data.target == 1, np.empty(len(margin))
    loss[yes], loss[~yes] = np.log(held[yes]), np.log1p(-held[~yes])
    loss = np.rint(-loss * ONE)
    wrong = (proba >= 0.5) != yes
    heads = [np.bincount(data.role, w, 2) for w in (loss, wrong.astype(float), np.ones(len(margin)))]
    return np.concatenate([np.stack(heads, 1).astype(np.int64), step_counts(data, margin, steps, span).reshape(2, -1)], 1)


def read_measures(total: np.ndarray) -> dict[str, dict[str, float | None]]:
    out = {}
    for role, name in ((TRAIN, "train"), (VAL, "val")):
        loss, wrong, n = (int(v) for v in total[role, :3])
        if n:
            out[name] = {"logloss": loss / ONE / n, "error": wrong / n, "roc_auc": step_auc(total[role, 3:].reshape(2, -1))}
    return out


@dataclass
class Fitted:
    base: float
    trees: list[Tree]
    history: list[dict]  # a round's measures by split
    best: int  # rounds kept
    aucs: dict[str, float | None] = field(default_factory=dict)


ROOT = Tree(np.array([-1], np.int16), np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(1), np.zeros(1), np.zeros((1, 1), bool))


def boost(p: Params, nominal: np.ndarray, keep: Callable[[Tree], None] = lambda tree: None, budget: Callable[[], int] = lambda: PASS_NODES) -> Ask:
    """One fit over columns of which some are ``nominal``; returns Fitted. Every finished tree is given to ``keep``."""
    neg, pos, vneg, vpos = ((yield Request(0.0, 0, p, counts=True))[0]).tolist()
    share = min(max(pos / max(1, neg + pos), 1e-6), 1 - 1e-6)
    base, stop = math.log(share / (1 - share)), p.patience is not None and vneg + vpos > 0
    out = Fitted(base, [], [], 0)
    best, rng, spans = None, np.random.default_rng(p.seed), [(base, base)]
    for k in range(p.rounds + 1):
        columns = np.sort(rng.permutation(len(nominal))[:max(1, round(p.columns * len(nominal)))])
        # a round's measures and the root of the next tree need the same margins
        found = yield Request(base, k, p, columns, ROOT, (0,) if k < p.rounds else (), steps=STEPS if k else 0, span=spans[k])
        if k:
            measured = read_measures(found[-1])
            out.history.append(measured)
            if stop:
                measure = measured["val"][p.stop_on]
                worth = -measure if p.stop_on == "logloss" else (measure or 0.0)
                if best is None or worth > best + p.tolerance * max(abs(best), 0.01):
                    best, out.best = worth, k
                elif k - out.best >= p.patience:
                    break
            else:
                out.best = k
        if k < p.rounds:
            root = _Node(found[0][0][0].sum(0), 0, found[0][0])
            tree = yield from grow([root], columns, nominal[columns], base, k, p, budget)
            out.trees.append(tree)
            leaves = tree.value[tree.feature < 0]
            spans.append((spans[k][0] + float(leaves.min()), spans[k][1] + float(leaves.max())))
            keep(tree)
    out.trees = out.trees[:out.best]
    total = (yield Request(base, out.best, p, steps=FINE_STEPS, span=spans[out.best]))[0]
    out.aucs = {name: m["roc_auc"] for name, m in read_measures(total).items()}
    return out


def drive(fits: Sequence[Ask], ask: Callable[[dict[int, Request]], dict[int, list]]) -> list:
    """Run several fits side by side: what they want of a pass is asked together. Returns their results in order."""
    results: list = [None] * len(fits)
    asked: dict[int, Request] = {}

    def turn(i: int, answer: list | None) -> None:
        try:
            asked[i] = fits[i].send(answer)
        except StopIteration as done:
            asked.pop(i, None)
            results[i] = done.value

    for i in range(len(fits)):
        turn(i, None)
    while asked:
        for i, answer in ask(dict(asked)).items():
            turn(i, answer)
    return results


# ── models ────────────────────────────────────────────────────────────────────────────────────────

@dataclass
class BoostedModel:
    """Trees over binned columns."""
    bins: Bins
    base: float
    trees: list[Tree]
    history: list[dict]
    aucs: dict[str, float | None]

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), self.base)
        for tree in self.trees:
            out += tree.value[tree.leaves(codes)]
        return out

    def parts(self, codes: np.ndarray) -> np.ndarray:
        """Trees x rows: what every tree adds to the margins."""
        return np.stack([t.value[t.leaves(codes)] for t in self.trees]) if self.trees else np.empty((0, len(codes)))

    def total(self, parts: Sequence[np.ndarray], rows: int) -> np.ndarray:
        """Margins of the trees' parts, added in the order of the trees like ``margins``."""
        out = np.full(rows, self.base)
        for part in parts:
            out += part
        return out

    def proba(self) -> Column:
        """P(class 1) of rows with the binned columns; Arrow batches, no shuffle."""
        own = self

        @F.pandas_udf("double")
        def score(frame: pd.DataFrame) -> pd.Series:
            return pd.Series(1.0 / (1.0 + np.exp(-own.margins(own.bins.codes(frame)))))

        return score(F.struct(*[F.col(c).cast("double").alias(c) for c in self.bins.numeric], *[F.col(c).cast("string").alias(c) for c in self.bins.nominal]))

    def splits(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of splits, sum of gains) per column."""
        n, gain = np.zeros(len(self.bins.columns)), np.zeros(len(self.bins.columns))
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(n, t.feature[inner], 1)
            np.add.at(gain, t.feature[inner], t.gain[inner])
        return n, gain

    def to_bytes(self) -> bytes:
        head = {"numeric": self.bins.numeric, "nominal": self.bins.nominal, "edges": self.bins.edges, "levels": self.bins.levels,
                "base": self.base, "history": self.history, "aucs": self.aucs}
        arrays = {"sizes": np.array([len(t.feature) for t in self.trees], np.int64)}
        for name in ("feature", "left", "right", "value", "gain"):
            arrays[name] = np.concatenate([getattr(t, name) for t in self.trees]) if self.trees else np.empty(0)
        arrays["codes"] = np.packbits(np.concatenate([t.left_codes for t in self.trees]), axis=1) if self.trees else np.empty((0, 0), np.uint8)
        out = io.BytesIO()
        np.savez_compressed(out, head=np.frombuffer(json.dumps(head).encode(), np.uint8), **arrays)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> BoostedModel:
        z = np.load(io.BytesIO(data))
        head = json.loads(z["head"].tobytes())
        bins = Bins(head["numeric"], head["nominal"], head["edges"], head["levels"])
        ends = np.cumsum(z["sizes"])
        parts = {n: z[n] for n in ("feature", "left", "right", "value", "gain")}
        codes = np.unpackbits(z["codes"], axis=1, count=bins.missing + 1).astype(bool) if len(ends) else None
        trees = [Tree(*[parts[n][b - s:b] for n in parts], codes[b - s:b]) for b, s in zip(ends, z["sizes"])]
        return BoostedModel(bins, head["base"], trees, head["history"], head["aucs"])


# ── Spark ─────────────────────────────────────────────────────────────────────────────────────────

def tasks_for(df: DataFrame, rows: int, fits: int = 1) -> int:
    """Tasks of a pass: one per ROWS_PER_TASK rows that a fit reads up to the number of slots, then whole rounds of all
    slots."""
    slots = max(1, df.sparkSession.sparkContext.defaultParallelism)
    return max(min(2, slots), min(slots, -(-rows * fits // ROWS_PER_TASK)), slots * (rows // (slots * 8_000_000)))


def _finder(sent: dict[int, tuple[int, list[Tree]]]) -> Callable[[int, int, int], list[Tree]]:
    """Trees by fit and range, of {fit: (number of the first one, trees)}."""
    return lambda fit, start, stop: sent[fit][1][start - sent[fit][0]:stop - sent[fit][0]]


def _sums(count: int, data: bytes) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(data, 8 * count, asbytes=True), np.int64)


def _work(p: Params) -> float:
    """Of a fit, in no unit."""
    return p.rounds * (20 + (p.num_leaves if p.num_leaves is not None else 1 << min(p.max_depth, 8)))


def _fit_whole(coded: DataFrame, bins: Bins, params: Sequence[Params], finished: Callable[[int, BoostedModel], None]) -> list[BoostedModel]:
    """A task per fit, the longest first, each with all rows."""
    sc, missing, p = coded.sparkSession.sparkContext, bins.missing, len(bins.columns)
    nominal = np.array([c in set(bins.nominal) for c in bins.columns], bool)
    held = coded.select("codes", "target", "role", "key").toArrow()
    data = sc.broadcast((b"".join(held.column("codes").to_pylist()), *[held.column(c).to_numpy().astype(t).tobytes() for c, t in
                                                                   (("target", np.int8), ("role", np.int8), ("key", np.int64))]))
    del held

    def run(own: Params) -> bytes:
        codes, target, role, key = data.value
        rows, trees = WholeRows(np.frombuffer(codes, np.uint8).reshape(-1, p), np.frombuffer(target, np.int8), np.frombuffer(role, np.int8),
                                np.frombuffer(key, np.int64), missing), []
        f = drive([boost(own, nominal, trees.append)], lambda wanted: {i: rows.answer(i, r, lambda _, a, b: trees[a:b]) for i, r in wanted.items()})[0]
        return BoostedModel(bins, f.base, f.trees, f.history, f.aucs).to_bytes()

    ending = threading.Lock()

    def fit(i: int) -> BoostedModel:
        model = BoostedModel.from_bytes(sc.parallelize([params[i]], 1).map(run).collect()[0])
        with ending:
            finished(i, model)
        return model

    order = sorted(range(len(params)), key=lambda i: -_work(params[i]))
    try:
        with ThreadPoolExecutor(max_workers=len(params)) as pool:
            fits = {i: pool.submit(fit, i) for i in order}
            return [fits[i].result() for i in range(len(params))]
    finally:
        data.destroy()


def fit_many(coded: DataFrame, bins: Bins, params: Sequence[Params], tasks: int | None = None,
             finished: Callable[[int, BoostedModel], None] = lambda i, model: None) -> list[BoostedModel]:
    """Fit every parameter set on the coded rows (``code_rows``), all of them side by side; ``finished`` is called as
    each of them ends. Few rows are given to a task per fit, unless ``tasks`` asks for passes of so many tasks."""
    sc = coded.sparkSession.sparkContext
    n = coded.count()
    if not n:
        raise ValueError("no rows to fit a model on")
    if tasks is None and params and n * (len(bins.columns) + FIT_BYTES) <= WHOLE_BYTES:
        return _fit_whole(coded, bins, params, finished)
    nominal = np.array([c in set(bins.nominal) for c in bins.columns], bool)
    p, missing = len(bins.columns), bins.missing
    tasks, sampled = tasks or tasks_for(coded, n, len(params)), any(x.rows < 1 for x in params)  # else nothing asks for the keys
    ensure_checkpoint_dir(coded.sparkSession)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        b = pa.Table.from_batches(held)
        return pa.RecordBatch.from_arrays([
            pa.array([b"".join(b.column("codes").to_pylist())], pa.binary()),
            *[pa.array([b.column(c).to_numpy().astype(t).tobytes()], pa.binary()) for c, t in (("target", np.int8), ("role", np.int8))],
            pa.array([b.column("key").to_numpy().astype(np.int64).tobytes() if sampled else b""], pa.binary())],
            names=["codes", "target", "role", "key"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                held.append(b.slice(at, BLOCK_ROWS - rows))
                at, rows = at + held[-1].num_rows, rows + held[-1].num_rows
                if rows == BLOCK_ROWS:
                    yield block(held)
                    held, rows = [], 0
        if held:
            yield block(held)

    dealt = coded.repartition(tasks, "key").select("codes", "target", "role", "key")
    # blocks of (codes, targets, roles, keys, {fit: (trees, margins after them)})
    blocks = dealt.mapInArrow(pack, "codes binary, target binary, role binary, key binary").rdd.map(lambda r: (*map(bytes, r), {})).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    grown: list[list[Tree]] = [[] for _ in params]  # finished trees of the fits
    held = [0] * len(params)  # trees that are in the blocks' margins
    added, sent = 0, []

    def add(new, wanted: dict[int, tuple[int, float]]) -> Callable[[Iterator], Iterator]:
        """Adds trees to the margins of the ``wanted`` fits: {fit: (trees after that, base)}; others are over."""
        def run(own: Iterator) -> Iterator[tuple]:
            trees = _finder(new.value)
            for part in own:
                rows = Rows.of(part, p, missing)
                margins = {i: (done, rows.margin(i, Request(base, done, params[i]), trees).tobytes()) for i, (done, base) in wanted.items()}
                yield (*part[:4], margins)
        return run

    def ask(wanted: dict[int, Request]) -> dict[int, list]:
        nonlocal blocks, added
        before = None
        new = [i for i, r in wanted.items() if r.done > held[i]]
        if new and sum(wanted[i].done - held[i] for i in new) >= len(wanted):
            # fits at an earlier round than the blocks are at are in their last pass, they start anew there
            target = {i: (r.done, r.base) for i, r in wanted.items() if r.done >= held[i] and r.done}
            sent.append(sc.broadcast({i: (held[i], grown[i][held[i]:done]) for i, (done, _) in target.items()}))
            before, blocks = blocks, blocks.mapPartitions(add(sent[-1], target)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
            added += 1
            if added % MERGE_ROUNDS == 0:
                blocks.checkpoint()
            for i, (done, _) in target.items():
                held[i] = done
        rest = {}
        for i, r in wanted.items():
            first = held[i] if held[i] <= r.done else 0
            if first < r.done:
                rest[i] = (first, grown[i][first:r.done])

        def run(own: Iterator) -> Iterator[tuple]:
            trees = _finder(rest)

            def answers(rows: Rows) -> list[np.ndarray]:
                return [f for i, r in wanted.items() for f in rows.answer(i, r, trees)]

            total = None
            for part in own:
                found = answers(Rows.of(part, p, missing))
                total = found if total is None else [np.add(a, b, out=a) for a, b in zip(total, found)]
            if total is None:
                total = answers(Rows.of((b"", b"", b"", b"", {}), p, missing))
            flat = np.concatenate([f.ravel() for f in total])
            yield [f.shape for f in total], len(flat), pa.Codec("zstd", 1).compress(flat.tobytes(), asbytes=True)

        passed = blocks.mapPartitions(run)
        size = 24 * (missing + 1) * sum(len(r.nodes) * len(r.columns) for r in wanted.values() if r.nodes)
        if size * blocks.getNumPartitions() <= PASS_BYTES:
            shapes, total = None, 0
            for shapes, count, data in passed.collect():
                total = total + _sums(count, data)
        else:
            shapes, total = passed.map(lambda x: (x[0], _sums(*x[1:]))).treeReduce(lambda a, b: (a[0], a[1] + b[1]))
        if before is not None:
            before.unpersist()
        out, at, shapes = {}, 0, iter(shapes)
        for i, r in wanted.items():
            out[i] = []
            for shape in itertools.islice(shapes, r.answers()):
                m = math.prod(shape)
                out[i].append(total[at:at + m].reshape(shape))
                at += m
        return out

    live = [len(params)]

    def budget() -> int:
        return max(1, PASS_NODES // live[0])

    def fit(i: int) -> Ask:
        f = yield from boost(params[i], nominal, grown[i].append, budget)
        model = BoostedModel(bins, f.base, f.trees, f.history, f.aucs)
        finished(i, model)
        return model

    try:
        fits = [fit(i) for i in range(len(params))]

        def counted(wanted: dict[int, Request]) -> dict[int, list]:
            live[0] = max(1, len(wanted))
            return ask(wanted)

        return drive(fits, counted)
    finally:
        blocks.unpersist()
        for s in sent:
            s.destroy()
