"""Trees that Spark ML lacks, grown by distributed histogram passes.

The training vectors become bytes: each feature is cut into at most 256 bins at its
quantiles, so a row of p features has p bytes. A tree node is (feature, bin): rows
whose bin is at most that bin go left.

Growing alternates two kinds of passes over the cached, binned rows:

* Nodes that are too big for one task are split by a histogram pass. Every task sends its
  rows down the trees so far and sums (rows, a, b) by bin for each open node and
  feature; the partial sums meet by (tree, node, feature), where the split of that
  feature is chosen; only one candidate for each node and feature reaches the driver.
* Nodes of at most `finish` bytes are finished in one task each on their gathered rows, level by level in numpy.

Both kinds choose splits by the same rules, and random draws hash (seed, tree, path in the tree,
feature), so a tree is the same wherever its nodes are grown.

Sums: a, b are the weights of class 0 and 1 (gini), the weight and weighted target
(variance), or gradient and Hessian (newton).

A model is its nodes: the driver and every scoring task hold them whole, as with Spark's own forests."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINISH = 32 << 20       # bytes of the rows of a node that one task finishes
SENT = 4 << 20          # bytes of gathered rows in one batch
CELLS = 1 << 22         # histogram cells held at once in a finishing task
SMALL = (2, 4, 8, 16, 32)       # nodes of at most so many rows are split by their rows, not by histograms
OPEN = 4096             # nodes that one histogram pass splits at most
EPS = 1e-12


# ---- bins ------------------------------------------------------------------

@dataclass
class Bins:
    """Cut points of the features `keep` (None: all): bin = number of cuts below the value; NaN is in the last bin. Features
    without a cut, which are the same in all training rows, are left out."""
    cuts: list[np.ndarray]
    keep: list[int] | None = None

    @property
    def width(self) -> int:
        """Bins of the feature that has most, two at least."""
        return max(2, max((len(c) for c in self.cuts), default=0) + 1)

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.cuts)), np.uint8)
        for k, (j, c) in enumerate(zip(self.keep or range(len(self.cuts)), self.cuts, strict=True)):
            out[:, k] = np.searchsorted(c, x[:, j], "left")
        return out


def fit_bins(train: DataFrame, bins: int = 64, features: str = "features") -> Bins:
    """Quantiles of each feature by one aggregation; its smallest and largest value are among them."""
    at = [i / bins for i in range(bins + 1)]
    rows = (train.select(F.posexplode(vector_to_array(features)).alias("j", "x")).groupBy("j")
            .agg(F.percentile_approx(F.when(~F.isnan("x"), F.col("x")), at, 10000).alias("q")).collect())     # a row for each feature
    cuts = {r.j: np.unique(np.array(r.q or [0.0], np.float64))[:-1] for r in rows}
    keep = [j for j in sorted(cuts) if len(cuts[j])] or [0]
    return Bins([cuts.get(j, np.zeros(0)) for j in keep], keep)


def _matrix(col: pa.Array) -> np.ndarray:
    """A list<double> column of equal lengths as rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 1)


def binned(df: DataFrame, bins: Bins, *keep: Column, features: str = "features") -> DataFrame:
    """The columns `keep`, and `x`: the bins of the feature vector as bytes."""
    names = df.select(*keep).columns
    schema = df.select(*keep, F.lit(b"").alias("x")).schema
    p = len(bins.cuts)

    def run(batches):
        for b in batches:
            x = np.ascontiguousarray(bins.of(_matrix(b.column(b.num_columns - 1))))
            off = pa.py_buffer((np.arange(b.num_rows + 1) * p).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.Array.from_buffers(pa.binary(), b.num_rows, [None, off, pa.py_buffer(x)])], [*names, "x"])
    return df.select(*keep, vector_to_array(features).alias("__v")).mapInArrow(run, schema)


def _bytes(col, p: int) -> np.ndarray:
    """A binary column of p bytes a row as rows."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.binary())
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]].reshape(-1, p) if len(col) else np.zeros((0, p), np.uint8)


# ---- trees -----------------------------------------------------------------

@dataclass
class Tree:
    """Nodes in order of creation; feature -1: a leaf. The children of a node stand side by side. gains: those of the splits, summed by feature."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gains: np.ndarray | None = None

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node where each row of bins ends."""
        at = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        while len(live):
            f = self.feature[at[live]]
            live, f = live[f >= 0], f[f >= 0]
            n = at[live]
            at[live] = self.left[n] + (x[live, f] > self.bin[n])
        return at


@dataclass
class Rule:
    """How nodes are split. score: gini, variance or newton. tries: features drawn for a node (None: all, best bin of
    each); with tries, each has one random cut, or with `best` its best bin."""
    score: str = "variance"
    tries: int | None = None
    best: bool = False
    depth: int = 1 << 30
    least_rows: int = 1
    least_b: float = 0.0
    l2: float = 0.0
    gain: float = EPS
    seed: int = 42
    bootstrap: bool = False
    leaves: int = 0             # best-first growth to so many leaves; 0: all splits
    symmetric: bool = False     # one split for all nodes of a level

    def splits(self, gain):
        """Whether a cut of this gain is made: a random one always, the best one if it is worth something."""
        return np.isfinite(gain) if self.tries and not self.best else np.asarray(gain) > self.gain


def part_score(rule: Rule, a, b):
    with np.errstate(divide="ignore", invalid="ignore"):
        if rule.score == "gini":
            s = (a * a + b * b) / (a + b)
        elif rule.score == "variance":
            s = b * b / a
        else:
            s = a * a / (b + rule.l2)
    return np.where(np.isfinite(s), s, 0.0)


def leaf_value(rule: Rule, a, b):
    with np.errstate(divide="ignore", invalid="ignore"):
        v = np.clip(b / (a + b), 0.0, 1.0) if rule.score == "gini" else b / a if rule.score == "variance" else -a / (b + rule.l2)
    return np.where(np.isfinite(v), v, 0.0)


def _draw(seed: int, tree, path, feature) -> np.ndarray:
    """64 random bits of (seed, tree, path, feature) by a splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (np.asarray(path, np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.asarray(tree, np.uint64) * np.uint64(0xD1B54A32D192ED03)
             ^ (np.asarray(feature).astype(np.uint64) + np.uint64(seed + 1)) * np.uint64(0x8CB92BA72F3D8DD7))
        for a, b in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(a))) * np.uint64(b)
        return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def features_of(rule: Rule, tree: int, paths: np.ndarray, p: int, turn: np.ndarray) -> np.ndarray:
    """nodes x tries: the features that each node looks at in its `turn`; a node without a valid cut takes the next ones."""
    order = np.argsort(_draw(rule.seed, tree, paths[:, None], np.arange(p)[None, :]), axis=1, kind="stable")
    at = turn[:, None] * rule.tries + np.arange(rule.tries)[None, :]
    return np.where(at < p, np.take_along_axis(order, np.minimum(at, p - 1), 1), -1)


def random_bins(rule: Rule, bins: Bins, tree: int, paths: np.ndarray, feats: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The bin of a cut drawn uniformly between the values of the lowest and highest bin of a node (low < high)."""
    u = _unit(_draw(rule.seed ^ 0x5A5A, tree, paths, feats))
    out = np.zeros(feats.shape, np.int64)
    for f in np.unique(feats[feats >= 0]):
        here = (feats == f) & (low < high)
        if here.any():
            c = bins.cuts[f]
            a, b = c[low[here]], c[high[here] - 1]
            out[here] = np.clip(np.searchsorted(c, a + u[here] * (b - a), "left"), low[here], high[here] - 1)
    return out


def poisson(seed: int, tree: int, ident: np.ndarray) -> np.ndarray:
    """How often each row is in the tree's bootstrap sample: Poisson(1) by hash of the row's id."""
    u = _unit(_draw(seed ^ 0x3C3C, tree, ident.view(np.uint64), 0))
    edges = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1, 13)])))
    return np.searchsorted(edges, u, "right").astype(np.float64)


def first_best(gain: np.ndarray, scale) -> np.ndarray:
    """The first place along the last axis whose gain is the largest, up to the rounding of sums of the size `scale`: equal
    cuts are told apart in the same way wherever, and in whatever order, their sums were made."""
    top = gain.max(-1, keepdims=True)
    return (gain >= top - 1e-10 * (np.asarray(scale)[..., None] + np.where(np.isfinite(top), np.abs(top), 0.0))).argmax(-1)


def best_bins(rule: Rule, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, bin, left sums) of the best cut of each histogram h[..., bins, 3]; gain -inf without a valid one."""
    left = np.cumsum(h, axis=-2)[..., :-1, :]
    total = h.sum(axis=-2)[..., None, :]
    right = total - left
    gain = part_score(rule, left[..., 1], left[..., 2]) + part_score(rule, right[..., 1], right[..., 2]) - part_score(rule, total[..., 1], total[..., 2])
    ok = (left[..., 0] >= rule.least_rows) & (right[..., 0] >= rule.least_rows)
    if rule.score == "newton":
        ok &= (left[..., 2] >= rule.least_b) & (right[..., 2] >= rule.least_b)
    gain = np.where(ok, gain, -np.inf)
    at = first_best(gain, part_score(rule, total[..., 0, 1], total[..., 0, 2]))
    pick = np.take_along_axis
    return pick(gain, at[..., None], -1)[..., 0], at, pick(left, at[..., None, None], -2)[..., 0, :]


def _done(rule: Rule, sums: np.ndarray, depth) -> np.ndarray:
    """Nodes (sums of rows, a, b) that are leaves without a look at their features."""
    stop = (sums[..., 0] < 2 * rule.least_rows) | (np.asarray(depth) >= rule.depth)
    if rule.score == "gini":
        stop |= (sums[..., 1] <= EPS * sums[..., 2]) | (sums[..., 2] <= EPS * sums[..., 1])       # what rounding leaves of a class is none
    return stop


# ---- finishing a node in one task -------------------------------------------

class _Nodes:
    """A growing list of nodes; `gain` tells in which order best-first growth splits them. `subs`: the finished subtrees
    in the places of leaves, as arrays: a full tree has as many nodes as rows, and they are not opened any more."""

    def __init__(self):
        self.feature, self.bin, self.left, self.sums, self.gain, self.path = [], [], [], [], [], []
        self.subs: dict[int, Tree] = {}

    def add(self, sums, path) -> int:
        self.feature.append(-1), self.bin.append(0), self.left.append(-1), self.sums.append(sums), self.gain.append(0.0), self.path.append(path)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, bin_: int, left_sums, gain: float) -> int:
        """Children of `node`; the place of the left one."""
        self.feature[node], self.bin[node], self.gain[node] = int(feature), int(bin_), float(gain)
        path = self.path[node]
        a = self.add(left_sums, (path * 2 + 1) & 0xFFFFFFFFFFFFFFFF)
        self.add(self.sums[node] - left_sums, (path * 2 + 2) & 0xFFFFFFFFFFFFFFFF)
        self.left[node] = a
        return a

    def gains(self, p: int) -> np.ndarray:
        """The gains of all splits, summed by feature."""
        f = np.array(self.feature, np.int64)
        own = np.bincount(f[f >= 0], np.array(self.gain, np.float64)[f >= 0], p)
        return own + sum(t.gains for t in self.subs.values())

    def tree(self, rule: Rule) -> Tree:
        s = np.array(self.sums, np.float64).reshape(-1, 3)
        own = Tree(np.array(self.feature, np.int32), np.array(self.bin, np.int16), np.array(self.left, np.int32), leaf_value(rule, s[:, 1], s[:, 2]))
        if not self.subs:
            return own
        end = len(own.feature)
        n = end + sum(len(t.feature) - 1 for t in self.subs.values())
        out = Tree(np.empty(n, np.int32), np.empty(n, np.int16), np.empty(n, np.int32), np.empty(n))
        for name in ("feature", "bin", "left", "value"):
            getattr(out, name)[:end] = getattr(own, name)
        for at, t in sorted(self.subs.items()):
            stop = end + len(t.feature) - 1                   # node k > 0 of the subtree becomes end - 1 + k
            for name, v in (("feature", t.feature), ("bin", t.bin), ("left", np.where(t.left >= 0, t.left + (end - 1), -1)), ("value", t.value)):
                getattr(out, name)[at], getattr(out, name)[end:stop] = v[0], v[1:]
            end = stop
        return out


def _histograms(x: np.ndarray, sums: np.ndarray, node: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """nodes x features x width x 3."""
    out = np.empty((nodes, x.shape[1], width, 3))
    first = node * width if nodes > 1 else 0
    n, a, b = (np.ascontiguousarray(sums[:, k]) for k in range(3))
    plain = bool((n == 1).all())
    for f in range(x.shape[1]):
        at = first + x[:, f].astype(np.int64)
        for k, w in enumerate((None if plain else n, a, b)):
            out[:, f, :, k] = np.bincount(at, w, nodes * width).reshape(nodes, width)
    return out


def _cuts_in_bins(rule: Rule, width: int, x, sums, node, m, totals):
    """(gain, column, bin, left sums) of the best cut of m nodes over the columns of x, from histograms of bounded blocks of nodes. Rows are sorted by node."""
    step = max(1, CELLS // (x.shape[1] * width * 3))
    gain, col, cut, left = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros((m, 3))
    for i in range(0, m, step):
        a, b = np.searchsorted(node, [i, min(m, i + step)])
        g, t, s = best_bins(rule, _histograms(x[a:b], sums[a:b], node[a:b] - i, min(m, i + step) - i, width))
        f = first_best(g, part_score(rule, totals[i:i + step, 1], totals[i:i + step, 2]))
        here = np.arange(len(f))
        gain[i:i + step], col[i:i + step], cut[i:i + step], left[i:i + step] = g[here, f], f, t[here, f], s[here, f]
    return gain, col, cut, left


def _cuts_in_rows(rule: Rule, x, sums, first, size, most, totals):
    """The same for nodes of at most `most` rows each (node i: `size[i]` rows from `first[i]` on): the rows of a node are
    sorted by bin and summed in that order, so that a node costs as its rows and not as all its bins."""
    m, p = len(first), x.shape[1]
    gain, col, cut, left = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros((m, 3))
    step = max(1, CELLS // (p * most * 4))
    for i in range(0, m, step):
        at = first[i:i + step, None] + np.arange(most)
        here = np.arange(most) < size[i:i + step, None]
        at = np.where(here, at, first[i:i + step, None])
        key = np.where(here[:, :, None], x[at].astype(np.int32), 1 << 9).transpose(0, 2, 1) * most + np.arange(most, dtype=np.int32)
        key.sort(axis=2)                                      # nodes x columns x rows, rows that are none last
        bins, place = key // most, key % most
        ls = np.empty((*key.shape[:2], most - 1, 3))
        for k in range(3):
            v = np.where(here, sums[at, k], 0.0)
            ls[..., k] = np.cumsum(v[np.arange(len(v))[:, None, None], place], 2)[..., :-1]
        total = totals[i:i + step, None, None, :]
        right = total - ls
        g = part_score(rule, ls[..., 1], ls[..., 2]) + part_score(rule, right[..., 1], right[..., 2]) - part_score(rule, total[..., 1], total[..., 2])
        ok = (bins[..., :-1] < bins[..., 1:]) & (bins[..., 1:] < 1 << 9) & (ls[..., 0] >= rule.least_rows) & (right[..., 0] >= rule.least_rows)
        if rule.score == "newton":
            ok &= (ls[..., 2] >= rule.least_b) & (right[..., 2] >= rule.least_b)
        g = np.where(ok, g, -np.inf)
        scale = part_score(rule, totals[i:i + step, 1], totals[i:i + step, 2])
        c = first_best(g, scale[:, None])
        g = np.take_along_axis(g, c[..., None], 2)[..., 0]
        f = first_best(g, scale)
        n = np.arange(len(f))
        c = c[n, f]
        gain[i:i + step], col[i:i + step], cut[i:i + step], left[i:i + step] = g[n, f], f, bins[n, f, c], ls[n, f, c]
    return gain, col, cut, left


def _best_cuts(rule: Rule, width: int, x, sums, node, m, totals):
    """Of m nodes, the large ones by bins, the small ones by rows, in classes of like size."""
    first = np.searchsorted(node, np.arange(m + 1))
    size, first = np.diff(first), first[:-1]
    gain, col, cut, left = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros((m, 3))
    low = 1
    for most in (*SMALL, 1 << 62):
        some = np.flatnonzero((size > low) & (size <= most))
        low = most
        if not len(some):
            continue
        if most <= SMALL[-1]:
            got = _cuts_in_rows(rule, x, sums, first[some], size[some], most, totals[some])
        else:
            place = np.full(m, -1)
            place[some] = np.arange(len(some))
            at = place[node]
            rows = at >= 0
            got = _cuts_in_bins(rule, width, x[rows], sums[rows], at[rows], len(some), totals[some])
        gain[some], col[some], cut[some], left[some] = got
    return gain, col, cut, left


def _level_best(rule: Rule, bins: Bins, tree: int, x, sums, node, m, paths, totals):
    """For each of m nodes: (gain, feature, bin, left sums) over all features. Rows are sorted by node."""
    return _best_cuts(rule, bins.width, x, sums, node, m, totals)


def _level_drawn(rule: Rule, bins: Bins, tree: int, x, sums, node, m, paths, totals):
    """The same over the features that each node draws; nodes without a cut that is worth something draw the next ones."""
    gain, feat, cut, left = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros((m, 3))
    p, todo, turn = x.shape[1], np.arange(m), 0
    order = np.argsort(_draw(rule.seed, tree, paths[:, None], np.arange(p)[None, :]), axis=1, kind="stable")
    while len(todo) and turn * rule.tries < p:
        pos = np.full(m, -1)
        pos[todo] = np.arange(len(todo))
        rows = np.flatnonzero(pos[node] >= 0)
        at = pos[node[rows]]
        feats = order[todo, turn * rule.tries:(turn + 1) * rule.tries]
        g, c, t, s = _best_cuts(rule, bins.width, x[rows[:, None], feats[at]], sums[rows], at, len(todo), totals[todo])
        gain[todo], feat[todo], cut[todo], left[todo] = g, feats[np.arange(len(todo)), c], t, s
        todo = todo[~rule.splits(g)]
        turn += 1
    return gain, feat, cut, left


def _level_random(rule: Rule, bins: Bins, tree: int, x, sums, node, m, paths, totals):
    """The same with one random cut of each drawn feature; nodes without a valid cut draw the next features."""
    gain, feat, cut, left = np.full(m, -np.inf), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros((m, 3))
    p, todo, turn = x.shape[1], np.arange(m), 0
    while len(todo) and turn * rule.tries < p:
        pos = np.full(m, -1)
        pos[todo] = np.arange(len(todo))
        rows = np.flatnonzero(pos[node] >= 0)
        at = pos[node[rows]]
        starts = np.searchsorted(at, np.arange(len(todo)))
        feats = features_of(rule, tree, paths[todo], p, np.full(len(todo), turn))
        v = np.take_along_axis(x[rows], np.maximum(feats, 0)[at], 1).astype(np.int64)
        low, high = np.minimum.reduceat(v, starts, 0), np.maximum.reduceat(v, starts, 0)
        t = random_bins(rule, bins, tree, paths[todo][:, None], feats, low, high)
        goes = v <= t[at]
        ls = np.stack([np.add.reduceat(goes * sums[rows, k][:, None], starts, 0) for k in range(3)], -1)
        rs = totals[todo][:, None, :] - ls
        g = (part_score(rule, ls[..., 1], ls[..., 2]) + part_score(rule, rs[..., 1], rs[..., 2]) - part_score(rule, totals[todo, 1], totals[todo, 2])[:, None])
        ok = (low < high) & (feats >= 0) & (ls[..., 0] >= rule.least_rows) & (rs[..., 0] >= rule.least_rows)
        g = np.where(ok, g, -np.inf)
        k = first_best(g, part_score(rule, totals[todo, 1], totals[todo, 2]))
        here = np.arange(len(todo))
        gain[todo], feat[todo], cut[todo], left[todo] = g[here, k], feats[here, k], t[here, k], ls[here, k]
        todo = todo[~np.isfinite(gain[todo])]
        turn += 1
    return gain, feat, cut, left


def grow_levels(rule: Rule, bins: Bins, tree: int, path: int, depth: int, x: np.ndarray, sums: np.ndarray) -> _Nodes:
    """The whole subtree above the rows x with their (rows, a, b), all nodes of a level at once."""
    feature, cuts, lefts, gains = ([np.array([v])] for v in (-1, 0, -1, 0.0))
    all_sums, all_paths, count = [sums.sum(0)[None]], [np.array([path], np.uint64)], 1
    level = np.array([0])                                     # places within the last arrays
    node = np.zeros(len(x), np.int64)
    choose = (_level_drawn if rule.best else _level_random) if rule.tries else _level_best
    while len(level):
        totals, paths = all_sums[-1][level], all_paths[-1][level]
        keep = ~_done(rule, totals, depth)
        renamed = np.cumsum(keep) - 1
        rows = keep[node]
        x, sums, node = x[rows], sums[rows], renamed[node[rows]]
        level, totals, paths = level[keep], totals[keep], paths[keep]
        if not len(level):
            break
        gain, feat, cut, left = choose(rule, bins, tree, x, sums, node, len(level), paths, totals)
        good = rule.splits(gain)
        made = int(good.sum())
        at = level[good]
        feature[-1][at], cuts[-1][at], gains[-1][at] = feat[good], cut[good], gain[good]
        lefts[-1][at] = count + 2 * np.arange(made)
        count += 2 * made
        for out, v, d in ((feature, -1, np.int64), (cuts, 0, np.int64), (lefts, -1, np.int64), (gains, 0.0, np.float64)):
            out.append(np.full(2 * made, v, d))
        all_sums.append(np.stack([left[good], totals[good] - left[good]], 1).reshape(-1, 3))
        with np.errstate(over="ignore"):
            all_paths.append((paths[good][:, None] * np.uint64(2) + np.array([1, 2], np.uint64)).ravel())
        first = 2 * (np.cumsum(good) - 1)
        rows = good[node]
        x, sums, node = x[rows], sums[rows], node[rows]
        child = first[node] + (x[np.arange(len(x)), feat[node]] > cut[node])
        order = np.argsort(child, kind="stable")
        x, sums, node, level = x[order], sums[order], child[order], np.arange(2 * made)
        depth += 1
    out = _Nodes()
    out.feature, out.bin, out.left, out.gain, out.path, out.sums = (np.concatenate(v) for v in (feature, cuts, lefts, gains, all_paths, all_sums))
    return out


def grow_best_first(rule: Rule, bins: Bins, path: int, depth: int, x: np.ndarray, sums: np.ndarray) -> _Nodes:
    """The subtree above the rows x by best-first splits up to rule.leaves leaves. Only the smaller child of a split is
    counted, the other one's histogram is its parent's less that."""
    width = bins.width
    out = _Nodes()
    out.add(sums.sum(0), path)
    columns, parts = [np.ascontiguousarray(x[:, f]).astype(np.int64) for f in range(x.shape[1])], [np.ascontiguousarray(sums[:, k]) for k in range(3)]
    best = {}

    def histogram(rows):
        h = np.empty((len(columns), width, 3))
        weights = [s[rows] for s in parts]
        for f, c in enumerate(columns):
            at = c[rows]
            for k in range(3):
                h[f, :, k] = np.bincount(at, weights[k], width)
        return h

    def look(node, rows, h, d):
        if _done(rule, np.asarray(out.sums[node]), d):
            return
        gain, at, left = best_bins(rule, h)
        f = int(first_best(gain, part_score(rule, *np.asarray(out.sums[node])[1:])))
        if gain[f] > rule.gain:
            best[node] = (float(gain[f]), f, int(at[f]), left[f], rows, h, d)

    rows = np.arange(len(x))
    look(0, rows, histogram(rows), depth)
    for _ in range(rule.leaves - 1):
        if not best:
            break
        node = max(best, key=lambda i: (best[i][0], -i))
        gain, f, cut, left, rows, h, d = best.pop(node)
        a = out.split(node, f, cut, left, gain)
        right = columns[f][rows] > cut
        sides = rows[~right], rows[right]
        small = int(len(sides[1]) < len(sides[0]))
        hs = [None, None]
        hs[small] = histogram(sides[small])
        hs[1 - small] = h - hs[small]
        for side in (0, 1):
            look(a + side, sides[side], hs[side], d + 1)
    return out


def grow_symmetric(rule: Rule, bins: Bins, x: np.ndarray, sums: np.ndarray) -> _Nodes:
    """A tree with one split for all nodes of a level, rule.depth levels at most."""
    width = bins.width
    out = _Nodes()
    out.add(sums.sum(0), 0)
    level, node = [0], np.zeros(len(x), np.int64)
    h = _histograms(x, sums, node, 1, width)
    for d in range(rule.depth):
        split = symmetric_split(rule, h)
        if split is None:
            break
        f, cut, left, gain = split
        level = [c for i, n in enumerate(level) for a in [out.split(n, f, cut, left[i], gain)] for c in (a, a + 1)]
        side = x[:, f] > cut
        if d + 1 < rule.depth:                                # of two children the smaller one is counted, the other is the rest
            small = (2 * left[:, 0] > h[:, 0, :, 0].sum(1)).astype(np.int64)
            rows = np.flatnonzero(side == small[node])
            part = _histograms(x[rows], sums[rows], node[rows], len(small), width)
            pair = np.stack([part, h - part], 1)
            pair[small == 1] = pair[small == 1][:, ::-1]
            h = pair.reshape(-1, *h.shape[1:])
        node = 2 * node + side
    return out


def symmetric_split(rule: Rule, h: np.ndarray):
    """(feature, bin, left sums of each node, gain) of the cut with the largest summed gain over all nodes of h[nodes, features, bins, 3]."""
    left = np.cumsum(h, axis=2)[:, :, :-1]
    total = h[:, :1].sum(axis=2)[:, :, None, :]
    right = total - left
    gain = (part_score(rule, left[..., 1], left[..., 2]) + part_score(rule, right[..., 1], right[..., 2]) - part_score(rule, total[..., 1], total[..., 2])).sum(0)
    parts = ((left[..., 0] > 0) & (right[..., 0] > 0)).any(0)
    gain = np.where(parts, gain, -np.inf)
    scale = part_score(rule, total[:, 0, 0, 1], total[:, 0, 0, 2]).sum()
    f, cut = np.unravel_index(first_best(gain.ravel(), scale), gain.shape)
    return (int(f), int(cut), left[:, f, cut], float(gain[f, cut])) if gain[f, cut] > rule.gain else None


# ---- passes over the binned rows --------------------------------------------

def _by_node(at: np.ndarray, nodes) -> Iterator[tuple[int, np.ndarray]]:
    """(node, places) of the rows that lie in one of `nodes`."""
    here = np.flatnonzero(np.isin(at, list(nodes)))
    order = here[np.argsort(at[here], kind="stable")]
    cuts = np.flatnonzero(np.diff(at[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(at[part[0]]), part


@dataclass
class Rows:
    """What a pass reads: `table` has x (bins as bytes) and other columns, from which `sums(batch, tree)` makes
    the (rows, a, b) of each row; rows of 0 are not in the tree. alone: the table is one partition that one task can hold."""
    table: DataFrame
    bins: Bins
    sums: object
    alone: bool = False
    parts: int = field(default=0)

    def __post_init__(self):
        self.parts = self.parts or int(self.table.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@dataclass
class _Growing:
    nodes: _Nodes
    open: dict[int, int]                # node -> depth
    turn: dict[int, int] = field(default_factory=dict)


def _total(col: pa.ChunkedArray) -> np.ndarray:
    """The sum of histograms, in an order that does not depend on their arrival."""
    return sum(np.frombuffer(v, np.float64) for v in sorted(col.to_pylist()))


def _histogram_pass(rows: Rows, rule: Rule, growing: dict[int, _Growing], big: list[tuple[int, int]]) -> dict[tuple[int, int], list]:
    """Candidates (feature, gain, bin, left sums) of each open node in `big`."""
    bins, sums_of, p = rows.bins, rows.sums, len(rows.bins.cuts)
    width = bins.width
    plan = {}
    for t, n in big:
        g = growing[t]
        f = (features_of(rule, t, np.array([g.nodes.path[n]], np.uint64), p, np.array([g.turn.get(n, 0)]))[0] if rule.tries else np.arange(p))
        plan.setdefault(t, {})[n] = f[f >= 0]
    trees = {t: growing[t].nodes.tree(rule) for t in plan}
    paths = {(t, n): growing[t].nodes.path[n] for t, n in big}
    sent = rows.table.sparkSession.sparkContext.broadcast((trees, plan, paths))        # at most OPEN nodes and the trees above them

    def count(batches):
        trees, plan, _ = sent.value
        held = {}
        for b in batches:
            x = _bytes(b.column(b.schema.get_field_index("x")), p)
            for t, tree in trees.items():
                s = sums_of(b, t)
                for n, here in _by_node(np.where(s[:, 0] > 0, tree.leaves(x), -1), plan[t]):
                    h = _histograms(np.ascontiguousarray(x[here][:, plan[t][n]]), s[here], np.zeros(len(here), np.int64), 1, width)[0]
                    held[t, n] = held[t, n] + h if (t, n) in held else h
        for (t, n), h in held.items():
            f = plan[t][n]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), t)), pa.array(np.full(len(f), n)), pa.array(f.astype(np.int64)), pa.array([c.tobytes() for c in h], pa.binary())],
                                             ["tree", "node", "feature", "h"])

    def choose(key, table):
        t, n, f = (k.as_py() for k in key)
        h = _total(table.column("h")).reshape(width, 3)
        if rule.tries is None or rule.best:
            gain, cut, left = (v[0] for v in best_bins(rule, h[None]))
        else:
            used = np.flatnonzero(h[:, 0] > 0)
            low, high = used[:1], used[-1:]
            cut = random_bins(rule, bins, t, np.array([sent.value[2][t, n]], np.uint64), np.array([f]), low, high)[0]
            left = h[:cut + 1].sum(0)
            right = h.sum(0) - left
            gain = float(part_score(rule, left[1], left[2]) + part_score(rule, right[1], right[2]) - part_score(rule, *h.sum(0)[1:]))
            if low[0] >= high[0] or left[0] < rule.least_rows or right[0] < rule.least_rows:
                gain = -np.inf
        return pa.table({"tree": [t], "node": [n], "feature": [f], "gain": [float(gain)], "bin": [int(cut)], "left": [[float(v) for v in left]]})

    got = (rows.table.mapInArrow(count, "tree long, node long, feature long, h binary").repartition(rows.parts, "tree", "node", "feature")
           .groupBy("tree", "node", "feature").applyInArrow(choose, "tree long, node long, feature long, gain double, bin long, left array<double>"))
    found = {}
    for r in got.collect():                                   # a row for each open node and feature
        found.setdefault((r.tree, r.node), []).append((r.feature, r.gain, r.bin, np.array(r.left)))
    if rule.tries:                                            # in the order in which the node drew them
        for (t, n), c in found.items():
            order = {f: i for i, f in enumerate(plan[t][n].tolist())}
            c.sort(key=lambda v: order[v[0]])
    else:
        for c in found.values():
            c.sort()
    sent.destroy()
    return found


_SUBTREE = "tree long, node long, feature binary, bin binary, left binary, sums binary, gain binary, value binary, gains binary"


def _finish_pass(rows: Rows, rule: Rule, growing: dict[int, _Growing]) -> dict[tuple[int, int], _Nodes | Tree]:
    """The subtrees of all open nodes, each grown in one task from its gathered rows: nodes with sums and gains where
    best-first or symmetric growth needs them (few by the rule), else plain trees (as many nodes as rows)."""
    few = bool(rule.leaves or rule.symmetric)
    bins, sums_of, p = rows.bins, rows.sums, len(rows.bins.cuts)
    plan = {t: dict(g.open) for t, g in growing.items() if g.open}
    trees = {t: growing[t].nodes.tree(rule) for t in plan}
    paths = {(t, n): growing[t].nodes.path[n] for t in plan for n in plan[t]}
    sent = rows.table.sparkSession.sparkContext.broadcast((trees, plan, paths))

    def gather(batches):
        trees, plan, _ = sent.value
        def rows_of(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                                              ["tree", "node", "x", "s"])
        for b in batches:
            x = _bytes(b.column(b.schema.get_field_index("x")), p)
            out, held = [], 0
            for t, tree in trees.items():
                s = sums_of(b, t)
                for n, here in _by_node(np.where(s[:, 0] > 0, tree.leaves(x), -1), plan[t]):
                    out.append((t, n, x[here].tobytes(), s[here].tobytes()))
                    held += len(here) * (p + 24)
                    if held > SENT:
                        yield rows_of(out)
                        out, held = [], 0
            if out:
                yield rows_of(out)

    def grown(t, n, parts):
        parts = sorted(parts)                                 # sums do not depend on the order of arrival
        x = np.concatenate([np.frombuffer(r, np.uint8) for _, r in parts]).reshape(-1, p)
        s = np.concatenate([np.frombuffer(r, np.float64) for r, _ in parts]).reshape(-1, 3)
        _, plan, paths = sent.value
        if rule.symmetric:
            got = grow_symmetric(rule, bins, x, s)
        elif rule.leaves:
            got = grow_best_first(rule, bins, paths[t, n], plan[t][n], x, s)
        else:
            got = grow_levels(rule, bins, t, paths[t, n], plan[t][n], x, s)
        cols = {"feature": (got.feature, np.int32), "bin": (got.bin, np.int16), "left": (got.left, np.int32), "sums": (got.sums if few else [], np.float64),
                "gain": (got.gain if few else [], np.float64), "value": ([] if few else got.tree(rule).value, np.float64), "gains": ([] if few else got.gains(p), np.float64)}
        return {"tree": [t], "node": [n], **{k: pa.array([np.array(v, d).tobytes()], pa.binary()) for k, (v, d) in cols.items()}}

    def grow(key, table):
        return pa.table(grown(*(k.as_py() for k in key), zip(table.column("s").to_pylist(), table.column("x").to_pylist(), strict=True)))

    def grow_here(batches):
        held = {}
        for b in gather(batches):
            for t, n, x, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.setdefault((t, n), []).append((s, x))
        for (t, n), parts in held.items():
            yield pa.RecordBatch.from_pydict(grown(t, n, parts))

    if rows.alone:                                            # one partition, which one task holds: nothing to shuffle
        done = rows.table.mapInArrow(grow_here, _SUBTREE)
    else:
        done = (rows.table.mapInArrow(gather, "tree long, node long, x binary, s binary")
                .repartition(max(1, min(rows.parts, len(paths))), "tree", "node").groupBy("tree", "node").applyInArrow(grow, _SUBTREE))
    out = {}
    for r in done.collect():                                  # a row for each open node, with its nodes
        if not few:
            out[r.tree, r.node] = Tree(*(np.frombuffer(v, d) for v, d in ((r.feature, np.int32), (r.bin, np.int16), (r.left, np.int32), (r.value, np.float64), (r.gains, np.float64))))
            continue
        g = _Nodes()
        g.feature, g.bin, g.left = (np.frombuffer(v, d).tolist() for v, d in ((r.feature, np.int32), (r.bin, np.int16), (r.left, np.int32)))
        g.sums, g.gain = list(np.frombuffer(r.sums, np.float64).reshape(-1, 3)), np.frombuffer(r.gain, np.float64).tolist()
        out[r.tree, r.node] = g
    sent.destroy()
    return out


def _graft(nodes: _Nodes, at: int, sub: _Nodes, leaves: int | None = None) -> None:
    """Put the nodes of `sub` in the place of the leaf `at`."""
    shift = len(nodes.feature) - 1                            # node k > 0 of the subtree becomes shift + k
    nodes.feature[at], nodes.bin[at], nodes.gain[at] = sub.feature[0], sub.bin[0], sub.gain[0]
    nodes.left[at] = sub.left[0] + shift if sub.left[0] >= 0 else -1
    nodes.sums[at] = sub.sums[0]
    nodes.feature += sub.feature[1:]
    nodes.bin += sub.bin[1:]
    nodes.left += [v + shift if v >= 0 else -1 for v in sub.left[1:]]
    nodes.sums += sub.sums[1:]
    nodes.gain += sub.gain[1:]
    nodes.path += [0] * (len(sub.feature) - 1)


def root_sums(rows: Rows, trees: list[int]) -> dict[int, np.ndarray]:
    """(rows, a, b) of all rows of each tree."""
    sums_of = rows.sums

    def add(batches):
        total = np.zeros((len(trees), 3))
        for b in batches:
            total += np.array([sums_of(b, t).sum(0) for t in trees])
        yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int64()), *[pa.array(total[:, k]) for k in range(3)]], ["tree", "n", "a", "b"])
    got = rows.table.mapInArrow(add, "tree long, n double, a double, b double").groupBy("tree").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")]).collect()
    return {r.tree: np.array([r.n, r.a, r.b]) for r in got}


def grow_forest(rows: Rows, rule: Rule, trees: list[int], roots: dict[int, np.ndarray], finish: int = FINISH) -> list[_Nodes]:
    """Trees over the rows; `roots`: the (rows, a, b) of each tree. Best-first trees are grown to rule.leaves leaves in
    every part first and cut back to the splits of largest gain by `pruned`."""
    size = len(rows.bins.cuts) + 24                           # bytes of a gathered row
    growing = {}
    for t in trees:
        nodes = _Nodes()
        nodes.add(np.asarray(roots[t], np.float64), 0)
        growing[t] = _Growing(nodes, {0: 0} if not _done(rule, np.asarray(roots[t]), 0) else {})
    while True:
        big = [(t, n) for t, g in growing.items() for n in g.open if g.nodes.sums[n][0] * size > finish][:OPEN]
        if not big:
            break
        found = _histogram_pass(rows, rule, growing, big)
        for t, n in big:
            g = growing[t]
            some = found.get((t, n), [])
            best = some[int(first_best(np.array([c[1] for c in some]), part_score(rule, *np.asarray(g.nodes.sums[n])[1:])))] if some else None
            if best is None or not rule.splits(best[1]):
                g.turn[n] = g.turn.get(n, 0) + 1
                if rule.tries is None or g.turn[n] * rule.tries >= len(rows.bins.cuts):
                    del g.open[n]
                continue
            f, gain, cut, left = best
            a = g.nodes.split(n, f, cut, left, gain)
            d = g.open.pop(n) + 1
            for c in (a, a + 1):
                if not _done(rule, np.asarray(g.nodes.sums[c]), d):
                    g.open[c] = d
        if rule.leaves:
            for g in growing.values():
                _close_hopeless(g, rule)
    if any(g.open for g in growing.values()):
        for (t, n), sub in sorted(_finish_pass(rows, rule, growing).items()):
            if isinstance(sub, Tree):
                growing[t].nodes.subs[n] = sub
            else:
                _graft(growing[t].nodes, n, sub)
    return [pruned(growing[t].nodes, rule.leaves) if rule.leaves else growing[t].nodes for t in trees]


def _best_first(nodes: _Nodes, leaves: int) -> list[int]:
    """The nodes that best-first growth splits, in its order."""
    order, ready = [], [0] if nodes.feature[0] >= 0 else []
    while ready and len(order) < leaves - 1:
        n = max(ready, key=lambda i: (nodes.gain[i], -i))
        ready.remove(n)
        order.append(n)
        ready += [c for c in (nodes.left[n], nodes.left[n] + 1) if nodes.feature[c] >= 0]
    return order


def _close_hopeless(g: _Growing, rule: Rule) -> None:
    """Open nodes below a split that best-first growth does not reach any more need no growing: the splits it makes
    among those known so far already fill the leaves before the way to them opens."""
    order = _best_first(g.nodes, rule.leaves)
    if len(order) < rule.leaves - 1:
        return
    reached = {c for n in order for c in (g.nodes.left[n], g.nodes.left[n] + 1)} | {0}
    for n in list(g.open):
        if n not in reached:
            del g.open[n]


def pruned(nodes: _Nodes, leaves: int) -> _Nodes:
    """The tree of the first leaves - 1 splits by largest gain, each after its parent's."""
    out = _Nodes()
    out.add(nodes.sums[0], 0)
    place = {0: 0}
    for n in _best_first(nodes, leaves):
        a = nodes.left[n]
        b = out.split(place[n], nodes.feature[n], nodes.bin[n], nodes.sums[a], nodes.gain[n])
        out.sums[b + 1] = nodes.sums[a + 1]
        place[a], place[a + 1] = b, b + 1
    return out


def grow_symmetric_tree(rows: Rows, rule: Rule, root: np.ndarray, finish: int = FINISH) -> _Nodes:
    """A symmetric tree: in one task where all rows fit it, else a histogram pass for each level, whose sums meet by feature."""
    nodes = _Nodes()
    nodes.add(np.asarray(root, np.float64), 0)
    if root[0] * (len(rows.bins.cuts) + 24) <= finish:
        return _finish_pass(rows, rule, {0: _Growing(nodes, {0: 0})}).get((0, 0), nodes)
    level = [0]
    for _ in range(rule.depth):
        got = _symmetric_pass(rows, rule, nodes.tree(rule), level)
        scale = sum(float(part_score(rule, *np.asarray(nodes.sums[n])[1:])) for n in level)
        best = got[int(first_best(np.array([r.gain for r in got]), scale))]
        if not np.isfinite(best.gain):
            break
        left = np.array(best.left).reshape(-1, 3)
        level = [c for i, n in enumerate(level) for a in [nodes.split(n, best.feature, best.bin, left[i], best.gain)] for c in (a, a + 1)]
    return nodes


def _symmetric_pass(rows: Rows, rule: Rule, tree: Tree, level: list[int]) -> list:
    """The best common cut of each feature for all nodes of a level, by feature."""
    p, width, sums_of, m = len(rows.bins.cuts), rows.bins.width, rows.sums, len(level)
    sent = rows.table.sparkSession.sparkContext.broadcast((tree, level))

    def count(batches):
        tree, level = sent.value
        place = np.full(len(tree.feature), -1)
        place[level] = np.arange(m)
        h = np.zeros((m, p, width, 3))
        for b in batches:
            x = _bytes(b.column(b.schema.get_field_index("x")), p)
            h += _histograms(x, sums_of(b, 0), place[tree.leaves(x)], m, width)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p)), pa.array([h[:, f].tobytes() for f in range(p)], pa.binary())], ["feature", "h"])

    def choose(key, table):
        got = symmetric_split(rule, _total(table.column("h")).reshape(m, 1, width, 3))
        _, cut, left, gain = got if got else (0, 0, np.zeros((m, 3)), -np.inf)
        return pa.table({"feature": [key[0].as_py()], "gain": [gain], "bin": [cut], "left": [left.ravel().tolist()]})

    got = (rows.table.mapInArrow(count, "feature long, h binary").repartition(rows.parts, "feature").groupBy("feature")
           .applyInArrow(choose, "feature long, gain double, bin long, left array<double>").orderBy("feature").collect())      # a row for each feature
    sent.destroy()
    return got


# ---- scoring ---------------------------------------------------------------

@dataclass
class Ensemble:
    """Trees over bins: base + scale * sum of the leaf values."""
    bins: Bins
    trees: list[Tree]
    base: float = 0.0
    scale: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for t in self.trees:
            out += t.value[t.leaves(x)]
        return self.base + self.scale * out

    def column(self, df: DataFrame, features: Column) -> Column:
        """The sum for an array column, as a pandas UDF over Arrow batches."""
        sent = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(v: pd.Series) -> pd.Series:
            e = sent.value
            return pd.Series(e.raw(e.bins.of(np.stack(v.to_numpy()).astype(np.float64))) if len(v) else np.zeros(0))
        return score(features)

    def rows(self) -> Iterator[dict]:
        """The model as table rows: cuts of each feature (tree -1), and the nodes of each tree."""
        for j, c in enumerate(self.bins.cuts):
            yield {"tree": -1, "part": j, "feature": [self.bins.keep[j] if self.bins.keep else j], "bin": [], "left": [], "value": c.tolist()}
        for i, t in enumerate(self.trees):
            yield {"tree": i, "part": 0, "feature": t.feature.tolist(), "bin": t.bin.tolist(), "left": t.left.tolist(), "value": t.value.tolist()}

    SCHEMA = "tree int, part int, feature array<int>, bin array<int>, left array<int>, value array<double>"

    @staticmethod
    def of(rows, base: float, scale: float) -> Ensemble:
        rows = sorted(rows, key=lambda r: (r["tree"], r["part"]))
        cuts = [np.array(r["value"], np.float64) for r in rows if r["tree"] < 0]
        keep = [r["feature"][0] for r in rows if r["tree"] < 0]
        trees = [Tree(np.array(r["feature"], np.int32), np.array(r["bin"], np.int16), np.array(r["left"], np.int32), np.array(r["value"], np.float64)) for r in rows if r["tree"] >= 0]
        return Ensemble(Bins(cuts, keep), trees, base, scale)
