"""Forests and boosted trees of many groups, grown level by level from histograms.

Features are cut into bins once per (group, fit). To grow a level, every task adds up,
for each open node, three sums per (feature, bin) over its blocks (``Sums``); the sums are
dealt by (group, fit, model, tree, node), added up across tasks, and the best split of
each node is read off them in the same pass. The splits are a small table that is joined
back to the blocks as the model so far. All trees of a forest grow together, so a
forest takes one pass a level. Boosting adds a tree per round, for all groups, fits and
models at once; the margins of all rows are written every ``KEEP`` rounds, and in between
a pass adds the few trees since then.

A (group, fit) of one block (``grouped.BLOCK_ROWS`` rows at most, about) has all its rows in
one place already: the same steps run there without an exchange, so the passes above are
only for groups of several blocks. Both ways give the same trees.

A split's worth is A_l**2 / (B_l + l2) + A_r**2 / (B_r + l2) - A**2 / (B + l2): with class
weights as B this is the Gini gain of a forest, with counts the gain in squared error of
gradient boosting, with second derivatives that of regularised boosting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.segments import dealt
from ..session import cut_lineage, discard
from .grouped import HELD, SCORE, floats, longs, scored_rows

#: Cuts of a feature's values, at its quantiles.
BINS = 32
#: Rounds of boosting between two written margins.
KEEP = 16
#: Trees of a forest whose histograms are held together.
TREES_AT_ONCE = 100


@dataclass(frozen=True)
class Trees:
    """One kind of ensemble. ``number`` tells it apart in the tables."""

    key: str
    number: int
    trees: int
    depth: int
    least: float            # of rows in a leaf, or of second derivatives (``hessian``)
    boosted: bool
    rate: float = 1.0
    rows: float = 1.0       # share of the rows of a tree
    columns: float = 1.0    # share of the features of a tree
    per_node: int = 0       # features drawn for a node, 0 for all
    hessian: bool = False   # splits by second derivatives with l2
    l2: float = 0.0


FOREST = Trees("random_forest", 0, 400, 6, 25, False, per_node=-1)
GRADIENT = Trees("gradient_boosting", 1, 200, 3, 25, True, rate=0.03, rows=0.8)
COLSAMPLE = Trees("boosted_trees_colsample", 2, 300, 3, 10, True, rate=0.03, rows=0.8, columns=0.8, hessian=True, l2=2.0)

SPLIT = "grp string, fit int, model int, tree int, node int, feature int, bin int, gain double, value double, left double, right double"


# ---------------------------------------------------------------------------
# random draws that depend on nothing but their names
# ---------------------------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def uniform(keys: np.ndarray, *names: int) -> np.ndarray:
    """A number in [0, 1) for each key, by the draw's names."""
    seed = C.RANDOM_STATE
    for n in names:
        seed = int(_mix(np.array([(seed ^ (n + 1) * 0x9E3779B97F4A7C15) % (1 << 64)], np.uint64))[0])
    return (_mix(keys.view(np.uint64) ^ np.uint64(seed)) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def poisson(u: np.ndarray) -> np.ndarray:
    """Poisson(1) draws: how often a row enters a tree's sample."""
    p, total, out = np.exp(-1.0), np.exp(-1.0), np.zeros(len(u))
    for k in range(1, 12):
        out += u >= total
        p /= k
        total += p
    return out


def drawn_features(spec: Trees, tree: int, nodes: np.ndarray, d: int) -> np.ndarray:
    """(len(nodes), k): the features that each node may split on, ascending."""
    k = max(1, int(np.sqrt(d))) if spec.per_node < 0 else spec.per_node or max(1, round(spec.columns * d))
    if k >= d:
        return np.tile(np.arange(d), (len(nodes), 1))
    names = np.arange(d, dtype=np.int64)
    if not spec.per_node:  # one draw for the whole tree
        return np.tile(np.sort(np.argsort(uniform(names, spec.number, tree, 7), kind="stable")[:k]), (len(nodes), 1))
    return np.stack([np.sort(np.argsort(uniform(names, spec.number, tree, 11, int(n)), kind="stable")[:k]) for n in nodes])


# ---------------------------------------------------------------------------
# bins
# ---------------------------------------------------------------------------
BINNED = "grp string, fit int, block bigint, n int, codes binary, y binary, inside binary, scored binary, key binary, symbols array<string>, dates array<bigint>"


def bin_edges(rows: DataFrame, features: list[str], group: str, fits: list[int]) -> DataFrame:
    """(grp, fit, edges): each feature's quantiles over the rows of a fit, by mergeable sketches. Value v has code #(edges < v)."""
    inside = rows.select(F.col(group).cast("string").alias("grp"), F.explode(F.array(*[F.lit(f).cast("int") for f in fits])).alias("fit"), "fits", *features)
    qs = [i / BINS for i in range(1, BINS)]
    found = inside.where(F.getbit("fits", "fit") == 1).groupBy("grp", "fit").agg(*[F.percentile_approx(F.col(f).cast("double"), qs, 10000).alias(f) for f in features])
    return found.select("grp", "fit", F.array(*[F.array_distinct(f) for f in features]).alias("edges"))


def binned(blocks: DataFrame, edges: DataFrame) -> DataFrame:
    """Written codes of every (block, fit); ``inside`` marks the fit's rows, ``scored`` those that it scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                x, fits, scored = floats(b["x"], b["n"]), longs(b["fits"]), longs(b["scored"])
                for m in b["models"]:
                    codes = np.column_stack([np.searchsorted(np.array(e), x[:, j], side="left") for j, e in enumerate(m["edges"])]).astype(np.uint8)
                    inside, mine = (fits >> m["fit"] & 1).astype(np.uint8), (scored >> m["fit"] & 1).astype(np.uint8)
                    if not (inside | mine).any():
                        continue
                    yield pa.RecordBatch.from_pylist([{"grp": b["grp"], "fit": m["fit"], "block": b["block"], "n": b["n"], "codes": codes.tobytes(), "y": b["y"], "inside": inside.tobytes(),
                                                       "scored": mine.tobytes(), "key": b["key"], "symbols": b["symbols"], "dates": b["dates"]}],
                                                     pa.schema([("grp", pa.string()), ("fit", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("codes", "y", "inside", "scored", "key")),
                                                                ("symbols", pa.list_(pa.string())), ("dates", pa.list_(pa.int64()))]))
    models = edges.groupBy("grp").agg(F.collect_list(F.struct("fit", "edges")).alias("models"))
    return cut_lineage(dealt(blocks.join(models, "grp").mapInArrow(run, BINNED), "grp", "fit", "block"), "binned")


# ---------------------------------------------------------------------------
# trees as arrays
# ---------------------------------------------------------------------------
class Tree:
    """A tree so far: of each node (1 the root, 2 i and 2 i + 1 the children of i) its split; leaf values of the children."""

    def __init__(self, rows: list[dict], depth: int):
        size = 1 << (depth + 1)
        self.feature, self.bin, self.value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        for r in rows:
            n = r["node"]
            if r["node"] == 1 and r["value"] is not None:
                self.value[1] = r["value"]
            if r["feature"] >= 0:
                self.feature[n], self.bin[n] = r["feature"], r["bin"]
                self.value[2 * n], self.value[2 * n + 1] = r["left"], r["right"]

    def nodes(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row has come to after ``levels`` splits, or earlier where there is none."""
        node, at = np.ones(len(codes), np.int64), np.arange(len(codes))
        for _ in range(levels):
            f = self.feature[node]
            go = codes[at, np.maximum(f, 0)] > self.bin[node]
            node = np.where(f >= 0, 2 * node + go, node)
        return node


def trees_of(rows: list[dict], depth: int) -> dict[int, Tree]:
    by: dict[int, list[dict]] = {}
    for r in rows:
        by.setdefault(r["tree"], []).append(r)
    return {t: Tree(r, depth) for t, r in by.items()}


# ---------------------------------------------------------------------------
# one level: histograms, then the best splits
# ---------------------------------------------------------------------------
HIST = "grp string, fit int, model int, tree int, node int, hist binary"


class _Hist:
    """Histograms (features x bins x 3) of nodes inside a task."""

    def __init__(self):
        self.held, self.bytes = {}, 0

    def add(self, key: tuple, hist: np.ndarray) -> None:
        if key in self.held:
            self.held[key] += hist
        else:
            self.held[key] = hist
            self.bytes += hist.nbytes

    def out(self) -> Iterator[pa.RecordBatch]:
        keys = list(self.held)
        for s in range(0, len(keys), 512):
            part = keys[s:s + 512]
            cols = list(zip(*part))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int32()) for c in cols[1:]),
                                              pa.array([self.held[k].tobytes() for k in part], pa.binary())], names=["grp", "fit", "model", "tree", "node", "hist"])
        self.held, self.bytes = {}, 0


def node_hists(spec: Trees, tree: int, level: int, codes: np.ndarray, node: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, histograms (nodes x features drawn x BINS x 3)) of the rows at the given level; stats: (rows, 3)."""
    at = np.flatnonzero(node >> level == 1)
    nodes, place = np.unique(node[at], return_inverse=True)
    if not len(nodes):
        return nodes, np.zeros((0, 0, BINS, 3))
    drawn = drawn_features(spec, tree, nodes, codes.shape[1])
    k = drawn.shape[1]
    cell = ((place[:, None] * k + np.arange(k)[None, :]) * BINS + codes[at[:, None], drawn[place]]).ravel()
    size = len(nodes) * k * BINS
    return nodes, np.stack([np.bincount(cell, np.repeat(stats[at, i], k), size) for i in range(3)], axis=-1).reshape(len(nodes), k, BINS, 3)


def best_split(spec: Trees, hist: np.ndarray) -> tuple[int, int, float]:
    """(place of the feature, bin, gain) of a node's histogram (features x BINS x 3); (-1, 0, 0) without a split. Ties go to the first."""
    total = hist[0].sum(0)
    left = hist.cumsum(1)[:, :-1]
    right = total - left
    worth = lambda s: np.divide(s[..., 0] ** 2, s[..., 1] + spec.l2, out=np.zeros(s.shape[:-1]), where=s[..., 1] + spec.l2 > 0)
    gain = worth(left) + worth(right) - worth(total)
    size = (1 if spec.boosted else 2)  # the sum that a leaf needs enough of
    ok = (left[..., size] >= spec.least - 1e-9) & (right[..., size] >= spec.least - 1e-9)
    gain = np.where(ok, gain, 0.0)
    top = gain.max(initial=0.0)
    if top <= 1e-12 * max(1.0, abs(float(worth(total)))):
        return -1, 0, 0.0
    f, b = np.unravel_index(np.argmax(gain >= top * (1 - 1e-10)), gain.shape)
    return int(f), int(b), float(gain[f, b])


def leaf(spec: Trees, s: np.ndarray) -> float:
    """A leaf's value from its sums (a, b, e)."""
    under = s[2] if spec.boosted and not spec.hessian else s[1] + spec.l2
    return float(spec.rate * s[0] / under) if under > 0 else 0.0


def split_of(spec: Trees, d: int, key: tuple, hist: np.ndarray) -> tuple:
    """The ``SPLIT`` row of a node, key (grp, fit, model, tree, node), from its histogram; feature -1 without a split."""
    f, b, gain = best_split(spec, hist)
    total = hist[0].sum(0)
    if f < 0:
        return (*key, -1, 0, 0.0, leaf(spec, total), None, None)
    low = hist[f, :b + 1].sum(0)
    feature = int(drawn_features(spec, key[3], np.array([key[4]]), d)[0, f])
    return (*key, feature, b, gain, leaf(spec, total), leaf(spec, low), leaf(spec, total - low))


SPLIT_NAMES = ["grp", "fit", "model", "tree", "node", "feature", "bin", "gain", "value", "left", "right"]


def split_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 11
    types = [pa.string()] + [pa.int32()] * 6 + [pa.float64()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=SPLIT_NAMES)


def grown(spec: Trees, grp: str, fit: int, tree: int, codes: np.ndarray, stats: np.ndarray, rows: np.ndarray) -> list[dict]:
    """``SPLIT`` rows of a tree whose rows are all here; ``rows`` masks those of its sample."""
    out: list[dict] = []
    for level in range(spec.depth):
        node = np.where(rows, Tree(out, spec.depth).nodes(codes, level), 0)
        nodes, hist = node_hists(spec, tree, level, codes, node, stats)
        if not len(nodes):
            break
        out += [dict(zip(SPLIT_NAMES, split_of(spec, codes.shape[1], (grp, fit, spec.number, tree, n), h))) for n, h in zip(nodes.tolist(), hist)]
    return out


def _splits(specs: dict[int, Trees], d: int):
    """Histogram rows in order of their keys -> the split of each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hist, out = None, None, []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in KEYS))
            for k, raw in zip(keys, batch.column("hist")):
                h = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, BINS, 3)
                if k == key:
                    hist = hist + h
                    continue
                if key is not None:
                    out.append(split_of(specs[key[2]], d, key, hist))
                key, hist = k, h
            if len(out) > 5000:
                yield split_batch(out)
                out = []
        if key is not None:
            out.append(split_of(specs[key[2]], d, key, hist))
        yield split_batch(out)
    return run


KEYS = ["grp", "fit", "model", "tree", "node"]


def split_table(hists: DataFrame, specs: list[Trees], d: int) -> DataFrame:
    """The best split of each node of the histograms, which are dealt by node; a task streams over its nodes."""
    n = int(hists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hists.repartition(n, *KEYS).sortWithinPartitions(*KEYS).mapInArrow(_splits({s.number: s for s in specs}, d), SPLIT)


def _known(splits: DataFrame | None, spark) -> DataFrame:
    """(grp, fit, splits): the trees so far of each (group, fit), of all models."""
    if splits is None:
        return spark.createDataFrame([], f"grp string, fit int, splits array<struct<{_TREE}>>")
    cells = F.struct("model", "tree", "node", "feature", "bin", "value", "left", "right")
    return splits.groupBy("grp", "fit").agg(F.collect_list(cells).alias("splits"))


_TREE = "model: int, tree: int, node: int, feature: int, bin: int, value: double, left: double, right: double"


# ---------------------------------------------------------------------------
# forest
# ---------------------------------------------------------------------------
def forest_stats(y: np.ndarray, counts: np.ndarray, share: float) -> np.ndarray:
    """(weight x y, weight, count) per row; ``share`` of the tree's whole sample goes up, and both classes weigh the same."""
    w = counts * (np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) if 0 < share < 1 else 1.0)
    return np.stack((w * y, w, counts), axis=1)


def _forest_hists(spec: Trees, level: int, first: int, last: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Hist()
        for batch in batches:
            for b in batch.to_pylist():
                inside = np.frombuffer(b["inside"], np.uint8) == 1
                codes, y, key = np.frombuffer(b["codes"], np.uint8).reshape(b["n"], -1)[inside], np.frombuffer(b["y"], np.int8)[inside].astype(float), longs(b["key"])[inside]
                known, share = trees_of(b["splits"] or [], spec.depth), dict(zip(b["trees"], b["up"]))
                for t in range(first, last):
                    counts = poisson(uniform(key, spec.number, t, 3))
                    tree = known.get(t)
                    node = np.ones(len(y), np.int64) if tree is None else tree.nodes(codes, level)
                    nodes, hist = node_hists(spec, t, level, codes, node, forest_stats(y, counts, share[t]))
                    for n, h in zip(nodes.tolist(), hist):
                        held.add((b["grp"], b["fit"], spec.number, t, n), h)
                if held.bytes > HELD:
                    yield from held.out()
        yield from held.out()
    return run


def _sample_shares(spec: Trees):
    """(grp, fit, tree, n, up): rows of each tree's sample, and those going up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                inside = np.frombuffer(b["inside"], np.uint8) == 1
                y, key = np.frombuffer(b["y"], np.int8)[inside].astype(float), longs(b["key"])[inside]
                draws = np.stack([poisson(uniform(key, spec.number, t, 3)) for t in range(spec.trees)])
                yield pa.RecordBatch.from_arrays([pa.array([b["grp"]] * spec.trees), pa.array([b["fit"]] * spec.trees, pa.int32()), pa.array(range(spec.trees), pa.int32()),
                                                  pa.array(draws.sum(1)), pa.array(draws @ y)], names=["grp", "fit", "tree", "n", "up"])
    return run


def _in_place_forest(spec: Trees):
    """Blocks that are a whole (group, fit), with the ``lot`` of trees to grow -> ``SPLIT`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                inside = np.frombuffer(b["inside"], np.uint8) == 1
                codes, y, key = np.frombuffer(b["codes"], np.uint8).reshape(b["n"], -1)[inside], np.frombuffer(b["y"], np.int8)[inside].astype(float), longs(b["key"])[inside]
                out = []
                for t in range(b["lot"], spec.trees, b["lots"]):
                    counts = poisson(uniform(key, spec.number, t, 3))
                    if counts.any():
                        out += grown(spec, b["grp"], b["fit"], t, codes, forest_stats(y, counts, (counts * y).sum() / counts.sum()), np.ones(len(y), bool))
                yield split_batch([tuple(r[n] for n in SPLIT_NAMES) for r in out])
    return run


def one_block(codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """codes of the (group, fit)s of one block, and of those of several."""
    single = cut_lineage(codes.groupBy("grp", "fit").agg(F.count(F.lit(1)).alias("k")).where("k = 1").select("grp", "fit"), "single")
    return codes.join(single, ["grp", "fit"], "left_semi"), codes.join(single, ["grp", "fit"], "left_anti")


#: Lots that a forest's trees are dealt into where they grow in place.
LOTS = 8


def fit_forest(codes: DataFrame, d: int, spec: Trees = FOREST) -> DataFrame:
    """``SPLIT`` rows of the forest of every (group, fit): depth passes for each lot of trees, or in place."""
    single, several = one_block(codes.select("grp", "fit", "block", "n", "codes", "y", "inside", "key"))
    lots = single.select("*", F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1))).alias("lot"), F.lit(LOTS).alias("lots"))
    whole = cut_lineage(dealt(lots, "grp", "fit", "lot").mapInArrow(_in_place_forest(spec), SPLIT), "splits")
    if several.isEmpty():
        return whole
    return whole.unionByName(_fit_forest_by_passes(several, d, spec))


def _fit_forest_by_passes(codes: DataFrame, d: int, spec: Trees) -> DataFrame:
    spark = codes.sparkSession
    counts = codes.select("grp", "fit", "n", "y", "inside", "key").mapInArrow(_sample_shares(spec), "grp string, fit int, tree int, n double, up double")
    counts = counts.groupBy("grp", "fit", "tree").agg(F.sum("n").alias("n"), F.sum("up").alias("up"))
    shares = cut_lineage(counts.groupBy("grp", "fit").agg(F.collect_list("tree").alias("trees"), F.collect_list(F.coalesce(F.try_divide("up", "n"), F.lit(0.0))).alias("up")), "shares")
    rows = codes.join(shares, ["grp", "fit"])
    made = []
    for first in range(0, spec.trees, TREES_AT_ONCE):
        lot: list[DataFrame] = []
        for level in range(spec.depth):
            known = _known(reduce(DataFrame.unionByName, lot).where("feature >= 0") if lot else None, spark)
            hists = rows.join(known, ["grp", "fit"], "left").mapInArrow(_forest_hists(spec, level, first, min(first + TREES_AT_ONCE, spec.trees)), HIST)
            lot.append(cut_lineage(split_table(hists, [spec], d), "splits"))
        made += lot
    discard(shares)
    return reduce(DataFrame.unionByName, made)


def score_forest(codes: DataFrame, splits: DataFrame, spec: Trees = FOREST) -> DataFrame:
    """(grp, symbol, date, fit, y, score): the mean of the trees' leaf shares over the rows that a fit scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(b["scored"], np.uint8))
                if not len(at):
                    continue
                mine = np.frombuffer(b["codes"], np.uint8).reshape(b["n"], -1)[at]
                trees = trees_of(b["splits"], spec.depth)
                p = sum(t.value[t.nodes(mine, spec.depth)] for t in trees.values()) / len(trees)
                yield scored_rows(b, at, b["fit"], p)
    return codes.select("grp", "fit", "n", "codes", "y", "scored", "symbols", "dates").join(_known(splits.where("feature >= 0 OR node = 1"), codes.sparkSession), ["grp", "fit"]).mapInArrow(run, SCORE)


# ---------------------------------------------------------------------------
# boosting
# ---------------------------------------------------------------------------
MARGIN = "grp string, fit int, model int, block bigint, margin binary"


def boosted_stats(spec: Trees, y: np.ndarray, margin: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """(residual, count or second derivative, second derivative) per row of the round's sample."""
    p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    h = p * (1 - p) * sample
    return np.stack(((y - p) * sample, h if spec.hessian else sample, h), axis=1)


def _margins(b: dict, spec: Trees, codes: np.ndarray) -> np.ndarray:
    """Margins of a block's rows: the written ones and the whole trees since then."""
    margin = np.frombuffer(b["margin"], np.float64).copy()
    for tree in trees_of([s for s in b["done"] or [] if s["model"] == spec.number], spec.depth).values():
        margin += tree.value[tree.nodes(codes, spec.depth)]
    return margin


def _boosted_hists(specs: dict[int, Trees], level: int, now: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Hist()
        for batch in batches:
            for b in batch.to_pylist():
                spec = specs.get(b["model"])
                if spec is None or level >= spec.depth:
                    continue
                inside = np.frombuffer(b["inside"], np.uint8) == 1
                codes = np.frombuffer(b["codes"], np.uint8).reshape(b["n"], -1)
                margin = _margins(b, spec, codes)[inside]
                codes, y = codes[inside], np.frombuffer(b["y"], np.int8)[inside].astype(float)
                sample = (uniform(longs(b["key"])[inside], spec.number, now, 5) < spec.rows).astype(float)
                tree = trees_of([s for s in b["growing"] or [] if s["model"] == spec.number], spec.depth).get(now) if level else None
                node = np.ones(len(y), np.int64) if tree is None else tree.nodes(codes, level)
                nodes, hist = node_hists(spec, now, level, codes, np.where(sample > 0, node, 0), boosted_stats(spec, y, margin, sample))
                for n, h in zip(nodes.tolist(), hist):
                    held.add((b["grp"], b["fit"], b["model"], now, n), h)
                if held.bytes > HELD:
                    yield from held.out()
        yield from held.out()
    return run


def _written_margins(specs: dict[int, Trees]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                codes = np.frombuffer(b["codes"], np.uint8).reshape(b["n"], -1)
                out.append((b["grp"], b["fit"], b["model"], b["block"], _margins(b, specs[b["model"]], codes).tobytes()))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["grp", "fit", "model", "block", "margin"])
    return run


def fit_boosted(codes: DataFrame, d: int, specs: list[Trees]) -> tuple[DataFrame, DataFrame]:
    """(``SPLIT`` rows, ``MARGIN`` rows at the end) of every (group, fit, model); all models grow in the same passes."""
    spark = codes.sparkSession
    by_number = {s.number: s for s in specs}

    def zero(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(grp, fit, block, n, share) -> margins of the prior, the log odds of the fit's rows."""
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                p = min(max(b["share"], 1e-12), 1 - 1e-12)
                out += [(b["grp"], b["fit"], s.number, b["block"], np.full(b["n"], 0.0 if s.hessian else np.log(p / (1 - p))).tobytes()) for s in specs]
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["grp", "fit", "model", "block", "margin"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = [np.frombuffer(r, np.uint8) for r in batch.column("inside").to_pylist()]
            up = [int((i * np.frombuffer(r, np.int8)).sum()) for i, r in zip(inside, batch.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("grp"), batch.column("fit"), pa.array([int(i.sum()) for i in inside]), pa.array(up)], names=["grp", "fit", "n", "up"])
    shares = (codes.select("grp", "fit", "y", "inside").mapInArrow(count, "grp string, fit int, n bigint, up bigint").groupBy("grp", "fit")
              .agg((F.sum("up") / F.sum("n")).alias("share")))
    margins = cut_lineage(codes.select("grp", "fit", "block", "n").join(shares, ["grp", "fit"]).mapInArrow(zero, MARGIN), "margins")
    single, several = one_block(codes.select("grp", "fit", "block", "n", "codes", "y", "inside", "key"))
    here = dealt(single.join(margins, ["grp", "fit", "block"]), "grp", "fit", "model", "block")
    done = cut_lineage(here.mapInArrow(_in_place_boosted(by_number), SPLIT + ", block bigint, margin binary"), "boosted")
    splits, ends = done.where("tree IS NOT NULL").drop("block", "margin"), done.where("tree IS NULL").select("grp", "fit", "model", "block", "margin")
    if several.isEmpty():
        return splits, ends
    more, late = _fit_boosted_by_passes(several, d, by_number, margins.join(several.select("grp", "fit").distinct(), ["grp", "fit"], "left_semi"))
    return splits.unionByName(more), ends.unionByName(late)


def _in_place_boosted(specs: dict[int, Trees]):
    """Blocks that are a whole (group, fit), with a model's prior margins -> ``SPLIT`` rows, and a last row with the margins at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                spec, inside = specs[b["model"]], np.frombuffer(b["inside"], np.uint8) == 1
                every = np.frombuffer(b["codes"], np.uint8).reshape(b["n"], -1)
                codes, y, key = every[inside], np.frombuffer(b["y"], np.int8)[inside].astype(float), longs(b["key"])[inside]
                margin, out = np.frombuffer(b["margin"], np.float64).copy(), []
                for now in range(spec.trees):
                    sample = (uniform(key, spec.number, now, 5) < spec.rows).astype(float)
                    rows = grown(spec, b["grp"], b["fit"], now, codes, boosted_stats(spec, y, margin[inside], sample), sample > 0)
                    tree = Tree(rows, spec.depth)
                    margin += tree.value[tree.nodes(every, spec.depth)]
                    out += [tuple(r[n] for n in SPLIT_NAMES) for r in rows]
                found = split_batch(out)
                found = found.append_column("block", pa.nulls(found.num_rows, pa.int64())).append_column("margin", pa.nulls(found.num_rows, pa.binary()))
                yield found
                last = split_batch([(b["grp"], b["fit"], b["model"], *[None] * 8)])
                yield last.append_column("block", pa.array([b["block"]], pa.int64())).append_column("margin", pa.array([margin.tobytes()], pa.binary()))
    return run


def _fit_boosted_by_passes(rows: DataFrame, d: int, specs: dict[int, Trees], margins: DataFrame) -> tuple[DataFrame, DataFrame]:
    spark, rounds = rows.sparkSession, max(s.trees for s in specs.values())
    margins = cut_lineage(margins, "margins")
    written: list[DataFrame] = []
    since: list[DataFrame] = []
    for now in range(rounds):
        active = {n: s for n, s in specs.items() if now < s.trees}
        done = _known(reduce(DataFrame.unionByName, since) if since else None, spark).withColumnRenamed("splits", "done")
        at = rows.join(margins.where(F.col("model").isin(list(active))), ["grp", "fit", "block"]).join(done, ["grp", "fit"], "left")
        levels: list[DataFrame] = []
        for level in range(max(s.depth for s in active.values())):
            known = _known(reduce(DataFrame.unionByName, levels) if levels else None, spark).withColumnRenamed("splits", "growing")
            hists = at.join(known, ["grp", "fit"], "left").mapInArrow(_boosted_hists(active, level, now), HIST)
            levels.append(cut_lineage(split_table(hists, list(active.values()), d), "level"))
        since += levels
        if (now + 1) % KEEP == 0 or now + 1 == rounds:
            trees = cut_lineage(reduce(DataFrame.unionByName, since).coalesce(1), "trees")
            for t in since:
                discard(t)
            written.append(trees)
            done = _known(trees, spark).withColumnRenamed("splits", "done")
            old, margins = margins, cut_lineage(rows.join(margins, ["grp", "fit", "block"]).join(done, ["grp", "fit"], "left").mapInArrow(_written_margins(specs), MARGIN), "margins")
            discard(old)
            since = []
    return reduce(DataFrame.unionByName, written), margins


def score_boosted(codes: DataFrame, margins: DataFrame) -> DataFrame:
    """(grp, symbol, date, fit, y, score, model) of the rows that a fit scores; score is a probability."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(b["scored"], np.uint8))
                if len(at):
                    out = scored_rows(b, at, b["fit"], 1 / (1 + np.exp(-np.frombuffer(b["margin"], np.float64)[at])))
                    yield out.append_column("model", pa.array([b["model"]] * len(at), pa.int32()))
    return codes.select("grp", "fit", "block", "n", "y", "scored", "symbols", "dates").join(margins, ["grp", "fit", "block"]).mapInArrow(run, SCORE + ", model int")


def importances(splits: DataFrame, features: list[str]) -> DataFrame:
    """(grp, fit, model, feature, importance): each feature's share of the gains of an ensemble's splits."""
    names = F.array(*[F.lit(f) for f in features])
    gains = splits.where("feature >= 0").groupBy("grp", "fit", "model", F.element_at(names, F.col("feature") + 1).alias("feature")).agg(F.sum("gain").alias("gain"))
    total = gains.groupBy("grp", "fit", "model").agg(F.sum("gain").alias("total"))
    return gains.join(total, ["grp", "fit", "model"]).select("grp", "fit", "model", "feature", F.try_divide("gain", "total").alias("importance"))
