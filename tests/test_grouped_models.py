"""Models of all symbols side by side: against plain fits, brute-force splits and MLlib."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barframe.operators import grouped as G
from barframe.operators import grouped_trees as T


# ---------------------------------------------------------------------------
# trees without Spark
# ---------------------------------------------------------------------------
def brute_split(spec, codes, stats, drawn):
    """Best (feature, bin) by trying every cut of every drawn feature."""
    def worth(s):
        return s[0] ** 2 / (s[1] + spec.l2) if s[1] + spec.l2 > 0 else 0.0
    size = 1 if spec.boosted else 2
    best = (0.0, -1, 0)
    total = stats.sum(0)
    for f in drawn:
        for b in range(T.BINS - 1):
            left = stats[codes[:, f] <= b].sum(0)
            right = total - left
            if left[size] < spec.least or right[size] < spec.least:
                continue
            gain = worth(left) + worth(right) - worth(total)
            if gain > best[0] * (1 + 1e-9) + 1e-12 * max(1.0, abs(worth(total))):
                best = (gain, f, b)
    return best


def brute_tree(spec, tree, codes, stats, node=1, depth=0):
    """{node: (feature, bin)} and {leaf: value}, depth first."""
    if depth == spec.depth:
        return {}, {node: T.leaf(spec, stats.sum(0))}
    drawn = T.drawn_features(spec, tree, np.array([node]), codes.shape[1])[0]
    gain, f, b = brute_split(spec, codes, stats, drawn)
    if f < 0:
        return {}, {node: T.leaf(spec, stats.sum(0))}
    splits, leaves = {node: (int(f), b)}, {}
    for side, child in ((codes[:, f] <= b, 2 * node), (codes[:, f] > b, 2 * node + 1)):
        s, v = brute_tree(spec, tree, codes[side], stats[side], child, depth + 1)
        splits.update(s)
        leaves.update(v)
    return splits, leaves


def data(seed, n=400, d=9):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[:, 3] = np.round(x[:, 3])  # few values
    y = (x[:, 0] + 0.5 * x[:, 1] * (x[:, 2] > 0) + rng.normal(size=n) > 0.2).astype(float)
    return x, y


@pytest.mark.parametrize("spec", [T.Trees("f", 0, 3, 4, 10, False, per_node=-1), T.Trees("g", 1, 3, 3, 12, True, rate=0.1),
                                  T.Trees("x", 2, 3, 3, 4, True, rate=0.1, columns=0.6, hessian=True, l2=2.0)])
def test_histogram_trees_equal_brute_force(spec):
    x, y = data(spec.number)
    codes = np.column_stack([np.searchsorted(np.quantile(c, np.arange(1, T.BINS) / T.BINS), c) for c in x.T]).astype(np.uint8)
    key = np.arange(len(y), dtype=np.int64) * 7919
    for tree in range(spec.trees):
        if spec.boosted:
            stats = T.boosted_stats(spec, y, x[:, 4] * 0.3, (T.uniform(key, spec.number, tree, 5) < 0.8).astype(float))
        else:
            counts = T.poisson(T.uniform(key, spec.number, tree, 3))
            stats = T.forest_stats(y, counts, (counts * y).sum() / counts.sum())
        rows = []
        split = T._splits({spec.number: spec}, x.shape[1])
        in_place = T.grown(spec, "s", 0, tree, codes, stats, np.ones(len(y), bool))
        for level in range(spec.depth):
            node = T.Tree(rows, spec.depth).nodes(codes, level)
            nodes, hist = T.node_hists(spec, tree, level, codes, node, stats)
            held = T._Hist()
            for n, h in zip(nodes.tolist(), hist):
                for part in (h * 0.25, h * 0.75):  # two tasks' shares
                    held.add(("s", 0, spec.number, tree, n), part)
            rows += [r for b in split(iter(sorted(held.out(), key=str))) for r in b.to_pylist()]
        want, leaves = brute_tree(spec, tree, codes, stats)
        assert {r["node"]: (r["feature"], r["bin"]) for r in rows if r["feature"] >= 0} == want
        for tree_rows in (rows, in_place):
            made = T.Tree(tree_rows, spec.depth)
            assert {r["node"]: (r["feature"], r["bin"]) for r in tree_rows if r["feature"] >= 0} == want
            for n, v in leaves.items():
                assert made.value[n] == pytest.approx(v, abs=1e-9)
            assert set(made.nodes(codes, spec.depth).tolist()) <= set(leaves)


def test_draws_are_fair():
    u = T.uniform(np.arange(200_000, dtype=np.int64), 1, 2, 3)
    assert abs(u.mean() - 0.5) < 0.005 and abs(u.std() - 12 ** -0.5) < 0.005
    counts = T.poisson(u)
    assert abs(counts.mean() - 1) < 0.02 and abs(counts.var() - 1) < 0.03
    again = T.uniform(np.arange(200_000, dtype=np.int64), 1, 3, 3)
    assert abs(np.corrcoef(u, again)[0, 1]) < 0.01


# ---------------------------------------------------------------------------
# linear steps without Spark
# ---------------------------------------------------------------------------
@pytest.mark.parametrize("spec", [G.LOGISTIC, G.Linear("h", loss="squared_hinge", c=1.0, tol=1e-7)])
def test_newton_reaches_the_minimum(spec):
    x, y = data(5)
    mean, sd, n, up = x.mean(0), x.std(0, ddof=1), len(y), y.sum()
    m = {"n": n, "w0": n / (2 * (n - up)), "w1": n / (2 * up), "mean": mean.tolist(), "sd": sd.tolist(), "beta": [0.0] * 10, "before": [0.0] * 10, "loss": None, "steps": 0, "status": None}
    while m["status"] is None:
        halves = [spec.sums(x[i::2], y[i::2], m) for i in range(2)]  # two tasks
        m = spec.step(m, halves[0] + halves[1])
    assert m["steps"] < spec.steps

    def objective(beta):
        z = spec.design(x, mean, sd)
        t = (2 * y - 1) * (z @ beta)
        loss = np.logaddexp(0, -t) if spec.loss == "log" else np.maximum(0, 1 - t) ** 2
        return (np.where(y == 1, m["w1"], m["w0"]) * loss).sum() + 0.5 / spec.c * (beta[:-1] ** 2).sum()
    best, rng = np.array(m["beta"]), np.random.default_rng(0)
    assert all(objective(best) <= objective(best + rng.normal(size=10) * s) for s in (1e-3, 1e-2, 0.1) for _ in range(20))


# ---------------------------------------------------------------------------
# with Spark
# ---------------------------------------------------------------------------
FEATS = ["f0", "f1", "f2", "f3", "f4"]
SMALL = dict(forest=T.Trees("random_forest", 0, 6, 3, 10, False, per_node=-1),
             boosted=(T.Trees("gradient_boosting", 1, 5, 3, 10, True, rate=0.3, rows=0.8), T.Trees("boosted_trees_colsample", 2, 7, 2, 4, True, rate=0.3, rows=0.8, columns=0.8, hessian=True, l2=2.0)),
             svm=G.Linear("rff_svm", loss="squared_hinge", c=1.0, components=40, tol=1e-5))


def split_rows(spark, symbols, n=260):
    """Rows of symbols with a chronological split; the label of ``FLAT`` never changes."""
    import datetime as dt
    rng, out = random.Random(3), []
    for s in symbols:
        for i in range(n):
            x = [rng.gauss(0, 1 + j) for j in range(5)]
            y = 1 if s == "FLAT" else int(x[0] - 0.4 * x[1] + (0.8 if x[2] > 0 else -0.3) + rng.gauss(0, 1) > 0)
            out.append((s, dt.date(2020, 1, 1) + dt.timedelta(days=i), "train" if i < 0.7 * n else "validation" if i < 0.85 * n else "test", y, *x))
    return spark.createDataFrame(out, "symbol string, date date, split string, target_up_next_day int, " + ", ".join(f"{f} double" for f in FEATS))


@pytest.fixture(scope="module", params=[70, 16384], ids=["several blocks", "one block"])
def swept(spark, request):
    from barframe.operators import sweep as S
    rows = split_rows(spark, ["A", "B", "C", "FLAT"])
    old, G.BLOCK_ROWS, T.KEEP, T.TREES_AT_ONCE = (G.BLOCK_ROWS, T.KEEP, T.TREES_AT_ONCE), request.param, 2, 4
    try:
        yield rows, S.sweep(rows, FEATS, n_splits=2, **SMALL)
    finally:
        G.BLOCK_ROWS, T.KEEP, T.TREES_AT_ONCE = old


def test_every_model_on_every_symbol(swept):
    from barframe.operators import sweep as S
    _, found = swept
    assert [(r.grp, r.failure) for r in found.failures.collect()] == [("FLAT", "one class only in the fit rows")]
    rows = {(r.grp, r.model_key): r for r in S.model_rows(found).collect()}
    assert set(rows) == {(s, k) for s in "ABC" for k in S.NAMES}
    for (_, k), r in rows.items():
        assert r.observations == 39 and 0 <= r.test_accuracy <= 1 and r.val_roc_auc is not None and r.fit_seconds > 0
        assert r.test_roc_auc > 0.6, k
        assert r.n_scored == (0 if k == "rff_svm" else 2)


def test_logistic_equals_mllib_also_on_folds(spark, swept):
    from barframe.operators import models as ML
    rows, found = swept
    mine = found.predictions.where("model_key = 'logistic_regression'")
    data = rows.withColumn("label", F.col("target_up_next_day").cast("double")).withColumn("i", F.datediff("date", F.lit("2020-01-01")))
    step = math.floor(182 / 3)
    for s in "ABC":
        cases = {G.FINAL: ("split <> 'test'", "split = 'test'")}
        if s == "A":
            cases[G.TRAIN] = ("split = 'train'", "split = 'validation'")
            for k in range(2):
                start = 182 - (2 - k) * step
                cases[G.FOLD + k] = (f"i < {start}", f"i >= {start} AND i < {start + step}")
        for fit, (train, test) in cases.items():
            train, test = data.where(F.col("symbol") == s).where(train), data.where(F.col("symbol") == s).where(test)
            model = ML._logistic(FEATS, train.count()).fit(ML.with_class_weights(train))
            want = {r.date: r.p_up for r in ML.probability_of_up(model.transform(test)).collect()}
            got = {r.date: r.p_up for r in mine.where((F.col("grp") == s) & (F.col("fit") == fit)).collect()}
            assert set(got) == set(want)
            assert max(abs(got[d] - want[d]) for d in want) < 2e-3, (s, fit)


def test_ensembles_equal_brute_force(swept):
    rows, found = swept
    masked = G.with_masks(rows.where("symbol IN ('A', 'B')"), "symbol", 2)
    blocks = G.feature_blocks(masked, FEATS, "symbol")
    assert (blocks.count() > 4) == (G.BLOCK_ROWS < 100)
    codes = T.binned(blocks, T.bin_edges(masked, FEATS, "symbol", [G.FINAL])).collect()
    keys = {s.number: s.key for s in (SMALL["forest"], *SMALL["boosted"])}
    got = {(r.grp, r.model_key, r.symbol, str(r.date)): r.p_up for r in found.predictions.where(F.col("fit") == G.FINAL).collect()}
    import datetime as dt
    for grp in "AB":
        part = [r for r in codes if r.grp == grp]
        c = np.concatenate([np.frombuffer(r.codes, np.uint8).reshape(r.n, -1) for r in part])
        y, inside, scored = (np.concatenate([np.frombuffer(getattr(r, k), t) for r in part]).astype(float) for k, t in (("y", np.int8), ("inside", np.uint8), ("scored", np.uint8)))
        key = np.concatenate([np.frombuffer(r.key, np.int64) for r in part])
        dates = [str((dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=d)).date()) for r in part for d in r.dates]
        at = np.flatnonzero(inside)

        def grown(spec, tree, stats):
            splits, leaves = brute_tree(spec, tree, c[at], stats)

            def value(row):
                node = 1
                while node in splits:
                    f, b = splits[node]
                    node = 2 * node + int(row[f] > b)
                return leaves[node]
            return np.array([value(r) for r in c])
        spec, votes = SMALL["forest"], []
        for t in range(spec.trees):
            counts = T.poisson(T.uniform(key[at], spec.number, t, 3))
            votes.append(grown(spec, t, T.forest_stats(y[at], counts, (counts * y[at]).sum() / counts.sum())))
        scores = {spec.key: np.mean(votes, axis=0)}
        for spec in SMALL["boosted"]:
            p = y[at].mean()
            margin = np.full(len(y), 0.0 if spec.hessian else math.log(p / (1 - p)))
            for t in range(spec.trees):
                sample = (T.uniform(key[at], spec.number, t, 5) < spec.rows).astype(float)
                margin = margin + grown(spec, t, T.boosted_stats(spec, y[at], margin[at], sample))
            scores[spec.key] = 1 / (1 + np.exp(-margin))
        for k, p in scores.items():
            for i in np.flatnonzero(scored):
                assert got[grp, k, grp, dates[i]] == pytest.approx(p[i], abs=1e-9), (grp, k)
    assert set(keys.values()) <= {k[1] for k in got}


def test_importances_are_shares(swept):
    _, found = swept
    shares = T.importances(found.trees, FEATS).groupBy("grp", "fit", "model").agg(F.sum("importance").alias("s"), F.max_by("feature", "importance").alias("top")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in shares) and {r.top for r in shares if r.fit == G.FINAL} <= {"f0", "f1", "f2"}


def test_panel_is_one_group(spark):
    """Two symbols in one group: a session stays in one part, and folds are cut on sessions."""
    rows = split_rows(spark, ["A", "B"], 60).withColumn("panel", F.lit("panel"))
    masked = G.with_masks(rows, "panel", 3).collect()
    assert len(masked) == 120
    by_day = {}
    for r in masked:
        by_day.setdefault(r.date, set()).add((r.fits, r.scored))
    assert all(len(v) == 1 for v in by_day.values())
    for r in masked:
        assert (r.fits >> G.TRAIN & 1) == (r.split == "train") and (r.scored >> G.FINAL & 1) == (r.split == "test")
        for f in range(G.FOLD + 3):
            assert not (r.fits >> f & 1 and r.scored >> f & 1)


def test_no_rows(spark):
    from barframe.operators import sweep as S
    found = S.sweep(split_rows(spark, ["A"], 30).limit(0), FEATS, models=("logistic_regression", "random_forest"), **SMALL)
    assert found.predictions.count() == 0 and S.model_rows(found).count() == 0
    with pytest.raises(KeyError, match="nope"):
        S.sweep(split_rows(spark, ["A"], 30), FEATS, models=("nope",))
