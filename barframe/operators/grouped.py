"""Models of many groups (symbols, or one pooled panel) fitted side by side.

Rows are packed once into *blocks*: up to about ``BLOCK_ROWS`` rows of one group with
their features as one matrix. A large group has many blocks, so it spreads over
tasks; a small one is one row. Every row carries two bit masks: the *fits* whose
training set it belongs to (train, train + validation, the early part of either,
the folds of a cross-validation) and the fits that *score* it. One pass over the
blocks therefore serves all fits of all groups.

Linear models (logistic regression, squared-hinge SVM on random Fourier features)
are fitted by Newton steps. A pass sums loss, gradient and Hessian per (group, fit)
inside each task, a grouped aggregate adds the tasks' sums up, and the step is
solved where the sums are: one small system per (group, fit), distributed like the
groups. Only the question whether a fit is still open comes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage, discard

#: Rows of a block, about: 5 MB of 40 features.
BLOCK_ROWS = 16384
#: Bytes of sums that a task holds before it hands them out.
HELD = 64 << 20
#: Share of a fit's sessions that trains the margins whose calibration the later ones fit.
EARLY = 0.8

#: The fits of a split: on train, on train + validation, and on the early part of either. Folds follow.
TRAIN, FINAL, EARLY_TRAIN, EARLY_FINAL, FOLD = 0, 1, 2, 3, 4


def _bit(fit: int) -> Column:
    return F.lit(1 << fit).cast("bigint")


def with_masks(split_df: DataFrame, group: str, n_splits: int = 0) -> DataFrame:
    """Adds ``fits`` and ``scored`` to rows with (group, date, split).

    Positions count a group's sessions, so a session never straddles two parts
    also where several symbols share a group. Validation rows are scored by the
    fit on train, test rows by the fit on train + validation, the later part of a
    training set by the fit on its early part, and the block of fold k by fit
    FOLD + k - 1, which trains on the sessions before it."""
    cal = split_df.where("split IS NOT NULL").select(group, "date", "split").distinct()
    of = Window.partitionBy(group)
    cal = cal.select(group, "date", "split", (F.row_number().over(of.orderBy("date")) - 1).alias("pos"),
                     F.count_if(F.col("split") == "train").over(of).alias("n_train"),
                     F.count_if(F.col("split") != "test").over(of).alias("n_fit"))
    pos, train, fit_row = F.col("pos"), F.col("split") == "train", F.col("split") != "test"
    cuts = {EARLY_TRAIN: (train, F.floor(F.col("n_train") * F.lit(EARLY))), EARLY_FINAL: (fit_row, F.floor(F.col("n_fit") * F.lit(EARLY)))}
    zero = F.lit(0).cast("bigint")
    fits = [F.when(train, _bit(TRAIN)), F.when(fit_row, _bit(FINAL))]
    scored = [F.when(F.col("split") == "validation", _bit(TRAIN)), F.when(F.col("split") == "test", _bit(FINAL))]
    for k, (rows, cut) in cuts.items():
        fits.append(F.when(rows & (pos < cut), _bit(k)))
        scored.append(F.when(rows & (pos >= cut), _bit(k)))
    step = F.floor(F.col("n_train") / F.lit(n_splits + 1))
    for k in range(n_splits):
        start = F.col("n_train") - F.lit(n_splits - k) * step
        fits.append(F.when(train & (pos < start), _bit(FOLD + k)))
        scored.append(F.when(train & (pos >= start) & (pos < start + step), _bit(FOLD + k)))

    def joined(bits: list[Column]) -> Column:
        out = zero
        for b in bits:
            out = out.bitwiseOR(F.coalesce(b, zero))
        return out
    return split_df.join(cal.select(group, "date", joined(fits).alias("fits"), joined(scored).alias("scored")), [group, "date"])


# ---------------------------------------------------------------------------
# blocks
# ---------------------------------------------------------------------------
BLOCK = "grp string, block bigint, n int, x binary, y binary, fits binary, scored binary, key binary, symbols array<string>, dates array<bigint>"


def _pack(features: list[str]):
    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        x = np.column_stack([table.column(f).to_numpy().astype(np.float64) for f in features])
        raw = {k: table.column(k).to_numpy().astype(t).tobytes() for k, t in (("y", np.int8), ("fits", np.int64), ("scored", np.int64), ("key", np.int64))}
        return pa.table({"grp": table.column("grp").slice(0, 1), "block": table.column("block").slice(0, 1), "n": pa.array([table.num_rows], pa.int32()), "x": pa.array([x.tobytes()], pa.binary()),
                         **{k: pa.array([v], pa.binary()) for k, v in raw.items()},
                         "symbols": pa.array([table.column("symbol").to_pylist()], pa.list_(pa.string())), "dates": pa.array([table.column("date").to_pylist()], pa.list_(pa.int64()))})
    return pack


def feature_blocks(rows: DataFrame, features: list[str], group: str, target: str = C.TARGET_COLUMN) -> DataFrame:
    """Written blocks of rows with (symbol, date, fits, scored, target, features). Rows of no fit and no score are left out."""
    rows = rows.where("fits <> 0 OR scored <> 0").select(
        F.col(group).cast("string").alias("grp"), "symbol", F.unix_micros(F.col("date").cast("timestamp")).alias("date"), "fits", "scored",
        F.col(target).cast("int").alias("y"), F.xxhash64("symbol", F.col("date").cast("timestamp")).alias("key"), *[F.col(f).cast("double").alias(f) for f in features])
    sizes = rows.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).alias("blocks"))
    dealt = rows.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks"))).drop("blocks")
    return cut_lineage(dealt.groupBy("grp", "block").applyInArrow(_pack(features), BLOCK), "blocks")


def floats(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(n, -1)


def longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


# ---------------------------------------------------------------------------
# sums of arrays per (group, fit)
# ---------------------------------------------------------------------------
class Sums:
    """Arrays added up by key inside a task, handed out before they take too much memory."""

    def __init__(self):
        self.held, self.bytes = {}, 0

    def add(self, key: tuple, value: np.ndarray) -> None:
        if key in self.held:
            self.held[key] += value
        else:
            self.held[key] = value
            self.bytes += value.nbytes

    def out(self) -> Iterator[pa.RecordBatch]:
        for (grp, fit), v in self.held.items():
            yield pa.RecordBatch.from_arrays([pa.array([grp]), pa.array([fit], pa.int32()), pa.array([v], pa.list_(pa.float64()))], names=["grp", "fit", "v"])
        self.held, self.bytes = {}, 0


SUM = "grp string, fit int, v array<double>"


def summed(partial: DataFrame) -> DataFrame:
    """(grp, fit, v) rows -> their elementwise sums, combined before the shuffle; v has the length of one model."""
    cells = partial.select("grp", "fit", F.posexplode("v").alias("i", "s")).groupBy("grp", "fit", "i").agg(F.sum("s").alias("s"))
    return cells.groupBy("grp", "fit").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda c: c["s"]).alias("v"))


def _sum_blocks(work):
    """mapInArrow over blocks with a list of models: work(batch columns of one block, model) -> array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            for b in batch.to_pylist():
                for m in b["models"]:
                    inside = longs(b["fits"]) >> m["fit"] & 1 == 1
                    if inside.any():
                        sums.add((b["grp"], m["fit"]), work(floats(b["x"], b["n"])[inside], np.frombuffer(b["y"], np.int8)[inside].astype(np.float64), m))
                if sums.bytes > HELD:
                    yield from sums.out()
        yield from sums.out()
    return run


# ---------------------------------------------------------------------------
# linear models by Newton steps
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Linear:
    """A linear model: its loss, inverse regularisation and the random features it sees."""

    key: str
    loss: str = "log"           # log or squared_hinge
    c: float = C.LOGISTIC_C
    balanced: bool = True
    components: int = 0         # random Fourier features of an RBF kernel with gamma = 1 / inputs
    steps: int = 50
    tol: float = 1e-8

    def design(self, x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
        z = (x - mean) / sd
        if self.components:
            rng, d = np.random.default_rng(C.RANDOM_STATE), z.shape[1]
            w = rng.normal(0.0, math.sqrt(2.0 / d), (d, self.components))
            z = math.sqrt(2.0 / self.components) * np.cos(z @ w + rng.uniform(0.0, 2 * math.pi, self.components))
        return np.c_[z, np.ones(len(z))]

    def sums(self, x: np.ndarray, y: np.ndarray, m: dict) -> np.ndarray:
        """[loss, gradient, upper triangle of the Hessian] of the rows, without the penalty."""
        z, beta = self.design(x, np.array(m["mean"]), np.array(m["sd"])), np.array(m["beta"])
        sign, weight = 2 * y - 1, np.where(y == 1, m["w1"], m["w0"])
        t = sign * (z @ beta)
        if self.loss == "log":
            p = 1 / (1 + np.exp(np.clip(t, -500, 500)))  # chance of the other class
            loss, slope, bend = np.logaddexp(0, -t), -p * sign, p * (1 - p)
        else:
            a = np.maximum(0.0, 1 - t)
            loss, slope, bend = a * a, -2 * a * sign, 2.0 * (a > 0)
        h = (z * (weight * bend)[:, None]).T @ z
        return np.concatenate(([weight @ loss], z.T @ (weight * slope), h[np.triu_indices(len(beta))]))

    def step(self, m: dict, v: np.ndarray) -> dict:
        """The model after a Newton step, halved where the last one overshot."""
        beta, k = np.array(m["beta"]), len(m["beta"])
        penalty = np.r_[np.full(k - 1, 1.0 / self.c if math.isfinite(self.c) else 0.0), 0.0]
        loss = v[0] + 0.5 * (penalty * beta * beta).sum()
        grad = v[1:k + 1] + penalty * beta
        out = dict(m, steps=m["steps"] + 1)
        if np.abs(grad).max() < self.tol * m["n"]:
            return dict(out, status="fitted")
        if out["steps"] > self.steps:
            return dict(out, status="fitted")  # as an iteration limit does
        if m["loss"] is not None and loss > m["loss"] + 1e-9 * abs(m["loss"]):
            return dict(out, beta=((beta + np.array(m["before"])) / 2).tolist())
        h = np.zeros((k, k))
        h[np.triu_indices(k)] = v[k + 1:]
        h = h + np.triu(h, 1).T + np.diag(penalty + 1e-10 * m["n"] / k)
        return dict(out, before=beta.tolist(), loss=float(loss), beta=(beta - np.linalg.solve(h, grad)).tolist())


LOGISTIC = Linear("logistic_regression")
SVM = Linear("rff_svm", loss="squared_hinge", c=1.0, components=200, tol=1e-5)
PLATT = Linear("platt", c=math.inf, balanced=False)

STATE = ("grp string, fit int, n double, w0 double, w1 double, mean array<double>, sd array<double>, beta array<double>, before array<double>, "
         "loss double, steps int, status string")


def _start(spec: Linear):
    """(grp, fit, v): counts and moments -> the models before the first step, or why there is none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                d = (len(r["v"]) - 2) // 2
                n, up = r["v"][:2]
                mean = np.array(r["v"][2:2 + d])
                sd = np.sqrt(np.array(r["v"][2 + d:]) / max(n - 1, 1))
                sd[sd == 0] = 1.0
                one = up == 0 or up == n
                w0, w1 = (1.0, 1.0) if one or not spec.balanced else (n / (2 * (n - up)), n / (2 * up))
                k = (spec.components or d) + 1
                out.append({"grp": r["grp"], "fit": r["fit"], "n": n, "w0": w0, "w1": w1, "mean": mean.tolist(), "sd": sd.tolist(), "beta": [0.0] * k, "before": [0.0] * k,
                            "loss": None, "steps": 0, "status": "one class only in the fit rows" if one else None})
            yield _state_batch(out)
    return run


def _state_batch(rows: list[dict]) -> pa.RecordBatch:
    many = pa.list_(pa.float64())
    return pa.RecordBatch.from_pylist(rows, pa.schema([("grp", pa.string()), ("fit", pa.int32()), ("n", pa.float64()), ("w0", pa.float64()), ("w1", pa.float64()), ("mean", many), ("sd", many),
                                                       ("beta", many), ("before", many), ("loss", pa.float64()), ("steps", pa.int32()), ("status", pa.string())]))


def _stepped(spec: Linear):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                v = r.pop("v")
                out.append(spec.step(r, np.array(v)) if v is not None else r)
            yield _state_batch(out)
    return run


def _with_models(blocks: DataFrame, state: DataFrame, *columns: str) -> DataFrame:
    """Blocks with their group's models in one list (one entry per fit)."""
    models = state.groupBy("grp").agg(F.collect_list(F.struct(*[c for c in state.columns if c != "grp"])).alias("models"))
    return blocks.select("grp", *columns).join(models, "grp")


def fit_linear(blocks: DataFrame, spec: Linear, fits: list[int]) -> DataFrame:
    """The fitted models (``STATE`` rows) of every (group, fit) that has rows."""
    wanted = blocks.select("grp").distinct().select("grp", F.explode(F.array(*[F.lit(f).cast("int") for f in fits])).alias("fit"))
    rows = ("n", "x", "y", "fits")

    def count(x, y, m):
        return np.concatenate(([len(y), y.sum()], x.sum(0)))

    def spread(x, y, m):
        return ((x - np.array(m["mean"])) ** 2).sum(0)
    first = cut_lineage(summed(_with_models(blocks, wanted, *rows).mapInArrow(_sum_blocks(count), SUM)), "sums")
    means = first.select("grp", "fit", F.transform(F.slice("v", F.lit(3), F.size("v")), lambda s: s / F.element_at("v", 1)).alias("mean"),
                         F.slice("v", 1, 2).alias("counts"))
    second = summed(_with_models(blocks, means.drop("counts"), *rows).mapInArrow(_sum_blocks(spread), SUM)).withColumnRenamed("v", "squares")
    moments = means.join(second, ["grp", "fit"]).select("grp", "fit", F.concat("counts", "mean", "squares").alias("v"))
    state = cut_lineage(moments.mapInArrow(_start(spec), STATE), "models")
    discard(first)
    while True:
        open_ = state.where("status IS NULL")
        if open_.isEmpty():
            return state
        sums = summed(_with_models(blocks, open_.select("grp", "fit", "w0", "w1", "mean", "sd", "beta"), *rows).mapInArrow(_sum_blocks(spec.sums), SUM))
        done, state = state, cut_lineage(state.join(sums, ["grp", "fit"], "left").select(*state.columns, "v").mapInArrow(_stepped(spec), STATE), "models")
        discard(done)


SCORE = "grp string, symbol string, date bigint, fit int, y int, score double"


def score_linear(blocks: DataFrame, state: DataFrame, spec: Linear) -> DataFrame:
    """(grp, symbol, date, fit, y, score) of every row that a fitted model scores; score is the margin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                for m in b["models"]:
                    at = np.flatnonzero(longs(b["scored"]) >> m["fit"] & 1)
                    if not len(at):
                        continue
                    margin = spec.design(floats(b["x"], b["n"])[at], np.array(m["mean"]), np.array(m["sd"])) @ np.array(m["beta"])
                    yield scored_rows(b, at, m["fit"], margin)
    fitted = state.where("status = 'fitted'").select("grp", "fit", "mean", "sd", "beta")
    return _with_models(blocks, fitted, "n", "x", "y", "scored", "symbols", "dates").mapInArrow(run, SCORE)


def scored_rows(b: dict, at: np.ndarray, fit: int, score: np.ndarray) -> pa.RecordBatch:
    y = np.frombuffer(b["y"], np.int8)[at].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array([b["grp"]] * len(at)), pa.array([b["symbols"][i] for i in at], pa.string()), pa.array([b["dates"][i] for i in at], pa.int64()),
                                       pa.array([fit] * len(at), pa.int32()), pa.array(y), pa.array(score)], names=["grp", "symbol", "date", "fit", "y", "score"])


def probability(margin="score") -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(margin)))


def predictions(scores: DataFrame, date_type: str, spec_key: str) -> DataFrame:
    """(grp, symbol, date, model_key, fit, y, p_up) of scores that are probabilities."""
    return scores.select("grp", "symbol", F.timestamp_micros("date").cast(date_type).alias("date"), F.lit(spec_key).alias("model_key"), "fit", "y", F.col("score").alias("p_up"))


def logistic(blocks: DataFrame, fits: list[int], spec: Linear = LOGISTIC) -> tuple[DataFrame, DataFrame]:
    """((grp, symbol, date, fit, y, score) with probabilities, the models)."""
    state = fit_linear(blocks, spec, fits)
    return score_linear(blocks, state, spec).withColumn("score", probability()), state


def svm(blocks: DataFrame, spec: Linear = SVM) -> tuple[DataFrame, DataFrame]:
    """Margins of the random-feature SVM for the fits TRAIN and FINAL as probabilities.

    The sigmoid of a fit is fitted on the sessions after those that trained the margins
    of its early part, so it sees margins as unseen rows have them."""
    state = fit_linear(blocks, spec, [TRAIN, FINAL, EARLY_TRAIN, EARLY_FINAL])
    margins = cut_lineage(score_linear(blocks, state, spec), "margins")
    late = margins.where(F.col("fit").isin(EARLY_TRAIN, EARLY_FINAL))
    full = F.when(F.col("fit") == EARLY_TRAIN, F.lit(TRAIN)).otherwise(F.lit(FINAL)).cast("int")
    # each calibration is a fit of its own group, as its margins come from another model
    rows = late.select(F.concat_ws("|", "grp", full.cast("string")).alias("of"), "symbol", F.timestamp_micros("date").alias("date"), _bit(TRAIN).alias("fits"),
                       F.lit(0).cast("bigint").alias("scored"), F.col("y").alias("target"), F.col("score").alias("margin"))
    sigmoid = fit_linear(feature_blocks(rows, ["margin"], "of", "target"), PLATT, [TRAIN])
    curve = sigmoid.where("status = 'fitted'").select(F.regexp_extract("grp", "^(.*)\\|", 1).alias("grp"), F.regexp_extract("grp", "\\|(\\d+)$", 1).cast("int").alias("fit"),
                                                      (F.get("beta", 0) / F.get("sd", 0)).alias("a"), (F.get("beta", 1) - F.get("beta", 0) * F.get("mean", 0) / F.get("sd", 0)).alias("b"))
    out = margins.where(F.col("fit").isin(TRAIN, FINAL)).join(curve, ["grp", "fit"]).withColumn("score", F.col("a") * F.col("score") + F.col("b"))
    return out.withColumn("score", probability()).select("grp", "symbol", "date", "fit", "y", "score"), state
