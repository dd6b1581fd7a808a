"""Exact top-k inner-product search by norm buckets.

Vectors are quantised to integers, grouped into buckets of similar length
(norm), and each query meets each bucket with its own threshold. A first pass
over the ``SEEDS`` longest vectors gives a query a lower bound of its k-th
score. Divided by the query's length and the bucket's largest length, that
bound becomes a local cosine threshold: above 1 the bucket is skipped; if it is
high, the ranges that it allows for the query's largest coordinates prune the
bucket's vectors (coordinate pruning); if it is low, only vectors too short to
reach the bound are cut (length pruning). What is left is verified by exact
integer products: floating ones where lengths show that they can't round, else
the floating score and its error bound choose the candidates, whose products are
made of Python integers. No pruning loses a result.

A bucket with many vectors is dealt out in parts of about ``PART`` vectors, and
queries in parts of ``QUERY_PART``, so one common length or vector splits over
tasks. A task keeps k rows per query; a window takes the best k of those.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows with a null id; repeated rows (same id and
vector) count once; a query meets only vectors of its own dimension; fewer than k
candidates give them all; equal scores go to the smaller id; a vector of length
2**63 or more after scaling (2**57 before) takes no part, as bigint doesn't hold it;
ranks are by the exact scores, a score that bigint doesn't hold is shown as its
nearest bigint; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.llm.common import materialise, read

K, EVERY, SCALE = 20, 20, 64
PART, QUERY_PART, SEEDS = 4096, 1024, 512
#: Buckets grow by this factor in length.
GROWTH = 1.05
#: From this local cosine threshold on, coordinates prune; below it, lengths do.
COORDINATE_FROM, FOCUS = 0.6, 6
#: Vectors are shorter than this, and products of lengths up to EXACT can't round.
LONGEST, EXACT = 2.0 ** 63, 2.0 ** 52
#: Slack against rounding where floating bounds prune; products are exact.
SLACK = 1e-9
#: A score is high * 2**63 + low.
LOW = (1 << 63) - 1

VECTOR = "vec_id bigint, dim int, norm double, v binary"


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, dims, norms, out = [], [], [], []
        for i, x in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            x = x.values
            if i is None or x is None or len(x) == 0 or x.null_count:
                continue
            x = x.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                v = np.floor(SCALE * x)
                norm = float(np.sqrt((v * v).sum()))
            if not norm < LONGEST:
                continue
            ids.append(i)
            dims.append(len(v))
            norms.append(norm)
            out.append(v.astype(np.int32 if norm < 2.0 ** 31 else np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()),
                                          pa.array(out, pa.binary())], names=["vec_id", "dim", "norm", "v"])


def _matrix(column, dim: int) -> np.ndarray:
    column = list(column)
    if all(len(v) == 4 * dim for v in column):
        return np.frombuffer(b"".join(column), np.int32).reshape(-1, dim).astype(np.float64)
    # the floor of a double is a double, so long vectors are exact as well
    return np.stack([np.frombuffer(v, np.int32 if len(v) == 4 * dim else np.int64).astype(np.float64) for v in column])


def _error(reach, dim: int):
    """Bound of the rounding of floating products of vectors whose lengths multiply to ``reach``."""
    return np.where(reach <= EXACT, 0.0, reach * (dim + 4) * 2.0 ** -51)


def _seed_bounds(seeds: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Adds ``bound``: no more than the k-th best score of a query among the longest vectors of its dimension."""
    norms = {d: np.sqrt((seed * seed).sum(1)) for d, (_, seed) in seeds.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("norm").to_numpy()
            dims, ids = batch.column("dim").to_numpy(), batch.column("vec_id").to_numpy()
            vs, bound = batch.column("v").to_pylist(), np.full(len(ids), -np.inf)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                seed_ids, seed = seeds.get(int(d), (None, None))
                if seed is None or len(seed_ids) <= k:
                    continue
                for s in range(0, len(at), QUERY_PART):
                    part = at[s:s + QUERY_PART]
                    score = _matrix([vs[i] for i in part], d) @ seed.T
                    score -= _error(lengths[part][:, None] * norms[int(d)][None, :], int(d))
                    score[ids[part][:, None] == seed_ids[None, :]] = -np.inf
                    bound[part] = np.partition(score, -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bound)], names=[*batch.schema.names, "bound"])
    return run


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, -k)[-k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _search(k: int):
    def run(key, queries: pa.Table, bucket: pa.Table) -> pa.Table:
        out = _Found(k)
        if queries.num_rows and bucket.num_rows:
            d = queries.column("dim")[0].as_py()
            q_ids, c_ids = queries.column("vec_id").to_numpy(), bucket.column("vec_id").to_numpy()
            q, c = (_matrix(t.column("v").to_pylist(), d) for t in (queries, bucket))
            q_norm, c_norm, bound = queries.column("norm").to_numpy(), bucket.column("norm").to_numpy(), queries.column("bound").to_numpy()
            longest = c_norm.max()
            reach = q_norm * longest
            with np.errstate(divide="ignore", invalid="ignore"):
                local = np.where(reach > 0, bound / reach, np.where(bound > 0, np.inf, -np.inf))
            alive = local <= 1 + SLACK
            tight = alive & (local >= COORDINATE_FROM)
            unit = c / np.maximum(c_norm, 1e-300)[:, None] if tight.any() else None
            for i in np.flatnonzero(tight):
                # the vector's direction must lie within the cosine threshold of the query's
                t, keep, dirn = min(local[i], 1.0), np.ones(len(c), bool), q[i] / q_norm[i]
                for f in np.argsort(-np.abs(dirn))[:FOCUS]:
                    keep &= (unit[:, f] >= _low(dirn[f], t) - SLACK) & (unit[:, f] <= _high(dirn[f], t) + SLACK)
                at = np.flatnonzero(keep & (c_ids != q_ids[i]))
                out.emit(q_ids[i], q[i], q_norm[i], q[i] @ c[at].T, c, c_norm, c_ids, at, bound[i])
            loose = np.flatnonzero(alive & ~tight)
            if len(loose):
                order = np.argsort(-c_norm, kind="stable")
                with np.errstate(divide="ignore", invalid="ignore"):
                    least = np.where(q_norm[loose] > 0, bound[loose] / q_norm[loose], -np.inf).min()
                order = order[:np.searchsorted(-c_norm[order], -(least * (1 - SLACK) if least > 0 else -np.inf), side="right")]
                scores = q[loose] @ c[order].T
                for i, row in zip(loose, scores):
                    other = c_ids[order] != q_ids[i]
                    out.emit(q_ids[i], q[i], q_norm[i], row[other], c, c_norm, c_ids, order[other], bound[i])
        return pa.table({"query_id": pa.array(out.q, pa.int64()), "vec_id": pa.array(out.i, pa.int64()),
                         "high": pa.array(out.high, pa.int64()), "low": pa.array(out.low, pa.int64())})
    return run


def _low(x: float, t: float) -> float:
    """Least coordinate of a unit vector whose cosine with one of coordinate x is t or more."""
    return -1.0 if x < -t else x * t - np.sqrt(max(0.0, (1 - x * x) * (1 - t * t)))


def _high(x: float, t: float) -> float:
    return 1.0 if x > t else x * t + np.sqrt(max(0.0, (1 - x * x) * (1 - t * t)))


class _Found:
    """The k best rows of each query in a block."""

    def __init__(self, k: int):
        self.k, self.q, self.i, self.high, self.low = k, [], [], [], []

    def emit(self, query, x, x_norm, scores, c, c_norm, c_ids, at, bound) -> None:
        """scores: the floating products of the query x with the rows ``at`` of c."""
        error = _error(x_norm * c_norm[at], len(x))
        keep = scores + error >= bound
        scores, at, error = scores[keep], at[keep], error[keep]
        if not error.any():
            best = _best(scores, c_ids[at], self.k)
            exact, ids = scores[best].astype(np.int64).tolist(), c_ids[at[best]].tolist()
        else:
            if len(at) > self.k:
                near = scores + error >= np.partition(scores - error, -self.k)[-self.k]
                at = at[near]
            left = [int(a) for a in x]
            ranked = sorted((-sum(a * int(b) for a, b in zip(left, c[j])), int(c_ids[j])) for j in at)[:self.k]
            exact, ids = [-s for s, _ in ranked], [i for _, i in ranked]
        self.q.extend([query] * len(ids))
        self.i.extend(ids)
        self.high.extend(s >> 63 for s in exact)
        self.low.extend(s & LOW for s in exact)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries whose id is divisible by ``every``, from (vec_id, embedding) rows."""
    rows = vectors.select("vec_id", "embedding").mapInArrow(_quantise, VECTOR).dropDuplicates(["vec_id", "v"])
    rows = materialise(rows.withColumn("bucket", F.when(F.col("norm") > 0, F.floor(F.log("norm") / float(np.log(GROWTH)))).otherwise(F.lit(-1))), "vectors")
    # One row per (dimension, bucket): lengths span a few hundred buckets at the most.
    sizes = rows.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("parts", F.ceil(F.col("n") / PART)).drop("n")
    dealt = rows.join(sizes, ["dim", "bucket"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))

    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    longest = rows.orderBy(F.col("norm").desc(), "vec_id").limit(SEEDS).select("vec_id", "dim", "v").collect()
    for d in {r["dim"] for r in longest}:
        own = {r["vec_id"]: bytes(r["v"]) for r in longest if r["dim"] == d}
        seeds[d] = (np.array(list(own), np.int64), _matrix(own.values(), d))

    queries = rows.where(F.col("vec_id") % every == 0).drop("bucket").mapInArrow(_seed_bounds(seeds, k), VECTOR + ", bound double")
    n_queries = rows.where(F.col("vec_id") % every == 0).count()
    q_parts = max(1, -(-n_queries // QUERY_PART))
    queries = queries.withColumn("q_part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(q_parts).cast("bigint")))

    # Blocks: every part of the queries meets every part of every bucket once.
    keys = ["dim", "bucket", "part", "q_part"]
    ids = sizes.select("dim", "bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    asked = queries.join(ids, "dim")
    held = dealt.select("dim", "bucket", F.col("part").cast("bigint"), "vec_id", "norm", "v", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(q_parts - 1).cast("bigint"))).alias("q_part"))
    found = (asked.groupBy(*keys).cogroup(held.groupBy(*keys))
             .applyInArrow(_search(k), "query_id bigint, vec_id bigint, high bigint, low bigint"))
    best = Window.partitionBy("query_id").orderBy(F.col("high").desc(), F.col("low").desc(), "vec_id")
    least = F.lit(-LOW - 1)
    score = F.when(F.col("high") == 0, F.col("low")).when(F.col("high") == -1, F.col("low") + least).when(F.col("high") > 0, F.lit(LOW)).otherwise(least)
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).withColumn("score", score)
            .select("query_id", "rank", "vec_id", "score"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector against all others."""
    return top_k(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


OP8_SQL = f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
