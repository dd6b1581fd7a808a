"""Vector codes by ball k-means: four codebooks of 256 integer entries, four rounds.

Every vector is quantised to integers and cut into ``PARTS`` parts; each part
position has its own codebook. An entry with the parts assigned to it is a ball:
its radius is the largest distance of such a part. Entries whose distance is more
than twice the radius can't take a part from it, so an entry's *neighbours* are
those within. Of a part at distance d from its entry, only entries within 2 d of
that entry can be as near (triangle inequality), which bounds its work:

* stable core: no other neighbour within 2 d, the part stays without a comparison;
  so does a whole ball that has no other neighbour, or where neither the entry
  nor a neighbour moved in the last round;
* annular ring: the parts whose 2 d lies between the gaps to the m-th and the
  next neighbour are compared with the first m neighbours exactly.

All of this is integer arithmetic (floating products only where they can't
round), and a gap of exactly 2 d is kept, so ties go to the lower index as if
every entry had been compared. The radius after an update is bounded by the old
radius plus the entry's step.

The vectors stay distributed. A round writes the assigned vectors once (its
predecessor is deleted then), sums them by part and entry inside the tasks, adds
those sums up by a grouped aggregate, and brings the at most PARTS * ENTRIES new
entries to the driver, a bound that doesn't grow with the table. A hot entry or
label is combined before its shuffle.

Defined cases: rows whose vector is null or holds a null or non-finite component
are dropped; so are empty vectors, and those whose dimension is not a multiple of
PARTS or not that of the smallest id's vector. Fewer than ENTRIES ids give fewer
entries. Of rows that repeat an id the one with the least bytes gives the entry;
each row is coded by its own vector. Rows with a null id are coded, and give no
entry at the start. Components so large that an error may not fit a bigint fail
the job with a message that names the id. An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm.common import materialise, read
from barframe.session import discard

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors that a task handles at a time.
BLOCK = 32768
#: Ring widths (numbers of neighbours) that are compared together.
RINGS = (1, 8, 32, 128, ENTRIES)
#: Floating products of integers below this can't round.
EXACT = 2 ** 53

VECTOR = "vec_id bigint, label int, dim int, v binary"
CODED = "vec_id bigint, label int, v binary, code binary"


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("embedding")
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten()
        x = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null turns NaN
        row = np.repeat(np.arange(len(sizes)), sizes)
        bad = np.zeros(len(sizes), bool)
        bad[row[~np.isfinite(x)]] = True
        keep = (sizes > 0) & (sizes % PARTS == 0) & ~bad
        ends = np.cumsum(sizes)
        ids, out = batch.column("vec_id"), []
        for i in np.flatnonzero(keep):
            v = np.floor(SCALE * x[ends[i] - sizes[i]:ends[i]])
            if len(v) * (2 * np.abs(v).max()) ** 2 >= 2.0 ** 63:
                raise ValueError(f"vec_id {ids[int(i)].as_py()}: components too large for an error of 64 bits")
            out.append(v.astype(np.int32).tobytes())
        at = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays([ids.take(at), batch.column("label").take(at), pa.array(sizes[keep], pa.int32()), pa.array(out, pa.binary())],
                                         names=["vec_id", "label", "dim", "v"])


class Balls:
    """One part position's codebook with the neighbours of each entry."""

    def __init__(self, entries: np.ndarray, radius: np.ndarray, moved: np.ndarray):
        #: entries: (k, w) int64; radius: (k,) bounds of the balls' radii; moved: (k,) bool
        self.entries = entries
        step = entries[:, None, :] - entries[None, :, :]
        gaps = (step * step).sum(2)
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, 1)
        reach = np.where(np.isfinite(radius), radius, 0.0) ** 2 * 4 * (1 + 1e-9) + 1
        self.near = [len(entries) if not np.isfinite(r) else int(np.searchsorted(g, t, side="right"))
                     for r, g, t in zip(radius, self.gaps, reach)]
        self.still = [n == 1 or not moved[o[:n]].any() for n, o in zip(self.near, self.order)]

    def assign(self, x: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Index of the nearest entry of each row of x, ties to the lower; ``start``: its ball so far."""
        entries = self.entries.astype(x.dtype)
        norms, out = (entries * entries).sum(1), start.copy()
        rows = np.argsort(start, kind="stable")
        for ball in np.split(rows, np.flatnonzero(np.diff(start[rows])) + 1):
            e = int(start[ball[0]])
            if self.still[e]:
                continue
            n = self.near[e]
            away = x[ball] - entries[e]
            # how many neighbours lie within 2 d of the entry, the entry itself among them
            width = np.searchsorted(self.gaps[e, :n], 4 * (away * away).sum(1), side="right")
            for low, high in zip(RINGS[:-1], RINGS[1:]):
                ring = ball[(width > low) & (width <= high)]
                if not len(ring):
                    continue
                cand = self.order[e, :width[(width > low) & (width <= high)].max()]
                p = x[ring]
                d = (p * p).sum(1)[:, None] - 2 * (p @ entries[cand].T) + norms[cand][None, :]
                out[ring] = np.where(d == d.min(1)[:, None], cand[None, :], ENTRIES).min(1)
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _ints(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, width).astype(np.int64)


def _codes(block: pa.Table) -> np.ndarray:
    if "code" not in block.column_names:
        return np.zeros((block.num_rows, PARTS), np.intp)  # any ball may be the first
    return np.frombuffer(b"".join(block.column("code").to_pylist()), np.uint8).reshape(-1, PARTS).astype(np.intp)


def _assigned(books: np.ndarray, radius: np.ndarray, moved: np.ndarray, final: bool):
    """(vec_id, label, v, code) with the codes of ``books``; with ``final`` the error in place of v."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(books[p], radius[p], moved[p]) for p in range(PARTS)]
        for block in _blocks(batches):
            v, codes = _ints(block.column("v"), PARTS * width), _codes(block)
            error = np.zeros(len(v), np.int64)
            largest = int(max(np.abs(v).max(), np.abs(books).max()))
            for p in range(PARTS):
                x = v[:, p * width:(p + 1) * width]
                codes[:, p] = balls[p].assign(x.astype(np.float64) if 4 * width * largest ** 2 < EXACT else x, codes[:, p])
                if final:
                    away = x - books[p][codes[:, p]]
                    error += (away * away).sum(1)
            code = pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())
            same = [block.column("vec_id").combine_chunks(), block.column("label").combine_chunks()]
            if final:
                yield from pa.table([*same, code, pa.array(error)], names=["vec_id", "label", "code", "error"]).to_batches()
            else:
                yield from pa.table([*same, block.column("v").combine_chunks(), code], names=["vec_id", "label", "v", "code"]).to_batches()
    return run


def _sums(books: np.ndarray):
    """(part, entry, n, reach, s0, s1, ...): per task the count, largest squared distance and sums of each entry's parts."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, reach, total = np.zeros((PARTS, ENTRIES), np.int64), np.zeros((PARTS, ENTRIES), np.int64), np.zeros((PARTS, ENTRIES, width), np.int64)
        for block in _blocks(batches):
            v, codes = _ints(block.column("v"), PARTS * width), _codes(block)
            for p in range(PARTS):
                x, c = v[:, p * width:(p + 1) * width], codes[:, p]
                away = x - books[p][c]
                n[p] += np.bincount(c, minlength=ENTRIES)
                np.maximum.at(reach[p], c, (away * away).sum(1))
                np.add.at(total[p], c, x)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), pa.array(reach[part, entry]),
                                          *(pa.array(np.ascontiguousarray(total[part, entry, i])) for i in range(width))],
                                         names=["part", "entry", "n", "reach", *(f"s{i}" for i in range(width))])
    return run


def _first_entries(vectors: DataFrame) -> np.ndarray | None:
    """(PARTS, k, w): the parts of the vectors of the ENTRIES smallest ids; None without any."""
    ids = [r[0] for r in vectors.select("vec_id").where("vec_id IS NOT NULL").distinct().orderBy("vec_id").limit(ENTRIES).collect()]
    if not ids:
        return None
    rows = (vectors.where(F.col("vec_id") <= ids[-1]).groupBy("vec_id").agg(F.min("v").alias("v"))  # ENTRIES rows at most
            .orderBy("vec_id").collect())
    v = np.frombuffer(b"".join(r["v"] for r in rows), np.int32).reshape(len(rows), PARTS, -1).astype(np.int64)
    return v.transpose(1, 0, 2)


def vector_codes(vectors: DataFrame) -> tuple[DataFrame, np.ndarray] | None:
    """((vec_id, label, code binary, error) of (vec_id, embedding, label), the final codebooks); None if no vector takes part."""
    state = materialise(vectors.select("vec_id", "embedding", F.col("label").cast("int").alias("label")).mapInArrow(_quantise, VECTOR), "vectors")
    first = state.where("vec_id IS NOT NULL").agg(F.min(F.struct("vec_id", "v", "dim")).alias("x")).select("x.dim").first()
    if first is None or first["dim"] is None:
        return None
    quantised, state = state, state.where(F.col("dim") == first["dim"]).drop("dim")
    books = _first_entries(state)
    _, k, width = books.shape
    radius, moved = np.full((PARTS, k), np.inf), np.ones((PARTS, k), bool)
    for _ in range(ROUNDS):
        coded = materialise(state.mapInArrow(_assigned(books, radius, moved, False), CODED), "coded")
        discard(quantised)
        quantised = state = coded
        schema = "part int, entry int, n bigint, reach bigint, " + ", ".join(f"s{i} bigint" for i in range(width))
        sums = (coded.select("v", "code").mapInArrow(_sums(books), schema).groupBy("part", "entry")
                .agg(F.sum("n").alias("n"), F.max("reach").alias("reach"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(width))))
        new = books.copy()
        radius = np.zeros((PARTS, k))
        for r in sums.collect():  # PARTS * ENTRIES rows at most
            new[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
            radius[r["part"], r["entry"]] = float(r["reach"]) ** 0.5
        step = new - books
        moved = (step != 0).any(2)
        radius += np.sqrt((step.astype(np.float64) ** 2).sum(2))
        books = new
    final = materialise(state.mapInArrow(_assigned(books, radius, moved, True), "vec_id bigint, label int, code binary, error bigint"), "codes")
    discard(state)
    return final, books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, errors and the errors of each label over all embeddings."""
    schema = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    found = vector_codes(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    if found is None:
        return spark.createDataFrame([], schema)
    rows, books = found
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return (rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def _sql() -> str:
    """The same by comparing every part with every entry, round by round."""
    steps = [f"""WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS x FROM kept, range({PARTS}) t(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {ENTRIES})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT * {ENTRIES} + e) AS best
  FROM parts JOIN b{i} USING (p) GROUP BY r, p)""")
        if i < ROUNDS:
            steps.append(f"""s{i} AS (
  SELECT p, best % {ENTRIES} AS e, i, sum(x[i]::BIGINT)::BIGINT AS s, count(*) AS n FROM a{i}, range(1, len(x) + 1) t(i) GROUP BY ALL),
m{i} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c FROM s{i} GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN m{i} USING (p, e))""")
    last = ROUNDS
    steps.append(f"""coded AS (
  SELECT r, string_agg(printf('%02x', (best % {ENTRIES})::INTEGER), '' ORDER BY p) AS code, sum(best // {ENTRIES})::BIGINT AS error FROM a{last} GROUP BY r),
digest AS (
  SELECT sha256(string_agg(c[i]::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b{last}, range(1, len(c) + 1) t(i))""")
    return ",\n".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


OP12_SQL = _sql()
