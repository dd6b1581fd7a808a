import hashlib
import math
import random

import numpy as np
import pytest

from barframe.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, code string, dim int, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "a", "b", 1, 2) for i, v, l in rows], SCHEMA)


def plain(rows, entries, rounds):
    """The contract by comparing every part with every entry. rows: (id, vector, label) without nulls."""
    vs = {n: [math.floor(1024 * float(np.float32(x))) for x in v] for n, (_, v, _) in enumerate(rows)}
    w = len(rows[0][1]) // 4
    ids = sorted(range(len(rows)), key=lambda n: rows[n][0])[:entries]
    books = [[vs[n][p * w:(p + 1) * w] for n in ids] for p in range(4)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for v in vs.values():
                part = v[p * w:(p + 1) * w]
                groups.setdefault(near(part, books[p])[1], []).append(part)
            for e, parts in groups.items():
                books[p][e] = [sum(c) // len(parts) for c in zip(*parts)]
    out = []
    for n, (i, _, l) in enumerate(rows):
        found = [near(vs[n][p * w:(p + 1) * w], books[p]) for p in range(4)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()


def run(spark, rows):
    found, books = V.vector_codes(frame(spark, rows))
    got = [(r["vec_id"], bytes(r["code"]).hex(), r["error"]) for r in found.collect()]
    return got, hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


@pytest.mark.parametrize("kind", ["clusters", "ties", "long"])
def test_equals_comparing_all(spark, kind):
    rng = random.Random(kind)
    if kind == "clusters":
        centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(9)]
        vectors = [[x + rng.gauss(0, 0.2) for x in rng.choice(centres)] for _ in range(240)]
    elif kind == "ties":  # few values: repeated entries, parts halfway between entries
        vectors = [[rng.choice([-2, 0, 2]) / 1024 for _ in range(8)] for _ in range(200)]
    else:
        vectors = [[rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-3, 5) for _ in range(8)] for _ in range(120)]
    rows = [(1000 - 3 * i, v, i % 3) for i, v in enumerate(vectors)]
    want, digest = plain(rows, 256, 4)
    got, mine = run(spark, rows)
    assert sorted(got) == sorted(want) and mine == digest


def test_balls_keep_the_nearest_with_ties():
    rng = np.random.default_rng(4)
    for top in (3, 50, 3000):
        entries, x = rng.integers(-top, top + 1, (40, 4)), rng.integers(-top, top + 1, (500, 4))
        d = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        want = d.argmin(1)  # the first of equal ones
        every = V.Balls(entries, np.full(40, np.inf), np.ones(40, bool))
        assert (every.assign(x.astype(float), np.zeros(500, np.intp)) == want).all()
        radius = np.array([np.sqrt(d[want == e, e].max()) if (want == e).any() else 0.0 for e in range(40)])
        # after a move: the old assignment, radii by the step
        step = rng.integers(-max(top // 20, 1), max(top // 20, 1) + 1, entries.shape) * (rng.random((40, 1)) < 0.5)
        new = entries + step
        balls = V.Balls(new, radius + np.sqrt((step.astype(float) ** 2).sum(1)), (step != 0).any(1))
        got = balls.assign(x, want.astype(np.intp))
        assert (got == ((x[:, None, :] - new[None, :, :]) ** 2).sum(2).argmin(1)).all()


def test_defined_cases(spark, tmp_path):
    rng = random.Random(6)
    good = [(i, [rng.random() for _ in range(8)], i % 2 or None) for i in range(30)]
    odd = [(100, None, 1), (101, [], 1), (102, [0.5] * 7 + [None], 1), (103, [0.5] * 7 + [float("nan")], 1), (104, [0.5] * 7 + [float("inf")], 1),
           (105, [0.1] * 12, 1), (106, [0.1] * 6, 1)]
    again = [good[3], (good[4][0], good[5][1], 0), (None, good[6][1], 0)]
    got, _ = run(spark, good + odd + again)
    assert sorted(i for i, _, _ in got if i is not None) == sorted([i for i, _, _ in good] + [3, 4])
    assert sum(i is None for i, _, _ in got) == 1
    want = [(c, e) for i, c, e in got if i == 3]
    assert want[0] == want[1]
    assert V.vector_codes(frame(spark, odd[:5])) is None
    assert V.vector_codes(frame(spark, good).limit(0)) is None
    frame(spark, odd[:5]).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert V.op12_vector_codes(spark, str(tmp_path)).collect() == []


def test_label_sums_and_one_entry(spark, tmp_path):
    rows = [(1, [0.5] * 4, None), (1, [0.5] * 4, None), (2, [0.25] * 4, 7)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in V.op12_vector_codes(spark, str(tmp_path)).collect()]
    assert [g[:4] for g in sorted(got)] == [(1, "00000000", 0, 0)] * 2 + [(2, "01010101", 0, 0)]


def test_too_large_components_name_the_id(spark):
    with pytest.raises(Exception, match="vec_id 2: components too large"):
        run(spark, [(1, [0.5] * 4, 1), (2, [1e9] * 4, 1)])
