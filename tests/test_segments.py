"""Scans and frames over slices: the same as over whole series, and no task holds more than a slice and its halo."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barframe import config as C
from barframe.functions import segments as S
from barframe.functions.windows import EmaSpec, with_ema


@pytest.fixture()
def short_slices(monkeypatch):
    monkeypatch.setattr(C, "SLICE_ROWS", 50)


@pytest.fixture(scope="module")
def series(spark):
    """Two series of uneven days; every fifth value of the second is missing, and a long run of them."""
    rng, rows = random.Random(1), []
    for s, n in (("A", 420), ("B", 233)):
        day = dt.date(2019, 12, 30)
        for i in range(n):
            day += dt.timedelta(days=rng.choice([1, 1, 1, 2, 30 if rng.random() < 0.05 else 1]))
            rows.append((s, day, None if s == "B" and (i % 5 == 0 or 60 < i < 190) else 100 + rng.gauss(0, 5)))
    return spark.createDataFrame(rows, "symbol string, date date, x double")


def in_order(df, *cols):
    return {s: [tuple(r[c] for c in cols) for r in sorted(rs, key=lambda r: r.date)] for s, rs in _by_symbol(df).items()}


def _by_symbol(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.symbol, []).append(r)
    return out


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_positions(series, short_slices, parts):
    got = in_order(S.positioned(series.repartition(parts)), S.POS, S.SLICE)
    assert got == {s: [(i, i // 50) for i in range(n)] for s, n in (("A", 420), ("B", 233))}


@pytest.mark.parametrize("back,ahead", [(1, 0), (19, 1), (70, 2)])
def test_halo_holds_what_frames_reach(series, short_slices, back, ahead):
    placed = S.with_halo(S.positioned(series), "symbol", back, ahead)
    rows = placed.groupBy("symbol", S.SLICE).agg(F.collect_set(S.POS).alias("p"), F.count("*").alias("n"), F.count_if(S.OWN).alias("own")).collect()
    sizes = {"A": 420, "B": 233}
    for r in rows:
        low, high = r[S.SLICE] * 50, min(r[S.SLICE] * 50 + 50, sizes[r.symbol])
        if r.own:
            assert set(r.p) == set(range(max(0, low - back), min(sizes[r.symbol], high + ahead)))
        assert r.n == len(r.p) <= 50 + back + ahead
    assert S.without_halo(placed).count() == 653


def test_scans_equal_running_ones(series, short_slices):
    placed = S.positioned(series)
    grow = F.lit(1) + F.coalesce("x", F.lit(0.0)) / 1e4
    got = S.with_before(placed, "symbol", {"total": S.summed(F.coalesce("x", F.lit(0.0))), "product": S.multiplied(grow), "peak": S.largest(F.col("x"))})
    w = S.within("symbol")
    got = got.select("symbol", "date", (F.col("total") + F.sum(F.coalesce("x", F.lit(0.0))).over(w)).alias("total"), (F.col("product") * F.product(grow).over(w)).alias("product"),
                     F.greatest("peak", F.max("x").over(w)).alias("peak"))
    filled = in_order(S.with_filled(placed, "symbol", {"f": F.col("x")}), "x", "f")
    scans = in_order(got, "total", "product", "peak")
    for s, rows in filled.items():
        total, product, peak, last = 0.0, 1.0, None, None
        for (x, f), (t, p, m) in zip(rows, scans[s]):
            total, product = total + (x or 0.0), product * (1 + (x or 0.0) / 1e4)
            peak = x if peak is None else max(peak, x) if x is not None else peak
            last = x if x is not None else last
            assert f == last and m == peak and t == pytest.approx(total, rel=1e-12) and p == pytest.approx(product, rel=1e-12)


@pytest.mark.parametrize("alpha,least", [(2 / 11, 10), (1 / 14, 14), (0.9, 3)])
def test_smoother_carries_over_slices_and_gaps(series, short_slices, alpha, least):
    out = with_ema(series, [EmaSpec("y", "x", alpha, least), EmaSpec("z", "x", alpha / 2, 1)])
    assert out.columns == ["symbol", "date", "x", "y", "z"]
    for rows in in_order(out, "x", "y", "z").values():
        for k, (a, need) in enumerate(((alpha, least), (alpha / 2, 1)), 1):
            value, old, seen = None, 0, 0
            for row in rows:
                x = row[0]
                if x is not None:
                    keep = (1 - a) ** (old + 1)
                    value = x if value is None else (keep * value + a * x) / (keep + a)
                    old, seen = 0, seen + 1
                elif value is not None:
                    old += 1
                assert row[k] is None if seen < need else row[k] == pytest.approx(value, rel=1e-11)


def test_features_do_not_depend_on_the_slices(bars, monkeypatch):
    from barframe.operators.features import ALL_FEATURES, LABELS, all_feature_columns
    from barframe.plans.catalog import market_for
    cols = ALL_FEATURES + LABELS
    found = []
    for rows in (61, 4096):
        monkeypatch.setattr(C, "SLICE_ROWS", rows)
        found.append(in_order(all_feature_columns(bars, market_for(bars)), "date", *cols))
    for s, rows in found[0].items():
        for a, b in zip(rows, found[1][s], strict=True):
            for c, x, y in zip(["date", *cols], a, b):
                assert (x is None) == (y is None) and (x == y or x == pytest.approx(y, rel=1e-9, abs=1e-11)), (s, a[0], c)


def test_study_rows_over_slices(spark, short_slices):
    from barframe.operators.signal import study_rows
    rng = random.Random(4)
    rows = [("p", dt.date(2020, 1, 1) + dt.timedelta(days=i), rng.random(), rng.gauss(0, 0.01)) for i in range(170)]
    got = sorted(study_rows(spark.createDataFrame(rows, "series string, date date, p_up double, fwd_return double"), ["series"]).collect(), key=lambda r: r.date)
    equity = peak = 1.0
    prev = None
    peak = 0.0
    for (_, _, p, f), r in zip(rows, got, strict=True):
        pos = float(p > C.BULLISH_THRESHOLD)
        turn = pos if prev is None else abs(pos - prev)
        equity *= 1 + pos * f - turn * C.TRANSACTION_COST_BPS / 1e4
        peak, prev = max(peak, equity), pos
        assert (r.position, r.turnover) == (pos, turn)
        assert r.strategy_equity == pytest.approx(equity, rel=1e-12) and r.strategy_drawdown == pytest.approx(equity / peak - 1, abs=1e-12)
