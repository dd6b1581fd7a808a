"""Exact medians by ranges, reduced ROC curves, file order and versioned snapshots."""
import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barframe import config as C
from barframe.functions import selection
from barframe.operators import metrics as M
from barframe.sources import snapshot as SN
from barframe.sources import versions as V


@pytest.mark.parametrize("few", [10_000, 40])
def test_medians_are_exact(spark, monkeypatch, few):
    """Ties, one value only, wide ranges, nulls; groups far above the number that is sorted in one place."""
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(2)
    groups = {"normal": [rng.gauss(0, 1) for _ in range(3000)], "even": [float(rng.randint(0, 3)) for _ in range(2000)], "same": [7.0] * 1500,
              "wide": [10.0 ** rng.uniform(-200, 200) for _ in range(1001)], "two": [1.0, 4.0], "half": [0.0] * 500 + [1.0] * 500}
    rows = [(g, x, -x if i % 2 else None) for g, xs in groups.items() for i, x in enumerate(xs)] + [("none", None, None)]
    got = {r.g: r for r in selection.medians(spark.createDataFrame(rows, "g string, a double, b double").repartition(7), ["g"], ["a", "b"]).collect()}
    assert set(got) == set(groups) | {"none"} and got["none"].a is None
    for g, xs in groups.items():
        assert got[g].a == pytest.approx(statistics.median(xs), rel=1e-15)
        assert got[g].b == pytest.approx(statistics.median([-x for i, x in enumerate(xs) if i % 2]), rel=1e-15)


def curve(rows):
    """Points of a curve (fp, tp) from the highest score on, less the middles of two equal steps."""
    steps = []
    for s in sorted({p for _, p in rows}, reverse=True):
        steps.append((s, sum(1 for y, p in rows if p == s and y == 0), sum(1 for y, p in rows if p == s and y == 1)))
    fp = tp = 0
    out = []
    for i, (s, n, p) in enumerate(steps):
        fp, tp = fp + n, tp + p
        if i in (0, len(steps) - 1) or steps[i + 1][1:] != (n, p):
            out.append((s, fp, tp))
    return out


@pytest.mark.parametrize("ranges", [256, 4])
def test_reduced_curve(spark, monkeypatch, ranges):
    monkeypatch.setattr(M, "SCORE_RANGES", ranges)
    rng = random.Random(5)
    groups = {"ties": [(rng.randint(0, 1), rng.randint(0, 30) / 30) for _ in range(400)], "runs": [(int(i % 40 < 20), i / 200) for i in range(200)],
              "one": [(1, 0.5)], "two": [(0, 0.1), (1, 0.1), (0, 0.9)]}
    df = spark.createDataFrame([(g, y, p) for g, rows in groups.items() for y, p in rows], "g string, y int, p_up double")
    got = {}
    for r in M.roc_points(df, ["g"], drop_collinear=True).where("threshold IS NOT NULL").collect():
        got.setdefault(r.g, []).append((r.threshold, r.fpr, r.tpr))
    for g, rows in groups.items():
        n, p = sum(y == 0 for y, _ in rows), sum(y == 1 for y, _ in rows)
        want = [(s, f / n if n else None, t / p if p else None) for s, f, t in curve(rows)]
        found = sorted(got[g], reverse=True)
        assert len(found) == len(want)
        if n and p:
            assert [x for r in found for x in r] == pytest.approx([x for r in want for x in r])


@pytest.mark.parametrize("size", ["200", "4000", "10000000"])
def test_kept_rows_do_not_depend_on_partitions(spark, tmp_path, size):
    """Repeated dates within and across files; the last row by path and line stays."""
    want = {}
    for k, name in enumerate(("b", "a")):
        folder = tmp_path / name
        folder.mkdir()
        lines, rng = ["date,open,high,low,close,volume,Name"], random.Random(k)
        for i in range(300):
            day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 40))
            lines.append(f"{day},1,2,0.5,{k * 1000 + i},10,ABC")
            want.setdefault(name, {})[day] = float(k * 1000 + i)
        (folder / "ABC_data.csv").write_text("\n".join(lines) + "\n")
    last = {**want["a"], **want["b"]}  # path order
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = {r.date: r.close for r in SN.read_symbol_files(spark, str(tmp_path / "*")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == last


def small(spark, symbols, price):
    return spark.createDataFrame([(s, dt.date(2020, 1, 1 + i), price + i) for s in symbols for i in range(3)], "symbol string, date date, close double")


def closes(df):
    return sorted((r.symbol, r.date.day, r.close) for r in df.select("symbol", "date", "close").collect())


def test_versions_replace_touched_symbols(spark, tmp_path):
    root = str(tmp_path / "snap")
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, root)
    assert V.write_version(small(spark, "AB", 1.0), root, spark.createDataFrame([("first", 6)], "source_name string, rows bigint")) == 0
    assert V.write_version(small(spark, "BC", 9.0), root) == 1
    assert closes(V.read_version(spark, root)) == closes(small(spark, "A", 1.0).union(small(spark, "BC", 9.0)))
    assert closes(V.read_version(spark, root, 0)) == closes(small(spark, "AB", 1.0))
    assert V.read_version_metadata(spark, root, 0).first().source_name == "first"
    assert V.write_version(small(spark, "C", 5.0), root, replace=True) == 2
    assert closes(V.read_version(spark, root)) == closes(small(spark, "C", 5.0))


@pytest.mark.parametrize("step", ["data", "manifest", "metadata", "published"])
def test_a_crash_between_steps_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "snap")
    V.write_version(small(spark, "AB", 1.0), root)
    meta = spark.createDataFrame([("second",)], "source_name string")
    with monkeypatch.context() as m:
        if step == "published":
            calls = []

            def lost_at_the_end(spark, root, real=V._fs):
                calls.append(root)
                if len(calls) > 1:
                    raise OSError("lost")
                return real(spark, root)
            m.setattr(V, "_fs", lost_at_the_end)
        else:
            from pyspark.sql.readwriter import DataFrameWriter
            name = "json" if step == "metadata" else "parquet"
            real = getattr(DataFrameWriter, name)

            def broken(self, path, *a, **k):
                if f"{root}/{step}/" in path:
                    raise OSError("lost")
                return real(self, path, *a, **k)
            m.setattr(DataFrameWriter, name, broken)
        with pytest.raises(OSError, match="lost"):
            V.write_version(small(spark, "BC", 9.0), root, meta)
    assert V.current_version(spark, root) == 0
    assert closes(V.read_version(spark, root)) == closes(small(spark, "AB", 1.0))
    assert V.write_version(small(spark, "C", 2.0), root, meta) == 1  # over the leavings
    assert closes(V.read_version(spark, root)) == closes(small(spark, "AB", 1.0).union(small(spark, "C", 2.0)))


def test_correlation_copies_no_rows(spark):
    from barframe.operators.explain import feature_correlation
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.gauss(0, 1), rng.gauss(0, 1) if i % 3 else None, float(i)) for i in range(90)], "a double, b double, c double")
    got = {(r.feature_a, r.feature_b): r["corr"] for r in feature_correlation(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "b"] == got["b", "a"] and got["a", "a"] == pytest.approx(1.0)
    assert got["b", "c"] == pytest.approx(df.where("b IS NOT NULL").corr("b", "c"))
    assert "Generate" not in feature_correlation(df, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert feature_correlation(df, []).count() == 0


def test_provenance(spark, bars):
    from barframe.operators.index import build_snapshot, provenance
    snap = build_snapshot(bars, min_coverage=0.1, require_span=False)
    r = provenance(bars, snap, "driver bars", "file", min_coverage=0.1, require_span=False).first()
    assert r.source_name == "driver bars" and r.source_tickers_available == 5 and 1 <= r.market_index_constituents <= 5
    assert dt.datetime.strptime(r.built_at_utc, "%Y-%m-%dT%H:%M:%SZ") and r.n_equities == 5 and r.market_index_symbol == C.MARKET_SYMBOL
