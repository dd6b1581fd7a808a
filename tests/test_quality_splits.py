"""Validation negatives (on modified copies of driver bars) and split invariants."""
import pytest
from pyspark.sql import functions as F

from barframe.operators import quality as Q
from barframe.operators import splits as SP


def _report(bars, **kw):
    return {r.symbol: r for r in Q.validation_report(bars, **kw).collect()}


def test_clean_bars_pass(bars):
    rep = _report(bars)
    assert all(r.passed for r in rep.values())
    assert all(r.summary.startswith("[OK]") for r in rep.values())


def test_each_failure_is_reported(spark, bars):
    one = bars.filter(F.col("symbol") == "1-URGENT")
    dup = one.unionByName(one.limit(1))
    assert "1 duplicated timestamp(s)" in _report(dup)["1-URGENT"].warnings
    neg = one.withColumn("low", F.when(F.col("date") == one.agg(F.min("date")).first()[0], -1.0)
                         .otherwise(F.col("low")))
    r = _report(neg)["1-URGENT"]
    assert not r.passed and "non-positive price(s) present" in r.warnings
    assert not any("high < low" in w for w in r.warnings)  # the low only fell
    hl = one.withColumn("high", F.col("low") - 1)
    assert any("row(s) with high < low" in w for w in _report(hl)["1-URGENT"].warnings)
    vol = one.withColumn("volume", F.lit(-1).cast("bigint"))
    assert "negative volume present" in _report(vol)["1-URGENT"].warnings
    short = one.limit(50)
    assert "only 50 rows, need at least 260" in _report(short)["1-URGENT"].warnings
    nulls = one.withColumn("open", F.lit(None).cast("double"))
    assert "20.0% of OHLCV cells are null" in _report(nulls)["1-URGENT"].warnings


def test_tolerated_nulls_still_pass(bars):
    one = bars.filter(F.col("symbol") == "2-HIGH")
    first = one.agg(F.min("date")).first()[0]
    n = one.withColumn("open", F.when(F.col("date") == first, None).otherwise(F.col("open")))
    r = _report(n)["2-HIGH"]
    assert r.passed and r.warnings[-1].endswith("null cells (tolerated)")


def test_strict_mode_raises(spark, bars):
    with pytest.raises(Q.DataValidationError):
        Q.assert_valid(Q.validation_report(bars.limit(10)))


def test_requested_but_absent_symbol_is_empty(spark, bars):
    req = spark.createDataFrame([("1-URGENT",), ("9-NOPE",)], "symbol string")
    rep = {r.symbol: r for r in Q.validation_report(bars, requested=req).collect()}
    assert rep["9-NOPE"].warnings == ["frame is empty"] and not rep["9-NOPE"].passed


def test_date_split_is_disjoint_and_ordered(bars):
    ds = SP.split_by_dates(bars)
    chk = Q.split_order_check(ds).collect()
    assert all(r.after_previous for r in chk)
    per_date = ds.groupBy("date").agg(F.count_distinct("split").alias("k"))
    assert per_date.filter("k > 1").count() == 0
    assert ds.count() == bars.count()


def test_row_split_fractions(spark, bars):
    rs = SP.split_by_rows(bars)
    sizes = {(r.symbol, r.split): r["count"] for r in rs.groupBy("symbol", "split").count().collect()}
    n = bars.filter(F.col("symbol") == "3-MEDIUM").count()
    assert sizes[("3-MEDIUM", "train")] == int(n * 0.70)
    assert sizes[("3-MEDIUM", "train")] + sizes[("3-MEDIUM", "validation")] == int(n * (0.70 + 0.15))


def test_bad_fractions_rejected(bars):
    with pytest.raises(ValueError):
        SP.split_by_rows(bars, 0.9, 0.2)


def test_cv_folds_expand(bars):
    tr = SP.split_by_rows(bars).filter("split = 'train'")
    f = SP.cv_fold_summary(tr, 5).filter("symbol = '1-URGENT'").toPandas()
    trains = f[f.role == "train"].sort_values("fold")["rows"].tolist()
    assert trains == sorted(trains) and len(trains) == 5
    assert f[f.role == "test"]["rows"].nunique() == 1
