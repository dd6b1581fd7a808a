"""Source operators: the large-dimension bar path, fallback, look-back, normalisation."""
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barframe.sources import snapshot as SN
from barframe.sources.ticks import bars_from_lineitem, read_table

from conftest import SF_SMALL


def test_lineitem_bars_use_hash_aggregates(spark):
    li, part = read_table(spark, SF_SMALL, "lineitem"), read_table(spark, SF_SMALL, "part")
    bars = bars_from_lineitem(li, part)
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and bars.count() > 0


def test_line_item_key_out_of_range_is_an_error(spark):
    from barframe.sources.ticks import line_sequence
    df = spark.createDataFrame([(5, 1), (None, 1), (1 << 50, 1)], "o bigint, l int").select(
        "o", line_sequence(F.col("o"), F.col("l")).alias("s"))
    assert [r.s for r in df.filter("o = 5 OR o IS NULL").collect()] == [(5 << 16) + 1, None]
    with pytest.raises(Exception, match="out of range"):
        df.collect()


def test_dedupe_and_latest_use_hash_aggregates(spark):
    from barframe.plans.catalog import QUERIES
    for name in ("dedupe_keep_last", "latest_signal", "bars_brand"):
        assert "SortAggregate" not in QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_ticks_are_read_once(spark):
    """Plans over the index read the written bars, and join nothing on a constant."""
    from barframe.plans.catalog import QUERIES
    for name in ("feature_matrix", "snapshot_metadata", "monthly_returns"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "orders.parquet" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_fallback_fills_only_missing_symbols(spark, bars):
    primary = bars.filter(F.col("symbol") != "5-LOW")
    out = SN.with_fallback(primary, bars)
    src = {r.symbol: r.source for r in out.select("symbol", "source").distinct().collect()}
    assert src["5-LOW"] == "live" and src["1-URGENT"] == "snapshot"
    assert out.count() == bars.count()


def test_lookback_keeps_recent_sessions(spark, bars):
    lb = SN.lookback(bars, years=1)
    check = lb.groupBy("symbol").agg(F.min("date").alias("a"), F.max("date").alias("b")) \
        .withColumn("span", F.datediff("b", "a"))
    assert check.agg(F.max("span")).first()[0] <= int(365.25)


def test_vendor_frame_normalisation(spark):
    raw = spark.createDataFrame(pd.DataFrame({
        "Date": ["2024-01-02", "2024-01-03", "2024-01-04"], "Open": [1.0, None, 2.0], "High": [1.5, None, 2.5],
        "Low": [0.5, None, 1.5], "Close": [1.2, None, 2.2], "Volume": [10.0, None, 20.0]}))
    out = SN.normalise_vendor_frame(raw).orderBy("date").collect()
    assert [r.adj_close for r in out] == [1.2, 2.2]
    assert out[0].date.isoformat() == "2024-01-02"


def test_symbol_fetch_is_pushed_to_the_scan(spark):
    """The symbol filter passes through the bar aggregate into the Parquet
    scan, and only the four columns the bars need are read."""
    from barframe.plans.catalog import QUERIES
    plan = QUERIES["fetch_symbol"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "EqualTo(o_orderpriority,3-MEDIUM)" in scan
    assert "o_custkey" not in scan and "o_orderstatus" not in scan


def test_late_ticks_reach_the_streamed_bars(spark, tmp_path):
    """Two runs of the stream; the second brings older ticks, a whole symbol and a NaN price."""
    from barframe.sources.ticks import bars_from_events
    from barframe.streaming.bars import read_stream_bars, run_bar_stream
    events = read_table(spark, SF_SMALL, "events")
    nan = events.limit(1).withColumn("value", F.lit(float("nan"))).withColumn("event_id", F.lit(-1).cast("bigint")) \
        .withColumn("ts", F.expr("ts + INTERVAL 1 MICROSECOND"))
    events = events.unionByName(nan)
    late = (F.pmod("event_id", F.lit(3)) == 0) | (F.col("event_type") == events.agg(F.min("event_type")).first()[0])
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    for part in (events.filter(~late), events.filter(late)):
        part.write.mode("append").parquet(src)
        run_bar_stream(spark, src, events.schema, out, state, "event_type", "ts", "value").awaitTermination()
    a, b = read_stream_bars(spark, out), bars_from_events(events)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_source_contracts(spark, bars, tmp_path):
    assert SN.read_metadata(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(LookupError):
        SN.fetch_known(bars, "9-NOPE")

    def broken():
        raise OSError("down")
    found, name, failed = SN.fetch_from({"live": broken, "snapshot": lambda: bars}, "5-LOW")
    assert name == "snapshot" and "down" in failed["live"] and found.count() == bars.filter("symbol = '5-LOW'").count()
    with pytest.raises(LookupError, match="down"):
        SN.fetch_from({"live": broken, "snapshot": lambda: bars}, "9-NOPE")


def test_snapshot_files_round_trip(spark, bars, tmp_path):
    few = bars.filter("symbol = '5-LOW'")
    SN.write_snapshot(few, str(tmp_path / "csv"), "csv")
    back = SN.conform(SN.read_snapshot_csv(spark, str(tmp_path / "csv")))
    assert back.exceptAll(SN.conform(few)).count() == 0 and back.count() == few.count()
    assert SN.fetch_many(bars, few.select("symbol").distinct()).count() == few.count()


def test_index_without_members_and_study_without_overlap_are_errors(spark, bars):
    from barframe.operators.features import vanished
    from barframe.operators.index import build_snapshot
    from barframe.operators.signal import require_overlap
    with pytest.raises(ValueError, match="market index"):
        build_snapshot(bars, min_coverage=2.0)
    with pytest.raises(ValueError, match="in common"):
        require_overlap(spark.createDataFrame([(0.5, None), (None, 0.1)], "p_up double, fwd_return double"))
    got = vanished(bars, bars.filter("symbol <> '5-LOW'")).collect()
    assert [(r.symbol, r.reason) for r in got] == [("5-LOW", "5-LOW: no row has all features")]
