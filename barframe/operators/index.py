"""Equal-weight market index, market returns and the snapshot table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.windows import pct_change, ffill
from ..sources.ticks import BAR_COLUMNS


def calendar_stats(bars: DataFrame) -> DataFrame:
    """One row: first session, last session, number of sessions (union of dates)."""
    return bars.agg(F.min("date").alias("cal_first"), F.max("date").alias("cal_last"),
                    F.count_distinct("date").alias("cal_sessions"))


def symbol_history(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count("*").alias("sessions"), F.min_by("close", "date").alias("base_close"))


def full_history_constituents(bars: DataFrame, min_coverage: float = 0.99,
                              require_span: bool = True) -> DataFrame:
    """Symbols that start on the first and end on the last calendar session and
    cover at least ``min_coverage`` of the calendar.

    The calendar is one row of three values; they enter the filter as literals."""
    cal = calendar_stats(bars).first()
    hist = symbol_history(bars)
    cond = F.col("sessions") >= F.lit(min_coverage * (cal.cal_sessions or 0))
    if require_span:
        cond = cond & (F.col("first_date") == F.lit(cal.cal_first)) & (F.col("last_date") == F.lit(cal.cal_last))
    return hist.filter(cond).select("symbol", "base_close", "sessions")


def equal_weight_index(bars: DataFrame, base_level: float = 100.0, min_coverage: float = 0.99,
                       require_span: bool = True, symbol: str = C.MARKET_SYMBOL) -> DataFrame:
    """OHLC of each constituent divided by its own first close, averaged across
    constituents per session and rescaled; volume summed. Returns bar rows."""
    members = full_history_constituents(bars, min_coverage, require_span) \
        .filter(F.col("base_close") > 0).select("symbol", "base_close")
    norm = bars.join(members, "symbol")
    idx = norm.groupBy("date").agg(
        *[(F.avg(F.col(c) / F.col("base_close")) * F.lit(base_level)).alias(c)
          for c in ("open", "high", "low", "close")],
        F.sum("volume").alias("volume"))
    idx = idx.dropna(how="any", subset=["open", "high", "low", "close", "volume"])
    return idx.select(F.lit(symbol).alias("symbol"), "date", "open", "high", "low", "close",
                      F.col("close").alias("adj_close"), F.col("volume").cast("bigint").alias("volume"))


def build_snapshot(bars: DataFrame, universe: list[str] | None = None,
                   min_coverage: float = 0.99, require_span: bool = True, require_members: bool = True) -> DataFrame:
    """Universe bars plus the index rows, prices rounded to 4 dp. Without a single
    index member that is an error, unless ``require_members`` is off."""
    if require_members and full_history_constituents(bars, min_coverage, require_span).isEmpty():
        raise ValueError("no symbol covers the calendar well enough for a market index")
    sel = bars if universe is None else bars.filter(F.col("symbol").isin(list(universe)))
    index = equal_weight_index(bars, min_coverage=min_coverage, require_span=require_span)
    snap = sel.select(*BAR_COLUMNS).unionByName(index)
    return snap.select("symbol", "date",
                       *[F.round(c, 4).alias(c) for c in ("open", "high", "low", "close", "adj_close")],
                       F.col("volume").cast("bigint").alias("volume"))


def market_returns(bars: DataFrame, symbol: str = C.MARKET_SYMBOL) -> DataFrame:
    """(date, market_return): pct_change of the index close."""
    m = bars.filter(F.col("symbol") == symbol).select("symbol", "date", "close")
    m = m.withColumn("_fc", ffill("close"))
    return m.select("date", pct_change("_fc", 1, fill=False).alias("market_return"))


def snapshot_metadata(snapshot: DataFrame, market_symbol: str = C.MARKET_SYMBOL) -> DataFrame:
    """One-row provenance table: counts, period, and min/median/max sessions over
    the equities (the symbols themselves are ``available_symbols``)."""
    per_symbol = snapshot.groupBy("symbol").agg(
        F.count_distinct("date").alias("n"), F.count("*").alias("rows"),
        F.min("date").alias("first"), F.max("date").alias("last"))
    equity = F.col("symbol") != market_symbol
    n = F.when(equity, F.col("n"))
    return per_symbol.agg(
        F.sum("rows").alias("rows"), F.min("first").alias("start_date"), F.max("last").alias("end_date"),
        F.min(n).alias("sessions_min"), F.median(n).alias("sessions_median"), F.max(n).alias("sessions_max"),
        F.count(n).alias("n_equities")).withColumn("market_index_symbol", F.lit(market_symbol))


def provenance(bars: DataFrame, snapshot: DataFrame, source_name: str, source_url: str = "", built_at=None, min_coverage: float = 0.99,
               require_span: bool = True, adjustment_note: str = "") -> DataFrame:
    """S11 whole: ``snapshot_metadata`` with the source, the time of the build, the number of
    index constituents and of symbols that the source has."""
    members = full_history_constituents(bars, min_coverage, require_span).where("base_close > 0").count()
    available = bars.select("symbol").distinct().count()
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'") if built_at is None else F.lit(built_at)
    return snapshot_metadata(snapshot).select(
        F.lit(source_name).alias("source_name"), F.lit(source_url).alias("source_url"), stamp.alias("built_at_utc"), "*",
        F.lit(members).cast("bigint").alias("market_index_constituents"), F.lit(available).cast("bigint").alias("source_tickers_available"),
        F.lit(adjustment_note).alias("adjustment_note"))
