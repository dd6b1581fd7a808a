"""Registered queries: each reads the driver's tables and returns a DataFrame.

``QUERIES[name] = fn(spark, sf_dir) -> DataFrame`` and ``SQL[name]`` is the
DuckDB twin. Floating outputs are rounded to 6 decimals on both sides
because summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators import features as FE
from ..operators.index import equal_weight_index, market_returns
from ..session import cut_lineage, scratch_path
from ..sources.ticks import brand_bars, daily_bars, hourly_bars
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The driver's bars are young series: no symbol covers 99 % of the calendar,
# so the market index takes every symbol with half the sessions.
INDEX_COVERAGE = 0.5
INDEX_SPAN = False


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def round_half_up(c, digits: int = O.R):  # noqa: D103
    """Same IEEE operations as ``oracle.rnd_expr`` so both engines agree bit for bit."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.when(c.isNull(), F.lit(None).cast("double")).when(F.abs(c) < F.lit(O.ROUND_LIMIT),
                  F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)) \
        .otherwise(F.format_string("%.12e", c).cast("double"))


def round_sig(c, digits: int = 10):
    """Twin of ``oracle.rnd_sig``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.format_string(f"%.{digits - 1}e", c).cast("double"))


def rounded(df: DataFrame, digits: int = O.R) -> DataFrame:
    return df.select(*[round_half_up(f.name, digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def sel_rounded(cols_double: list[str], cols_other: list[str]) -> str:
    return ", ".join(cols_other + [O.rnd(c, c) for c in cols_double])


BAR_DOUBLES = ["open", "high", "low", "close", "adj_close"]


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------
def market_for(bars: DataFrame) -> DataFrame:
    return market_returns(equal_weight_index(bars, min_coverage=INDEX_COVERAGE,
                                             require_span=INDEX_SPAN))


def bars_once(spark, sf) -> DataFrame:
    """The daily bars as a written table: what reads them several times (index,
    calendar, windows) reads the ticks once."""
    return cut_lineage(daily_bars(spark, sf), "bars")


def _bars_ctes() -> list[tuple[str, str]]:
    return [("bars", O.bars_orders())]


# ---------------------------------------------------------------------------
# bars (tick -> bar)
# ---------------------------------------------------------------------------
@register("bars_daily", O.sql(_bars_ctes(), f"SELECT {sel_rounded(BAR_DOUBLES, ['symbol', 'date', 'volume'])} FROM bars"))
def q_bars_daily(spark, sf):
    return rounded(daily_bars(spark, sf))


@register("bars_hourly", O.sql([("bars", O.bars_events())],
                               f"SELECT {sel_rounded(BAR_DOUBLES, ['symbol', 'date', 'volume'])} FROM bars"))
def q_bars_hourly(spark, sf):
    return rounded(hourly_bars(spark, sf))


@register("bars_brand", O.sql([("bars", O.bars_lineitem())],
                              f"SELECT {sel_rounded(BAR_DOUBLES, ['symbol', 'date', 'volume'])} FROM bars"))
def q_bars_brand(spark, sf):
    return rounded(brand_bars(spark, sf))


# ---------------------------------------------------------------------------
# index, market
# ---------------------------------------------------------------------------
@register("equal_weight_index", O.sql(_bars_ctes() + O.index_ctes(min_coverage=INDEX_COVERAGE),
                                      f"SELECT {sel_rounded(BAR_DOUBLES, ['symbol', 'date', 'volume'])} FROM idx"))
def q_equal_weight_index(spark, sf):
    return rounded(equal_weight_index(bars_once(spark, sf), min_coverage=INDEX_COVERAGE,
                                      require_span=INDEX_SPAN))


@register("market_returns", O.sql(_bars_ctes() + O.index_ctes(min_coverage=INDEX_COVERAGE),
                                  f"SELECT date, {O.rnd('market_return', 'market_return')} FROM mkt"))
def q_market_returns(spark, sf):
    return rounded(market_for(bars_once(spark, sf)))


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------
def _feature_sql(cols: list[str], matrix: bool = False, bars_ctes=None, market=True,
                 extra_cols: list[str] | None = None) -> str:
    ctes = (bars_ctes or _bars_ctes())
    if market:
        ctes = ctes + O.index_ctes(min_coverage=INDEX_COVERAGE)
    ctes = ctes + O.feature_ctes(market="mkt" if market else None)
    where = ""
    if matrix:
        where = "WHERE " + O.matrix_filter(FE.BASE_FEATURES, FE.MARKET_FEATURES, ["next_day_return"],
                                           with_market=market)
    ints = [c for c in cols if c == C.TARGET_COLUMN]
    dbl = [c for c in cols if c != C.TARGET_COLUMN]
    return O.sql(ctes, f"SELECT symbol, date, {sel_rounded(dbl, ints + (extra_cols or []))} FROM feat {where}")


def _features(spark, sf, cols: list[str]) -> DataFrame:
    bars = bars_once(spark, sf)
    df = FE.all_feature_columns(bars, market_for(bars))
    return rounded(df.select("symbol", "date", *cols))


BLOCKS = {
    "price_features": FE.PRICE_FEATURES,
    "momentum_features": FE.MOMENTUM_FEATURES,
    "ma_features": FE.MA_FEATURES,
    "technical_features": FE.TECHNICAL_FEATURES,
    "volatility_features": FE.VOLATILITY_FEATURES,
    "volume_features": FE.VOLUME_FEATURES,
    "calendar_features": FE.CALENDAR_FEATURES,
    "market_features": FE.MARKET_FEATURES,
    "target_labels": FE.LABELS,
}

for _name, _cols in BLOCKS.items():
    register(_name, _feature_sql(_cols))(
        (lambda cols: (lambda spark, sf: _features(spark, sf, cols)))(_cols))


@register("feature_matrix", _feature_sql(FE.ALL_FEATURES + FE.LABELS, matrix=True))
def q_feature_matrix(spark, sf):
    bars = bars_once(spark, sf)
    return rounded(FE.feature_matrix(bars, market_for(bars)).drop("market_ok"))


@register("feature_matrix_brand", _feature_sql(FE.BASE_FEATURES + FE.LABELS, matrix=True,
                                               bars_ctes=[("bars", O.bars_lineitem())], market=False))
def q_feature_matrix_brand(spark, sf):
    return rounded(FE.feature_matrix(brand_bars(spark, sf), None, include_market=False).drop("market_ok"))


# more registered queries (import registers them)
from . import queries_analytics  # noqa: E402,F401
from . import queries_models  # noqa: E402,F401
from . import queries_more  # noqa: E402,F401
from . import queries_sweep  # noqa: E402,F401
from . import queries_indicators  # noqa: E402,F401


@register("bars_hourly_stream", SQL["bars_hourly"])
def q_bars_hourly_stream(spark, sf):
    """Live mode re-aimed: the hourly bars folded from the events files by a
    Structured Streaming job (availableNow), read back keep-last."""
    from ..streaming.bars import read_stream_bars, run_bar_stream
    base = scratch_path(spark, "bar-stream")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    q = run_bar_stream(spark, sf, schema, base + "/out", base + "/state", "event_type", "ts", "value",
                       file_glob="events.parquet")
    q.awaitTermination()
    return rounded(read_stream_bars(spark, base + "/out"))
