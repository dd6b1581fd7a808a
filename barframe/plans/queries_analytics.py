"""Registered queries over bars and the feature matrix: quality, sources,
statistics, splits, metrics and the signal study. Each has a DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import signal as S
from ..operators import splits as SP
from ..operators import stats as ST
from ..operators.index import build_snapshot, snapshot_metadata
from ..session import cut_lineage
from ..sources import snapshot as SN
from ..sources.ticks import brand_bars, daily_bars, read_table
from . import oracle as O
from .catalog import (BAR_DOUBLES, INDEX_COVERAGE, INDEX_SPAN, _bars_ctes, bars_once, market_for, register,
                      rounded, sel_rounded)

BARS = _bars_ctes()
IDX = O.index_ctes(min_coverage=INDEX_COVERAGE)
TGT = C.TARGET_COLUMN


def bar_cols(prefix: str = "") -> str:
    return ", ".join([f"{prefix}{c} AS {c}" for c in ("symbol", "date", "volume")]
                     + [O.rnd(prefix + c, c) for c in BAR_DOUBLES])


# ---------------------------------------------------------------------------
# quality
# ---------------------------------------------------------------------------
def _validation_sql(bars_ctes, min_rows: int = C.MIN_ROWS_REQUIRED) -> str:
    agg = f"""SELECT symbol, count(*) AS rows, count(*) - count(DISTINCT date) AS duplicates,
       count_if(open <= 0 OR high <= 0 OR low <= 0 OR close <= 0) AS non_positive,
       count_if(high < low) AS bad_range, count_if(volume < 0) AS negative_volume,
       sum(CAST(open IS NULL AS INTEGER) + CAST(high IS NULL AS INTEGER) + CAST(low IS NULL AS INTEGER)
           + CAST(close IS NULL AS INTEGER) + CAST(volume IS NULL AS INTEGER)) / (count(*) * 5.0) AS null_share
FROM bars GROUP BY symbol"""
    fails = f"""SELECT symbol, rows, null_share, list_filter([
   CASE WHEN duplicates > 0 THEN printf('%d duplicated timestamp(s)', duplicates) END,
   CASE WHEN rows < {min_rows} THEN printf('only %d rows, need at least {min_rows}', rows) END,
   CASE WHEN non_positive > 0 THEN 'non-positive price(s) present' END,
   CASE WHEN bad_range > 0 THEN printf('%d row(s) with high < low', bad_range) END,
   CASE WHEN negative_volume > 0 THEN 'negative volume present' END,
   CASE WHEN null_share > {C.NULL_SHARE_MAX} THEN printf('%.1f%% of OHLCV cells are null', null_share * 100) END
  ], lambda x: x IS NOT NULL) AS fails,
  CASE WHEN null_share > 0 AND null_share <= {C.NULL_SHARE_MAX}
       THEN printf('%.2f%% null cells (tolerated)', null_share * 100) END AS tol
FROM agg"""
    final = """SELECT symbol, rows, len(fails) = 0 AS passed,
       array_to_string(list_concat(fails, list_filter([tol], lambda x: x IS NOT NULL)), '; ') AS message,
       printf('[%s] %s: %d rows, %d warning(s)', CASE WHEN len(fails) = 0 THEN 'OK' ELSE 'FAILED' END,
              symbol, rows, len(list_concat(fails, list_filter([tol], lambda x: x IS NOT NULL)))) AS summary
FROM f"""
    return O.sql(bars_ctes + [("agg", agg), ("f", fails)], final)


@register("validation_report", _validation_sql(BARS))
def q_validation_report(spark, sf):
    return Q.validation_report(daily_bars(spark, sf)).drop("warnings")


@register("validation_report_brand", _validation_sql([("bars", O.bars_lineitem())]))
def q_validation_report_brand(spark, sf):
    return Q.validation_report(brand_bars(spark, sf)).drop("warnings")


@register("panel_skipped", O.sql([("bars", O.bars_lineitem()), ("agg", f"""SELECT symbol, count(*) AS rows
FROM bars GROUP BY symbol""")], f"""SELECT symbol, symbol || ': only ' || rows || ' rows, need at least {C.MIN_ROWS_REQUIRED}' AS reason
FROM agg WHERE rows < {C.MIN_ROWS_REQUIRED}"""))
def q_panel_skipped(spark, sf):
    """F42 skipped list for the brand panel (validation failures)."""
    _, skipped = Q.valid_bars(brand_bars(spark, sf))
    return skipped


#: Damage done to the brand bars, by the last digit of the brand: 1 repeats the
#: first of each month, 2 has highs below lows in January, 3 negative volume in
#: February, 4 no open in the first half-year, 5 negative closes on each 15th.
_DAMAGED = """SELECT symbol, date, CASE WHEN right(symbol, 1) = '4' AND month(date) <= 6 THEN NULL ELSE open END AS open,
       CASE WHEN right(symbol, 1) = '2' AND month(date) = 1 THEN low - 1 ELSE high END AS high, low,
       CASE WHEN right(symbol, 1) = '5' AND day(date) = 15 THEN -1.0 ELSE close END AS close, adj_close,
       CASE WHEN right(symbol, 1) = '3' AND month(date) = 2 THEN -volume ELSE volume END AS volume FROM bars0"""
DAMAGED = [("bars0", O.bars_lineitem()), ("bars1", _DAMAGED),
           ("bars", "SELECT * FROM bars1 UNION ALL SELECT * FROM bars1 WHERE right(symbol, 1) = '1' AND day(date) = 1")]


def damaged_bars(spark, sf) -> DataFrame:
    """Brand bars with every fault that the validation looks for."""
    kind = F.substring("symbol", -1, 1)
    hit = lambda digit, cond: (kind == digit) & cond
    b = brand_bars(spark, sf).select(
        "symbol", "date", F.when(~hit("4", F.month("date") <= 6), F.col("open")).alias("open"),
        F.when(hit("2", F.month("date") == 1), F.col("low") - 1).otherwise(F.col("high")).alias("high"), "low",
        F.when(hit("5", F.dayofmonth("date") == 15), F.lit(-1.0)).otherwise(F.col("close")).alias("close"), "adj_close",
        F.when(hit("3", F.month("date") == 2), -F.col("volume")).otherwise(F.col("volume")).alias("volume"))
    b = cut_lineage(b, "damaged")
    return b.unionByName(b.filter(hit("1", F.dayofmonth("date") == 1)))


@register("validation_report_damaged", _validation_sql(DAMAGED))
def q_validation_report_damaged(spark, sf):
    """V5-V11 over bars that fail each check."""
    return Q.validation_report(damaged_bars(spark, sf)).drop("warnings")


@register("panel_skipped_damaged", O.sql([("rep", _validation_sql(DAMAGED))], "SELECT symbol, symbol || ': ' || message AS reason FROM rep WHERE NOT passed"))
def q_panel_skipped_damaged(spark, sf):
    """F42 skipped list where symbols fail."""
    return Q.valid_bars(damaged_bars(spark, sf))[1]


# ---------------------------------------------------------------------------
# sources (S3, S4, S7, S15, W16) and the snapshot
# ---------------------------------------------------------------------------
@register("symbols_list", O.sql(BARS, "SELECT DISTINCT symbol FROM bars"))
def q_symbols_list(spark, sf):
    return SN.available_symbols(daily_bars(spark, sf))


FETCH_SYMBOL = "3-MEDIUM"


@register("fetch_symbol", O.sql(BARS, f"SELECT {bar_cols()} FROM bars WHERE symbol = '{FETCH_SYMBOL}'"))
def q_fetch_symbol(spark, sf):
    return rounded(SN.fetch(daily_bars(spark, sf), FETCH_SYMBOL))


LOOKBACK_YEARS = 3


@register("lookback_filter", O.sql(BARS + [("ends", "SELECT symbol, max(date) AS end_date FROM bars GROUP BY symbol")],
                                   f"""SELECT {bar_cols('b.')} FROM bars b JOIN ends e ON b.symbol = e.symbol
WHERE b.date >= e.end_date - {int(365.25 * LOOKBACK_YEARS)}"""))
def q_lookback_filter(spark, sf):
    return rounded(SN.lookback(daily_bars(spark, sf), LOOKBACK_YEARS))


REQUESTED = ("1-URGENT", "2-HIGH", "5-LOW", "6-UNKNOWN", "0-NONE")


@register("missing_symbols", O.sql(BARS, f"""SELECT symbol FROM (VALUES {', '.join(f"('{s}')" for s in REQUESTED)}) t(symbol)
WHERE symbol NOT IN (SELECT DISTINCT symbol FROM bars)"""))
def q_missing_symbols(spark, sf):
    return SN.missing_symbols(spark, daily_bars(spark, sf), list(REQUESTED))


@register("dedupe_keep_last", O.sql([], f"""SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
       arg_max(o_orderkey, o_orderkey) AS o_orderkey, {O.rnd('arg_max(o_totalprice, o_orderkey)', 'o_totalprice')}
FROM orders GROUP BY 1, 2"""))
def q_dedupe_keep_last(spark, sf):
    o = read_table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("date"),
        "o_orderkey", "o_totalprice")
    return rounded(SN.dedupe_keep_last(o, ["symbol", "date"], "o_orderkey"))


@register("snapshot", O.sql(BARS + IDX + [("snap", "SELECT * FROM bars UNION ALL SELECT * FROM idx")],
                            f"""SELECT symbol, date, {', '.join(O.rnd(f'round({c}, 4)', c) for c in BAR_DOUBLES)}, volume FROM snap"""))
def q_snapshot(spark, sf):
    return rounded(build_snapshot(bars_once(spark, sf), min_coverage=INDEX_COVERAGE, require_span=INDEX_SPAN, require_members=False))


@register("snapshot_metadata", O.sql(BARS + IDX + [
    ("snap", "SELECT * FROM bars UNION ALL SELECT * FROM idx"),
    ("per", f"SELECT symbol, count(DISTINCT date) AS n FROM snap WHERE symbol <> '{C.MARKET_SYMBOL}' GROUP BY symbol")],
    f"""SELECT (SELECT count(*) FROM snap) AS rows, (SELECT min(date) FROM snap) AS start_date,
       (SELECT max(date) FROM snap) AS end_date, min(n) AS sessions_min,
       {O.rnd('median(n)', 'sessions_median')}, max(n) AS sessions_max, count(*) AS n_equities,
       '{C.MARKET_SYMBOL}' AS market_index_symbol
FROM per"""))
def q_snapshot_metadata(spark, sf):
    snap = build_snapshot(bars_once(spark, sf), min_coverage=INDEX_COVERAGE, require_span=INDEX_SPAN, require_members=False)
    return rounded(snapshot_metadata(snap))


# ---------------------------------------------------------------------------
# descriptive statistics
# ---------------------------------------------------------------------------
RET = BARS + [("r0", f"""SELECT *, last_value(close IGNORE NULLS) OVER {O.RUN} AS fc FROM bars"""),
              ("ret", f"""SELECT *, {O.div('fc', f'lag(fc) OVER {O.W}')} - 1 AS daily_return FROM r0""")]


@register("price_summary", O.sql(RET + [("dd", f"""SELECT *, CASE WHEN close IS NOT NULL THEN
       close / max(close) OVER {O.RUN} - 1 END AS dd FROM ret""")],
    f"""SELECT symbol, count(*) AS observations, min(date) AS start_date, max(date) AS end_date,
  {O.rnd('CASE WHEN count(*) > 1 THEN arg_max(close, date) / arg_min(close, date) - 1 ELSE 0.0 END * 100', 'total_return_pct')},
  {O.rnd('''CASE WHEN count(daily_return) = 0 THEN 0.0 WHEN product(1 + daily_return) <= 0 THEN -1.0
       ELSE pow(product(1 + daily_return), 252.0 / count(daily_return)) - 1 END * 100''', 'annualised_return_pct')},
  {O.rnd(f'CASE WHEN count(daily_return) < 2 THEN 0.0 ELSE stddev_samp(daily_return) * {ST.SQRT_YEAR!r} END * 100', 'annualised_volatility_pct')},
  {O.rnd('coalesce(max(daily_return), 0.0) * 100', 'largest_daily_gain_pct')},
  {O.rnd('coalesce(min(daily_return), 0.0) * 100', 'largest_daily_loss_pct')},
  {O.rnd('CASE WHEN count(close) < 2 THEN 0.0 ELSE min(dd) END * 100', 'max_drawdown_pct')},
  {O.rnd('coalesce(avg(CASE WHEN daily_return IS NOT NULL THEN CAST(daily_return > 0 AS DOUBLE) END), 0.0) * 100', 'up_day_share_pct')}
FROM dd GROUP BY symbol"""))
def q_price_summary(spark, sf):
    return rounded(ST.price_summary(daily_bars(spark, sf)))


@register("max_drawdown", O.sql(BARS + [("dd", f"""SELECT symbol, date, close / max(close) OVER {O.RUN} - 1 AS dd
FROM bars WHERE close IS NOT NULL""")], f"""SELECT symbol, {O.rnd('CASE WHEN count(*) < 2 THEN 0.0 ELSE min(dd) END', 'max_drawdown')},
       arg_min(date, {{'d': dd, 't': date}}) AS trough_date FROM dd GROUP BY symbol"""))
def q_max_drawdown(spark, sf):
    return rounded(ST.max_drawdown(daily_bars(spark, sf)))


_MONTHLY = BARS + [
    ("m", """SELECT symbol, date_trunc('month', date) AS month_start, arg_max(close, date) AS month_close
FROM bars WHERE close IS NOT NULL GROUP BY 1, 2"""),
    ("span", "SELECT symbol, min(month_start) AS a, max(month_start) AS b FROM m GROUP BY symbol"),
    ("spine", """SELECT symbol, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM span"""),
    ("s", """SELECT sp.symbol, sp.month_start, last_value(m.month_close IGNORE NULLS) OVER
       (PARTITION BY sp.symbol ORDER BY sp.month_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fc
FROM spine sp LEFT JOIN m ON sp.symbol = m.symbol AND sp.month_start = m.month_start"""),
    ("mr", f"""SELECT symbol, month_start, ({O.div('fc', 'lag(fc) OVER (PARTITION BY symbol ORDER BY month_start)')} - 1) * 100 AS return_pct
FROM s"""),
]


@register("monthly_returns", O.sql(_MONTHLY, f"""SELECT symbol, CAST(year(month_start) AS INTEGER) AS year,
       CAST(month(month_start) AS INTEGER) AS month, strftime(month_start, '%b') AS month_name,
       {O.rnd('return_pct', 'return_pct')} FROM mr WHERE return_pct IS NOT NULL"""))
def q_monthly_returns(spark, sf):
    return rounded(ST.monthly_returns(bars_once(spark, sf)))


@register("monthly_return_table", O.sql(_MONTHLY, "SELECT symbol, CAST(year(month_start) AS INTEGER) AS year, " + ", ".join(
    O.rnd(f"avg(CASE WHEN month(month_start) = {i + 1} THEN return_pct END)", m) for i, m in enumerate(C.MONTH_NAMES))
    + " FROM mr WHERE return_pct IS NOT NULL GROUP BY 1, 2"))
def q_monthly_return_table(spark, sf):
    return rounded(ST.monthly_return_table(bars_once(spark, sf)))


@register("weekday_returns", O.sql(RET, f"""SELECT symbol, CAST(isodow(date) - 1 AS INTEGER) AS weekday_index,
       {O.rnd('avg(daily_return) * 100', 'mean_return_pct')}, count(*) AS observations,
       strftime(any_value(date), '%A') AS weekday
FROM ret WHERE daily_return IS NOT NULL AND isodow(date) <= 5 GROUP BY 1, 2"""))
def q_weekday_returns(spark, sf):
    return rounded(ST.weekday_returns(daily_bars(spark, sf)))


@register("up_down", O.sql(RET, """SELECT symbol, count_if(daily_return > 0) AS up_days,
       count_if(daily_return <= 0) AS down_days FROM ret WHERE daily_return IS NOT NULL GROUP BY symbol"""))
def q_up_down(spark, sf):
    return ST.up_down(daily_bars(spark, sf))


_B = C.HISTOGRAM_BINS


@register("return_histogram", O.sql(RET + [("h", """SELECT symbol, daily_return * 100 AS r,
       min(daily_return * 100) OVER (PARTITION BY symbol) AS lo, max(daily_return * 100) OVER (PARTITION BY symbol) AS hi,
       avg(daily_return * 100) OVER (PARTITION BY symbol) AS mean_r FROM ret WHERE daily_return IS NOT NULL"""),
    ("hb", f"""SELECT *, CAST(CASE WHEN hi - lo > 0 THEN least(floor((r - lo) / (hi - lo) * {_B}), {_B - 1}) ELSE 0 END AS INTEGER) AS bin FROM h""")],
    f"""SELECT symbol, bin, count(*) AS count, {O.rnd(f'any_value(lo) + (any_value(hi) - any_value(lo)) * bin / {_B}', 'bin_start')},
       {O.rnd('any_value(mean_r)', 'mean_return_pct')} FROM hb GROUP BY symbol, bin"""))
def q_return_histogram(spark, sf):
    return rounded(ST.return_histogram(daily_bars(spark, sf)))


@register("annualised_vol", O.sql(RET, "SELECT symbol, date, " + ", ".join(
    O.rnd(f"{O.full('daily_return', n, 'stddev_samp')} * {ST.SQRT_YEAR!r} * 100", f"volatility_{n}d_pct")
    for n in C.VOLATILITY_WINDOWS) + " FROM ret"))
def q_annualised_vol(spark, sf):
    return rounded(ST.rolling_volatility(daily_bars(spark, sf)))


@register("price_series", O.sql(BARS, "SELECT symbol, date, " + O.rnd("close", "close") + ", " + ", ".join(
    O.rnd(O.full("close", n, "avg"), f"sma_{n}") for n in (5, 20, 50)) + ", volume, "
    + O.rnd(O.full("CAST(volume AS DOUBLE)", 20, "avg"), "volume_sma_20") + " FROM bars"))
def q_price_series(spark, sf):
    return rounded(ST.price_series(daily_bars(spark, sf)))


@register("last_n_bars", O.sql(BARS, f"""SELECT * FROM (SELECT {bar_cols()},
       row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS recency FROM bars)
WHERE recency <= {C.RAW_VIEW_ROWS}"""))
def q_last_n_bars(spark, sf):
    return rounded(ST.last_n_bars(daily_bars(spark, sf)))


def _feat_all_ctes() -> list:
    return BARS + IDX + O.feature_ctes(market="mkt")


@register("latest_indicators", O.sql(_feat_all_ctes(), f"""SELECT symbol, max(date) AS as_of,
       {O.rnd('arg_max(rsi_14, CASE WHEN rsi_14 IS NOT NULL THEN date END)', 'rsi_14')},
       {O.rnd('arg_max(macd_hist, CASE WHEN macd_hist IS NOT NULL THEN date END)', 'macd_hist')},
       {O.rnd('arg_max(bb_position, CASE WHEN bb_position IS NOT NULL THEN date END)', 'bb_position')},
       {O.rnd('arg_max(close_to_sma20 * 100, CASE WHEN close_to_sma20 IS NOT NULL THEN date END)', 'close_vs_sma20_pct')},
       CASE WHEN arg_max(rsi_14, CASE WHEN rsi_14 IS NOT NULL THEN date END) > 70 THEN 'overbought'
            WHEN arg_max(rsi_14, CASE WHEN rsi_14 IS NOT NULL THEN date END) < 30 THEN 'oversold' END AS rsi_flag
FROM feat GROUP BY symbol"""))
def q_latest_indicators(spark, sf):
    bars = bars_once(spark, sf)
    return rounded(ST.latest_indicators(FE.all_feature_columns(bars, market_for(bars))))


# ---------------------------------------------------------------------------
# scored matrix shared by splits, metrics and the signal study
# ---------------------------------------------------------------------------
def scored(spark, sf) -> DataFrame:
    """Feature matrix + deterministic P(up) (``p_up``), ``y`` and ``pred``."""
    bars = bars_once(spark, sf)
    fm = FE.feature_matrix(bars, market_for(bars))
    return cut_lineage(fm.select("symbol", "date", F.col(TGT).alias("y"), "daily_return", "next_day_return",
                                 "close_to_sma20", M.deterministic_score().alias("p_up"))
                       .withColumn("pred", M.threshold("p_up")))


def _scored_ctes() -> list:
    where = O.matrix_filter(FE.BASE_FEATURES, FE.MARKET_FEATURES, ["next_day_return"])
    return _feat_all_ctes() + [("sc0", f"""SELECT symbol, date, target_up_next_day AS y, daily_return, next_day_return,
       close_to_sma20, 1.0 / (1.0 + exp(-{C.SCORE_SLOPE!r} * close_to_sma20)) AS p_up FROM feat WHERE {where}"""),
        ("sc", "SELECT *, CAST(p_up >= 0.5 AS INTEGER) AS pred FROM sc0")]


def _date_split_ctes(tr=C.TRAIN_FRACTION, va=C.VALIDATION_FRACTION) -> list:
    return _scored_ctes() + [
        ("dcal", "SELECT date, row_number() OVER (ORDER BY date) - 1 AS date_idx, count(*) OVER () AS n_dates FROM (SELECT DISTINCT date FROM sc)"),
        ("dsplit", f"""SELECT date, date_idx, n_dates, CASE WHEN date_idx <= floor(n_dates * {tr!r}) - 1 THEN 'train'
       WHEN date_idx <= floor(n_dates * {tr + va!r}) - 1 THEN 'validation' ELSE 'test' END AS split FROM dcal"""),
        ("ds", "SELECT sc.*, dsplit.split FROM sc JOIN dsplit ON sc.date = dsplit.date")]


def date_split(spark, sf) -> DataFrame:
    return cut_lineage(SP.split_by_dates(scored(spark, sf)))


def _row_split_ctes(tr=C.TRAIN_FRACTION, va=C.VALIDATION_FRACTION) -> list:
    return _scored_ctes() + [
        ("rp", "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n FROM sc"),
        ("rs", f"""SELECT * EXCLUDE (pos, n), CASE WHEN n < {C.MIN_SPLIT_ROWS} THEN NULL WHEN pos < floor(n * {tr!r}) THEN 'train'
       WHEN pos < floor(n * {tr + va!r}) THEN 'validation' ELSE 'test' END AS split FROM rp""")]


def row_split(spark, sf) -> DataFrame:
    return cut_lineage(SP.split_by_rows(scored(spark, sf)))


# ---------------------------------------------------------------------------
# splits
# ---------------------------------------------------------------------------
@register("split_rows", O.sql(_row_split_ctes(), """SELECT symbol, split, count(*) AS rows, min(date) AS first_date,
       max(date) AS last_date FROM rs GROUP BY symbol, split"""))
def q_split_rows(spark, sf):
    return row_split(spark, sf).groupBy("symbol", "split").agg(
        F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@register("split_dates", O.sql(_date_split_ctes(), "SELECT date, split FROM dsplit"))
def q_split_dates(spark, sf):
    return SP.session_splits(scored(spark, sf)).select("date", "split")


@register("split_bounds", O.sql(_date_split_ctes(), """SELECT split, min(date) AS first_date, max(date) AS last_date,
       count(*) AS sessions FROM dsplit GROUP BY split"""))
def q_split_bounds(spark, sf):
    return SP.split_bounds(scored(spark, sf))


@register("split_sizes", O.sql(_date_split_ctes(), f"""SELECT split, count(*) AS rows, min(date) AS first_date,
       max(date) AS last_date, {O.rnd('avg(CAST(y AS DOUBLE))', 'class_balance')} FROM ds GROUP BY split"""))
def q_split_sizes(spark, sf):
    return rounded(SP.split_sizes(date_split(spark, sf).withColumnRenamed("y", TGT)))


@register("split_order_check", O.sql(_date_split_ctes() + [("blk", """SELECT split, CASE split WHEN 'train' THEN 0
       WHEN 'validation' THEN 1 ELSE 2 END AS block, count(*) AS rows, min(date) AS first_date, max(date) AS last_date
FROM ds GROUP BY split""")],
    """SELECT split, block, rows, first_date, last_date,
       coalesce(lag(last_date) OVER (ORDER BY block) < first_date, true) AS after_previous FROM blk"""))
def q_split_order_check(spark, sf):
    return Q.split_order_check(date_split(spark, sf))


@register("cv_folds", O.sql(_row_split_ctes() + [
    ("tr", """SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos,
       count(*) OVER (PARTITION BY symbol) AS n FROM rs WHERE split = 'train'"""),
    ("fx", f"""SELECT symbol, date, pos, n, fold, n - ({C.CV_SPLITS} - fold + 1) * (n // {C.CV_SPLITS + 1}) AS st,
       n // {C.CV_SPLITS + 1} AS ts FROM tr, range(1, {C.CV_SPLITS + 1}) f(fold)"""),
    ("fr", """SELECT symbol, date, fold, CASE WHEN pos < st THEN 'train' WHEN pos < st + ts THEN 'test' END AS role FROM fx""")],
    """SELECT symbol, CAST(fold AS INTEGER) AS fold, role, count(*) AS rows, min(date) AS first_date, max(date) AS last_date
FROM fr WHERE role IS NOT NULL GROUP BY 1, 2, 3"""))
def q_cv_folds(spark, sf):
    tr = row_split(spark, sf).filter(F.col("split") == "train")
    return SP.cv_fold_summary(tr)


# ---------------------------------------------------------------------------
# metrics (deterministic score on the date-split panel)
# ---------------------------------------------------------------------------
_SCORE_SQL = """SELECT {g}, {acc}, {prec}, {rec}, {f1}, CAST(count(*) AS BIGINT) AS support,
       {pr}, {ppr} FROM {src} GROUP BY {g}"""


def _scorecard_sql(src: str, group: str) -> str:
    tp, fp = "count_if(y = 1 AND pred = 1)", "count_if(y = 0 AND pred = 1)"
    fn, tn = "count_if(y = 1 AND pred = 0)", "count_if(y = 0 AND pred = 0)"
    return _SCORE_SQL.format(
        g=group, src=src,
        acc=O.rnd(f"CAST({tp} + {tn} AS DOUBLE) / count(*)", "accuracy"),
        prec=O.rnd(f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fp}, 0), 0.0)", "precision"),
        rec=O.rnd(f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fn}, 0), 0.0)", "recall"),
        f1=O.rnd(f"coalesce(2.0 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0.0)", "f1"),
        pr=O.rnd(f"CAST({tp} + {fn} AS DOUBLE) / count(*)", "positive_rate"),
        ppr=O.rnd(f"CAST({tp} + {fp} AS DOUBLE) / count(*)", "predicted_positive_rate"))


def _auc_ctes(src: str, group: str) -> list:
    return [("sagg", f"""SELECT {group}, p_up, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM {src}
WHERE p_up IS NOT NULL AND y IS NOT NULL GROUP BY {group}, p_up"""),
            ("scum", f"""SELECT *, coalesce(sum(neg) OVER (PARTITION BY {group} ORDER BY p_up
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
       coalesce(sum(pos) OVER (PARTITION BY {group} ORDER BY p_up
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below FROM sagg"""),
            ("auc", f"""SELECT {group}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
       THEN sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)) END AS roc_auc FROM scum GROUP BY {group}""")]


@register("metrics_scorecard", O.sql(_date_split_ctes() + [("card", _scorecard_sql("ds", "split"))] + _auc_ctes("ds", "split"),
                                     f"SELECT card.*, {O.rnd('auc.roc_auc', 'roc_auc')} FROM card LEFT JOIN auc USING (split)"))
def q_metrics_scorecard(spark, sf):
    return rounded(M.scorecard(date_split(spark, sf), ["split"]))


@register("confusion", O.sql(_date_split_ctes(), """SELECT split, a.actual, a.predicted, count_if(y = a.actual AND pred = a.predicted) AS count
FROM ds, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) a(actual, predicted) GROUP BY split, a.actual, a.predicted"""))
def q_confusion(spark, sf):
    return M.confusion(date_split(spark, sf), ["split"])


@register("roc_auc", O.sql(_row_split_ctes() + _auc_ctes("rs", "symbol, split"),
                           f"SELECT symbol, split, {O.rnd('roc_auc', 'roc_auc')} FROM auc"))
def q_roc_auc(spark, sf):
    return rounded(M.roc_auc(row_split(spark, sf), ["symbol", "split"]))


@register("roc_points", O.sql(_date_split_ctes() + _auc_ctes("ds", "split")[:2] + [
    ("tot", "SELECT split, sum(pos) AS P, sum(neg) AS N FROM sagg GROUP BY split")],
    f"""SELECT scum.split, {O.rnd('p_up', 'threshold')}, {O.rnd('(N - neg_below) / nullif(N, 0)', 'fpr')},
       {O.rnd('(P - pos_below) / nullif(P, 0)', 'tpr')} FROM scum JOIN tot USING (split)
UNION ALL SELECT split, NULL, 0.0, 0.0 FROM tot"""))
def q_roc_points(spark, sf):
    return rounded(M.roc_points(date_split(spark, sf), ["split"]))


def _baseline_ctes() -> list:
    return _date_split_ctes() + [
        ("maj", "SELECT CASE WHEN avg(CAST(y AS DOUBLE)) > 0.5 THEN 1 ELSE 0 END AS majority FROM ds WHERE split = 'train'"),
        ("bp", """SELECT 'baseline_momentum_persistence' AS model_key, y, coalesce(CAST(daily_return > 0 AS INTEGER), 0) AS pred
FROM ds WHERE split = 'test'
UNION ALL SELECT 'baseline_majority_class', y, (SELECT majority FROM maj) FROM ds WHERE split = 'test'""")]


@register("baselines", O.sql(_baseline_ctes() + [("card", _scorecard_sql("bp", "model_key"))], "SELECT * FROM card"))
def q_baselines(spark, sf):
    ds = date_split(spark, sf).withColumn("panel", F.lit("panel"))
    bp = M.baseline_predictions(ds, ["panel"])
    return rounded(M.scorecard(bp, ["model_key"], proba=None).drop("roc_auc"))


@register("comparison_table", O.sql(
    _baseline_ctes() + [("card", _scorecard_sql("bp", "model_key")),
                        ("mt", "SELECT 'sma20_score' AS model_key, y, pred, p_up FROM ds WHERE split = 'test'"),
                        ("mcard", _scorecard_sql("mt", "model_key"))] + _auc_ctes("mt", "model_key"),
    f"""SELECT model_key, accuracy AS test_accuracy, precision AS test_precision, recall AS test_recall, f1 AS test_f1,
       {O.rnd('auc.roc_auc', 'test_roc_auc')}, starts_with(model_key, 'baseline_') AS is_baseline
FROM mcard LEFT JOIN auc USING (model_key)
UNION ALL SELECT model_key, accuracy, precision, recall, f1, NULL, true FROM card"""))
def q_comparison_table(spark, sf):
    from ..operators.report import comparison_table
    ds = date_split(spark, sf).withColumn("panel", F.lit("panel"))
    test = ds.filter(F.col("split") == "test").withColumn("model_key", F.lit("sma20_score"))
    models = M.scorecard(test, ["model_key"])
    base = M.scorecard(M.baseline_predictions(ds, ["panel"]), ["model_key"], proba=None)
    return rounded(comparison_table(models, base))


def _per_symbol_ctes() -> list:
    """Per-symbol test metrics of two fixed scores plus both baselines."""
    return _row_split_ctes() + [
        ("mt", """SELECT symbol, 'sma20_score' AS model_key, y, pred, p_up FROM rs WHERE split = 'test'
UNION ALL SELECT symbol, 'inverse_sma20_score', y, CAST(1 - p_up >= 0.5 AS INTEGER), 1 - p_up FROM rs WHERE split = 'test'"""),
        ("mcard", _scorecard_sql("mt", "symbol, model_key"))] + _auc_ctes("mt", "symbol, model_key") + [
        ("maj", """SELECT symbol, CASE WHEN avg(CAST(y AS DOUBLE)) > 0.5 THEN 1 ELSE 0 END AS majority FROM rs
WHERE split = 'train' GROUP BY symbol"""),
        ("bl", """SELECT t.symbol, avg(CAST(t.y = coalesce(m.majority, 0) AS DOUBLE)) AS majority_baseline_accuracy,
       avg(CAST(t.y = coalesce(CAST(t.daily_return > 0 AS INTEGER), 0) AS DOUBLE)) AS momentum_baseline_accuracy
FROM rs t LEFT JOIN maj m ON t.symbol = m.symbol WHERE t.split = 'test' GROUP BY t.symbol"""),
        ("pt", """SELECT mcard.symbol, mcard.model_key, mcard.support AS observations, mcard.accuracy AS test_accuracy,
       mcard.f1 AS test_f1, auc.roc_auc AS test_roc_auc, bl.majority_baseline_accuracy, bl.momentum_baseline_accuracy
FROM mcard LEFT JOIN auc ON mcard.symbol = auc.symbol AND mcard.model_key = auc.model_key
JOIN bl ON mcard.symbol = bl.symbol""")]


def per_symbol_table(spark, sf) -> DataFrame:
    from ..operators.report import per_symbol_rows
    rs = row_split(spark, sf)
    test = rs.filter(F.col("split") == "test")
    t = test.withColumn("model_key", F.lit("sma20_score")).unionByName(
        test.withColumn("model_key", F.lit("inverse_sma20_score"))
        .withColumn("p_up", F.lit(1.0) - F.col("p_up")).withColumn("pred", M.threshold("p_up")))
    cards = M.scorecard(t, ["symbol", "model_key"])
    return per_symbol_rows(cards, rs)


@register("per_symbol_metrics", O.sql(_per_symbol_ctes(), f"""SELECT symbol, model_key, observations,
       {O.rnd('test_accuracy', 'test_accuracy')}, {O.rnd('test_f1', 'test_f1')}, {O.rnd('test_roc_auc', 'test_roc_auc')},
       {O.rnd('majority_baseline_accuracy', 'majority_baseline_accuracy')},
       {O.rnd('momentum_baseline_accuracy', 'momentum_baseline_accuracy')} FROM pt"""))
def q_per_symbol_metrics(spark, sf):
    return rounded(per_symbol_table(spark, sf))


@register("best_per_symbol", O.sql(_per_symbol_ctes() + [("best", """SELECT * FROM (SELECT *, row_number() OVER
       (PARTITION BY symbol ORDER BY test_roc_auc DESC NULLS LAST, model_key) AS rk FROM pt) WHERE rk = 1""")],
    f"""SELECT symbol, model_key, {O.rnd('test_roc_auc', 'test_roc_auc')},
       {O.rnd('median(test_roc_auc) OVER ()', 'biased_median_auc')} FROM best"""))
def q_best_per_symbol(spark, sf):
    from ..operators.report import best_per_symbol
    return rounded(best_per_symbol(per_symbol_table(spark, sf)))


@register("model_summary", O.sql(_per_symbol_ctes(), f"""SELECT model_key, count(*) AS n_symbols,
       {O.rnd('median(test_roc_auc)', 'median_test_roc_auc')}, {O.rnd('avg(test_roc_auc)', 'mean_test_roc_auc')},
       {O.rnd('avg(CASE WHEN test_roc_auc IS NOT NULL THEN CAST(test_roc_auc > 0.5 AS DOUBLE) END)', 'share_above_half_auc')},
       {O.rnd('median(test_accuracy)', 'median_test_accuracy')}, {O.rnd('median(test_f1)', 'median_test_f1')},
       {O.rnd('avg(CAST(test_accuracy > majority_baseline_accuracy AS DOUBLE))', 'share_beating_majority')},
       {O.rnd('median(majority_baseline_accuracy)', 'median_majority_baseline')},
       {O.rnd('median(momentum_baseline_accuracy)', 'median_momentum_baseline')}
FROM pt GROUP BY model_key"""))
def q_model_summary(spark, sf):
    from ..operators.report import model_summary
    return rounded(model_summary(per_symbol_table(spark, sf)))


# ---------------------------------------------------------------------------
# signal
# ---------------------------------------------------------------------------
_LABEL = (f"CASE WHEN p_up < {C.BEARISH_THRESHOLD} THEN '{C.SIGNAL_BEARISH}' WHEN p_up > {C.BULLISH_THRESHOLD} "
          f"THEN '{C.SIGNAL_BULLISH}' ELSE '{C.SIGNAL_NEUTRAL}' END")


@register("signal_labels", O.sql(_scored_ctes(), f"SELECT symbol, date, {O.rnd('p_up', 'p_up')}, {_LABEL} AS signal FROM sc"))
def q_signal_labels(spark, sf):
    return rounded(scored(spark, sf).select("symbol", "date", "p_up", S.classify_probability().alias("signal")))


def _panel_daily_ctes() -> list:
    """Test sessions of the date split, probabilities and forward returns averaged per session."""
    return _date_split_ctes() + [("pd", """SELECT 'panel' AS series, date, avg(p_up) AS p_up, avg(next_day_return) AS fwd_return
FROM ds WHERE split = 'test' GROUP BY date""")]


def panel_daily(spark, sf) -> DataFrame:
    return S.panel_daily(date_split(spark, sf).filter(F.col("split") == "test"))


_BPS = C.TRANSACTION_COST_BPS


def _study_rows_ctes() -> list:
    run = "(PARTITION BY series ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return _panel_daily_ctes() + [
        ("a0", f"""SELECT series, date, p_up, fwd_return, CAST(p_up > {C.BULLISH_THRESHOLD} AS DOUBLE) AS position
FROM pd WHERE p_up IS NOT NULL AND fwd_return IS NOT NULL"""),
        ("a1", f"""SELECT *, coalesce(abs(position - lag(position) OVER (PARTITION BY series ORDER BY date)), position) AS turnover FROM a0"""),
        ("a2", f"SELECT *, turnover * {_BPS / 10000.0!r} AS cost, position * fwd_return - turnover * {_BPS / 10000.0!r} AS net_return FROM a1"),
        ("a2n", "SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS rn FROM a2"),
        # running products multiplied left to right, the order Spark's running frame uses
        ("eq", """SELECT series, rn, 1.0 * (1 + coalesce(net_return, 0.0)) AS strategy_equity,
       1.0 * (1 + coalesce(fwd_return, 0.0)) AS buy_hold_equity FROM a2n WHERE rn = 0
UNION ALL
SELECT s.series, s.rn, r.strategy_equity * (1 + coalesce(s.net_return, 0.0)),
       r.buy_hold_equity * (1 + coalesce(s.fwd_return, 0.0))
FROM eq r JOIN a2n s ON s.series = r.series AND s.rn = r.rn + 1"""),
        ("a3", "SELECT a2n.*, eq.strategy_equity, eq.buy_hold_equity FROM a2n JOIN eq USING (series, rn)"),
        ("rows", f"""SELECT *, strategy_equity / max(strategy_equity) OVER {run} - 1 AS strategy_drawdown,
       buy_hold_equity / max(buy_hold_equity) OVER {run} - 1 AS buy_hold_drawdown FROM a3""")]


def _ann_sql(r: str) -> tuple[str, str]:
    ann = (f"CASE WHEN count({r}) = 0 THEN 0.0 WHEN product(1 + {r}) <= 0 THEN -1.0 "
           f"ELSE pow(product(1 + {r}), 252.0 / count({r})) - 1 END")
    vol = f"coalesce(stddev_samp({r}), 0.0) * {ST.SQRT_YEAR!r}"
    return ann, vol


@register("signal_study", O.sql(_study_rows_ctes(), "SELECT series, count(*) AS observations, " + ", ".join([
    O.rnd("avg(position) * 100", "days_in_market_pct"),
    O.rnd("(product(1 + net_return) - 1) * 100", "strategy_total_return_pct"),
    O.rnd("(product(1 + fwd_return) - 1) * 100", "buy_hold_total_return_pct"),
    O.rnd(_ann_sql("net_return")[0] + " * 100", "strategy_annualised_return_pct"),
    O.rnd(_ann_sql("fwd_return")[0] + " * 100", "buy_hold_annualised_return_pct"),
    O.rnd(_ann_sql("net_return")[1] + " * 100", "strategy_annualised_volatility_pct"),
    O.rnd(_ann_sql("fwd_return")[1] + " * 100", "buy_hold_annualised_volatility_pct"),
    O.rnd("min(strategy_drawdown) * 100", "strategy_max_drawdown_pct"),
    O.rnd("min(buy_hold_drawdown) * 100", "buy_hold_max_drawdown_pct"),
    "CAST(sum(turnover) AS BIGINT) AS n_position_changes",
    O.rnd("sum(cost) * 100", "total_cost_pct"),
    f"{_BPS!r} AS transaction_cost_bps"]) + " FROM rows GROUP BY series"))
def q_signal_study(spark, sf):
    return rounded(S.signal_study(panel_daily(spark, sf), ["series"]))


@register("equity_curve", O.sql(_study_rows_ctes(), "SELECT series, date, " + ", ".join(
    [O.rnd(c, c) for c in ("position", "turnover", "net_return", "strategy_drawdown", "buy_hold_drawdown")]
    + [O.rnd_sig(c, c) for c in ("strategy_equity", "buy_hold_equity")]) + " FROM rows"))
def q_equity_curve(spark, sf):
    from .catalog import round_half_up, round_sig
    rows = S.study_rows(panel_daily(spark, sf), ["series"])
    return rows.select("series", "date",
                       *[round_half_up(c).alias(c) for c in ("position", "turnover", "net_return",
                                                             "strategy_drawdown", "buy_hold_drawdown")],
                       *[round_sig(c).alias(c) for c in ("strategy_equity", "buy_hold_equity")])


@register("signal_buckets", O.sql(_scored_ctes(), f"""SELECT symbol, {_LABEL} AS signal, count(*) AS observations,
       {O.rnd('avg(next_day_return) * 100', 'mean_next_day_return_pct')},
       {O.rnd('stddev_samp(next_day_return) * 100', 'std_next_day_return_pct')},
       CASE {_LABEL} WHEN '{C.SIGNAL_BEARISH}' THEN 0 WHEN '{C.SIGNAL_NEUTRAL}' THEN 1 ELSE 2 END AS bucket_order
FROM sc WHERE next_day_return IS NOT NULL GROUP BY 1, 2"""))
def q_signal_buckets(spark, sf):
    return rounded(S.returns_by_signal(scored(spark, sf), ["symbol"], fwd="next_day_return"))


@register("latest_signal", O.sql(_date_split_ctes(), f"""SELECT symbol, max(date) AS date, {O.rnd('arg_max(p_up, date)', 'p_up')},
       CASE WHEN arg_max(p_up, date) < {C.BEARISH_THRESHOLD} THEN '{C.SIGNAL_BEARISH}'
            WHEN arg_max(p_up, date) > {C.BULLISH_THRESHOLD} THEN '{C.SIGNAL_BULLISH}' ELSE '{C.SIGNAL_NEUTRAL}' END AS signal
FROM ds WHERE split = 'test' GROUP BY symbol"""))
def q_latest_signal(spark, sf):
    return rounded(S.latest_signal(date_split(spark, sf).filter(F.col("split") == "test"), ["symbol"]))
