"""DuckDB twins of the registered queries, written as plain SQL text.

Each builder returns CTE text; ``sql(...)`` glues CTEs into a statement. The
exponential smoothers are written as a recursive CTE (the textbook
recurrence, row by row), an independent check of the block form used on
Spark. Divisions use ``nullif(b, 0)`` because DuckDB gives ``inf`` for x/0.
"""

from __future__ import annotations

from .. import config as C

R = 6  # decimals kept when comparing floating results


def sql(ctes: list[tuple[str, str]], final: str) -> str:
    if not ctes:
        return final
    parts = [f"{name} AS (\n{body}\n)" for name, body in ctes]
    recursive = "RECURSIVE " if any("UNION ALL" in b and "JOIN" in b and "rn + 1" in b
                                    for _, b in ctes) else ""
    return f"WITH {recursive}" + ",\n".join(parts) + "\n" + final


ROUND_LIMIT = 1e9  # |x| beyond this keeps 12 significant digits instead


def rnd_expr(expr: str, digits: int = R) -> str:
    """Round half up as the same IEEE operations on both engines:
    ``floor(x * 10^d + 0.5) / 10^d``."""
    scale = f"1e{digits}"
    return (f"(CASE WHEN ({expr}) IS NULL THEN NULL WHEN abs({expr}) < {ROUND_LIMIT} THEN floor(({expr}) * {scale} + 0.5) / {scale} "
            f"ELSE CAST(printf('%.12e', {expr}) AS DOUBLE) END)")


def rnd(expr: str, alias: str, digits: int = R) -> str:
    return f"CAST({rnd_expr(expr, digits)} AS DOUBLE) AS {alias}"


def rnd_sig(expr: str, alias: str, digits: int = 10) -> str:
    """Keep ``digits`` significant digits (for compounded values whose size
    makes an absolute rounding ask for more bits than they carry)."""
    return (f"CAST(CASE WHEN ({expr}) IS NULL THEN NULL ELSE CAST(printf('%.{digits - 1}e', {expr}) AS DOUBLE) END "
            f"AS DOUBLE) AS {alias}")


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


# ---------------------------------------------------------------------------
# bars
# ---------------------------------------------------------------------------
def bars_orders() -> str:
    return """SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
       arg_max(o_totalprice, o_orderkey) AS adj_close, CAST(count(*) AS BIGINT) AS volume
FROM orders GROUP BY 1, 2"""


def bars_events() -> str:
    return """SELECT event_type AS symbol, date_trunc('hour', ts) AS date,
       arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, ts) AS close, arg_max(value, ts) AS adj_close,
       CAST(count(*) AS BIGINT) AS volume
FROM events GROUP BY 1, 2"""


def bars_lineitem() -> str:
    return """SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
       arg_min(l_extendedprice / nullif(l_quantity, 0), {'k': l_orderkey, 'n': l_linenumber}) AS open,
       max(l_extendedprice / nullif(l_quantity, 0)) AS high,
       min(l_extendedprice / nullif(l_quantity, 0)) AS low,
       arg_max(l_extendedprice / nullif(l_quantity, 0), {'k': l_orderkey, 'n': l_linenumber}) AS close,
       arg_max(l_extendedprice / nullif(l_quantity, 0), {'k': l_orderkey, 'n': l_linenumber}) AS adj_close,
       CAST(sum(l_quantity) AS BIGINT) AS volume
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""


# ---------------------------------------------------------------------------
# index and market
# ---------------------------------------------------------------------------
def index_ctes(bars: str = "bars", min_coverage: float = 0.5, require_span: bool = False,
               base: float = 100.0) -> list[tuple[str, str]]:
    span = ("AND h.first_date = c.cal_first AND h.last_date = c.cal_last" if require_span else "")
    return [
        ("hist", f"""SELECT symbol, min(date) AS first_date, max(date) AS last_date,
       count(*) AS sessions, arg_min(close, date) AS base_close FROM {bars} GROUP BY symbol"""),
        ("cal", f"""SELECT min(date) AS cal_first, max(date) AS cal_last,
       count(DISTINCT date) AS cal_sessions FROM {bars}"""),
        ("members", f"""SELECT h.symbol, h.base_close FROM hist h, cal c
WHERE h.sessions >= {min_coverage} * c.cal_sessions {span} AND h.base_close > 0"""),
        ("idx", f"""SELECT * FROM (
  SELECT '{C.MARKET_SYMBOL}' AS symbol, b.date,
         avg(b.open / m.base_close) * {base} AS open, avg(b.high / m.base_close) * {base} AS high,
         avg(b.low / m.base_close) * {base} AS low, avg(b.close / m.base_close) * {base} AS close,
         avg(b.close / m.base_close) * {base} AS adj_close, CAST(sum(b.volume) AS BIGINT) AS volume
  FROM {bars} b JOIN members m ON b.symbol = m.symbol GROUP BY b.date)
WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
  AND volume IS NOT NULL"""),
        ("mkt_fill", """SELECT date, last_value(close IGNORE NULLS) OVER (ORDER BY date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fc FROM idx"""),
        ("mkt", f"""SELECT date, {div('fc', 'lag(fc) OVER (ORDER BY date)')} - 1 AS market_return
FROM mkt_fill"""),
    ]


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------
W = "(PARTITION BY symbol ORDER BY date)"


def frame(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


RUN = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def full(x: str, n: int, agg: str) -> str:
    return f"(CASE WHEN count({x}) OVER {frame(n)} = {n} THEN {agg}({x}) OVER {frame(n)} END)"


def ema_recursive(src: str, series: list[tuple[str, str, float]], name: str = "ema_r") -> tuple[str, str]:
    """Recursive CTE: ``series`` = [(out, input column, alpha)]. Emits y (the
    unmasked EMA) and n (count of observations) per series, keyed by
    (symbol, rn)."""
    init, step = [], []
    for out, x, a in series:
        b = 1.0 - a
        init += [f"{x} AS {out}_y", f"0 AS {out}_g", f"CAST({x} IS NOT NULL AS INTEGER) AS {out}_n"]
        step += [
            f"""CASE WHEN s.{x} IS NULL THEN r.{out}_y WHEN r.{out}_y IS NULL THEN s.{x}
      ELSE (pow({b!r}, r.{out}_g + 1) * r.{out}_y + {a!r} * s.{x}) / (pow({b!r}, r.{out}_g + 1) + {a!r}) END""",
            f"CASE WHEN s.{x} IS NULL THEN r.{out}_g + 1 ELSE 0 END",
            f"r.{out}_n + CAST(s.{x} IS NOT NULL AS INTEGER)"]
    init_sql = ", ".join(init)
    cols = []
    for out, _, _ in series:
        cols += [f"{out}_y", f"{out}_g", f"{out}_n"]
    step_sql = ",\n      ".join(f"{e} AS {c}" for e, c in zip(step, cols))
    body = f"""SELECT symbol, rn, {init_sql} FROM {src} WHERE rn = 0
UNION ALL
SELECT s.symbol, s.rn,
      {step_sql}
FROM {name} r JOIN {src} s ON s.symbol = r.symbol AND s.rn = r.rn + 1"""
    return name, body


def masked(out: str, n: int) -> str:
    return f"(CASE WHEN {out}_n >= {n} THEN {out}_y END)"


def feature_ctes(bars: str = "bars", market: str | None = "mkt") -> list[tuple[str, str]]:
    """All feature and label columns in table ``feat`` (before warm-up/dropna)."""
    ctes = [
        ("s1", f"""SELECT *, row_number() OVER {W} - 1 AS rn,
       last_value(close IGNORE NULLS) OVER {RUN} AS fc,
       last_value(CAST(volume AS DOUBLE) IGNORE NULLS) OVER {RUN} AS fv,
       lag(close) OVER {W} AS pc, lead(close) OVER {W} AS nc
FROM {bars}"""),
        ("s2", """SELECT *,
       CASE WHEN close - pc IS NULL THEN NULL WHEN close - pc > 0 THEN close - pc ELSE 0.0 END AS gain,
       CASE WHEN close - pc IS NULL THEN NULL WHEN close - pc < 0 THEN pc - close ELSE 0.0 END AS loss,
       greatest(high - low, abs(high - pc), abs(low - pc)) AS tr
FROM s1"""),
    ]
    series = []
    for n in sorted(set(C.EMA_WINDOWS) | {C.MACD_FAST, C.MACD_SLOW}):
        series.append((f"e{n}", "close", 2.0 / (n + 1.0)))
    series += [("ag", "gain", 1.0 / C.RSI_WINDOW), ("al", "loss", 1.0 / C.RSI_WINDOW),
               ("atr", "tr", 1.0 / 14)]
    ctes.append(ema_recursive("s2", series, "ema_r"))
    f, s = C.MACD_FAST, C.MACD_SLOW
    ctes.append(("s3", f"""SELECT s2.*, {', '.join(masked(o, int(round(2 / a - 1))) + ' AS ' + o
                                              for o, _, a in series[:-3])},
       {masked('ag', C.RSI_WINDOW)} AS avg_gain, {masked('al', C.RSI_WINDOW)} AS avg_loss,
       {masked('atr', 14)} AS atr14,
       {masked(f'e{f}', f)} - {masked(f'e{s}', s)} AS macd_line
FROM s2 JOIN ema_r USING (symbol, rn)"""))
    ctes.append(ema_recursive("s3", [("sg", "macd_line", 2.0 / (C.MACD_SIGNAL + 1.0))], "sig_r"))
    pct = lambda x, k: f"({div(x, f'lag({x}, {k}) OVER {W}')} - 1)"
    v = "CAST(volume AS DOUBLE)"
    mid = full("close", 20, "avg")
    spread = full("close", 20, "stddev_pop")
    upper, lower = f"({mid} + 2.0 * {spread})", f"({mid} - 2.0 * {spread})"
    smas = {n: full("close", n, "avg") for n in C.SMA_WINDOWS}
    ctes.append(("s4", f"""SELECT s3.*, {masked('sg', C.MACD_SIGNAL)} AS macd_signal_line,
       CASE WHEN avg_gain IS NULL OR avg_loss IS NULL THEN NULL WHEN avg_gain = 0 THEN 0.0
            WHEN avg_loss = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + avg_gain / avg_loss) END AS rsi14,
       {pct('fc', 1)} AS daily_return,
       CASE WHEN close / nullif(pc, 0) > 0 THEN ln(close / nullif(pc, 0)) END AS log_return,
       {div('open', 'pc')} - 1 AS overnight_return,
       {div('close', 'open')} - 1 AS intraday_return,
       {div('high - low', 'close')} AS high_low_range,
       {div('high - close', 'close')} AS close_to_high,
       {', '.join(pct('fc', k) + f' AS return_{k}d' for k in C.MOMENTUM_WINDOWS)},
       {', '.join(div('close', smas[n]) + f' - 1 AS close_to_sma{n}' for n in C.SMA_WINDOWS)},
       {div(smas[5], smas[20])} - 1 AS sma5_to_sma20,
       {div(smas[20], smas[50])} - 1 AS sma20_to_sma50,
       {div(f'close - {lower}', f'{upper} - {lower}')} AS bb_position,
       {div(f'{upper} - {lower}', mid)} AS bb_width,
       {pct('fv', 1)} AS volume_change,
       {div(v, full(v, 20, 'avg'))} AS relative_volume,
       {div(full(v, 5, 'avg'), full(v, 20, 'avg'))} AS volume_trend_5d,
       CAST(isodow(date) - 1 AS DOUBLE) AS day_of_week, CAST(month(date) AS DOUBLE) AS month,
       {div('nc', 'close')} - 1 AS next_day_return
FROM s3 JOIN sig_r USING (symbol, rn)"""))
    ctes.append(("s5", f"""SELECT *,
       {', '.join(div('close', f'e{n}') + f' - 1 AS close_to_ema{n}' for n in C.EMA_WINDOWS)},
       {div('macd_line', 'close')} AS macd, {div('macd_signal_line', 'close')} AS macd_signal,
       {div('macd_line - macd_signal_line', 'close')} AS macd_hist,
       {div('atr14', 'close')} AS atr_14_norm, rsi14 AS rsi_14,
       {', '.join(full('daily_return', n, 'stddev_samp') + f' AS volatility_{n}d' for n in C.VOLATILITY_WINDOWS)},
       {div(full('daily_return', 5, 'stddev_samp'), full('daily_return', 20, 'stddev_samp'))} AS vol_ratio_5_20,
       CASE WHEN next_day_return IS NOT NULL THEN CAST(next_day_return > 0 AS INTEGER) END AS target_up_next_day
FROM s4"""))
    if market is None:
        ctes.append(("feat", """SELECT *, CAST(NULL AS DOUBLE) AS market_return,
       CAST(NULL AS DOUBLE) AS market_return_5d, CAST(NULL AS DOUBLE) AS market_volatility_20d,
       CAST(NULL AS DOUBLE) AS excess_return, false AS market_ok FROM s5"""))
        return ctes
    ctes.append(("s6", f"""SELECT s5.*, m.market_return AS mr,
       avg(CAST(m.market_return IS NOT NULL AS DOUBLE)) OVER (PARTITION BY s5.symbol) >= {C.MARKET_COVERAGE_MIN} AS market_ok
FROM s5 LEFT JOIN {market} m ON s5.date = m.date"""))
    ctes.append(("feat", f"""SELECT *,
       CASE WHEN market_ok THEN mr END AS market_return,
       CASE WHEN market_ok THEN {full('mr', 5, 'sum')} END AS market_return_5d,
       CASE WHEN market_ok THEN {full('mr', 20, 'stddev_samp')} END AS market_volatility_20d,
       CASE WHEN market_ok THEN daily_return - mr END AS excess_return
FROM s6"""))
    return ctes


def matrix_filter(base: list[str], market: list[str], labels: list[str],
                  warmup: int = C.WARMUP_ROWS, with_market: bool = True) -> str:
    req = " AND ".join(f"{c} IS NOT NULL" for c in base + labels)
    cond = f"rn >= {warmup} AND {req}"
    if with_market:
        present = " AND ".join(f"{c} IS NOT NULL" for c in market)
        cond += f" AND (NOT market_ok OR ({present}))"
    return cond
