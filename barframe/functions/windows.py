"""Window building blocks over the long bar table.

Every positional operation is an explicit window ordered by ``date`` inside a
partition: a series, or where series are long a slice of one with the rows its
frames reach (``segments.with_halo``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage
from .segments import POS, SLICE, positioned, summed, with_before

SYMBOL = "symbol"
DATE = "date"


def win(part: str | list[str] = SYMBOL, order: str = DATE) -> WindowSpec:
    parts = [part] if isinstance(part, str) else list(part)
    return Window.partitionBy(*parts).orderBy(order)


def trailing(n: int, part=SYMBOL, order: str = DATE) -> WindowSpec:
    """``ROWS n-1 PRECEDING .. CURRENT ROW``."""
    return win(part, order).rowsBetween(-(n - 1), 0)


def running(part=SYMBOL, order: str = DATE) -> WindowSpec:
    """``ROWS UNBOUNDED PRECEDING .. CURRENT ROW``."""
    return win(part, order).rowsBetween(Window.unboundedPreceding, 0)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sdiv(a, b) -> Column:
    """Division with 0 (and null) denominators giving null (ANSI-safe)."""
    return F.try_divide(col_(a), col_(b))


def full(x, n: int, agg, part=SYMBOL, order: str = DATE, count: Column | None = None) -> Column:
    """Rolling aggregate that is null until n non-null values fill the frame
    (the ``min_periods=n`` rule). ``count`` may supply the frame's non-null
    count (e.g. from ``prefix_count``) instead of a sliding count."""
    x = col_(x)
    w = trailing(n, part, order)
    c = count if count is not None else F.count(x).over(w)
    return F.when(c == n, agg(x).over(w))


def prefix_columns(x, name: str, part=SYMBOL, order: str = DATE) -> list[Column]:
    """Running sum and running non-null count of x (``{name}_s``, ``{name}_n``):
    O(1) per row, the inputs of ``prefix_mean`` / ``prefix_count``."""
    x = col_(x)
    w = running(part, order)
    return [F.sum(x).over(w).alias(f"{name}_s"), F.count(x).over(w).alias(f"{name}_n")]


def prefix_count(name: str, n: int, part=SYMBOL, order: str = DATE) -> Column:
    """Non-null count in the trailing n rows, from the running count."""
    w = win(part, order)
    return F.col(f"{name}_n") - F.coalesce(F.lag(f"{name}_n", n).over(w), F.lit(0))


def prefix_mean(name: str, n: int, part=SYMBOL, order: str = DATE) -> Column:
    """Trailing n-row mean, null unless all n values are present, as a
    difference of running sums: O(n) instead of the O(n * w) a sliding frame
    costs (Spark re-aggregates a sliding frame for every row)."""
    w = win(part, order)
    total = F.col(f"{name}_s") - F.coalesce(F.lag(f"{name}_s", n).over(w), F.lit(0.0))
    return F.when(prefix_count(name, n, part, order) == n, total / F.lit(float(n)))


def sma(x, n: int, part=SYMBOL, order: str = DATE) -> Column:
    return full(x, n, F.avg, part, order)


def rolling_std(x, n: int, ddof: int = 1, part=SYMBOL, order: str = DATE) -> Column:
    agg = F.stddev_samp if ddof == 1 else F.stddev_pop
    return full(x, n, agg, part, order)


def rolling_sum(x, n: int, part=SYMBOL, order: str = DATE) -> Column:
    return full(x, n, F.sum, part, order)


def ffill(x, part=SYMBOL, order: str = DATE) -> Column:
    return F.last(col_(x), ignorenulls=True).over(running(part, order))


def pct_change(x, k: int = 1, part=SYMBOL, order: str = DATE, fill: bool = True) -> Column:
    """``x_t / x_{t-k} - 1`` with the forward fill applied first (pandas default)."""
    base = ffill(x, part, order) if fill else col_(x)
    return sdiv(base, F.lag(base, k).over(win(part, order))) - F.lit(1.0)


def lag(x, k: int = 1, part=SYMBOL, order: str = DATE) -> Column:
    return F.lag(col_(x), k).over(win(part, order))


def lead(x, k: int = 1, part=SYMBOL, order: str = DATE) -> Column:
    return F.lead(col_(x), k).over(win(part, order))


def diff(x, part=SYMBOL, order: str = DATE) -> Column:
    return col_(x) - lag(x, 1, part, order)


def running_peak(x, part=SYMBOL, order: str = DATE) -> Column:
    return F.max(col_(x)).over(running(part, order))


def drawdown(x, part=SYMBOL, order: str = DATE) -> Column:
    """``x / cummax(x) - 1``."""
    return col_(x) / running_peak(x, part, order) - F.lit(1.0)


def cumprod(x, part=SYMBOL, order: str = DATE) -> Column:
    return F.product(col_(x)).over(running(part, order))


def row_position(part=SYMBOL, order: str = DATE) -> Column:
    """0-based row index inside the partition."""
    return F.row_number().over(win(part, order)) - F.lit(1)


# ---------------------------------------------------------------------------
# Exponential moving averages without a UDF
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class EmaSpec:
    """``out = ewm(alpha, adjust=False, min_periods).mean()`` of column ``src``."""

    out: str
    src: str
    alpha: float
    min_periods: int

    @staticmethod
    def span(out: str, src: str, n: int) -> "EmaSpec":
        return EmaSpec(out, src, 2.0 / (n + 1.0), n)

    @staticmethod
    def wilder(out: str, src: str, n: int) -> "EmaSpec":
        return EmaSpec(out, src, 1.0 / n, n)

    @property
    def decay(self) -> float:
        return -math.log1p(-self.alpha)


#: The decay of a smoother over a slice is at most exp(-600), so that the rebased
#: prefix sum never overflows a double.
DECAY_MAX = 600.0


def with_ema(df: DataFrame, specs: list[EmaSpec], part: str = SYMBOL,
             order: str = DATE, keep_raw: bool = False) -> DataFrame:
    """Add recursive EMAs (pandas ``ewm(adjust=False)``) as columns.

    ``y_t = a_t * y_{t-1} + b_t * x_t`` where, for an observation that follows
    ``g`` rows after the previous one, ``a = beta^g / (beta^g + alpha)`` and
    ``b = alpha / (beta^g + alpha)``; the first observation seeds ``y`` and a
    null row carries it. A slice of rows folds to the map ``y -> l + P y``: inside,
    ``y = P_t * (carry + sum(b x / P))`` with ``P`` the running product of ``a`` (a
    bounded, rebased prefix sum), and the carry is the maps of all slices before it,
    composed: a long run of nulls does not decay, so none may be left out. No task
    holds more than a slice, and a series is met only as one row per slice.
    """
    for spec in specs:
        if not 0.0 < spec.alpha < 0.999:
            raise ValueError(f"alpha must be in (0, 0.999): {spec}")
    own = POS in df.columns
    df = cut_lineage(df, "smoothed") if own else positioned(df, part, order)
    keep = [c for c in df.columns if own or c not in (POS, SLICE)]
    rows = min(C.SLICE_ROWS, int(DECAY_MAX / max(s.decay for s in specs)))
    df = df.withColumn("__s", F.floor(F.col(POS) / F.lit(rows)))
    at = Window.partitionBy(part, "__s").orderBy(POS)
    run, prev = at.rowsBetween(Window.unboundedPreceding, 0), at.rowsBetween(Window.unboundedPreceding, -1)
    sources = {src: f"__{i}" for i, src in enumerate(dict.fromkeys(s.src for s in specs))}
    # what came before the slice: the place of the last observation and their number
    totals = {}
    for src, n in sources.items():
        totals[f"{n}_last"] = (F.max(F.when(F.col(src).isNotNull(), F.col(POS))), lambda name, w: F.max(name).over(w))
        totals[f"{n}_count"] = summed(F.col(src).isNotNull().cast("bigint"))
    df = with_before(df, part, totals, "__s")
    seen = []
    for src, n in sources.items():
        x = F.col(src)
        last = F.coalesce(F.max(F.when(x.isNotNull(), F.col(POS))).over(prev), F.col(f"{n}_last"))
        seen += [(F.col(POS) - last).cast("double").alias(f"{n}_gap"), (F.col(f"{n}_count") + F.count(x).over(run)).alias(f"{n}_seen")]
    coefficients = []
    for s in specs:
        x, gap = F.col(s.src), F.col(f"{sources[s.src]}_gap")
        bg = F.pow(F.lit(1.0 - s.alpha), gap)
        a = F.when(x.isNull() | gap.isNull(), F.lit(1.0)).otherwise(bg / (bg + F.lit(s.alpha)))
        b = F.when(x.isNull(), F.lit(0.0)).when(gap.isNull(), F.lit(1.0)).otherwise(F.lit(s.alpha) / (bg + F.lit(s.alpha)))
        coefficients += [a.alias(f"__a_{s.out}"), b.alias(f"__b_{s.out}")]
    products = [F.product(f"__a_{s.out}").over(run).alias(f"__p_{s.out}") for s in specs]
    local = [(F.col(f"__p_{s.out}") * F.sum(F.coalesce(F.col(f"__b_{s.out}") * F.col(s.src) / F.col(f"__p_{s.out}"), F.lit(0.0))).over(run)).alias(f"__l_{s.out}")
             for s in specs]
    df = df.select("*", *seen).select("*", *coefficients).select("*", *products).select("*", *local)
    df = cut_lineage(df.select(*keep, *([] if own else [POS]), "__s", *[f"{n}_seen" for n in sources.values()],
                               *[f"__{k}_{s.out}" for s in specs for k in ("p", "l")]), "slices")

    def fold(name, w):
        return F.aggregate(F.collect_list(name).over(w), F.lit(0.0), lambda y, e: e["l"] + e["p"] * y)
    maps = {f"__c_{s.out}": (F.max_by(F.struct(F.col(f"__p_{s.out}").alias("p"), F.col(f"__l_{s.out}").alias("l")), F.col(POS)), fold) for s in specs}
    df = with_before(df, part, maps, "__s")
    outs = []
    for s in specs:
        y = F.col(f"__l_{s.out}") + F.col(f"__p_{s.out}") * F.col(f"__c_{s.out}")
        seen_ = F.col(f"{sources[s.src]}_seen")
        outs.append(F.when(seen_ >= F.lit(s.min_periods), y).alias(s.out))
        if keep_raw:
            outs.append(F.when(seen_ >= F.lit(1), y).alias(s.out + "_raw"))
    return df.select(*keep, *outs)
