"""Scans and frames over a long series without a task that holds all of it.

A series is cut into slices of ``config.SLICE_ROWS`` rows, and everything is computed
by (series, slice):

* *Positions* come from pieces of the calendar: rows are counted per piece, and the
  counts of the pieces before give each piece its first position.
* *Scans* (running sums, products, maxima, the last value so far, recursive smoothers)
  fold a slice to one row; the rows of the slices before are combined, a window over
  the slices of a series only, and handed back to the slice.
* *Frames* (lags, moving means and deviations) get *halo rows*: a slice carries the last
  rows of those before it, and the first of those after it, and drops them at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import cut_lineage

POS, SLICE, OWN = "_pos", "_slice", "_own"


def keys_of(part: str | list[str]) -> list[str]:
    return [part] if isinstance(part, str) else list(part)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by hash of the keys, in as many partitions as shuffles have: a small but
    CPU-heavy table is not folded into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def positioned(df: DataFrame, part: str | list[str] = "symbol", order: str = "date", written: bool = False) -> DataFrame:
    """Adds ``_pos``, the 0-based place of a row in its series, and ``_slice``; the result is written.

    A piece of the calendar holds SLICE_ROWS days (hours where the order is a timestamp).
    ``written``: df is a written table, so that reading it twice costs nothing."""
    keys = keys_of(part)
    df = df if written else cut_lineage(df, "series")
    unit = 3600 if isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)) else 86400
    piece = F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / F.lit(unit * C.SLICE_ROWS)).alias("_piece")
    sizes = df.groupBy(*keys, piece).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(*keys, "_piece", F.coalesce(F.sum("_n").over(_before(keys, "_piece")), F.lit(0)).alias("_first"))
    placed = dealt(df.select("*", piece).join(before, [*keys, "_piece"]), *keys, "_piece")
    pos = F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(order)) - 1 + F.col("_first")
    out = placed.select(*df.columns, pos.cast("bigint").alias(POS)).withColumn(SLICE, F.floor(F.col(POS) / F.lit(C.SLICE_ROWS)))
    return cut_lineage(out, "positions")


def _before(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def with_before(df: DataFrame, part: str | list[str], totals: dict[str, tuple[Column, object]], slices: str = SLICE) -> DataFrame:
    """Adds, for each name, what the slices before a row's slice hand on.

    totals: name -> (aggregate that folds a slice to a value, combine(name, window) over the
    slices before). df is read twice, so it should be a written table. The result is dealt
    by (series, slice)."""
    keys = keys_of(part)
    folded = df.groupBy(*keys, slices).agg(*[total.alias(name) for name, (total, _) in totals.items()])
    w = _before(keys, slices)
    before = folded.select(*keys, slices, *[combine(name, w).alias(name) for name, (_, combine) in totals.items()])
    return dealt(df.join(before, [*keys, slices]), *keys, slices)


def summed(x: Column) -> tuple:
    return F.sum(x), lambda name, w: F.coalesce(F.sum(name).over(w), F.lit(0))


def multiplied(x: Column) -> tuple:
    return F.product(x), lambda name, w: F.coalesce(F.product(name).over(w), F.lit(1.0))


def largest(x: Column) -> tuple:
    return F.max(x), lambda name, w: F.max(name).over(w)


def last_value(x: Column, pos: str = POS) -> tuple:
    """The last non-null value."""
    return F.max_by(x, F.when(x.isNotNull(), F.col(pos))), lambda name, w: F.last(name, ignorenulls=True).over(w)


def within(part: str | list[str], slices: str = SLICE, order: str = POS):
    """Window of a slice up to the current row."""
    return Window.partitionBy(*keys_of(part), slices).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def with_filled(df: DataFrame, part: str | list[str], columns: dict[str, Column]) -> DataFrame:
    """Adds each column's last non-null value so far, under the given names."""
    names = {n: f"_before{n}" for n in columns}
    found = with_before(df, part, {names[n]: last_value(x) for n, x in columns.items()})
    w = within(part)
    return found.select("*", *[F.coalesce(F.last(x, ignorenulls=True).over(w), F.col(names[n])).alias(n) for n, x in columns.items()]).drop(*names.values())


def with_halo(df: DataFrame, part: str | list[str], back: int, ahead: int = 0) -> DataFrame:
    """Every slice with the ``back`` rows before it and the ``ahead`` rows after it, dealt by (series, slice).

    A row goes to its own slice, where ``_own`` is true, and to those whose frames reach it."""
    rows = F.lit(C.SLICE_ROWS)
    reached = F.sequence(F.greatest(F.floor((F.col(POS) - F.lit(ahead)) / rows), F.lit(0).cast("bigint")), F.floor((F.col(POS) + F.lit(back)) / rows))
    copies = df.withColumn("_home", F.col(SLICE)).withColumn(SLICE, F.explode(reached))
    return dealt(copies.withColumn(OWN, F.col(SLICE) == F.col("_home")).drop("_home"), *keys_of(part), SLICE)


def without_halo(df: DataFrame) -> DataFrame:
    return df.where(OWN).drop(OWN)
