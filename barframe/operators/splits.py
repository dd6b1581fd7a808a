"""Chronological splits as a ``split`` column (never six copied frames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.windows import win

TRAIN, VALID, TEST = "train", "validation", "test"


def _check_fractions(train: float, valid: float) -> None:
    if train <= 0 or valid < 0:
        raise ValueError("fractions must be positive.")
    if train + valid >= 1.0:
        raise ValueError("train + validation fractions must leave room for a test set.")


def split_by_rows(df: DataFrame, train: float = C.TRAIN_FRACTION, valid: float = C.VALIDATION_FRACTION,
                  part: str = "symbol", min_rows: int = C.MIN_SPLIT_ROWS) -> DataFrame:
    """L1: per-symbol positional split ``[0, n*tr) [.., n*(tr+va)) [.., n)``.
    Symbols with fewer than ``min_rows`` rows get a null split."""
    _check_fractions(train, valid)
    pos = F.row_number().over(win(part)) - F.lit(1)
    n = F.count("*").over(Window.partitionBy(part))
    df = df.select("*", pos.alias("_pos"), n.alias("_n"))
    t_end = F.floor(F.col("_n") * F.lit(train))
    v_end = F.floor(F.col("_n") * F.lit(train + valid))
    label = (F.when(F.col("_n") < min_rows, F.lit(None).cast("string"))
             .when(F.col("_pos") < t_end, F.lit(TRAIN))
             .when(F.col("_pos") < v_end, F.lit(VALID)).otherwise(F.lit(TEST)))
    return df.withColumn("split", label).drop("_pos", "_n")


def split_failures(split_df: DataFrame, part: str = "symbol", min_rows: int = C.MIN_SPLIT_ROWS) -> DataFrame:
    """(symbol, reason) of the symbols that ``split_by_rows`` had too few rows to split."""
    short = split_df.filter("split IS NULL").groupBy(part).agg(F.count("*").alias("n"))
    return short.select(part, F.format_string(f"%d rows, a split takes {min_rows}", "n").alias("reason"))


def session_splits(df: DataFrame, train: float = C.TRAIN_FRACTION,
                   valid: float = C.VALIDATION_FRACTION, date_col: str = "date") -> DataFrame:
    """L2 calendar: one row per distinct session with its split label.

    The distinct-date table is bounded by the calendar length, so numbering it
    in one ordered window is cheap; the panel rows are never sorted globally.
    """
    _check_fractions(train, valid)
    dates = df.select(date_col).distinct()
    w = Window.orderBy(date_col)
    d = dates.select(date_col, (F.row_number().over(w) - F.lit(1)).alias("date_idx"),
                     F.count("*").over(Window.partitionBy()).alias("n_dates"))
    t_cut = F.floor(F.col("n_dates") * F.lit(train)) - F.lit(1)
    v_cut = F.floor(F.col("n_dates") * F.lit(train + valid)) - F.lit(1)
    label = (F.when(F.col("date_idx") <= t_cut, F.lit(TRAIN))
             .when(F.col("date_idx") <= v_cut, F.lit(VALID)).otherwise(F.lit(TEST)))
    return d.select(date_col, "date_idx", "n_dates", label.alias("split"))


def split_by_dates(df: DataFrame, train: float = C.TRAIN_FRACTION, valid: float = C.VALIDATION_FRACTION,
                   date_col: str = "date", min_dates: int = C.MIN_SPLIT_ROWS) -> DataFrame:
    """L2: the panel split on session boundaries; a session never straddles blocks."""
    cal = session_splits(df, train, valid, date_col)
    n = cal.select(F.max("n_dates")).first()[0] or 0
    if n < min_dates:
        raise ValueError(f"Need at least {min_dates} distinct sessions, got {n}.")
    return df.join(cal.select(date_col, "split"), date_col)


def split_bounds(df: DataFrame, train: float = C.TRAIN_FRACTION, valid: float = C.VALIDATION_FRACTION,
                 date_col: str = "date") -> DataFrame:
    """First and last session of each block (over the session calendar)."""
    cal = session_splits(df, train, valid, date_col)
    return cal.groupBy("split").agg(F.min(date_col).alias("first_date"),
                                    F.max(date_col).alias("last_date"),
                                    F.count("*").alias("sessions"))


def split_sizes(split_df: DataFrame) -> DataFrame:
    """Rows, period and class balance per block."""
    return split_df.groupBy("split").agg(
        F.count("*").alias("rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.avg(F.col(C.TARGET_COLUMN).cast("double")).alias("class_balance"))


def train_plus_validation(split_df: DataFrame) -> DataFrame:
    """U2."""
    return split_df.filter(F.col("split").isin(TRAIN, VALID))


def cv_folds(train_rows: DataFrame, n_splits: int = C.CV_SPLITS, part: str = "symbol",
             order: str = "date") -> DataFrame:
    """L3 expanding-window folds on each symbol's training rows: with
    ``ts = n // (k+1)``, fold i tests rows ``[n - (k-i+1) ts, n - (k-i) ts)`` and
    trains on everything before. Returns the rows with (fold, role)."""
    pos = F.row_number().over(win(part, order)) - F.lit(1)
    n = F.count("*").over(Window.partitionBy(part))
    df = train_rows.select("*", pos.alias("_pos"), n.alias("_n"))
    ts = F.floor(F.col("_n") / F.lit(n_splits + 1))
    df = df.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    start = F.col("_n") - (F.lit(n_splits) - F.col("fold") + F.lit(1)) * ts
    role = (F.when(F.col("_pos") < start, F.lit("train"))
            .when(F.col("_pos") < start + ts, F.lit("test")))
    return df.withColumn("role", role).filter(F.col("role").isNotNull()).drop("_pos", "_n")


def cv_fold_summary(train_rows: DataFrame, n_splits: int = C.CV_SPLITS, part: str = "symbol") -> DataFrame:
    f = cv_folds(train_rows, n_splits, part)
    return f.groupBy(part, "fold", "role").agg(F.count("*").alias("rows"),
                                               F.min("date").alias("first_date"),
                                               F.max("date").alias("last_date"))
