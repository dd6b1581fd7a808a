"""Snapshot-style sources and sinks over the long bar table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .ticks import BAR_COLUMNS, BAR_SCHEMA, nan_to_null

CSV_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), True),
    T.StructField("symbol", T.StringType(), True),
    *[T.StructField(c, T.DoubleType(), True) for c in ("open", "high", "low", "close", "adj_close")],
    T.StructField("volume", T.LongType(), True),
])


def read_snapshot_csv(spark: SparkSession, path: str) -> DataFrame:
    """The long CSV (gz ok) with a fixed schema; fails if the path is absent."""
    df = spark.read.schema(CSV_SCHEMA).option("header", True).csv(path)
    return nan_to_null(df).select(*BAR_COLUMNS)


METADATA_SCHEMA = ("source_name string, source_url string, built_at_utc string, rows bigint, symbols array<string>, "
                   "n_equities bigint, market_index_constituents bigint, source_tickers_available bigint, "
                   "sessions_per_equity bigint, market_index_symbol string, start_date string, end_date string, adjustment_note string")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Provenance JSON document (multi-line); a path without one gives an empty record."""
    try:
        return spark.read.schema(METADATA_SCHEMA).option("multiLine", True).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], METADATA_SCHEMA)


def available_symbols(bars: DataFrame) -> DataFrame:
    """S3."""
    return bars.select("symbol").distinct()


def fetch(bars: DataFrame, symbol: str) -> DataFrame:
    """One symbol's bars (an equality filter, pushed to the scan /
    partition-pruned when the table is partitioned by symbol)."""
    return bars.filter(F.col("symbol") == F.lit(symbol))


def fetch_known(bars: DataFrame, symbol: str) -> DataFrame:
    """S4 where an unknown symbol is an error (one small job looks for a row)."""
    found = fetch(bars, symbol)
    if found.isEmpty():
        raise LookupError(f"no bars for symbol {symbol!r}")
    return found


def fetch_many(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """S4 batch form: semi join against a symbol table."""
    return bars.join(symbols.select("symbol"), "symbol", "left_semi")


def lookback(bars: DataFrame, years: float = C.DEFAULT_LIVE_PERIOD_YEARS, end_col: str | None = None) -> DataFrame:
    """Keep ``date >= end - int(365.25 * years)`` days, end = each symbol's
    last session."""
    w = Window.partitionBy("symbol")
    end = F.max("date").over(w) if end_col is None else F.col(end_col)
    return bars.withColumn("_end", end).filter(
        F.col("date") >= F.date_sub(F.col("_end"), int(365.25 * years))).drop("_end")


def missing_symbols(spark: SparkSession, bars: DataFrame, universe: list[str]) -> DataFrame:
    """Requested - available."""
    req = spark.createDataFrame([(s,) for s in universe], "symbol string")
    return req.join(available_symbols(bars), "symbol", "left_anti")


def dedupe_keep_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key, the one with the largest ingest sequence.

    One ``max_by`` per column: their buffers are plain values, so numeric rows
    stay in a hash aggregate. ``seq`` is unique within a key."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max(seq).alias(seq) if c == seq else F.max_by(c, seq).alias(c) for c in others])


def normalise_vendor_frame(raw: DataFrame) -> DataFrame:
    """Lower-case/underscore column names, adj_close defaults to close,
    OHLCV projection, date without time zone, rows null in every column dropped."""
    df = raw.toDF(*[c.strip().lower().replace(" ", "_") for c in raw.columns])
    if "adj_close" not in df.columns:
        df = df.withColumn("adj_close", F.col("close"))
    df = df.withColumn("date", F.to_date("date"))
    cols = ["open", "high", "low", "close", "adj_close", "volume"]
    return df.select("date", *cols).dropna(how="all", subset=cols)


def in_read_order(raw: DataFrame, *columns) -> DataFrame:
    """The columns of a file source with ``_seq``, a row's place in the files: (file, start of its block, place in the block).

    A block is read by one task from its first line on, so the order of the rows is
    that of the files however they are packed into partitions."""
    seq = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return raw.select(*columns, seq.alias("_seq"))


def read_symbol_files(spark: SparkSession, pattern: str) -> DataFrame:
    """A directory of ``<TICKER>_data.csv`` files (header date, open, high,
    low, close, volume, Name). The symbol comes from the file name; rows null
    in date or close are dropped and duplicate dates keep the last row of the
    files in order of their paths."""
    raw = spark.read.option("header", True).csv(pattern)
    df = in_read_order(
        raw, F.upper(F.regexp_extract(F.col("_metadata.file_name"), C.SNAPSHOT_FILE_PATTERN, 1)).alias("symbol"),
        F.to_date(F.col("date")).alias("date"),
        *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")])
    df = df.filter((F.col("symbol") != "") & F.col("date").isNotNull() & F.col("close").isNotNull())
    return dedupe_keep_last(df, ["symbol", "date"], "_seq").drop("_seq")


def write_snapshot(snapshot: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Partitioned by symbol so a fetch prunes partitions."""
    if fmt == "parquet":
        snapshot.write.mode("overwrite").partitionBy("symbol").parquet(path)
    else:  # in the order that ``read_snapshot_csv`` expects
        ordered = snapshot.select(*CSV_SCHEMA.fieldNames())
        ordered.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def conform(df: DataFrame) -> DataFrame:
    """Cast a frame onto the bar schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BAR_SCHEMA.fields])


def fetch_from(sources: dict[str, Callable[[], DataFrame]], symbol: str,
               validate: Callable[[DataFrame], None] | None = None) -> tuple[DataFrame, str, dict[str, str]]:
    """S6 for one symbol: the first source that loads, knows the symbol and passes
    ``validate``. Returns (bars, source, why the earlier ones failed)."""
    failed: dict[str, str] = {}
    for name, load in sources.items():
        try:
            found = fetch_known(load(), symbol)
            if validate is not None:
                validate(found)
            return found, name, failed
        except Exception as e:  # noqa: BLE001 - the next source takes over; the reasons are returned or raised
            failed[name] = f"{type(e).__name__}: {e}"
    raise LookupError(f"no source has {symbol!r}: " + "; ".join(f"{k}: {v}" for k, v in failed.items()))


def with_fallback(primary: DataFrame, fallback: DataFrame, primary_name: str = "snapshot",
                  fallback_name: str = "live") -> DataFrame:
    """Bars from the preferred source, and from the other source for every
    symbol the preferred one lacks; ``source`` says which was used."""
    have = primary.select("symbol").distinct()
    rest = fallback.join(have, "symbol", "left_anti")
    return primary.withColumn("source", F.lit(primary_name)).unionByName(
        rest.withColumn("source", F.lit(fallback_name)))
