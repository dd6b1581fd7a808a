"""The reference's "live" data mode re-aimed: ticks that keep arriving in a
folder are folded into bars by Structured Streaming.

A bar is made of parts that combine in any order (first and last price by time,
extremes, volume). Each micro-batch is aggregated to partial bars and written to
a folder of its own; readers merge the partial bars of all batches. There is no
state and no watermark, so a tick counts however late it comes, and the table
equals the batch result over all ticks seen. A batch that is run again after a
failure overwrites its own folder and so counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.ticks import nan_to_null


def partial_bars(ticks: DataFrame, symbol: str, ts: str, price: str, bar: str = "1 hour",
                 volume: str | None = None) -> DataFrame:
    """(symbol, date, first, open, high, low, last, close, volume) of some of the ticks."""
    ntz = isinstance(ticks.schema[ts].dataType, T.TimestampNTZType)
    at = F.col(ts).cast("timestamp") if ntz else F.col(ts)  # the session zone (UTC) makes the cast exact
    t = nan_to_null(ticks).select(F.col(symbol).alias("symbol"), at.alias("_ts"), F.col(price).alias("_px"),
                                  (F.col(volume) if volume else F.lit(1)).cast("double").alias("_vol"))
    agg = t.groupBy("symbol", F.window("_ts", bar).alias("_w")).agg(
        F.min("_ts").alias("first"), F.min_by("_px", "_ts").alias("open"), F.max("_px").alias("high"),
        F.min("_px").alias("low"), F.max("_ts").alias("last"), F.max_by("_px", "_ts").alias("close"),
        F.sum("_vol").alias("volume"))
    start = F.col("_w.start").cast("timestamp_ntz") if ntz else F.col("_w.start")
    return agg.select("symbol", start.alias("date"), "first", "open", "high", "low", "last", "close", "volume")


def merge_bars(partials: DataFrame) -> DataFrame:
    """Bars from the partial bars of any number of batches."""
    bars = partials.groupBy("symbol", "date").agg(
        F.min_by("open", "first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "last").alias("close"), F.sum("volume").alias("volume"))
    return bars.select("symbol", "date", "open", "high", "low", "close",
                       F.col("close").alias("adj_close"), F.col("volume").cast("bigint").alias("volume"))


def run_bar_stream(spark: SparkSession, source_dir: str, schema: T.StructType, out_dir: str,
                   checkpoint: str, symbol: str, ts: str, price: str, bar: str = "1 hour",
                   file_glob: str | None = None, volume: str | None = None):
    """Start (availableNow) a stream from Parquet tick files to ``out_dir``;
    returns the StreamingQuery."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)

    def write(batch: DataFrame, batch_id: int) -> None:
        partial_bars(batch, symbol, ts, price, bar, volume).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return (reader.parquet(source_dir).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_stream_bars(spark: SparkSession, out_dir: str) -> DataFrame:
    """The bars of all batches written by ``run_bar_stream``."""
    return merge_bars(spark.read.parquet(out_dir).drop("batch"))
