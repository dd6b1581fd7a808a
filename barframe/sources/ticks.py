"""Tick tables -> daily (or hourly) OHLCV bars.

The bar key is (symbol, session). Open/close are the first/last price by a
unique sequence key, high/low the extremes, volume a count or a sum. All of
it is one hash aggregate with map-side partial aggregation, so a hot symbol
(or a hot session) is combined inside each map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import table_path

BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("adj_close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
])
BAR_COLUMNS = [f.name for f in BAR_SCHEMA.fields]
PRICE_COLUMNS = ("open", "high", "low", "close", "adj_close")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    """Spark keeps NaN distinct from NULL (and NaN sorts above every number)."""
    names = set(columns or [f.name for f in df.schema.fields
                            if isinstance(f.dataType, (T.DoubleType, T.FloatType))])
    return df.select(*[
        F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if c in names else F.col(c)
        for c in df.columns])


def aggregate_bars(ticks: DataFrame, symbol: Column, session: Column, price: Column,
                   seq: Column, volume: Column) -> DataFrame:
    """Generic tick -> bar aggregation."""
    t = ticks.select(symbol.alias("symbol"), session.alias("date"),
                     price.alias("_px"), seq.alias("_seq"), volume.alias("_vol"))
    bars = t.groupBy("symbol", "date").agg(
        F.min_by("_px", "_seq").alias("open"),
        F.max("_px").alias("high"),
        F.min("_px").alias("low"),
        F.max_by("_px", "_seq").alias("close"),
        F.sum("_vol").alias("volume"),
    )
    return bars.select("symbol", "date", "open", "high", "low", "close",
                       F.col("close").alias("adj_close"),
                       F.col("volume").cast("bigint").alias("volume"))


def bars_from_orders(orders: DataFrame) -> DataFrame:
    """Daily bars per order priority; price = o_totalprice, volume = order count."""
    return aggregate_bars(
        nan_to_null(orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")),
        symbol=F.col("o_orderpriority"), session=F.to_date("o_orderdate"),
        price=F.col("o_totalprice"), seq=F.col("o_orderkey"), volume=F.lit(1))


def bars_from_events(events: DataFrame) -> DataFrame:
    """Hourly bars per event type; ``date`` is the hour (TIMESTAMP_NTZ)."""
    return aggregate_bars(
        nan_to_null(events.select("event_id", "ts", "event_type", "value")),
        symbol=F.col("event_type"), session=F.date_trunc("hour", F.col("ts")),
        price=F.col("value"), seq=F.col("ts"), volume=F.lit(1))


#: Bits of the line number in a line item's sequence key.
LINE_BITS = 16


def line_sequence(order: Column, line: Column) -> Column:
    """(order key, line number) as one long, so that first and last stay in hash
    aggregates; a key that doesn't fit is an error."""
    fits = (order >= 0) & (order < 1 << (63 - LINE_BITS)) & (line >= 0) & (line < 1 << LINE_BITS)
    return F.when(order.isNull() | line.isNull(), F.lit(None)) \
        .when(fits, F.shiftleft(order.cast("bigint"), LINE_BITS) + line) \
        .otherwise(F.raise_error(F.concat(F.lit("line item key out of range: "), order.cast("string"))).cast("bigint"))


def bars_from_lineitem(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Daily bars per part brand: price = l_extendedprice / l_quantity, first and
    last by (l_orderkey, l_linenumber), volume = sum(l_quantity).

    Line items collapse to one partial bar per (part, day) before they meet
    ``part``, so the join moves partial bars, and Spark chooses how to join."""
    li = nan_to_null(lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                     "l_quantity", "l_extendedprice", "l_shipdate"))
    li = li.select("l_partkey", F.to_date("l_shipdate").alias("day"),
                   F.try_divide("l_extendedprice", "l_quantity").alias("px"),
                   line_sequence(F.col("l_orderkey"), F.col("l_linenumber")).alias("seq"),
                   F.col("l_quantity").alias("qty"))
    partial = li.groupBy("l_partkey", "day").agg(
        F.min("seq").alias("seq_first"), F.min_by("px", "seq").alias("first"),
        F.max("seq").alias("seq_last"), F.max_by("px", "seq").alias("last"),
        F.max("px").alias("high"), F.min("px").alias("low"), F.sum("qty").alias("qty"))
    joined = partial.join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    bars = joined.groupBy(F.col("p_brand").alias("symbol"), F.col("day").alias("date")).agg(
        F.min_by("first", "seq_first").alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("last", "seq_last").alias("close"),
        F.sum("qty").alias("volume"))
    return bars.select("symbol", "date", "open", "high", "low", "close",
                       F.col("close").alias("adj_close"), F.col("volume").cast("bigint").alias("volume"))


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_orders(read_table(spark, sf_dir, "orders"))


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_lineitem(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"))


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_events(read_table(spark, sf_dir, "events"))
