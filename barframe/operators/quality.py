"""Per-symbol data-quality report: one grouped aggregate over the bar table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import scratch_path


class DataValidationError(ValueError):
    """Raised (strict mode) when a symbol fails a hard check."""


def _pct(x: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f%%", x * F.lit(100.0))


def _schema_faults(bars: DataFrame) -> list[str]:
    """V2 and V3: what the schema alone rules out."""
    missing = [c for c in C.REQUIRED_COLUMNS if c not in bars.columns]
    out = [f"columns absent: {', '.join(missing)}"] if missing else []
    kind = dict(bars.dtypes).get("date", "")
    if not kind.startswith(("date", "timestamp")):
        out.append(f"date is {kind or 'absent'}, not a date or timestamp")
    return out


def out_of_order(bars: DataFrame, seq: str) -> DataFrame:
    """V4: (symbol, out_of_order): rows dated before the one ingested just ahead of them.

    A DataFrame has no order of its own; ``seq`` is the ingest sequence (unique
    within a symbol). A symbol's rows are bounded by its sessions."""
    w = Window.partitionBy("symbol").orderBy(seq)
    back = bars.select("symbol", (F.col("date") < F.lag("date").over(w)).alias("back"))
    return back.groupBy("symbol").agg(F.count_if("back").alias("out_of_order"))


def validation_report(bars: DataFrame, min_rows: int = C.MIN_ROWS_REQUIRED,
                      requested: DataFrame | None = None) -> DataFrame:
    """symbol, rows, passed, warnings (array), message, summary.

    ``requested`` (a one-column ``symbol`` table) adds an "empty" row for each
    requested symbol without bars.
    """
    req = list(C.REQUIRED_COLUMNS)
    broken = _schema_faults(bars)
    if broken:  # V2, V3: every symbol fails for the same reason, decided from the schema
        symbols = bars.select("symbol").distinct() if "symbol" in bars.columns else \
            bars.sparkSession.createDataFrame([("",)], "symbol string")
        message = "; ".join(broken)
        return symbols.select(
            "symbol", F.lit(0).cast("bigint").alias("rows"), F.lit(False).alias("passed"),
            F.array(*map(F.lit, broken)).alias("warnings"), F.lit(message).alias("message"),
            F.format_string(f"[FAILED] %s: 0 rows, {len(broken)} warning(s)", F.col("symbol")).alias("summary"))
    nulls = sum(F.col(c).isNull().cast("int") for c in req)
    agg = bars.groupBy("symbol").agg(
        F.count("*").alias("rows"),
        (F.count("*") - F.count_distinct("date")).alias("duplicates"),
        F.count_if((F.col("open") <= 0) | (F.col("high") <= 0) | (F.col("low") <= 0)
                   | (F.col("close") <= 0)).alias("non_positive"),
        F.count_if(F.col("high") < F.col("low")).alias("bad_range"),
        F.count_if(F.col("volume") < 0).alias("negative_volume"),
        (F.sum(nulls) / (F.count("*") * F.lit(len(req)))).alias("null_share"),
    )
    fails = [
        F.when(F.col("duplicates") > 0, F.format_string("%d duplicated timestamp(s)", F.col("duplicates"))),
        F.when(F.col("rows") < min_rows, F.format_string(f"only %d rows, need at least {min_rows}", F.col("rows"))),
        F.when(F.col("non_positive") > 0, F.lit("non-positive price(s) present")),
        F.when(F.col("bad_range") > 0, F.format_string("%d row(s) with high < low", F.col("bad_range"))),
        F.when(F.col("negative_volume") > 0, F.lit("negative volume present")),
        F.when(F.col("null_share") > C.NULL_SHARE_MAX,
               F.concat(_pct(F.col("null_share"), 1), F.lit(" of OHLCV cells are null"))),
    ]
    tolerated = F.when((F.col("null_share") > 0) & (F.col("null_share") <= C.NULL_SHARE_MAX),
                       F.concat(_pct(F.col("null_share"), 2), F.lit(" null cells (tolerated)")))
    rep = agg.select(
        "symbol", "rows",
        F.filter(F.array(*fails), lambda x: x.isNotNull()).alias("_fails"),
        tolerated.alias("_tol"))
    rep = rep.select(
        "symbol", "rows", (F.size("_fails") == 0).alias("passed"),
        F.concat("_fails", F.filter(F.array("_tol"), lambda x: x.isNotNull())).alias("warnings"))
    if requested is not None:
        empty = requested.join(bars.select("symbol").distinct(), "symbol", "left_anti").select(
            "symbol", F.lit(0).cast("bigint").alias("rows"), F.lit(False).alias("passed"),
            F.array(F.lit("frame is empty")).alias("warnings"))
        rep = rep.unionByName(empty)
    return rep.select(
        "symbol", "rows", "passed", "warnings",
        F.array_join("warnings", "; ").alias("message"),
        F.format_string("[%s] %s: %d rows, %d warning(s)",
                        F.when(F.col("passed"), F.lit("OK")).otherwise(F.lit("FAILED")),
                        F.col("symbol"), F.col("rows"), F.size("warnings")).alias("summary"))


def assert_valid(report: DataFrame) -> None:
    """Strict mode (V12): write every failing row to a table in the shared folder
    and raise with their exact number, the table's path and one example."""
    path = scratch_path(report.sparkSession, "failed-symbols", keep=True)
    report.filter(~F.col("passed")).select("symbol", "message").write.parquet(path)
    failed = report.sparkSession.read.schema("symbol string, message string").parquet(path)
    count = failed.count()
    if count:
        example = failed.orderBy("symbol").first()
        raise DataValidationError(f"{count} symbol(s) failed, listed in {path}; "
                                  f"first: {example.symbol}: {example.message}")


def valid_bars(bars: DataFrame, min_rows: int = C.MIN_ROWS_REQUIRED) -> tuple[DataFrame, DataFrame]:
    """Non-strict gate: (bars of passing symbols, skipped(symbol, reason))."""
    rep = validation_report(bars, min_rows)
    ok = rep.filter("passed").select("symbol")
    skipped = rep.filter(~F.col("passed")).select(
        "symbol", F.concat(F.col("symbol"), F.lit(": "), F.col("message")).alias("reason"))
    return bars.join(ok, "symbol", "left_semi"), skipped


def leakage_tripwire(matrix: DataFrame, features: list[str], target: str = C.TARGET_COLUMN) -> DataFrame:
    """|corr(feature, target)| per feature, one aggregate pass."""
    row = matrix.agg(*[F.corr(F.col(f), F.col(target).cast("double")).alias(f) for f in features])
    stack = ", ".join(f"'{f}', `{f}`" for f in features)
    return row.selectExpr(f"stack({len(features)}, {stack}) AS (feature, corr)") \
        .withColumn("abs_corr", F.abs("corr"))


def split_order_check(split_df: DataFrame, date_col: str = "date") -> DataFrame:
    """Per split block min/max date and whether each block starts
    strictly after the previous one ends."""
    order = F.when(F.col("split") == "train", 0).when(F.col("split") == "validation", 1).otherwise(2)
    blocks = split_df.groupBy("split").agg(F.min(date_col).alias("first_date"),
                                            F.max(date_col).alias("last_date"),
                                            F.count("*").alias("rows")).withColumn("block", order)
    w = Window.orderBy("block")  # three rows at most
    return blocks.select("split", "block", "rows", "first_date", "last_date",
                         F.coalesce(F.lag("last_date").over(w) < F.col("first_date"), F.lit(True))
                         .alias("after_previous"))
