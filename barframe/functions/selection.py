"""Exact medians of groups of any size.

A median is the value at one or two ranks. Instead of a buffer per group, the ranks
are narrowed down: values are cut at a group's approximate quantiles (a mergeable
sketch), counted by range, and only the range that holds a wanted rank goes on,
until it has few values or a single one. The counts are exact, so the result is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Values of a group that are sorted in one place.
FEW = 10_000
#: Ranges that a group's values are cut into, and the accuracy of the cuts.
RANGES, ACCURACY = 64, 2048


def medians(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """(group, columns): the exact median of each column's non-null values, null without any. Group values are not null."""
    of = [*group, "_column"]
    keys = [*of, "_which"]
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_x")) for c in columns])
    values = df.select(*group, F.inline(cells)).where("_x IS NOT NULL")
    n = F.count(F.lit(1)).alias("_n")
    # two targets each, the lower and the upper middle, by rank from 0
    targets = values.groupBy(*of).agg(n).select("*", F.inline(F.array(
        F.struct(F.lit(0).alias("_which"), F.floor((F.col("_n") - 1) / 2).alias("_rank")), F.struct(F.lit(1).alias("_which"), F.floor(F.col("_n") / 2).alias("_rank")))))
    rows = cut_lineage(values.join(targets, of), "values")
    done = rows.where(F.col("_n") <= FEW)
    while True:
        large = rows.where(F.col("_n") > FEW)
        if large.isEmpty():
            break
        cuts = large.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("_x", [i / RANGES for i in range(1, RANGES)], ACCURACY)).alias("_cuts"))
        # place 2 i holds the values between two cuts, 2 i + 1 those of a cut: a frequent value is a range of its own
        place = F.size(F.filter("_cuts", lambda c: c < F.col("_x"))) * 2 + F.array_contains("_cuts", F.col("_x")).cast("int")
        placed = large.join(cuts, keys).withColumn("_place", place).drop("_cuts")
        counts = placed.groupBy(*keys, "_rank", "_place").agg(F.count(F.lit(1)).alias("_in"), F.min("_x").alias("_a"), F.max("_x").alias("_b"))
        before = Window.partitionBy(*keys).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
        hit = cut_lineage(counts.where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_in"))), "hits")
        inside = placed.drop("_n", "_rank").join(hit.where("_a <> _b"), [*keys, "_place"])
        inside = inside.select(*of, "_x", F.col("_in").alias("_n"), "_which", (F.col("_rank") - F.col("_before")).alias("_rank"))
        alone = hit.where("_a = _b").select(*of, F.col("_a").alias("_x"), F.lit(1).cast("bigint").alias("_n"), "_which", F.lit(0).cast("bigint").alias("_rank"))
        rows = cut_lineage(inside.unionByName(alone), "ranges")
        done = done.unionByName(rows.where(F.col("_n") <= FEW))
    found = done.groupBy(*keys).agg(F.element_at(F.array_sort(F.collect_list("_x")), (F.first("_rank") + 1).cast("int")).alias("_v"))  # FEW values at most
    middle = found.groupBy(*of).agg(F.max(F.when(F.col("_which") == 0, F.col("_v"))).alias("_low"), F.max(F.when(F.col("_which") == 1, F.col("_v"))).alias("_high"))
    middle = middle.withColumn("_m", F.col("_low") + (F.col("_high") - F.col("_low")) / 2)
    wide = middle.groupBy(*group).agg(*[F.max(F.when(F.col("_column") == c, F.col("_m"))).alias(c) for c in columns])
    return df.select(*group).distinct().join(wide, group, "left")
