"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.session import cut_lineage, table_path

#: White space that separates words: blank and U+0009 to U+000D.
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table; only these, so a clash with extra columns can't arise."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def python_batches(df: DataFrame, rows: int = 1000) -> None:
    """Send rows to Python tasks in batches of ``rows`` at the most.

    The default of 10,000 texts takes some 100 MB in the JVM and again in Python."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) > rows:
        conf.set(key, rows)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into the shared checkpoint folder and read back: the
    lineage is cut, and a lost executor only costs its tasks."""
    return cut_lineage(df, name)


#: A written table of up to so many rows is broadcast: 20 MB at 40 bytes a row.
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """Broadcast a written table of a few numbers a row if its counted rows are few; else leave the join to Spark."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside array functions a
    plain column expression is computed again for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Array of words; null or blank text gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def shingle_hashes(ws: Column, k: int = 5) -> Column:
    """64-bit hashes of all k-word shingles; shorter texts are one shingle."""
    def made(w: Column) -> Column:
        n = F.size(w)
        return (F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))
                .when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")))
    return let(ws, made)


def chunks(batches: Iterator[pa.RecordBatch], size_of: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text column of each holds about ``limit`` bytes.

    A row is never cut: one longer text is a chunk of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(size_of)))
        start = held = 0
        for i, n in enumerate(sizes.to_pylist()):
            if held and held + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)
