"""A snapshot kept in versions (S10, S12): readers see one whole version, writers touch only what changed.

Under the root, in this order: ``data/version=n`` holds the bars that version n wrote,
by symbol; ``manifest/n`` says for every symbol which version's bars are its own;
``metadata/n`` is the provenance as JSON; ``published/n`` is an empty file written last.
The current version is the largest published one, so a writer that dies between the
steps leaves the old version as it was, and its leavings are under a number that the next
writer overwrites. One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

MANIFEST = "symbol string, version bigint"


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)


def current_version(spark: SparkSession, root: str) -> int | None:
    """The largest published version; None before the first."""
    fs, path = _fs(spark, root)
    folder = path(f"{root}/published")
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]  # one name per version
    return max((int(n) for n in names if n.isdigit()), default=None)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The bars of a published version, by default the current one."""
    version = current_version(spark, root) if version is None else version
    if version is None or not _is_published(spark, root, version):
        raise FileNotFoundError(f"no published snapshot version {'' if version is None else version} under {root}")
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/manifest/{version}")
    data = spark.read.parquet(f"{root}/data")
    return data.join(manifest.withColumn("version", F.col("version").cast(data.schema["version"].dataType)), ["symbol", "version"], "left_semi").drop("version")


def _is_published(spark: SparkSession, root: str, version: int) -> bool:
    fs, path = _fs(spark, root)
    return fs.exists(path(f"{root}/published/{version}"))


def read_version_metadata(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    version = current_version(spark, root) if version is None else version
    return spark.read.option("multiLine", True).json(f"{root}/metadata/{version}")


def write_version(bars: DataFrame, root: str, metadata: DataFrame | None = None, replace: bool = False) -> int:
    """Publish a version with these symbols' bars in place of their old ones; other symbols keep theirs
    unless ``replace``. metadata: a one-row provenance table. Returns the version."""
    spark = bars.sparkSession
    old = current_version(spark, root)
    version = 0 if old is None else old + 1
    bars = cut_lineage(bars, "version")
    # whatever an unpublished writer left under this number goes
    bars.repartition("symbol").write.mode("overwrite").partitionBy("symbol").parquet(f"{root}/data/version={version}")
    touched = bars.select("symbol").distinct().withColumn("version", F.lit(version).cast("bigint"))
    if old is not None and not replace:
        before = spark.read.schema(MANIFEST).parquet(f"{root}/manifest/{old}")
        touched = touched.unionByName(before.join(touched.select("symbol"), "symbol", "left_anti"))
    touched.write.mode("overwrite").parquet(f"{root}/manifest/{version}")
    if metadata is not None:
        metadata.coalesce(1).write.mode("overwrite").json(f"{root}/metadata/{version}")
    fs, path = _fs(spark, root)
    fs.create(path(f"{root}/published/{version}"), True).close()
    return version
