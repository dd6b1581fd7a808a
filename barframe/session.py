"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # PySpark otherwise records a Python call site (several JVM round trips)
    # for every Column function call while a plan is being built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "barframe", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, the submit config wins over these."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is. A session on a
    local master without one gets a fresh scratch folder; on a cluster a folder
    of one machine would be of no use to the others, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="barframe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in the shared checkpoint folder, deleted when the driver ends unless kept."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if keep:
        return path
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Like a reliable checkpoint it survives lost executors, but the plan runs
    once (an eager checkpoint runs it twice) and the rows are stored as
    compressed columns, of which later queries read only those they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table that ``cut_lineage`` wrote for ``df``, once its successor is written.

    Only folders below the shared checkpoint folder are touched."""
    spark = df.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.makeQualified(root).toString().rstrip("/") + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if fs.makeQualified(path).toString().startswith(base):
            fs.delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
