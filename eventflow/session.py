"""Session settings the library is tuned for, and where shared scratch data goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library should run with.  Skew handling, partition
# coalescing and runtime broadcast conversion are left to adaptive execution.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A repeated key in one JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RECOMMENDED_CONF`` to a running session."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder; where it is unset, the warehouse folder is
    used, and a machine-local one only by a session whose tasks all run in the driver.  The folder
    goes when the driver's JVM ends.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base and context.master.startswith("local") and not context.master.startswith("local-cluster"):
        base = tempfile.gettempdir() + "/eventflow"
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to a new shared folder and read back, which cuts its lineage; the folder goes with the driver's JVM."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
