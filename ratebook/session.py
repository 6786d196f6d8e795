"""Session helpers.

The library never creates its own cluster settings beyond what a job needs:
AQE on (runtime broadcast choice, skew-join splitting, partition coalescing),
ANSI on (bad numbers and dates raise instead of turning into NULL).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every ratebook job relies on.  They are all standard Spark SQL
# options; a cluster's own defaults for anything else are left alone.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size shuffle partitions by bytes, not by core count: AQE starts from
    # spark.sql.shuffle.partitions (set high on a big cluster) and merges
    # small partitions up to the advisory size, so tasks stay well inside
    # executor memory and spills stay rare.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "ratebook",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the job settings applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir) and taken as named, a plain path too: it is whatever
    the cluster's default file system or a mount on every machine makes of
    it.  Only when neither is set -- a test session -- the
    caller's fallback is installed, or a temporary folder where driver and
    executors are one process; on a cluster the job stops, because a
    machine-local folder is no place for lineage cuts there.
    """
    one_process = (spark.sparkContext.master or "").split("[")[0] == "local"
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if fallback is None and one_process:
            fallback = tempfile.mkdtemp(prefix="ratebook-")
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        d = fallback
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def staging_root(spark: SparkSession) -> str:
    """This application's folder for staged tables, under the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ratebook-stage/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh directory for one staged table."""
    return f"{staging_root(spark)}/{name}-{os.urandom(6).hex()}"


def staged_ranges(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """``df`` range-partitioned by ``keys``, written under the checkpoint folder and read back.

    ``number`` tells each row's range: rows of a lower range come before
    those of a higher one in the order of ``keys`` (NULLs first), and equal
    keys share a range.  Ranges are drawn from a sample, so they are fixed by
    writing them: every later pass, and a task that is run again, sees the
    same ones.
    """
    path = staging_path(df.sparkSession, "ranges")
    out = df.repartitionByRange(*keys).withColumn(number, F.spark_partition_id())
    out.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)
