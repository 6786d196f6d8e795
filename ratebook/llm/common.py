"""Shared helpers of the training-data operators: scratch tables and shipping the package to workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII white space of the contracts, and A-Z / a-z.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for staged tables under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` (or the context's checkpoint folder) names it; only a
    local session without one gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not (spark.sparkContext.master or "").startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        base = tempfile.mkdtemp(prefix="ratebook-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/ratebook-llm/{name}-{os.urandom(6).hex()}"


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read again: cuts the lineage at a shared table, and gives the
    planner the measured size of what was written (so it may broadcast a side it knows is small)."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table that no later step reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda variable is a let-binding)."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null or blank: an empty array."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1))


_shipped: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application (as ``--py-files`` would), so that
    worker functions import it whatever the driver's working folder is."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ratebook-ship-"), "ratebook_pkg.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _shipped[app] = target
