"""Pick up each new quote document once and upsert its base-currency rates.

A file source with a checkpoint remembers which files were processed, and
``availableNow`` processes everything new and stops -- the cron-style batch
run, without ever reading a file twice.  Each micro-batch goes through the
same keyed upsert as the batch job (K2), which is idempotent, so a batch
replayed after a failure gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.operators.layouts import bpm_layout
from ratebook.operators.rates import quote_mid
from ratebook.schemas import QUOTE_FILE
from ratebook.sources.config import BASE_CURRENCY
from ratebook.sources.quote_files import document_items
from ratebook.sources.sinks import upsert_rates


MAX_FILE_AGE = "36500d"


def quote_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New quote documents under ``path`` as a stream of items.

    The file source would drop a file whose time is more than a week before
    the newest one seen; no age is too old here."""
    r = spark.readStream.schema(QUOTE_FILE).option("multiLine", True).option("mode", "FAILFAST").option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    docs = r.json(path).select("*", F.col("_metadata.file_path").alias("file_path"),
                               F.col("_metadata.file_modification_time").alias("file_mtime"))
    return document_items(docs)


def ingest_new_quotes(spark: SparkSession, source: str, checkpoint: str, table_path: str,
                      base: str = BASE_CURRENCY, available_now: bool = True, max_files: int | None = None):
    """Start the ingest query; returns the StreamingQuery.

    A key quoted by several files takes the newest file's value (file time,
    then path, then position), within a micro-batch and across them: the
    table keeps the source of each rate, so an older file that arrives late
    changes nothing that a newer one has set.  ``max_files`` bounds a
    micro-batch.  Files without a quote to
    ``base`` stop the query before its checkpoint advances.
    """
    items = quote_stream(spark, source, max_files)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        ordered = batch.withColumn("pos", F.struct("file_mtime", "file_path", "pos"))
        upsert_rates(bpm_layout(quote_mid(ordered, base), base, seq="pos"), table_path, newest_source=True)

    w = items.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
