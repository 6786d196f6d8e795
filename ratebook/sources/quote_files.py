"""Quote documents on storage.

A document is one JSON object ``{"start", "end", "items": [{code, buyValue,
sellValue}, ...]}`` per file.  Every file of a directory is read (files are
the unit of parallelism for multi-line JSON); items become rows with their
position in the document, and the file's path and modification time come
from the ``_metadata`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.schemas import QUOTE_FILE


def read_quote_files(spark: SparkSession, path: str) -> DataFrame:
    """The raw documents with file metadata (batch).

    FAILFAST: a corrupt document stops the job (the source stops on a bad
    file too) instead of turning silently into NULLs and missing quotes.
    """
    return (spark.read.schema(QUOTE_FILE).option("multiLine", True).option("mode", "FAILFAST")
            .json(path)
            .select("*", F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_modification_time").alias("file_mtime")))


def document_items(docs: DataFrame) -> DataFrame:
    """One row per item, the document's ``start``/``end`` attached.

    Extra keys in the JSON are ignored by the explicit schema.  A document
    without ``start``, ``end`` or ``items`` raises, naming the file: its
    quotes would otherwise vanish without notice.
    """
    def required(name: str):
        c = F.col(name)
        lacks = F.raise_error(F.concat(F.lit(f"quote document without {name}: "), F.col("file_path")))
        return F.when(c.isNull(), lacks).otherwise(c).alias(name)

    return (docs
            .select(required("start"), required("end"), "file_path", "file_mtime",
                    F.posexplode(required("items")).alias("pos", "item"))
            .select(F.col("start").alias("period"), F.col("pos").cast("int").alias("pos"),
                    F.col("item.code").alias("code"),
                    F.col("item.buyValue").alias("buyValue"),
                    F.col("item.sellValue").alias("sellValue"),
                    "start", "end", "file_path", "file_mtime"))


def newest_per_key(rows: DataFrame, keys: list[str], order: list[str],
                   values: list[str]) -> DataFrame:
    """Keep, per ``keys``, the ``values`` of the row that is last by ``order``.

    One aggregate, one ``max_by`` per value column: it has a map-side
    partial step, so a key holding a large share of the rows is pre-reduced
    in every task before the shuffle, and no group is ever sorted or
    collected whole.  With a single fixed-width ``order`` column (e.g. a
    packed bigint) and fixed-width values, Spark plans it as a hash
    aggregate; several order columns are compared as a struct.
    """
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(o) for o in order])
    return rows.groupBy(*keys).agg(*[F.max_by(v, rank).alias(v) for v in values])


def newest_file_items(items: DataFrame) -> DataFrame:
    """Per period, only the items of the newest file.

    The source read whatever file its directory listing gave first; here the
    rule is explicit -- newest modification time wins, the path breaks ties.
    """
    newest = (items.groupBy("period")
              .agg(F.max(F.struct("file_mtime", "file_path")).alias("_f"))
              .select("period", F.col("_f.file_path").alias("file_path")))
    return items.join(newest, ["period", "file_path"], "left_semi")


def scan_quote_json(spark: SparkSession, path: str, newest_only: bool = True) -> DataFrame:
    """S1 (+ S2): quote items from every document under ``path``."""
    items = document_items(read_quote_files(spark, path))
    return newest_file_items(items) if newest_only else items
