"""Line deduplication over levelled sorted runs of line hashes.

A run is a set of (h1, h2, n) rows: the 128-bit hash of a line's key and the number of documents
seen with it, bucketed and sorted by the hash.  Every new batch of documents is one new run at level 0:
its keys are merge-anti-joined with the closed runs (keys that already reached the threshold need
no more counting) and the rest is added.  When a level holds ``fanout`` runs they are compacted:
one merge sums the counts, keys that reach the threshold move to a closed run and the rest becomes
one run a level up.  Bucketing lets Spark merge runs without a shuffle, and map-side aggregation
sends a line that a third of all documents share as one row per task.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; lines with an
empty key are never dropped.  Null or empty text is one empty line.  A document is a row: repeated
rows count each, and every copy loses the same lines.  Null doc_ids are ids like any other.  Two
lines are one if both 64-bit hashes agree.  Extra columns pass through ``drop_lines``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm.common import LOWER, SPACE, UPPER, ascii_lower, scratch, shuffle_partitions, staged
from ratebook.sources.tables import table

THRESHOLD = 10              # documents with a line's key from which the line goes
FANOUT = 4                  # runs of a level that are compacted into one
BATCHES = 10                # deliveries a table is dealt in: clearly more than FANOUT, so runs close while they arrive


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


class LineRuns:
    """The levelled runs of line keys seen so far: partitions of one bucketed, sorted table, so that a
    scan of several runs reads a hash bucket of all of them in one task and merges without a shuffle.
    ``close`` drops the table."""

    def __init__(self, spark: SparkSession, threshold: int = THRESHOLD, fanout: int = FANOUT,
                 buckets: int | None = None):
        self.spark, self.threshold, self.fanout = spark, threshold, fanout
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[int]] = []
        self.closed: list[int] = []
        self.table, self._made = f"ratebook_lines_{os.urandom(6).hex()}", 0

    def _write(self, run: DataFrame) -> int:
        number, self._made = self._made, self._made + 1
        (run.withColumn("run", F.lit(number)).write.format("parquet").mode("append").partitionBy("run")
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(self.table))
        return number

    def _read(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.table).where(F.col("run").isin(runs))

    def add_batch(self, docs: DataFrame, text: str = "text") -> None:
        """Count the batch's keys (once per document) and add them as a run, but for closed keys."""
        hashes = F.transform(F.filter(F.transform(_lines(F.col(text)), line_key), lambda k: k != ""), _hash)
        run = (docs.select(F.explode(F.array_distinct(hashes)).alias("h")).select("h.h1", "h.h2")
               .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")))
        if self.closed:
            run = run.join(self._read(self.closed).select("h1", "h2"), ["h1", "h2"], "left_anti")
        self._add(0, self._write(run))

    def _add(self, level: int, run: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            self._compact(level)

    def _merged(self, runs: list[int]) -> DataFrame:
        return self._read(runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def _compact(self, level: int) -> None:
        runs, self.levels[level] = self.levels[level], []
        merged = self._merged(runs)
        self.closed.append(self._write(merged.where(F.col("n") >= self.threshold)))
        rest = self._write(merged.where(F.col("n") < self.threshold))
        for x in runs:
            # a run without rows has no partition
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (run = {x})")
        self._add(level + 1, rest)

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys found in at least ``threshold`` documents so far, staged."""
        if not self._made:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        left = [x for runs in self.levels for x in runs]
        opened = self._merged(left).where(F.col("n") >= self.threshold).select("h1", "h2")
        # closed runs may hold a key that an open run reaches the threshold with as well
        every = self._read(self.closed).select("h1", "h2").unionByName(opened).distinct()
        return staged(every, scratch(self.spark, "lines"))

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.closed, self.levels = [], []


def drop_lines(docs: DataFrame, frequent: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` cut to the lines that stay, plus ``n_lines`` and ``n_dropped`` (long)."""
    lines = _lines(F.col(text))
    mine = docs.select(F.col(key).alias("_ld_id"), F.xxhash64(text).alias("_ld_hash"), F.posexplode(lines).alias("_ld_at", "line"))
    mine = mine.select("_ld_id", "_ld_hash", "_ld_at", line_key(F.col("line")).alias("k")).where("k != ''")
    mine = mine.select("_ld_id", "_ld_hash", "_ld_at", _hash(F.col("k")).alias("h")).select("_ld_id", "_ld_hash", "_ld_at", "h.h1", "h.h2")
    gone = (mine.join(frequent, ["h1", "h2"], "left_semi")
            .groupBy("_ld_id", "_ld_hash").agg(F.collect_set("_ld_at").alias("_ld_gone")))
    both = docs.join(gone, F.col(key).eqNullSafe(F.col("_ld_id")) & (F.xxhash64(text) == F.col("_ld_hash")), "left")
    gone_at = F.coalesce(F.col("_ld_gone"), F.array().cast("array<int>"))
    # array_except is hash-based and keeps the order, so long documents stay linear
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), F.col("_ld_gone")),
                       lambda i: F.get(F.col("_ld_lines"), i))
    out = both.withColumns({"_ld_lines": lines, "_ld_gone": gone_at})
    return (out.withColumns({"n_lines": F.size("_ld_lines").cast("bigint"), "n_dropped": F.size("_ld_gone").cast("bigint"),
                             text: F.when(F.size("_ld_gone") == 0, F.col(text)).otherwise(F.array_join(kept, "\n"))})
            .drop("_ld_id", "_ld_hash", "_ld_gone", "_ld_lines"))


def dedup_lines(docs: DataFrame, batches: list[DataFrame], threshold: int = THRESHOLD, fanout: int = FANOUT,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines found in ``threshold`` or more documents of ``batches`` (all of ``docs``)."""
    runs = LineRuns(docs.sparkSession, threshold, fanout)
    try:
        for b in batches:
            runs.add_batch(b, text)
        found = runs.frequent()
    finally:
        runs.close()
    return drop_lines(docs, found, key, text)


def hash_batches(docs: DataFrame, n: int = BATCHES) -> list[DataFrame]:
    """Any table as ``n`` deliveries, dealt by a hash of the id."""
    return [docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) == i) for i in range(n)]


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return dedup_lines(docs, hash_batches(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT doc_id, line, place, translate(trim(line, {_TRIM}), '{UPPER}', '{LOWER}') AS k FROM lines),
frequent AS (
  SELECT k FROM (SELECT DISTINCT doc_id, k FROM keyed WHERE length(k) >= 1) GROUP BY k HAVING count(*) >= {THRESHOLD})
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.k = f.k GROUP BY doc_id
"""
