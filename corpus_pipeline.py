"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept: quality rules
reject documents, line deduplication removes lines that many documents share, the Jaccard join
keeps one document of each group of near duplicates, decontamination removes documents that hold a
benchmark passage, and byte-level BPE turns the rest into token ids.  Between stages the documents
are written as Parquet and read again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm import bpe, decontaminate, jaccard_join, line_dedup, quality_rules
from ratebook.llm.common import scratch, staged
from ratebook.sources.tables import table


# All columns of a document but its id and text travel in one struct, so that no operator's own
# columns (``n_words``, ``rule``, ...) meet a source's columns of the same names.
CARRIED = "source_columns"


def packed(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest).alias(CARRIED)) if rest else docs.select("doc_id", "text")


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in ("doc_id", "text") else F.col(CARRIED)[c].alias(c) for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from ``labels``."""
    rules = quality_rules.learn_rules(quality_rules.fit_sample(docs, table(spark, sf_dir, "labels")))
    return unpacked(quality_rules.judge(packed(docs), rules).where("kept"), docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines found in 10 or more of these documents; n_chars follows the text."""
    out = unpacked(line_dedup.dedup_lines(packed(docs), line_dedup.hash_batches(docs)), docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    found = decontaminate.marked(packed(docs), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return unpacked(found.where("NOT contaminated"), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_shared_lines),
    ("jaccard_join", keep_one_of_each),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", encode),
]

# Learned rules and token ids are not SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), scratch(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
