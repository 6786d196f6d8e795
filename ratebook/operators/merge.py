"""K2: keyed upsert of rates (MERGE semantics) as DataFrame operations.

MERGE ON (Currency, Currency2, RateDate): a matched key takes the batch's
``Rate``, an unmatched batch row is inserted, other target rows stay.  Batch
rows apply in order, so among duplicates the last (highest ``seq``) wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebook.schemas import BPM_KEYS, OUT_RATE



def last_rank(first: Column, second: str, rows: DataFrame) -> Column:
    """A value that orders by (``first``, ``second``), ``first`` being an int.

    For an integral ``second`` it is one DECIMAL(38,0), ``first`` x 10^20 +
    ``second``: exact for every bigint, and a fixed-width aggregate buffer
    keeps ``max_by`` hash-based.  NULL counts
    as 0.  Anything else is compared as a struct.
    """
    if isinstance(rows.schema[second].dataType, T.IntegralType):
        step = F.lit(str(10 ** 20)).cast("decimal(21,0)")
        at = F.coalesce(F.col(second), F.lit(0)).cast("decimal(20,0)")
        return (first.cast("decimal(10,0)") * step + at).cast("decimal(38,0)")
    return F.struct(first, F.col(second))


def merge_tagged(rows: DataFrame, keys: list[str] = BPM_KEYS, is_batch: str = "is_batch",
                 seq: str = "seq") -> DataFrame:
    """The MERGE reduction over target and batch rows held in one frame.

    Per key, the ``Rate`` of the row ranked highest by (is_batch, seq): a key
    in the batch takes its last batch value, any other key keeps the
    target's.  ``seq`` is any orderable column or struct.  One aggregate with
    a map-side partial step -- a key repeated many times in the batch is
    pre-reduced in every task before the shuffle, never collected whole.
    A NULL ``Rate`` never replaces a value.
    """
    rank = F.when(F.col("Rate").isNotNull(), last_rank(F.col(is_batch).cast("int"), seq, rows))
    return (rows.groupBy(*keys)
            .agg(F.max_by(F.col("Rate").cast(OUT_RATE), rank).alias("Rate")))


def merge_rates(target: DataFrame, batch: DataFrame, keys: list[str] = BPM_KEYS,
                seq: str = "seq") -> DataFrame:
    """The table after the upsert: ``merge_tagged`` over target rows
    (not batch, no seq) and batch rows (batch, their ``seq``); each input is
    read once."""
    t = target.select(*keys, "Rate", F.lit(False).alias("is_batch"),
                      F.lit(None).cast(batch.schema[seq].dataType).alias("seq"))
    b = batch.select(*keys, "Rate", F.lit(True).alias("is_batch"), F.col(seq).alias("seq"))
    return merge_tagged(t.unionByName(b), keys)


def merge_sources(target: DataFrame, batch: DataFrame, keys: list[str] = BPM_KEYS,
                  newest_source: bool = False) -> DataFrame:
    """The upsert for rows that know their source: ``Rate`` and ``origin``
    (time, path and position of the quote; NULL if it is not known).

    By default the batch wins, as in ``merge_rates`` (order ``seq``), and a
    key keeps the newest origin it has had.  With ``newest_source`` the row
    of the newest origin wins, in the batch or not; a row without an origin
    is older than any with one, and the batch wins among equals.
    """
    t = target.select(*keys, "Rate", "origin", F.lit(False).alias("is_batch"), F.lit(None).cast(batch.schema["seq"].dataType).alias("seq"))
    rows = t.unionByName(batch.select(*keys, "Rate", "origin", F.lit(True).alias("is_batch"), "seq"))
    if newest_source:
        rank = F.struct(F.col("origin").isNotNull(), F.col("origin"), F.col("is_batch"))
    else:
        rank = last_rank(F.col("is_batch").cast("int"), "seq", rows)
    filled = F.when(F.col("Rate").isNotNull(), rank)
    return rows.groupBy(*keys).agg(F.max_by(F.col("Rate").cast(OUT_RATE), filled).alias("Rate"), F.max("origin").alias("origin"))
