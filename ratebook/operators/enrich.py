"""Reference enrichment: factors per pair, unknown pairs dropped (J4, J5, F4,
P8, N2)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.functions.dates import as_date
from ratebook.functions.numbers import ratio5, scale5
from ratebook.schemas import FACTOR, REF_RATE

# What an unknown pair gets before it is dropped.
DEFAULT_FROM_RATIO = 1
DEFAULT_REF_RATE = 0
DEFAULT_TO_RATIO = 1


def ref_snapshot(ref: DataFrame, run_date: _dt.date | str) -> DataFrame:
    """The reference rows for one date, result fields renamed.

    The equality on ``rate_date`` is a partition filter when the reference
    table is partitioned by date, and a pushed-down Parquet filter otherwise.
    """
    d = as_date(run_date)
    return (ref.where(F.col("rate_date") == F.lit(d))
            .select("from_curr", "to_curr",
                    F.col("from_factor").alias("from_ratio"),
                    F.col("kursf").alias("ref_rate"),
                    F.col("to_factor").alias("to_ratio")))


def enrich_left(rates: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Left join on (from_curr, to_curr); a miss gets (1, 0, 1).

    The join strategy is left to the planner and AQE: the snapshot is
    broadcast when its statistics -- at planning, or measured at runtime
    after its shuffle -- are under the broadcast threshold, and joined by
    shuffle otherwise.
    """
    return (rates.join(snapshot, ["from_curr", "to_curr"], "left")
            .withColumns({
                "from_ratio": F.coalesce("from_ratio", F.lit(DEFAULT_FROM_RATIO).cast(FACTOR)),
                "ref_rate": F.coalesce("ref_rate", F.lit(DEFAULT_REF_RATE).cast(REF_RATE)),
                "to_ratio": F.coalesce("to_ratio", F.lit(DEFAULT_TO_RATIO).cast(FACTOR)),
            }))


def known_pairs(enriched: DataFrame) -> DataFrame:
    """F4 (J5 together with J4): keep pairs whose reference rate is not 0.

    Written literally as left join + filter; the filter rejects the NULLs a
    miss would produce once coalesced to 0, so Catalyst plans an inner join.
    """
    return enriched.where(F.col("ref_rate") != 0)


def scaled(known: DataFrame) -> DataFrame:
    """P8 + N2: ``fx_rate x from_ratio`` rounded half up to five decimals.

    Rates that carry their ratio (``fx_num / fx_den``) are divided, scaled and
    rounded in one step.  ``to_ratio`` is fetched but never used, as in the
    source.
    """
    if {"fx_num", "fx_den"} <= set(known.columns):
        return known.withColumn("fx_rate_with_ratio", ratio5("fx_num", "fx_den", "from_ratio"))
    return known.withColumn("fx_rate_with_ratio", scale5("fx_rate", "from_ratio"))
