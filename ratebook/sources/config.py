"""Configuration inputs as DataFrames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.functions.text import json_list

# Fixed value: the base currency.
BASE_CURRENCY = "TWD"


def target_list(spark: SparkSession, targets) -> DataFrame:
    """Target currencies as rows ``(to_curr, t_pos)``; duplicates are kept.

    ``targets`` is the configuration value: a JSON list text or a Python
    list.  Its length is known on the driver, which is what makes the frame
    safe to broadcast.
    """
    text = targets if isinstance(targets, str) else json.dumps(list(targets))
    return (spark.range(1)
            .select(F.posexplode(json_list(text)).alias("t_pos", "to_curr"))
            .select("to_curr", F.col("t_pos").cast("int").alias("t_pos")))


def drop_base(targets: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """the base currency is not a cross-rate target."""
    return targets.where(F.col("to_curr") != F.lit(base))


def currency_list(spark: SparkSession, codes, name: str = "from_curr") -> DataFrame:
    """A literal list of codes as a one-column frame (order kept as ``c_pos``)."""
    return (spark.range(1)
            .select(F.posexplode(json_list(json.dumps(list(codes)))).alias("c_pos", name))
            .select(name, F.col("c_pos").cast("int").alias("c_pos")))
