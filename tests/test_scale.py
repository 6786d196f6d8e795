"""Skew: one customer holding a third of all orders.

The driver tables are small, so the cluster-scale path is forced: no
broadcast, tiny skew thresholds.  The hot customer's shuffle partition must
be split by AQE (``SortMergeJoin(skew=true)``) and results must not change.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from ratebook.plans import catalog
from ratebook.sources import proxies

CLUSTER_LIKE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    # at this size coalescing would merge every partition into one
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skewed_dir(spark, tmp):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    hot = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7))
                       .otherwise(F.col("o_custkey")))
    # several input files, as any large table has: AQE splits a skewed
    # partition by ranges of map tasks
    hot.repartition(8).write.parquet(f"{tmp}/orders.parquet")
    for t in ("customer", "nation"):
        spark.read.parquet(f"{SF01}/{t}.parquet").write.parquet(f"{tmp}/{t}.parquet")
    return tmp


@pytest.fixture()
def cluster_like(spark):
    old = {k: spark.conf.get(k, None) for k in CLUSTER_LIKE}
    for k, v in CLUSTER_LIKE.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_customer_is_split(spark, skewed_dir, cluster_like):
    """Single orders meet their customers: the hot partition is split at run time."""
    q = proxies.priced_orders(spark, skewed_dir)
    rows = sorted(tuple(r) for r in q.collect())
    plan = q._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in plan
    assert "AQEShuffleRead skewed" in plan
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = sorted(tuple(r) for r in proxies.priced_orders(spark, skewed_dir).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert rows == plain and rows


def test_hot_customer_is_reduced_before_the_join(spark, skewed_dir, cluster_like):
    """Quotes aggregate orders per customer first, with a map-side step below the join."""
    q = proxies.quote_items(spark, skewed_dir)
    assert q.count() == 25 * 27
    plan = q._jdf.queryExecution().executedPlan().toString()
    reduced = plan[plan.rindex("SortMergeJoin"):]
    assert "partial_min(o_totalprice" in reduced and "SortMergeJoin(skew=true)" not in plan


def test_w1_on_skewed_history(spark, skewed_dir, cluster_like):
    erp = catalog.q_erp_layout_m(spark, skewed_dir)
    assert erp.count() > 0
    assert erp.where("FROM_CURR = TO_CURRNCY").count() == 0


def test_hot_period_uses_several_tasks(spark, cluster_like):
    """One period with a third of a million quotes: no window, the period is split, mids are as in the rest."""
    from ratebook.operators import rates

    n = 300_000
    spread = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 < 2, F.lit("20250101")).otherwise(F.concat(F.lit("2024"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"), F.lit("01")))
        .alias("period"), F.col("id").alias("pos"), F.when(F.col("id") % 5 == 0, "USD").otherwise(F.concat(F.lit("C"), F.col("id").cast("string"))).alias("code"),
        (F.col("id") % 97 + 1).cast("string").alias("buyValue"), (F.col("id") % 97 + 2).cast("string").alias("sellValue"),
        F.lit("20250101").alias("start"), F.lit("20250131").alias("end"))
    q = rates.quote_mid(spread)
    df = rates.cross_rates(q, ["USD"])
    got = df.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum("fx_rate").alias("s"), F.count_distinct("fx_den").alias("dens")).collect()
    assert sum(r.n for r in got) == n and all(r.dens == 1 for r in got)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in plan and "SortMergeJoin(skew=true)" in plan
    first = q.where("from_curr = 'USD' AND period = '20250101'").orderBy("pos").head()
    assert df.where("period = '20250101'").head().fx_den == first.mid2


def test_call_windows_never_span_a_whole_connection(spark):
    """The window over raw calls (ordered by time) is partitioned by
    (connection, day, bucket); only the per-bucket summary rows are windowed
    by connection alone."""
    import re

    df = catalog.QUERIES["call_metrics"](spark, SF01)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    specs = re.findall(r"Window \[.*\], \[([^\]]*)\], \[([^\]]*)\]", plan)
    raw = [p for p, order in specs if re.search(r"\bts#", order)]
    assert raw and all("_hour" in p and "_day" in p for p in raw), specs
