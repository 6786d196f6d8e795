"""Properties of the jobs on the driver tables, and plan checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from ratebook.operators import enrich, rates
from ratebook.plans import catalog, jobs
from ratebook.sources import proxies

BAD_NODES = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def w1(spark):
    return catalog.q_erp_layout_m(spark, SF01)


def test_no_self_pairs(w1):
    assert w1.where("FROM_CURR = TO_CURRNCY").count() == 0


def test_cross_count(spark):
    q = proxies.quotes(spark, SF01)
    per_period = q.groupBy("period").count().collect()
    ts = [t for t in catalog.TARGETS if t != "TWD"]
    want = sum(r["count"] for r in per_period) * len(ts)
    assert rates.cross_rates(q, ts).count() == want


def test_every_pair_known(spark, w1):
    ref = proxies.ref_rates(spark, SF01).where("kursf <> 0")
    missing = w1.join(ref, (w1.FROM_CURR == ref.from_curr) & (w1.TO_CURRNCY == ref.to_curr), "left_anti")
    assert missing.count() == 0


def test_v_is_month_end(spark):
    v = catalog.q_erp_layout_v(spark, SF01)
    d = F.to_date("VALID_FROM", "yyyyMMdd")
    assert v.where(F.last_day(d) != d).count() == 0
    assert v.groupBy("FROM_CURR", "TO_CURRNCY", "VALID_FROM").count().where("count > 1").count() == 0


def test_partitioning_does_not_change_output(spark):
    q = proxies.quotes(spark, SF01)
    ref = proxies.ref_rates(spark, SF01)
    a = jobs.common_rates(q, catalog.TARGETS, ref, catalog.RUN_DATE, "M")
    b = jobs.common_rates(q.repartition(7, "from_curr"), catalog.TARGETS, ref, catalog.RUN_DATE, "M")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_twice_equals_once(spark):
    from ratebook.operators.merge import merge_rates
    target, batch = proxies.merge_inputs(spark, SF01)
    once = merge_rates(target, batch)
    twice = merge_rates(once, batch)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert once.groupBy("Currency", "Currency2", "RateDate").count().where("count > 1").count() == 0


@pytest.mark.parametrize("name", ["erp_layout_m", "erp_layout_v", "rare_erp_m", "bpm_merge",
                                  "call_metrics", "completeness_gaps", "cross_rates"])
def test_plans_have_no_product_or_python(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF01))
    for bad in BAD_NODES:
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["quote_mid", "self_pair_filter", "cross_rates", "all_rates_union",
                                  "target_mid_first", "erp_layout_m", "erp_layout_v", "rare_erp_m",
                                  "bpm_merge", "completeness_gaps", "run_counts", "newest_quote"])
def test_history_scanned_once(spark, name):
    """Every query built on the order history reads ``orders`` exactly once.

    Quotes meet their period's target mids in a join, whose sides share one derivation where they
    read the same columns (the jobs); queries that show fewer columns derive the quotes twice."""
    df = catalog.QUERIES[name](spark, SF01)
    final = _plan(df).split("== Initial Plan ==")[0]
    narrow = {"self_pair_filter", "cross_rates", "all_rates_union", "run_counts"}
    assert final.count("orders.parquet") in ((1, 2) if name in narrow else (1,)), (name, final)


def test_known_pairs_is_inner_join(spark):
    from fixtures import ref_frame
    rows = rates.all_rates(proxies.quotes(spark, SF01), catalog.TARGETS)
    snap = enrich.ref_snapshot(ref_frame(spark), catalog.RUN_DATE)
    plan = _plan(enrich.known_pairs(enrich.enrich_left(rows, snap)))
    assert "LeftOuter" not in plan and "Inner" in plan


@pytest.mark.parametrize("name", ["bpm_merge", "newest_quote"])
def test_rankings_use_hash_aggregation(spark, name):
    """Packed bigint rankings keep aggregate buffers fixed-width."""
    plan = _plan(catalog.QUERIES[name](spark, SF01)).split("== Initial Plan ==")[0]
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_every_query_reads_the_driver_tables(spark, name):
    """No registered query runs on fixed input alone: each one scans the
    driver's Parquet tables, so its work grows with them."""
    df = catalog.QUERIES[name](spark, SF01)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and SF01 in plan, name
