"""The hand-computed golden case and the edge rows of FIXTURES §2."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import (GOLDEN_DOC, GOLDEN_ERP_M, GOLDEN_TARGETS, RUN, items_frame, ref_frame,
                      write_doc)
from ratebook.operators import quality, rates
from ratebook.plans import jobs
from ratebook.sources.quote_files import scan_quote_json


def _erp(df):
    return {(r.FROM_CURR, r.TO_CURRNCY, r.EXCH_RATE) for r in df.collect()}


def _golden_quotes(spark, tmp):
    write_doc(f"{tmp}/quotes", "quotes-0201.json", GOLDEN_DOC)
    return rates.quote_mid(scan_quote_json(spark, f"{tmp}/quotes"))


def test_golden_m(spark, tmp):
    q = _golden_quotes(spark, tmp)
    erp = jobs.common_rates(q, GOLDEN_TARGETS, ref_frame(spark), RUN, "M")
    rows = erp.collect()
    assert _erp(erp) == GOLDEN_ERP_M
    assert {r.VALID_FROM for r in rows} == {"20250201"}
    assert {r.RATE_TYPE for r in rows} == {"M"}
    assert {(r.FROM_FACTOR, r.TO_FACTOR, r.EXCH_RATE_V, r.FROM_FACTOR_V, r.TO_FACTOR_V)
            for r in rows} == {("1", "1", "1.00000", "1", "1")}
    assert erp.columns == ["FROM_CURR", "TO_CURRNCY", "EXCH_RATE", "VALID_FROM", "RATE_TYPE",
                           "FROM_FACTOR", "TO_FACTOR", "EXCH_RATE_V", "FROM_FACTOR_V", "TO_FACTOR_V"]


def test_golden_v(spark, tmp):
    q = _golden_quotes(spark, tmp)
    erp = jobs.common_rates(q, GOLDEN_TARGETS, ref_frame(spark), RUN, "V")
    assert _erp(erp) == GOLDEN_ERP_M
    assert {r.VALID_FROM for r in erp.collect()} == {"20250228"}


def test_golden_bpm(spark, tmp):
    got = {tuple(r) for r in jobs.bpm_rows(_golden_quotes(spark, tmp)).collect()}
    assert got == {("USD", "TWD", "32.70000", "2025-02-01"), ("JPY", "TWD", "0.21700", "2025-02-01"),
                   ("EUR", "TWD", "35.40000", "2025-02-01")}


def test_rate_type_guard(spark, tmp):
    with pytest.raises(ValueError):
        jobs.common_rates(_golden_quotes(spark, tmp), GOLDEN_TARGETS, ref_frame(spark), RUN, "X")


def test_missing_target_raises(spark):
    q = rates.quote_mid(items_frame(spark, [("USD", "32.5", "32.9"), ("JPY", "0.215", "0.219")]))
    with pytest.raises(Exception, match="no quote for target EUR"):
        rates.all_rates(q, ["TWD", "USD", "EUR"]).collect()
    with pytest.raises(quality.GuardError, match="EUR in 20250201"):
        quality.check_complete(q, ["USD", "EUR"])


def test_first_quote_wins(spark):
    q = rates.quote_mid(items_frame(spark, [("USD", "32.5", "32.9"), ("JPY", "0.215", "0.219"),
                                            ("USD", "40", "40")]))
    got = {(r.from_curr, r.to_curr): r.fx_rate for r in rates.cross_rates(q, ["USD"]).collect()}
    # sell(JPY) / mid(first USD) = 0.219 / 32.7
    assert round(float(got[("JPY", "USD")]), 8) == round(0.219 / 32.7, 8)
    m = rates.target_mids(q, ["USD"]).collect()
    assert [(r.to_curr, float(r.target_mid)) for r in m] == [("USD", 32.7)]


def test_first_of_many_quotes_per_target(spark):
    """J3 over duplicate quotes of every key, in several periods; a NULL mid is not a missing one."""
    items = items_frame(spark, [("USD", "1", "3"), ("EUR", "5", "5"), ("USD", "8", "8"), ("EUR", "6", "6"), ("JPY", "2", "2")] * 3)
    both = items.unionByName(items.withColumns({"period": F.lit("20250301"), "buyValue": F.col("sellValue")}))
    got = {(r.period, r.to_curr): float(r.target_mid) for r in rates.target_mids(rates.quote_mid(both), ["USD", "EUR"]).collect()}
    assert got == {("20250201", "USD"): 2.0, ("20250201", "EUR"): 5.0, ("20250301", "USD"): 3.0, ("20250301", "EUR"): 5.0}
    cross = rates.cross_rates(rates.quote_mid(both), ["USD", "EUR"]).where("from_curr = 'JPY'").collect()
    assert len(cross) == 12 and {round(float(r.fx_rate), 10) for r in cross} == {1.0, 0.4, round(2 / 3, 10)}


def test_scaled_rate_is_rounded_once(spark):
    """A near tie: 1.00000499999999999 stays below it."""
    q = rates.quote_mid(items_frame(spark, [("USD", "1000000000", "1000000000"), ("JPY", "1", "1000004999.99999999")]))
    row = rates.cross_rates(q, ["USD"]).where("from_curr = 'JPY'").withColumn("from_ratio", F.lit(1).cast("decimal(9,0)"))
    from ratebook.operators.enrich import scaled
    assert str(scaled(row).head().fx_rate_with_ratio) == "1.00000"


def test_repeated_target_repeats_rows(spark):
    q = rates.quote_mid(items_frame(spark, [("USD", "32.5", "32.9"), ("JPY", "0.215", "0.219")]))
    rows = rates.all_rates(q, ["TWD", "USD", "USD"]).where("to_curr = 'USD'").collect()
    assert len(rows) == 2 and {r.from_curr for r in rows} == {"JPY"}


def test_empty_input_guard(spark):
    q = rates.quote_mid(items_frame(spark, [("USD", "32.5", "32.9")])).where(F.lit(False))
    with pytest.raises(quality.GuardError):
        quality.require_rows(q, "quotes")


@pytest.mark.parametrize("bad", ["1,234.5", "", "abc"])
def test_bad_number_raises(spark, bad):
    q = rates.quote_mid(items_frame(spark, [("USD", bad, "32.9")]))
    with pytest.raises(Exception, match="invalid buyValue"):
        q.collect()


def test_bad_date_raises(spark):
    q = rates.quote_mid(items_frame(spark, [("USD", "32.5", "32.9")], start="20250230"))
    erp = jobs.common_rates(q, ["TWD"], ref_frame(spark), RUN, "M")
    with pytest.raises(Exception, match="invalid yyyyMMdd date: '20250230'"):
        erp.collect()


def test_bad_end_date_raises_under_m(spark):
    q = rates.quote_mid(items_frame(spark, [("USD", "32.5", "32.9")], end="2025021"))
    erp = jobs.common_rates(q, ["TWD"], ref_frame(spark), RUN, "M")
    with pytest.raises(Exception, match="invalid yyyyMMdd date: '2025021'"):
        erp.collect()


def test_zero_divisor_raises(spark):
    q = rates.quote_mid(items_frame(spark, [("USD", "0", "0"), ("JPY", "0.215", "0.219")]))
    with pytest.raises(Exception, match="division by zero"):
        rates.cross_rates(q, ["USD"]).collect()


def test_leap_month_end(spark):
    from ratebook.functions.dates import month_end
    df = spark.createDataFrame([("20240229",), ("20250201",), ("20241231",)], "d string")
    assert [r[0] for r in df.select(month_end("d")).collect()] == ["20240229", "20250228", "20241231"]


def test_all_pairs_unknown(spark, tmp):
    q = _golden_quotes(spark, tmp)
    empty_ref = ref_frame(spark, rows=[("XXX", "YYY", 1, "1")])
    erp = jobs.common_rates(q, GOLDEN_TARGETS, empty_ref, RUN, "M")
    with pytest.raises(quality.GuardError, match="no rows"):
        quality.require_rows(erp, "ERP rates")


def test_tie_rounds_half_up(spark):
    from ratebook.functions.numbers import fmt5
    df = spark.createDataFrame([("2.000015",), ("31.123455",)], "x string")
    got = [r[0] for r in df.select(fmt5(F.col("x").cast("decimal(18,10)"))).collect()]
    assert got == ["2.00002", "31.12346"]


def test_null_rate_flows(spark, tmp):
    q = rates.quote_mid(items_frame(spark, [("USD", None, "32.9")]))
    ref = ref_frame(spark)
    erp = jobs.common_rates(q, ["TWD"], ref, RUN, "M").collect()
    assert len(erp) == 1 and erp[0].EXCH_RATE is None
    # ...and is stopped at the ERP write (NOT NULL contract)
    with pytest.raises(quality.GuardError, match="USD->TWD: EXCH_RATE"):
        jobs.run_common(q, ["TWD"], ref, RUN, "M", "common_m", f"{tmp}/erp")


def test_local_run_stamp(spark):
    import datetime as dt
    from ratebook.functions.text import export_name
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 20, 0),)], "ts timestamp_ntz")
    assert df.select(export_name("common_m", F.col("ts"))).first()[0] == "FinalData__common_m__20250102_0400"


def test_v_two_periods_one_month(spark, tmp):
    a = items_frame(spark, [("USD", "32.5", "32.9")], start="20250201", end="20250210")
    b = items_frame(spark, [("USD", "33.5", "33.9")], start="20250211", end="20250220")
    q = rates.quote_mid(a.unionByName(b))
    erp = jobs.common_rates(q, ["TWD"], ref_frame(spark), RUN, "V")
    with pytest.raises(quality.GuardError, match="not unique"):
        quality.check_unique(erp, ["FROM_CURR", "TO_CURRNCY", "VALID_FROM"], "V rates")
    with pytest.raises(quality.GuardError, match="20250228"):
        jobs.run_common(q, ["TWD"], ref_frame(spark), RUN, "V", "common_v", f"{tmp}/erp")
    # narrowed to one period of the month, the run goes through
    rep = jobs.run_common(q, ["TWD"], ref_frame(spark), RUN, "V", "common_v", f"{tmp}/erp",
                          periods=["20250211"])
    assert rep.counts["erp"] == 1


def test_rare_self_pair_kept(spark):
    from ratebook.sources.pages import extract_page_quotes
    pages = spark.createDataFrame([
        ("https://c.example/?from=HUF&to=HUF&amount=1",
         '<input name="numberformat" tabindex="4" value="1.0000">'),
        ("https://c.example/?from=HUF&to=TWD&amount=1",
         '<input name="numberformat" tabindex="3" value="1"><input name="numberformat" tabindex="4" value="0.0871">'),
        ("https://c.example/?from=HUF&to=USD&amount=1",
         '<input name="numberformat" tabindex="4" value="-">'),
        ("https://c.example/?from=HUF&to=EUR&amount=1",
         '<input name="numberformat" tabindex="4" value="">'),
        ("https://other.example/page?x=1", "<p>no rate here</p>"),
    ], "url string, html string")
    rq = extract_page_quotes(pages, RUN, host="c.example", allow_not_ready=True)
    assert {(r.from_curr, r.to_curr, r.fx_rate) for r in rq.collect()} == {
        ("HUF", "HUF", "1.0000"), ("HUF", "TWD", "0.0871")}
    erp = jobs.rare_rates(rq, ref_frame(spark), RUN, "M")
    assert {(r.FROM_CURR, r.TO_CURRNCY, r.EXCH_RATE, r.VALID_FROM) for r in erp.collect()} == {
        ("HUF", "HUF", "1.00000", "20250221"), ("HUF", "TWD", "0.08710", "20250221")}
    erp_v = jobs.rare_rates(rq, ref_frame(spark), RUN, "V")
    assert {r.VALID_FROM for r in erp_v.collect()} == {"20250228"}


def test_rate_input_found_by_attributes(spark):
    from ratebook.sources.pages import extract_page_quotes, skipped_pages
    pages = spark.createDataFrame([
        ("https://c.example/?from=RUB&to=TWD&amount=1",
         '<input data-name="numberformat" tabindex="4" value="9.9">'
         '<input value="0.3512" tabindex="4" name="numberformat" class="x">'),
        ("https://c.example/?from=RUB&to=USD&amount=1",
         '<input name="numberformat" tabindex="3" value="1"><p>no rate input</p>'),
    ], "url string, html string")
    good = pages.where("url LIKE '%to=TWD%'")
    got = {(r.from_curr, r.to_curr, r.fx_rate) for r in extract_page_quotes(good, RUN, host="c.example").collect()}
    assert got == {("RUB", "TWD", "0.3512")}
    # the page without the input is reported up front, and stops the extraction
    assert [(r.to_curr, r.fx_rate) for r in skipped_pages(pages, "c.example").collect()] == [("USD", None)]
    with pytest.raises(Exception, match="no rate input on converter page RUB->USD"):
        extract_page_quotes(pages, RUN, host="c.example").collect()


def test_null_target_quote_is_not_a_missing_one(spark):
    from fixtures import items_frame
    q = rates.quote_mid(items_frame(spark, [("USD", None, "32.9"), ("JPY", "0.2150", "0.2190")]))
    got = {(r.from_curr, r.to_curr): r.fx_rate for r in rates.all_rates(q, ["TWD", "USD"]).collect()}
    assert got[("JPY", "USD")] is None and got[("USD", "TWD")] is None and got[("JPY", "TWD")] is not None
    with pytest.raises(Exception, match="no quote for target EUR"):
        rates.all_rates(q, ["EUR"]).collect()


def test_wide_rates(spark):
    from fixtures import items_frame
    q = rates.quote_mid(items_frame(spark, [("IDR", "100000000", "100000002"), ("BTC", "0.000000000001", "0.000000000003")]))
    assert [r.fx_rate for r in q.orderBy("pos").collect()] == [Decimal("100000001"), Decimal("0.000000000002")]
