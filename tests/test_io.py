"""File sources and sinks: S1, S2, K1, K2, K3, T1."""

from __future__ import annotations

import csv
import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from fixtures import GOLDEN_DOC, GOLDEN_TARGETS, RUN, ref_frame, write_doc
from ratebook.operators import rates
from ratebook.plans import jobs
from ratebook.sources import sinks
from ratebook.sources.quote_files import document_items, read_quote_files, scan_quote_json
from ratebook.streaming.ingest import ingest_new_quotes


def test_scan_items_and_extra_keys(spark, tmp):
    doc = dict(GOLDEN_DOC, note="ignored")
    doc["items"] = [dict(i, extra=1) for i in doc["items"]]
    write_doc(f"{tmp}/q", "a.json", doc)
    rows = document_items(read_quote_files(spark, f"{tmp}/q")).orderBy("pos").collect()
    assert [(r.pos, r.code, r.buyValue, r.start, r.end) for r in rows] == [
        (0, "USD", "32.50", "20250201", "20250210"), (1, "JPY", "0.2150", "20250201", "20250210"),
        (2, "EUR", "35.10", "20250201", "20250210")]


def test_numeric_json_values_read_as_text(spark, tmp):
    doc = {"start": "20250201", "end": "20250210",
           "items": [{"code": "USD", "buyValue": 32.5, "sellValue": 32.9}]}
    write_doc(f"{tmp}/q", "n.json", doc)
    q = rates.quote_mid(scan_quote_json(spark, f"{tmp}/q"))
    assert float(q.first().fx_rate) == 32.7


def test_newest_file_wins(spark, tmp):
    old = dict(GOLDEN_DOC, items=[{"code": "USD", "buyValue": "1", "sellValue": "1"}])
    now = time.time()
    write_doc(f"{tmp}/q", "old.json", old, mtime=now - 3600)
    write_doc(f"{tmp}/q", "new.json", GOLDEN_DOC, mtime=now)
    other = dict(GOLDEN_DOC, start="20250211", end="20250220")
    write_doc(f"{tmp}/q", "other.json", other, mtime=now - 7200)
    items = scan_quote_json(spark, f"{tmp}/q")
    got = {(r.period, r.code, r.buyValue) for r in items.collect()}
    assert ("20250201", "USD", "32.50") in got and ("20250201", "USD", "1") not in got
    assert len([g for g in got if g[0] == "20250211"]) == 3


def test_erp_sink_partitions_survive(spark, tmp):
    q = rates.quote_mid(scan_quote_json(spark, _golden_dir(tmp)))
    common = jobs.common_rates(q, GOLDEN_TARGETS, ref_frame(spark), RUN, "V")
    rare = common.where("FROM_CURR = 'JPY'")
    path = f"{tmp}/erp"
    sinks.write_erp_rates(common, path, "common_v")
    sinks.write_erp_rates(rare, path, "rare_v")
    sinks.write_erp_rates(common, path, "common_v")  # retry: same rows, no duplicates
    back = sinks.read_erp_rates(spark, path)
    assert back.where("job = 'common_v'").count() == 5
    assert back.where("job = 'rare_v'").count() == 3
    assert {r.VALID_FROM for r in back.collect()} == {"20250228"}
    assert dict(back.dtypes)["VALID_FROM"] == "string"


def _golden_dir(tmp):
    d = f"{tmp}/golden"
    write_doc(d, "g.json", GOLDEN_DOC)
    return d


def test_export_file_name_and_order(spark, tmp):
    q = rates.quote_mid(scan_quote_json(spark, _golden_dir(tmp)))
    erp = jobs.common_rates(q, GOLDEN_TARGETS, ref_frame(spark), RUN, "M")
    out = sinks.export_rates(erp, f"{tmp}/export", "common_m", dt.datetime(2025, 1, 1, 20, 0))
    assert out.endswith("FinalData__common_m__20250102_0400")
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 5 and back.columns[0] == "FROM_CURR"


def test_export_as_one_ordered_file(spark, tmp):
    """Several sorted tasks, one file, one header; a retry replaces it; quotes and line ends survive."""
    rows = [(f"C{i % 97:02d}", f"T{i * 31 % 113:03d}", f"{i}.00000", 'a "b",\nc' if i % 50 == 0 else "x") for i in range(3000)]
    erp = spark.createDataFrame(rows, "FROM_CURR string, TO_CURRNCY string, EXCH_RATE string, VALID_FROM string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for _ in range(2):
            out = sinks.export_rates(erp, f"{tmp}/export", "common_m", dt.datetime(2025, 1, 1, 20, 0), one_file=True)
        parts = erp.orderBy("TO_CURRNCY", "FROM_CURR", "VALID_FROM").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1 and out.endswith("/FinalData__common_m__20250102_0400.csv") and os.path.isfile(out)
    assert [f for f in os.listdir(f"{tmp}/export") if not f.startswith(".")] == [os.path.basename(out)]
    with open(out, newline="") as f:
        back = list(csv.reader(f, escapechar="\\", doublequote=False))
    assert back[0] == erp.columns and len(back) == 3001
    assert [(r[1], r[0]) for r in back[1:]] == sorted((r[1], r[0]) for r in rows)
    assert sorted(map(tuple, back[1:])) == sorted(rows)
    empty = sinks.export_rates(erp.limit(0), f"{tmp}/none", "m", dt.datetime(2025, 1, 1, 20, 0), one_file=True)
    assert open(empty).read() == "FROM_CURR,TO_CURRNCY,EXCH_RATE,VALID_FROM\n"


def test_part_files_are_ordered_by_task_number():
    names = ["part-100000-a-c000.csv", "part-99999-a-c000.csv", "part-00002-a-c001.csv", "part-00002-a-c000.csv"]
    assert sorted(names, key=sinks._part_order) == [names[3], names[2], names[1], names[0]]


def test_listed_copies_bound_repeated_keys(spark):
    from ratebook.operators.quality import GuardError, check_unique
    rows = [("USD", "EUR", "20250201")] * 2 + [("USD", "JPY", "20250201")]
    df = spark.createDataFrame(rows, "FROM_CURR string, TO_CURRNCY string, VALID_FROM string")
    check_unique(df, jobs.ERP_KEYS, "ERP rates", copies={"EUR": 2, "JPY": 1})
    for copies in (None, {"EUR": 1}, {"JPY": 3}):
        with pytest.raises(GuardError, match="not unique"):
            check_unique(df, jobs.ERP_KEYS, "ERP rates", copies=copies)
    with pytest.raises(GuardError, match="not unique"):
        check_unique(df.union(df.limit(1)), jobs.ERP_KEYS, "ERP rates", copies={"EUR": 2})


def _rates_frame(spark, rows):
    return spark.createDataFrame(rows, "Currency string, Currency2 string, Rate string, "
                                       "RateDate string, seq bigint")


def test_upsert_last_wins_and_idempotent(spark, tmp):
    path = f"{tmp}/rates"
    first = _rates_frame(spark, [("USD", "TWD", "32.70000", "2025-02-01", 0),
                                 ("JPY", "TWD", "0.21700", "2025-02-01", 1),
                                 ("EUR", "TWD", "35.40000", "2025-01-01", 2)])
    sinks.upsert_rates(first, path)
    batch = _rates_frame(spark, [("USD", "TWD", "33.00000", "2025-02-01", 0),
                                 ("USD", "TWD", "34.00000", "2025-02-01", 5),
                                 ("GBP", "TWD", "40.00000", "2025-02-01", 1)])
    sinks.upsert_rates(batch, path)
    once = sorted(tuple(str(x) for x in r) for r in sinks.read_rates(spark, path).collect())
    sinks.upsert_rates(batch, path)
    twice = sorted(tuple(str(x) for x in r) for r in sinks.read_rates(spark, path).collect())
    assert once == twice
    assert ("USD", "TWD", "34.00000", "2025-02-01") in once
    assert ("EUR", "TWD", "35.40000", "2025-01-01") in once
    assert ("GBP", "TWD", "40.00000", "2025-02-01") in once
    assert len(once) == 4


def test_upsert_rejects_bad_rate(spark, tmp):
    from ratebook.operators.quality import GuardError
    bad = _rates_frame(spark, [("USD", "TWD", "1,234.5", "2025-02-01", 0)])
    with pytest.raises(GuardError, match="1,234.5"):
        sinks.upsert_rates(bad, f"{tmp}/rates")


def test_run_common_end_to_end(spark, tmp):
    q = rates.quote_mid(scan_quote_json(spark, _golden_dir(tmp)))
    rep = jobs.run_common(q, GOLDEN_TARGETS, ref_frame(spark), RUN, "M", "common_m",
                          f"{tmp}/erp", export_dir=f"{tmp}/exp", bpm_path=f"{tmp}/bpm",
                          run_ts=dt.datetime(2025, 2, 21, 3, 0))
    assert rep.counts == {"quotes": 3, "erp": 5}
    assert sinks.read_rates(spark, f"{tmp}/bpm").count() == 3
    assert len(glob.glob(f"{tmp}/exp/FinalData__common_m__*")) == 1


def test_streaming_ingest_once_per_file(spark, tmp):
    src, table, ckpt = f"{tmp}/in", f"{tmp}/table", f"{tmp}/ckpt"
    write_doc(src, "a.json", GOLDEN_DOC)
    ingest_new_quotes(spark, src, ckpt, table).awaitTermination()
    assert sinks.read_rates(spark, table).count() == 3
    nxt = {"start": "20250211", "end": "20250220",
           "items": [{"code": "USD", "buyValue": "33", "sellValue": "34"}]}
    write_doc(src, "b.json", nxt)
    ingest_new_quotes(spark, src, ckpt, table).awaitTermination()
    got = {(r.Currency, r.RateDate): str(r.Rate) for r in sinks.read_rates(spark, table).collect()}
    assert got[("USD", "2025-02-11")] == "33.50000" and got[("USD", "2025-02-01")] == "32.70000"
    assert len(got) == 4
    # nothing new: the checkpoint remembers both files
    ingest_new_quotes(spark, src, ckpt, table).awaitTermination()
    assert sinks.read_rates(spark, table).count() == 4
    assert os.path.isdir(ckpt)


def test_upsert_reads_only_touched_partitions(spark, tmp):
    path = f"{tmp}/rates"
    rows = [(c, "TWD", f"{i}.5", f"2025-{m:02d}-01", 0) for i, c in enumerate(["USD", "EUR"])
            for m in range(1, 13)]
    sinks.upsert_rates(_rates_frame(spark, rows), path)
    existing = sinks.read_rates(spark, path)
    batch = _rates_frame(spark, [("USD", "TWD", "9.0", "2025-03-01", 0)])
    manifest = sinks._manifest(spark, path, 1)
    dates = batch.select("RateDate").distinct()
    touched = sinks._rows_of(spark, path, manifest.join(dates, "RateDate", "left_semi"),
                             F.col("RateDate").between("2025-03-01", "2025-03-01"))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(RateDate" in plan and "2025-03-01" in plan
    assert touched.count() == 2 and existing.count() == 24
    sinks.upsert_rates(batch, path)
    back = sinks.read_rates(spark, path)
    assert back.count() == 24
    assert str(back.where("Currency = 'USD' AND RateDate = '2025-03-01'").first().Rate) == "9.00000"


def test_ref_snapshot_is_a_partition_filter(spark, tmp):
    from fixtures import ref_frame
    from ratebook.operators.enrich import ref_snapshot
    ref_frame(spark).write.partitionBy("rate_date").parquet(f"{tmp}/ref")
    snap = ref_snapshot(spark.read.parquet(f"{tmp}/ref"), RUN)
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rate_date" in plan and "2025-02-21" in plan
    assert snap.count() == 9


def test_run_rare_from_pages(spark, tmp):
    pages = spark.createDataFrame([
        ("https://c.example/?from=HUF&to=TWD&amount=1", '<input name="numberformat" tabindex="4" value="0.0871">'),
        ("https://c.example/?from=HUF&to=USD&amount=1", '<input name="numberformat" tabindex="4" value="">'),
        ("https://c.example/?from=HUF&to=HUF&amount=1", '<input name="numberformat" tabindex="4" value="1.0000">'),
    ], "url string, html string")
    rep = jobs.run_rare(pages, ref_frame(spark), RUN, "M", "rare_m", f"{tmp}/erp", bpm_path=f"{tmp}/bpm",
                        skipped_path=f"{tmp}/skipped", host="c.example")
    assert rep.counts == {"erp": 2, "quotes": 2, "skipped": 1}
    assert [tuple(r) for r in spark.read.parquet(f"{tmp}/skipped").collect()] == [("HUF", "USD", "")]
    got = {(r.Currency, r.Currency2, str(r.Rate), r.RateDate) for r in sinks.read_rates(spark, f"{tmp}/bpm").collect()}
    assert got == {("HUF", "TWD", "0.08710", "2025-02-21")}


def test_cli_common_and_rare(spark, tmp):
    from ratebook.cli import main
    ref_frame(spark).write.parquet(f"{tmp}/ref")
    out = main(["common", "--quotes", _golden_dir(tmp), "--ref", f"{tmp}/ref",
                "--targets", '["TWD","USD","EUR"]', "--rate-type", "M", "--run-date", "20250221",
                "--job", "common_m", "--erp", f"{tmp}/erp", "--bpm", f"{tmp}/bpm",
                "--export", f"{tmp}/exp", "--run-ts", "2025-01-01T20:00"], spark=spark)
    assert out["counts"]["erp"] == 5
    assert out["outputs"]["export"].endswith("FinalData__common_m__20250102_0400")
    spark.createDataFrame([("https://c.example/?from=HUF&to=TWD&amount=1",
                            '<input name="numberformat" tabindex="4" value="0.0871">')],
                          "url string, html string").write.parquet(f"{tmp}/pages")
    out = main(["rare", "--pages", f"{tmp}/pages", "--ref", f"{tmp}/ref", "--rate-type", "V",
                "--run-date", "20250221", "--job", "rare_v", "--erp", f"{tmp}/erp",
                "--host", "c.example"], spark=spark)
    assert out["counts"]["erp"] == 1
    back = sinks.read_erp_rates(spark, f"{tmp}/erp")
    assert back.where("job = 'rare_v' AND VALID_FROM = '20250228'").count() == 1
    assert back.where("job = 'common_m'").count() == 5


def test_streaming_newest_file_wins_within_a_batch(spark, tmp):
    src, table, ckpt = f"{tmp}/in", f"{tmp}/table", f"{tmp}/ckpt"
    now = time.time()
    old = {"start": "20250201", "end": "20250210",
           "items": [{"code": "USD", "buyValue": "1", "sellValue": "1"}]}
    write_doc(src, "old.json", old, mtime=now - 600)
    write_doc(src, "new.json", GOLDEN_DOC, mtime=now)
    ingest_new_quotes(spark, src, ckpt, table).awaitTermination()
    got = {(r.Currency, r.RateDate): str(r.Rate) for r in sinks.read_rates(spark, table).collect()}
    assert got[("USD", "2025-02-01")] == "32.70000" and len(got) == 3


def test_merge_into_needs_a_merge_capable_table(spark, tmp):
    """Parquet catalog tables cannot MERGE; the sink says so through Spark's
    own error instead of silently rewriting the table."""
    spark.createDataFrame([("USD", "TWD", "1.00000", "2025-02-01")],
                          "Currency string, Currency2 string, Rate string, RateDate string") \
        .withColumn("Rate", F.col("Rate").cast("decimal(18,5)")) \
        .write.mode("overwrite").option("path", f"{tmp}/er").saveAsTable("exchange_rate_probe")
    batch = _rates_frame(spark, [("USD", "TWD", "2.0", "2025-02-01", 0)])
    try:
        with pytest.raises(Exception, match="does not support MERGE INTO TABLE"):
            sinks.merge_into_table(batch, "exchange_rate_probe")
    finally:
        spark.sql("DROP TABLE IF EXISTS exchange_rate_probe")


def test_corrupt_document_fails_the_scan(spark, tmp):
    os.makedirs(f"{tmp}/q", exist_ok=True)
    write_doc(f"{tmp}/q", "good.json", GOLDEN_DOC)
    with open(f"{tmp}/q/bad.json", "w") as f:
        f.write('{"start": "20250211", "items": [ {"code": "USD", ')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        scan_quote_json(spark, f"{tmp}/q").collect()


def test_cli_reads_catalog_tables(spark, tmp):
    from ratebook.cli import main
    ref_frame(spark).write.mode("overwrite").option("path", f"{tmp}/reft").saveAsTable("ref_rates_probe")
    try:
        out = main(["common", "--quotes", _golden_dir(tmp), "--ref", "table:ref_rates_probe",
                    "--targets", '["TWD","USD","EUR"]', "--rate-type", "V", "--run-date", "20250221",
                    "--job", "common_v", "--erp", f"{tmp}/erp"], spark=spark)
    finally:
        spark.sql("DROP TABLE IF EXISTS ref_rates_probe")
    assert out["counts"]["erp"] == 5


def test_cli_ingest(spark, tmp):
    from ratebook.cli import main
    write_doc(f"{tmp}/in", "a.json", GOLDEN_DOC)
    main(["ingest", "--source", f"{tmp}/in", "--checkpoint", f"{tmp}/ck", "--table", f"{tmp}/rates"],
         spark=spark)
    got = {(r.Currency, str(r.Rate)) for r in sinks.read_rates(spark, f"{tmp}/rates").collect()}
    assert got == {("USD", "32.70000"), ("JPY", "0.21700"), ("EUR", "35.40000")}


def test_runner_retry_gives_the_same_outputs(spark, tmp):
    """A scheduler retry re-runs the whole job: outputs must not change."""
    q = rates.quote_mid(scan_quote_json(spark, _golden_dir(tmp)))

    def run():
        jobs.run_common(q, GOLDEN_TARGETS, ref_frame(spark), RUN, "M", "common_m", f"{tmp}/erp",
                        export_dir=f"{tmp}/exp", bpm_path=f"{tmp}/bpm",
                        run_ts=dt.datetime(2025, 2, 21, 3, 0))
        erp = sorted(tuple(r) for r in sinks.read_erp_rates(spark, f"{tmp}/erp").collect())
        bpm = sorted(tuple(str(x) for x in r) for r in sinks.read_rates(spark, f"{tmp}/bpm").collect())
        exp = sorted(tuple(r) for r in spark.read.option("header", True).csv(
            f"{tmp}/exp/FinalData__common_m__20250221_1100").collect())
        return erp, bpm, exp

    first = run()
    assert run() == first
    assert len(first[0]) == 5 and len(first[1]) == 3 and len(first[2]) == 5


def test_newest_file_tie_broken_by_path(spark, tmp):
    t = time.time() - 60
    a = dict(GOLDEN_DOC, items=[{"code": "USD", "buyValue": "1", "sellValue": "1"}])
    b = dict(GOLDEN_DOC, items=[{"code": "USD", "buyValue": "2", "sellValue": "2"}])
    write_doc(f"{tmp}/q", "a.json", a, mtime=t)
    write_doc(f"{tmp}/q", "b.json", b, mtime=t)
    got = [(r.code, r.buyValue) for r in scan_quote_json(spark, f"{tmp}/q").collect()]
    assert got == [("USD", "2")]   # same time: the greater path ("b.json") wins, every run


def test_upsert_rejects_nulls_and_writes_nothing(spark, tmp):
    from ratebook.operators.quality import GuardError
    path = f"{tmp}/rates"
    sinks.upsert_rates(_rates_frame(spark, [("USD", "TWD", "32.7", "2025-02-01", 0)]), path)
    for bad in [("USD", "TWD", None, "2025-02-01", 1), ("USD", "TWD", "33", None, 1), (None, "TWD", "33", "2025-02-01", 1),
                ("USD", "TWD", "33", "2025-02-01", None)]:
        with pytest.raises(GuardError, match="NULL"):
            sinks.upsert_rates(_rates_frame(spark, [bad, ("EUR", "TWD", "35", "2025-02-01", 0)]), path)
    with pytest.raises(GuardError, match="no rows"):
        sinks.upsert_rates(_rates_frame(spark, []), path)
    assert [(r.Currency, str(r.Rate)) for r in sinks.read_rates(spark, path).collect()] == [("USD", "32.70000")]


def test_upsert_is_all_or_nothing(spark, tmp, monkeypatch):
    """A run that fails after writing its rows leaves readers on the old version; the retry succeeds."""
    path = f"{tmp}/rates"
    sinks.upsert_rates(_rates_frame(spark, [("USD", "TWD", "1", "2025-02-01", 0), ("EUR", "TWD", "2", "2025-02-02", 0)]), path)
    batch = _rates_frame(spark, [("USD", "TWD", "9", "2025-02-01", 0), ("JPY", "TWD", "3", "2025-02-03", 0)])
    real = sinks._manifest
    monkeypatch.setattr(sinks, "_manifest", lambda s, p, v: real(s, p, v).withColumn("RateDate", F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        sinks.upsert_rates(batch, path)
    monkeypatch.undo()
    table = lambda: sorted((r.Currency, str(r.Rate), r.RateDate) for r in sinks.read_rates(spark, path).collect())
    old = [("EUR", "2.00000", "2025-02-02"), ("USD", "1.00000", "2025-02-01")]
    assert table() == old and sinks.rate_versions(spark, path) == [1]
    sinks.upsert_rates(batch, path)
    new = [("EUR", "2.00000", "2025-02-02"), ("JPY", "3.00000", "2025-02-03"), ("USD", "9.00000", "2025-02-01")]
    assert table() == new and sinks.rate_versions(spark, path) == [1, 2]
    assert sorted((r.Currency, str(r.Rate), r.RateDate) for r in sinks.read_rates(spark, path, 1).collect()) == old
    sinks.vacuum_rates(spark, path)
    assert table() == new and sinks.rate_versions(spark, path) == [2]


def test_streaming_ingest_with_another_base(spark, tmp):
    write_doc(f"{tmp}/in", "a.json", GOLDEN_DOC)
    ingest_new_quotes(spark, f"{tmp}/in", f"{tmp}/ck", f"{tmp}/t", base="USD", max_files=1).awaitTermination()
    assert {(r.Currency, r.Currency2) for r in sinks.read_rates(spark, f"{tmp}/t").collect()} == \
        {("USD", "USD"), ("JPY", "USD"), ("EUR", "USD")}


def test_streaming_equal_file_times_follow_the_path(spark, tmp):
    t = time.time() - 60
    for name, value in (("a.json", "1"), ("b.json", "2")):
        write_doc(f"{tmp}/in", name, dict(GOLDEN_DOC, items=[{"code": "USD", "buyValue": value, "sellValue": value}]), mtime=t)
    ingest_new_quotes(spark, f"{tmp}/in", f"{tmp}/ck", f"{tmp}/t").awaitTermination()
    assert [str(r.Rate) for r in sinks.read_rates(spark, f"{tmp}/t").collect()] == ["2.00000"]


@pytest.mark.parametrize("lacking", ["start", "items"])
def test_incomplete_document_names_its_file(spark, tmp, lacking):
    write_doc(f"{tmp}/q", "good.json", GOLDEN_DOC)
    write_doc(f"{tmp}/q", "lacks.json", {k: v for k, v in GOLDEN_DOC.items() if k != lacking})
    with pytest.raises(Exception, match=f"without {lacking}.*lacks.json"):
        scan_quote_json(spark, f"{tmp}/q").collect()


def _page(a, b, value, quote='"'):
    q = quote
    return (f"https://converter.example.com/?from={a}&to={b}&amount=1",
            f"<input name={q}numberformat{q} tabindex={q}4{q} value={q}{value}{q}>")


def test_converter_pages_of_other_hosts_and_quoting(spark):
    from ratebook.sources.pages import extract_page_quotes
    pages = spark.createDataFrame([_page("HUF", "TWD", "0.1"), _page("HUF", "USD", "0.2", "'"),
                                   ("https://routes.example.com/?from=A&to=B", "<p>a route planner</p>"), (None, "x")],
                                  "url string, html string")
    got = {(r.from_curr, r.to_curr, r.fx_rate) for r in extract_page_quotes(pages, RUN).collect()}
    assert got == {("HUF", "TWD", "0.1"), ("HUF", "USD", "0.2")}


def test_not_ready_page_stops_the_run(spark, tmp):
    pages = spark.createDataFrame([_page("HUF", "TWD", "0.1"), _page("HUF", "USD", "-")], "url string, html string")
    with pytest.raises(Exception, match="not ready: HUF->USD"):
        jobs.run_rare(pages, ref_frame(spark), RUN, "M", "rare_m", f"{tmp}/erp")
    rep = jobs.run_rare(pages, ref_frame(spark), RUN, "M", "rare_m", f"{tmp}/erp", allow_not_ready=True)
    assert rep.counts == {"erp": 1, "quotes": 1, "skipped": 1}


def test_pair_captured_twice_stops_the_run(spark, tmp):
    from ratebook.operators.quality import GuardError
    pages = spark.createDataFrame([_page("HUF", "TWD", "0.1"), _page("HUF", "TWD", "0.2")], "url string, html string")
    with pytest.raises(GuardError, match="captured twice"):
        jobs.run_rare(pages, ref_frame(spark), RUN, "M", "rare_m", f"{tmp}/erp")


def test_every_skipped_pair_is_reported(spark, tmp):
    pages = spark.createDataFrame([_page("HUF", "TWD", "0.1")] + [_page("HUF", f"C{k}", "") for k in range(30)], "url string, html string")
    rep = jobs.run_rare(pages, ref_frame(spark), RUN, "V", "rare_v", f"{tmp}/erp", skipped_path=f"{tmp}/skipped")
    assert rep.counts["skipped"] == 30 and spark.read.parquet(f"{tmp}/skipped").count() == 30


def test_runner_parameters_are_checked(spark, tmp):
    from ratebook.operators.quality import GuardError
    q = rates.quote_mid(scan_quote_json(spark, _golden_dir(tmp)))
    with pytest.raises(ValueError, match="run_ts"):
        jobs.run_common(q, GOLDEN_TARGETS, ref_frame(spark), RUN, "M", "m", f"{tmp}/erp", export_dir=f"{tmp}/exp")
    with pytest.raises(GuardError, match="19990101"):
        jobs.run_common(q, GOLDEN_TARGETS, ref_frame(spark), RUN, "M", "m", f"{tmp}/erp", periods=["20250201", "19990101"])


def _put(folder, name, rate, mtime, start="20250301"):
    doc = {"start": start, "end": start, "items": [{"code": "USD", "buyValue": rate, "sellValue": rate}]}
    with open(f"{folder}/{name}.json", "w") as f:
        json.dump(doc, f)
    os.utime(f"{folder}/{name}.json", (mtime, mtime))


def test_late_older_file_does_not_win(spark, tmp):
    """T1 + S2 across batches: the newest file's rate stays, whatever arrives later; a replay changes nothing."""
    from ratebook.streaming.ingest import ingest_new_quotes
    src, table = f"{tmp}/src", f"{tmp}/rates"
    os.makedirs(src)

    def run():
        ingest_new_quotes(spark, src, f"{tmp}/ckpt", table).awaitTermination()
        return {(r.Currency, r.RateDate): str(r.Rate) for r in sinks.read_rates(spark, table).collect()}

    _put(src, "b-new", "32", 1_700_000_000)
    assert run() == {("USD", "2025-03-01"): "32.00000"}
    _put(src, "a-old", "31", 1_600_000_000)
    _put(src, "a-other-day", "30", 1_500_000_000, start="20250302")
    late = {("USD", "2025-03-01"): "32.00000", ("USD", "2025-03-02"): "30.00000"}
    assert run() == late
    _put(src, "c-newer", "33", 1_800_000_000)
    newer = late | {("USD", "2025-03-01"): "33.00000"}
    assert run() == newer
    # a fresh checkpoint replays every file, in one batch
    ingest_new_quotes(spark, src, f"{tmp}/ckpt2", table).awaitTermination()
    assert {(r.Currency, r.RateDate): str(r.Rate) for r in sinks.read_rates(spark, table).collect()} == newer
    # a job's batch has no file and wins; a file older than the last one seen still does not come back
    job = spark.createDataFrame([("USD", "TWD", "2025-03-01", "40", 0)], "Currency string, Currency2 string, RateDate string, Rate string, seq int")
    sinks.upsert_rates(job, table)
    _put(src, "d-older", "1", 1_750_000_000)
    assert run() == newer | {("USD", "2025-03-01"): "40.00000"}


def test_interleaved_upserts_are_both_kept(spark, tmp, monkeypatch):
    """K2: a writer that commits between another's read and commit is merged, not overwritten."""
    schema = "Currency string, Currency2 string, RateDate string, Rate string, seq int"
    table = f"{tmp}/rates"
    first = spark.createDataFrame([("USD", "TWD", "2025-01-01", "1", 0), ("EUR", "TWD", "2025-01-01", "2", 0)], schema)
    sinks.upsert_rates(first, table)
    one = spark.createDataFrame([("USD", "TWD", "2025-01-01", "10", 0), ("USD", "TWD", "2025-02-01", "11", 0)], schema)
    two = spark.createDataFrame([("EUR", "TWD", "2025-01-01", "20", 0), ("EUR", "TWD", "2025-03-01", "21", 0)], schema)
    real, calls = sinks._commit, []

    def late(s, path, version, manifest):
        calls.append(version)
        if len(calls) == 1:                       # the other writer commits just before this one
            sinks.upsert_rates(two, table)
        return real(s, path, version, manifest)

    monkeypatch.setattr(sinks, "_commit", late)
    sinks.upsert_rates(one, table)
    assert calls == [2, 2, 3] and sinks.rate_versions(spark, table) == [1, 2, 3]
    got = {(r.Currency, r.RateDate): str(r.Rate) for r in sinks.read_rates(spark, table).collect()}
    assert got == {("USD", "2025-01-01"): "10.00000", ("USD", "2025-02-01"): "11.00000", ("EUR", "2025-01-01"): "20.00000", ("EUR", "2025-03-01"): "21.00000"}
    sinks.vacuum_rates(spark, table)
    assert {(r.Currency, r.RateDate): str(r.Rate) for r in sinks.read_rates(spark, table).collect()} == got


def _captures(spark, rows):
    return spark.createDataFrame([(*_page(a, b, value), day and dt.date.fromisoformat(day), number) for a, b, value, day, number in rows],
                                 "url string, html string, captured_on date, capture_id long")


ARCHIVE = [
    ("HUF", "TWD", "0.1", "2025-01-03", 5), ("HUF", "TWD", "0.2", "2025-03-30", 1), ("HUF", "TWD", "0.3", "2025-03-30", 2),
    ("HUF", "TWD", "0.3", "2025-03-30", 2),                                                       # delivered twice
    ("HUF", "TWD", "0.4", "2025-04-01", -7), ("HUF", "USD", "0.5", "2025-02-01", 9), ("HUF", "USD", "", "2025-02-02", 1),
    ("HUF", "HUF", "9", None, 100), ("HUF", "HUF", "9", "2025-06-01", None),
]


def test_newest_captures_decide(spark):
    from ratebook.sources.pages import capture_rates
    got = sorted(map(tuple, capture_rates(_captures(spark, ARCHIVE)).collect()))
    assert got == [("HUF", "TWD", "0.3", "20250101", "20250330"), ("HUF", "TWD", "0.4", "20250401", "20250401"),
                   ("HUF", "USD", "", "20250101", "20250202")]
    yearly = sorted(map(tuple, capture_rates(_captures(spark, ARCHIVE), "year").collect()))
    assert yearly == [("HUF", "TWD", "0.4", "20250101", "20250401"), ("HUF", "USD", "", "20250101", "20250202")]
    assert capture_rates(_captures(spark, ARCHIVE).where("false")).count() == 0


def _files_read(df):
    """Files of the scan that reads HTML, from its metrics after a run."""
    counted, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet") and "html" in node.output().toString():
            counted.append(node.metrics().apply("numFiles").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert len(counted) == 1
    return counted[0]


def test_html_is_read_for_chosen_captures_only(spark, tmp):
    from ratebook.sources.pages import capture_rates, newest_captures
    rows = [("HUF", "TWD", f"0.{k}", f"2025-01-{k:02d}", k) for k in range(1, 29)] + [("HUF", "USD", "2", "2025-01-07", 99)]
    _captures(spark, rows).repartition("captured_on").write.partitionBy("captured_on").parquet(f"{tmp}/archive")
    archive = spark.read.parquet(f"{tmp}/archive")
    # the first pass does not touch the HTML
    plan = newest_captures(archive)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<url:string,capture_id:bigint>" in plan
    # the second reads the days of the chosen captures: 2 of 28
    late = capture_rates(archive)
    assert sorted((r.to_curr, r.rate) for r in late.collect()) == [("TWD", "0.28"), ("USD", "2")]
    plan = late._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "html" in line]
    assert scans and all("PartitionFilters: [captured_on" in line for line in scans)
    # one file a day
    assert _files_read(late) == 2


def test_run_rare_over_an_archive(spark, tmp):
    from ratebook.cli import main
    ref_frame(spark).write.parquet(f"{tmp}/ref")
    good = [("HUF", "TWD", "0.0871", "2025-01-20", 1), ("HUF", "TWD", "0.0872", "2025-02-20", 2), ("HUF", "TWD", "", "2025-03-01", 3)]
    _captures(spark, good).write.parquet(f"{tmp}/archive")
    out = main(["rare", "--pages", f"{tmp}/archive", "--ref", f"{tmp}/ref", "--rate-type", "M", "--run-date", "20250221",
                "--job", "rare_m", "--erp", f"{tmp}/erp", "--period", "month", "--bpm", f"{tmp}/bpm"], spark=spark)
    assert out["counts"] == {"erp": 2, "quotes": 2, "skipped": 1}
    rows = {(r.VALID_FROM, r.EXCH_RATE) for r in spark.read.parquet(f"{tmp}/erp").select(F.col("VALID_FROM").cast("string"), "EXCH_RATE").collect()}
    assert rows == {("20250101", "0.08710"), ("20250201", "0.08720")}
    late = _captures(spark, [("HUF", "TWD", "-", "2025-03-02", 1), *good])
    with pytest.raises(Exception, match="not ready"):
        jobs.run_rare(late, ref_frame(spark), RUN, "M", "rare_m", f"{tmp}/erp", period="month")


@pytest.mark.parametrize("named", ["/shared/checkpoints", "file:///shared/checkpoints", "hdfs://name/checkpoints", None])
def test_a_cluster_names_its_checkpoint_folder(named):
    """What spark.checkpoint.dir names is shared, in whatever form; only a cluster that names none is refused."""
    from types import SimpleNamespace as Fake

    from ratebook.session import staging_path
    context = Fake(master="spark://host:7077", applicationId="app-1", getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    cluster = Fake(sparkContext=context, conf=Fake(get=lambda key, default=None: named))
    if named:
        assert staging_path(cluster, "ranges").startswith(f"{named}/ratebook-stage/app-1/ranges-")
    else:
        with pytest.raises(RuntimeError, match="not set"):
            staging_path(cluster, "ranges")
