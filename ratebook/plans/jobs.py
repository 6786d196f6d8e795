"""The four rate jobs (W1-W4) as lazy plans, plus runners with guards and sinks.

* common, M: quotes -> mid + cross rates -> reference filter -> ERP layout
  valid from the period start; and quotes -> BPM layout -> keyed upsert.
* common, V: as M, valid from the month end of the period's ``end``.
* rare, M / V: converter pages -> quotes (pass-through, no cross rates, no
  self-pair filter) -> reference filter -> ERP layout; BPM branch for M.

The plan functions never run an action.  The runners stage the small derived
frames once (written to the cluster's checkpoint folder, which cuts lineage
and survives executor loss), run the guards on them, then write the sinks.
"""

from __future__ import annotations

import datetime as _dt
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.operators import enrich, layouts, quality, rates
from ratebook.schemas import ERP_COLUMNS
from ratebook.sources.config import BASE_CURRENCY
from ratebook.sources.sinks import stage, stage_observed


def _targets_wo_base(targets: list[str], base: str) -> list[str]:
    return [t for t in targets if t != base]


def erp_rates(all_rate_rows: DataFrame, ref: DataFrame, run_date, rate_type: str) -> DataFrame:
    """J4 -> F4 -> P8/N2 -> ERP layout (shared by all four jobs)."""
    layouts.check_rate_type(rate_type)
    snap = enrich.ref_snapshot(ref, run_date)
    known = enrich.known_pairs(enrich.enrich_left(all_rate_rows, snap))
    return layouts.erp_layout(enrich.scaled(known), rate_type)


def narrow_periods(quotes: DataFrame, periods: list[str] | None) -> DataFrame:
    """Keep the listed periods (``start`` values); ``None`` keeps all.

    An ``isin`` on a plain column: pushed into the scan when quotes are
    stored partitioned or sorted by period.
    """
    return quotes if periods is None else quotes.where(F.col("period").isin(list(periods)))


def common_rates(quotes: DataFrame, targets: list[str], ref: DataFrame, run_date,
                 rate_type: str = "M", base: str = BASE_CURRENCY,
                 periods: list[str] | None = None) -> DataFrame:
    """W1 (M) / W2 (V): ERP rows for the common currencies.

    ``periods`` narrows a history to chosen periods (for V: one per month).
    """
    layouts.check_rate_type(rate_type)
    quotes = narrow_periods(quotes, periods)
    rows = rates.all_rates(quotes, targets, skipped=False, base=base)
    return erp_rates(rows, ref, run_date, rate_type)


def rare_rates(rare_quotes: DataFrame, ref: DataFrame, run_date, rate_type: str = "M") -> DataFrame:
    """W3 (M) / W4 (V): ERP rows for the rare currencies (pass-through)."""
    layouts.check_rate_type(rate_type)
    rows = rates.all_rates(rates.rare_quotes_to_rates(rare_quotes), [], skipped=True)
    return erp_rates(rows, ref, run_date, rate_type)


def bpm_rows(quote_rows: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """BPM branch: raw quotes to the base currency, keyed-table layout."""
    return layouts.bpm_layout(quote_rows, base)


# ------------------------------------------------------------------ runners


@dataclass
class RunReport:
    job: str
    counts: dict = field(default_factory=dict)
    outputs: dict = field(default_factory=dict)


def _require(metrics: dict, what: str) -> None:
    """G1 from the staging pass's row count (no extra job)."""
    if not metrics["rows"]:
        raise quality.GuardError(f"{what}: no rows")


def _null_rows(cols: list[str]):
    """Rows with a NULL in any of ``cols`` (an aggregate for ``observe``)."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    return F.count(F.when(any_null, F.lit(1)))


# A pair has one rate per validity date.
ERP_KEYS = ["FROM_CURR", "TO_CURRNCY", "VALID_FROM"]


def _check_run_ts(export_dir: str | None, run_ts) -> None:
    """An export is named by its run time, which a retry must repeat."""
    if export_dir is not None and run_ts is None:
        raise ValueError("an export needs run_ts")


def _check_periods(quotes: DataFrame, periods: list[str] | None) -> None:
    """Every listed period must have quotes (the list is configuration)."""
    if periods is not None:
        have = {r[0] for r in quotes.select("period").distinct().collect()}
        if lacking := sorted(set(periods) - have):
            raise quality.GuardError(f"no quotes for listed periods: {', '.join(lacking)}")


def _publish(report: RunReport, erp: DataFrame, job: str, erp_path: str,
             export_dir: str | None, run_ts, bpm: DataFrame | None, bpm_path: str | None,
             bpm_table: str | None = None, export_file: bool = False) -> None:
    """Write the outputs of a run; independent sinks run as concurrent jobs.

    The ERP write, the export and the keyed upsert only read staged frames,
    so they are submitted from separate driver threads and Spark schedules
    their tasks side by side (the source runs these branches in parallel
    too).  Every sink is idempotent; the first failure is re-raised after
    all branches have finished.
    """
    from concurrent.futures import ThreadPoolExecutor

    from ratebook.sources import sinks

    def upsert():
        quality.require_rows(bpm, "BPM rates (no quotes to the base currency)")
        if bpm_table is not None:
            return sinks.merge_into_table(bpm, bpm_table)
        return sinks.upsert_rates(bpm, bpm_path)

    tasks = {"erp": lambda: sinks.write_erp_rates(erp, erp_path, job)}
    if export_dir is not None:
        tasks["export"] = lambda: sinks.export_rates(erp, export_dir, job, run_ts, export_file)
    if bpm is not None:
        tasks["bpm"] = upsert
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
    errors = []
    for name, fut in futures.items():
        try:
            report.outputs[name] = fut.result()
        except Exception as e:  # noqa: BLE001 - re-raised below
            errors.append(e)
    if errors:
        raise errors[0]


def run_common(quotes: DataFrame, targets: list[str], ref: DataFrame, run_date,
               rate_type: str, job: str, erp_path: str, export_dir: str | None = None,
               bpm_path: str | None = None, run_ts: _dt.datetime | None = None,
               base: str = BASE_CURRENCY, periods: list[str] | None = None,
               bpm_table: str | None = None, export_file: bool = False) -> RunReport:
    """Run W1/W2 end to end: guards, ERP write, export, BPM upsert."""

    layouts.check_rate_type(rate_type)                               # G2
    _check_run_ts(export_dir, run_ts)
    report = RunReport(job)
    q, mq = stage_observed(narrow_periods(quotes, periods), "quotes")
    _require(mq, "quotes")                                            # G1
    _check_periods(q, periods)
    quality.check_complete(q, _targets_wo_base(targets, base))       # G3
    if rate_type == "V":
        quality.check_one_period_per_month(q)                        # V collision
    erp, me = stage_observed(common_rates(q, targets, ref, run_date, rate_type, base),
                             "erp", nulls=_null_rows(ERP_COLUMNS))
    _require(me, "ERP rates (no known pairs)")                        # G1 / all unknown
    if me["nulls"]:
        quality.check_not_null(erp, ERP_COLUMNS, "ERP rates")        # K1 contract: name samples
    # a target listed twice repeats its rows on purpose, and just so often
    quality.check_unique(erp, ERP_KEYS, "ERP rates", copies=Counter(_targets_wo_base(targets, base)))
    report.counts["quotes"] = mq["rows"]
    report.counts["erp"] = me["rows"]
    keyed = (bpm_path is not None or bpm_table is not None) and rate_type == "M"
    bpm = layouts.bpm_layout(q, base, seq="pos") if keyed else None
    _publish(report, erp, job, erp_path, export_dir, run_ts, bpm, bpm_path, bpm_table, export_file)
    return report


def run_rare(pages: DataFrame, ref: DataFrame, run_date, rate_type: str, job: str,
             erp_path: str, export_dir: str | None = None, bpm_path: str | None = None,
             run_ts: _dt.datetime | None = None, base: str = BASE_CURRENCY,
             bpm_table: str | None = None, skipped_path: str | None = None,
             host: str | None = None, allow_not_ready: bool = False, export_file: bool = False,
             period: str | None = None) -> RunReport:
    """Run W3/W4 end to end from captured converter pages (S3 + F1).

    ``period`` (``quarter``, ``month``, ...): the pages are a growing archive
    of captures, of which each period's newest per pair counts.
    """
    from ratebook.sources.pages import CONVERTER_HOST, capture_rates, converter_rates, quotes_from_rates, skipped_rates

    layouts.check_rate_type(rate_type)
    _check_run_ts(export_dir, run_ts)
    report = RunReport(job)
    # The pages (HTML, the heavy column) are read once: the small converter
    # rates are staged, and both the skip report and the quotes come from them.
    host = host or CONVERTER_HOST
    conv = stage(capture_rates(pages, period, host) if period else converter_rates(pages, host), "converter-rates")
    # F1's log: every pair without a rate goes to a table, its count to the report.
    skipped = skipped_rates(conv)
    if skipped_path is not None:
        skipped.write.mode("overwrite").parquet(skipped_path)
        report.outputs["skipped"] = skipped_path
    report.counts["skipped"] = skipped.count()
    rq, mq = stage_observed(quotes_from_rates(conv, run_date, allow_not_ready), "rare-quotes")
    _require(mq, "rare quotes")
    erp, me = stage_observed(rare_rates(rq, ref, run_date, rate_type),
                             "erp", nulls=_null_rows(ERP_COLUMNS))
    _require(me, "ERP rates (no known pairs)")
    if me["nulls"]:
        quality.check_not_null(erp, ERP_COLUMNS, "ERP rates")
    quality.check_unique(erp, ERP_KEYS, "ERP rates (a pair captured twice)")
    report.counts["quotes"] = mq["rows"]
    report.counts["erp"] = me["rows"]
    keyed = (bpm_path is not None or bpm_table is not None) and rate_type == "M"
    bpm = bpm_rows(rates.rare_quotes_to_rates(rq), base).withColumn("seq", F.lit(0)) if keyed else None
    _publish(report, erp, job, erp_path, export_dir, run_ts, bpm, bpm_path, bpm_table, export_file)
    return report
