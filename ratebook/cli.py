"""Command line for the scheduled jobs (launch with ``spark-submit`` or
``python -m ratebook.cli``).  Scheduling itself belongs to whatever launches
the job; every run is idempotent, so a retried launch repeats exactly.

    common  --quotes DIR --ref PATH|table:NAME --targets JSON --rate-type M|V --run-date yyyyMMdd
            --job NAME --erp PATH [--export DIR --run-ts T [--export-file]] [--bpm PATH | --bpm-table NAME] [--periods p1,...]
    rare    --pages PATH|table:NAME --ref PATH|table:NAME --rate-type M|V --run-date yyyyMMdd
            --job NAME --erp PATH [--export DIR --run-ts T [--export-file]] [--bpm PATH | --bpm-table NAME]
    ingest  --source DIR --checkpoint DIR --table PATH
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from ratebook.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ratebook")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("common", "rare"):
        s = sub.add_parser(name)
        if name == "common":
            s.add_argument("--quotes", required=True, help="folder of quote JSON documents")
            s.add_argument("--targets", required=True, help='JSON list, e.g. ["TWD","USD"]')
            s.add_argument("--periods", default=None, help="comma-separated period starts to keep")
        else:
            s.add_argument("--pages", required=True,
                           help="converter pages (url, html): a Parquet path, or table:<catalog name>")
        s.add_argument("--ref", required=True,
                       help="reference-factor table: a Parquet path, or table:<catalog name>")
        s.add_argument("--rate-type", required=True, choices=["M", "V"])
        s.add_argument("--run-date", required=True, help="yyyyMMdd (never defaults to today)")
        s.add_argument("--job", required=True)
        s.add_argument("--erp", required=True)
        s.add_argument("--export", default=None)
        s.add_argument("--export-file", action="store_true", help="export a single CSV file instead of a folder of part files")
        s.add_argument("--bpm", default=None, help="keyed rate table (Parquet path, set-based upsert)")
        s.add_argument("--bpm-table", default=None,
                       help="keyed rate table in a catalog whose format supports MERGE INTO")
        s.add_argument("--run-ts", default=None, help="UTC run time yyyy-MM-ddTHH:mm; required with --export")
        if name == "rare":
            s.add_argument("--skipped", default=None, help="table of the pairs without a rate (Parquet path)")
            s.add_argument("--host", default=None, help="host of the converter pages")
            s.add_argument("--period", default=None, choices=["week", "month", "quarter", "year"],
                           help="the pages are an archive with captured_on and capture_id: take each period's newest capture per pair")
            s.add_argument("--allow-not-ready", action="store_true", help="skip pages that had not finished loading")
    s = sub.add_parser("ingest")
    s.add_argument("--source", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--base", default="TWD")
    s.add_argument("--max-files", type=int, default=None, help="files in a micro-batch, at most")
    return p


def _read(spark, spec: str, schema):
    """``table:<name>`` reads a catalog table, anything else a Parquet path;
    either way only the schema's columns, with the schema's types."""
    if spec.startswith("table:"):
        df = spark.table(spec[len("table:"):])
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.read.schema(schema).parquet(spec)


def main(argv: list[str] | None = None, spark=None) -> dict:
    from ratebook.operators.rates import quote_mid
    from ratebook.plans.jobs import run_common, run_rare
    from ratebook.schemas import CAPTURES, PAGES, REF_RATES
    from ratebook.sources.quote_files import scan_quote_json
    from ratebook.sources.sinks import drop_staged
    from ratebook.streaming.ingest import ingest_new_quotes

    a = _parser().parse_args(argv)
    spark = spark or build_session()
    if a.cmd == "ingest":
        ingest_new_quotes(spark, a.source, a.checkpoint, a.table, a.base, max_files=a.max_files).awaitTermination()
        drop_staged(spark)
        return {"ingested": a.table}
    run_ts = _dt.datetime.fromisoformat(a.run_ts) if a.run_ts else None
    ref = _read(spark, a.ref, REF_RATES)
    if a.cmd == "common":
        quotes = quote_mid(scan_quote_json(spark, a.quotes))
        periods = a.periods.split(",") if a.periods else None
        rep = run_common(quotes, json.loads(a.targets), ref, a.run_date, a.rate_type, a.job,
                         a.erp, export_dir=a.export, bpm_path=a.bpm, run_ts=run_ts, periods=periods,
                         bpm_table=a.bpm_table, export_file=a.export_file)
    else:
        pages = _read(spark, a.pages, CAPTURES if a.period else PAGES)
        rep = run_rare(pages, ref, a.run_date, a.rate_type, a.job, a.erp,
                       export_dir=a.export, bpm_path=a.bpm, run_ts=run_ts, bpm_table=a.bpm_table,
                       skipped_path=a.skipped, host=a.host, allow_not_ready=a.allow_not_ready, export_file=a.export_file,
                       period=a.period)
    drop_staged(spark)                # every output is written
    out = {"job": rep.job, "counts": rep.counts, "outputs": rep.outputs}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
