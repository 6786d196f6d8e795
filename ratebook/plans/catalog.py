"""Registered queries: one per operator of the inventory, over the driver's
tables (``queries()`` in ``__spark_entry__``).

Every query reads whole tables (no row caps, no id subsets); the only limit
is D1's MAX_ROWS, which is that operator's feature.  Rates are shown as
fixed five-decimal text and dates as text, so results compare exactly with
any engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.functions.dates import date_text, iso_date, local_stamp, local_time, month_end, yyyymmdd
from ratebook.functions.numbers import fmt5, ratio5
from ratebook.functions.text import export_name
from ratebook.operators import enrich, quality, rates, records
from ratebook.operators.merge import last_rank, merge_tagged
from ratebook.plans import jobs
from ratebook.sources import proxies
from ratebook.sources.config import BASE_CURRENCY, drop_base, target_list
from ratebook.sources.pages import capture_rates, extract_page_quotes, quotes_from_rates
from ratebook.sources.quote_files import newest_per_key
from ratebook.sources.tables import table

# Fixed parameters of the registered queries.
PERIOD = "quarter"
ENTRY_PERIOD = "year"
TARGETS = proxies.TARGETS
CROSS_TARGETS = [t for t in TARGETS if t != BASE_CURRENCY]      # F2 applied to the list
RUN_DATE = proxies.RUN_DATE
GAP_PERIOD = "month"
GAP_TARGETS = [f"NATION_{i}" for i in range(25)]
FLIGHT_RANGES = [("I", "BT", "19960101", "19960131"), ("I", "BT", "19980601", "19980615")]
FLIGHT_EQUALS = {"o_orderstatus": "*", "o_orderpriority": "1-URGENT"}
FLIGHT_MAX_ROWS = 100
SIGNUP_DAYS = 3
CALENDAR_START, CALENDAR_DAYS = "1990-01-01", 7000
EXPORT_JOB = "common_m"
MERGE_REPEAT_CURRENCY = proxies.MERGE_REPEAT_CURRENCY


def _quotes(spark, sf_dir, period=PERIOD):
    return proxies.quotes(spark, sf_dir, period)


def _show_rates(df: DataFrame) -> DataFrame:
    return df.select("period", "from_curr", "to_curr", _shown())


def _shown():
    """The unscaled rate, rounded once from its ratio."""
    return ratio5("fx_num", "fx_den").cast("string").alias("fx_rate")


def _targets(spark):
    return drop_base(target_list(spark, TARGETS), BASE_CURRENCY)


# ---------------------------------------------------------------- rates

def q_quote_mid(spark, sf_dir):
    q = _quotes(spark, sf_dir)
    return q.select("period", "pos", "from_curr", "to_curr",
                    F.col("buyValue").cast("decimal(18,4)").cast("string").alias("buyValue"),
                    F.col("sellValue").cast("decimal(18,4)").cast("string").alias("sellValue"),
                    fmt5("fx_rate").alias("fx_rate"), "start", "end")



def q_all_rates_union(spark, sf_dir):
    return _show_rates(rates.union_rates(_quotes(spark, sf_dir), TARGETS))


def q_self_pair_filter(spark, sf_dir):
    return _show_rates(rates.all_rates(_quotes(spark, sf_dir), TARGETS))


def q_target_list(spark, sf_dir):
    q = _quotes(spark, sf_dir)
    cover = q.groupBy(F.col("from_curr").alias("to_curr")) \
        .agg(F.countDistinct("period").alias("periods_quoted"))
    return (_targets(spark).join(cover, "to_curr", "left")
            .select("to_curr", "t_pos",
                    F.coalesce("periods_quoted", F.lit(0)).cast("bigint").alias("periods_quoted")))


def q_rare_pair_grid(spark, sf_dir):
    return proxies.rare_rate_texts(spark, sf_dir)


def q_target_mid_first(spark, sf_dir):
    m = rates.target_mids(_quotes(spark, sf_dir), CROSS_TARGETS)
    return m.select("period", "to_curr", fmt5("target_mid").alias("target_mid"))


def q_cross_rates(spark, sf_dir):
    return _show_rates(rates.cross_rates(_quotes(spark, sf_dir), CROSS_TARGETS))


# ---------------------------------------------------------------- enrich

def _enriched(spark, sf_dir):
    rows = rates.all_rates(_quotes(spark, sf_dir), TARGETS)
    snap = enrich.ref_snapshot(proxies.ref_rates(spark, sf_dir), RUN_DATE)
    return enrich.enrich_left(rows, snap)


def q_ref_enrich_left(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "period", "from_curr", "to_curr", _shown(),
        F.col("from_ratio").cast("bigint").alias("from_ratio"),
        F.col("ref_rate").cast("string").alias("ref_rate"),
        F.col("to_ratio").cast("bigint").alias("to_ratio"))


def q_ref_known_pairs(spark, sf_dir):
    return enrich.known_pairs(_enriched(spark, sf_dir)).select(
        "period", "from_curr", "to_curr", _shown(),
        F.col("from_ratio").cast("bigint").alias("from_ratio"))


def q_scaled_rates(spark, sf_dir):
    s = enrich.scaled(enrich.known_pairs(_enriched(spark, sf_dir)))
    return s.select("period", "from_curr", "to_curr", _shown(),
                    F.col("from_ratio").cast("bigint").alias("from_ratio"),
                    F.col("fx_rate_with_ratio").cast("string").alias("fx_rate_with_ratio"))


# ---------------------------------------------------------------- dates

def _order_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", date_text("o_orderdate").alias("order_date"))


def q_month_end(spark, sf_dir):
    return _order_dates(spark, sf_dir).select(
        "o_orderkey", "order_date", month_end("order_date").alias("month_end"))


def q_date_reformat(spark, sf_dir):
    return _order_dates(spark, sf_dir).select(
        "o_orderkey", yyyymmdd("order_date").alias("valid_date"),
        iso_date("order_date").alias("iso_date"))


def q_local_run_stamp(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_id", "ts")
    return e.select("event_id",
                    F.date_format(local_time("ts"), "yyyy-MM-dd HH:mm:ss").alias("local_time"),
                    local_stamp("ts").alias("stamp"),
                    export_name(EXPORT_JOB, F.col("ts")).alias("export_file"))


# ---------------------------------------------------------------- jobs

def q_erp_layout_m(spark, sf_dir, period=PERIOD):
    return jobs.common_rates(_quotes(spark, sf_dir, period), TARGETS,
                             proxies.ref_rates(spark, sf_dir), RUN_DATE, "M")


def q_erp_layout_v(spark, sf_dir):
    return jobs.common_rates(_quotes(spark, sf_dir), TARGETS,
                             proxies.ref_rates(spark, sf_dir), RUN_DATE, "V")


def _rare_quotes(spark, sf_dir):
    # one proxy page is not ready; the query skips it, as the runner may
    return extract_page_quotes(proxies.all_pages(spark, sf_dir), RUN_DATE, allow_not_ready=True)


def q_page_quotes(spark, sf_dir):
    return _rare_quotes(spark, sf_dir)


def q_rare_erp_m(spark, sf_dir):
    return jobs.rare_rates(_rare_quotes(spark, sf_dir), proxies.ref_rates(spark, sf_dir), RUN_DATE, "M")


def q_rare_erp_v(spark, sf_dir):
    return jobs.rare_rates(_rare_quotes(spark, sf_dir), proxies.ref_rates(spark, sf_dir), RUN_DATE, "V")


def q_capture_quotes(spark, sf_dir):
    """S3 over an archive that grows with the orders: each quarter's newest capture per pair."""
    conv = capture_rates(proxies.converter_captures(spark, sf_dir), PERIOD)
    return quotes_from_rates(conv, RUN_DATE, allow_not_ready=True)


def q_rare_history_m(spark, sf_dir):
    return jobs.rare_rates(q_capture_quotes(spark, sf_dir), proxies.ref_rates(spark, sf_dir), RUN_DATE, "M")


def q_rare_history_v(spark, sf_dir):
    return jobs.rare_rates(q_capture_quotes(spark, sf_dir), proxies.ref_rates(spark, sf_dir), RUN_DATE, "V")


def q_bpm_layout(spark, sf_dir):
    return jobs.bpm_rows(_quotes(spark, sf_dir))


def q_bpm_merge(spark, sf_dir):
    m = merge_tagged(proxies.merge_rows(spark, sf_dir, PERIOD))
    return m.select("Currency", "Currency2", F.col("Rate").cast("string").alias("Rate"), "RateDate")


# ---------------------------------------------------------------- guards

def q_completeness_gaps(spark, sf_dir):
    return quality.completeness_gaps(_quotes(spark, sf_dir, GAP_PERIOD), GAP_TARGETS) \
        .select("period", "to_curr")


def q_invalid_rates(spark, sf_dir):
    return quality.invalid_rates(proxies.rate_texts(spark, sf_dir), "Rate").select("o_orderkey", "Rate")


def q_newest_quote(spark, sf_dir):
    """S2's rule over every order: per (period, currency) the latest capture
    by (order date, order key); the text is formatted after aggregating."""
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    po = proxies.priced_orders(spark, sf_dir)
    rows = (po.join(nation, po["c_nationkey"] == nation["n_nationkey"])
            .select(date_text(F.trunc("order_date", PERIOD)).alias("period"),
                    F.col("n_name").alias("from_curr"), "order_date", "o_orderkey",
                    proxies._price("o_totalprice").alias("value")))
    rows = rows.withColumn("_rank", last_rank(F.unix_date("order_date"), "o_orderkey", rows))
    latest = newest_per_key(rows, ["period", "from_curr"], ["_rank"],
                            ["value", "o_orderkey", "order_date"])
    return latest.select("period", "from_curr", F.col("value").cast("string").alias("value"),
                         "o_orderkey", date_text("order_date").alias("last_date"))


def q_run_counts(spark, sf_dir):
    """A1: rows at each stage of W1, from ONE pass: the union of mid and
    cross rows is enriched once and the stage counts are conditional counts
    over it (mid rows are those to the base currency; cross rows the rest;
    F3 and F4 are the conditions of the later stages)."""
    u = rates.union_rates(_quotes(spark, sf_dir), TARGETS)
    snap = enrich.ref_snapshot(proxies.ref_rates(spark, sf_dir), RUN_DATE)
    e = enrich.enrich_left(u, snap)
    is_mid = F.col("to_curr") == F.lit(BASE_CURRENCY)
    kept = F.col("from_curr") != F.col("to_curr")
    known = kept & (F.col("ref_rate") != 0)

    def n(cond):
        return F.count(F.when(cond, F.lit(1))).cast("bigint")

    counts = e.agg(n(is_mid).alias("quotes"), n(~is_mid).alias("cross_rates"),
                   n(kept).alias("all_rates"), n(known).alias("known_pairs"),
                   n(known).alias("erp_rows"))
    return counts.select(F.expr(
        "stack(5, 'quotes', quotes, 'cross_rates', cross_rates, 'all_rates', all_rates, "
        "'known_pairs', known_pairs, 'erp_rows', erp_rows) AS (stage, rows)"))


# ---------------------------------------------------------------- records

def q_range_select(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
              "o_orderpriority", "o_orderdate", "o_totalprice")
    sel = records.range_select(o, "o_orderdate", FLIGHT_RANGES, FLIGHT_EQUALS,
                               max_rows=FLIGHT_MAX_ROWS, order_by=["o_orderkey"],
                               kind="timestamp_ntz")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    det = records.detail_lookup(sel, cust, sel["o_custkey"] == cust["c_custkey"])
    return det.select("o_orderkey", date_text("o_orderdate").alias("flight_date"),
                      "o_orderpriority",
                      proxies._price("o_totalprice").cast("string").alias("price"), "c_name")


def q_range_table_select(spark, sf_dir):
    """D1 with a selection table: a user's events on the days from a signup of theirs on."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    selection = e.where("event_type = 'signup'").select(
        "user_id", F.lit("I").alias("SIGN"), F.lit("BT").alias("OPTION"), date_text("ts").alias("LOW"),
        date_text(F.date_add(F.to_date("ts"), (F.col("event_id") % SIGNUP_DAYS).cast("int"))).alias("HIGH"))
    near = records.range_table_select(e, "ts", selection, ["user_id"], kind="timestamp_ntz")
    return near.select("event_id", "user_id", "event_type", date_text("ts").alias("day"))


def q_range_calendar_select(spark, sf_dir):
    """D1 with one selection table for all rows: orders of the days that the signups point at."""
    e = table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    low = F.date_add(F.lit(CALENDAR_START).cast("date"), (F.col("event_id") * 7 % CALENDAR_DAYS).cast("int"))
    selection = e.where("event_type = 'signup'").select(
        F.lit("I").alias("SIGN"), F.lit("BT").alias("OPTION"), date_text(low).alias("LOW"),
        date_text(F.date_add(low, (F.col("user_id") % SIGNUP_DAYS).cast("int"))).alias("HIGH"))
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    near = records.range_table_select(o, "o_orderdate", selection, kind="timestamp_ntz")
    return near.select("o_orderkey", date_text("o_orderdate").alias("flight_date"))


def q_call_metrics(spark, sf_dir):
    return records.call_metrics(proxies.calls_from_events(spark, sf_dir))


def q_normalize_records(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate",
               "l_returnflag", "l_extendedprice")
    d = date_text("l_shipdate")
    raw = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.concat(F.substring(d, 1, 6), F.lit("32"))).otherwise(d)
        .alias("ship"),
        F.rpad("l_returnflag", 10, " ").alias("flag"),
        F.lpad(F.col("l_linenumber").cast("string"), 6, "0").alias("line"),
        F.col("l_extendedprice").cast("decimal(15,2)").cast("string").alias("price"))
    spec = [("ship", "DATE"), ("flag", "CHAR"), ("line", "NUM", 6), ("price", "BCD", "15,2")]
    n = records.normalize_records(raw, spec, keep=["l_orderkey", "l_linenumber"])
    return n.select("l_orderkey", "l_linenumber",
                    F.date_format("ship", "yyyy-MM-dd").alias("ship"), "flag",
                    F.col("line").cast("bigint").alias("line"),
                    F.col("price").cast("string").alias("price"), "errors")


def q_normalize_record_types(spark, sf_dir):
    """D3 over all field types, nested ones included; some fields of some lines do not convert."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    day, n = date_text("l_shipdate"), F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(15,2)").cast("string")

    def two(column, mod):
        return F.lpad((F.col(column) % mod).cast("string"), 2, "0")

    def power(e):
        return F.concat(F.lit("E"), e.cast("string"))

    ship = F.when(n == 7, F.concat(F.substring(day, 1, 6), F.lit("32"))).otherwise(day)
    line = F.lpad(n.cast("string"), 6, "0")
    item = F.struct(price.alias("price"), F.when(n == 6, F.lit("0G")).otherwise(F.hex("l_returnflag")).alias("mark"))
    raw = li.select(
        "l_orderkey", "l_linenumber", F.rpad("l_returnflag", 10, " ").alias("c"), F.col("l_linestatus").alias("s"), ship.alias("d"),
        F.concat(two("l_orderkey", 24), two("l_partkey", 60), two("l_suppkey", 61)).alias("t"), line.alias("n"), price.alias("b"),
        F.concat(price, power(n * 3 - 20)).alias("f16"), F.concat(F.lit("-"), price, power(n - 6180)).alias("f34"),
        (F.col("l_quantity").cast("bigint") * 6).cast("string").alias("i"),
        F.col("l_discount").cast("decimal(4,2)").cast("string").alias("f"),
        F.when(n == 5, F.lit("4")).otherwise(F.hex(F.concat("l_returnflag", "l_linestatus"))).alias("x"), F.hex(day).alias("xs"),
        F.struct(ship.alias("d"), line.alias("n")).alias("st"), F.array(item, item).alias("tb"))
    spec = [("c", "CHAR", 1), ("s", "STRING"), ("d", "DATE"), ("t", "TIME"), ("n", "NUM", 6), ("b", "BCD", "15,2"),
            ("f16", "DECF16", "float"), ("f34", "DECF34", "float"), ("i", "INT", 1), ("f", "FLOAT"), ("x", "BYTE"), ("xs", "XSTRING"),
            ("st", "STRUCTURE", [("d", "DATE"), ("n", "NUM", 6)]), ("tb", "TABLE", [("price", "BCD", "15,2"), ("mark", "BYTE")])]
    out = records.normalize_records(raw, spec, keep=["l_orderkey", "l_linenumber"])
    return out.select(
        "l_orderkey", "l_linenumber", "c", "s", F.date_format("d", "yyyy-MM-dd").alias("d"), "t", F.col("n").cast("bigint").alias("n"),
        F.col("b").cast("string").alias("b"), F.col("f16.coefficient").cast("bigint").alias("f16_coefficient"), F.col("f16.exponent").alias("f16_exponent"),
        F.col("f34.coefficient").cast("bigint").alias("f34_coefficient"), F.col("f34.exponent").alias("f34_exponent"),
        F.col("i").cast("int").alias("i"), "f", F.hex("x").alias("x"), F.hex("xs").alias("xs"),
        F.date_format("st.d", "yyyy-MM-dd").alias("st_d"), F.col("st.n").cast("bigint").alias("st_n"),
        F.size("tb").alias("tb_size"), F.col("tb")[1]["price"].cast("string").alias("tb_price"), F.hex(F.col("tb")[1]["mark"]).alias("tb_mark"),
        "errors")


def q_flatten_deep_table(spark, sf_dir):
    flat = records.flatten_deep_table(proxies.deep_table_from_documents(spark, sf_dir))
    return flat.select(F.col("id").alias("doc_id"), "line_no", "I", "C", "STR", "XSTR")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "quote_mid": q_quote_mid,
    "self_pair_filter": q_self_pair_filter,
    "target_list": q_target_list,
    "rare_pair_grid": q_rare_pair_grid,
    "target_mid_first": q_target_mid_first,
    "cross_rates": q_cross_rates,
    "all_rates_union": q_all_rates_union,
    "ref_enrich_left": q_ref_enrich_left,
    "ref_known_pairs": q_ref_known_pairs,
    "scaled_rates": q_scaled_rates,
    "month_end": q_month_end,
    "date_reformat": q_date_reformat,
    "erp_layout_m": q_erp_layout_m,
    "erp_layout_v": q_erp_layout_v,
    "page_quotes": q_page_quotes,
    "rare_erp_m": q_rare_erp_m,
    "rare_erp_v": q_rare_erp_v,
    "capture_quotes": q_capture_quotes,
    "rare_history_m": q_rare_history_m,
    "rare_history_v": q_rare_history_v,
    "bpm_layout": q_bpm_layout,
    "bpm_merge": q_bpm_merge,
    "completeness_gaps": q_completeness_gaps,
    "invalid_rates": q_invalid_rates,
    "newest_quote": q_newest_quote,
    "run_counts": q_run_counts,
    "local_run_stamp": q_local_run_stamp,
    "range_select": q_range_select,
    "range_table_select": q_range_table_select,
    "range_calendar_select": q_range_calendar_select,
    "call_metrics": q_call_metrics,
    "normalize_records": q_normalize_records,
    "normalize_record_types": q_normalize_record_types,
    "flatten_deep_table": q_flatten_deep_table,
}
