"""Exchange-rate inputs derived from the driver's TPC-H-style tables.

The driver's tables hold no currencies, so each rate input is derived from
them with Spark, and its size grows with the tables:

* quote items: ``orders x customer x nation`` per (nation, period); a nation
  is a currency, buy = min(o_totalprice)/100, sell = max(o_totalprice)/100.
* reference factors: ``nation x (nation + base)`` by a fixed rule.
* rare quotes: rates between the rare nations and the targets over the whole
  order history, rendered as captured converter pages.
* keyed-rate batches, call logs, flight lists and nested tables for the
  remaining operators.

Scale notes.  Orders are aggregated per (customer, period) first, with a
map-side partial step that collapses any hot customer, and the join with
``customer`` keeps that partitioning; nations are aggregated after it, and
``nation`` joins last.  Only the newest-capture query needs single orders: it
joins them on the customer key, where AQE splits skewed partitions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebook.functions.dates import date_text
from ratebook.operators.layouts import bpm_layout
from ratebook.operators.rates import quote_mid
from ratebook.sources.config import BASE_CURRENCY
from ratebook.sources.tables import table

# Fixed values of the proxies (FIXTURES §3).
TARGETS = ["TWD", "NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5"]
RARE_NATIONS = ["NATION_21", "NATION_22", "NATION_23", "NATION_24"]
RUN_DATE = _dt.date(2025, 2, 21)
BASE_KEY = 25                 # the base currency counts as nation key 25
PRICE_SCALE = "0.01"          # quotes are prices / 100
ABSENT_MOD = 11               # pair absent from the reference when (a+b) % 11 = 0
ZERO_MOD = 7                  # reference rate 0 when (a+b) % 7 = 0
FACTOR_MOD = 3                # from_factor = 10 ^ (regionkey % 3)
BLANK_PAGES = {("NATION_22", "NATION_3"): "", ("NATION_24", "NATION_2"): "-"}
BLANK_EACH, UNREADY_EACH = 13, 17          # captures whose number these divide show no rate, or are not ready
CONVERTER_BASE = "https://converter.example.com/en/"
MERGE_BUMP = "0.50000"
MERGE_REPEAT_BUMP = "1.00000"
MERGE_REPEAT_CURRENCY = "NATION_1"


def _price(col: str = "o_totalprice"):
    """Money column -> DECIMAL(18,2) -> scaled to a quote, DECIMAL(18,4)."""
    return (F.col(col).cast("decimal(18,2)") * F.lit(PRICE_SCALE).cast("decimal(3,2)")) \
        .cast("decimal(18,4)")


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nationkey, order date, order key, quote value) for every order."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return (orders.join(cust, orders["o_custkey"] == cust["c_custkey"])
            .select("c_nationkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                    "o_totalprice"))


def _customer_ranges(spark: SparkSession, sf_dir: str, period) -> DataFrame:
    """(nationkey, period_start, lo, hi, last_date) per customer and period.

    Orders are reduced per customer before they meet ``customer``: the
    map-side step collapses a hot customer in every task, and the join sees
    one row per customer and period instead of one per order.
    """
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    reduced = (orders.select("o_custkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice")
               .groupBy("o_custkey", period.alias("period_start"))
               .agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"),
                    F.max("order_date").alias("last_date")))
    return reduced.join(cust, reduced["o_custkey"] == cust["c_custkey"]).drop("o_custkey", "c_custkey")


def quote_items(spark: SparkSession, sf_dir: str, period: str = "quarter") -> DataFrame:
    """Quote items as a quote document would list them (text values).

    Columns ``period, pos, code, buyValue, sellValue, start, end``; one item
    per (nation, period) that has orders; ``pos`` is the nation key.
    """
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    per_period = (_customer_ranges(spark, sf_dir, F.trunc("order_date", period))
                  .groupBy("c_nationkey", "period_start")
                  .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("last_date").alias("last_date")))
    return (per_period.join(nation, per_period["c_nationkey"] == nation["n_nationkey"])
            .select(date_text("period_start").alias("period"),
                    F.col("n_nationkey").cast("int").alias("pos"),
                    F.col("n_name").alias("code"),
                    _price("lo").cast("string").alias("buyValue"),
                    _price("hi").cast("string").alias("sellValue"),
                    date_text("period_start").alias("start"),
                    date_text("last_date").alias("end")))


def quotes(spark: SparkSession, sf_dir: str, period: str = "quarter") -> DataFrame:
    """P1-P4 applied to the proxy items: quotes to the base currency."""
    return quote_mid(quote_items(spark, sf_dir, period))


def ref_rates(spark: SparkSession, sf_dir: str, run_date: _dt.date = RUN_DATE) -> DataFrame:
    """Reference factors for one date: ``nation x (nation + base)``.

    Each nation row emits its counterpart keys through a generator over the
    fixed key range (TPC-H nations are keys 0..24, the base is 25); names
    come back by an equi-join on the small nation table.
    """
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    names = nation.select(F.col("n_nationkey").alias("to_key"), F.col("n_name").alias("to_name"))
    pairs = (nation
             .select("n_nationkey", "n_name", "n_regionkey",
                     F.explode(F.sequence(F.lit(0), F.lit(BASE_KEY))).alias("to_key"))
             .join(names, "to_key", "left")
             .withColumn("to_curr", F.when(F.col("to_key") == BASE_KEY, F.lit(BASE_CURRENCY))
                         .otherwise(F.col("to_name")))
             .where(F.col("to_curr").isNotNull())
             .withColumn("k", F.col("n_nationkey") + F.col("to_key")))
    return (pairs.where(F.col("k") % ABSENT_MOD != 0)
            .select(F.lit(run_date).alias("rate_date"),
                    F.col("n_name").alias("from_curr"),
                    "to_curr",
                    F.pow(F.lit(10), F.col("n_regionkey") % FACTOR_MOD).cast("decimal(9,0)")
                    .alias("from_factor"),
                    F.when(F.col("k") % ZERO_MOD == 0, F.lit(0)).otherwise(F.lit(1))
                    .cast("decimal(18,5)").alias("kursf"),
                    F.lit(1).cast("decimal(9,0)").alias("to_factor")))


def nation_mids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-history mid value per nation: (min + max) / 2 of its quotes."""
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    per_nation = (_customer_ranges(spark, sf_dir, F.lit(None).cast("date"))
                  .groupBy("c_nationkey").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return (per_nation.join(nation, per_nation["c_nationkey"] == nation["n_nationkey"])
            .select(F.col("n_name").alias("name"),
                    ((_price("lo") + _price("hi")) * F.lit("0.5").cast("decimal(2,1)"))
                    .cast("decimal(18,10)").alias("mid")))


def rare_rate_texts(spark: SparkSession, sf_dir: str, targets: list[str] = TARGETS,
                    rare: list[str] = RARE_NATIONS) -> DataFrame:
    """(from_curr, to_curr, c_pos, t_pos, fx_rate text) for the rare grid.

    rate(a -> base) = mid(a); rate(a -> b) = mid(a) / mid(b), rounded half up
    to four decimals and shown as text, as a converter page shows it.  Two
    fixed pairs show a blank and a not-ready value.
    """
    from ratebook.operators.rates import rare_pair_grid
    from ratebook.sources.config import currency_list

    mids = nation_mids(spark, sf_dir)
    grid = rare_pair_grid(currency_list(spark, rare), targets)
    # Both ends of a pair are looked up in ONE join: each grid row asks for
    # two names, the answers are folded back per pair.  (Two joins against
    # the same derived table would derive it -- and scan the history -- twice.)
    key = ["from_curr", "to_curr", "c_pos", "t_pos"]
    asks = grid.select(*key, F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("from_curr").alias("name")),
        F.struct(F.lit(1).alias("side"), F.col("to_curr").alias("name")))).alias("_ask"))
    looked = asks.join(mids, F.col("_ask.name") == mids["name"], "left")
    joined = (looked.groupBy(*key)
              .agg(F.max(F.when(F.col("_ask.side") == 0, F.col("mid"))).alias("mid_a"),
                   F.max(F.when(F.col("_ask.side") == 1, F.col("mid"))).alias("mid_b"))
              .where(F.col("mid_a").isNotNull()))
    rate = F.when(F.col("to_curr") == F.lit(BASE_CURRENCY), F.col("mid_a")) \
        .otherwise(F.col("mid_a") / F.col("mid_b"))
    text = F.round(rate, 4).cast("decimal(18,4)").cast("string")
    for (fa, fb), shown in BLANK_PAGES.items():
        text = F.when((F.col("from_curr") == fa) & (F.col("to_curr") == fb), F.lit(shown)) \
            .otherwise(text)
    return joined.select("from_curr", "to_curr", "c_pos", "t_pos", text.alias("fx_rate"))


def converter_pages(spark: SparkSession, sf_dir: str, targets: list[str] = TARGETS,
                    rare: list[str] = RARE_NATIONS) -> DataFrame:
    """Captured converter pages (url, html) for the rare grid."""
    rates = rare_rate_texts(spark, sf_dir, targets, rare)
    url = F.concat(F.lit(CONVERTER_BASE + "?from="), F.col("from_curr"),
                   F.lit("&to="), F.col("to_curr"), F.lit("&amount=1"))
    # Pages to the base currency list the attributes in another order; the
    # rate is found by attributes, not by their position in the tag.
    head = F.lit('<html><body><form><input name="numberformat" tabindex="3" value="1">')
    usual = F.concat(F.lit('<input name="numberformat" tabindex="4" value="'), F.col("fx_rate"),
                     F.lit('">'))
    reordered = F.concat(F.lit('<input tabindex="4" value="'), F.col("fx_rate"),
                         F.lit('" class="rate" name="numberformat">'))
    html = F.concat(head,
                    F.when(F.col("to_curr") == F.lit(BASE_CURRENCY), reordered).otherwise(usual),
                    F.lit('</form></body></html>'))
    return rates.select(url.alias("url"), html.alias("html"))


def converter_captures(spark: SparkSession, sf_dir: str, targets: list[str] = TARGETS,
                       rare: list[str] = RARE_NATIONS) -> DataFrame:
    """A growing archive of captures (url, html, captured_on, capture_id): every order of a rare nation's
    customer is one, of the pair (nation, target at the order key's place in the list), with the price as its
    rate.  The driver's pages, undated, come with it; they are of other hosts."""
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name").where(F.col("n_name").isin(rare))
    orders = priced_orders(spark, sf_dir)
    o = orders.join(nation, orders["c_nationkey"] == nation["n_nationkey"])
    to = F.element_at(F.lit(targets), (F.col("o_orderkey") % len(targets) + 1).cast("int"))
    rate = (F.when(F.col("o_orderkey") % BLANK_EACH == 0, F.lit(""))
            .when(F.col("o_orderkey") % UNREADY_EACH == 0, F.lit("-"))
            .otherwise(_price().cast("string")))
    url = F.concat(F.lit(CONVERTER_BASE + "?from="), F.col("n_name"), F.lit("&to="), to, F.lit("&amount=1"))
    html = F.concat(F.lit('<html><body><form><input name="numberformat" tabindex="4" value="'), rate, F.lit('"></form></body></html>'))
    made = o.select(url.alias("url"), html.alias("html"), F.col("order_date").alias("captured_on"),
                    F.col("o_orderkey").cast("bigint").alias("capture_id"))
    real = table(spark, sf_dir, "pages", "url", "html", "page_id")
    return made.unionByName(real.select("url", "html", F.lit(None).cast("date").alias("captured_on"),
                                        F.col("page_id").alias("capture_id")))


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's captured pages plus the converter pages above."""
    real = table(spark, sf_dir, "pages", "url", "html")
    return real.unionByName(converter_pages(spark, sf_dir))


# ------------------------------------------------ keyed upsert, guards, records

def merge_rows(spark: SparkSession, sf_dir: str, period: str = "quarter") -> DataFrame:
    """Target: the keyed rows of even quarters.  Batch: each currency's rows
    of its last quoted year with a changed rate, plus its newest row once
    more (later ``seq``) for one currency -- a half-overlapping batch with
    one repeated key.  Both come from one windowed frame per currency (a
    currency has one row per period), so the history is read once."""
    bpm = bpm_layout(quotes(spark, sf_dir, period)).withColumn("Rate", F.col("Rate").cast("decimal(18,5)"))
    d = F.to_date("RateDate")
    w = Window.partitionBy("Currency")
    x = (bpm.withColumn("_maxy", F.max(F.year(d)).over(w))
         .withColumn("_maxd", F.max("RateDate").over(w)))

    def role(cond, name, rate, seq):
        return F.when(cond, F.struct(F.lit(name).alias("role"), rate.cast("decimal(18,5)").alias("Rate"),
                                     F.lit(seq).cast("bigint").alias("seq")))

    bump = F.col("Rate") + F.lit(MERGE_BUMP).cast("decimal(6,5)")
    bump2 = F.col("Rate") + F.lit(MERGE_REPEAT_BUMP).cast("decimal(6,5)")
    # Every row states its roles through one generator; the role filters
    # sit above the generator, so both inputs share one derivation.
    g = (x.select("Currency", "Currency2", "RateDate", F.explode(F.array(
            role(F.quarter(d) % 2 == 0, "target", F.col("Rate"), 0),
            role(F.year(d) == F.col("_maxy"), "batch", bump, 0),
            role((F.col("Currency") == MERGE_REPEAT_CURRENCY) & (F.col("RateDate") == F.col("_maxd")),
                 "batch", bump2, 1))).alias("_r"))
         .where(F.col("_r").isNotNull())
         .select("Currency", "Currency2", "RateDate", "_r.*"))
    return g.withColumn("is_batch", F.col("role") == "batch")


def merge_inputs(spark: SparkSession, sf_dir: str, period: str = "quarter"):
    """The same rows split into (target, batch) frames."""
    g = merge_rows(spark, sf_dir, period)
    target = g.where(~F.col("is_batch")).select("Currency", "Currency2", "Rate", "RateDate")
    batch = g.where(F.col("is_batch")).select("Currency", "Currency2", "Rate", "RateDate", "seq")
    return target, batch


def rate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate texts as a file might carry them: orders with status P show a
    decimal comma (invalid), the rest a plain decimal."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    txt = o["o_totalprice"].cast("decimal(18,2)").cast("string")
    shown = F.when(F.col("o_orderstatus") == "P", F.regexp_replace(txt, r"\.", ",")).otherwise(txt)
    return o.select("o_orderkey", shown.alias("Rate"))


def calls_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote-call log rows from ``events``: connection = user, a signup is a
    counter reset, measures derived from ``value`` and ``props``."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    total = (F.col("value").cast("decimal(18,2)") * F.lit(100)).cast("bigint")
    return e.select(F.col("user_id").alias("connection"), "ts", F.col("event_id").alias("call_id"),
                    (F.col("event_type") == "signup").alias("is_reset"),
                    total.alias("total_ms"), (total % 7).alias("ser_ms"), (total % 5).alias("deser_ms"),
                    (total - total % 7 - total % 5).alias("app_ms"),
                    F.length("props").cast("bigint").alias("sent_bytes"),
                    F.floor(F.col("value").cast("decimal(18,2)") * F.lit(10)).cast("bigint").alias("recv_bytes"))


def deep_table_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested-table records from whole ``documents`` texts: one nested line
    per text line (I = line number, C = source as CHAR10, STR = the line,
    XSTR = its bytes in hex)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    c10 = F.rpad(F.coalesce(F.col("source"), F.lit("")), 10, " ")
    tab = F.transform(F.split("text", "\n", -1),
                      lambda line, i: F.struct((i + 1).cast("int").alias("I"), c10.alias("C"),
                                               line.alias("STR"), F.hex(line).alias("XSTR")))
    return docs.select(F.col("doc_id").alias("id"), tab.alias("tab"))
