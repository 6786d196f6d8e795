"""S3: rates read off captured currency-converter pages.

A page is one (from, to) pair: the pair is in the URL query string
(``?from=..&to=..&amount=1``) and the rate is the ``value`` of the input
``name="numberformat" tabindex="4"``.  An empty value means there is no rate;
the row is skipped (F1).  ``-`` means the page had not finished loading, and a
converter page without that input is a failed capture: both stop the run (a
caller may allow not-ready pages, which are then skipped and reported).  Pages
of another host, or without ``from``/``to`` in the URL, are ignored.

A growing archive of captures is read late: ``newest_captures`` picks the
newest capture of every pair and period from the narrow columns, and
``capture_rates`` then reads the HTML of just those.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.functions.dates import date_text, run_date_text

# Where the rate sits on a converter page -- the value of the
# input with name="numberformat" and tabindex="4" (attributes in any order).
INPUT_TAG = r"<input\b[^>]*>"
RATE_ATTRS = [r"""\sname\s*=\s*(?:"numberformat"|'numberformat'|numberformat(?=[\s/>]))""",
              r"""\stabindex\s*=\s*(?:"4"|'4'|4(?=[\s/>]))"""]
VALUE_ATTR = r"""\svalue\s*=\s*(?:"([^"]*)"|'([^']*)')"""
NOT_READY = "-"
CONVERTER_HOST = "converter.example.com"      # the captured converter's host; a parameter


def page_rate(html) -> "F.Column":
    """The rate text of a converter page, or NULL when the input is absent.

    Built-ins only: every ``<input>`` tag is extracted, the tags carrying
    both selector attributes are kept (``filter`` with a lambda), and the
    first one's ``value`` is read -- the same element a CSS selector picks.
    """
    tags = F.regexp_extract_all(F.col(html) if isinstance(html, str) else html,
                                F.lit(INPUT_TAG), F.lit(0))
    chosen = F.filter(tags, lambda t: t.rlike(RATE_ATTRS[0]) & t.rlike(RATE_ATTRS[1]))
    tag = F.try_element_at(chosen, F.lit(1))
    return F.concat(F.regexp_extract(tag, VALUE_ATTR, 1), F.regexp_extract(tag, VALUE_ATTR, 2))


def _query_param(url, key: str):
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(key))


def converter_rates(pages: DataFrame, host: str = CONVERTER_HOST) -> DataFrame:
    """(url, html) -> ``from_curr, to_curr, rate`` for every converter page.

    ``rate`` is the raw text of the rate input (NULL when the page has none).
    The URL test runs first, so the page's HTML is only parsed for converter
    pages; other pages drop out here.
    """
    url = F.col("url")
    conv = (pages
            .select(_query_param(url, "from").alias("from_curr"),
                    _query_param(url, "to").alias("to_curr"), "html",
                    F.lower(F.try_parse_url(url, F.lit("HOST"))).alias("host"))
            .where((F.col("host") == host) & F.col("from_curr").isNotNull() & F.col("to_curr").isNotNull()))
    return conv.select("from_curr", "to_curr", page_rate("html").alias("rate"))


CAPTURE = ["captured_on", "capture_id"]       # a capture's day (the archive's partition column) and number


def _converter_captures(captures: DataFrame, host: str) -> DataFrame:
    url = F.col("url")
    return (captures
            .withColumns({"from_curr": _query_param(url, "from"), "to_curr": _query_param(url, "to"),
                          "host": F.lower(F.try_parse_url(url, F.lit("HOST")))})
            .where((F.col("host") == host) & F.col("from_curr").isNotNull() & F.col("to_curr").isNotNull()))


def newest_captures(captures: DataFrame, period: str = "quarter", host: str = CONVERTER_HOST) -> DataFrame:
    """Of every period (``quarter``, ``month``, ...) and pair, the newest capture: ``period_start, from_curr,
    to_curr, captured_on, capture_id``.

    Later days win, then larger numbers; captures without a day or number are
    left out.  The HTML is not read, and a pair that is captured very often
    is pre-reduced in every task.
    """
    from ratebook.operators.merge import last_rank
    from ratebook.sources.quote_files import newest_per_key

    narrow = _converter_captures(captures.select("url", *CAPTURE), host).where("captured_on IS NOT NULL AND capture_id IS NOT NULL")
    ranked = narrow.select(F.trunc("captured_on", period).alias("period_start"), "from_curr", "to_curr", *CAPTURE,
                           last_rank(F.unix_date("captured_on"), "capture_id", narrow).alias("_rank"))
    return newest_per_key(ranked, ["period_start", "from_curr", "to_curr"], ["_rank"], CAPTURE)


def capture_rates(captures: DataFrame, period: str = "quarter", host: str = CONVERTER_HOST) -> DataFrame:
    """Converter rates of the newest captures: ``from_curr, to_curr, rate, start, end``.

    ``captures``: ``url, html, captured_on (date), capture_id (bigint)``; best
    stored partitioned by ``captured_on``.  ``start`` is the period's first
    day, ``end`` the capture's, as yyyyMMdd.  The newest capture decides even
    where it shows no rate (F1 then drops the pair, or the run stops, as for
    a single page).  A capture delivered twice counts once; of copies that
    differ the smaller rate text is taken.

    The choice (one narrow row per period and pair) is staged, which runs the
    first pass.  Its days, at most one per calendar day, become a constant
    predicate on ``captured_on``: it prunes the partitions, or by its bounds
    the row groups, that hold no chosen capture before any HTML is read.
    """
    from ratebook.sources.sinks import stage

    chosen = stage(newest_captures(captures, period, host), "newest-captures")
    days = [r[0] for r in chosen.select("captured_on").distinct().sort("captured_on").collect()]
    late = _converter_captures(captures.where(F.col("captured_on").isin(days)), host)
    pages = late.select("from_curr", "to_curr", *CAPTURE, "html").join(chosen, [*CAPTURE, "from_curr", "to_curr"])
    read = pages.select("period_start", "from_curr", "to_curr", "captured_on", page_rate("html").alias("rate"))
    return (read.groupBy("period_start", "from_curr", "to_curr", "captured_on").agg(F.min("rate").alias("rate"))
            .select("from_curr", "to_curr", "rate", date_text("period_start").alias("start"),
                    date_text("captured_on").alias("end")))


def quotes_from_rates(conv: DataFrame, run_date: _dt.date | str, allow_not_ready: bool = False) -> DataFrame:
    """Converter rates -> rare quotes ``from_curr, to_curr, fx_rate, start, end`` (F1).

    Rates that carry their own ``start`` and ``end`` keep them; the others
    get the run date for both.
    Blank values are dropped, and not-ready ones if that is allowed (else they
    raise).  Filtering happens on the raw
    rate first, and only then the raising check is applied: a projection is
    evaluated only on rows that passed every filter, whereas an expression
    inside a filter may be evaluated early (Catalyst merges filters and
    hoists their common subexpressions), even for rows a caller's own filter
    would drop.
    """
    d = run_date_text(run_date)                                   # N8: a parameter
    start, end = (F.col("start"), F.col("end")) if "start" in conv.columns else (d, d)
    dropped = ["", NOT_READY] if allow_not_ready else [""]
    kept = conv.where(F.col("rate").isNull() | ~F.col("rate").isin(dropped))
    # A converter page without the rate input is a failed capture: the
    # source's wait for the element times out and the run stops.
    pair = F.concat(F.col("from_curr"), F.lit("->"), F.col("to_curr"))
    missing = F.raise_error(F.concat(F.lit("no rate input on converter page "), pair))
    unready = F.raise_error(F.concat(F.lit("converter page was not ready: "), pair))
    return kept.select("from_curr", "to_curr",
                       F.when(F.col("rate").isNull(), missing).when(F.col("rate") == NOT_READY, unready)
                       .otherwise(F.col("rate")).alias("fx_rate"),
                       start.alias("start"), end.alias("end"))


def extract_page_quotes(pages: DataFrame, run_date: _dt.date | str, host: str = CONVERTER_HOST,
                        allow_not_ready: bool = False) -> DataFrame:
    """S3: (url, html) -> rare quotes ``from_curr, to_curr, fx_rate (text), start, end``;
    ``start`` and ``end`` are the run date (a parameter, so a rerun repeats)."""
    return quotes_from_rates(converter_rates(pages, host), run_date, allow_not_ready)


def skipped_rates(conv: DataFrame) -> DataFrame:
    """Converter rates that F1 drops (blank or not ready) or that have no
    rate input at all, for the run log."""
    return (conv.where(F.col("rate").isNull() | F.col("rate").isin("", NOT_READY))
            .select("from_curr", "to_curr", F.col("rate").alias("fx_rate")))


def skipped_pages(pages: DataFrame, host: str = CONVERTER_HOST) -> DataFrame:
    """``skipped_rates`` straight from (url, html) pages."""
    return skipped_rates(converter_rates(pages, host))
