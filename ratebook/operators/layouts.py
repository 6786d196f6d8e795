"""Output layouts for the two receiving systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.functions.dates import iso_date, month_end, yyyymmdd
from ratebook.functions.numbers import fmt5
from ratebook.schemas import BPM_COLUMNS, ERP_COLUMNS
from ratebook.sources.config import BASE_CURRENCY

# Fixed values demanded by the ERP rate table: every column must be present,
# factors as text "1", the V-rate as "1.00000".
RATE_TYPES = ("M", "V")
FROM_FACTOR = "1"
TO_FACTOR = "1"
EXCH_RATE_V = "1.00000"
FROM_FACTOR_V = "1"
TO_FACTOR_V = "1"


def check_rate_type(rate_type: str) -> str:
    """Only M (valid from period start) and V (month end) exist."""
    if rate_type not in RATE_TYPES:
        raise ValueError(f"rate type must be M or V, got {rate_type!r}")
    return rate_type


def valid_from(rate_type: str):
    """Chosen when the plan is built, not per row.

    M -> the period's ``start``; V -> last day of the month of ``end``.
    Both pass through a date parse, so a malformed date raises (N5).  The
    month end of ``end`` is computed for every row in the source, whatever
    the rate type, so under M a malformed ``end`` stops the run as well: the
    check is part of the value, where Catalyst cannot prune it.
    """
    check_rate_type(rate_type)
    if rate_type == "V":
        return month_end("end")
    return F.when(F.isnotnull(month_end("end")), yyyymmdd("start"))


def erp_layout(scaled_rates: DataFrame, rate_type: str) -> DataFrame:
    """P5 + P7 + N3: the ten text columns of the ERP rate table."""
    return scaled_rates.select(
        F.col("from_curr").cast("string").alias("FROM_CURR"),
        F.col("to_curr").cast("string").alias("TO_CURRNCY"),
        F.col("fx_rate_with_ratio").cast("string").alias("EXCH_RATE"),
        valid_from(rate_type).alias("VALID_FROM"),
        F.lit(rate_type).alias("RATE_TYPE"),
        F.lit(FROM_FACTOR).alias("FROM_FACTOR"),
        F.lit(TO_FACTOR).alias("TO_FACTOR"),
        F.lit(EXCH_RATE_V).alias("EXCH_RATE_V"),
        F.lit(FROM_FACTOR_V).alias("FROM_FACTOR_V"),
        F.lit(TO_FACTOR_V).alias("TO_FACTOR_V"),
    ).select(*ERP_COLUMNS)


def base_quotes(rates: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """only rows quoted to the base currency."""
    return rates.where(F.col("to_curr") == F.lit(base))


def bpm_layout(rates: DataFrame, base: str = BASE_CURRENCY, seq: str | None = None) -> DataFrame:
    """F5 + N3 + N6: ``Currency, Currency2, Rate ('%.5f'), RateDate (yyyy-MM-dd)``.

    Built from the raw quotes, not from cross rows, and without factors.
    With ``seq`` (e.g. ``pos``), the row order is kept as a ``seq`` column for
    the upsert, where the last of duplicate keys wins.
    """
    extra = [F.col(seq).alias("seq")] if seq else []
    return (base_quotes(rates, base)
            .select(F.col("from_curr").cast("string").alias("Currency"),
                    F.col("to_curr").cast("string").alias("Currency2"),
                    fmt5("fx_rate").alias("Rate"),
                    iso_date("start").alias("RateDate"), *extra)
            .select(*BPM_COLUMNS, *(["seq"] if seq else [])))
