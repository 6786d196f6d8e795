"""Date and time column functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the two receiving systems.
ERP_DATE = "yyyyMMdd"
ISO_DATE = "yyyy-MM-dd"
STAMP = "yyyyMMdd_HHmm"
LOCAL_TIME = "yyyy-MM-dd HH:mm:ss"
LOCAL_ZONE = "Asia/Taipei"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_yyyymmdd(text) -> Column:
    """yyyyMMdd text -> DATE; NULL or malformed text raises."""
    t = _c(text)
    d = F.try_to_date(t, ERP_DATE)
    return F.when(d.isNull(), F.raise_error(
        F.concat(F.lit("invalid yyyyMMdd date: '"), F.coalesce(t, F.lit("NULL")), F.lit("'")))
    ).otherwise(d)


def yyyymmdd(text) -> Column:
    """yyyyMMdd -> date -> yyyyMMdd: a checked pass-through."""
    return F.date_format(parse_yyyymmdd(text), ERP_DATE)


def month_end(text) -> Column:
    """Last day of the month of a yyyyMMdd text, as yyyyMMdd."""
    return F.date_format(F.last_day(parse_yyyymmdd(text)), ERP_DATE)


def iso_date(text) -> Column:
    """yyyyMMdd -> yyyy-MM-dd."""
    return F.date_format(parse_yyyymmdd(text), ISO_DATE)


def date_text(ts) -> Column:
    """A date or timestamp column as yyyyMMdd text."""
    return F.date_format(F.to_date(_c(ts)), ERP_DATE)


def local_time(utc_ts, zone: str = LOCAL_ZONE) -> Column:
    """A zone-less UTC timestamp as wall-clock time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(utc_ts).cast("timestamp_ntz"))


def local_stamp(utc_ts, zone: str = LOCAL_ZONE) -> Column:
    """``yyyyMMdd_HHmm`` of the local time (used in export file names)."""
    return F.date_format(local_time(utc_ts, zone), STAMP)


def run_date_text(run_date: _dt.date | str) -> Column:
    """The run date as yyyyMMdd (N8): always a parameter, never today."""
    if isinstance(run_date, str):
        run_date = _dt.datetime.strptime(run_date, "%Y%m%d").date()
    return F.lit(run_date.strftime("%Y%m%d"))


def as_date(run_date: _dt.date | str) -> _dt.date:
    if isinstance(run_date, _dt.date):
        return run_date
    return _dt.datetime.strptime(run_date, "%Y%m%d").date()
