"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratebook.functions.dates import local_stamp

# Fixed value: prefix and separator of exported rate files.
EXPORT_PREFIX = "FinalData"
EXPORT_SEP = "__"


def export_name(job, utc_ts) -> Column:
    """``FinalData__{job}__{yyyyMMdd_HHmm local}``."""
    j = F.lit(job) if isinstance(job, str) else job
    return F.concat_ws(EXPORT_SEP, F.lit(EXPORT_PREFIX), j, local_stamp(utc_ts))


def json_list(text) -> Column:
    """JSON list of strings -> ARRAY<STRING>."""
    t = F.lit(text) if isinstance(text, str) else text
    return F.from_json(t, "array<string>")
