"""Column-level functions; every one is a built-in Spark expression."""

from ratebook.functions.dates import (as_date, date_text, iso_date, local_stamp, local_time,
                                      month_end, parse_yyyymmdd, run_date_text, yyyymmdd)
from ratebook.functions.numbers import (cross_rate, fmt5, mid_rate, parse_rate, ratio5, round5,
                                        scale5)
from ratebook.functions.text import export_name, json_list

__all__ = [
    "as_date", "date_text", "iso_date", "local_stamp", "local_time", "month_end",
    "parse_yyyymmdd", "run_date_text", "yyyymmdd", "cross_rate", "fmt5", "mid_rate",
    "parse_rate", "ratio5", "round5", "scale5", "export_name", "json_list",
]
