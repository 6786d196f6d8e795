"""Hand-written fixtures (FIXTURES §2): the golden quote document and its
reference factors, plus small builders used by several tests."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

from ratebook.schemas import REF_RATES

GOLDEN_DOC = {
    "start": "20250201", "end": "20250210",
    "items": [
        {"code": "USD", "buyValue": "32.50", "sellValue": "32.90"},
        {"code": "JPY", "buyValue": "0.2150", "sellValue": "0.2190"},
        {"code": "EUR", "buyValue": "35.10", "sellValue": "35.70"},
    ],
}
GOLDEN_TARGETS = ["TWD", "USD", "EUR"]
RUN = dt.date(2025, 2, 21)

# (from, to, from_factor, kursf); USD->EUR absent on purpose.
GOLDEN_REF = [
    ("USD", "TWD", 1, "1"), ("JPY", "TWD", 100, "1"), ("EUR", "TWD", 1, "0"),
    ("JPY", "USD", 100, "1"), ("EUR", "USD", 1, "1"), ("JPY", "EUR", 100, "1"),
    ("HUF", "TWD", 1, "1"), ("HUF", "USD", 1, "1"), ("HUF", "HUF", 1, "1"),
]

GOLDEN_ERP_M = {
    ("USD", "TWD", "32.70000"), ("JPY", "TWD", "21.70000"), ("JPY", "USD", "0.66972"),
    ("EUR", "USD", "1.09174"), ("JPY", "EUR", "0.61864"),
}


def write_doc(folder: str, name: str, doc: dict, mtime: float | None = None) -> str:
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        json.dump(doc, f, indent=1)
    if mtime is not None:
        os.utime(p, (mtime, mtime))
    return p


def ref_frame(spark, rows=GOLDEN_REF, run=RUN):
    data = [(run, a, b, Decimal(f), Decimal(k), Decimal(1)) for a, b, f, k in rows]
    return spark.createDataFrame(data, REF_RATES)


def items_frame(spark, items, start="20250201", end="20250210"):
    """Quote items as S1 produces them, from (code, buy, sell) tuples."""
    rows = [(start, i, c, b, s, start, end) for i, (c, b, s) in enumerate(items)]
    return spark.createDataFrame(
        rows, "period string, pos int, code string, buyValue string, sellValue string, "
              "start string, `end` string")
