"""Column functions N1-N12 on edge values."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Context, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ratebook.functions import dates, numbers, text


def _one(spark, col, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("y")).first()[0]


@pytest.mark.parametrize("x, want", [("0.000005", "0.00001"), ("0.0000049", "0.00000"),
                                     ("123456789.123456", "123456789.12346"), ("1", "1.00000")])
def test_fmt5(spark, x, want):
    assert _one(spark, numbers.fmt5(F.col("x").cast("decimal(38,10)")), x) == want


def test_dates(spark):
    assert _one(spark, dates.iso_date("x"), "20240229") == "2024-02-29"
    assert _one(spark, dates.yyyymmdd("x"), "20251231") == "20251231"
    assert _one(spark, dates.month_end("x"), "20250415") == "20250430"
    with pytest.raises(Exception, match="invalid yyyyMMdd date"):
        _one(spark, dates.month_end("x"), "2025-04-15")


def test_export_name_crosses_midnight(spark):
    ts = dt.datetime(2024, 12, 31, 23, 30)
    got = _one(spark, text.export_name("rare_v", F.col("x")), ts, "x timestamp_ntz")
    assert got == "FinalData__rare_v__20250101_0730"


def test_json_list_keeps_order_and_duplicates(spark):
    got = _one(spark, text.json_list(F.col("x")), '["TWD","USD","USD","EUR"]')
    assert got == ["TWD", "USD", "USD", "EUR"]


def test_cross_rate_and_scale(spark):
    df = spark.createDataFrame([("35.70", "32.70", "100")], "s string, m string, f string")
    r = df.select(numbers.cross_rate(F.col("s").cast("decimal(18,10)"), F.col("m")).alias("c")).first()
    assert str(r.c) == "1.09174311926605504587"
    scaled = df.select(numbers.scale5(numbers.cross_rate("s", "m"), F.col("f").cast("decimal(9,0)")).alias("v")).first()
    assert str(scaled.v) == "109.17431"


def _half_up(x: Fraction, places: int) -> Decimal:
    n = abs(x) * 10 ** places * 2
    q = (n.numerator // n.denominator + 1) // 2
    return Decimal(q if x >= 0 else -q).scaleb(-places, Context(prec=60))


def test_rates_are_rounded_once(spark):
    """Against fractions: random pairs, exact ties, and quotients next to a tie."""
    r = random.Random(7)
    rows = []
    for _ in range(400):
        digits = r.choice([2, 6, 12])
        num = Decimal(r.randrange(10 ** (r.choice([3, 12]) if digits < 12 else 18))).scaleb(-digits)
        den = Decimal(r.randrange(1, 10 ** r.choice([2, 6, 14]))).scaleb(-r.choice([0, 4, 12]))
        rows.append((num, den, r.choice([1, 10, 100, 1000, 999_999_999])))
    one = Decimal("0.000000000001")
    for k in range(60):
        tie = Decimal(2 * k + 1).scaleb(-6) * 5           # x.xxxxx5
        rows += [(tie, Decimal(1), 1), (tie - one, Decimal(1), 1), (tie + one, Decimal(1), 1)]
        den = Decimal(r.randrange(1, 10 ** 9)) + one
        rows += [(tie * 10 ** 4, Decimal(10 ** 4) + one, 1), (tie * 10 ** 4, Decimal(10 ** 4) - one, 1), (den, den * 3, 100)]
    rows += [(Decimal("1.00000499999999999") * 10 ** 3, Decimal(10 ** 3), 1), (Decimal(-5), Decimal(3), 1), (Decimal(0), Decimal(7), 100)]
    rows = [(n.quantize(one), d.quantize(one), f) for n, d, f in rows if d and n / d * f < 10 ** 12]
    df = spark.createDataFrame(rows, "n decimal(26,12), d decimal(26,12), f int")
    got = df.select("n", "d", "f", numbers.ratio5("n", "d", F.col("f").cast("decimal(9,0)")).alias("v"), numbers.cross_rate("n", "d").alias("c"),
                    numbers.scale5(numbers.cross_rate("n", "d"), F.col("f").cast("decimal(9,0)")).alias("s")).collect()
    assert len(got) > 500
    for x in got:
        exact = Fraction(x.n) / Fraction(x.d)
        assert x.v == _half_up(exact * x.f, 5), x
        assert x.c == _half_up(exact, 20), x
        assert x.s == _half_up(Fraction(x.c) * x.f, 5), x


@pytest.mark.parametrize(("text", "ok"), [
    ("1.123456789012", True), ("1.1234567890123", False), ("1.12345678901200000", True), ("123456789012.5", True), ("1234567890123", False),
    ("0000000000000000.5", True), ("-2.5", True), ("1E-12", True), ("1E-13", False), ("5E3", True), (".5", True), ("5.", True)])
def test_no_digit_is_rounded_away(spark, text, ok):
    if ok:
        assert _one(spark, numbers.parse_rate("x"), text) == Decimal(text)
    else:
        with pytest.raises(Exception, match="too many digits in rate"):
            _one(spark, numbers.parse_rate("x"), text)
