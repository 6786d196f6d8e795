"""Numeric column functions.

All built-in expressions, so they stay inside whole-stage codegen.  Rounding
contract: exact decimal arithmetic, rounded once, HALF_UP at the fifth decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratebook.schemas import OUT_RATE, RATE, RATIO, WIDE_RATE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# a plain number, and its integer digits and decimals without filling zeros
_NUMBER = r"^[+-]?(?=[.]?[0-9])0*([0-9]*)(?:[.]([0-9]*?)0*)?$"


def parse_rate(text, what: str = "rate") -> Column:
    """Text -> DECIMAL(24,12); NULL stays NULL, malformed text raises.

    Nothing is rounded: more than twelve decimals or twelve integer digits
    (zeros that only fill up do not count) raise as well.  The raise does not
    depend on the session's ANSI setting: a non-null text that does not parse
    fails the task with the offending value in the message (``1,234.5`` and
    the empty string both fail).
    """
    t = _c(text)
    v = t.try_cast(RATE)
    bare = F.trim(t)
    plain = bare.rlike(_NUMBER)
    fits = (F.length(F.regexp_extract(bare, _NUMBER, 1)) <= 12) & (F.length(F.regexp_extract(bare, _NUMBER, 2)) <= 12)

    def bad(why: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{why} {what}: '"), t, F.lit("'")))

    # a text in exponent form has no digits to count here: it must come back from its decimal unchanged
    exact = F.when(plain, fits).otherwise(F.coalesce(t.try_cast("decimal(38,20)") == v, F.lit(False)))
    return F.when(t.isNotNull() & v.isNull() & ~F.coalesce(plain & ~fits, F.lit(False)), bad("invalid")) \
        .when(t.isNotNull() & ~exact, bad("too many digits in")).otherwise(v)


def mid_rate(buy, sell) -> Column:
    """(buy + sell) / 2, back to DECIMAL(24,12) (a thirteenth decimal is rounded half up;
    ``buy + sell`` itself is the exact form, see ``ratio5``)."""
    return ((_c(buy) + _c(sell)) / F.lit(2)).cast(RATE)


INTEGER = "decimal(38,0)"


def _ten_to(n: int) -> Column:
    return F.lit("1" + "0" * n).cast(f"decimal({n + 1},0)")


def _integer(x: Column, decimals: int) -> Column:
    """x * 10^decimals, for an x of so many decimals."""
    return (x * _ten_to(decimals)).cast(INTEGER)


def _divide(n: Column, d: Column) -> tuple[Column, Column]:
    """Integer quotient and remainder of non-negative DECIMAL(38,0) values."""
    rest = (n % d).cast(INTEGER)
    return ((n.cast(INTEGER) - rest).cast(INTEGER) / d).cast(INTEGER), rest


def _digits(rest: Column, d: Column, count: int, half_up: bool) -> tuple[Column, Column]:
    """The next ``count`` decimals of rest / d as an integer, the last one rounded if asked for."""
    more = (rest * _ten_to(count)).cast(INTEGER)
    if half_up:
        more = (more + more + d).cast(INTEGER)
        d = (d + d).cast(INTEGER)
    return _divide(more, d)


def _signed(num: Column, den: Column, value: Column) -> Column:
    return F.when((num < 0) != (den < 0), -value).otherwise(value)


def _checked(den: Column, target: Column | None) -> Column:
    msg = F.lit("division by zero in cross rate")
    if target is not None:
        msg = F.concat(msg, F.lit(" to "), target)
    return F.when(den == 0, F.raise_error(msg)).otherwise(den)


def cross_rate(numerator, divisor, target: Column | None = None) -> Column:
    """numerator / divisor as DECIMAL(38,20), rounded half up at the twentieth
    decimal; a zero divisor raises, naming the target currency when given."""
    n, d = _c(numerator).cast(RATIO), _checked(_c(divisor).cast(RATIO), target)
    den = _integer(F.abs(d), 12)
    whole, rest = _divide(_integer(F.abs(n), 12), den)
    first, rest = _digits(rest, den, 10, half_up=False)
    last, _ = _digits(rest, den, 10, half_up=True)
    # 17 integer digits and 20 decimals are added without losing one
    decimals = (first.cast("decimal(10,0)") * F.lit("0.0000000001").cast("decimal(10,10)")
                + last.cast("decimal(11,0)") * F.lit("0.00000000000000000001").cast("decimal(20,20)"))
    return _signed(n, d, (whole.cast("decimal(17,0)") + decimals).cast(WIDE_RATE)).cast(WIDE_RATE)


def _rounded(whole: Column, rest: Column, den: Column, factor: Column) -> Column:
    """(whole + rest / den) * factor, rounded half up once, as DECIMAL(18,5)."""
    more, rest = _divide((rest * factor.cast("decimal(9,0)")).cast(INTEGER), den)
    part, _ = _digits(rest, den, 5, half_up=True)
    out = (whole * factor.cast("decimal(9,0)")).cast(INTEGER) + more
    return (out.cast("decimal(13,0)").cast(OUT_RATE) + (part.cast("decimal(6,0)") * F.lit("0.00001").cast("decimal(5,5)"))).cast(OUT_RATE)


def ratio5(num, den, factor=None) -> Column:
    """num / den * factor (``RATIO`` columns and a whole factor), rounded half up to five decimals: the
    quotient is never rounded on the way."""
    n, d = _c(num).cast(RATIO), _checked(_c(den).cast(RATIO), None)
    divisor = _integer(F.abs(d), 12)
    whole, rest = _divide(_integer(F.abs(n), 12), divisor)
    f = F.lit(1) if factor is None else _c(factor)
    return _signed(n, d, _rounded(whole, rest, divisor, f))


def scale5(rate, factor) -> Column:
    """P8 + N2 for a rate that is a DECIMAL(38,20) itself: rate * factor, rounded half up once."""
    r = _c(rate).cast(WIDE_RATE)
    size = F.abs(r)
    whole = F.floor(size).cast(INTEGER)
    rest = _integer((size % F.lit(1).cast("decimal(1,0)")).cast("decimal(20,20)"), 20)
    one = _ten_to(20).cast(INTEGER)
    return _signed(r, F.lit(1), _rounded(whole, rest, one, _c(factor)))


def round5(x) -> Column:
    """Round half up to five decimals, as DECIMAL(18,5)."""
    return F.round(_c(x), 5).cast(OUT_RATE)


def fmt5(x) -> Column:
    """Text with exactly five decimals (``'%.5f'``), trailing zeros kept."""
    return round5(x).cast("string")
