"""Record operators (D1-D4): selection ranges, call metrics, typed fields,
nested tables.  Table-level jobs for what the remote-call samples do one
record at a time."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebook.functions.dates import parse_yyyymmdd
from ratebook.session import staged_ranges

# ---------------------------------------------------------------- D1


def selection_filter(col: str, ranges, kind: str = "date") -> Column:
    """Selection rows ``(SIGN, OPTION, LOW, HIGH)`` -> one filter expression.

    Only SIGN='I' with OPTION='BT' (between, inclusive) is supported, the one
    form the sample uses; LOW/HIGH are yyyyMMdd texts.  ``kind`` is the
    column's type: ``date``, or ``timestamp_ntz`` for a date kept as a
    timestamp (compared as ``>= LOW`` and ``< HIGH + 1 day``).  Several rows
    are OR-ed.  The bounds are constants compared with the bare column, so
    Catalyst pushes the ranges into the Parquet scan.
    """
    conds = []
    for sign, option, low, high in ranges:
        if (sign, option) != ("I", "BT"):
            raise ValueError(f"unsupported selection {sign}/{option}; only I/BT")
        for bound in (low, high):
            if len(bound) != 8 or not bound.isascii() or not bound.isdigit():
                raise ValueError(f"selection bound {bound!r} is not yyyyMMdd")
        lo = _dt.datetime.strptime(low, "%Y%m%d")
        hi = _dt.datetime.strptime(high, "%Y%m%d")
        c = F.col(col)
        if kind == "date":
            conds.append(c.between(F.lit(lo.date()), F.lit(hi.date())))
        elif kind == "timestamp_ntz":
            nxt = hi + _dt.timedelta(days=1)
            conds.append((c >= F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz"))
                         & (c < F.lit(nxt.isoformat(sep=" ")).cast("timestamp_ntz")))
        else:
            raise ValueError(f"unknown column kind {kind}")
    if not conds:
        raise ValueError("at least one selection range is required")
    return reduce(lambda a, b: a | b, conds)


def range_select(df: DataFrame, date_col: str, ranges, equals: dict | None = None,
                 max_rows: int | None = None, order_by: list[str] | None = None,
                 kind: str = "date") -> DataFrame:
    """Rows whose ``date_col`` is in any selection range.

    ``equals`` maps column -> value, where ``'*'`` means any value.  A
    ``max_rows`` cap (the remote list call's MAX_ROWS) keeps the first rows
    by ``order_by``; Spark plans it as a top-k (each task keeps its best
    ``max_rows``, one small merge), never a global sort.
    """
    out = df.where(selection_filter(date_col, ranges, kind))
    for c, v in (equals or {}).items():
        if v != "*":
            out = out.where(F.col(c) == F.lit(v))
    if max_rows is not None:
        if not order_by:
            raise ValueError("a row cap needs an order for a stable result")
        out = out.orderBy(*order_by).limit(max_rows)
    return out


# Days a bin of a selection table covers: one bit each of a bigint.
BIN_DAYS = 64


def selection_bins(selection: DataFrame, by: list[str] = ()) -> DataFrame:
    """Selection rows as a table (``by`` columns, SIGN, OPTION, LOW, HIGH) -> the selected days.

    One row per (``by``, bin of 64 days) with a bit for every selected day.
    Each range is cut at the bin edges and the pieces are united by
    ``bit_or``, a partial aggregate: overlapping, repeated and nested ranges
    cost nothing further on.  Without ``by`` there is one row per bin of the
    calendar at most, however many ranges are given.  A range whose LOW lies
    after its HIGH selects nothing.  Anything but I/BT and a bound that is no
    yyyyMMdd date (NULL too) raises.
    """
    by = list(by)
    form = F.concat(F.coalesce("SIGN", F.lit("NULL")), F.lit("/"), F.coalesce("OPTION", F.lit("NULL")))
    only = F.raise_error(F.concat(F.lit("unsupported selection "), form, F.lit("; only I/BT")))
    low = F.when(form != "I/BT", only.cast("date")).otherwise(parse_yyyymmdd("LOW"))
    days = selection.select(*by, F.unix_date(low).alias("_lo"), F.unix_date(parse_yyyymmdd("HIGH")).alias("_hi"))
    # of ranges that begin on one day the longest holds the others
    days = days.groupBy(*by, "_lo").agg(F.max("_hi").alias("_hi")).where("_lo <= _hi")
    pieces = days.select(*by, "_lo", "_hi", F.explode(F.expr(
        f"sequence(floor(_lo / {BIN_DAYS}D), floor(_hi / {BIN_DAYS}D))")).alias("_bin"))
    first = F.greatest(F.col("_lo") - F.col("_bin") * BIN_DAYS, F.lit(0)).cast("int")
    last = F.least(F.col("_hi") - F.col("_bin") * BIN_DAYS, F.lit(BIN_DAYS - 1)).cast("int")
    ones = F.lit(-1).cast("bigint")
    mask = F.call_function("shiftrightunsigned", ones, F.lit(BIN_DAYS - 1) - last) \
        .bitwiseAND(F.call_function("shiftleft", ones, first))
    return pieces.select(*by, "_bin", mask.alias("_days")).groupBy(*by, "_bin").agg(F.bit_or("_days").alias("_days"))


def range_table_select(df: DataFrame, date_col: str, selection: DataFrame, by: list[str] = (),
                       kind: str = "date") -> DataFrame:
    """D1 with the selection rows as a table: rows whose ``date_col`` is in any range (of the row's ``by``).

    A semi join on intervals, as an equi-join with ``selection_bins`` on
    (``by``, bin) and an exact test of the day's bit.  A bin is there once,
    so no row is repeated and thousands of ranges become neither a long OR
    nor a nested-loop join.  Without ``by`` the bins are bounded by the
    calendar (10,000 years are 57,100 rows of 16 bytes) and broadcast; with
    it, the planner chooses by measured size and AQE splits a key that holds
    many rows.  The first and the last selected day are scalar subqueries
    that reach the scan as a range.  A NULL date or key is in no range;
    columns, repeated rows and their number stay as they are.
    """
    if kind not in ("date", "timestamp_ntz"):
        raise ValueError(f"unknown column kind {kind}")
    by, taken = list(by), {c.lower() for c in df.columns}
    names = dict(zip([*by, "_bin", "_days"], _free_names([*by, "_bin", "_days"], taken), strict=True))
    bins = selection_bins(selection, by).withColumnsRenamed(names)
    if not by:
        bins = F.broadcast(bins)
    day = F.unix_date(F.to_date(date_col))
    # The scan takes a subquery as it is, so both edges are made within theirs; one is the smallest text
    # and one the largest date, since two aggregates alike become fields of one subquery, which no scan takes.
    lo = selection.select(F.try_to_date(F.min("LOW"), "yyyyMMdd").cast(kind)).scalar()
    after = selection.select(F.date_add(F.max(parse_yyyymmdd("HIGH")), 1).cast(kind)).scalar()
    near = (F.col(date_col) >= lo) & (F.col(date_col) < after)
    on = F.floor(day / F.lit(float(BIN_DAYS))) == F.col(names["_bin"])
    for c in by:
        on = on & (df[c] == F.col(names[c]))
    bit = F.call_function("shiftright", F.col(names["_days"]), F.pmod(day, F.lit(BIN_DAYS))).bitwiseAND(F.lit(1).cast("bigint"))
    return df.where(near).join(bins, on & (bit == 1), "left_semi")


def _free_names(stems: list[str], taken: set[str]) -> list[str]:
    """A name for each stem that is neither taken nor given twice, in whatever case."""
    out, taken = [], set(taken)
    for stem in stems:
        name = f"_sel{stem}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def detail_lookup(selected: DataFrame, detail: DataFrame, on: list[str] | Column) -> DataFrame:
    """D1, second call: the detail record of each selected row (equi-join)."""
    return selected.join(detail, on, "inner")


# ---------------------------------------------------------------- D2

CALL_MEASURES = ["total_ms", "ser_ms", "deser_ms", "app_ms", "sent_bytes", "recv_bytes"]


def call_metrics(calls: DataFrame, conn: str = "connection", ts: str = "ts",
                 tie: str = "call_id", reset: str = "is_reset",
                 measures: list[str] = CALL_MEASURES, bucket_minutes: int | None = None) -> DataFrame:
    """Throughput counters per connection since each reset.

    ``reset_epoch`` = number of resets at or before a call, in (ts, tie)
    order; a reset row opens its epoch and is not counted as a call.

    A running count over ``partitionBy(connection)`` would sort a whole
    connection in one task, and cutting time into hours would leave a busy
    hour whole.  Here the calls are range-partitioned by (connection, ts,
    tie), which cuts any connection, hour or single moment at as many places
    as its rows need, and staged with the number of their range
    (``staged_ranges``).  A count within each range gives a local epoch;
    the resets of a connection's earlier ranges, one row per connection and
    range, are carried over the edges and added once the calls are summed up
    per local epoch.  Rows with equal (connection, ts, tie) share a range.

    A NULL connection is a connection of its own, a NULL time precedes every
    time, a NULL tie every tie, and a NULL reset flag is no reset.
    ``bucket_minutes`` has no effect any more.
    """
    r = F.coalesce(F.col(reset).cast("int"), F.lit(0))
    c = staged_ranges(calls.select(conn, ts, tie, r.alias("_r"), *measures), [conn, ts, tie], "_range")
    per_range = c.groupBy("_range", conn).agg(F.sum("_r").alias("_resets"))
    earlier = Window.partitionBy(conn).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_range.select(F.col("_range").alias("_at"), F.col(conn).alias("_conn"),
                             F.coalesce(F.sum("_resets").over(earlier), F.lit(0)).alias("_before"))
    # dealing whole ranges by their number is all the order the window needs
    within = Window.partitionBy("_range", conn).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    counted = c.repartitionByRange("_range").withColumn("_local", F.sum("_r").over(within))
    call = F.col("_r") == 0
    sums = [F.sum(F.when(call, F.col(m)).otherwise(F.lit(0))).alias(m) for m in measures]
    local = counted.groupBy("_range", conn, "_local").agg(F.sum(call.cast("bigint")).alias("calls"), *sums)
    both = local.join(carry, (F.col("_range") == F.col("_at")) & F.col(conn).eqNullSafe(F.col("_conn")))
    return (both.groupBy(conn, (F.col("_before") + F.col("_local")).cast("bigint").alias("reset_epoch"))
            .agg(*[F.sum(m).cast("bigint").alias(m) for m in ["calls", *measures]]))


# ---------------------------------------------------------------- D3

# Field types of the remote-call records and their Spark forms.
FIELD_TYPES = ("CHAR", "STRING", "DATE", "TIME", "NUM", "BCD", "DECF16", "DECF34", "INT", "FLOAT",
               "BYTE", "XSTRING", "STRUCTURE", "TABLE")


# Significant digits, smallest exponent and largest exponent of
# the first digit of the two decimal floating-point types.
DECF_LIMITS = {"DECF16": (16, -398, 384), "DECF34": (34, -6176, 6144)}
_DECF_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]{1,6})?$"


def decfloat(text: Column, ftype: str) -> Column:
    """A decimal floating-point text as ``struct<coefficient, exponent>``, exact.

    The value is coefficient * 10^exponent; the coefficient has no trailing
    zeros (zero is 0 * 10^0), so equal values are equal structs.  NULL where
    the text is no number, has more significant digits than the type, or an
    exponent outside its range: nothing is rounded.
    """
    return _let(_let(_let(_decf_text(text), lambda t: _struct(_decf_parts(t))), lambda p: _struct(_decf_stripped(p))),
                lambda p: _decf_value(p, ftype))


def _struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _decf_text(text: Column) -> Column:
    """The text of a number, its exponent marked by E; NULL for any other text."""
    t = F.trim(text)
    return F.when(t.rlike(_DECF_TEXT), F.replace(t, F.lit("e"), F.lit("E")))


def _decf_parts(t: Column) -> dict[str, Column]:
    """Digits as shown without leading zeros, digits after the point, power of ten."""
    mark = F.instr(t, "E")
    number = F.when(mark == 0, t).otherwise(F.substring(t, F.lit(1), mark - 1))
    point = F.instr(number, ".")
    sign = t.startswith("-") | t.startswith("+")
    digits = F.replace(F.when(sign, F.substring(number, 2, 1 << 30)).otherwise(number), F.lit("."), F.lit(""))
    power = F.when(mark > 0, F.substring(t, mark + 1, F.lit(8)).try_cast("int"))
    return {"shown": F.ltrim(digits, F.lit("0")), "after": F.when(point > 0, F.char_length(number) - point).otherwise(F.lit(0)),
            "power": F.coalesce(power, F.lit(0)), "minus": t.startswith("-")}


def _decf_stripped(p) -> dict[str, Column]:
    kept = F.rtrim(p["shown"], F.lit("0"))
    return {"kept": kept, "n": F.char_length(kept), "minus": p["minus"],
            "exponent": p["power"] - p["after"] + F.char_length(p["shown"]) - F.char_length(kept)}


def _decf_value(p, ftype: str) -> Column:
    digits, smallest, largest = DECF_LIMITS[ftype]
    whole = f"decimal({digits},0)"
    fits = (p["n"] <= digits) & (p["exponent"] >= smallest) & (p["exponent"] + p["n"] - 1 <= largest)
    signed = F.concat(F.when(p["minus"], F.lit("-")).otherwise(F.lit("")), p["kept"]).try_cast(whole)
    return F.when(p["n"] == 0, F.struct(F.lit(0).cast(whole).alias("coefficient"), F.lit(0).alias("exponent"))) \
        .when(fits, F.struct(signed.alias("coefficient"), p["exponent"].cast("int").alias("exponent")))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _typed(col: Column, ftype: str, arg) -> Column:
    if ftype == "CHAR":
        # a length, if given, is the field's width: a longer value does not fit
        return F.rtrim(col) if arg is None else F.when(F.char_length(F.rtrim(col)) <= int(arg), F.rtrim(col))
    if ftype == "STRING":
        return col
    if ftype == "DATE":
        # eight plain digits are cut by place, which costs less than a date pattern; the rest is the pattern's to judge
        plain = F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2))
        return F.when(col.rlike(r"^[1-9][0-9]{7}\z"), plain.try_cast("date")).otherwise(F.try_to_date(col, "yyyyMMdd"))
    if ftype == "TIME":
        ok = col.rlike("^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]$")
        return F.when(ok, col)
    if ftype == "NUM":
        ok = col.rlike("^[0-9]+$")
        return F.when(ok, col.try_cast(f"decimal({arg or 18},0)"))
    if ftype == "BCD":
        # packed decimals hold a fixed number of decimals: more of them do not fit
        size = arg or "31,14"
        fits = F.trim(col).rlike(rf"^[+-]?[0-9]*(\.[0-9]{{0,{int(size.split(',')[1])}}}0*)?$")
        return F.when(fits, F.trim(col).try_cast(f"decimal({size})"))
    if ftype in ("DECF16", "DECF34"):
        # decimal floating point, exponent allowed in the text: held as it is
        # (arg "float"), or as a fixed-scale DECIMAL if that holds it exactly
        if arg == "float":
            return decfloat(col, ftype)
        size, scale = (int(x) for x in (arg or "38,18").split(","))

        def fits(v: Column) -> Column:
            point = F.char_length(F.abs(v["coefficient"]).cast("string")) + v["exponent"]
            return (v["coefficient"] == 0) | ((v["exponent"] >= -scale) & (point <= size - scale))

        return F.when(_let(decfloat(col, ftype), fits), F.trim(col).try_cast(f"decimal({size},{scale})"))
    if ftype == "INT":
        # INT1 is unsigned (0..255); INT2/INT4/INT8 are signed 16/32/64 bit.
        width = int(arg or 8)
        kinds = {1: ("smallint", 0, 255), 2: ("smallint", -32768, 32767),
                 4: ("int", -2147483648, 2147483647), 8: ("bigint", None, None)}
        kind, lo, hi = kinds[width]
        v = F.trim(col).try_cast("bigint")
        if lo is not None:
            v = F.when(v.between(lo, hi), v)
        return v.cast(kind)
    if ftype == "FLOAT":
        return F.trim(col).try_cast("double")
    if ftype in ("BYTE", "XSTRING"):
        ok = col.rlike("^([0-9A-Fa-f]{2})*$")
        return F.when(ok, F.unhex(col))
    raise ValueError(f"unknown field type {ftype}")


def normalize_records(df: DataFrame, spec: list[tuple], keep: list[str] | None = None) -> DataFrame:
    """D3: text fields of fixed remote types -> typed columns.

    ``spec`` rows are ``(column, type[, arg])`` with types from FIELD_TYPES.
    DECF16 and DECF34 become a DECIMAL of ``arg`` (38,18 by default), or with
    ``arg`` "float" the struct of ``decfloat``, which holds all their values.
    A value with more significant digits than the type, or one the DECIMAL
    would have to round, does not convert.
    A field that does not convert becomes NULL and its name is listed in
    ``errors`` (comma separated, empty when clean): flagged, never dropped.
    """
    keep, names = list(keep or []), [item[0] for item in spec]
    # Converted in a step of its own, so that the flags read each value instead of converting it again.
    held = dict(zip(names, _free_names(names, {c.lower() for c in df.columns}), strict=True))
    floats = [item for item in spec if tuple(item[1:]) in (("DECF16", "float"), ("DECF34", "float"))]
    ready, done = _decfloat_columns(df, floats, held)
    done = done.select("*", *[ready.get(item[0], _converted(F.col(item[0]), item)).alias(held[item[0]]) for item in spec])
    value = {item[0]: _value(F.col(held[item[0]]), item) for item in spec}
    flags = [F.when(_bad(F.col(item[0]), F.col(held[item[0]]), item), F.lit(item[0])) for item in spec]
    return done.select(*keep, *[value[n].alias(n) for n in names], F.concat_ws(",", *flags).alias("errors"))


def _decfloat_columns(df: DataFrame, items: list[tuple], held: dict[str, str]) -> tuple[dict[str, Column], DataFrame]:
    """``decfloat`` of whole columns, step by step: compiled, where a lambda's body is interpreted."""
    def step(df: DataFrame, what: str, of) -> tuple[DataFrame, dict]:
        made = {item[0]: of(item) for item in items}
        stems = [(n, f) for n in made for f in made[n]]
        names = dict(zip(stems, _free_names([f"{what}{held[n]}_{f}" for n, f in stems], {c.lower() for c in df.columns}), strict=True))
        df = df.withColumns({names[n, f]: made[n][f] for n, f in stems})
        return df, {n: {f: F.col(names[n, f]) for f in made[n]} for n in made}

    if not items:
        return {}, df
    df, text = step(df, "t", lambda item: {"t": _decf_text(F.col(item[0]))})
    df, parts = step(df, "p", lambda item: _decf_parts(text[item[0]]["t"]))
    df, stripped = step(df, "s", lambda item: _decf_stripped(parts[item[0]]))
    return {item[0]: _decf_value(stripped[item[0]], item[1]) for item in items}, df


# ``STRUCTURE`` and ``TABLE`` take a nested spec as third entry: a struct, and an array of structs, converted field
# by field.  A converted TABLE holds (value, bad) of each line, anything else is its value.

def _converted(src: Column, item: tuple) -> Column:
    ftype, arg = item[1], item[2] if len(item) > 2 else None
    if ftype == "STRUCTURE":
        return F.when(src.isNotNull(), F.struct(*[_converted(src[i[0]], i).alias(i[0]) for i in arg]))
    if ftype == "TABLE":
        line = ("", "STRUCTURE", arg)
        return F.transform(src, lambda s: _let(_converted(s, line), lambda v: F.struct(
            _value(v, line).alias("value"), _bad(s, v, line).alias("bad"))))
    return _typed(src, ftype, arg)


def _value(done: Column, item: tuple) -> Column:
    """The typed value of one spec row."""
    if item[1] == "TABLE":
        return done["value"]
    if item[1] == "STRUCTURE" and _has_table(item):
        return F.when(done.isNotNull(), F.struct(*[_value(done[i[0]], i).alias(i[0]) for i in item[2]]))
    return done


def _has_table(item: tuple) -> bool:
    return any(i[1] == "TABLE" or i[1] == "STRUCTURE" and _has_table(i) for i in item[2])


def _bad(src: Column, done: Column, item: tuple) -> Column:
    """Does anything in one spec row not convert?"""
    if item[1] == "TABLE":
        return F.coalesce(F.exists(done, lambda line: line["bad"]), F.lit(False))
    if item[1] == "STRUCTURE":
        return reduce(lambda a, b: a | b, [F.coalesce(_bad(src[i[0]], done[i[0]], i), F.lit(False)) for i in item[2]])
    return src.isNotNull() & done.isNull()


# ---------------------------------------------------------------- D4

# The longest field values the nested-table sample prints:
# characters of STR, bytes of XSTR (held as hex text, two digits a byte).
STR_MAX = 256
XSTR_MAX = 128


def flatten_deep_table(df: DataFrame, id_col: str = "id", tab: str = "tab") -> DataFrame:
    """Nested-table rows -> flat rows with a 1-based line number.

    ``STR`` longer than 256 characters and ``XSTR`` longer than 128 bytes (256
    hex digits) are left out (NULL), the rest of the line is kept.  ``posexplode`` runs inside the
    task that holds the record, so no shuffle is involved.
    """
    lines = df.select(id_col, F.posexplode(tab).alias("_pos", "_line"))
    return lines.select(
        id_col,
        (F.col("_pos") + 1).cast("int").alias("line_no"),
        F.col("_line.I").alias("I"),
        F.col("_line.C").alias("C"),
        F.when(F.char_length("_line.STR") <= STR_MAX, F.col("_line.STR")).alias("STR"),
        F.when(F.char_length("_line.XSTR") <= 2 * XSTR_MAX, F.col("_line.XSTR")).alias("XSTR"),
    )
