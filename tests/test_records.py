"""D1-D4 against brute-force Python on small fixtures."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from ratebook.operators import records


def test_range_select_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(1996, 1, 1)
    rows = [(i, base + dt.timedelta(days=rnd.randrange(0, 900)), rnd.choice(["LH", "AA", "UA"]))
            for i in range(500)]
    df = spark.createDataFrame(rows, "id long, d date, airline string")
    ranges = [("I", "BT", "19960110", "19960220"), ("I", "BT", "19970301", "19970301")]

    def inside(d):
        return (dt.date(1996, 1, 10) <= d <= dt.date(1996, 2, 20)) or d == dt.date(1997, 3, 1)

    got = [r.id for r in records.range_select(df, "d", ranges, {"airline": "LH"}, 10, ["id"]).collect()]
    want = sorted(i for i, d, a in rows if inside(d) and a == "LH")[:10]
    assert got == want
    all_rows = {r.id for r in records.range_select(df, "d", ranges, {"airline": "*"}).collect()}
    assert all_rows == {i for i, d, a in rows if inside(d)}


def test_range_filter_pushed_to_scan(spark, tmp):
    rows = [(i, dt.datetime(1996, 1, 1) + dt.timedelta(days=i)) for i in range(100)]
    spark.createDataFrame(rows, "id long, ts timestamp_ntz").write.parquet(f"{tmp}/t")
    df = spark.read.parquet(f"{tmp}/t")
    sel = records.range_select(df, "ts", [("I", "BT", "19960105", "19960110")], kind="timestamp_ntz")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert sorted(r.id for r in sel.collect()) == list(range(4, 10))


def test_call_metrics_brute_force(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        conn = rnd.choice([1, 1, 1, 2, 3])          # connection 1 is hot
        ts = t0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 30))
        rows.append((conn, ts, i, rnd.random() < 0.1, rnd.randrange(1, 100), rnd.randrange(0, 5),
                     rnd.randrange(0, 5), rnd.randrange(0, 50), rnd.randrange(0, 900), rnd.randrange(0, 900)))
    cols = "connection long, ts timestamp_ntz, call_id long, is_reset boolean, total_ms long, " \
           "ser_ms long, deser_ms long, app_ms long, sent_bytes long, recv_bytes long"
    df = spark.createDataFrame(rows, cols)
    got = {(r.connection, r.reset_epoch): tuple(r)[2:] for r in records.call_metrics(df).collect()}
    fine = {(r.connection, r.reset_epoch): tuple(r)[2:]
            for r in records.call_metrics(df, bucket_minutes=8).collect()}
    assert fine == got
    want = {}
    for conn in {r[0] for r in rows}:
        epoch = 0
        for r in sorted((r for r in rows if r[0] == conn), key=lambda r: (r[1], r[2])):
            epoch += int(r[3])
            acc = want.setdefault((conn, epoch), [0] * 7)
            if not r[3]:
                acc[0] += 1
                for k in range(6):
                    acc[k + 1] += r[4 + k]
    assert got == {k: tuple(v) for k, v in want.items()}


def test_normalize_records_flags(spark):
    df = spark.createDataFrame([
        ("20250221", "AB        ", "000042", " 12.50", "0A0B", "235959"),
        ("20250230", "X", "12a", "x", "0G", "246000"),
    ], "d string, c string, n string, b string, x string, t string")
    spec = [("d", "DATE"), ("c", "CHAR"), ("n", "NUM", 6), ("b", "BCD", "9,2"), ("x", "BYTE"), ("t", "TIME")]
    rows = records.normalize_records(df, spec).collect()
    ok, bad = rows
    assert ok.d == dt.date(2025, 2, 21) and ok.c == "AB" and int(ok.n) == 42
    assert str(ok.b) == "12.50" and bytes(ok.x) == b"\x0a\x0b" and ok.t == "235959" and ok.errors == ""
    assert bad.errors == "d,n,b,x,t" and bad.c == "X"


def test_flatten_deep_table_limits(spark):
    long_str = "y" * 257
    ok_str = "z" * 256
    tab = [(1, "C1", "short", "0A0B"), (2, "C2", long_str, "AB" * 129), (3, "C3", ok_str, "AB" * 128),
           (4, "C4", "x", "AB" * 64), (5, "C5", "x", "AB" * 65)]
    df = spark.createDataFrame([(10, tab)],
                               "id long, tab array<struct<I:int,C:string,STR:string,XSTR:string>>")
    rows = records.flatten_deep_table(df).orderBy("line_no").collect()
    assert [r.line_no for r in rows] == [1, 2, 3, 4, 5]
    assert rows[0].STR == "short" and rows[0].XSTR == "0A0B"
    assert rows[1].STR is None and rows[1].XSTR is None and rows[1].C == "C2"
    assert rows[2].STR == ok_str and rows[2].XSTR == "AB" * 128
    assert rows[3].XSTR == "AB" * 64 and rows[4].XSTR == "AB" * 65


def test_deep_table_proxy_whole_texts(spark):
    from conftest import SF001
    from ratebook.plans.catalog import q_flatten_deep_table
    flat = q_flatten_deep_table(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = docs.select(F.sum(F.size(F.split("text", "\n", -1)))).first()[0]
    assert flat.count() == want


def test_int_widths(spark):
    df = spark.createDataFrame([("255", "-5", "70000", " 12 ")], "a string, b string, c string, d string")
    spec = [("a", "INT", 1), ("b", "INT", 1), ("c", "INT", 2), ("d", "INT", 4)]
    r = records.normalize_records(df, spec).first()
    assert (r.a, r.b, r.c, r.d, r.errors) == (255, None, None, 12, "b,c")


def test_decfloat_and_text_types(spark):
    df = spark.createDataFrame([("1.5E+3", "-0.000123", "héllo ", "0a0b0c")],
                               "a string, b string, c string, x string")
    r = records.normalize_records(df, [("a", "DECF16"), ("b", "DECF34"), ("c", "STRING"),
                                       ("x", "XSTRING")]).first()
    assert float(r.a) == 1500.0 and float(r.b) == -0.000123 and r.c == "héllo "
    assert bytes(r.x) == b"\x0a\x0b\x0c" and r.errors == ""


def test_call_metrics_keeps_null_keys_and_hot_hours(spark):
    """A third of all calls in one hour of one connection; NULL connections, times and flags are kept."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(seconds=i), i, i % 50 == 0) for i in range(400)]
    rows += [(2 + i % 7, t0 + dt.timedelta(hours=i % 90), 1000 + i, i % 9 == 0) for i in range(700)]
    rows += [(None, t0, 5000, False), (None, None, 5001, True), (3, None, 5002, None)]
    cols = "connection long, ts timestamp_ntz, call_id long, is_reset boolean"
    df = spark.createDataFrame(rows, cols).withColumns({c: F.lit(1).cast("long") for c in records.CALL_MEASURES})
    for minutes in (60, 8):
        got = {(r.connection, r.reset_epoch): r.calls for r in records.call_metrics(df, bucket_minutes=minutes).collect()}
        want = {}
        for conn in {r[0] for r in rows}:
            epoch = 0
            for r in sorted((r for r in rows if r[0] == conn), key=lambda r: (r[1] is not None, r[1] or t0, r[2])):
                epoch += bool(r[3])
                want.setdefault((conn, epoch), 0)
                want[conn, epoch] += not r[3]
        assert got == want


def test_selection_bounds_have_eight_digits(spark):
    import pytest
    df = spark.createDataFrame([(dt.date(1996, 10, 1),)], "d date")
    for low, high in (("1996101", "19961031"), ("19961001", "1996 10 1"), ("19961001", "")):
        with pytest.raises(ValueError, match="yyyyMMdd"):
            records.range_select(df, "d", [("I", "BT", low, high)])


def test_structures_tables_lengths_and_scales(spark):
    schema = "s struct<d:string,n:string>, t array<struct<x:string,i:string>>, c string, b string"
    df = spark.createDataFrame([
        (("20250221", "7"), [("0A", "1"), ("0B", "2")], "ABC  ", "1.20"),
        (("20250230", None), [("0G", "1"), None, ("0C", "x")], "ABCD", "1.239"),
        (None, None, None, None), ((None, "1"), [], "", "1.2300"),
    ], schema)
    spec = [("s", "STRUCTURE", [("d", "DATE"), ("n", "INT", 1)]), ("t", "TABLE", [("x", "BYTE"), ("i", "INT", 2)]),
            ("c", "CHAR", 3), ("b", "BCD", "9,2")]
    a, b, c, d = records.normalize_records(df, spec).collect()
    assert (a.s.d, a.s.n, [(bytes(x.x), x.i) for x in a.t], a.c, str(a.b), a.errors) == \
        (dt.date(2025, 2, 21), 7, [(b"\x0a", 1), (b"\x0b", 2)], "ABC", "1.20", "")
    assert b.errors == "s,t,c,b" and b.s.d is None and b.t[1] is None and b.t[2].i is None and b.c is None and b.b is None
    assert tuple(c) == (None, None, None, None, "") and d.s.n == 1 and d.t == [] and str(d.b) == "1.23" and d.errors == ""


def _selection(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"{extra}SIGN string, OPTION string, LOW string, HIGH string")


def _text(d):
    return d.isoformat().replace("-", "")


def test_selection_table_brute_force(spark):
    """Overlapping, nested, repeated, empty and calendar-wide ranges; days before 1970; NULL dates; clashing names."""
    rnd = random.Random(11)
    base = dt.date(1968, 3, 1)
    rows = [(i, base + dt.timedelta(days=rnd.randrange(0, 1500)) if i % 40 else None, i % 3) for i in range(1200)] * 2
    df = spark.createDataFrame(rows, "id long, d date, _sel_bin int")
    ranges = []
    for _ in range(60):
        low = base + dt.timedelta(days=rnd.randrange(0, 1500))
        ranges.append((low, low + dt.timedelta(days=rnd.choice([-2, 0, 0, 1, 3, 64, 130]))))
    ranges += ranges[:5]
    selection = _selection(spark, [("I", "BT", _text(a), _text(b)) for a, b in ranges])
    got = records.range_table_select(df, "d", selection)
    assert got.columns == df.columns
    want = [r for r in rows if r[1] is not None and any(a <= r[1] <= b for a, b in ranges)]
    assert 0 < len(want) < len(rows)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    times = df.withColumn("d", F.col("d").cast("timestamp_ntz") + F.expr("interval '23:59:59.999999' hour to second"))
    assert sorted(r.id for r in records.range_table_select(times, "d", selection, kind="timestamp_ntz").collect()) == sorted(r[0] for r in want)
    assert records.range_table_select(df, "d", selection.limit(0)).count() == 0
    assert records.range_table_select(df.limit(0), "d", selection).count() == 0


def test_selection_table_by_key(spark):
    rnd = random.Random(12)
    base = dt.date(2024, 1, 1)
    rows = [(i, rnd.choice([1, 2, 3, None]), base + dt.timedelta(days=rnd.randrange(0, 200))) for i in range(800)]
    ranges = []
    for _ in range(25):
        low = base + dt.timedelta(days=rnd.randrange(0, 200))
        ranges.append((rnd.choice([1, 2, None]), low, low + dt.timedelta(days=rnd.randrange(0, 20))))
    selection = _selection(spark, [(k, "I", "BT", _text(a), _text(b)) for k, a, b in ranges], "k long, ")
    got = records.range_table_select(spark.createDataFrame(rows, "id long, k long, d date"), "d", selection, ["k"])
    want = sorted(i for i, k, d in rows if k is not None and any(k == q and a <= d <= b for q, a, b in ranges))
    assert want and sorted(r.id for r in got.collect()) == want


def test_selection_table_is_bounded_and_pushed(spark, tmp):
    """The whole calendar a thousand times is 57,100 bins at most; no nested loop; the edges reach the scan."""
    wide = _selection(spark, [("I", "BT", "00010101", "99991231"), ("I", "BT", "00010101", "99991230")] * 500)
    assert records.selection_bins(wide).count() <= 57100
    rows = [(i, dt.datetime(1996, 1, 1) + dt.timedelta(days=i)) for i in range(300)]
    spark.createDataFrame(rows, "id long, ts timestamp_ntz").write.parquet(f"{tmp}/t")
    selection = _selection(spark, [("I", "BT", "19960105", "19960110"), ("I", "BT", "19960601", "19960601")])
    sel = records.range_table_select(spark.read.parquet(f"{tmp}/t"), "ts", selection, kind="timestamp_ntz")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "BroadcastHashJoin" in plan and "GreaterThanOrEqual(ts,ScalarSubquery" in plan
    assert sorted(r.id for r in sel.collect()) == [4, 5, 6, 7, 8, 9, 152]


def test_selection_table_refuses_other_forms(spark):
    import pytest
    df = spark.createDataFrame([(dt.date(1996, 10, 1),)], "d date")
    for row in (("E", "BT", "19961001", "19961031"), ("I", "EQ", "19961001", "19961031"), (None, "BT", "19961001", "19961031"),
                ("I", "BT", "19961301", "19961031"), ("I", "BT", "19961001", None)):
        with pytest.raises(Exception, match="unsupported selection|invalid yyyyMMdd"):
            records.range_table_select(df, "d", _selection(spark, [row])).collect()


def test_call_metrics_splits_a_hot_hour(spark):
    """A third of the calls in one hour of one connection, a sixth in one moment: no range holds above twice the median."""
    from ratebook.session import staged_ranges
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(milliseconds=i), i, i % 97 == 0) for i in range(20000)]
    rows += [(2, t0, 100000 + i, i % 89 == 0) for i in range(10000)]
    rows += [(3 + i % 50, t0 + dt.timedelta(hours=i % 700), 200000 + i, i % 31 == 0) for i in range(30000)]
    df = spark.createDataFrame(rows, "connection long, ts timestamp_ntz, call_id long, is_reset boolean")
    # at this size coalescing would merge every range into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sorted(r["count"] for r in staged_ranges(df, ["connection", "ts", "call_id"], "_range").groupBy("_range").count().collect())
        _check_hot_hour(spark, df, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 3 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def _check_hot_hour(spark, df, rows):
    metrics = records.call_metrics(df.withColumns({c: F.lit(2).cast("long") for c in records.CALL_MEASURES}))
    # the calls are dealt by range alone; what is hashed by connection has been summed up
    plan = metrics._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [_range" in plan
    got = {(r.connection, r.reset_epoch): (r.calls, r.total_ms) for r in metrics.collect()}
    want = {}
    for conn in {r[0] for r in rows}:
        epoch = 0
        for r in sorted((r for r in rows if r[0] == conn), key=lambda r: (r[1], r[2])):
            epoch += r[3]
            n = want.get((conn, epoch), (0, 0))[0] + (not r[3])
            want[conn, epoch] = (n, 2 * n)
    assert got == want


def test_decfloat_is_exact_or_flagged(spark):
    """Coefficient and exponent against Python decimals, at the edges of both types."""
    from decimal import Context, Decimal, Inexact, Overflow, Underflow
    texts = ["0", "-0.00", "1E-20", "1.50", "150e1", "+.5", "5.", "1234567890123456", "12345678901234567", "12345678901234560",
             "9.999999999999999E384", "1E385", "1E-398", "1E-399", "10E-399", "123E-398", "0.1E-398", "1e6144", "1e6145", "1E-6176", "1E-6177",
             "-" + "7" * 34, "7" * 35, "000000000000000000000000000000000000000001", "1E+000003", "x", "", ".", "1E", "1E9999999", "1.2.3", "1 2"]
    limits = {"DECF16": (16, 384, -398), "DECF34": (34, 6144, -6176)}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "id int, v string")
    for ftype, (digits, emax, etiny) in limits.items():
        got = {r.id: r for r in records.normalize_records(df, [("v", ftype, "float")], keep=["id"]).collect()}
        assert got[len(texts)].v is None and got[len(texts)].errors == ""
        context = Context(prec=digits, Emax=emax, Emin=etiny + digits - 1, traps=[Inexact, Overflow, Underflow])
        for i, t in enumerate(texts):
            try:
                want = context.create_decimal(t.strip())
                assert want.is_finite()
            except Exception:
                want = None
            r = got[i]
            if want is None:
                assert r.v is None and r.errors == "v", (ftype, t, r)
            else:
                assert r.errors == "" and Decimal(r.v.coefficient).scaleb(r.v.exponent, Context(prec=40, Emax=99999, Emin=-99999)) == want, (ftype, t, r)
                assert r.v.exponent == 0 if not want else int(r.v.coefficient) % 10 != 0, (ftype, t, r)
    # as a DECIMAL: exact, or flagged; never rounded to 0
    fixed = {r.id: r for r in records.normalize_records(df, [("v", "DECF34")], keep=["id"]).collect()}
    assert fixed[texts.index("1E-20")].v is None and fixed[texts.index("1E-20")].errors == "v"
    assert fixed[texts.index("150e1")].v == 1500 and fixed[texts.index("0")].v == 0 and fixed[texts.index("1.50")].v == Decimal("1.5")


def test_each_field_is_converted_once(spark):
    """Values and flags read one conversion, decimal floats included; nested tables in structures keep their form."""
    spec = [("f", "DECF16", "float"), ("d", "DATE"), ("st", "STRUCTURE", [("d", "DATE"), ("tb", "TABLE", [("x", "BYTE"), ("f", "DECF34", "float")])])]
    rows = [("1.50e2", "20240229", ("20240101", [("0A", "7E-3"), (None, None)])), ("x", "20230229", ("2024", [("0G", "1")])),
            ("+.5", "02024010", (None, [("0A", "1e")])), (None, None, None)]
    df = spark.createDataFrame(rows, "f string, d string, st struct<d:string,tb:array<struct<x:string,f:string>>>")
    out = records.normalize_records(df, spec, keep=["f"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(trim(f") == 1 and plan.count("RLIKE(d#") == 1
    got = records.normalize_records(df, spec).collect()
    assert [r.errors for r in got] == ["", "f,d,st", "d,st", ""]
    assert [r.f and (int(r.f.coefficient), r.f.exponent) for r in got] == [(15, 1), None, (5, -1), None]
    assert [r.d for r in got] == [dt.date(2024, 2, 29), None, None, None]
    assert got[0].st.d == dt.date(2024, 1, 1) and bytes(got[0].st.tb[0].x) == b"\n" and got[0].st.tb[1].x is None
    assert (int(got[0].st.tb[0].f.coefficient), got[0].st.tb[0].f.exponent) == (7, -3)
    assert got[1].st.d is None and got[1].st.tb[0].x is None and got[2].st.tb[0].f is None and got[3].st is None
    assert records.normalize_records(df, spec).schema["st"].dataType.simpleString() == \
        "struct<d:date,tb:array<struct<x:binary,f:struct<coefficient:decimal(34,0),exponent:int>>>>"
