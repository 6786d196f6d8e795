"""Line deduplication, quality rules, decontamination and pseudonyms against brute force."""

from __future__ import annotations

import re
import time
from collections import Counter, defaultdict
from datetime import date

import pytest
from llm_data import DOCS, SPACE, ascii_lower, edge_documents, prose, with_extras, words
from pyspark.sql import functions as F

from ratebook.llm import decontaminate, line_dedup, pii, quality_rules


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_documents(), DOCS)


# ------------------------------------------------------------------ lines

def line_key(line: str) -> str:
    return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))


def brute_lines(rows, threshold):
    seen = Counter(k for _, t in rows for k in {line_key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[line_key(x)] < threshold]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("threshold", "batches", "fanout"), [(10, 4, 4), (2, 5, 2), (3, 1, 4)])
def test_lines_match_brute_force(docs, threshold, batches, fanout):
    got = line_dedup.dedup_lines(docs, line_dedup.hash_batches(docs, batches), threshold, fanout)
    rows = sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()], key=str)
    assert rows == brute_lines(edge_documents(), threshold)


def test_line_runs_are_compacted_and_closed(spark, docs):
    runs = line_dedup.LineRuns(spark, threshold=2, fanout=2)
    for b in line_dedup.hash_batches(docs, 4):
        runs.add_batch(b)
    assert [len(x) for x in runs.levels] == [0, 0, 1] and len(runs.closed) == 3
    n = runs.frequent().count()
    runs.close()
    keys = Counter(k for _, t in edge_documents() for k in {line_key(x) for x in (t or "").split("\n")} if k)
    assert n == sum(v >= 2 for v in keys.values())
    assert not [t.name for t in spark.catalog.listTables() if t.name == runs.table]


def test_registered_batches_meet_closed_runs(spark, monkeypatch):
    closed, add = [], line_dedup.LineRuns.add_batch

    def recorded(runs, *batch):
        closed.append(len(runs.closed))
        add(runs, *batch)

    monkeypatch.setattr(line_dedup.LineRuns, "add_batch", recorded)
    rows = [(k, f"common\n{prose(k, 20)}") for k in range(60)]
    one_file = spark.createDataFrame(rows, DOCS).coalesce(1)
    monkeypatch.setattr(line_dedup, "table", lambda *names: line_dedup.staged(one_file, line_dedup.scratch(spark, "documents")))
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.op4_line_dedup(spark, "").collect()}
    assert got == {i: (n, dropped) for i, n, dropped, _ in brute_lines(rows, line_dedup.THRESHOLD)}
    assert len(closed) > 2 * line_dedup.FANOUT and max(closed) >= 2


def test_lines_keep_extra_columns_and_empty_tables(spark, docs):
    wide = with_extras(docs)
    out = line_dedup.dedup_lines(wide, [wide])
    assert set(wide.columns) <= set(out.columns) and out.count() == docs.count()
    none = docs.where("false")
    assert line_dedup.dedup_lines(none, [none]).count() == 0
    assert line_dedup.dedup_lines(docs, []).where("n_dropped > 0").count() == 0


# ------------------------------------------------------------------ quality

def brute_statistics(text):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    inside = {p for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search(f"[^{SPACE}]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_statistics_match_brute_force(spark, docs):
    more = [(900, "a b c d e f g h " * 5), (901, "x " + "a b c d e f g h " * 2 + "y"), (902, "a " * 40), (903, "1 2 3 4 5 6 7 8")]
    rows = edge_documents() + more
    got = quality_rules.with_statistics(spark.createDataFrame(rows, DOCS))
    have = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect()], key=str)
    assert have == sorted([(i, *brute_statistics(t)) for i, t in rows], key=str)


def test_rules_learn_held_out_quality(spark):
    rows, labels = [], []
    for k in range(900):
        bad = k % 3 == 0
        text = prose(k, 60)
        if bad:
            text = " ".join(w + ("!!" if k % 4 < 2 else " | ") for w in text.split())
        rows.append((k, text))
        labels.append((k, 0 if bad else 1, 0))
    labels += [(None, 0, 0), (5000, 0, 0), (1, None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = quality_rules.learn_rules(quality_rules.fit_sample(docs.where("doc_id % 2 = 0"), lab))
    assert 1 <= len(rules) <= quality_rules.MAX_RULES and all(1 <= len(r) <= quality_rules.MAX_LITERALS for r in rules)
    held = quality_rules.judge(docs.where("doc_id % 2 = 1"), rules)
    got = [(r.doc_id % 3 == 0, r.kept) for r in held.collect()]
    assert sum(k for bad, k in got if not bad) >= 0.97 * sum(not bad for bad, _ in got)
    assert sum(not k for bad, k in got if bad) >= 0.9 * sum(bad for bad, _ in got)


def test_source_columns_of_any_name_pass_through(spark, docs):
    own = ["_s", "_L", "_symbols", "_upper", "_digits", "_bang", "_bar", "_stops"]
    out = quality_rules.judge(docs.withColumns({c: F.lit(c) for c in own}), [])
    plain = quality_rules.judge(docs, [])
    assert [c for c in out.columns if c not in own] == plain.columns
    assert all(list(r) == own for r in out.select(*own).distinct().collect())
    assert sorted(map(str, out.drop(*own).collect())) == sorted(map(str, plain.collect()))


def test_fitting_sample_is_bounded_by_labels(spark):
    rows = [(1, prose(k, 60)) for k in range(50)] + [(2, prose(99, 60)), (3, None)]
    lab = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_rules.fit_sample(spark.createDataFrame(rows, DOCS), lab).collect()
    want = [brute_statistics(min(t for i, t in rows if i == 1)), brute_statistics(rows[-2][1])]
    assert sorted(int(r.words_count) for r in got) == sorted(w[0] for w in want)       # a text without words fails the base rules


def test_rules_without_labels_reject_nothing(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rules = quality_rules.learn_rules(quality_rules.fit_sample(docs, none))
    assert rules == []
    out = quality_rules.judge(with_extras(docs), rules)
    for r in out.collect():
        n = len(words(r.text))
        assert r.base_failed == (n < 20 or 100 * brute_statistics(r.text)[4] > 30 * n) and r.kept == (not r.base_failed)
    assert quality_rules.judge(docs.where("false"), rules).count() == 0


# ------------------------------------------------------------------ decontamination

def bench_words(text):
    return [w.decode() for w in re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())]


def brute_contamination(rows, items, window=10):
    phrases = defaultdict(set)
    for item, t in items:
        w = bench_words(t)
        for k in range(max(1, len(w) - window + 1)):
            if w:
                phrases[tuple(w[k:k + window])].add(str(item))
    out = []
    for i, t in rows:
        w, hit, found = bench_words(t), set(), set()
        for p, names in phrases.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    found |= names
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_contamination_matches_brute_force(spark, docs):
    rows = edge_documents() + [(300, "a a a a a a a a a a a a"), (301, None)]
    d = spark.createDataFrame(rows, DOCS)
    items = [(1, " ".join(words(rows[0][1])[5:30])), (2, "one TWO"), (3, None), (4, "..."), (5, "absent words here"), (6, "one, two"),
             (7, "a a a a a a a a a a a"), (8, " ".join(words(rows[6][1])[4000:4025])), (None, "école")]
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.marked(with_extras(d), b)
    have = sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()], key=str)
    want = [(i, n, h, [x for x in f if x != "None"]) for i, n, h, f in brute_contamination(rows, items)]
    assert have == sorted(want, key=str)
    assert got.where("contaminated <> (n_hit > 0)").count() == 0
    assert decontaminate.marked(d.where("false"), b).count() == 0
    assert decontaminate.marked(d, b.where("false")).where("contaminated").count() == 0


def test_proximity_matches_brute_force(spark, docs):
    queries = [("q1", "one"), ("q1", "three"), ("q2", "header"), ("q2", "line"), ("q3", "shared"), ("q3", "mine"), ("q4", "absent")]
    q = spark.createDataFrame(queries, "query string, term string")
    index = decontaminate.index_of(docs, q)
    for slop in (1, 2, 3, 30):
        got = {(r["query"], r.key) for r in decontaminate.proximity_matches(index, q, slop).collect()}
        want = set()
        for i, t in edge_documents():
            w = bench_words(t)
            for name in {x for x, _ in queries}:
                need = {t for x, t in queries if x == name}
                if any(need <= set(w[k:k + slop]) for k in range(len(w))):
                    want.add((name, i))
        assert got == want


# ------------------------------------------------------------------ pseudonyms

PII_ROWS = [
    (1, "card 4111 1111 1111 1111, 4111-1111-1111-1112 4337166598464399."), (2, "ip 70.123.182.155 and 1.2.3.256 v1.2.3.4.5 01.2.3.4"),
    (3, "tel +1 (988) 555-2485 or 212-555-0199"), (4, "2024-02-29 2023-02-29 1999/12/31 31.12.1849 0999-01-01 31.02.2020"),
    (5, "mail bosbt.42@mail8.example.com A.b+c@x.org _@x.org"), (6, None), (7, ""), (8, "nothing here, but 12 and @"),
    (9, "4111 1111 1111 1111 2024-02-29 bosbt.42@mail8.example.com +1 (988) 555-2485 70.123.182.155"), (None, "4337166598464399"),
]


def luhn(digits):
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits)))) % 10


def test_pseudonyms_come_back_and_link(spark):
    d = spark.createDataFrame(PII_ROWS, DOCS)
    out = pii.pseudonymize(with_extras(d))
    by = {r.doc_id: r for r in out.collect()}
    assert [(r.n_card, r.n_ip, r.n_phone, r.n_date, r.n_email) for r in (by[1], by[2], by[3], by[4], by[5])] == \
        [(2, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 2, 0, 0), (0, 0, 0, 3, 0), (0, 0, 0, 0, 2)]      # year 999 stays
    assert by[6].text is None and by[7].text == "" and by[8].text == PII_ROWS[7][1]
    for secret in ("4111 1111 1111 1111", "4337166598464399", "70.123.182.155", "555-2485", "2024-02-29", "bosbt"):
        assert not any(secret in (r.text or "") for r in by.values())
    assert "1.2.3.256" in by[2].text and "4111-1111-1111-1112" in by[1].text and "31.02.2020" in by[4].text
    cards = re.findall(r"\d(?:[ -]?\d){15}", by[1].text)
    assert [luhn(re.sub(r"\D", "", c)) for c in cards] == [0, 1, 0] and re.fullmatch(r"\d{4}( \d{4}){3}", cards[0])
    # equal values are equal everywhere
    linked = by[9].text.split()
    assert cards[0] in by[9].text and linked[4] == by[4].text.split()[0] and by[5].text.split()[1] in linked
    assert by[None].text == cards[2]
    back = {r.doc_id: r.text for r in pii.pseudonymize(out.select("doc_id", "text"), back=True).collect()}
    assert back == dict(PII_ROWS)
    other = {r.doc_id: r.text for r in pii.pseudonymize(d, key="another").collect()}
    assert other[1] != by[1].text
    assert pii.pseudonymize(d.where("false")).count() == 0


def test_number_permutations_are_bijective(spark):
    for a, b in (pii.INSIDE, pii.OUTSIDE, (7, 5)):
        x = spark.range(a * b).select("id", pii.permute_number(F.col("id"), a, b, "k").alias("v"))
        assert x.agg(F.count_distinct("v"), F.min("v"), F.max("v")).head() == (a * b, 0, a * b - 1)
    x = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"))
    y = x.select("s", pii.permute_text(F.col("s"), F.lit("ddd"), "k").alias("v"))
    assert y.select("v").distinct().count() == 1000
    assert y.where(pii.permute_text(F.col("v"), F.lit("ddd"), "k", back=True) != F.col("s")).count() == 0


# An independent scanner: plain patterns, the library's own notion of a date and an address.
SCAN = [
    ("email", r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("date", r"(?<!\w)(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4})(?!\w)"),
    ("ip", r"(?<!\w)(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)"),
    ("phone", r"(?<![\w+])(?:(?:\+1[ .-]?)?\(\d{3}\) ?\d{3}|\+1[ .-]?\d{3}[ .-]\d{3}|[2-9]\d\d[ .-][2-9]\d\d)[ .-]\d{4}(?!\w)"),
    ("card", r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)"),
]


def valid_value(kind, m):
    digits = re.sub(r"[^0-9]", "", m)
    if kind == "card":
        return luhn(digits) == 0
    if kind == "ip":
        return all(str(int(o)) == o and int(o) < 256 for o in m.split("."))
    if kind == "date":
        y, mo, d = (int(x) for x in (re.split("[-/.]", m) if m[4] in "-/" else re.split("[.]", m)[::-1]))
        try:
            return 1800 <= date(y, mo, d).year < 2200
        except ValueError:
            return False
    return kind != "email" or re.search("[0-9A-Za-z]", m.split("@")[0]) is not None


def test_matches_equal_an_independent_scanner(spark):
    """Every document of the smallest tables and the formats' edges: what is found, counted and kept."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(-1, "+1 (017) 555-7713 (099) 111-2222 +1.000.000.0000 017-555-7713 217-055-7713 217-555-7713"),
             (-2, "1700-01-01 0000-01-01 2301-05-05 1800-01-01 2199-12-31 31.12.1949 2000-02-30"),
             (-3, "a@b a@b.c a@b.cd a@.b.cd a@b..cd _@b.cd x@a.com1 p.q+r@s-t.u1.org. me@1.2.3.4"), (-4, None), (-5, "")]
    pattern = re.compile("|".join(f"(?P<{k}>{p})" for k, p in SCAN), flags=re.ASCII)
    out = {r.doc_id: r for r in pii.pseudonymize(spark.createDataFrame(rows, DOCS)).collect()}
    shape = str.maketrans({**dict.fromkeys("0123456789", "9"), **dict.fromkeys("abcdefghijklmnopqrstuvwxyz", "a"),
                           **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A")})
    changed = 0
    for i, t in rows:
        found = [(m.lastgroup, m.start(), m.end()) for m in pattern.finditer(t or "") if valid_value(m.lastgroup, m[0])]
        r = out[i]
        assert {k: r[f"n_{k}"] for k, _ in SCAN} == {k: sum(f[0] == k for f in found) for k, _ in SCAN}, (i, t)
        if t is None:
            assert r.text is None
            continue
        # the text between matches stays, and so does each value's format (an address may change its length)
        at = 0
        rest = r.text
        for k, a, z in found:
            assert rest.startswith(t[at:a])
            rest = rest[a - at:]
            new = re.match(dict(SCAN)[k], rest, flags=re.ASCII)[0] if k == "ip" else rest[:z - a]
            assert valid_value(k, new)
            if k != "ip":
                assert new.translate(shape) == t[a:z].translate(shape)
            changed += new != t[a:z]
            rest, at = rest[len(new):], z
        assert rest == t[at:]
    assert changed > 30
    back = pii.pseudonymize(spark.createDataFrame([(i, out[i].text) for i, _ in rows], DOCS), back=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(rows)


def test_endless_addresses_and_queries_end(spark):
    """100,000 labels, a local part of 100,000 characters, a run without an address."""
    rows = [(1, "x@a" + ".bb" * 100_000), (2, "q" * 100_000 + "@example.com"), (3, "w" * 300_000), (4, "1" * 100_000), (5, "a@" * 50_000),
            (6, "x@" + "a" * 100_000), (7, "1.1." * 50_000)]
    began = time.monotonic()
    out = {r.doc_id: r for r in pii.pseudonymize(spark.createDataFrame(rows, DOCS)).collect()}
    assert time.monotonic() - began < 60
    assert [out[i].n_email for i, _ in rows] == [1, 1, 0, 0, 0, 0, 0]
    assert len(out[2].text) == len(rows[1][1]) and out[2].text.endswith("@example.com") and out[2].text != rows[1][1]
    assert pii.pseudonymize(spark.createDataFrame([(2, out[2].text)], DOCS), back=True).head().text == rows[1][1]
