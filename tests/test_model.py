"""Randomized checks against a plain-Python model of the job semantics.

The model follows the source's rules (first quote per target, sell over the
target's mid, self pairs dropped, unknown or zero-rate pairs dropped, rate
times from-factor, five decimals half up), computed with ``decimal`` -- a
check independent of both Spark and SQL.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal, getcontext

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import RUN, items_frame, ref_frame
from ratebook.operators import rates
from ratebook.operators.merge import merge_rates
from ratebook.plans import jobs

getcontext().prec = 40
CODES = ["USD", "EUR", "JPY", "GBP", "AUD"]
Q5 = Decimal("0.00001")

money = st.decimals(min_value=Decimal("0.0100"), max_value=Decimal("999.9999"), places=4,
                    allow_nan=False, allow_infinity=False)
quote = st.tuples(st.sampled_from(CODES), money, money)


def model(items, targets, ref):
    mids = [(c, (b + s) / 2, s) for c, b, s in items]
    first = {}
    for c, m, _ in mids:
        first.setdefault(c, m)
    rows = [(c, "TWD", m) for c, m, _ in mids]
    for t in [t for t in targets if t != "TWD"]:
        for c, _, s in mids:
            rows.append((c, t, s / first[t]))
    out = []
    for a, b, r in rows:
        if a == b:
            continue
        f, k = ref.get((a, b), (1, Decimal(0)))
        if k == 0:
            continue
        out.append((a, b, str((r * f).quantize(Q5, rounding=ROUND_HALF_UP))))
    return sorted(out)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(items=st.lists(quote, min_size=1, max_size=6),
       extra_targets=st.lists(st.sampled_from(CODES), max_size=3),
       seed=st.integers(0, 10_000))
def test_common_rates_match_model(spark, items, extra_targets, seed):
    import random
    rnd = random.Random(seed)
    present = [c for c, _, _ in items]
    targets = ["TWD"] + [t for t in extra_targets if t in present]
    ref_rows, ref = [], {}
    for a in CODES:
        for b in CODES + ["TWD"]:
            if rnd.random() < 0.2:
                continue                      # absent pair
            f = rnd.choice([1, 10, 100])
            k = rnd.choice(["0", "1", "1", "1"])
            ref_rows.append((a, b, f, k))
            ref[(a, b)] = (f, Decimal(k))
    df = items_frame(spark, [(c, str(b), str(s)) for c, b, s in items])
    erp = jobs.common_rates(rates.quote_mid(df), targets, ref_frame(spark, ref_rows), RUN, "M")
    got = sorted((r.FROM_CURR, r.TO_CURRNCY, r.EXCH_RATE) for r in erp.collect())
    assert got == model(items, targets, ref)


key = st.tuples(st.sampled_from(["USD", "EUR", "JPY"]), st.sampled_from(["2025-01-01", "2025-02-01"]))
rate = st.decimals(min_value=Decimal("0.00001"), max_value=Decimal("999.99999"), places=5,
                   allow_nan=False, allow_infinity=False)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=st.dictionaries(key, rate, max_size=6), batch=st.lists(st.tuples(key, rate), max_size=8))
def test_merge_matches_row_by_row(spark, target, batch):
    table = dict(target)
    for k, r in batch:          # MERGE applied row by row, in order
        table[k] = r
    want = sorted((c, d, str(r)) for (c, d), r in table.items())
    t = spark.createDataFrame([(c, "TWD", r, d) for (c, d), r in target.items()],
                              "Currency string, Currency2 string, Rate decimal(18,5), RateDate string")
    b = spark.createDataFrame([(c, "TWD", r, d, i) for i, ((c, d), r) in enumerate(batch)],
                              "Currency string, Currency2 string, Rate decimal(18,5), RateDate string, seq bigint")
    got = sorted((r.Currency, r.RateDate, str(r.Rate)) for r in merge_rates(t, b).collect())
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 3), st.integers(0, 50),
                               st.integers(0, 10**6)), min_size=1, max_size=30, unique_by=lambda r: r[2]))
def test_newest_per_key_matches_python(spark, rows):
    from ratebook.sources.quote_files import newest_per_key
    df = spark.createDataFrame(rows, "k string, day int, seq int, v long")
    got = {(r.k, r.v, r.day, r.seq) for r in newest_per_key(df, ["k"], ["day", "seq"], ["v", "day", "seq"]).collect()}
    want = {}
    for k, day, seq, v in rows:
        if k not in want or (day, seq) > (want[k][1], want[k][2]):
            want[k] = (v, day, seq)
    assert got == {(k, *val) for k, val in want.items()}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(quoted=st.lists(st.tuples(st.sampled_from(["p1", "p2", "p3"]), st.sampled_from(CODES)),
                       min_size=1, max_size=12),
       wanted=st.lists(st.sampled_from(CODES), min_size=1, max_size=4))
def test_completeness_gaps_match_python(spark, quoted, wanted):
    from ratebook.operators.quality import completeness_gaps
    df = spark.createDataFrame([(p, i, c) for i, (p, c) in enumerate(quoted)],
                               "period string, pos int, from_curr string")
    got = {(r.period, r.to_curr) for r in completeness_gaps(df, wanted).collect()}
    periods = {p for p, _ in quoted}
    want = {(p, t) for p in periods for t in set(wanted) if (p, t) not in set(quoted)}
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(order=st.permutations(["name", "tabindex", "value", "class"]), decoy=st.booleans(),
       rate=st.decimals(min_value=Decimal("0.0001"), max_value=Decimal("9999"), places=4,
                        allow_nan=False, allow_infinity=False))
def test_page_rate_any_attribute_order(spark, order, decoy, rate):
    from ratebook.sources.pages import page_rate
    attrs = {"name": 'name="numberformat"', "tabindex": 'tabindex="4"', "value": f'value="{rate}"',
             "class": 'class="c"'}
    tag = "<input " + " ".join(attrs[a] for a in order) + ">"
    html = ('<input data-name="numberformat" tabindex="4" value="0">' if decoy else "") + tag
    got = spark.createDataFrame([(html,)], "html string").select(page_rate("html")).first()[0]
    assert got == str(rate)
