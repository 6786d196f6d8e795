"""DuckDB twins of the registered queries (``oracle_sql()``).

Written independently of the Spark plans, in plain SQL over the driver's
views.  Where DuckDB's decimal division returns DOUBLE the result is rounded
to five decimals and cast to DECIMAL(18,5) before it is shown as text.
"""

from __future__ import annotations

from ratebook.plans import catalog

_TL = ", ".join(f"('{t}', {i})" for i, t in enumerate(catalog.TARGETS))
_RARE = ", ".join(f"('{t}', {i})" for i, t in enumerate(catalog.proxies.RARE_NATIONS))
_RUN = catalog.RUN_DATE.strftime("%Y-%m-%d")
_RUN_TXT = catalog.RUN_DATE.strftime("%Y%m%d")
_BASE = "TWD"


def f5(x: str) -> str:
    return f"CAST(CAST(round({x}, 5) AS DECIMAL(18,5)) AS VARCHAR)"


def q4(x: str) -> str:
    """Money -> DECIMAL(18,2) -> /100 as DECIMAL(18,4)."""
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,4))"


def ymd(x: str) -> str:
    return f"strftime({x}, '%Y%m%d')"


def _po() -> str:
    return ("po AS (SELECT c.c_nationkey, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_date, "
            "o.o_totalprice FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)")


def _quotes(period: str = catalog.PERIOD) -> str:
    return f"""{_po()},
items AS (
  SELECT {ymd('p.ps')} AS period, CAST(n.n_nationkey AS INTEGER) AS pos, n.n_name AS code,
         CAST({q4('p.lo')} AS VARCHAR) AS buyValue, CAST({q4('p.hi')} AS VARCHAR) AS sellValue,
         {ymd('p.ps')} AS start, {ymd('p.last_date')} AS "end"
  FROM (SELECT c_nationkey, date_trunc('{period}', order_date) AS ps, min(o_totalprice) AS lo,
               max(o_totalprice) AS hi, max(order_date) AS last_date
        FROM po GROUP BY c_nationkey, date_trunc('{period}', order_date)) p
  JOIN nation n ON p.c_nationkey = n.n_nationkey),
quotes AS (
  SELECT period, pos, code AS from_curr, CAST(buyValue AS DECIMAL(18,10)) AS buyValue,
         CAST(sellValue AS DECIMAL(18,10)) AS sellValue, start, "end",
         CAST((CAST(buyValue AS DECIMAL(18,10)) + CAST(sellValue AS DECIMAL(18,10))) * 0.5
              AS DECIMAL(18,10)) AS fx_rate,
         '{_BASE}' AS to_curr
  FROM items)"""


_CFG = f"""cfg AS (SELECT * FROM (VALUES {_TL}) t(to_curr, t_pos)),
tl AS (SELECT to_curr, CAST(t_pos AS INTEGER) AS t_pos FROM cfg WHERE to_curr <> '{_BASE}')"""

_CROSS = """tm AS (SELECT period, from_curr AS to_curr, arg_min(fx_rate, pos) AS target_mid
       FROM quotes WHERE from_curr IN (SELECT to_curr FROM tl) GROUP BY period, from_curr),
xr AS (SELECT q.period, q.from_curr, t.to_curr, CAST(q.sellValue AS DOUBLE) / CAST(m.target_mid AS DOUBLE) AS fx_rate,
              q.start, q."end"
       FROM quotes q JOIN tm m ON q.period = m.period JOIN tl t ON t.to_curr = m.to_curr),
mr AS (SELECT period, from_curr, to_curr, CAST(fx_rate AS DOUBLE) AS fx_rate, start, "end" FROM quotes),
au AS (SELECT * FROM mr UNION ALL SELECT * FROM xr),
ar AS (SELECT * FROM au WHERE from_curr <> to_curr)"""

_REF = f"""ref AS (
  SELECT DATE '{_RUN}' AS rate_date, a.n_name AS from_curr,
         CASE WHEN k.to_key = 25 THEN '{_BASE}' ELSE b.n_name END AS to_curr,
         CAST(power(10, a.n_regionkey % 3) AS DECIMAL(9,0)) AS from_factor,
         CAST(CASE WHEN (a.n_nationkey + k.to_key) % 7 = 0 THEN 0 ELSE 1 END AS DECIMAL(18,5)) AS kursf,
         CAST(1 AS DECIMAL(9,0)) AS to_factor
  FROM nation a CROSS JOIN (SELECT range AS to_key FROM range(0, 26)) k
  LEFT JOIN nation b ON b.n_nationkey = k.to_key
  WHERE (a.n_nationkey + k.to_key) % 11 <> 0 AND (k.to_key = 25 OR b.n_name IS NOT NULL)),
snap AS (SELECT from_curr, to_curr, from_factor AS from_ratio, kursf AS ref_rate, to_factor AS to_ratio
         FROM ref WHERE rate_date = DATE '{_RUN}')"""


def _enrich(src: str) -> str:
    return f"""en AS (
  SELECT r.*, coalesce(s.from_ratio, CAST(1 AS DECIMAL(9,0))) AS from_ratio,
         coalesce(s.ref_rate, CAST(0 AS DECIMAL(18,5))) AS ref_rate,
         coalesce(s.to_ratio, CAST(1 AS DECIMAL(9,0))) AS to_ratio
  FROM {src} r LEFT JOIN snap s ON r.from_curr = s.from_curr AND r.to_curr = s.to_curr),
kn AS (SELECT * FROM en WHERE ref_rate <> 0),
sc AS (SELECT *, {f5('fx_rate * CAST(from_ratio AS DOUBLE)')} AS fx_rate_with_ratio FROM kn)"""


def _erp(valid_from: str) -> str:
    return f"""SELECT from_curr AS FROM_CURR, to_curr AS TO_CURRNCY, fx_rate_with_ratio AS EXCH_RATE,
       {valid_from} AS VALID_FROM, '{{rt}}' AS RATE_TYPE, '1' AS FROM_FACTOR, '1' AS TO_FACTOR,
       '1.00000' AS EXCH_RATE_V, '1' AS FROM_FACTOR_V, '1' AS TO_FACTOR_V FROM sc"""


_VF_M = "strftime(strptime(start, '%Y%m%d'), '%Y%m%d')"
_VF_V = "strftime(last_day(CAST(strptime(\"end\", '%Y%m%d') AS DATE)), '%Y%m%d')"

_NMID = f"""nm AS (
  SELECT n.n_name AS name,
         CAST(({q4('p.lo')} + {q4('p.hi')}) * 0.5 AS DECIMAL(18,10)) AS mid
  FROM (SELECT c_nationkey, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM po GROUP BY c_nationkey) p
  JOIN nation n ON p.c_nationkey = n.n_nationkey),
rg AS (SELECT r.from_curr, t.to_curr, CAST(r.c_pos AS INTEGER) AS c_pos, CAST(t.t_pos AS INTEGER) AS t_pos
       FROM (VALUES {_RARE}) r(from_curr, c_pos) CROSS JOIN (VALUES {_TL}) t(to_curr, t_pos)),
rt AS (
  SELECT rg.from_curr, rg.to_curr, rg.c_pos, rg.t_pos,
         CASE WHEN rg.from_curr = 'NATION_22' AND rg.to_curr = 'NATION_3' THEN ''
              WHEN rg.from_curr = 'NATION_24' AND rg.to_curr = 'NATION_2' THEN '-'
              WHEN rg.to_curr = '{_BASE}' THEN CAST(CAST(round(a.mid, 4) AS DECIMAL(18,4)) AS VARCHAR)
              ELSE CAST(CAST(round(CAST(a.mid AS DOUBLE) / CAST(b.mid AS DOUBLE), 4) AS DECIMAL(18,4)) AS VARCHAR)
         END AS fx_rate
  FROM rg JOIN nm a ON a.name = rg.from_curr LEFT JOIN nm b ON b.name = rg.to_curr)"""

_PAGES = f"""{_NMID},
cp AS (SELECT 'https://converter.example.com/en/?from=' || from_curr || '&to=' || to_curr || '&amount=1' AS url,
              '<html><body><form><input name="numberformat" tabindex="3" value="1">'
              || CASE WHEN to_curr = '{_BASE}'
                      THEN '<input tabindex="4" value="' || fx_rate || '" class="rate" name="numberformat">'
                      ELSE '<input name="numberformat" tabindex="4" value="' || fx_rate || '">' END
              || '</form></body></html>' AS html
       FROM rt),
ap AS (SELECT url, html FROM pages UNION ALL SELECT url, html FROM cp),
px AS (SELECT regexp_extract(url, '[?&]from=([^&#]*)', 1) AS from_curr,
              regexp_extract(url, '[?&]to=([^&#]*)', 1) AS to_curr,
              regexp_extract(list_filter(regexp_extract_all(html, '<input\\b[^>]*>'),
                                         lambda t: regexp_matches(t, '\\sname="numberformat"')
                                              AND regexp_matches(t, '\\stabindex="4"'))[1],
                             '\\svalue="([^"]*)"', 1) AS fx_rate
       FROM ap),
pq AS (SELECT from_curr, to_curr, fx_rate, '{_RUN_TXT}' AS start, '{_RUN_TXT}' AS "end" FROM px
       WHERE from_curr <> '' AND to_curr <> '' AND fx_rate <> '' AND fx_rate <> '-'),
rr AS (SELECT start AS period, from_curr, to_curr, CAST(fx_rate AS DECIMAL(18,10)) AS fx_rate, start, "end" FROM pq)"""

_CAPTURES = f"""rare AS (SELECT * FROM (VALUES {_RARE}) t(name, c_pos)),
cfg AS (SELECT * FROM (VALUES {_TL}) t(to_curr, t_pos)),
shots AS (SELECT date_trunc('{catalog.PERIOD}', po.order_date) AS ps, n.n_name AS from_curr, cfg.to_curr, po.order_date, po.o_orderkey,
                 CASE WHEN po.o_orderkey % 13 = 0 THEN '' WHEN po.o_orderkey % 17 = 0 THEN '-'
                      ELSE CAST({q4('po.o_totalprice')} AS VARCHAR) END AS fx_rate
          FROM po JOIN nation n ON n.n_nationkey = po.c_nationkey JOIN rare ON rare.name = n.n_name
          JOIN cfg ON cfg.t_pos = po.o_orderkey % {len(catalog.TARGETS)}),
newest AS (SELECT * FROM shots
           QUALIFY row_number() OVER (PARTITION BY ps, from_curr, to_curr ORDER BY order_date DESC, o_orderkey DESC) = 1),
cq AS (SELECT from_curr, to_curr, fx_rate, {ymd('ps')} AS start, {ymd('order_date')} AS "end" FROM newest WHERE fx_rate NOT IN ('', '-')),
rr AS (SELECT start AS period, from_curr, to_curr, CAST(fx_rate AS DECIMAL(18,10)) AS fx_rate, start, "end" FROM cq)"""

_RATES3 = "period, from_curr, to_curr"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _bpm() -> str:
    return f"""bpm AS (SELECT from_curr AS Currency, to_curr AS Currency2,
              CAST(round(fx_rate, 5) AS DECIMAL(18,5)) AS Rate,
              strftime(strptime(start, '%Y%m%d'), '%Y-%m-%d') AS RateDate
       FROM quotes WHERE to_curr = '{_BASE}')"""


def _orders_dates() -> str:
    return "od AS (SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS order_date FROM orders)"


def build() -> dict[str, str]:
    Q = _quotes()
    sql: dict[str, str] = {}
    sql["quote_mid"] = _with(Q) + f"""SELECT period, pos, from_curr, to_curr,
  CAST(CAST(buyValue AS DECIMAL(18,4)) AS VARCHAR) AS buyValue,
  CAST(CAST(sellValue AS DECIMAL(18,4)) AS VARCHAR) AS sellValue,
  {f5('fx_rate')} AS fx_rate, start, "end" FROM quotes"""
    sql["self_pair_filter"] = _with(Q, _CFG, _CROSS) + f"SELECT {_RATES3}, {f5('fx_rate')} AS fx_rate FROM ar"
    sql["all_rates_union"] = _with(Q, _CFG, _CROSS) + f"SELECT {_RATES3}, {f5('fx_rate')} AS fx_rate FROM au"
    sql["cross_rates"] = _with(Q, _CFG, _CROSS) + f"SELECT {_RATES3}, {f5('fx_rate')} AS fx_rate FROM xr"
    sql["target_mid_first"] = _with(Q, _CFG, _CROSS) + f"SELECT period, to_curr, {f5('target_mid')} AS target_mid FROM tm"
    sql["target_list"] = _with(Q, _CFG) + """SELECT t.to_curr, t.t_pos, CAST(coalesce(c.n, 0) AS BIGINT) AS periods_quoted
FROM tl t LEFT JOIN (SELECT from_curr, count(DISTINCT period) AS n FROM quotes GROUP BY from_curr) c
ON c.from_curr = t.to_curr"""
    sql["rare_pair_grid"] = _with(_po(), _NMID) + "SELECT from_curr, to_curr, c_pos, t_pos, fx_rate FROM rt"
    sql["ref_enrich_left"] = _with(Q, _CFG, _CROSS, _REF, _enrich("ar")) + f"""SELECT {_RATES3}, {f5('fx_rate')} AS fx_rate,
  CAST(from_ratio AS BIGINT) AS from_ratio, CAST(ref_rate AS VARCHAR) AS ref_rate, CAST(to_ratio AS BIGINT) AS to_ratio FROM en"""
    sql["ref_known_pairs"] = _with(Q, _CFG, _CROSS, _REF, _enrich("ar")) + f"""SELECT {_RATES3}, {f5('fx_rate')} AS fx_rate,
  CAST(from_ratio AS BIGINT) AS from_ratio FROM kn"""
    sql["scaled_rates"] = _with(Q, _CFG, _CROSS, _REF, _enrich("ar")) + f"""SELECT {_RATES3}, {f5('fx_rate')} AS fx_rate,
  CAST(from_ratio AS BIGINT) AS from_ratio, fx_rate_with_ratio FROM sc"""
    sql["month_end"] = _with(_orders_dates()) + """SELECT o_orderkey, order_date,
  strftime(last_day(CAST(strptime(order_date, '%Y%m%d') AS DATE)), '%Y%m%d') AS month_end FROM od"""
    sql["date_reformat"] = _with(_orders_dates()) + """SELECT o_orderkey,
  strftime(strptime(order_date, '%Y%m%d'), '%Y%m%d') AS valid_date,
  strftime(strptime(order_date, '%Y%m%d'), '%Y-%m-%d') AS iso_date FROM od"""
    sql["erp_layout_m"] = _with(Q, _CFG, _CROSS, _REF, _enrich("ar")) + _erp(_VF_M).replace("{rt}", "M")
    sql["erp_layout_v"] = _with(Q, _CFG, _CROSS, _REF, _enrich("ar")) + _erp(_VF_V).replace("{rt}", "V")
    sql["page_quotes"] = _with(_po(), _PAGES) + 'SELECT from_curr, to_curr, fx_rate, start, "end" FROM pq'
    sql["rare_erp_m"] = _with(_po(), _PAGES, _REF, _enrich("rr")) + _erp(_VF_M).replace("{rt}", "M")
    sql["rare_erp_v"] = _with(_po(), _PAGES, _REF, _enrich("rr")) + _erp(_VF_V).replace("{rt}", "V")
    sql["capture_quotes"] = _with(_po(), _CAPTURES) + 'SELECT from_curr, to_curr, fx_rate, start, "end" FROM cq'
    sql["rare_history_m"] = _with(_po(), _CAPTURES, _REF, _enrich("rr")) + _erp(_VF_M).replace("{rt}", "M")
    sql["rare_history_v"] = _with(_po(), _CAPTURES, _REF, _enrich("rr")) + _erp(_VF_V).replace("{rt}", "V")
    sql["bpm_layout"] = _with(Q, _bpm()) + "SELECT Currency, Currency2, CAST(Rate AS VARCHAR) AS Rate, RateDate FROM bpm"
    sql["bpm_merge"] = _with(Q, _bpm()) + f""",
tgt AS (SELECT * FROM bpm WHERE quarter(CAST(RateDate AS DATE)) % 2 = 0),
lastq AS (SELECT Currency, max(year(CAST(RateDate AS DATE))) AS maxy, max(RateDate) AS maxd
          FROM bpm GROUP BY Currency),
batch AS (
  SELECT b.Currency, b.Currency2, b.Rate + 0.50000 AS Rate, b.RateDate, 0 AS seq
  FROM bpm b JOIN lastq l ON b.Currency = l.Currency AND year(CAST(b.RateDate AS DATE)) = l.maxy
  UNION ALL
  SELECT b.Currency, b.Currency2, b.Rate + 1.00000 AS Rate, b.RateDate, 1 AS seq
  FROM bpm b JOIN lastq l ON b.Currency = l.Currency AND b.RateDate = l.maxd
  WHERE b.Currency = '{catalog.MERGE_REPEAT_CURRENCY}'),
src AS (SELECT Currency, Currency2, RateDate, Rate FROM (
  SELECT *, row_number() OVER (PARTITION BY Currency, Currency2, RateDate ORDER BY seq DESC) AS rn FROM batch) WHERE rn = 1)
SELECT coalesce(s.Currency, t.Currency) AS Currency, coalesce(s.Currency2, t.Currency2) AS Currency2,
       CAST(CAST(coalesce(s.Rate, t.Rate) AS DECIMAL(18,5)) AS VARCHAR) AS Rate,
       coalesce(s.RateDate, t.RateDate) AS RateDate
FROM tgt t FULL OUTER JOIN src s
  ON t.Currency = s.Currency AND t.Currency2 = s.Currency2 AND t.RateDate = s.RateDate"""
    gap_list = ", ".join(f"('{t}')" for t in catalog.GAP_TARGETS)
    sql["completeness_gaps"] = _with(_quotes(catalog.GAP_PERIOD)) + f""",
want AS (SELECT p.period, t.to_curr FROM (SELECT DISTINCT period FROM quotes) p
         CROSS JOIN (VALUES {gap_list}) t(to_curr))
SELECT w.period, w.to_curr FROM want w
WHERE NOT EXISTS (SELECT 1 FROM quotes q WHERE q.period = w.period AND q.from_curr = w.to_curr)"""
    sql["invalid_rates"] = """WITH rt AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P'
           THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
           ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS Rate
  FROM orders)
SELECT o_orderkey, Rate FROM rt WHERE Rate IS NOT NULL AND TRY_CAST(Rate AS DECIMAL(18,5)) IS NULL"""
    sql["newest_quote"] = _with(_po()) + f""",
r AS (SELECT {ymd("date_trunc('quarter', p.order_date)")} AS period, n.n_name AS from_curr, p.order_date,
             p.o_orderkey, CAST({q4('p.o_totalprice')} AS VARCHAR) AS value,
             row_number() OVER (PARTITION BY date_trunc('quarter', p.order_date), n.n_name
                                ORDER BY p.order_date DESC, p.o_orderkey DESC) AS rn
      FROM po p JOIN nation n ON p.c_nationkey = n.n_nationkey)
SELECT period, from_curr, value, o_orderkey, {ymd('order_date')} AS last_date FROM r WHERE rn = 1"""
    sql["run_counts"] = _with(Q, _CFG, _CROSS, _REF, _enrich("ar")) + """SELECT 'quotes' AS stage, CAST(count(*) AS BIGINT) AS rows FROM quotes
UNION ALL SELECT 'cross_rates', count(*) FROM xr
UNION ALL SELECT 'all_rates', count(*) FROM ar
UNION ALL SELECT 'known_pairs', count(*) FROM kn
UNION ALL SELECT 'erp_rows', count(*) FROM sc"""
    sql["local_run_stamp"] = f"""WITH e AS (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Taipei' AS lt FROM events)
SELECT event_id, strftime(lt, '%Y-%m-%d %H:%M:%S') AS local_time, strftime(lt, '%Y%m%d_%H%M') AS stamp,
       'FinalData__{catalog.EXPORT_JOB}__' || strftime(lt, '%Y%m%d_%H%M') AS export_file FROM e"""
    conds = " OR ".join(
        f"(CAST(o_orderdate AS DATE) BETWEEN strptime('{lo}', '%Y%m%d') AND strptime('{hi}', '%Y%m%d'))"
        for _, _, lo, hi in catalog.FLIGHT_RANGES)
    eq = " AND ".join(f"{c} = '{v}'" for c, v in catalog.FLIGHT_EQUALS.items() if v != "*") or "TRUE"
    sql["range_select"] = f"""WITH sel AS (
  SELECT * FROM orders WHERE ({conds}) AND {eq} ORDER BY o_orderkey LIMIT {catalog.FLIGHT_MAX_ROWS})
SELECT s.o_orderkey, strftime(CAST(s.o_orderdate AS DATE), '%Y%m%d') AS flight_date, s.o_orderpriority,
       CAST({q4('s.o_totalprice')} AS VARCHAR) AS price, c.c_name
FROM sel s JOIN customer c ON s.o_custkey = c.c_custkey"""
    sql["range_table_select"] = f"""WITH s AS (
  SELECT user_id, CAST(ts AS DATE) AS lo, CAST(ts AS DATE) + CAST(event_id % {catalog.SIGNUP_DAYS} AS INTEGER) AS hi
  FROM events WHERE event_type = 'signup')
SELECT event_id, user_id, event_type, {ymd('ts')} AS day FROM events e
WHERE EXISTS (SELECT 1 FROM s WHERE s.user_id = e.user_id AND CAST(e.ts AS DATE) BETWEEN lo AND hi)"""
    sql["range_calendar_select"] = f"""WITH s AS (
  SELECT DATE '{catalog.CALENDAR_START}' + CAST(event_id * 7 % {catalog.CALENDAR_DAYS} AS INTEGER) AS lo, user_id % {catalog.SIGNUP_DAYS} AS more
  FROM events WHERE event_type = 'signup'),
days AS (SELECT DISTINCT lo + CAST(unnest(range(0, more + 1)) AS INTEGER) AS day FROM s)
SELECT o_orderkey, {ymd('o_orderdate')} AS flight_date FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT day FROM days)"""
    sql["call_metrics"] = """WITH c AS (
  SELECT user_id AS connection, ts, event_id AS call_id,
         CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS r,
         CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS total_ms,
         length(props) AS sent_bytes, CAST(floor(CAST(value AS DECIMAL(18,2)) * 10) AS BIGINT) AS recv_bytes
  FROM events),
e AS (SELECT *, sum(r) OVER (PARTITION BY connection ORDER BY ts, call_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reset_epoch FROM c)
SELECT connection, CAST(reset_epoch AS BIGINT) AS reset_epoch,
       CAST(sum(1 - r) AS BIGINT) AS calls,
       CAST(sum(CASE WHEN r = 0 THEN total_ms ELSE 0 END) AS BIGINT) AS total_ms,
       CAST(sum(CASE WHEN r = 0 THEN total_ms % 7 ELSE 0 END) AS BIGINT) AS ser_ms,
       CAST(sum(CASE WHEN r = 0 THEN total_ms % 5 ELSE 0 END) AS BIGINT) AS deser_ms,
       CAST(sum(CASE WHEN r = 0 THEN total_ms - total_ms % 7 - total_ms % 5 ELSE 0 END) AS BIGINT) AS app_ms,
       CAST(sum(CASE WHEN r = 0 THEN sent_bytes ELSE 0 END) AS BIGINT) AS sent_bytes,
       CAST(sum(CASE WHEN r = 0 THEN recv_bytes ELSE 0 END) AS BIGINT) AS recv_bytes
FROM e GROUP BY connection, reset_epoch"""
    sql["normalize_records"] = """WITH raw AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber = 7 THEN substr(strftime(CAST(l_shipdate AS DATE), '%Y%m%d'), 1, 6) || '32'
              ELSE strftime(CAST(l_shipdate AS DATE), '%Y%m%d') END AS ship,
         rpad(l_returnflag, 10, ' ') AS flag,
         lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS line,
         CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS price
  FROM lineitem),
t AS (SELECT *, CAST(try_strptime(ship, '%Y%m%d') AS DATE) AS ship_d,
             TRY_CAST(price AS DECIMAL(15,2)) AS price_d,
             CASE WHEN regexp_full_match(line, '[0-9]+') THEN TRY_CAST(line AS DECIMAL(6,0)) END AS line_d
      FROM raw)
SELECT l_orderkey, l_linenumber, strftime(ship_d, '%Y-%m-%d') AS ship, rtrim(flag) AS flag,
       CAST(line_d AS BIGINT) AS line, CAST(price_d AS VARCHAR) AS price,
       concat_ws(',', CASE WHEN ship IS NOT NULL AND ship_d IS NULL THEN 'ship' END,
                      CASE WHEN line IS NOT NULL AND line_d IS NULL THEN 'line' END,
                      CASE WHEN price IS NOT NULL AND price_d IS NULL THEN 'price' END) AS errors
FROM t"""
    sql["normalize_record_types"] = f"""WITH raw AS (
  SELECT *, {ymd('l_shipdate')} AS day, l_extendedprice::DECIMAL(15,2) AS price, CAST(CAST(price * 100 AS BIGINT) AS VARCHAR) AS cents,
         rtrim(cents, '0') AS kept, l_suppkey % 61 = 60 AS bad_t, l_linenumber = 7 AS bad_d, l_quantity * 6 > 255 AS bad_i,
         -2 + length(cents) - length(kept) AS shift, l_linenumber - 6180 + shift < -6176 AS bad_f, l_linenumber = 5 AS bad_x,
         l_linenumber = 6 AS bad_mark, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS iso
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_returnflag AS c, l_linestatus AS s, CASE WHEN NOT bad_d THEN iso END AS d,
       CASE WHEN NOT bad_t THEN printf('%02d%02d%02d', l_orderkey % 24, l_partkey % 60, l_suppkey % 61) END AS t,
       CAST(l_linenumber AS BIGINT) AS n, CAST(price AS VARCHAR) AS b,
       CAST(kept AS BIGINT) AS f16_coefficient, CAST(l_linenumber * 3 - 20 + shift AS INTEGER) AS f16_exponent,
       CASE WHEN NOT bad_f THEN -CAST(kept AS BIGINT) END AS f34_coefficient,
       CASE WHEN NOT bad_f THEN CAST(l_linenumber - 6180 + shift AS INTEGER) END AS f34_exponent,
       CASE WHEN NOT bad_i THEN CAST(l_quantity * 6 AS INTEGER) END AS i, CAST(l_discount::DECIMAL(4,2) AS DOUBLE) AS f,
       CASE WHEN NOT bad_x THEN hex(l_returnflag || l_linestatus) END AS x, hex(day) AS xs,
       CASE WHEN NOT bad_d THEN iso END AS st_d, CAST(l_linenumber AS BIGINT) AS st_n, 2 AS tb_size, CAST(price AS VARCHAR) AS tb_price,
       CASE WHEN NOT bad_mark THEN hex(l_returnflag) END AS tb_mark,
       concat_ws(',', CASE WHEN bad_d THEN 'd' END, CASE WHEN bad_t THEN 't' END, CASE WHEN bad_f THEN 'f34' END, CASE WHEN bad_i THEN 'i' END,
                 CASE WHEN bad_x THEN 'x' END, CASE WHEN bad_d THEN 'st' END, CASE WHEN bad_mark THEN 'tb' END) AS errors
FROM raw"""
    sql["flatten_deep_table"] = """WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS arr,
                  rpad(coalesce(source, ''), 10, ' ') AS c FROM documents),
u AS (SELECT doc_id, c, unnest(arr) AS line, unnest(generate_series(1, len(arr))) AS line_no FROM d)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(line_no AS INTEGER) AS I, c AS C,
       CASE WHEN length(line) <= 256 THEN line END AS STR,
       CASE WHEN octet_length(encode(line)) <= 128 THEN hex(line) END AS XSTR
FROM u"""
    return sql


ORACLE_SQL = build()
