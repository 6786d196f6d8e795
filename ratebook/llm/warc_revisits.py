"""Resolution of not-modified revisit records.

A crawl that gets "304 Not Modified" writes a revisit record without a payload.  It stands for the
latest earlier full response of the same canonical URL -- if the validators agree.  The join is an
as-of join: records are range-partitioned by (canonical URL, time, record), so a URL with a third of
all captures spreads over many partitions; a window finds the last full response within (partition,
URL), and a URL that goes on from an earlier partition gets that partition's last response as a
carry.  A partition edge splits one URL at most, so there are fewer carries than partitions.

The outcome is ``resolved``; ``mismatch`` (the latest earlier response has other validators, so the
payload it stands for is not in the archive); ``unvalidated`` (no validator on one side); or
``missing`` (no earlier response).  A strong or weak ETag is compared weakly (RFC 9110); without
ETags on both sides, Last-Modified decides.  Headers of a resolved record are the response's, with
those that a 304 may update (``PERMITTED``) taken from the revisit.

Records at the same time follow the record id; a response counts as earlier if it sorts before.
Null URLs are a URL of their own, null times come first, null headers are empty.  Repeated rows are
records each.  Header names are compared in lower case; the last of repeated names counts.  Extra
columns are left out of the result.  URLs of any length are walked in linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebook.llm.common import LOWER, UPPER, scratch, shuffle_partitions, staged
from ratebook.sources.tables import table

# Headers a 304 response may update, and tracking parameters that do not tell pages apart.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = ("ref", "utm_source")
FULL, REVISIT = "response", "revisit"


def canonical_url(url: Column) -> Column:
    """Scheme and ``www.`` dropped, host lower-cased, no default port, fragment or tracking parameters,
    no slash at the end."""
    bare = F.regexp_replace(F.substring_index(url, "#", 1), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.translate(F.regexp_extract(bare, r"^[^/?]*", 0), UPPER, LOWER), r"^www\.|:(80|443)$", "")
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    # possessive, so a URL of any number of parameters is walked without recursion
    rest = F.regexp_replace(rest, rf"([?&])(?:(?:{'|'.join(TRACKING)})=[^&]*+(?:&|$))++", "$1")
    return F.rtrim(F.concat(host, rest), F.lit("/?&"))


def _lowered(headers: Column) -> Column:
    """Header names in lower case; of repeated names the last stays."""
    h = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
                    lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(h, lambda e, i: ~F.exists(F.slice(h, i + 2, F.size(h)), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def _etag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Revisit rows of ``records`` (record_id, url, ts, kind, headers map) resolved: record_id, url_key,
    ts, status, refers_to, headers (merged if resolved, else the revisit's own)."""
    spark = records.sparkSession
    rows = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "kind", _lowered(F.col("headers")).alias("headers"))
    order = ["url_key", "ts", "record_id"]
    # the edges between ranges may fall inside a URL; equal (url, ts, record) stay together
    dealt = rows.repartitionByRange(shuffle_partitions(spark), *order).withColumn("part", F.spark_partition_id())
    local = staged(dealt, scratch(spark, "records"))
    full = F.when(F.col("kind") == FULL, F.struct("record_id", "headers"))
    here = Window.partitionBy("part", "url_key").orderBy("ts", "record_id", "kind")
    seen = local.withColumn("base", F.last(full, ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, -1)))
    ends = local.groupBy("part", "url_key").agg(
        F.max_by(full, F.when(F.col("kind") == FULL, F.struct("ts", "record_id"))).alias("last"))
    # of URLs in several parts: the last full response before each part
    w = Window.partitionBy("url_key")
    spans = ends.withColumn("parts", F.count(F.lit(1)).over(w)).where("parts > 1")
    before = w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = spans.select("part", "url_key", F.last("last", ignorenulls=True).over(before).alias("carry")).where("carry IS NOT NULL")
    joined = seen.where(F.col("kind") == REVISIT).alias("r").join(
        F.broadcast(carry).alias("c"), (F.col("r.part") == F.col("c.part")) & F.col("r.url_key").eqNullSafe(F.col("c.url_key")), "left")
    base = F.coalesce("base", "carry")
    out = joined.select("r.record_id", "r.url_key", "r.ts", F.col("r.headers").alias("own"), base.alias("b"))
    mine, theirs = _etag(F.col("own")), _etag(F.col("b.headers"))
    dates = F.col("own")["last-modified"], F.col("b.headers")["last-modified"]
    status = (F.when(F.col("b").isNull(), "missing")
              .when(mine.isNotNull() & theirs.isNotNull(), F.when(mine == theirs, "resolved").otherwise("mismatch"))
              .when(dates[0].isNotNull() & dates[1].isNotNull(), F.when(dates[0] == dates[1], "resolved").otherwise("mismatch"))
              .otherwise("unvalidated"))
    updates = F.map_filter("own", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("b.headers", lambda k, v: ~F.map_contains_key(updates, k)), updates)
    out = out.withColumn("status", status)
    done = F.col("status") == "resolved"
    return out.select("record_id", "url_key", "ts", "status", F.when(done, F.col("b.record_id")).alias("refers_to"),
                      F.when(done, merged).otherwise(F.col("own")).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """A crawl history from ``pages``: each page is fetched once (but every seventh never in full) and
    revisited page_id mod 4 times, some with an old validator and some under another spelling of its URL.
    A page without an id has no record id to give its captures and makes none."""
    p = pages.where("page_id IS NOT NULL").select(
        "page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    each = p.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.pmod("page_id", F.lit(4)))).alias("k"))
    each = each.where(~((F.col("k") == 0) & (F.pmod("page_id", F.lit(7)) == 0)))
    revisit = F.col("k") > 0
    stale = revisit & (F.pmod(F.col("page_id") + F.col("k"), F.lit(5)) == 0)
    tag = F.concat(F.when(F.col("k") == 2, "W/").otherwise(""), F.lit('"'), F.when(stale, "old").otherwise(F.col("digest")), F.lit('"'))
    ts = F.col("page_id") * 100 + F.col("k") * 7919
    common = F.create_map(F.lit("ETag"), tag, F.lit("Date"), ts.cast("string"))
    extra = F.when(revisit, F.create_map(F.lit("Cache-Control"), F.concat(F.lit("max-age="), F.col("k").cast("string")), F.lit("Content-Length"), F.lit("0"))) \
        .otherwise(F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("size").cast("string")))
    url = F.when(F.col("k") == 1, F.concat("url", F.lit("#again"))).otherwise(F.col("url"))
    return each.select((F.col("page_id") * 4 + F.col("k")).alias("record_id"), url.alias("url"), ts.alias("ts"),
                       F.when(revisit, REVISIT).otherwise(FULL).alias("kind"), F.map_concat(common, extra).alias("headers"))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, sf_dir, "pages", "page_id", "url", "html")))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return found.select("record_id", "url_key", "ts", "status", "refers_to", text.alias("headers"))


_BARE = "regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
ORACLE = f"""
WITH p AS (SELECT page_id, url, md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size
           FROM pages WHERE page_id IS NOT NULL),
e AS (SELECT p.*, k FROM p, unnest(range(0, page_id % 4 + 1)) AS t(k) WHERE NOT (k = 0 AND page_id % 7 = 0)),
r AS (
  SELECT page_id * 4 + k AS record_id, page_id * 100 + k * 7919 AS ts, k > 0 AS revisit, size, k,
         '"' || CASE WHEN k > 0 AND (page_id + k) % 5 = 0 THEN 'old' ELSE digest END || '"' AS tag,
         regexp_replace(
           regexp_replace(translate(regexp_extract({_BARE}, '^[^/?]*'), '{UPPER}', '{LOWER}'), '^www\\.|:(80|443)$', '', 'g')
           || regexp_replace(regexp_extract({_BARE}, '^[^/?]*(.*)$', 1), '([?&])(?:(?:{'|'.join(TRACKING)})=[^&]*(?:&|$))+', '\\1', 'g'),
           '[/?&]+$', '') AS url_key
  FROM e),
j AS (SELECT r.record_id, r.url_key, r.ts, r.k, r.tag, f.record_id AS base, f.tag AS base_tag, f.size
      FROM r LEFT JOIN LATERAL (
        SELECT record_id, tag, size FROM r f WHERE NOT f.revisit AND f.url_key = r.url_key AND (f.ts, f.record_id) < (r.ts, r.record_id)
        ORDER BY f.ts DESC, f.record_id DESC LIMIT 1) f ON true
      WHERE r.revisit)
SELECT record_id, url_key, ts,
       CASE WHEN base IS NULL THEN 'missing' WHEN tag = base_tag THEN 'resolved' ELSE 'mismatch' END AS status,
       CASE WHEN tag = base_tag THEN base END AS refers_to,
       'cache-control: max-age=' || k || chr(10) || 'content-length: ' || CASE WHEN tag = base_tag THEN size ELSE 0 END
       || CASE WHEN tag = base_tag THEN chr(10) || 'content-type: text/html' ELSE '' END
       || chr(10) || 'date: ' || ts || chr(10) || 'etag: ' || CASE WHEN k = 2 THEN 'W/' ELSE '' END || tag AS headers
FROM j
"""
