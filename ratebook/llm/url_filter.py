"""URL filtering by host rules and an exact Bloom filter cascade.

A Bloom filter over the listed keys answers "maybe" for some keys that are not listed.  When the
complete universe of keys that will ever be asked is known -- here every host of the corpus --
those false positives can be listed themselves: level 2 encodes them, level 3 encodes the listed
keys that level 2 lets through by mistake, and so on until a level has nothing left to encode.
A key's answer is the parity of the first level that rejects it, which is exact on the universe.

Everything is built with DataFrame aggregations (``bit_or`` of bit positions per 64-bit word).
The filters are literals of bounded size: when the listed keys, or the unlisted ones that level 1
is expected to let through, need more than ``max_bits`` bits, keys are split by hash into shards
whose levels stay below it and are judged in one pass each.

Nulls: a null key is not part of the universe and is judged like the empty key.  Repeated keys
count once; a key that is both listed and not listed counts as listed.  An empty list gives an
empty cascade that lists nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm.common import LOWER, UPPER, scratch, staged
from ratebook.sources.tables import table

BITS_PER_KEY = 10
HASHES = 5
MAX_BITS = 1 << 23          # one shard's largest filter: 1 MiB
MIN_BITS = 256              # floor of a level's filter
MAX_LEVELS = 64

# The rules of the registered query, (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Host labels whose hosts are listed for blocking in the registered query.
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what follows the first ``://``; both empty without one or for null."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; both null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):   # the longest is applied last
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _hashes(key: Column) -> tuple[Column, Column, Column]:
    """Two 64-bit hashes of a key, and the one that deals keys to shards."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key), F.xxhash64(F.lit("shard"), key)


def _positions(h1: Column, h2: Column, level: int, n_bits: int) -> list[Column]:
    """The bit positions of a key in a level's filter (double hashing, seeded by the level)."""
    mask = F.lit(0x7FFFFFFF).cast("bigint")
    a = F.xxhash64(h1, h2, F.lit(level)).bitwiseAND(mask)
    b = F.xxhash64(h2, h1, F.lit(level)).bitwiseAND(mask)
    return [F.pmod(a + b * F.lit(i), F.lit(n_bits).cast("bigint")) for i in range(HASHES)]


@dataclass
class Level:
    """One Bloom filter: ``words`` are its bits, 64 to a word."""
    number: int
    n_bits: int
    n_keys: int
    words: list[int]

    def passes(self, h1: Column, h2: Column) -> Column:
        # One string literal, folded to an array literal by the optimizer: cheaper to ship than one literal a word.
        bits = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        hit = F.lit(True)
        for p in _positions(h1, h2, self.number, self.n_bits):
            word = F.get(bits, F.shiftright(p, 6).cast("int"))
            hit = hit & (F.getbit(word, p.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1)
        return hit


@dataclass
class Cascade:
    """The levels of each shard; ``listed(key)`` is exact for every key of the universe."""
    shards: list[list[Level]] = field(default_factory=list)

    @property
    def n_shards(self) -> int:
        return len(self.shards)

    def listed_in(self, shard: int, h1: Column, h2: Column) -> Column:
        answer: Column | None = None
        for level in reversed(self.shards[shard]):
            listed_level = level.number % 2 == 1
            # passed the last level: the answer of that level's own side, with nothing left to correct
            deeper = answer if answer is not None else F.lit(listed_level)
            answer = F.when(level.passes(h1, h2), deeper).otherwise(F.lit(not listed_level))
        return answer if answer is not None else F.lit(False)

    def mark(self, df: DataFrame, key: str, out: str) -> DataFrame:
        """``df`` with a boolean ``out``: is the key listed?  One shard is a plain expression; more
        are judged in one pass each over their own rows, and every pass carries one shard's bits."""
        h1, h2, h3 = _hashes(F.coalesce(F.col(key), F.lit("")))
        if self.n_shards <= 1:
            return df.withColumn(out, self.listed_in(0, h1, h2) if self.shards else F.lit(False))
        path = scratch(df.sparkSession, "urlpass")
        for s in range(self.n_shards):
            mine = df.where(F.pmod(h3, F.lit(self.n_shards)) == s)
            mine.withColumn(out, self.listed_in(s, h1, h2)).write.mode("append").parquet(path)
        return df.sparkSession.read.parquet(path)


def shards_for(n_listed: int, n_unlisted: int, bits_per_key: int, max_bits: int) -> int:
    """Shards in which level 1 (the listed keys) and level 2 (its false positives) fit ``max_bits``; later
    levels are smaller.  The false positives are an expectation, so they leave room for their spread."""
    n_bits = max(MIN_BITS, n_listed * bits_per_key)
    wrong = n_unlisted * (1 - math.exp(-HASHES * n_listed / n_bits)) ** HASHES
    room = max(1.0, (math.sqrt(4 + max_bits / bits_per_key) - 2) ** 2)     # mean + 4 sqrt(mean) fits
    return max(1, math.ceil(n_listed * bits_per_key / max_bits), math.ceil(wrong / room))


def fit_cascade(universe: DataFrame, listed: DataFrame, key: str = "key",
                bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS) -> Cascade:
    """Cascade over ``universe[key]`` (every key that will be asked) for the keys of ``listed[key]``."""
    spark = universe.sparkSession
    both = (universe.select(key).where(F.col(key).isNotNull()).withColumn("listed", F.lit(0))
            .unionByName(listed.select(key).where(F.col(key).isNotNull()).withColumn("listed", F.lit(1))))
    h1, h2, h3 = _hashes(F.col(key))
    keys = staged(both.groupBy(key).agg(F.max("listed").alias("listed"))
                  .select(h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), "listed"), scratch(spark, "urlkeys"))
    n = keys.agg(F.count_if(F.col("listed") == 1).alias("listed"), F.count_if(F.col("listed") == 0).alias("unlisted")).first()
    n_shards = shards_for(n["listed"], n["unlisted"], bits_per_key, max_bits)
    return Cascade([_fit_shard(keys.where(F.pmod("h3", F.lit(n_shards)) == s), bits_per_key) for s in range(n_shards)])


def _fit_shard(keys: DataFrame, bits_per_key: int) -> list[Level]:
    h1, h2 = F.col("h1"), F.col("h2")
    levels: list[Level] = []
    # left[side]: the keys of that side which every earlier level of the other side lets through
    left = {1: keys.where("listed = 1"), 0: keys.where("listed = 0")}
    for number in range(1, MAX_LEVELS + 1):
        side = number % 2
        n = left[side].count()
        if n == 0 and levels:
            return levels
        # a level with few keys still gets a floor, so chains of tiny levels stay short
        n_bits = max(MIN_BITS, 64 * math.ceil(n * bits_per_key / 64))
        where = left[side].select(F.explode(F.array(*_positions(h1, h2, number, n_bits))).alias("p"))
        words = (where.groupBy(F.shiftright("p", 6).cast("int").alias("w"))
                 .agg(F.bit_or(F.call_function("shiftleft", F.expr("1L"), F.expr("cast(p & 63 as int)"))).alias("bits")))
        filled = [0] * (n_bits // 64)
        for r in words.toLocalIterator():        # n_bits / 64 rows at most
            filled[r["w"]] = r["bits"]
        level = Level(number, n_bits, n, filled)
        levels.append(level)
        left[1 - side] = left[1 - side].where(level.passes(h1, h2))
    raise RuntimeError(f"the cascade did not close within {MAX_LEVELS} levels")


def judge_urls(pages: DataFrame, listed_hosts: DataFrame, rules=RULES, **fit) -> DataFrame:
    """Every page's url judged: the longest fitting rule decides, else the cascade over the corpus's hosts.

    Columns ``host``, ``path``, ``listed``, ``rule`` and ``verdict`` of ``pages`` are replaced; others pass through."""
    host, path = split_url(F.col("url"))
    parts = pages.withColumns({"host": host, "path": path})
    cascade = fit_cascade(parts.select(F.col("host").alias("key")).distinct(),
                          listed_hosts.select(F.col("host").alias("key")), **fit)
    marked = cascade.mark(parts, "host", "listed")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return marked.withColumns({"rule": rule, "verdict": F.coalesce(
        verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))})


def listed_hosts(pages: DataFrame, labels=LISTED_LABELS) -> DataFrame:
    """The block list of the registered query: the corpus's hosts that have a listed label."""
    host, _ = split_url(F.col("url"))
    return (pages.select(host.alias("host")).distinct()
            .where(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, labels)))))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return judge_urls(pages, listed_hosts(pages)).select("page_id", "host", "path", "rule", "verdict")


_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
ORACLE = f"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce({_REST}, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce({_REST}, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN list_has_any(string_split(host, '.'), [{', '.join(repr(x) for x in LISTED_LABELS)}]) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""
