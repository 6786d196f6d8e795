"""Near duplicates: a Jaccard self-join of 5-word shingle sets, and its connected components.

Two documents link when ``100 * |A & B| >= 80 * |A | B|``.  Equal sets are one class, and only
classes are compared, so copies are never expanded into pairs.  The join goes in three steps, each
of which keeps every link:

1. Filter.  Order tokens by hash.  Linked sets share ``l`` tokens within the first
   ``n - ceil(0.8 n) + l`` of each; a set that shares fewer of its prefix with any other document
   (``l`` = n / 20) has no link.  Most documents end here, and never move their full sets.
2. Signatures.  Order the remaining sets' tokens by document frequency.  Let U be the tokens that a
   linked pair does not share; then U <= o / 4 for the o shared ones.  If the first shared token is
   rare (at most ``RARE`` sets hold it), it lies in both plain prefixes and is a single-token
   signature.  Otherwise all shared tokens are frequent: of the gaps between consecutive shared
   tokens at most U are broken by an unshared one, so among the first U + 2 shared tokens two are
   neighbours in both orders.  That 2-token combination lies within the first 0.4 n + 2 tokens of
   each set, so the extended prefix's neighbouring frequent tokens are the other signatures: one
   per token, not one per pair of tokens.
3. Verification.  In each signature's bucket the set with the fewest unshared tokens is compared
   with the others (stars), links are merged into components, and only members that are still apart
   and whose sizes and signature positions leave room for a link are compared pairwise.  Overlaps are counted exactly on
   the 64-bit shingle hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer than five words are one shingle.  A text
without words (or null) has an empty set and links with nothing.  Repeated rows are members of one
class; a null doc_id takes part and is named by the smallest id of its component, if it has one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebook.llm.common import SPACE, scratch, ship_package, staged
from ratebook.sources.tables import table

WORDS = 5                   # words in a shingle
PERCENT = 80                # similarity from which two sets link
RARE = 8                    # sets that hold a rare token, at most
SLACK = 20                  # the filter asks for n / SLACK shared prefix tokens
BEFORE = 8                  # preceding signatures by which a pair is seen to have met already
STARS = 2                   # star rounds before members that are apart are compared pairwise
NO_ID = -(1 << 62)          # stands for a null doc_id where a key is needed

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# Odd multipliers that keep a shingle's words in order.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD],
                np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes (uint64) of a text."""
    words = _WORD.findall((text or "").encode().lower())      # bytes.lower() changes A-Z only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - WORDS + 1
    out = np.zeros(n, np.uint64)
    for k in range(WORDS):
        out ^= h[k:k + n] * _MIX[k]
        out = (out ^ (out >> np.uint64(29))) * _MIX[-1]
    return np.unique(out)


def _class(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _least(n):
    """Tokens that a set of n shares with any set it links with, at least: ceil(0.8 n)."""
    return -(-PERCENT * n // 100)


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n, c1, c2, dk): text hash, set size and 128-bit class key of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, keys = [], []
            for t in b.column(2):
                s = shingles(t.as_py())
                n.append(len(s))
                keys.append(_class(s))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
                                   pa.array([k[1] for k in keys], pa.int64())], ["doc_id", "mark", "n", "c1", "c2"])

    out = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(
        run, "doc_id long, mark long, n long, c1 long, c2 long")
    return out.withColumn("dk", F.coalesce("doc_id", F.lit(NO_ID)))


def prefix_hits(docs: DataFrame) -> DataFrame:
    """(dk, hits): how many prefix tokens a document shares with another one, where it shares any.

    Tokens that several documents of an Arrow batch hold are settled there and sent once, so a token
    that very many documents share is a few rows per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dk = b.column(0).to_numpy(zero_copy_only=False)
            tokens, owner = [], []
            for i, t in enumerate(b.column(1)):
                s = shingles(t.as_py())
                n = len(s)
                p = s[:n - _least(n) + -(-n // SLACK)]
                tokens.append(p)
                owner.append(np.full(len(p), i))
            if not (token := np.concatenate(tokens) if tokens else np.empty(0)).size:
                continue
            owner = np.concatenate(owner)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            first = np.concatenate([[True], token[1:] != token[:-1]])
            several = ~(first & np.concatenate([first[1:], [True]]))
            here = np.bincount(owner[several], minlength=len(dk))
            settled = token[several & first]
            alone = token[~several]
            at = np.flatnonzero(here)
            k = len(alone) + len(settled)
            yield pa.record_batch([
                pa.array(np.concatenate([alone, settled, np.zeros(len(at), np.uint64)]).astype(np.uint64).view(np.int64),
                         mask=np.arange(k + len(at)) >= k),
                pa.array(np.concatenate([dk[owner[~several]], np.zeros(len(settled), np.int64), dk[at]]).astype(np.int64),
                         mask=(np.arange(k + len(at)) >= len(alone)) & (np.arange(k + len(at)) < k)),
                pa.array(np.concatenate([np.ones(k, np.int64), here[at]]).astype(np.int32))], ["token", "dk", "hits"])

    sent = (docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("dk"), "text")
            .mapInArrow(run, "token long, dk long, hits int"))
    # rows with a token: one holder each, or a null holder for "several in one batch"
    met = F.count(F.lit(1)).over(Window.partitionBy("token", F.when(F.col("token").isNull(), F.col("dk"))))
    kept = sent.withColumn("met", met).where("dk IS NOT NULL AND (token IS NULL OR met > 1)")
    return kept.groupBy("dk").agg(F.sum("hits").alias("hits"))


def class_tokens(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, n, token) of every class in ``classes`` (dk, cid, c1): sets are taken from the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cid, c1, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                s = shingles(t.as_py())
                if len(s) and _class(s)[0] == c1:          # else another text under the same id
                    k = len(s)
                    yield pa.record_batch([pa.array(np.full(k, cid)), pa.array(np.full(k, k)), pa.array(s.view(np.int64))],
                                          ["cid", "n", "token"])

    # shuffled at every size: the classes grow with the corpus, so a broadcast would only suit small ones
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("dk"), "text").join(classes.hint("merge"), "dk")
    return texts.select("cid", "c1", "text").mapInArrow(run, "cid long, n long, token long")


def shared_sets(tokens: DataFrame) -> DataFrame:
    """(cid, n, toks, dfs) of the classes that can link: the tokens some other class has too, rarest first."""
    df = F.count(F.lit(1)).over(Window.partitionBy("token"))
    both = tokens.withColumn("df", df).where("df > 1")
    sets = both.groupBy("cid", "n").agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("s"))
    able = sets.where(F.size("s") * F.lit(100) >= F.lit(PERCENT) * F.col("n"))
    return able.select("cid", "n", F.col("s.token").alias("toks"), F.col("s.df").alias("dfs"))


def signatures(sets: DataFrame, rare: int = RARE) -> DataFrame:
    """(sig, is_pair, cid, n, own, at): rare single tokens of the prefix, and neighbouring frequent tokens of
    the extended prefix.  ``own`` counts tokens that a pair met by this signature cannot share: those no
    other set has, and for a pair of frequent tokens the rare ones too (if the sets shared one of
    those, it would be their first shared token and a signature of its own).  ``at`` counts the other
    tokens before the signature."""
    own = F.col("n") - F.size("toks")
    least = F.ceil(F.col("n") * F.lit(PERCENT) / F.lit(100))
    plain = F.greatest(F.col("n") - least + 1 - own, F.lit(0)).cast("int")
    extended = F.greatest(F.floor(F.col("n") * 2 / F.lit(5)) + 2 - own, F.lit(0)).cast("int")
    n_rare = F.size(F.filter("dfs", lambda d: d <= rare))
    singles = F.slice("toks", 1, F.least(plain, n_rare))
    frequent = F.slice("toks", n_rare + 1, F.greatest(extended - n_rare, F.lit(0)))
    pairs = F.zip_with(F.slice(frequent, 1, F.greatest(F.size(frequent) - 1, F.lit(0))),
                       F.slice(frequent, 2, F.greatest(F.size(frequent) - 1, F.lit(0))),
                       lambda a, b: F.xxhash64(F.lit("pair"), a, b))
    each = F.concat(
        F.transform(singles, lambda t, k: F.struct(t.alias("sig"), F.lit(False).alias("is_pair"),
                                                   own.cast("bigint").alias("own"), k.cast("bigint").alias("at"))),
        F.transform(pairs, lambda t, k: F.struct(t.alias("sig"), F.lit(True).alias("is_pair"),
                                                 (own + n_rare).cast("bigint").alias("own"), k.cast("bigint").alias("at"))))
    return sets.select("cid", "n", F.explode(each).alias("s")).select("s.sig", "s.is_pair", "cid", "n", "s.own", "s.at")


def _fits(a: str, b: str):
    """Can the sets link, by their sizes, unshared tokens, and the tokens on either side of the signature?
    Both sets keep their tokens in one order, so none before it in one set is behind it in the other."""
    na, nb, ka, kb = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.at"), F.col(f"{b}.at")
    room = F.least(ka, kb) + F.least(na - F.col(f"{a}.own") - ka, nb - F.col(f"{b}.own") - kb)
    return F.lit(100) * room >= F.lit(PERCENT) * (na + nb - room)


def size_class(n):
    """Sizes by powers of 1.26: linked sets differ by a factor of 1.25 at most, so by one class at most."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(1.26)))


def _apart(live: DataFrame) -> DataFrame:
    """The pairs (x, y) of ``live`` that share a signature and are not told apart by their sizes: a bucket
    is joined by size classes, each with itself and with the one above."""
    up = live.withColumn("over", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("class", size_class(F.col("n")) + F.col("over"))
    x, y = up.alias("x"), live.withColumn("class", size_class(F.col("n"))).alias("y")
    return x.join(y, ["sig", "class"]).where((F.col("x.over") == 1) | (F.col("x.cid") < F.col("y.cid")))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of (a, b) the pairs that link, by exact overlap."""
    s = sets.select("cid", "n", "toks")
    both = (pairs.join(s.toDF("a", "na", "ta"), "a").join(s.toDF("b", "nb", "tb"), "b"))
    o = F.size(F.array_intersect("ta", "tb"))
    return both.where(F.lit(100) * o >= F.lit(PERCENT) * (F.col("na") + F.col("nb") - o)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(cid, root) of every node of ``edges`` (a, b): random-order contraction, logarithmic rounds."""
    spark = edges.sparkSession
    labels, round_ = None, 0
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), scratch(spark, "edges"))
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(round_), c).alias("r"), c.alias("c"))
        ways = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = ways.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        up = staged(up.select("a", F.least(F.col("m"), rank(F.col("a")))["c"].alias("up")), scratch(spark, "up"))
        if labels is None:
            labels = up.select(F.col("a").alias("cid"), F.col("up").alias("root"))
        else:
            labels = labels.join(up, labels["root"] == up["a"], "left").select("cid", F.coalesce("up", "root").alias("root"))
        labels = staged(labels, scratch(spark, "labels"))
        moved = (edges.join(up.toDF("a", "ua"), "a").join(up.toDF("b", "ub"), "b").where("ua <> ub")
                 .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct())
        edges, round_ = staged(moved, scratch(spark, "edges")), round_ + 1
    return labels if labels is not None else spark.createDataFrame([], "cid long, root long")


def links(sets: DataFrame, rare: int = RARE, stars: int = STARS) -> DataFrame:
    """(cid, root): the components of the link graph over ``sets``, staged."""
    spark = sets.sparkSession
    every = staged(signatures(sets, rare), scratch(spark, "signatures"))
    n = F.count(F.lit(1)).over(Window.partitionBy("sig"))
    buckets = staged(every.withColumn("m", n).where("m > 1").drop("m"), scratch(spark, "buckets"))
    edges = spark.createDataFrame([], "a long, b long")
    labels = components(edges)
    for turn in range(stars + 1):
        named = buckets.join(labels, "cid", "left").withColumn("label", F.coalesce("root", "cid")).drop("root")
        # members that cannot link with the bucket's sizes, and buckets in one piece, are done
        w = Window.partitionBy("sig")
        lowest = F.ceil(F.col("n") * F.lit(PERCENT) / F.lit(100))
        highest = F.floor((F.col("n") - F.col("own")) * F.lit(100 + PERCENT) / F.lit(PERCENT)) - F.col("n")
        able = named.withColumns({"least_n": F.min("n").over(w), "most_n": F.max("n").over(w)}) \
            .where((highest >= F.col("least_n")) & (lowest <= F.col("most_n"))).drop("least_n", "most_n")
        able = able.withColumns({"l0": F.min("label").over(w), "l1": F.max("label").over(w)}).where("l0 <> l1").drop("l0", "l1")
        buckets = staged(able.drop("label"), scratch(spark, "buckets"))
        live = staged(able, scratch(spark, "live"))
        if live.isEmpty():
            break
        if turn < stars:
            # stars: the first round's centre is the set with the fewest unshared tokens, later ones come by chance
            by = F.struct("own", "cid") if turn == 0 else F.struct(F.xxhash64(F.lit(turn), "cid"), "cid")
            centre = live.groupBy("sig").agg(F.min_by(F.struct("cid", "n", "own", "at", "label"), by).alias("c")).select("sig", "c.*")
            pairs = live.alias("y").join(centre.alias("x"), "sig")
        else:
            # A pair meets in every signature it shares.  Where two sets have one of the preceding BEFORE
            # signatures in common they have met already; at their first common one they never do.  Single
            # tokens come first: a pair of tokens counts rare ones as unshared, which holds only for sets
            # without a common single, so the first common signature is where _fits allows the most.
            each = Window.partitionBy("cid").orderBy("is_pair", "sig").rowsBetween(-BEFORE, -1)
            last = live.withColumn("before", F.collect_list("sig").over(each))
            pairs = _apart(last).where(~F.arrays_overlap("x.before", "y.before"))
        pairs = (pairs.where((F.col("x.label") != F.col("y.label")) & _fits("x", "y"))
                 .select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct())
        found = staged(verified(pairs, sets), scratch(spark, "links"))
        if not found.isEmpty():
            edges = staged(edges.unionByName(found).distinct(), scratch(spark, "edges"))
            labels = components(edges)
    return labels


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n, size, root, component_id) of every row of ``docs`` (doc_id, text): its class's
    number of rows, the group it belongs to (null for an empty set) and the group's smallest id."""
    spark = docs.sparkSession
    ship_package(spark)
    each = staged(document_sets(docs), scratch(spark, "sets"))
    classes = each.where("n > 0").groupBy("c1", "c2").agg(F.min("dk").alias("dk"), F.min("doc_id").alias("first_id"),
                                                          F.max("n").alias("n"), F.count(F.lit(1)).alias("size"))
    # a class is named by its smallest id, or by its key where that id has several texts
    same = F.count(F.lit(1)).over(Window.partitionBy("dk"))
    classes = staged(classes.withColumn("cid", F.when(same == 1, F.col("dk")).otherwise(F.col("c1"))), scratch(spark, "classes"))
    hits = prefix_hits(docs)
    alive = classes.join(hits, "dk").where(F.col("hits") >= F.ceil(F.col("n") / F.lit(SLACK)))
    alive = staged(alive.select("dk", "cid", "c1"), scratch(spark, "alive"))
    able = staged(shared_sets(class_tokens(docs, alive)), scratch(spark, "shared"))
    roots = links(able)
    named = classes.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(first, "root").select("c1", "c2", "root", "component_id", "size")
    return each.join(of_class, ["c1", "c2"], "left").select("doc_id", "mark", "n", "size", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_size): one row per row of ``docs`` (doc_id, text)."""
    return grouped(docs).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("class_size"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group, that with the smallest id; rows with empty sets all stay."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    kept = (grouped(docs).where("n > 0").groupBy("root").agg(F.min_by(F.struct("doc_id", "mark"), order).alias("k"))
            .select(F.col("k.doc_id").alias("_nd_id"), F.col("k.mark").alias("_nd_mark")))
    blank = F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACE)) == ""
    rows = docs.where(~blank).withColumn("_nd_text", F.xxhash64("text"))
    mine = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_nd_id")) & (F.col("_nd_text") == F.col("_nd_mark")), "left_semi")
    # of repeated rows, one
    w = Window.partitionBy("doc_id", "_nd_text").orderBy("_nd_text")
    mine = mine.withColumn("_nd_row", F.row_number().over(w)).where("_nd_row = 1").drop("_nd_row", "_nd_text")
    return mine.unionByName(docs.where(blank))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
