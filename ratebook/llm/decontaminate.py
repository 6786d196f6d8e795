"""Benchmark decontamination with a positional inverted index of the corpus.

The index holds postings (hash of the term, document, position) of the corpus words that the tests use.  Each
test phrase -- a window of ``WINDOW`` consecutive words of an item, or a whole shorter item -- is
looked up from its rarest terms: the rarest term's postings, moved back by the term's offset, are
the candidate starts; each further rare term keeps the starts where its own posting lies at its
offset; what is left is compared word by word with the document.  So long posting lists of common
words are never walked unless a phrase has no rarer word, and nothing is capped.

``proximity_matches`` finds documents where all of a query's terms lie within a span of words, in
any order, from the same postings.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.  Null or empty text has no
words and matches nothing; an item without words has no phrase.  Items with the same words all
count.  A document is known by its id and a hash of its text, so repeated rows, or different rows
under one id (or under null), are judged each by its own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm.common import ascii_lower, let, scratch, staged
from ratebook.sources.tables import table

WINDOW = 10                 # words of a phrase
ANCHORS = 2                 # rarest terms whose lists are intersected before the words are compared
END = " "                   # not a word: the posting that closes every document


def words_of(text: Column) -> Column:
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def _mark(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key).isNull(), F.col(text))


def _tid() -> Column:
    return F.xxhash64("term").alias("tid")


def phrases_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(phrase array<string>, item): every window of every item, or the whole item if it is shorter."""
    w = items.select(F.col("item_id").alias("item"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    at = w.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    return at.select(F.slice("w", F.col("i") + 1, F.lit(window)).alias("phrase"), "item").distinct()


def index_of(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The staged positional index for ``terms``: (tid, key, doc, mark, pos), and a posting of ``END``
    for every row of ``docs`` at the position after its last word.  ``tid`` is a term's 64-bit hash.

    ``doc`` and ``mark`` know a document and are never null.  The texts are cut into words only here.
    The staged vocabulary has a measured size: Spark broadcasts it only below its threshold."""
    spark = docs.sparkSession
    end = spark.range(1).select(F.lit(END).alias("term"))
    wanted = staged(terms.select("term").unionByName(end).select(_tid()).distinct(), scratch(spark, "terms"))
    tokens = docs.select(F.col(key).alias("key"), _mark(key, text).alias("mark"),
                         F.posexplode(F.array_append(words_of(F.col(text)), F.lit(END))).alias("pos", "term"))
    held = staged(tokens.select(_tid(), "key", "mark", "pos").join(wanted, "tid"), scratch(spark, "index"))
    return held.withColumn("doc", F.coalesce("key", F.lit(0)).cast("bigint"))


def term_counts(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n) for ``terms``: how often each occurs in the corpus; 0 included."""
    found = index.groupBy("tid").agg(F.count(F.lit(1)).alias("n"))
    return terms.select("term", _tid()).join(found, "tid", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def anchors_of(phrases: DataFrame, counts: DataFrame, k: int = ANCHORS) -> DataFrame:
    """(phrase, rank, term, offset): each phrase's ``k`` rarest distinct terms, rarest first; phrases
    with a term that the corpus lacks are left out."""
    terms = phrases.select("phrase").distinct().select("phrase", F.posexplode("phrase").alias("offset", "term"))
    first = terms.groupBy("phrase", "term").agg(F.min("offset").alias("offset"))
    by = first.join(counts, "term").groupBy("phrase").agg(
        F.min("n").alias("least"), F.sort_array(F.collect_list(F.struct("n", "term", "offset"))).alias("a"))
    kept = by.where("least > 0").select("phrase", F.posexplode(F.slice("a", 1, k)).alias("rank", "x"))
    return kept.select("phrase", "rank", "x.term", "x.offset")


def phrase_matches(docs: DataFrame, index: DataFrame, phrases: DataFrame, k: int = ANCHORS,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, phrase, start): every place where a phrase occurs in ``docs``; ``index`` holds its terms."""
    spark = docs.sparkSession
    every = phrases.select("phrase").distinct()
    counts = term_counts(index, every.select(F.explode("phrase").alias("term")).distinct())
    anchors = staged(anchors_of(every, counts, k), scratch(spark, "anchors"))
    anchors = anchors.select("phrase", "rank", _tid(), "offset")
    ranked = [staged(anchors.where(F.col("rank") == r).drop("rank"), scratch(spark, "ranked")) for r in range(k)]
    found = (index.join(ranked[0], "tid").select("phrase", "doc", "mark", (F.col("pos") - F.col("offset")).alias("start"))
             .where("start >= 0"))
    for rank in ranked[1:]:
        # phrases with fewer distinct terms have no anchor of this rank and stay as they are
        at = found.join(rank, "phrase", "left").withColumn("pos", F.col("start") + F.coalesce("offset", F.lit(0)))
        lists = (index.join(rank.select("tid").distinct(), "tid", "left_semi")
                 .select("tid", "doc", "mark", "pos", F.lit(True).alias("hit")))
        at = at.join(lists, ["tid", "doc", "mark", "pos"], "left")
        found = at.where(F.col("tid").isNull() | F.col("hit")).select("phrase", "doc", "mark", "start")
    found = staged(found, scratch(spark, "candidates"))
    by_doc = staged(found.groupBy("doc", "mark").agg(F.collect_set(F.struct("phrase", "start")).alias("c")),
                    scratch(spark, "bydoc"))
    # Repeated rows of a document all give the same answer; distinct() below keeps one.
    texts = docs.select(F.coalesce(F.col(key), F.lit(0)).cast("bigint").alias("doc"), _mark(key, text).alias("mark"),
                        F.col(text).alias("text"))
    same = texts.join(by_doc, ["doc", "mark"])

    def compared(words: Column) -> Column:
        return F.filter("c", lambda c: F.forall(
            F.sequence(F.lit(0), F.size(c["phrase"]) - 1),
            lambda i: F.coalesce(F.get(words, c["start"] + i) == F.get(c["phrase"], i), F.lit(False))))

    at = same.select("doc", "mark", F.explode(let(words_of(F.col("text")), compared)).alias("x"))
    return at.select("doc", "mark", "x.phrase", "x.start").distinct()


def proximity_matches(index: DataFrame, queries: DataFrame, slop: int) -> DataFrame:
    """(query, key, doc, mark): documents in which all terms of (query, term) rows lie within ``slop`` words."""
    wanted = queries.distinct()
    need = wanted.groupBy("query").agg(F.count(F.lit(1)).alias("need"))
    at = index.join(wanted.select("query", "term", _tid()), "tid")
    # a span that starts in a block of ``slop`` words ends in it or in the next one
    block = F.floor(F.col("pos") / F.lit(slop))
    both = at.select("query", "key", "doc", "mark", "pos", "term", F.explode(F.array(block, block - 1)).alias("block"))
    spans = both.groupBy("query", "key", "doc", "mark", "block").agg(F.collect_set(F.struct("pos", "term")).alias("s"))
    whole = F.exists("s", lambda a: F.size(F.array_distinct(F.transform(
        F.filter("s", lambda b: (b["pos"] >= a["pos"]) & (b["pos"] < a["pos"] + slop)), lambda b: b["term"]))) == F.col("need"))
    return spans.join(need, "query").where(whole).select("query", "key", "doc", "mark").distinct()


def judged(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, doc, mark, n_words, n_hit, items), a row for every row of ``docs``; n_hit and items are null
    where no phrase of any item occurs."""
    spark = docs.sparkSession
    phrases = staged(phrases_of(items, window), scratch(spark, "phrases"))
    index = index_of(docs, phrases.select(F.explode("phrase").alias("term")), key, text)
    found = staged(phrase_matches(docs, index, phrases, key=key, text=text), scratch(spark, "matches"))
    spans = found.select("doc", "mark", "start", (F.col("start") + F.size("phrase")).alias("end"))
    # words in the union of the spans, walking them by their starts
    hit = F.aggregate(F.sort_array(F.collect_set(F.struct("start", "end"))),
                      F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n")),
                      lambda a, s: F.struct(F.greatest(a["reach"], s["end"]).alias("reach"),
                                            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).alias("n")),
                      lambda a: a["n"])
    hits = spans.groupBy("doc", "mark").agg(hit.cast("bigint").alias("n_hit"))
    named = (found.select("doc", "mark", "phrase").join(phrases, "phrase").groupBy("doc", "mark")
             .agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items")))
    ends = index.where(F.col("tid") == F.xxhash64(F.lit(END))).select("key", "doc", "mark", F.col("pos").cast("bigint").alias("n_words"))
    return ends.join(hits.join(named, ["doc", "mark"]), ["doc", "mark"], "left")


def marked(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus n_words, n_hit (long), items (array of item ids as text) and contaminated;
    columns of these names are replaced."""
    found = judged(docs, items, window, key, text).select("doc", "mark", "n_words", "n_hit", "items").distinct()
    found = found.toDF("_dc_doc", "_dc_mark", "_dc_words", "_dc_hit", "_dc_items")
    mine = docs.withColumns({"_dc_doc": F.coalesce(F.col(key), F.lit(0)).cast("bigint"), "_dc_mark": _mark(key, text)})
    out = mine.join(found, ["_dc_doc", "_dc_mark"], "left")
    n = F.coalesce("_dc_hit", F.lit(0).cast("bigint"))
    return out.withColumns({"n_words": F.col("_dc_words"), "n_hit": n,
                            "items": F.coalesce("_dc_items", F.array().cast("array<string>")),
                            "contaminated": n > 0}).drop("_dc_doc", "_dc_mark", "_dc_words", "_dc_hit", "_dc_items")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = judged(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    n = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(F.col("key").alias("doc_id"), "n_words", n.alias("n_hit"), F.size(listed).cast("bigint").alias("n_items"),
                      F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n > 0).alias("contaminated"))
