"""Quality rules: text statistics, and an ordered decision list learned from labelled documents.

Statistics are built-in Spark expressions evaluated within the row.  Learning is sequential
covering: a rule grows one threshold literal at a time (the literal with the highest information
gain over the growing rows), is pruned back on held-out rows, and is kept while its held-out
precision stays high; the rows it covers are removed and the next rule is learned.  The result is
an ordered list of interpretable conjunctions, applied as one conditional expression.

Only fitting uses a bounded sample: ``fit_rows`` labelled documents (those with the smallest hash
of their id); statistics and verdicts cover every document.

Nulls and empty texts have no words and all statistics 0.  Repeated windows are compared by a
64-bit hash of their words within one document.  Labels that are null are not used; a document
labelled more than once counts once per label row.  Without usable labels the list is empty and
rejects nothing.  Extra columns of ``documents`` pass through ``with_statistics`` untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm.common import SPACE, free_name, let, scratch, staged, words_of
from ratebook.sources.tables import table

WINDOW = 8                  # words in a repeat window
FIT_ROWS = 8000             # labelled documents used to learn the list
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_RULES = 12
MAX_LITERALS = 4
MIN_PRECISION = 0.97        # of a rule on held-out rows; clean documents must stay
MIN_COVER = 3               # low-quality held-out rows a rule must catch
# The quantiles whose values are candidate thresholds (dense in the tails, where junk is).
QUANTILES = (0.005, 0.01, 0.02, 0.03, 0.05, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.88, 0.9,
             0.92, 0.94, 0.95, 0.96, 0.97, 0.98, 0.985, 0.99, 0.995)
FEATURES = ("words_count", "word_length", "symbols_per_word", "dup_line_share", "repeat_word_share", "upper_share",
            "bang_per_word", "bar_per_word", "digit_share", "words_per_line", "stops_per_word")


def _repeat_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in the text."""

    def windows(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return let(each, covered)

    def covered(w: Column) -> Column:
        # most texts repeat no window; only the others pay for the sort
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(
            let(F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), repeated))

    def repeated(s: Column) -> Column:
        def twice(e: Column, i: Column) -> Column:
            before, after = F.get(s, i - 1)["x"], F.get(s, i + 1)["x"]
            return F.coalesce(e["x"] == before, F.lit(False)) | F.coalesce(e["x"] == after, F.lit(False))

        starts = F.sort_array(F.transform(F.filter(s, twice), lambda e: e["i"]))
        return F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                           lambda a, p: F.struct((p + WINDOW).alias("end"),
                                                 (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")),
                           lambda a: a["n"])

    hashed = F.transform(words, lambda x: F.xxhash64(x))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(hashed, windows))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the base counts (long) and the learned list's features (double).  Columns of
    these names in ``docs`` are replaced."""
    t = F.coalesce(F.col(text), F.lit(""))
    stats = let(words_of(t), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        _repeat_words(w).cast("bigint").alias("n_repeat_words")))
    lines = let(F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
                lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    names = {k: free_name(docs, f"_{k}") for k in ("s", "l", "symbols", "upper", "digits", "bang", "bar", "stops")}
    of = {k: F.col(name) for k, name in names.items()}
    counted = docs.withColumns({
        names["s"]: stats, names["l"]: lines,
        names["symbols"]: F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("bigint"),
        names["upper"]: F.regexp_count(t, F.lit("[A-Z]")),
        names["digits"]: F.regexp_count(t, F.lit("[0-9]")),
        names["bang"]: F.length(t) - F.length(F.replace(t, F.lit("!"))),
        names["bar"]: F.length(t) - F.length(F.replace(t, F.lit("|"))),
        names["stops"]: F.length(t) - F.length(F.replace(t, F.lit("."))),
    })

    def per(a: Column, b: Column) -> Column:
        return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))

    n, chars = of["s"]["n_words"], of["s"]["word_chars"]
    return counted.withColumns({
        "n_words": n, "word_chars": chars, "n_symbols": of["symbols"], "n_dup_lines": of["l"]["dup"].cast("bigint"),
        "n_repeat_words": of["s"]["n_repeat_words"],
        "words_count": n.cast("double"), "word_length": per(chars, n), "symbols_per_word": per(of["symbols"], n),
        "dup_line_share": per(of["l"]["dup"], of["l"]["n"]),
        "repeat_word_share": per(of["s"]["n_repeat_words"], n),
        "upper_share": per(of["upper"], chars), "bang_per_word": per(of["bang"], n),
        "bar_per_word": per(of["bar"], n), "digit_share": per(of["digits"], chars),
        "words_per_line": per(n, of["l"]["n"]), "stops_per_word": per(of["stops"], n),
    }).drop(*names.values())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | \
        (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


@dataclass(frozen=True)
class Literal:
    """``feature > threshold`` (``above``) or ``feature <= threshold``."""
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


def _all(literals) -> Column:
    out = F.lit(True)
    for x in literals:
        out = out & x.column()
    return out


def decision(rules: list[list[Literal]]) -> Column:
    """The text of the first rule that fires (it rejects the document), else null."""
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(_all(r), F.lit(" and ".join(map(str, r)))).otherwise(out)
    return out


def learn_rules(rows: DataFrame) -> list[list[Literal]]:
    """Rules that cover the rows with ``bad`` = 1, from rows (FEATURES, bad 0/1, held 0/1): ``MAX_RULES`` of
    ``MAX_LITERALS`` conditions at most, which keeps the list readable.

    ``rows`` is the bounded fitting sample; each step is one aggregation over it, and what comes
    back is one count per feature and candidate threshold."""
    cuts = rows.agg(*[F.percentile(f, F.array(*map(F.lit, QUANTILES))).alias(f) for f in FEATURES]).head()
    cuts = {f: sorted(set(cuts[f] or [])) for f in FEATURES}
    bins = {f: sum([(F.col(f) > F.lit(t)).cast("int") for t in cuts[f]], F.lit(0)) for f in FEATURES}
    long = F.explode(F.array(*[F.struct(F.lit(k).alias("f"), bins[f].alias("b")) for k, f in enumerate(FEATURES)]))

    def counts(part: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
        by = part.select(long.alias("x"), "bad").groupBy("x.f", "x.b")
        return {(r["f"], r["b"]): (r["p"], r["n"])
                for r in by.agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()}

    def totals(part: DataFrame, conds: list[Column]) -> list[tuple[int, int]]:
        got = part.agg(*[F.count_if(c & (F.col("bad") == v)).alias(f"c{i}_{v}")
                         for i, c in enumerate(conds) for v in (1, 0)]).head()
        return [(got[f"c{i}_1"], got[f"c{i}_0"]) for i in range(len(conds))]

    def best_literal(part: DataFrame) -> tuple[float, Literal | None, int]:
        found = counts(part)
        p0 = sum(p for (f, _), (p, n) in found.items() if f == 0)
        n0 = sum(n for (f, _), (p, n) in found.items() if f == 0)
        if not p0:
            return 0.0, None, 0
        base, best = math.log2(p0 / (p0 + n0)), (0.0, None, 0)
        for k, f in enumerate(FEATURES):
            for j, t in enumerate(cuts[f]):
                for above in (True, False):
                    inside = [v for (g, b), v in found.items() if g == k and (b > j) == above]
                    p, n = sum(v[0] for v in inside), sum(v[1] for v in inside)
                    if p and (gain := p * (math.log2(p / (p + n)) - base)) > best[0] + 1e-9:
                        best = (gain, Literal(f, above, t), n)
        return best

    rules: list[list[Literal]] = []
    grow, held = rows.where("held = 0"), rows.where("held = 1")
    while len(rules) < MAX_RULES:
        rule: list[Literal] = []
        while len(rule) < MAX_LITERALS:
            gain, literal, negatives = best_literal(grow.where(_all(rule)))
            if literal is None:
                break
            rule.append(literal)
            if negatives == 0:
                break
        if not rule:
            return rules
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        scored = [((p - n) / (p + n), -k, p, n, prefixes[k])
                  for k, (p, n) in enumerate(totals(held, [_all(x) for x in prefixes])) if p + n]
        if not scored:
            return rules
        _, _, p, n, pruned = max(scored, key=lambda s: s[:2])
        if p < MIN_COVER or p / (p + n) < MIN_PRECISION:
            return rules
        rules.append(pruned)
        grow, held = grow.where(~_all(pruned)), held.where(~_all(pruned))
    return rules


def fit_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Statistics of the fitting sample: ``fit_rows`` labels with the smallest id hash.  A labelled id that
    several documents carry counts once, with the smallest of its texts, so the sample is bounded by ``fit_rows``."""
    spark = docs.sparkSession
    picked = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
              .select(F.col("doc_id").alias("_id"), F.when(F.col("quality") == 0, 1).otherwise(0).alias("bad"),
                      F.xxhash64("doc_id").alias("_h"))
              .orderBy("_h", "_id", "bad").limit(fit_rows))
    picked = staged(picked.select("_id", "bad", (F.pmod("_h", F.lit(3)) == 0).cast("int").alias("held")),
                    scratch(spark, "fitids"))
    known = docs.select("doc_id", "text").join(picked.select("_id").distinct(), F.col("doc_id") == F.col("_id"))
    known = known.groupBy("_id").agg(F.min("text").alias("text")).join(picked, "_id")
    rows = with_statistics(known).where(~base_failed()).select(*FEATURES, "bad", "held")
    return staged(rows, scratch(spark, "fitrows")).coalesce(1)       # fit_rows rows at most


def judge(docs: DataFrame, rules: list[list[Literal]]) -> DataFrame:
    """``docs`` with statistics, ``base_failed``, the firing ``rule`` (null: none) and ``kept``."""
    s = with_statistics(docs).withColumn("base_failed", base_failed())
    s = s.withColumn("rule", F.when(~F.col("base_failed"), decision(rules)))
    return s.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rules = learn_rules(fit_sample(docs, table(spark, sf_dir, "labels")))
    return judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                     "n_repeat_words", "base_failed", "rule", "kept")
