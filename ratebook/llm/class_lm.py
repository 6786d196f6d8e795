"""Language-model scoring with Brown class-based bigrams.

The model is P(w | v) = P(class(w) | class(v)) * P(w | class(w)).  Classes come from exchange
clustering: a unit moves to the class where the training text's class-bigram likelihood is largest,
given how often it follows and precedes each class.  Moves are parallel: a round takes every
``SPLIT``-th unit, sums its contexts over the whole training text, and evaluates all 64 classes for
each; the assignment with the best likelihood over all rounds stays.

Units are the words frequent enough (at most ``EXCHANGE_WORDS`` of them, by a threshold on their
count), the end of a text, and ``STAND_INS`` stand-ins, which every other word shares by its ending
(three bytes, digits alike); so the classes cover all words while what a task holds stays bounded.
Everything else follows the corpus: every distinct word has its exact count and emission probability,
transitions count every token, and counts too many for a task are joined, not broadcast.

Smoothing: transitions back off to class frequencies with weight ``KAPPA``.  A class of N tokens, n1 of
them words seen once, emits a known word with c / (N + n1 + 1) and an unknown one with
(n1 + 1) / (N + n1 + 1) (Good-Turing); the probabilities of all words and "unknown" sum to one.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end token; a text starts as if after an
end.  Null text is empty (the end token alone).  Documents with crc32(id as text) mod ``FOLDS`` =
``HELD_OUT`` are not learned from; a null id counts as the empty text and is learned from.  Repeated
rows count and are scored each.  Without training documents every word is unknown.  Extra columns
are left out.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm.chunks import text_groups
from ratebook.llm.common import LOWER, UPPER, scratch, ship_package, staged
from ratebook.sources.tables import table

CLASSES = 64
EXCHANGE_WORDS = 1 << 15    # words that move on their own
STAND_INS = 1 << 12
WORD_BYTES = 64             # longer words share a stand-in
ROUNDS, SPLIT = 8, 4        # every unit moves in ROUNDS / SPLIT rounds
KAPPA = 4.0
FOLDS, HELD_OUT = 7, 2
GROUP = 1 << 22             # characters of texts that are counted together (one text at least)
COUNTED = 500_000           # distinct words that a task counts before it hands them on
STEPS = 8                   # thresholds per doubling of a word's count
END = 0                     # the unit and the class of the end of a text
_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def held_out(doc_id: str = "doc_id"):
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()       # splits at the six ASCII white-space characters


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all texts, ends not included."""
    ship_package(docs.sparkSession)

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array([w.decode() for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], ["word", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for some in text_groups(b, GROUP, 0):
                for t in _texts(some, 0):
                    counts.update(words_of(t))
                    if len(counts) > COUNTED:
                        yield out(counts)
                        counts = Counter()
        if counts:
            yield out(counts)

    return docs.select("text").where("text IS NOT NULL").mapInArrow(run, "word string, c long") \
        .groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Units:
    """Words that move on their own, most frequent first (unit 1 onwards), and their counts."""
    words: list[bytes]
    counts: np.ndarray
    stand_ins: int

    @property
    def size(self) -> int:
        return 1 + len(self.words) + self.stand_ins

    def numbers(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words, 1)}

    def stand_in(self, word: bytes) -> int:
        return 1 + len(self.words) + zlib.crc32(word[-3:].translate(_DIGITS)) % self.stand_ins


def frequent_units(words: DataFrame, most: int = EXCHANGE_WORDS, stand_ins: int = STAND_INS) -> Units:
    """The words above the lowest threshold that leaves at most ``most`` of them."""
    if most + stand_ins >= 1 << 16:
        raise ValueError("units are numbered in 16 bits")
    short = words.where(F.octet_length("word") <= WORD_BYTES).withColumn("step", F.floor(F.log2("c") * STEPS))
    sizes = sorted(((r["step"], r["n"]) for r in short.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    taken, least = 0, None                           # steps: a few hundred at most
    for step, n in sizes:
        if taken + n > most:
            break
        taken, least = taken + n, step
    rows = [] if least is None else short.where(F.col("step") >= least).select("word", "c").collect()
    rows.sort(key=lambda r: (-r["c"], r["word"]))
    return Units([r["word"].encode() for r in rows], np.array([r["c"] for r in rows], np.int64), stand_ins)


def encoded(docs: DataFrame, units: Units) -> DataFrame:
    """Per document: rid (number of the row), doc_id, held, ids (units of its tokens, 16 bits each, with
    the end) and its words without a unit of their own: rare, times, unit."""
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(units)
    names = ["rid", "doc_id", "held", "ids", "rare", "times", "unit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = held.value
        number, rid = u.numbers(), TaskContext.get().partitionId() << 33
        known: dict[bytes, int] = {}                 # stand-ins of recent words
        for b in batches:
            for some in text_groups(b, GROUP, 2):
                if len(known) > COUNTED:
                    known = {}
                n, ids, rare, times, unit = some.num_rows, [], [], [], []
                for t in _texts(some, 2):
                    words = words_of(t or b"")
                    at = np.fromiter((number.get(w, 0) for w in words), np.int64, len(words))
                    others = Counter([words[i] for i in np.flatnonzero(at == 0).tolist()])
                    for w in others:
                        if w not in known:
                            known[w] = u.stand_in(w)
                    if others:
                        at[at == 0] = [known[words[i]] for i in np.flatnonzero(at == 0).tolist()]
                    ids.append(np.append(at, END).astype("<u2").tobytes())
                    rare.append([w.decode() for w in others])
                    times.append(list(others.values()))
                    unit.append([known[w] for w in others])
                yield pa.record_batch([
                    pa.array(range(rid, rid + n), pa.int64()), some.column(0), some.column(1), pa.array(ids, pa.binary()),
                    pa.array(rare, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64())), pa.array(unit, pa.list_(pa.int32()))], names)
                rid += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held"), "text").mapInArrow(
        run, f"rid long, doc_id {kind}, held boolean, ids binary, rare array<string>, times array<long>, unit array<int>")


# ------------------------------------------------------------------ exchange

def contexts(ids: DataFrame, classes: np.ndarray, moving: np.ndarray, n_classes: int) -> DataFrame:
    """(unit, j, n): how often each moving unit stands before a token of class j, after one of class
    j - n_classes, and before itself (j = 2 * n_classes; not counted in the others); unit -1 counts class
    bigrams, j = first * n_classes + second."""
    spark = ids.sparkSession
    ship_package(spark)
    slot = np.full(len(classes), -1, np.int64)
    slot[moving] = np.arange(len(moving))
    held = spark.sparkContext.broadcast((classes, slot, moving))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, slots, units = held.value
        c, m = n_classes, len(units)
        pairs, after, before, same = np.zeros(c * c, np.int64), np.zeros(m * c, np.int64), np.zeros(m * c, np.int64), np.zeros(m, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            u = np.concatenate([np.zeros(1, "<u2"), np.frombuffer(b"".join(b.column(0).to_pylist()), "<u2")]).astype(np.int64)
            k, s = cls[u], slots[u]
            pairs += np.bincount(k[:-1] * c + k[1:], minlength=c * c)
            if not m:
                continue
            own = u[:-1] == u[1:]
            left, right = (s[:-1] >= 0) & ~own, (s[1:] >= 0) & ~own
            after += np.bincount(s[:-1][left] * c + k[1:][left], minlength=m * c)
            before += np.bincount(s[1:][right] * c + k[:-1][right], minlength=m * c)
            same += np.bincount(s[:-1][own & (s[:-1] >= 0)], minlength=m)
        found = []
        for unit, j, n in ((None, np.arange(c * c), pairs), (units.repeat(c), np.tile(np.arange(c), m), after),
                           (units.repeat(c), np.tile(np.arange(c, 2 * c), m), before), (units, np.full(m, 2 * c), same)):
            some = np.flatnonzero(n)
            found.append((np.full(len(some), -1) if unit is None else unit[some], j[some], n[some]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)]
        yield pa.record_batch([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())],
                              ["unit", "j", "n"])

    return ids.select("ids").mapInArrow(run, "unit int, j int, n long").groupBy("unit", "j").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(pairs: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, up to a constant of the text."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(axis=0)).sum() - _xlogx(pairs.sum(axis=1)).sum())


def best_class(pairs: np.ndarray, now: int, after: np.ndarray, before: np.ndarray, same: float) -> tuple[int, float]:
    """The class (never the end's) where a unit raises the likelihood most, and by how much over staying."""
    m = pairs.copy()
    m[now, :] -= after
    m[:, now] -= before
    m[now, now] -= same
    f, diag = _xlogx(m), np.diagonal(m)
    a, b = np.flatnonzero(after), np.flatnonzero(before)
    gain = (_xlogx(m[:, a] + after[a]) - f[:, a]).sum(axis=1) + (_xlogx(m[b, :] + before[b, None]) - f[b, :]).sum(axis=0)
    # in the class's own cell both directions meet
    gain += _xlogx(diag + after + before + same) - _xlogx(diag + after) - _xlogx(diag + before) + _xlogx(diag)
    # what stands before the unit stays in its class whichever class the unit takes, and so does what follows
    for total, more in ((m.sum(axis=1) + before, after.sum() + same), (m.sum(axis=0) + after, before.sum() + same)):
        gain -= _xlogx(total + more) - _xlogx(total)
    gain[END] = -np.inf
    best = int(gain.argmax())
    return best, float(gain[best] - gain[now])


def moves(sums: DataFrame, classes: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """(unit, class) of the units that gain by moving."""
    spark, n_classes = sums.sparkSession, len(pairs)
    held = spark.sparkContext.broadcast((classes, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, table = held.value
        for b in batches:
            units, found = [], []
            for unit, row in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = np.zeros(2 * n_classes + 1)
                entries = row.values
                x[entries.field(0).to_numpy()] = entries.field(1).to_numpy()
                to, gain = best_class(table, int(cls[unit]), x[:n_classes], x[n_classes:-1], x[-1])
                if gain > 1e-9:
                    units.append(unit)
                    found.append(to)
            yield pa.record_batch([pa.array(units, pa.int32()), pa.array(found, pa.int32())], ["unit", "class"])

    # a unit has 2 * n_classes + 1 entries at most
    rows = sums.where("unit >= 0").groupBy("unit").agg(F.collect_list(F.struct("j", "n")).alias("x"))
    return rows.mapInArrow(run, "unit int, class int")


def exchange(ids: DataFrame, units: Units, n_classes: int = CLASSES, rounds: int = ROUNDS, split: int = SPLIT,
             report: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Classes by unit and the class-bigram counts of the best assignment.  ``report`` gets each round's
    likelihood."""
    spark = ids.sparkSession
    number = np.arange(units.size)
    classes = 1 + (number - 1) % (n_classes - 1)
    classes[END] = END
    best = None
    for k in range(rounds + 1):
        moving = number[1:][(number[1:] % split) == k % split] if k < rounds else number[:0]
        sums = staged(contexts(ids, classes, moving, n_classes), scratch(spark, f"contexts{k}"))
        pairs = np.zeros((n_classes, n_classes))
        for r in sums.where("unit < 0").collect():                   # n_classes squared at most
            pairs[r["j"] // n_classes, r["j"] % n_classes] = r["n"]
        value = likelihood(pairs)
        if report is not None:
            report.append(value)
        if best is None or value > best[0]:
            best = value, classes.copy(), pairs
        if k < rounds:
            for r in moves(sums, classes, pairs).collect():          # one row per unit at most
                classes[r["unit"]] = r["class"]
    return best[1], best[2]


# ------------------------------------------------------------------ scores

@dataclass
class Model:
    """Logarithms (base 10) that a task needs; all of a size bounded by the units."""
    classes: np.ndarray         # by unit
    transition: np.ndarray      # by class before and class
    emitted: np.ndarray         # by unit: of its emission (end, own words), of 1 / (N + n1 + 1) for stand-ins
    unknown: np.ndarray         # by class: of n1 + 1
    base: np.ndarray            # by unit: of its base probability, 0 for stand-ins
    own: int                    # units below it have counts of their own
    end_known: bool
    train_tokens: int
    types: int


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def fit_model(words: DataFrame, ids: DataFrame, units: Units, n_classes: int = CLASSES, rounds: int = ROUNDS, split: int = SPLIT,
              kappa: float = KAPPA, report: list | None = None) -> Model:
    """The model of training documents ``ids`` (see ``encoded``) with word counts ``words``."""
    spark = words.sparkSession
    n_docs = ids.count()
    classes, pairs = exchange(ids, units, n_classes, rounds, split, report)
    held = spark.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = held.value
        number = u.numbers()
        for b in batches:
            raw = [w.encode() for w in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array([number.get(w) or u.stand_in(w) for w in raw], pa.int32()), b.column(1)], ["unit", "c"])

    per_unit = words.mapInArrow(run, "unit int, c long").groupBy("unit").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("types"), F.count_if(F.col("c") == 1).alias("once")).collect()
    count, once, types = np.zeros(units.size), np.zeros(units.size), 0
    count[END] = n_docs
    for r in per_unit:
        count[r["unit"]], once[r["unit"]], types = r["n"], r["once"], types + r["types"]
    types += n_docs > 0
    tokens = int(count.sum())
    size, unseen = np.bincount(classes, count, n_classes), np.bincount(classes, once, n_classes)
    room = _log10(size + unseen + 1)
    own = 1 + len(units.words)
    emitted = -room[classes]
    emitted[1:own] += _log10(count[1:own])
    emitted[END] += _log10(count[END]) if n_docs else _log10(unseen[END] + 1)
    total = pairs.sum(axis=0)
    share = (total + 1) / (total.sum() + n_classes)
    transition = _log10((pairs + kappa * share) / (pairs.sum(axis=1, keepdims=True) + kappa))
    base = _log10((count + 1) / (tokens + types + 1))
    base[own:] = 0.0
    return Model(classes, transition, emitted, _log10(unseen + 1), base, own, n_docs > 0, tokens, int(types))


def scored(ids: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """Scores of encoded documents; words without a unit of their own are joined with their counts."""
    spark = ids.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(model)
    names = ["rid", "doc_id", "held", "n_tokens", "n_known", "base", "score", "rare", "times", "unknown"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            n, known, base, score, unknown = [], [], [], [], []
            for raw, unit in zip(b.column(3).to_pylist(), b.column(6).to_pylist(), strict=True):
                u = np.frombuffer(raw, "<u2").astype(np.int64)
                k = m.classes[u]
                n.append(len(u))
                known.append(int((u < m.own).sum()) - (not m.end_known))
                base.append(float(m.base[u].sum()))
                score.append(float(m.emitted[u].sum() + m.transition[np.append(END, k[:-1]), k].sum()))
                unknown.append(m.unknown[m.classes[unit]] if unit else [])
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                                   pa.array(base, pa.float64()), pa.array(score, pa.float64()), b.column(4), b.column(5),
                                   pa.array(unknown, pa.list_(pa.float64()))], names)

    kind = ids.schema["doc_id"].dataType.simpleString()
    shape = f"rid long, doc_id {kind}, held boolean, n_tokens long, n_known long, base double, score double, rare array<string>, times array<long>, unknown array<double>"
    parts = staged(ids.mapInArrow(run, shape), scratch(spark, "parts"))
    rare = parts.select("rid", F.explode(F.arrays_zip("rare", "times", "unknown")).alias("e")) \
        .select("rid", F.col("e.rare").alias("word"), F.col("e.times").alias("times"), F.col("e.unknown").alias("unknown"))
    joined = rare.join(words, "word", "left")
    c = F.coalesce("c", F.lit(0))
    more = joined.select("rid", F.when(c > 0, F.col("times")).otherwise(0).alias("n_known"),
                         (F.col("times") * F.log10((c + 1) / F.lit(float(model.train_tokens + model.types + 1)))).alias("base"),
                         (F.col("times") * F.when(c > 0, F.log10(c)).otherwise(F.col("unknown"))).alias("score"))
    more = more.groupBy("rid").agg(*[F.sum(x).alias(f"more_{x}") for x in ("n_known", "base", "score")])
    whole = parts.drop("rare", "times", "unknown").join(more, "rid", "left")

    def plus(x: str):
        return F.col(x) + F.coalesce(F.col(f"more_{x}"), F.lit(0))

    return whole.select("doc_id", F.col("held").alias("held_out"), "n_tokens", plus("n_known").cast("bigint").alias("n_known"),
                        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
                        plus("base").alias("base_score"), plus("score").alias("score"))


def score_documents(docs: DataFrame, n_classes: int = CLASSES, most: int = EXCHANGE_WORDS, stand_ins: int = STAND_INS,
                    rounds: int = ROUNDS, split: int = SPLIT, report: list | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every (doc_id, text) row."""
    spark = docs.sparkSession
    words = staged(word_counts(docs.where(~held_out())), scratch(spark, "words"))
    units = frequent_units(words, most, stand_ins)
    ids = staged(encoded(docs, units), scratch(spark, "ids"))
    model = fit_model(words, ids.where("NOT held"), units, n_classes, rounds, split, report=report)
    return scored(ids, words, model)


def perplexity(scores: DataFrame, score: str = "score") -> float:
    """10 ^ (-score per token) over the held-out documents."""
    r = scores.where("held_out").agg(F.sum(score).alias("s"), F.sum("n_tokens").alias("n")).head()
    return math.pow(10.0, -r["s"] / r["n"]) if r["n"] else float("nan")


def op12_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
