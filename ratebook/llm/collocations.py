"""Phrase collocation mining with stripes.

A stripe belongs to a (lang, prefix) and counts the words that follow the prefix.  Level k holds the
stripes of prefixes of k - 1 words: level 1 (the empty prefix) counts words and gives each lang's
total, level k >= 2 counts phrases of k words.  Texts are cut into words once, into a staged table of
word numbers (two bytes each, unless a group has more words than that); every level reads that.  Tasks make
entries from groups of texts and Spark merges them elementwise: entry by entry, with map-side sums, so the
stripe of a very frequent prefix is spread over all tasks and none is ever gathered whole.  As text, stripes are
arrays (a prefix with its next words and their counts, ``ROW`` stripes in a row).  Everything else is read from
the merged stripes: an entry is the count of a phrase, the largest entry of a stripe tells whether its prefix is
subsumed by a word to the right, and the largest entry over all prefixes that begin with some word tells the
same of a word to the left.  A phrase is subsumed by a longer one if and only if it is by one of one word
more, since counts never rise with length.  (Rare words have no entry; the total is summed where texts are cut.)

Levels are complete and pruned like frequent item sets: a phrase can reach ``min_count`` only if both
of its parts of one word less do, so level k looks only at places where they may.  What was frequent
in the levels below is known to tasks as Bloom filters of a fixed number of bits (``FILTER_BITS``),
whatever the corpus size; a false positive makes an entry that falls short of ``min_count`` and
goes, and nothing frequent is ever missed.  Most phrases of a level, and most words, are rare, so levels are
counted by a fingerprint of each phrase and its lang: 64 bits of one hash and 31 of an unrelated one, which cost
the shuffle less than texts (that any two of 10^10 phrases share one has odds of about 10^-9).  Each task gives
out its phrases frequent or not, so their number follows the input, and what is added up is each phrase's count.

Texts follow for frequent phrases only, and only from one part of the staged table each: the first that has the
phrase (the smallest, in the sums).  If every task gave out every frequent phrase it has, tasks times frequent
phrases would, since both grow with the input, grow with its square for as long as most of a task's phrases are
rare.  Which part gives out which phrase is a Bloom filter too; a false positive only repeats a text.

Text is cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and at spaces and tabs into words, A-Z lower-cased.
Null or empty text has no words; a null lang is ``und`` (and counts with texts of that lang); repeated
rows count each; extra columns are not read.  Ties of a score go to the larger count, then to the
smaller phrase in UTF-8 byte order; ties between cuts to the shortest first part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebook.llm.chunks import text_groups
from ratebook.llm.common import LOWER, UPPER, scratch, ship_package, staged
from ratebook.sources.tables import table

MIN_COUNT = 100             # occurrences of a candidate
MAX_WORDS = 5
TOP = 2000                  # phrases reported for each lang
SUBSUMED_PERCENT = 100      # a longer phrase with this share of the occurrences makes a candidate go
GROUP = 1 << 22             # characters of texts whose stripes are made together (one text at least)
ROW = 4096                  # stripes in a row
HASH_ROWS = 1 << 15         # rows of hashes in a batch
HASHES = 1 << 20            # hashes that a task adds up before it gives them out
ENTRIES = 1 << 19           # the same for entries of stripes; half as many stay
FILTER_BITS = 1 << 26       # bits of a level's filter (8 MB), a power of two
UNKNOWN_LANG = "und"
_BITMAP = 1 << 15           # bits of a bitmap aggregate
# The characters that end a piece; 0xFF is no byte of UTF-8 and stands for them.
_ENDS, _END = b".,;:!?\n\x0b\x0c\r", b"\xff"
_BYTES = bytes.maketrans(_ENDS + b"\t" + UPPER.encode(), _END * len(_ENDS) + b" " + LOWER.encode())
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)      # odd: hashes of phrases are polynomials in it
_OF_BYTES = np.uint64(0xC2B2AE3D27D4EB4F)        # odd: hashes of words are polynomials in it
_PRIME = np.uint64((1 << 31) - 1)                # checks are polynomials modulo it: in the first number
_CHECK_BYTES, _CHECK_WORDS = np.uint64(1_402_024_253), np.uint64(586_950_981)     # over bytes, in the second over words


def _folded(hashes: np.ndarray) -> np.ndarray:
    """32 bits of each hash."""
    with np.errstate(over="ignore"):
        return ((hashes ^ (hashes >> np.uint64(31))) * _MULTIPLIER >> np.uint64(32)).astype(np.uint32)


def _positions(folded: np.ndarray) -> np.ndarray:
    """Two filter bits per folded hash."""
    with np.errstate(over="ignore"):
        h = (folded.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    low = np.uint64(FILTER_BITS - 1)
    return np.stack([(h >> np.uint64(32)) & low, (h ^ (h >> np.uint64(17))) & low]).astype(np.int64)


def _in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _positions(_folded(hashes))
    return (bits[a >> 3] >> (a & 7) & bits[b >> 3] >> (b & 7) & 1).astype(bool)


def _chain(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return first * _MULTIPLIER + word


def _check_chain(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (first * _CHECK_WORDS + word) % _PRIME


def _in_part(hashes: np.ndarray, part: np.ndarray | int) -> np.ndarray:
    """Hashes of phrases together with a part of the staged texts."""
    return _chain(hashes, (np.asarray(part).astype(np.uint64) + np.uint64(1)) * _OF_BYTES)


def _coded(texts: list[bytes]) -> tuple[bytes, np.ndarray, int]:
    """The distinct words of some texts, space-joined, in order each word's number in them from 1 (0: end of a
    piece), and how many words there are in all."""
    data = np.frombuffer((_END + _END.join(texts) + _END).translate(_BYTES), np.uint8)
    ends = data == _END[0]
    inner = ~(ends | (data == 0x20))
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    first |= ends
    at = np.flatnonzero(first)
    is_word = inner[at]
    # the words' bytes without what stands between them, as an Arrow array
    edges = np.append(np.append(0, np.cumsum(inner))[at[is_word]], np.count_nonzero(inner)).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data[inner])]).dictionary_encode()
    ids = np.zeros(len(at), np.int32)
    ids[is_word] = coded.indices.to_numpy() + 1
    again = np.zeros(len(at), bool)               # one end of a piece after another
    again[1:] = ~(is_word[1:] | is_word[:-1])
    if len(edges) == 1:
        return b"", ids[~again], 0
    # spaces between the dictionary's values, which lie in one buffer
    between = np.frombuffer(coded.dictionary.buffers()[1], np.int32)[:len(coded.dictionary) + 1]
    listed = np.insert(np.frombuffer(coded.dictionary.buffers()[2], np.uint8)[:between[-1]], between[1:-1], 0x20).tobytes()
    return listed, ids[~again], len(edges) - 1


def coded_texts(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Texts cut into words once: lang, n, words, size, ids; a row holds a group of texts of one lang: its number
    of words, the distinct ones space-joined, and the running text as their numbers (``_coded``) in
    little-endian unsigned integers of ``size`` bytes."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in text_groups(b, group):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(some.column(0).to_pylist(), some.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    listed, ids, n = _coded(texts)
                    if n:
                        size = 2 if ids.max() < 1 << 16 else 4
                        yield pa.record_batch([pa.array([lang]), pa.array([n], pa.int64()), pa.array([listed], pa.binary()),
                                               pa.array([size], pa.int32()), pa.array([ids.astype(f"<u{size}").tobytes()], pa.binary())],
                                              ["lang", "n", "words", "size", "ids"])

    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"), "text").where("text IS NOT NULL")
    return texts.mapInArrow(run, "lang string, n long, words binary, size int, ids binary").withColumn("part", F.spark_partition_id())


def _coded_rows(coded: DataFrame) -> DataFrame:
    return coded.select("lang", "words", "size", "ids", "part")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes, np.ndarray, int]]:
    """Lang, joined words, ids and part of each group of coded texts."""
    for b in batches:
        for i in range(b.num_rows):
            yield (b.column(0)[i].as_py(), b.column(1)[i].as_py(), np.frombuffer(b.column(3)[i].as_buffer(), f"<u{b.column(2)[i].as_py()}"),
                   b.column(4)[i].as_py())


def _powers(n: int) -> np.ndarray:
    """The first powers of ``_CHECK_BYTES``, modulo ``_PRIME``."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.append(out, out * (out[-1] * _CHECK_BYTES % _PRIME) % _PRIME)
    return out[:n]


def _word_hashes(lang: str, words: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and checks of a group's space-joined words by their numbers (0: no word)."""
    data = np.frombuffer(words, np.uint8)
    gaps = np.flatnonzero(data == 0x20)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
    size = ends - starts
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(size.max() + 1, _OF_BYTES))
        place = np.arange(len(data)) - np.repeat(starts, np.append(size[:-1] + 1, size[-1]))
        values = (data.astype(np.uint64) + np.uint64(1)) * (data != 0x20)
        h = np.add.reduceat(values * powers[place], starts)
        h += np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        h = (h ^ (h >> np.uint64(32))) * _MULTIPLIER
        checks = (np.add.reduceat(values * _powers(len(powers))[place], starts) + np.uint64(xxhash.xxh32_intdigest(lang.encode()))) % _PRIME
    return np.append(np.uint64(0), h ^ (h >> np.uint64(29))), np.append(np.uint64(0), checks)


def _places(ids: np.ndarray, of_word: np.ndarray, filters: list[np.ndarray | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For k = 2, 3, ... up to one word more than ``filters`` has levels: where the phrases of ``k`` words begin that
    pass their level's filter, if there is one, and all whose parts pass theirs; and their hashes (``None``: all pass)."""
    passing = np.ones(len(of_word), bool) if filters[0] is None else _in_filter(filters[0], of_word)
    passing[0] = False
    may, h = passing[ids], of_word[ids]
    for k in range(2, len(filters) + 2):
        at = np.flatnonzero(may[:-1] & may[1:])
        hashes = _chain(h[at], of_word[ids[at + k - 1]])
        own = filters[k - 1] if k <= len(filters) else None
        if own is not None:
            hit = _in_filter(own, hashes)
            at, hashes = at[hit], hashes[hit]
        yield at, hashes
        may = np.zeros(len(ids), bool)
        may[at], h[at] = True, hashes


def _added(columns: np.ndarray, n_words: int, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases as columns of word numbers below ``n_words``, equal ones added up (``counts``: each counts 1 without) and
    sorted by number; their counts, and where each stripe begins: where the words before the last change."""
    # equal prefixes get equal numbers, one word at a time; sorting (prefix, next) makes the stripes
    prefix = np.zeros(columns.shape[1], np.int64)
    for j, some in enumerate(columns[:-1]):
        prefix = prefix * n_words + some
        if j:
            _, prefix = np.unique(prefix, return_inverse=True)
    keys = prefix * n_words + columns[-1]
    if counts is None:
        keys, first, counts = np.unique(keys, return_index=True, return_counts=True)
    else:
        keys, first, same = np.unique(keys, return_index=True, return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, same, counts)
        counts = sums
    return columns[:, first], counts, np.flatnonzero(np.diff(keys // n_words, prepend=-1))


class _Stripes:
    """Entries of several groups of coded texts, added up before they are given out as stripes: the groups'
    words get numbers of their own here, by lang."""

    def __init__(self):
        self.size, self.numbers, self.parts = 0, {}, {}

    def add(self, lang: str, words: list[bytes], used: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``found``: columns of a group's word numbers (from 1), all among ``used``, and their counts."""
        numbers = self.numbers.setdefault(lang, {})
        here = np.zeros(len(words) + 1, np.int32)
        here[used] = [numbers.setdefault(words[i - 1], len(numbers)) for i in used.tolist()]
        for columns, counts in found:
            self.parts.setdefault((lang, len(columns)), []).append((here[columns], counts))
            self.size += len(counts)

    def add_up(self) -> None:
        for (lang, k), some in self.parts.items():
            columns, counts, _ = _added(np.concatenate([c for c, _ in some], axis=1), max(1, len(self.numbers[lang])), np.concatenate([n for _, n in some]))
            self.parts[lang, k] = [(columns, counts)]
        self.size = sum(len(counts) for some in self.parts.values() for _, counts in some)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (lang, k), some in self.parts.items():
            words = list(self.numbers[lang])
            columns, counts, starts = _added(np.concatenate([c for c, _ in some], axis=1), max(1, len(words)), np.concatenate([n for _, n in some]))
            heads = [words_of_prefix.tolist() for words_of_prefix in columns[:-1, starts]]
            prefixes = [b" ".join([words[i] for i in one]).decode() for one in zip(*heads, strict=True)] if k > 1 else [""] * len(starts)
            edges = pa.array(np.append(starts, len(counts)), pa.int32())
            each = pa.StructArray.from_arrays(
                [pa.array(prefixes, pa.string()),
                 pa.ListArray.from_arrays(edges, pa.array(words, pa.binary()).cast(pa.string()).take(pa.array(columns[-1]))),
                 pa.ListArray.from_arrays(edges, pa.array(counts, pa.int64()))], ["prefix", "next", "n"])
            for at in range(0, len(prefixes), ROW):
                part = each.slice(at, ROW)
                yield pa.record_batch([pa.array([lang]), pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)], ["lang", "stripes"])


def coded_stripes(coded: DataFrame, k: int, known: np.ndarray | None = None) -> DataFrame:
    """Unmerged stripes of level ``k`` of coded texts: lang, and an array of (prefix, next words, their counts);
    ``known``: the filter of phrases of k - 1 words that may be frequent."""
    return _stripes_of(coded, [None] * (k - 2) + [known] if k > 1 else [None], k, k)


def filtered_stripes(coded: DataFrame, filters: list[np.ndarray], givers: np.ndarray | None = None) -> DataFrame:
    """Unmerged stripes of all levels of the phrases that pass their level's filter (``filters``: of levels 1, 2, ...),
    in the parts that give them out (``givers``: the filter of hashes in parts)."""
    return _stripes_of(coded, filters, 1, len(filters), givers)


def _stripes_of(coded: DataFrame, filters: list[np.ndarray | None], lowest: int, highest: int, givers: np.ndarray | None = None) -> DataFrame:
    spark = coded.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast([None if f is None else f.tobytes() for f in [givers, *filters]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        givers, *filters = [None if f is None else np.frombuffer(f, np.uint8) for f in held.value]
        made = _Stripes()
        for lang, joined, ids, part in _groups(batches):
            words, (of_word, _), found = joined.split(b" "), _word_hashes(lang, joined), []
            if lowest == 1:
                used = np.arange(1, len(of_word))
                if filters[0] is not None:
                    used = used[_in_filter(filters[0], of_word[1:])]
                if givers is not None:
                    used = used[_in_filter(givers, _in_part(of_word[used], part))]
                found.append((used[None, :], np.bincount(ids, minlength=len(of_word))[used]))
            if highest > 1:
                for k, (at, hashes) in zip(range(2, highest + 1), _places(ids, of_word, filters), strict=False):
                    if k >= lowest:
                        at = at if givers is None else at[_in_filter(givers, _in_part(hashes, part))]
                        found.append(_added(np.stack([ids[at + j] for j in range(k)]), len(of_word))[:2])
            made.add(lang, words, np.unique(np.concatenate([c.ravel() for c, _ in found])), found)
            if made.size >= ENTRIES:
                made.add_up()
                if made.size >= ENTRIES // 2:
                    yield from made.rows()
                    made = _Stripes()
        yield from made.rows()

    return _coded_rows(coded).mapInArrow(
        run, "lang string, stripes array<struct<prefix:string,next:array<string>,n:array<bigint>>>")


def coded_hashes(coded: DataFrame, filters: list[np.ndarray]) -> DataFrame:
    """Counts of the next level's phrases of coded texts by fingerprint (hash and check, lang included), added up only
    within a task's groups: h, c, n, part.  ``filters``: of the levels below, from 1 on; none for words."""
    spark = coded.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast([f.tobytes() for f in filters])

    def added(h: np.ndarray, c: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # by hash alone: where equal hashes have several checks, a fingerprint may come again, and is added up later
        order = np.argsort(h)
        h, c = h[order], c[order]
        starts = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
        n = np.diff(starts, append=len(h)) if n is None else np.add.reduceat(n[order], starts)
        return h[starts], c[starts], n

    def counted(held_back: list[tuple[np.ndarray, np.ndarray, np.ndarray]], part: int) -> Iterator[pa.RecordBatch]:
        h, c, n = added(*(np.concatenate(some) for some in zip(*held_back, strict=True)))
        for at in range(0, len(h), HASH_ROWS):
            some = slice(at, at + HASH_ROWS)
            yield pa.record_batch([pa.array(h[some].view(np.int64)), pa.array(c[some]), pa.array(n[some]),
                                   pa.array(np.full(len(h[some]), part, np.int32))], ["h", "c", "n", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, held_back, size, last = [np.frombuffer(f, np.uint8) for f in held.value], [], 0, None
        for lang, joined, ids, part in _groups(batches):
            if held_back and (size >= HASHES or part != last):
                yield from counted(held_back, last)
                held_back, size = [], 0
            last = part
            of_word, checks = _word_hashes(lang, joined)
            if filters:
                *_, (at, hashes) = _places(ids, of_word, filters)
                if not len(at):
                    continue
                c = checks[ids[at]]
                for j in range(1, len(filters) + 1):
                    c = _check_chain(c, checks[ids[at + j]])
                h, c, n = added(hashes, c.astype(np.int32))
            else:
                h, c, n = of_word[1:], checks[1:].astype(np.int32), np.bincount(ids, minlength=len(of_word))[1:]
            held_back.append((h, c, n))
            size += len(h)
        if held_back:
            yield from counted(held_back, last)

    return _coded_rows(coded).mapInArrow(run, "h long, c int, n long, part int")


def stripes(docs: DataFrame, k: int, known: np.ndarray | None = None, group: int = GROUP) -> DataFrame:
    """Unmerged stripes of level ``k`` straight from (text, lang) rows."""
    return coded_stripes(coded_texts(docs, group), k, known)


def merge_stripes(parts: DataFrame) -> DataFrame:
    """Stripes added up elementwise: lang, phrase (prefix and next word), n; one row per entry.

    While they are added up, an entry's key is one text, the phrase before its lang: words hold no tab."""
    def entries(s: Column) -> Column:
        return F.transform(F.arrays_zip(s["next"], s["n"]), lambda e: F.struct(
            F.concat(F.when(s["prefix"] == "", "").otherwise(F.concat(s["prefix"], F.lit(" "))), e["next"], F.lit("\t"), F.col("lang")).alias("key"),
            e["n"].alias("n")))

    each = parts.select(F.explode(F.flatten(F.transform("stripes", entries))).alias("e")).select("e.key", "e.n")
    return each.groupBy("key").agg(F.sum("n").alias("n")).select(
        F.expr("substr(key, locate('\t', key) + 1)").alias("lang"), F.substring_index("key", "\t", 1).alias("phrase"), "n")


def fingerprints(phrases: DataFrame) -> DataFrame:
    """(lang, phrase) rows with the phrases' fingerprints, hash ``h`` and check ``c``."""
    ship_package(phrases.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [phrase.encode().split(b" ") for phrase in b.column(1).to_pylist()]
            alike: dict[tuple[str, int], list[int]] = {}
            for i, lang in enumerate(b.column(0).to_pylist()):
                alike.setdefault((lang, len(each[i])), []).append(i)
            h, c = np.zeros((2, len(each)), np.uint64)
            for (lang, _), some in alike.items():
                words = list(dict.fromkeys(chain.from_iterable(each[i] for i in some)))
                numbers = {w: i for i, w in enumerate(words, 1)}
                of_word, checks = _word_hashes(lang, b" ".join(words))
                first, *others = np.array([[numbers[w] for w in each[i]] for i in some]).T
                hashes, checked = of_word[first], checks[first]
                for w in others:
                    hashes, checked = _chain(hashes, of_word[w]), _check_chain(checked, checks[w])
                h[some], c[some] = hashes, checked
            yield pa.record_batch([b.column(0), b.column(1), pa.array(h.view(np.int64)), pa.array(c.astype(np.int32))], ["lang", "phrase", "h", "c"])

    return phrases.select("lang", "phrase").mapInArrow(run, "lang string, phrase string, h long, c int")


def filter_of(phrases: DataFrame) -> np.ndarray:
    """The Bloom filter of (lang, phrase) rows: ``FILTER_BITS`` bits on the driver, however many rows."""
    return filter_of_hashes(fingerprints(phrases).select("h"))


def filter_of_hashes(hashes: DataFrame) -> np.ndarray:
    """The Bloom filter of hashes, the first column, or of hashes in the parts that the second names."""
    ship_package(hashes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy().view(np.uint64)
            at = _positions(_folded(h if b.num_columns == 1 else _in_part(h, b.column(1).to_numpy()))).ravel()
            yield pa.record_batch([pa.array(at // _BITMAP, pa.int64()), pa.array(at % _BITMAP, pa.int64())], ["bucket", "bit"])

    bits = hashes.mapInArrow(run, "bucket long, bit long")
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        raw = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[r["bucket"] * _BITMAP // 8:][:len(raw)] = raw
    return out


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 subsumed_percent: int = SUBSUMED_PERCENT, group: int = GROUP) -> DataFrame:
    """Each lang's ``top`` phrases of (text, lang) rows: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    coded = staged(coded_texts(docs, group), scratch(spark, "coded"))
    totals = coded.groupBy("lang").agg(F.sum("n").alias("total"))
    # first by fingerprint alone, level by level; then, in one pass, the texts of the frequent ones, from one part each
    filters: list[np.ndarray] = []
    frequent: DataFrame | None = None
    while len(filters) < max_words and (not filters or filters[-1].any()):
        sums = coded_hashes(coded, filters).groupBy("h", "c").agg(F.sum("n").alias("n"), F.min("part").alias("part")).where(F.col("n") >= min_count)
        level = staged(sums.withColumn("k", F.lit(len(filters) + 1)), scratch(spark, "frequent"))
        filters.append(filter_of_hashes(level.select("h")))
        frequent = level if frequent is None else frequent.unionByName(level)
    texts = merge_stripes(filtered_stripes(coded, filters, filter_of_hashes(frequent.select("h", "part"))))
    spaces = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit("")))
    known = fingerprints(texts).withColumn("k", (spaces + 1).cast("int")).join(frequent, ["h", "c", "k"]).select(
        "lang", "k", F.expr("substring_index(phrase, ' ', k - 1)").alias("prefix"), "phrase", "n")
    known = staged(known, scratch(spark, "phrases"))

    return ranked_phrases(known, totals, top, subsumed_percent)


def ranked_phrases(known: DataFrame, totals: DataFrame, top: int = TOP, subsumed_percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """Phrases scored and ranked, from frequent phrases (lang, k words, prefix, phrase, n) and totals
    (lang, total).  Products are decimals of 38 digits: exact where three counts' product stays below."""
    counts = known.select("lang", "phrase", F.col("n").alias("f"))
    candidates = known.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    # the largest entry of the phrase's own stripe, and of all stripes that end in it after their first word
    longer = known.where("k > 1")
    right = longer.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("n").alias("m"))
    left = longer.groupBy("lang", F.expr("substr(phrase, locate(' ', phrase) + 1)").alias("phrase")).agg(F.max("n").alias("m"))
    widest = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("m").alias("widest"))
    kept = candidates.join(widest, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("widest") * 100 < F.col("a") * subsumed_percent, F.lit(True)))

    big = "decimal(38,0)"
    cuts = kept.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, k - 1)")).alias("at"))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', at)"),
                             "rest": F.expr("substr(phrase, length(substring_index(phrase, ' ', at)) + 2)")})
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
            .join(totals, "lang"))
    cuts = cuts.withColumn("score", F.expr(
        f"(cast(1000 as {big}) * cast(a as {big}) * cast(total as {big})) div (cast(l as {big}) * cast(r as {big}))").cast("bigint"))
    lowest = cuts.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct("score", "at", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN_LANG}') AS lang,
         regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\n\\x0b\\f\\r]')),
                            '[^ \\t]+') AS w
  FROM documents),
phrases AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4), (5)) AS t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {MIN_COUNT}),
inner_phrases AS (
  SELECT lang, a AS longer, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
  FROM (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3), (4)) AS t(m) WHERE m < k)),
widest AS (SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN widest USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {SUBSUMED_PERCENT} * a),
cuts AS (
  SELECT lang, phrase, a, pos, array_to_string(list_slice(w, 1, pos), ' ') AS p1, array_to_string(list_slice(w, pos + 1, k), ' ') AS p2
  FROM (SELECT *, unnest(range(1, k)) AS pos FROM kept)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, pos, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.p1 JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.p2
  JOIN total ON total.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= {TOP}
"""
