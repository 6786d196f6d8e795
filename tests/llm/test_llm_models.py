"""Collocations, the class language model and vector codes against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import DOCS, ascii_lower, edge_documents, with_extras
from pyspark.sql import functions as F

from ratebook.llm import class_lm, collocations, vector_codes

# ------------------------------------------------------------------ collocations


def brute_phrases(rows, min_count, top, most=5):
    out = []
    langs = {"und" if lang is None else lang for lang, _ in rows}
    for lang in langs:
        f = Counter()
        for x, t in rows:
            if ("und" if x is None else x) == lang:
                for piece in re.split(r"[.,;:!?\x0a-\x0d]", ascii_lower(t or "")):
                    w = re.findall(r"[^\x20\x09]+", piece)
                    f.update(tuple(w[i:i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1))
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: v for p, v in f.items() if len(p) > 1 and v >= min_count}
        gone = {p[i:i + k] for p, v in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if v >= f[p[i:i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize(("min_count", "top", "group"), [(2, 2000, 1 << 22), (3, 7, 500)])
def test_phrases_match_brute_force(spark, min_count, top, group):
    r = random.Random(3)
    rows = [(None, t) for _, t in edge_documents() if len(t or "") < 5000]
    some = ["a", "B", "ü", "Ü", "日本", "x\x1cy", "\xa0", "the", "The", "\0", "of"]
    for k in range(60):
        rows.append((r.choice(["en", "de", None, "und", ""]), "".join(r.choice(some) + r.choice([" ", " ", "\t", "  ", ".", "\x0b", ", "]) for _ in range(80))))
    df = with_extras(spark.createDataFrame([(a, b) for a, b in rows], "lang string, text string"))
    got = collocations.collocations(df, min_count=min_count, top=top, group=group).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, min_count, top)
    assert len(got) > 20


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).count() == 0


def test_scores_past_64_bits_are_exact(spark):
    a, n = 3_000_000_000_017, 98_765_432_109_876_543
    known = [("en", 1, "", "x", 4_000_000_000_021), ("en", 1, "", "y", 3_500_000_000_003), ("en", 2, "x", "x y", a)]
    df = spark.createDataFrame(known, "lang string, k int, prefix string, phrase string, n long")
    got = collocations.ranked_phrases(df, spark.createDataFrame([("en", n)], "lang string, total long")).collect()
    assert [tuple(r) for r in got] == [("en", 1, "x y", a, known[0][4], known[1][4], n, 1000 * a * n // (known[0][4] * known[1][4]))]


def test_a_prefix_keys_one_counter(spark):
    df = spark.createDataFrame([("en", "a b a c a b. b a")], "lang string, text string")

    def read(parts):
        return {s.prefix: dict(zip(s.next, s.n, strict=True)) for r in parts.collect() for s in r.stripes}

    assert read(collocations.stripes(df, 1)) == {"": {"a": 4, "b": 3, "c": 1}}
    known = collocations.filter_of(spark.createDataFrame([("en", w) for w in "abc"], "lang string, phrase string"))
    two = collocations.stripes(df, 2, known)
    assert read(two) == {"a": {"b": 2, "c": 1}, "b": {"a": 2}, "c": {"a": 1}}
    assert sorted(map(tuple, collocations.merge_stripes(two.union(two)).collect())) == \
        [("en", "a b", 4), ("en", "a c", 2), ("en", "b a", 4), ("en", "c a", 2)]


# ------------------------------------------------------------------ class language model

def tokens(text):
    return re.findall(r"[^\x20\x09-\x0d]+", ascii_lower(text or "")) + [None]


def grammar(seed, n):
    """Texts in which nouns, verbs and marks follow each other."""
    r = random.Random(seed)
    kinds = [[f"noun{k}" for k in range(60)], [f"verb{k}" for k in range(60)], [f"adv{k}x" for k in range(30)]]
    return [(k, " ".join(r.choice(kinds[j % 3]) for j in range(r.randint(6, 60)))) for k in range(n)]


def test_scores_match_the_formulas(spark):
    rows = [*edge_documents(), *((1000 + k, t) for k, t in grammar(1, 120))]
    df = with_extras(spark.createDataFrame(rows, DOCS))
    docs = df.select("doc_id", "text")
    train = docs.where(~class_lm.held_out())
    words = class_lm.word_counts(train).cache()
    units = class_lm.frequent_units(words, 100, 50)
    assert 0 < len(units.words) <= 100
    ids = class_lm.encoded(docs, units).cache()
    n_classes, kappa = 6, 2.0
    report = []
    model = class_lm.fit_model(words, ids.where("NOT held"), units, n_classes, rounds=4, split=2, kappa=kappa, report=report)
    assert max(report) > report[0] and len(report) == 5
    got = class_lm.scored(ids, words, model).collect()

    learned = [t for i, t in rows if zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2]
    count = Counter(w for t in learned for w in tokens(t))
    n, v = sum(count.values()), len(count)
    number = units.numbers()

    def cls(w):
        return 0 if w is None else int(model.classes[number.get(w.encode()) or units.stand_in(w.encode())])

    pairs, size, once = Counter(), Counter(), Counter()
    for t in learned:
        c = [0, *map(cls, tokens(t))]
        pairs.update(zip(c, c[1:], strict=False))
    for w, k in count.items():
        size[cls(w)] += k
        once[cls(w)] += k == 1
    once[0] = 0
    row, col = Counter(), Counter()
    for (a, b), k in pairs.items():
        row[a] += k
        col[b] += k
    total = sum(col.values())

    def score(t):
        out, last = 0.0, 0
        for w in tokens(t):
            c = cls(w)
            share = (col[c] + 1) / (total + n_classes)
            out += math.log10((pairs[last, c] + kappa * share) / (row[last] + kappa))
            out += math.log10((count[w] or once[c] + 1) / (size[c] + once[c] + 1))
            last = c
        return out

    want = sorted((str(i), zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2, len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t)), 5), round(score(t), 5)) for i, t in rows)
    have = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got)
    assert [w[:5] for w in want] == [h[:5] for h in have]
    for w, h in zip(want, have, strict=True):
        assert w[5:] == pytest.approx(h[5:], abs=1e-4)
    # the emissions of a class, unknown included, sum to one
    for c in set(model.classes.tolist()):
        room = size[c] + once[c] + 1
        assert sum(k for w, k in count.items() if cls(w) == c) / room + (once[c] + 1) / room == pytest.approx(1)


def test_best_class_is_the_brute_force_move(spark):
    r = np.random.default_rng(2)
    text = r.integers(1, 12, 3000)
    classes = np.concatenate([[0], 1 + np.arange(11) % 4])

    def table(cls):
        c = cls[np.concatenate([[0], text, [0]])]
        out = np.zeros((5, 5))
        np.add.at(out, (c[:-1], c[1:]), 1)
        return out

    seq = np.concatenate([[0], text, [0]])
    for unit in range(1, 12):
        after, before = np.zeros(5), np.zeros(5)
        own = (seq[:-1] == unit) & (seq[1:] == unit)
        np.add.at(after, classes[seq[1:]][(seq[:-1] == unit) & ~own], 1)
        np.add.at(before, classes[seq[:-1]][(seq[1:] == unit) & ~own], 1)
        values = {}
        for c in range(1, 5):
            moved = classes.copy()
            moved[unit] = c
            values[c] = class_lm.likelihood(table(moved))
        best, gain = class_lm.best_class(table(classes), int(classes[unit]), after, before, float(own.sum()))
        assert values[best] == pytest.approx(max(values.values())) and gain == pytest.approx(values[best] - values[int(classes[unit])])


def test_classes_lower_held_out_perplexity(spark):
    df = spark.createDataFrame(grammar(5, 600), DOCS)
    out = class_lm.score_documents(df, n_classes=5, most=400, stand_ins=16, rounds=6, split=3).cache()
    assert out.count() == 600
    # three kinds in turn: about 55 words to choose from, where the base model has 150
    assert class_lm.perplexity(out) < 0.5 * class_lm.perplexity(out, "base_score")


def test_nothing_to_learn_from(spark):
    assert class_lm.score_documents(spark.createDataFrame([], DOCS), rounds=1).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = class_lm.score_documents(spark.createDataFrame([(held, "a b")], DOCS), rounds=1).head()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and math.isfinite(r.score)


# ------------------------------------------------------------------ vector codes

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_codes(rows, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width, codes, errors, books = len(kept[0][1]) // 8, [[] for _ in kept], [0] * len(kept), []
    for p in range(8):
        xs = [v[p * width:(p + 1) * width] for _, v, _ in kept]
        book = [list(x) for x in xs[:entries]]

        def nearest(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(book))

        for _ in range(rounds):
            groups = [[] for _ in book]
            for x in xs:
                groups[nearest(x, book)[1]].append(x)
            book = [[sum(col) // len(g) for col in zip(*g, strict=True)] if g else c for g, c in zip(groups, book, strict=True)]
        for k, x in enumerate(xs):
            d, j = nearest(x, book)
            codes[k].append(j)
            errors[k] += d
        books.append(book)
    return sorted((str(i), "".join(f"{c:02x}" for c in code), e, str(lab)) for (i, _, lab), code, e in zip(kept, codes, errors, strict=True)), \
        ",".join(str(v) for b in books for row in b for v in row)


def vectors(seed, n, scale=1.0):
    r = random.Random(seed)
    centres = [[r.gauss(0, scale) for _ in range(16)] for _ in range(9)]
    rows = [(k, [x + r.gauss(0, scale / 30) for x in r.choice(centres)], r.choice([1, 2, None])) for k in range(n)]
    rows += [(n, [0.25, -0.25] * 8, 1)] * 5 + [(n + 1, [0.0] * 16, None), (None, [0.5] * 16, 3)]
    rows += [(n + 2, None, 1), (n + 3, [None, *[0.0] * 15], 1), (n + 4, [float("nan"), *[0.0] * 15], 2), (n + 5, [float("inf"), *[0.0] * 15], 2)]
    return rows


@pytest.mark.parametrize(("n", "scale"), [(300, 1.0), (5, 1.0), (80, 1e5)])
def test_codes_match_brute_force(spark, n, scale):
    rows = vectors(n, n, scale)
    report = []
    frame = spark.createDataFrame(rows, VECTORS).repartition(3).withColumns({c: F.lit("x") for c in ("code", "error", "entry", "kind")})
    out, books = vector_codes.code_vectors(frame, report=report)
    want, text = brute_codes(rows)
    assert vector_codes.books_text(books) == text
    assert sorted((str(r.vec_id), r.code, r.error, str(r.label)) for r in out.collect()) == want
    # bounds spare scans once entries settle
    assert report[0][1] == 8 * len(want)
    if n == 300:
        assert report[-1][1] < 0.3 * report[0][1] and report[-1][0] <= report[0][0]


def test_carried_bounds_hold():
    """A bound of any earlier round, moved by the net displacement, stays a bound."""
    r = np.random.default_rng(1)
    x = r.integers(-500, 500, (400, 4))
    books = [[r.integers(-500, 500, (6, 4))] for _ in range(5)]
    moved = vector_codes.Movement(books)
    for then in range(5):
        d = np.stack([np.sqrt(vector_codes.squared(x, np.broadcast_to(c, x.shape))) for c in books[then][0]], axis=1)
        now = np.stack([np.sqrt(vector_codes.squared(x, np.broadcast_to(c, x.shape))) for c in books[-1][0]], axis=1)
        steps = sum(np.sqrt(((books[k + 1][0] - books[k][0]) ** 2).sum(axis=1)) for k in range(then, 4)) if then < 4 else np.zeros(6)
        assert (moved.own[then, 0] <= steps + 1e-9).all()
        for e in range(6):
            assert (now[:, e] <= d[:, e] + moved.own[then, 0, e] + 1e-9).all()
            others = np.delete(d, e, axis=1).min(axis=1), np.delete(now, e, axis=1).min(axis=1)
            assert (others[1] >= others[0] - moved.other[then, 0, e] - 1e-9).all()


def test_vectors_of_another_length_and_none(spark):
    rows = [(1, [1.0] * 8, 1), (2, [2.0] * 8, 1), (3, [1.0] * 9, 2), (4, [], 2)]
    out, books = vector_codes.code_vectors(spark.createDataFrame(rows, VECTORS))
    by = {r.vec_id: (r.code, r.error) for r in out.collect()}
    assert by == {1: ("00" * 8, 0), 2: ("01" * 8, 0), 3: (None, None), 4: (None, None)}
    none, books = vector_codes.code_vectors(spark.createDataFrame([(1, None, 1)], VECTORS))
    assert none.count() == 0 and books == []
    with pytest.raises(ValueError, match="8 equal parts"):
        vector_codes.code_vectors(spark.createDataFrame([(1, [1.0] * 9, 1)], VECTORS))


def test_registered_codes(spark):
    from conftest import SF001
    got = vector_codes.op13_vector_codes(spark, SF001).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, text = brute_codes(rows)
    sums = Counter()
    for _, _, e, lab in want:
        sums[lab] += e
    digest = hashlib.sha256(text.encode()).hexdigest()
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == \
        sorted((i, c, e, sums[lab], digest) for i, c, e, lab in want)


def test_rare_phrases_of_frequent_words_are_not_shuffled_as_texts(spark, monkeypatch):
    """Pairs of frequent words are counted by hash first: only those that may be frequent become stripes."""
    rnd, seen = random.Random(5), []
    texts = [" ".join(f"w{rnd.randrange(40)}" for _ in range(400)) for _ in range(20)] + ["alpha beta gamma."] * 120
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(3)
    merge = collocations.merge_stripes

    def counted(parts):
        seen.append(parts.select(F.explode("stripes").alias("s")).agg(F.sum(F.size("s.n"))).head()[0])
        return merge(parts)

    monkeypatch.setattr(collocations, "merge_stripes", counted)
    got = {r.phrase: (r.a, r.l, r.r) for r in collocations.collocations(df, min_count=100).collect()}
    assert got == {"alpha beta gamma": (120, 120, 120)}
    assert seen[0] >= 43 and sum(seen[1:]) < 30


def test_groups_of_a_task_are_added_up_and_rare_words_stay_numbers(spark, monkeypatch):
    """However many groups a task has, each frequent phrase leaves it once, and no rare word leaves it as text."""
    texts = [f"alpha beta gamma. rare{k} " for k in range(120)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").coalesce(1)
    merge, seen = collocations.merge_stripes, []

    def counted(parts):
        seen.append(parts.select(F.explode("stripes").alias("s")).agg(F.sum(F.size("s.n"))).head()[0])
        return merge(parts)

    monkeypatch.setattr(collocations, "merge_stripes", counted)
    got = {r.phrase: (r.a, r.l, r.r, r.n) for r in collocations.collocations(df, min_count=100, group=60).collect()}
    assert got == {"alpha beta gamma": (120, 120, 120, 480)}
    assert sum(seen) <= 6 + 2


@pytest.mark.parametrize("held", [1, 7, 1 << 20])
def test_many_words_and_small_runs_match_brute_force(spark, monkeypatch, held):
    """More words in a group than two bytes number, and tasks that give out what they hold early."""
    monkeypatch.setattr(collocations, "HASHES", held)
    monkeypatch.setattr(collocations, "ENTRIES", held)
    listed, ids, n = collocations._coded([" ".join(f"w{i}" for i in range(70_000)).encode(), b"", b". ;x Y"])
    assert n == 70_002 and ids.max() == 70_002 and listed.split(b" ")[-2:] == [b"x", b"y"]
    rows = [("en", " ".join(f"w{i}" for i in range(66_000)) + " a b c"), ("en", "a b c. w65999 a b"), (None, "a b, a b"), ("en", None)]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = collocations.collocations(df, min_count=2, group=1 << 20).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 2, 2000) and got


def test_texts_of_frequent_phrases_come_from_one_part_each(spark, monkeypatch):
    """However many tasks have a frequent phrase, its text leaves one of them, with its count over all."""
    texts = [f"alpha beta gamma. rare{k}" for k in range(160)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(8)
    merge, seen = collocations.merge_stripes, []

    def counted(parts):
        seen.append(parts.select(F.explode("stripes").alias("s")).agg(F.sum(F.size("s.n"))).head()[0])
        return merge(parts)

    monkeypatch.setattr(collocations, "merge_stripes", counted)
    got = {r.phrase: (r.a, r.l, r.r, r.n) for r in collocations.collocations(df, min_count=100).collect()}
    assert got == {"alpha beta gamma": (160, 160, 160, 640)}
    assert 6 <= sum(seen) <= 6 + 2


def test_equal_hashes_are_told_apart_by_checks(spark, monkeypatch):
    """With one hash for all words, and so for all phrases of a length, counts are right all the same."""
    hashed = collocations._word_hashes

    def alike(lang, words):
        h, checks = hashed(lang, words)
        return np.where(np.arange(len(h)) > 0, np.uint64(7), np.uint64(0)), checks

    monkeypatch.setattr(collocations, "_word_hashes", alike)
    rnd = random.Random(9)
    rows = [(rnd.choice(["en", "de", None]), " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(30)))) for _ in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(df, min_count=3, group=100).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 3, 2000) and got


def test_fingerprints_of_rows_are_those_of_texts(spark):
    df = spark.createDataFrame([("en", "a B ü. 日本 x\x1cy a"), ("de", "a b"), (None, "a b")], "lang string, text string").repartition(2)
    coded = collocations.coded_texts(df)
    every = np.full(collocations.FILTER_BITS // 8, 255, np.uint8)
    for k in range(1, 4):
        parts = collocations.coded_stripes(coded, k, None if k == 1 else every)
        rows = collocations.fingerprints(collocations.merge_stripes(parts)).collect()
        of_texts = collocations.coded_hashes(coded, [every] * (k - 1)).collect()
        assert sorted((r.h, r.c) for r in rows) == sorted((r.h, r.c) for r in of_texts)
        assert len({(r.h, r.c) for r in rows}) == len(rows) == {1: 9, 2: 6, 3: 2}[k]


def test_entries_that_add_up_to_few_stay_in_the_task(spark, monkeypatch):
    """A task that holds as many entries as it may adds them up first, and gives each out once if they are few then."""
    texts = [f"alpha beta gamma. rare{k} " for k in range(120)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").coalesce(1)
    merge, seen = collocations.merge_stripes, []

    def counted(parts):
        seen.append(parts.select(F.explode("stripes").alias("s")).agg(F.sum(F.size("s.n"))).head()[0])
        return merge(parts)

    monkeypatch.setattr(collocations, "merge_stripes", counted)
    monkeypatch.setattr(collocations, "ENTRIES", 20)
    got = {r.phrase: (r.a, r.l, r.r, r.n) for r in collocations.collocations(df, min_count=100, group=60).collect()}
    assert got == {"alpha beta gamma": (120, 120, 120, 480)}
    assert sum(seen) <= 6 + 2
