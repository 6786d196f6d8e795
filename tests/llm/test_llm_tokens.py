"""Byte-level BPE, token files and chat windows: exact round trips and the libraries' own results."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_data import DOCS, edge_documents, prose, with_extras
from tokenizers import Tokenizer

from ratebook.llm import bpe, chat_windows, chunks, token_files
from ratebook.llm.common import scratch

ALPHABET = [" ", "  ", "\n", "\t", "\r", "\x1c", "\x1f", "\u2003", "\u00a0", "\x85", "a", "B", "é", "ß", "1", "９", "!", "'s", "'ll",
            "日本", "🙂", "\u0301", "the", " of", "\0", "x" * 40, "\u200b", "\u180e", "ǅ", "Ⅷ", "²", "<|endoftext|>"]


def texts(n, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))


def test_cuts_are_whole():
    for t in texts(3000):
        assert "".join(chunks.cut(t)) == t and "".join(chunks._cut_slow(t)) == t


def test_memo_is_bounded():
    m = chunks.Memo(10)
    for k in range(100):
        for x in m.missing([k, 0]):
            m.young[x] = -x
        m.room()
        assert m.young.get(0, m.old.get(0)) == 0 and len(m.young) + len(m.old) <= 22


def test_encoding_matches_the_library(reference):
    c = bpe.Codec(public_tokenizers.path(bpe.RANKS), memo=50)
    for t in [*texts(3000), *(t or "" for _, t in edge_documents()), "ab" * 4000 + "é" * 3000, "a" * 20000]:
        ids = c.encode(t)
        assert ids == reference.encode_ordinary(t) and c.decode(ids) == t.encode()


def test_round_trip_of_documents(spark, reference):
    rows = edge_documents()
    got = bpe.round_trip(with_extras(spark.createDataFrame(rows, DOCS)), with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest(), ids))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trip(spark.createDataFrame([], DOCS)).count() == 0


def test_pieces_merge_alike_side_by_side_and_one_by_one(reference):
    c = bpe.Codec(public_tokenizers.path(bpe.RANKS))
    r = random.Random(9)
    for width in (2, 8, 64):
        pieces = [bytes(r.choice(b"aabbeht\xc3\xa9 \xff") for _ in range(r.randint(1, width))) for _ in range(200)]
        pieces = [p for p in pieces if p not in c.ranks]
        side = bpe.merge_pieces(pieces, width, c.byte_ids, c.pair_ranks)
        for p, ids in zip(pieces, side, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == bpe.merge_piece(p, c.ranks, c.pairs) == reference._encode_single_piece(p)


def test_special_token_strings_are_the_library_s(library):
    e = token_files.Encoder(public_tokenizers.path(token_files.TOKENIZER))
    for t in ["a <|endoftext|> b", "<|endoftext|>\n\n x<|endoftext|>y <|endoftext", *texts(500, 8)]:
        assert np.frombuffer(e.encode_batch([t, ""])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert 50256 in library.encode("a <|endoftext|> b", add_special_tokens=False).ids


def test_segments_give_any_token():
    r = random.Random(1)
    for n in (1, 7, 511, 512, 513, 3000):
        ids = np.array([r.choice([0, 3, 255, 256, 50000, 70000, 1 << 25, (1 << 32) - 1]) for _ in range(n)], np.uint32)
        s = token_files.Segment(token_files.pack_segment(ids, [(5, 0, 0)]))
        assert (s.tokens() == ids).all() and [s.token(i) for i in range(n)] == ids.tolist()
        with pytest.raises(IndexError):
            s.token(n)


def test_crc_of_joined_strings():
    a, b = b"some bytes" * 99, b"others"
    assert token_files.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert token_files.crc_join(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


@pytest.mark.parametrize("segment", [token_files.SEGMENT, 97])
def test_token_files_of_documents(spark, library, segment):
    rows = edge_documents()
    path = scratch(spark, "test")
    token_files.write_tokens(with_extras(spark.createDataFrame(rows, DOCS)), path, segment=segment)
    got = token_files.document_digests(spark, path).collect()
    size = {i: 0 for i, _ in rows}
    want = defaultdict(list)
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, token_files.END_ID]
        want[i].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        size[i] += len(ids)
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.start, r.n_tokens, r.ids_crc32))
    at = 0
    for i in sorted(want, key=lambda x: (x is not None, x or 0)):       # null ids first
        assert sorted((n, c) for _, n, c in have[i]) == sorted((n, c) for n, c, _ in want[i])
        starts = sorted((s, n) for s, n, _ in have[i])
        for s, n in starts:
            assert s == at
            at += n
    one = want[11][0][2]
    start = have[11][0][0]
    assert [token_files.read_token(spark, path, start + k) for k in range(len(one))] == one
    assert token_files.read_token(spark, path, at) is None and token_files.read_token(spark, path, -1) is None


def test_no_documents_make_empty_files(spark):
    path = scratch(spark, "test")
    token_files.write_tokens(spark.createDataFrame([], DOCS), path)
    assert token_files.document_digests(spark, path).count() == 0


# ------------------------------------------------------------------ chat

def conversations():
    r = random.Random(4)
    rows = [(1, 0, "system", "be kind"), *[(1, k, "user" if k % 2 else "assistant", prose(k, r.choice([5, 40, 90]))) for k in range(1, 60)],
            (2, 0, "user", None), (2, 1, "assistant", None), (3, 0, "user", "a"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"),
            (4, 0, "assistant", chat_windows.EXTRA_TEXT + "</turn>\n### user: \\"), (5, 0, "ro:le\\#", "odd role"), (5, 1, None, "no role"),
            (6, 0, "assistant", "x y " * 3000), (6, 1, "user", "after the long one"), (None, 1, "user", "q"), (None, 2, "assistant", "a"),
            (7, None, "assistant", "null turn"), (7, 1, "user", "then")]
    rows += [(8, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(300)]
    r.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment", [1024, 16])
def test_windows_read_back(spark, segment):
    rows = conversations()
    budget = 200
    windows = chat_windows.format_windows(with_extras(spark.createDataFrame(rows, SCHEMA)), budget, 60, 4, segment).cache()
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    got = defaultdict(list)
    for w in windows.collect():
        got[w.conv_id].append(w)
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [(t[2], t[3]) for t in sorted(turns, key=lambda t: t[:3])]
        seen, targets = [], []
        for w in sorted(got[c], key=lambda w: w.first):
            read = chat_windows.read_turns(w.text)
            context, new = read[:w.n_context], read[w.n_context:]
            assert new and w.first == len(seen)
            assert w.tokens <= budget or len(new) == 1
            assert len(context) <= 5
            if w.first and turns[0][0] == "system":
                assert context[0] == turns[0]
            seen += new
            said = [chat_windows._plain(w.text[s.start:s.end]) for s in w.loss]
            assert said == [t for role, t in new if role == "assistant"]
            targets += said
        # equal (turn, role) pairs follow a hash of their text: compare without their order
        assert sorted(seen) == sorted(turns) and [r for r, _ in seen] == [r for r, _ in turns]
        assert sorted(targets) == sorted(t for r, t in turns if r == "assistant")
    whole = {r.conv_id: r for r in chat_windows.conversation_digests(windows).collect()}
    for c, turns in by.items():
        if c != 3:
            t = [(x[2], x[3]) for x in sorted(turns)]
            assert whole[c].n_turns == len(t)
            assert whole[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest()
            a = "".join(x for r, x in t if r == "assistant")
            assert (whole[c].loss_chars, whole[c].loss_sha256) == (len(a), hashlib.sha256(a.encode()).hexdigest())
    windows.unpersist()


def test_long_system_turn_is_not_repeated(spark):
    """A system turn of three budgets before 200 turns: what is written stays in proportion."""
    rows = [(1, 0, "system", "rule " * 600), *[(1, k, "user" if k % 2 else "assistant", prose(k, 6)) for k in range(1, 201)],
            (2, 0, "system", "brief"), *[(2, k, "user" if k % 2 else "assistant", prose(k, 6)) for k in range(1, 60)]]
    windows = chat_windows.format_windows(spark.createDataFrame(rows, SCHEMA), 200, 60, 4).collect()
    said = sum(len(t) for _, _, _, t in rows)
    assert sum(len(w.text) for w in windows) < 4 * said
    for w in windows:
        first = w.first == 0
        assert w.tokens <= 200 or (first and w.conv_id == 1)
        assert ("rule rule" in w.text) == (first and w.conv_id == 1)
        assert ("brief" in w.text) == (w.conv_id == 2)
    whole = {r.conv_id: r for r in chat_windows.conversation_digests(spark.createDataFrame(windows)).collect()}
    for c in (1, 2):
        turns = [(r, t) for k, _, r, t in rows if k == c]
        assert whole[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_registered_chat_holds_the_extra_conversation(spark):
    from conftest import SF001
    got = {r.conv_id: r for r in chat_windows.op1_chat_windows(spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/conversations.parquet")
    assert len(got) == rows.select("conv_id").distinct().count() + 1
    x = chat_windows.EXTRA_TEXT
    r = got[chat_windows.EXTRA_ID]
    assert (r.n_turns, r.loss_chars) == (2, len(x))
    assert r.turns_sha256 == hashlib.sha256(f"user\n{x}\nassistant\n{x}\n".encode()).hexdigest()
    assert r.loss_sha256 == hashlib.sha256(x.encode()).hexdigest()
    assert sum(k.n_turns for k in got.values()) == rows.count() + 2


def test_no_conversations(spark):
    w = chat_windows.format_windows(spark.createDataFrame([], SCHEMA))
    assert w.count() == 0 and chat_windows.conversation_digests(w).count() == 0


def test_new_parts_are_encoded_in_rows():
    """One library text holds many new parts; ids are those of whole texts, special tokens and odd spaces included."""
    import public_tokenizers
    from ratebook.llm import token_files
    e = token_files.Encoder(public_tokenizers.path(token_files.TOKENIZER))
    library, sent = e.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            sent.extend(texts)
            return library.encode_batch_fast(texts, **kw)

    e.tokenizer = Counted()
    texts = [" ".join(f"wörd{i}x{j}," for i in range(300)) for j in range(3)]
    texts += ["", "a<|endoftext|>b <|endoftext|> c\n\n d 　 e", " <|endo ftext|> \0 x  y", "日本語 テキスト\r\n\t z "]
    got = e.encode_batch(texts)
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode_batch(texts) == got and len(sent) < 100


def test_a_word_before_punctuation_is_encoded_once(library):
    """A word is one part whatever mark follows it; ids stay those of whole texts."""
    e = token_files.Encoder(public_tokenizers.path(token_files.TOKENIZER))
    sent = []

    class Counted:
        def encode_batch_fast(self, some, **kw):
            sent.extend(some)
            return library.encode_batch_fast(some, **kw)

    e.tokenizer = Counted()
    marks = [",", ".", "!", "?", ";", ":", ")", "]", "&&&", "$$$", "...", ""]
    rows = [" ".join(f"wörd{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}{m}" for i in range(100)) for m in marks]
    rows += ["it's o'clock's, x|y<|endoftext|>.z <|endoftext|>, a.b's", "é  a ü  b 日　 c —  d \n e\x85 f 🙂 g “q” h", "a᠎ b", ""]
    got = e.encode_batch(rows)
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in rows]
    assert sum(map(len, sent)) < 3000
    ids, ends = e.encode_column(pa.array(["x", None, "", *rows, None])[1:])
    assert ids.tobytes() == b"".join(got) and ends.tolist() == [0, 0, *np.cumsum([len(g) // 4 for g in got]).tolist(), sum(map(len, got)) // 4]
