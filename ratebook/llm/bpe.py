"""Byte-level BPE encoding and decoding from a rank file.

A piece (one match of the pre-tokenizer's pattern) starts as its single bytes.  A segment tree over
the byte positions holds, for every live token start, the rank of the pair it forms with its live
right neighbour; the root is the leftmost minimum.  Each merge updates the merged pair, its left
neighbour and the removed position: three logarithmic point updates, so a piece of n bytes takes
O(n log n) however long it is.

Spark deals the documents; a task walks Arrow batches, cuts texts at safe points (``chunks``) and
memoizes parts, since words repeat.  The memo is bounded and never changes a result.  The pieces that
are new in a group of documents merge side by side: one tree per piece, pieces of like length as rows
of one array, and each step does the next merge of every row (``merge_pieces``).  A length with few
pieces is merged piece by piece with the same tree (``merge_piece``).

Null text is empty: no tokens.  Any other column of the input is left out of the result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ratebook.llm.chunks import Memo, cut, text_groups
from ratebook.llm.common import ship_package
from ratebook.sources.tables import table

RANKS = "byte_bpe_multi_50k.tiktoken"
MEMO_ENTRIES = 400_000
GROUP = 1 << 21             # characters of documents whose ids are held at once (one document at least)
ROWS = 1 << 20              # tree leaves merged side by side
FEW = 8                     # pieces of a length below which they are merged one by one
MEMO_CHARS = 256            # longer parts and pieces are not memoized
NO_RANK = 1 << 62
# The white space of the pattern's \s, named one by one: Python's own \s also takes U+001C to U+001F.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def piece_pattern(pattern: str = public_tokenizers.PATTERN) -> regex.Pattern:
    """The pre-tokenizer's pattern with \\s and \\S spelled out."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two == r"\s":
            out.append(_WHITE if inside else f"[{_WHITE}]")
            i += 2
        elif two == r"\S":
            out.append(f"[^{_WHITE}]")
            i += 2
        elif pattern[i] == "\\":
            out.append(two)
            i += 2
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out.append(pattern[i])
            i += 1
    return regex.compile("".join(out))


def pair_table(ranks: dict[bytes, int]) -> list[int]:
    """The rank of every two-byte pair at ``256 * first + second``, ``NO_RANK`` where there is none."""
    return [ranks.get(bytes((a, b)), NO_RANK) for a in range(256) for b in range(256)]


def merge_piece(piece: bytes, ranks: dict[bytes, int], pairs: list[int]) -> list[int]:
    """Token ids of one piece by leftmost lowest-rank merges, with a segment tree of pair ranks."""
    n, none = len(piece), NO_RANK
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    # A leaf is rank << bits | position, so the smallest value is the leftmost of the lowest rank.  Leaf i is
    # tree[n + i], and node k the minimum of nodes 2k and 2k + 1, whatever n is: node 1 covers every leaf.
    bits = n.bit_length()
    low = (1 << bits) - 1
    tree = [none] * n
    tree += [r << bits | i if (r := pairs[a << 8 | b]) < none else none
             for i, (a, b) in enumerate(zip(piece, piece[1:], strict=False))]
    tree.append(none)
    for k in range(n - 1, 0, -1):
        x, y = tree[k + k], tree[k + k + 1]
        tree[k] = x if x < y else y
    end = list(range(1, n + 1))         # end[i]: where the live token that starts at i ends
    before = list(range(-1, n - 1))     # start of the live token to the left
    get = ranks.get
    while (best := tree[1]) != none:
        i = best & low
        j = end[i]
        end[i] = e = end[j]
        tree[n + j] = none              # the position leaves the tree
        if e < n:
            before[e] = i
            r = get(piece[i:end[e]])
            tree[n + i] = none if r is None else r << bits | i
        else:
            tree[n + i] = none
        h = before[i]
        if h >= 0:
            r = get(piece[h:e])
            tree[n + h] = none if r is None else r << bits | h
            changed = (n + j, n + i, n + h)
        else:
            changed = (n + j, n + i)
        for k in changed:
            k >>= 1
            while k:
                x, y = tree[k + k], tree[k + k + 1]
                if y < x:
                    x = y
                if tree[k] == x:
                    break               # nothing above changes
                tree[k] = x
                k >>= 1
    out, i = [], 0
    while i < n:
        e = end[i]
        out.append(ranks[piece[i:e]])
        i = e
    return out


class PairRanks:
    """Ranks of adjacent tokens by their ids, for whole arrays: a sorted list of the pairs that merge."""

    def __init__(self, ranks: dict[bytes, int]):
        get, found = ranks.get, {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = get(token[:k]), get(token[k:])
                if a is not None and b is not None:
                    found[a << 32 | b] = rank
        keys = np.fromiter(found.keys(), np.int64, len(found))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(NO_RANK))
        self.ranks = np.append(np.fromiter(found.values(), np.int64, len(found))[order], np.int64(NO_RANK))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)


def merge_pieces(pieces: list[bytes], width: int, byte_ids: np.ndarray, ranks: PairRanks) -> list[bytes]:
    """``merge_piece`` for pieces of at most ``width`` (a power of two) bytes, all rows at once: ids of each
    piece as little-endian unsigned 32-bit integers."""
    n_rows, none = len(pieces), NO_RANK
    size = np.fromiter(map(len, pieces), np.int64, n_rows)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n_rows, width)
    place = np.arange(width)
    live = place < size[:, None]                    # starts of live tokens
    token = byte_ids[raw]
    end = np.tile(place + 1, (n_rows, 1))
    before = np.tile(place - 1, (n_rows, 1))
    tree = np.full((n_rows, 2 * width), none, np.int64)
    pair = ranks.of(token[:, :-1], token[:, 1:])
    tree[:, width:-1] = np.where((pair < none) & live[:, 1:], pair * width + place[:-1], none)
    k = width // 2
    while k:
        tree[:, k:2 * k] = np.minimum(tree[:, 2 * k:4 * k:2], tree[:, 2 * k + 1:4 * k:2])
        k //= 2
    row = np.arange(n_rows)
    while True:
        best = tree[row, 1]
        more = best != none
        row, best = row[more], best[more]
        if not len(row):
            break
        i, rank = best & (width - 1), best // width
        j = end[row, i]
        e = end[row, j]
        end[row, i], live[row, j], token[row, i] = e, False, rank
        right, h = e < size[row], before[row, i]
        left, after = h >= 0, np.minimum(e, width - 1)
        before[row[right], e[right]] = i[right]
        tree[row, width + j] = none
        r = np.where(right, ranks.of(rank, token[row, after]), none)
        tree[row, width + i] = np.where(r < none, r * width + i, none)
        h = np.where(left, h, 0)
        r = np.where(left, ranks.of(token[row, h], rank), none)
        r = np.where(r < none, r * width + h, none)
        tree[row[left], width + h[left]] = r[left]
        nodes, rows3 = np.concatenate([width + i, width + j, np.where(left, width + h, width + i)]), np.concatenate([row] * 3)
        for _ in range(width.bit_length() - 1):     # every level is whole before the next one
            nodes >>= 1
            tree[rows3, nodes] = np.minimum(tree[rows3, 2 * nodes], tree[rows3, 2 * nodes + 1])
    ids = token[live].astype("<u4").tobytes()
    ends = np.cumsum(live.sum(axis=1)) * 4
    return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, memo: int = MEMO_ENTRIES):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.pairs, self.pair_ranks = pair_table(self.ranks), PairRanks(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes((b,))] for b in range(256)], np.int64)
        self.pattern = piece_pattern()
        self.pieces, self.parts = Memo(memo), Memo(memo)

    def merged(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each piece."""
        out, by_width = {}, {}
        for p in pieces:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[p] = whole.to_bytes(4, "little")
            else:
                by_width.setdefault(1 << (len(raw) - 1).bit_length(), []).append((p, raw))
        for width, some in by_width.items():
            if len(some) < FEW:
                for p, raw in some:
                    out[p] = np.array(merge_piece(raw, self.ranks, self.pairs), "<u4").tobytes()
                continue
            step = max(FEW, ROWS // width)
            for at in range(0, len(some), step):
                rows = some[at:at + step]
                found = merge_pieces([raw for _, raw in rows], width, self.byte_ids, self.pair_ranks)
                out.update(zip([p for p, _ in rows], found, strict=True))
        return out

    def _ids_of(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of each part, by its pieces."""
        found = [self.pattern.findall(p) for p in parts]
        fresh = self.merged(list(self.pieces.missing(chain.from_iterable(found))))
        known = self.pieces.young
        known.update(fresh)
        out = {p: b"".join([known[x] for x in f]) for p, f in zip(parts, found, strict=True)}
        for p in fresh:
            if len(p) > MEMO_CHARS:
                del known[p]
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cuts = [cut(t) for t in texts]
        known = self.parts.young
        fresh = self._ids_of(list(self.parts.missing(chain.from_iterable(cuts))))
        known.update(fresh)
        out = [b"".join(map(known.__getitem__, c)) for c in cuts]
        for p in fresh:
            if len(p) > MEMO_CHARS:
                del known[p]
        self.parts.room()
        self.pieces.room()
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process; its memo lives on between tasks."""
    return Codec(path)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str | None = None,
               with_ids: bool = False) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the text decoded from them, and the ids
    themselves (array<int>) if asked for."""
    path = ranks or public_tokenizers.path(RANKS)
    ship_package(docs.sparkSession)
    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            for some in text_groups(b, GROUP):
                n, of_ids, of_text, rows = [], [], [], []
                for data in c.encode_batch([x or "" for x in some.column(1).to_pylist()]):
                    ids = np.frombuffer(data, "<u4").tolist()
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                    of_text.append(hashlib.sha256(c.decode(ids)).hexdigest())
                    if with_ids:
                        rows.append(pa.array(ids, pa.int32()))
                out = [some.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
                yield pa.record_batch(out + [pa.array(rows, pa.list_(pa.int32()))] * with_ids, names)

    kind = docs.schema[key].dataType.simpleString()
    out = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(key, text).mapInArrow(run, out).withColumnRenamed("key", key)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents", "doc_id", "text"))
