"""Token ids in a directly addressable binary format.

Ids are split into byte-sized chunk levels.  Level 0 holds every id's low byte; a continuation
bitmap marks the ids that go on, level 1 holds the next byte of just those, and so on.  A rank
directory (the number of set bits before every 512-bit block) turns "how many ids before me go on"
into one lookup and a short popcount, so any token is read from a few fixed places: no block is
decoded.

Layout on disk (a Parquet data set, uncompressed, so Spark's committer makes it whole on any store
and a lost executor's attempt leaves nothing behind): ``segments`` holds one row per ``SEGMENT``
tokens of a part's stream, with the binary segment; ``parts`` holds each part's first token.  Parts
are ranges of (doc_id, text hash), so the concatenation of parts in order is ascending by doc_id;
repeated doc_ids follow each other, ordered by text; null ids come first.

Null text is empty and holds only the end id.  Extra columns are left out; ids are cast to bigint.  Every document has at least that token.  Long
documents run over several segments, so no row grows with a document.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebook.llm.chunks import Memo, text_groups
from ratebook.llm.common import scratch, ship_package, shuffle_partitions
from ratebook.sources.tables import table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SEGMENT = 1 << 18           # tokens in a segment
BLOCK = 512                 # bits a rank directory entry covers
MEMO_ENTRIES = 800_000
MEMO_BYTES = 256            # longer parts are not memoized
CHAIN = 256                 # new parts that are encoded as one text
GROUP = 1 << 22             # characters of documents that are encoded together (one document at least)
MAGIC = b"DAC1"
STOPS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"     # ASCII punctuation but the apostrophe, which may belong to the letters before
_LETTERS = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


# ------------------------------------------------------------------ the binary segment

def pack_segment(ids: np.ndarray, docs: list[tuple[int | None, int, int]]) -> bytes:
    """``ids`` (uint32) as chunk levels, and the document pieces in them: (doc_id, ordinal of the
    document in its part, first position here); a piece ends where the next begins."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        low, high = (rest & 0xFF).astype(np.uint8), rest >> 8
        more = high > 0
        levels.append((low, more))
        if not more.any():
            break
        rest = high[more]
    head = [MAGIC, struct.pack("<IIB", len(ids), len(docs), len(levels))]
    head.append(np.array([d[0] is not None for d in docs], np.uint8).tobytes())
    head.append(np.array([d[0] or 0 for d in docs], "<i8").tobytes())
    head.append(np.array([d[1] for d in docs], "<i8").tobytes())
    head.append(np.array([d[2] for d in docs], "<u4").tobytes())
    for low, more in levels:
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        per_block = _POP[bits].reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(per_block)])[:-1].astype("<u4") if len(per_block) else per_block
        head += [struct.pack("<I", len(low)), low.tobytes(), bits.tobytes(), ranks.tobytes()]
    return b"".join(head)


class Segment:
    """A view of a packed segment: nothing is unpacked until asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token segment")
        self.n, self.n_docs, n_levels = struct.unpack_from("<IIB", data, 4)
        at = 13
        self.has_id = np.frombuffer(data, np.uint8, self.n_docs, at)
        at += self.n_docs
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, at)
        self.ordinals = np.frombuffer(data, "<i8", self.n_docs, at + 8 * self.n_docs)
        self.starts = np.frombuffer(data, "<u4", self.n_docs, at + 16 * self.n_docs)
        at += 20 * self.n_docs
        self.levels = []
        for _ in range(n_levels):
            (m,) = struct.unpack_from("<I", data, at)
            n_bits = -(-m // BLOCK) * (BLOCK // 8)
            low = np.frombuffer(data, np.uint8, m, at + 4)
            bits = np.frombuffer(data, np.uint8, n_bits, at + 4 + m)
            ranks = np.frombuffer(data, "<u4", n_bits // (BLOCK // 8), at + 4 + m + n_bits)
            self.levels.append((low, bits, ranks))
            at += 4 + m + n_bits + 4 * len(ranks)

    def token(self, i: int) -> int:
        """The id at position ``i``: one byte per level, found by rank."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for low, bits, ranks in self.levels:
            value |= int(low[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            first = block * (BLOCK // 8)
            i = int(ranks[block]) + int(_POP[bits[first:i >> 3]].sum()) + int(_POP[bits[i >> 3] & ((1 << (i & 7)) - 1)])
            shift += 8
        return value

    def tokens(self) -> np.ndarray:
        """Every id, level by level (a scan)."""
        out = np.zeros(self.n, np.uint32)
        at = np.arange(self.n)
        for k, (low, bits, _) in enumerate(self.levels):
            out[at] |= low.astype(np.uint32) << (8 * k)
            at = at[np.unpackbits(bits, bitorder="little", count=len(low)).astype(bool)]
        return out


# ------------------------------------------------------------------ encoding

def _follows_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters of several bytes that end just before ``at`` are white space (or once were: U+180E)."""
    a, b, c = data[np.maximum(at - 3, 0)], data[at - 2], data[at - 1]
    return (((b == 0xC2) & ((c == 0x85) | (c == 0xA0)))
            | ((a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E))))
            | ((a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))))
            | ((a == 0xE3) & (b == 0x80) & (c == 0x80)))


def _cuts(data: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Where no token of running text (UTF-8) can span: before a space or line feed after a non-space (as in
    ``chunks``), and before a byte of ``stops`` after an ASCII letter, since a run of letters is whole there."""
    before, here = data[:-1], data[1:]
    gap = (here == 0x20) | (here == 0x0A)
    mark = gap & (before > 0x20) | _LETTERS[before] & stops[here]
    wide = np.flatnonzero(gap & (before >= 0x80)) + 1
    mark[wide[_follows_space(data, wide)] - 1] = False
    return np.flatnonzero(mark) + 1


def listed(values: pa.BinaryArray) -> list[bytes]:
    """``to_pylist`` of an array without nulls that is no slice, by slices of its one buffer."""
    if not len(values):
        return []
    edges = np.frombuffer(values.buffers()[1], np.int32)[:len(values) + 1].tolist()
    return list(map(values.buffers()[2].to_pybytes().__getitem__, map(slice, edges, edges[1:])))


class Encoder:
    """Ids of texts with the tokenizers library; parts between safe cuts are memoized.

    A group's distinct parts are found in its Arrow buffer, so that Python sees each once a group.
    A special token's string in a text is that token, as the library has it; it holds no white space,
    and no stop is a character of one, so no cut falls inside it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.memo = Memo(MEMO_ENTRIES)
        # bytes of text that each id stands for: a byte-level token has one character a byte, an added one its own text
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
        added = self.tokenizer.get_added_tokens_decoder()
        for token, i in self.tokenizer.get_vocab().items():
            if i >= len(self.n_bytes):
                self.n_bytes = np.append(self.n_bytes, np.zeros(i + 1 - len(self.n_bytes), np.int64))
            self.n_bytes[i] = len(token.encode()) if i in added else len(token)
        self.stops = np.zeros(256, bool)
        self.stops[list(set(STOPS) - {b for t in added.values() for b in t.content.encode()})] = True

    def _one_by_one(self, parts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)] if parts else []
        return zip(parts, (np.array(i, "<u4").tobytes() for i in ids), strict=True)

    def _in_a_row(self, parts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Parts encoded as one text, whose ids are told apart by the bytes they stand for."""
        ids = np.array(self.tokenizer.encode_batch_fast([b"".join(parts).decode()], add_special_tokens=False)[0].ids, "<u4")
        reached = np.cumsum(self.n_bytes[ids])
        wanted = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        ends = np.searchsorted(reached, wanted)
        if not len(ids) or reached[-1] != wanted[-1] or (reached[ends] != wanted).any():
            return self._one_by_one(parts)
        raw, ends = ids.tobytes(), (4 * (ends + 1)).tolist()
        return zip(parts, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=True)

    def _learn(self, new: list[bytes]) -> None:
        """Put the ids of new parts into the memo; they go to the library in rows."""
        known, chained, alone = self.memo.young, [], []
        for p in new:
            # a part that starts at a safe cut and ends in no space may follow another one in a text
            if p[0] in b" \n" and p[-1] > 0x20 and (p[-1] < 0x80 or not p[-4:].decode(errors="ignore")[-1:].isspace()):
                chained.append(p)
            else:
                alone.append(p)
        known.update(self._one_by_one(alone))
        for i in range(0, len(chained), CHAIN):
            known.update(self._in_a_row(chained[i:i + CHAIN]))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (null: empty), and where each text's ids end."""
        texts = texts.fill_null("").cast(pa.string())
        n_texts = len(texts)
        edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n_texts + 1] if n_texts else np.zeros(1, np.int32)
        if edges[0] == edges[-1]:
            return np.zeros(0, "<u4"), np.zeros(n_texts, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[edges[0]:edges[-1]]
        edges = edges - edges[0]
        mark = np.zeros(len(data) + 1, bool)
        mark[_cuts(data, self.stops)] = True
        mark[edges] = True
        bounds = np.flatnonzero(mark)
        parts = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        which, distinct = parts.indices.to_numpy(), listed(parts.dictionary)

        new = self.memo.missing(distinct)
        self._learn(list(new))
        known = self.memo.young
        raw = list(map(known.__getitem__, distinct))
        for p in new:
            if len(p) > MEMO_BYTES:
                del known[p]
        self.memo.room()
        # each part's ids are copied from the group's distinct ones to their places
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        each = size[which]
        ends = np.cumsum(each)
        shift = (np.cumsum(size) - size)[which] - (ends - each)
        ids = np.frombuffer(b"".join(raw), "<u4")[np.repeat(shift, each) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[np.searchsorted(bounds, edges[1:])]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, ends = self.encode_column(pa.array(texts, pa.string()))
        return [some.tobytes() for some in np.split(ids, ends[:-1])] if texts else []


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # a task has one core
    return Encoder(path)


class _Stream:
    """Tokens of a part's documents in order, given out as packed segments of ``size`` tokens."""

    def __init__(self, size: int):
        self.size, self.runs, self.docs, self.held, self.n_docs = size, [], [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple[int, bytes]]:
        at = 0
        while at < len(ids):
            self.docs.append((doc_id, self.n_docs, self.held))
            take = min(len(ids) - at, self.size - self.held)
            self.runs.append(ids[at:at + take])
            at, self.held = at + take, self.held + take
            if self.held == self.size:
                yield self.flush()
        self.n_docs += 1

    def flush(self) -> tuple[int, bytes]:
        out = self.held, pack_segment(np.concatenate(self.runs), self.docs)
        self.runs, self.docs, self.held = [], [], 0
        return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 segment: int = SEGMENT) -> None:
    """Encode (doc_id, text) and write ``path``/segments and ``path``/parts, ascending by doc_id."""
    spark = docs.sparkSession
    source = tokenizer or public_tokenizers.path(TOKENIZER)
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, e, stream, number = TaskContext.get().partitionId(), encoder(source), _Stream(segment), 0

        def row(n: int, data: bytes) -> pa.RecordBatch:
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                                    pa.array([n], pa.int64()), pa.array([data], pa.binary())],
                                   ["part", "segment", "n_tokens", "data"])

        for b in batches:
            for some in text_groups(b, GROUP):
                ids, ends = e.encode_column(some.column(1))
                ids, ends = np.insert(ids, ends, end_id), (ends + np.arange(1, len(ends) + 1)).tolist()
                for key, a, z in zip(some.column(0).to_pylist(), [0, *ends], ends, strict=False):
                    for n, data in stream.add(key, ids[a:z]):
                        yield row(n, data)
                        number += 1
        if stream.held:
            yield row(*stream.flush())

    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = (docs.select("doc_id", "text").repartitionByRange(shuffle_partitions(spark), *order)
             .sortWithinPartitions(*order, "text"))
    segments = dealt.mapInArrow(run, "part int, segment int, n_tokens long, data binary")
    segments.write.option("compression", "none").parquet(f"{path}/segments")
    # one row per part: as many as the write had tasks
    sizes = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    first = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes.select("part", F.coalesce(first, F.lit(0)).cast("bigint").alias("first")) \
        .write.parquet(f"{path}/parts")


def read_token(spark: SparkSession, path: str, position: int) -> int | None:
    """The id at a global position: the part by its first token, the segment by division, the token by rank."""
    part = spark.read.parquet(f"{path}/parts").where(F.col("first") <= position).orderBy(F.desc("first"), F.desc("part")).head()
    if part is None or position < 0:
        return None
    at = position - part["first"]
    sizes = spark.read.parquet(f"{path}/segments").where((F.col("part") == part["part"]))
    size = sizes.agg(F.max("n_tokens")).head()[0]
    row = sizes.where(F.col("segment") == at // size).select("data").head()
    return None if row is None or at % size >= Segment(row["data"]).n else Segment(row["data"]).token(at % size)


def crc_join(a: int, b: int, length: int) -> int:
    """CRC-32 of two byte strings put together, from both CRCs and the second one's length."""
    # appending ``length`` zero bytes to the first is linear: square the one-zero-bit operator as needed
    def times(m, v):
        out, i = 0, 0
        while v:
            if v & 1:
                out ^= m[i]
            v >>= 1
            i += 1
        return out

    op = [0xEDB88320] + [1 << i for i in range(31)]      # one zero bit (the CRC's fixed polynomial)
    bits = 8 * length
    while bits:
        if bits & 1:
            a = times(op, a)
        bits >>= 1
        op = [times(op, x) for x in op]
    return a ^ b


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: per document its first token's position, length and CRC-32."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                s = Segment(b.column(2)[k].as_py())
                raw, n = s.tokens().astype("<u4").tobytes(), s.n_docs
                ends = [*map(int, s.starts[1:]), s.n]
                crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(map(int, s.starts), ends, strict=True)]
                yield pa.record_batch([
                    pa.array([b.column(0)[k].as_py()] * n, pa.int32()), pa.array([b.column(1)[k].as_py()] * n, pa.int32()),
                    pa.array(s.ordinals, pa.int64()), pa.array(s.doc_ids, pa.int64(), mask=s.has_id == 0),
                    pa.array(s.starts.astype(np.int64)), pa.array(ends, pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "segment", "ordinal", "doc_id", "a", "z", "crc"])

    pieces = spark.read.parquet(f"{path}/segments").select("part", "segment", "data").mapInArrow(
        run, "part int, segment int, ordinal long, doc_id long, a long, z long, crc long")
    sizes = spark.read.parquet(f"{path}/segments").select("part", "segment", F.col("n_tokens").alias("n"))
    parts = spark.read.parquet(f"{path}/parts")
    # where a segment begins in its part: its number times the part's segment size (its first segment's)
    size = sizes.where("segment = 0").select("part", F.col("n").alias("size")).join(parts, "part")
    placed = pieces.join(size, "part").select(
        "part", "ordinal", "doc_id", "segment", (F.col("first") + F.col("segment") * F.col("size") + F.col("a")).alias("start"),
        (F.col("z") - F.col("a")).alias("n"), "crc")

    # a document has one piece per segment it reaches into
    by_doc = placed.groupBy("part", "ordinal").agg(F.sort_array(F.collect_list(
        F.struct("segment", "start", "n", "crc", "doc_id"))).alias("p"))
    listed = by_doc.select(F.col("p")[0]["doc_id"].alias("doc_id"), F.col("p")[0]["start"].alias("start"),
                           F.col("p.n").alias("n"), F.col("p.crc").alias("crc"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, crcs = [], []
            for ns, cs in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                crc = cs[0]
                for c, n in zip(cs[1:], ns[1:], strict=True):
                    crc = crc_join(crc, c, 4 * n)
                total.append(sum(ns))
                crcs.append(crc)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(total, pa.int64()), pa.array(crcs, pa.int64())],
                                  ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(join, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return document_digests(spark, path)
