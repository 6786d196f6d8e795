"""Cutting texts where no token of a byte-level BPE pre-tokenizer can span, and a bounded memo.

The pre-tokenizer's pattern only looks ahead, and none of its alternatives continues past a
non-space character into white space.  So a match always ends just before a space or a line feed
that follows a non-space character, and the parts on both sides tokenize independently.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

_GAPS = re.compile(r"\s[ \n]")


def cut(text: str) -> list[str]:
    """``text`` in order as parts that each start at a space or line feed after a non-space (but the first)."""
    if not text:
        return []
    if "\0" in text:
        return _cut_slow(text)
    parts = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    if not parts[0]:
        del parts[0]
    if _GAPS.search(text) is None:
        return parts
    return _joined(parts)


def _joined(parts: list[str]) -> list[str]:
    """Parts that follow white space are not safe cuts: glue them to what they follow."""
    out: list[str] = []
    run: list[str] = []
    for p in parts:
        if run and not run[-1][-1].isspace():
            out.append("".join(run))
            run = []
        run.append(p)
    out.append("".join(run))
    return out


def _cut_slow(text: str) -> list[str]:
    at = [m.start() for m in re.finditer(r"(?<=\S)[ \n]", text)]
    return [text[a:b] for a, b in zip([0, *at], [*at, len(text)], strict=True) if a < b]


def text_groups(batch: pa.RecordBatch, limit: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with at most ``limit`` characters of text together, or one row."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if batch.num_rows > first:
        yield batch.slice(first)


class Memo:
    """A mapping that keeps the recently used of at most ``2 * size`` entries (two generations)."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys) -> set:
        """Of ``keys``, those not known; known ones of the old generation become young again."""
        young, old = self.young, self.old
        out = set(keys).difference(young)
        again = out.intersection(old)
        young.update(zip(again, map(old.__getitem__, again), strict=True))
        return out - again

    def room(self) -> None:
        """Start a new generation when the young one is full (call between batches)."""
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
