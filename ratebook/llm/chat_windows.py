"""Chat formatting in budgeted windows.

Each conversation becomes training windows of at most ``budget`` tokens.  Prefix sums of the turns'
tokens choose where a window's span of new turns ends (always between turns); every window starts
with the conversation's system turn and a limited stretch of the turns before its span, and only
assistant turns of the span itself are under the loss mask, so every assistant text is a target
exactly once.  A single turn over the budget gets a window of its own, without history.  A system turn of
more than half the budget is not repeated: it stands in the first window only (alone, if it is over the
budget), so what is written stays in proportion to the conversation.  Extra columns are left out.

The template writes a turn as ``### role: text</turn>`` and a line feed.  Inside texts and roles,
backslash, ``#`` and the slash of ``</turn>`` (in roles also the colon) get a backslash before them,
so neither marker can occur in them and removing the backslashes restores them.

Scale: turns are range-partitioned by (conversation, turn, ...), so one conversation with a third of
all rows spreads over many tasks; positions and token sums are taken per partition and completed
with per-partition offsets (only conversations that cross a partition edge have any, so there are
fewer of them than partitions).  Spans restart every ``SEGMENT`` turns, which bounds the group that
is planned together; texts are joined afterwards by position.

Turns are ordered by turn, then role, then text (ties and repeated rows stay, each a turn); a null
turn comes first.  Null text or role is empty.  A null conv_id is a conversation of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebook.llm.common import scratch, ship_package, shuffle_partitions, staged
from ratebook.sources.tables import table

BUDGET = 1024               # tokens of a window
HISTORY = 256               # tokens of repeated turns, at most
HISTORY_TURNS = 4           # repeated turns, at most
SEGMENT = 1024              # turns after which a span ends in any case
RANKS = "byte_bpe_50k.tiktoken"
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
# The contract's additional conversation.
EXTRA_ID, EXTRA_TEXT = -7, r"\### Assistant: </turn> ok"


def escaped(text: Column) -> Column:
    t = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\#"))
    return F.replace(t, F.lit("</turn>"), F.lit("<\\/turn>"))


def _plain(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def placed_turns(rows: DataFrame, ranks: str | None = None) -> DataFrame:
    """Staged turns (no_conv, conv, idx, role, text, tokens): formatted text, position and size."""
    spark = rows.sparkSession
    path = ranks or public_tokenizers.path(RANKS)
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc, last, at = TaskContext.get().partitionId(), _encoding(path), None, 0
        for b in batches:
            before = []
            for key in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at = at + 1 if key == last else 0
                last = key
                before.append(at)
            tokens = [len(enc.encode_ordinary(t)) for t in b.column(4).to_pylist()]
            n = b.num_rows
            yield pa.record_batch([b.column(0), b.column(1), pa.array([part] * n, pa.int32()), pa.array(before, pa.int64()),
                                   b.column(3), b.column(4), pa.array(tokens, pa.int64())],
                                  ["no_conv", "conv", "part", "before", "role", "text", "tokens"])

    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.select(F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).cast("bigint").alias("conv"),
                        F.col("turn"), role.alias("role"),
                        F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit(":"), F.lit("\\:")), F.lit(COLON),
                                 escaped(text), F.lit(CLOSE)).alias("text"))
    order = [F.col("no_conv"), F.col("conv"), F.col("turn"), F.col("role"), F.xxhash64("text")]
    dealt = (turns.repartitionByRange(shuffle_partitions(spark), *order)
             .sortWithinPartitions("no_conv", "conv", "turn", "role", F.xxhash64("text"), "text"))
    local = staged(dealt.mapInArrow(run, "no_conv boolean, conv long, part int, before long, role string, text string, tokens long"),
                   scratch(spark, "turns"))
    # where a conversation goes on from an earlier part: at most two entries per part edge
    sizes = local.groupBy("no_conv", "conv", "part").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("no_conv", "conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.sum("n").over(w)).where("offset IS NOT NULL").drop("n")
    both = local.join(F.broadcast(offsets), ["no_conv", "conv", "part"], "left")
    return both.select("no_conv", "conv", (F.col("before") + F.coalesce("offset", F.lit(0))).alias("idx"), "role", "text", "tokens")


def repeated_system(turns: DataFrame, budget: int) -> DataFrame:
    """The system turns that every window of their conversation starts with."""
    return turns.where(F.expr("idx = 0 AND role = 'system'") & (F.col("tokens") * 2 <= budget))


def plan_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_turns: int = HISTORY_TURNS,
                 segment: int = SEGMENT) -> DataFrame:
    """(no_conv, conv, window, first, last, shown): a window's span of new turns [first, last], and the
    first turn of the history that it repeats (``first`` if none)."""
    head = repeated_system(turns, budget).select("no_conv", "conv", F.col("tokens").alias("system"))
    seg = F.floor(F.col("idx") / segment)
    # the next segment sees the last turns of this one as possible history
    also = F.when((F.pmod("idx", F.lit(segment)) >= segment - history_turns), F.array(seg, seg + 1)).otherwise(F.array(seg))
    sized = turns.select("no_conv", "conv", "idx", "tokens", F.explode(also).alias("seg"))
    groups = (sized.groupBy("no_conv", "conv", "seg").agg(F.sort_array(F.collect_list(F.struct("idx", "tokens"))).alias("t"))
              .join(head, ["no_conv", "conv"], "left")
              .select("no_conv", "conv", "seg", F.col("t.idx").alias("idx"), F.col("t.tokens").alias("tokens"),
                      F.coalesce("system", F.lit(0)).alias("system")))

    def spans(idx: np.ndarray, tokens: np.ndarray, start: int, system: int) -> Iterator[tuple[int, int, int]]:
        """Spans of one segment whose own turns begin at position ``start`` of the lists."""
        sums = np.concatenate([[0], np.cumsum(tokens)])
        i, n = start, len(idx)
        while i < n:
            # the system turn is written once: in the first window it is part of the span
            kept = system if idx[i] > 0 else 0
            low = max(i - history_turns, int(np.searchsorted(sums, sums[i] - history)), 0)
            if system and idx[low] == 0 and low < i:
                low += 1                                  # already shown as the system turn
            while low < i and kept + sums[i + 1] - sums[low] > budget:
                low += 1                                  # history yields to the span's first turn
            room = budget - kept - (sums[i] - sums[low])
            j = max(i + 1, int(np.searchsorted(sums, sums[i] + room, side="right")) - 1)
            yield int(idx[i]), int(idx[j - 1]), int(idx[low]) if low < i else int(idx[i])
            i = j

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                idx, start = np.asarray(r.idx), int(np.searchsorted(r.idx, r.seg * segment))
                out += [(r.no_conv, r.conv, *s) for s in spans(idx, np.asarray(r.tokens), start, r.system)]
            yield pd.DataFrame(out, columns=["no_conv", "conv", "first", "last", "shown"])

    return groups.mapInPandas(run, "no_conv boolean, conv long, first long, last long, shown long")


def format_windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_turns: int = HISTORY_TURNS,
                   segment: int = SEGMENT, ranks: str | None = None) -> DataFrame:
    """One row per window of (conv_id, turn, role, text) rows: conv_id, first (the first new turn's
    position), n_context (turns repeated before it), text, tokens and ``loss`` -- character spans
    [start, end) of ``text`` that are targets."""
    spark = rows.sparkSession
    turns = staged(placed_turns(rows, ranks), scratch(spark, "placed"))
    windows = staged(plan_windows(turns, budget, history, history_turns, segment), scratch(spark, "windows"))
    system = repeated_system(turns, budget).select("no_conv", "conv", F.lit(True).alias("has"))
    own = F.transform(F.sequence("shown", "last"), lambda i: F.struct(i.alias("idx"), (i >= F.col("first")).alias("new")))
    lead = F.when(F.col("has") & (F.col("shown") > 0), F.array(F.struct(F.lit(0).cast("bigint").alias("idx"), F.lit(False).alias("new"))))
    members = (windows.join(system, ["no_conv", "conv"], "left")
               .select("no_conv", "conv", "first", F.explode(F.concat(F.coalesce(lead, F.array().cast("array<struct<idx:bigint,new:boolean>>")), own)).alias("m"))
               .select("no_conv", "conv", "first", "m.idx", "m.new"))
    # a window's turns are bounded by its budget (but for a single long one)
    full = members.join(turns, ["no_conv", "conv", "idx"]).groupBy("no_conv", "conv", "first").agg(
        F.sort_array(F.collect_list(F.struct("idx", "new", "role", "text", "tokens"))).alias("t"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))

    def step(a: Column, t: Column) -> Column:
        head = len(OPEN) + len("assistant") + len(COLON)
        end = a["at"] + F.length(t["text"])
        span = F.array(F.struct((a["at"] + head).alias("start"), (end - len(CLOSE)).alias("end")))
        target = t["new"] & (t["role"] == "assistant")
        return F.struct(end.alias("at"), F.when(target, F.concat(a["loss"], span)).otherwise(a["loss"]).alias("loss"))

    return full.select(
        F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), "first",
        F.size(F.filter("t", lambda t: ~t["new"])).alias("n_context"), F.array_join(F.col("t.text"), "").alias("text"),
        F.aggregate("t.tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("tokens"),
        F.aggregate("t", start, step, lambda a: a["loss"]).alias("loss"))


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window."""
    out = []
    for turn in text.split(CLOSE)[:-1]:
        head = re.match(r"### ((?:[^\\:]|\\.)*): ", turn, flags=re.S)
        out.append((_plain(head[1]), _plain(turn[head.end():])))
    return out


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows in order: turns, digests of turns and of targets, sizes.

    A digest needs its conversation's windows one after the other, so they are streamed in order
    with the running hashes as the only state."""
    ship_package(windows.sparkSession)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = object(), None

        def done() -> pa.RecordBatch:
            n, turns, chars, loss, size, k = state
            values = [last, n, turns.hexdigest(), chars, loss.hexdigest(), size, k]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        for b in batches:
            for conv, context, text, loss in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if state is None or conv != last:
                    if state is not None:
                        yield done()
                    last, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in read_turns(text)[context:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = _plain(text[span["start"]:span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
                state[5] += 1
        if state is not None:
            yield done()

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    dealt = windows.repartition(shuffle_partitions(windows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "first")
    return dealt.select("conv_id", "n_context", "text", "loss").mapInArrow(run, kinds)


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(EXTRA_ID, 0, "user", EXTRA_TEXT), (EXTRA_ID, 1, "assistant", EXTRA_TEXT)], rows.schema)
    windows = staged(format_windows(rows.unionByName(extra)), scratch(spark, "chat"))
    return conversation_digests(windows)

