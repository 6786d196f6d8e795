"""Vector code compression: product quantization with norm-of-sum bounds.

Vectors are cut into ``PARTS`` equal parts, and each part position has a codebook of ``ENTRIES``
entries, learned by rounds of exact integer k-means.  A part of a vector keeps its entry, an upper
bound of its distance to that entry and a lower bound of its distance to every other one, each with
the stamp of the round in which it was computed.  All codebooks so far are kept, so a bound of round
s is carried to round t by how far the entries are now from where they were then, |c(t) - c(s)|: the
norm of the sum of their steps, never more than the sum of the steps' norms that is accumulated
otherwise.  Where the upper bound stays under the lower one the entry cannot have changed; else the
distance to the own entry is taken exactly, and only if that does not settle it are all entries
scanned again, in exact integers (nearest entry, ties to the lower index).

Spark deals the vectors.  A round is one pass that writes vectors with their new bounds and, beside
them, sums and counts of each task's batches by part and entry; what returns to the driver is one row
per part, entry and component.  A round's table lies under the checkpoint folder and replaces the one
before, so a lost executor repeats its tasks of one round at most.

Rows whose vector is null or holds a null or non-finite component are dropped.  Repeated rows count
each.  The codebooks start from the first rows by id (repeated ids by vector, null ids last); with
fewer rows than ``ENTRIES`` they are that short.  The first of these rows gives the length, which must
be a multiple of ``PARTS``; a vector of another length stays in the result without code and error and
takes no part otherwise.  Extra columns are left out.  Components up to 2^90 are exact; an error past
64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm.common import drop_path, scratch, ship_package, staged
from ratebook.sources.tables import table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
SAFE = 1 << 27              # components below it have squared distances within 64 bits
SLACK = 1e-9                # relative room for the rounding of square roots


def integers(vectors: pa.Array, dim: int) -> np.ndarray:
    """floor(SCALE * x) of vectors of ``dim`` components: int64, or Python integers where they are large."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    scaled = np.floor(flat * SCALE)
    if not len(scaled) or np.abs(scaled).max() < SAFE:
        return scaled.astype(np.int64)
    return np.array([[int(v) for v in row] for row in scaled], dtype=object)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    if x.dtype != object and c.dtype != object:
        d = x - c
        return (d * d).sum(axis=1)
    d = x.astype(object) - c.astype(object)
    return (d * d).sum(axis=1)


class Movement:
    """How far the entries of the newest codebook are from where they were in each round before."""

    def __init__(self, history: list[list[np.ndarray]]):
        now = history[-1]
        self.own, self.other = [], []
        for then in history:
            own = [np.sqrt(squared(a, b).astype(np.float64)) for a, b in zip(now, then, strict=True)]
            self.own.append(own)
            # the farthest of the other entries
            self.other.append([np.array([np.delete(v, j).max(initial=0.0) for j in range(len(v))]) for v in own])
        self.own, self.other = np.array(self.own), np.array(self.other)


class Bounds:
    """Entries, bounds and stamps of one part of a batch of vectors."""

    def __init__(self, entry: np.ndarray, upper: np.ndarray, lower: np.ndarray, upper_at: np.ndarray, lower_at: np.ndarray):
        self.entry, self.upper, self.lower, self.upper_at, self.lower_at = entry, upper, lower, upper_at, lower_at

    @classmethod
    def unknown(cls, n: int) -> Bounds:
        """Bounds that settle nothing."""
        return cls(np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64))

    def assign(self, x: np.ndarray, book: np.ndarray, moved: Movement, part: int) -> tuple[int, int]:
        """Move to round ``len(moved.own) - 1``; returns how many own distances and how many scans it took."""
        now = len(moved.own) - 1
        low = self.lower - moved.other[self.lower_at, part, self.entry]

        def open_rows(rows: np.ndarray) -> np.ndarray:
            up = self.upper[rows] + moved.own[self.upper_at[rows], part, self.entry[rows]]
            return rows[~(up * (1 + SLACK) < low[rows] * (1 - SLACK))]

        rows = open_rows(np.arange(len(x)))
        if len(rows):
            self.upper[rows] = np.sqrt(squared(x[rows], book[self.entry[rows]]).astype(np.float64))
            self.upper_at[rows] = now
        scans = open_rows(rows)
        if len(scans):
            d = np.stack([squared(x[scans], np.broadcast_to(c, (len(scans), len(c)))) for c in book], axis=1)
            best = d.argmin(axis=1)
            self.entry[scans] = best
            self.upper[scans] = np.sqrt(d[np.arange(len(scans)), best].astype(np.float64))
            if len(book) > 1:
                rest = np.sort(d, axis=1)[:, 1]
                self.lower[scans] = np.sqrt(rest.astype(np.float64))
            else:
                self.lower[scans] = np.inf
            self.upper_at[scans] = self.lower_at[scans] = now
        return len(rows), len(scans)


STATE = "entry array<tinyint>, upper array<double>, lower array<double>, upper_at array<tinyint>, lower_at array<tinyint>"
SUMS = "part int, slot int, n long, sums array<string>, n_own long, n_scans long"


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), kind), values.shape[1]).cast(pa.list_(kind))


def _read_state(b: pa.RecordBatch, first: int) -> list[Bounds]:
    """Bounds of a batch by part; ``first``: the column where they begin."""
    cols = [b.column(first + k).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, PARTS) for k in range(5)]
    kinds = (np.int64, np.float64, np.float64, np.int64, np.int64)
    return [Bounds(*[c[:, p].astype(k) for c, k in zip(cols, kinds, strict=True)]) for p in range(PARTS)]


def _round(state: DataFrame, history: list[list[np.ndarray]], dim: int, path: str) -> tuple[DataFrame, DataFrame]:
    """One assignment: vectors with their new bounds, and sums by part and entry, both staged."""
    moved, books, width = Movement(history), history[-1], dim // PARTS
    known = "entry" in state.columns
    key = state.schema["vec_id"].dataType.simpleString()
    label = state.schema["label"].dataType.simpleString()
    vector = state.schema["vector"].dataType.simpleString()
    kinds = [pa.int8(), pa.float64(), pa.float64(), pa.int8(), pa.int8()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = integers(b.column(2), dim)
            parts = _read_state(b, 3) if known else [Bounds.unknown(n) for _ in range(PARTS)]
            sums = []
            for p, s in enumerate(parts):
                mine = x[:, p * width:(p + 1) * width]
                own, scans = s.assign(mine, books[p], moved, p)
                for e in np.unique(s.entry).tolist():
                    these = mine[s.entry == e]
                    sums.append((p, e, len(these), [str(v) for v in these.sum(axis=0).tolist()], own, scans))
                    own = scans = 0
            state = [_lists(np.stack([getattr(s, name) for s in parts], axis=1), kind)
                     for name, kind in zip(("entry", "upper", "lower", "upper_at", "lower_at"), kinds, strict=True)]
            m = len(sums)
            columns = [pa.array([0] * n + [1] * m, pa.int32())]
            columns += [pa.concat_arrays([c, pa.nulls(m, c.type)]) for c in [*(b.column(k) for k in range(3)), *state]]
            for k, kind in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int64())):
                columns.append(pa.array([None] * n + [s[k] for s in sums], kind))
            yield pa.record_batch(columns, names)

    out = f"kind int, vec_id {key}, label {label}, vector {vector}, {STATE}, {SUMS}"
    names = [c.split()[0] for c in out.split(", ")]
    listed = ["vec_id", "label", "vector", *(["entry", "upper", "lower", "upper_at", "lower_at"] if known else [])]
    rows = state.select(*listed).mapInArrow(run, out)
    rows.write.partitionBy("kind").parquet(path)
    whole = state.sparkSession.read.schema(rows.schema).parquet(path)
    return (whole.where("kind = 0").select("vec_id", "label", "vector", "entry", "upper", "lower", "upper_at", "lower_at"),
            whole.where("kind = 1").select("part", "slot", "n", "sums", "n_own", "n_scans"))


def _moved_books(books: list[np.ndarray], sums: DataFrame) -> list[np.ndarray]:
    """Entries replaced by floor(sum / count) of their parts; unused ones stay."""
    each = sums.select("part", "slot", "n", F.posexplode("sums").alias("pos", "v"))
    rows = each.groupBy("part", "slot", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    out = [b.astype(object) for b in books]         # PARTS * ENTRIES * width numbers at most
    for r in rows:
        out[r["part"]][r["slot"], r["pos"]] = int(r["v"]) // r["n"]
    return [b.astype(np.int64) if not b.size or max(abs(v) for v in b.ravel()) < SAFE else b for b in out]


def kept_vectors(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, vector of the rows whose vector is whole and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col(vector).isNotNull() & ~bad).select(
        F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))


def code_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES,
                 rounds: int = ROUNDS, report: list | None = None) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every kept vector, and the final codebooks by part.

    ``report`` (a list) gets, per assignment, the exact own distances and the scans that it took."""
    spark = rows.sparkSession
    ship_package(spark)
    kept = kept_vectors(rows, key, vector, label)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    dim = len(first[0]["vector"]) if first else 0
    if dim % PARTS:
        raise ValueError(f"vectors of {dim} components cannot be cut into {PARTS} equal parts")
    first = [r["vector"] for r in first if len(r["vector"]) == dim]
    if not dim:
        return kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), []
    seeds = integers(pa.array(first, pa.list_(pa.float64())), dim)
    width = dim // PARTS
    history = [[seeds[:, p * width:(p + 1) * width] for p in range(PARTS)]]
    state, last = kept.where(F.size("vector") == dim), None
    for k in range(rounds + 1):
        path = scratch(spark, f"codes{k}")
        state, sums = _round(state, history, dim, path)
        if report is not None:
            report.append(tuple(sums.agg(F.sum("n_own"), F.sum("n_scans")).head()))
        if last:
            drop_path(spark, last)
        last = path
        if k < rounds:
            history.append(_moved_books(history[-1], sums))
    books = history[-1]

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x = integers(b.column(2), dim)
            entry = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(n, PARTS).astype(np.int64)
            error = sum(squared(x[:, p * width:(p + 1) * width], books[p][entry[:, p]]) for p in range(PARTS))
            codes = [bytes(e).hex() for e in entry.astype(np.uint8)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(codes, pa.string()),
                                   pa.array([e if e < 1 << 63 else None for e in error.tolist()], pa.int64())],
                                  ["vec_id", "label", "code", "error"])

    key_type, label_type = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    coded = state.select("vec_id", "label", "vector", "entry").mapInArrow(final, f"vec_id {key_type}, label {label_type}, code string, error long")
    others = kept.where(F.size("vector") != dim).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(others), books


def books_text(books: list[np.ndarray]) -> str:
    return ",".join(str(v) for b in books for row in b.tolist() for v in row)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = code_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    coded = staged(coded, scratch(spark, "coded"))
    by_label = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")), scratch(spark, "labels")).alias("l")
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return coded.alias("c").join(by_label, F.col("c.label").eqNullSafe(F.col("l.label")), "left").select(
        "c.vec_id", "c.code", "c.error", "l.label_error", F.lit(digest).alias("codebooks_sha256"))
