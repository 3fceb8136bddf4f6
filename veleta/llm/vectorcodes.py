"""Vector codes by exact ball k-means, one codebook per part of the vector.

All arithmetic is on integers, so pruning by the triangle inequality is exact.  The parts that an
entry holds form a ball.  Of two entries whose squared distance is more than four times that of a part
to its own entry, the other one cannot be nearer; hence the ball's radius names the neighbour entries
that matter at all, parts in the stable core (nearer than half the way to the nearest neighbour) are
not compared, and a part in the k-th ring around the entry is compared with the k nearest neighbours
only.  A neighbour also drops out while neither entry has moved since the last comparison.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veleta.llm.common import arrow_map, release, stored

SCALE = 4096
LARGEST = 1 << 27          # integer components stay below this, so squared distances fit 64 bits
BROADCAST_LABELS = 100_000


def reassign(x: np.ndarray, code: np.ndarray, book: np.ndarray, moved: np.ndarray | None = None) -> np.ndarray:
    """Move every part to its nearest entry (the lower index among equally near ones).

    ``x`` (rows, width) are one part of the vectors, ``code`` their present entries (changed in place),
    ``book`` (entries, width) the entries, ``moved`` which of them differ from those that ``code`` was
    exact for (None: it was exact for none).  Returns the squared distance to the final entry.
    """
    apart = ((book[:, None, :] - book[None, :, :]) ** 2).sum(2)
    near = np.empty(len(x), np.int64)
    before = code.copy()
    for i in np.unique(before).tolist():
        own = np.flatnonzero(before == i)
        rows = x[own]
        best = ((rows - book[i]) ** 2).sum(1)
        other = np.flatnonzero((np.arange(len(book)) != i) & (apart[i] <= 4 * best.max()))
        if moved is not None and not moved[i]:
            other = other[moved[other]]
        entry = np.full(len(own), i, np.int64)
        if len(other):
            other = other[np.argsort(apart[i][other], kind="stable")]
            # The ring of a part: how many neighbours are near enough to win it.
            ring = np.searchsorted(apart[i][other], 4 * best, side="right")
            for k, j in enumerate(other.tolist()):
                at = np.flatnonzero(ring > k)
                if not len(at):
                    break
                d = ((rows[at] - book[j]) ** 2).sum(1)
                won = (d < best[at]) | (d == best[at]) & (j < entry[at])
                best[at[won]] = d[won]
                entry[at[won]] = j
        near[own] = best
        code[own] = entry
    return near


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v) of the rows whose vector is not empty and has finite components only."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), v.alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fine)


def first_entries(rows: DataFrame, entries: int) -> np.ndarray:
    """The integer vectors of the smallest ids, ascending; a repeated id gives its smallest vector."""
    ids = rows.filter("id is not null").select("id").distinct().orderBy("id").limit(entries)
    found = (rows.join(F.broadcast(ids), "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
             .orderBy("id").collect())
    found = [r["v"] for r in found]
    found = [v for v in found if len(v) == len(found[0])]
    return np.floor(np.array(found, np.float64) * SCALE).astype(np.int64)


class Codebooks:
    """Integer entries by (part, entry, place); vectors are filled up with zeros to whole parts."""

    def __init__(self, first: np.ndarray, parts: int):
        self.size, self.parts = first.shape[1], parts
        self.width = -(-self.size // parts)
        padded = np.zeros((len(first), self.width * parts), np.int64)
        padded[:, :self.size] = first
        self.books = padded.reshape(len(first), parts, self.width).transpose(1, 0, 2).copy()
        self.moved = None

    def cells(self) -> int:
        return self.books.shape[0] * self.books.shape[1] * (self.width + 1)

    def step(self, sums: np.ndarray) -> None:
        """Every used entry becomes the floored mean of its parts."""
        sums = sums.reshape(*self.books.shape[:2], self.width + 1)
        count = sums[:, :, -1:]
        new = np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), self.books)
        self.moved = (new != self.books).any(2)
        self.books = new

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _integers(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, x, code): integer vectors as bytes, every part at entry 0 for the start."""
    size, whole, parts = books.size, books.parts * books.width, books.parts

    def run(batches):
        for b in batches:
            n = len(b)
            x = np.zeros((n, whole), np.int64)
            x[:, :size] = np.floor(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, size) * SCALE)
            if n and np.abs(x).max() >= LARGEST:
                raise OverflowError(f"vector components must be below {LARGEST // SCALE} in size")
            raw = np.ascontiguousarray(x, np.int32).view(np.uint8).reshape(n, -1)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([r.tobytes() for r in raw], pa.binary()),
                 pa.array([bytes(parts)] * n, pa.binary())], ["id", "label", "x", "code"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    return arrow_map(rows.filter(F.size("v") == size), run,
                     f"id {kinds[0]}, label {kinds[1]}, x binary, code binary")


def _round(state: DataFrame, books: Codebooks) -> DataFrame:
    """``state`` with every part at its nearest entry; ``error`` is the vector's summed squared
    distance, ``sums`` (in one row a batch) the sums and counts of the parts of each entry."""
    table, moved, parts, width = books.books, books.moved, books.parts, books.width

    def run(batches):
        for b in batches:
            n = len(b)
            if not n:
                continue
            x = _matrix(b.column("x"), parts * width, np.int32).reshape(n, parts, width).astype(np.int64)
            code = _matrix(b.column("code"), parts, np.uint8).astype(np.int64)
            error = np.zeros(n, np.int64)
            sums = np.zeros((parts, table.shape[1], width + 1), np.int64)
            for p in range(parts):
                own = np.ascontiguousarray(code[:, p])
                error += reassign(x[:, p], own, table[p], None if moved is None else moved[p])
                code[:, p] = own
                np.add.at(sums[p, :, :width], own, x[:, p])
                sums[p, :, width] = np.bincount(own, minlength=table.shape[1])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), b.column("x"),
                 pa.array([c.tobytes() for c in code.astype(np.uint8)], pa.binary()), pa.array(error),
                 pa.array([sums.tobytes()] + [None] * (n - 1), pa.binary())],
                ["id", "label", "x", "code", "error", "sums"])

    kinds = [state.schema[c].dataType.simpleString() for c in ("id", "label")]
    return arrow_map(state.select("id", "label", "x", "code"), run,
                     f"id {kinds[0]}, label {kinds[1]}, x binary, code binary, error long, sums binary")


def _sums(state: DataFrame, cells: int) -> np.ndarray:
    """All ``sums`` added up: a task sends one row a cell, the driver gets one row a cell."""
    def run(batches):
        total = np.zeros(cells, np.int64)
        for b in batches:
            for raw in b.column("sums").to_pylist():
                total += np.frombuffer(raw, np.int64)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own])], ["cell", "s"])

    out = np.zeros(cells, np.int64)
    rows = arrow_map(state.filter("sums is not null").select("sums"), run, "cell long, s long")
    for r in rows.groupBy("cell").agg(F.sum("s").alias("s")).collect():
        out[r[0]] = r[1]
    return out


def train(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id",
          vector_col: str = "embedding", label_col: str = "label") -> tuple[Codebooks | None, DataFrame | None]:
    """(codebooks, coded rows (id, label, x, code, error)) of the kept vectors, see ``encode``.

    The state of a round (integer vectors and present entries) is a written table that replaces the one
    before, so a lost executor costs a re-read; only sums per entry leave the tasks.
    """
    rows = kept(vectors, id_col, vector_col, label_col)
    first = first_entries(rows, entries)
    if not len(first):
        return None, None
    books = Codebooks(first, parts)
    state = None
    for step in range(rounds + 1):
        last, source = state, _integers(rows, books) if state is None else state
        state = stored(_round(source, books), "codes")
        if last is not None:
            release(last)
        if step < rounds:
            books.step(_sums(state, books.cells()))
    return books, state


def encode(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id",
           vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per kept row: id, code (two hex digits a part), error (squared distance of its parts to their entries),
    label_error (error summed over equal labels, nulls together) and codebooks_sha256.

    Components become floor(4096 x).  A codebook starts as its part of the vectors of the ``entries``
    smallest ids and takes ``rounds`` steps of k-means; ties go to the lower entry, means are floored,
    unused entries stay.  Rows whose vector is null, empty or holds a null or non-finite component go, and
    so do rows of another length than the vector of the smallest id.  A length that does not divide by
    ``parts`` is filled up with zeros.  With fewer distinct ids than ``entries`` the codebooks are smaller.
    A row without id is coded but starts no entry; an id repeated with different vectors starts one
    entry, with the smallest; repeated rows count one by one.  Components of 32,768 or more raise
    OverflowError.  An empty table, or one without ids, gives an empty one.  Other columns are ignored.
    """
    books, state = train(vectors, parts, entries, rounds, id_col, vector_col, label_col)
    if books is None:
        id_type = vectors.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"`{id_col}` {id_type}, code string, error long, label_error long, codebooks_sha256 string")
    per_label = state.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("_l"), "label_error")
    # Few labels are broadcast; many are joined, and the adaptive planner splits a frequent one.
    if per_label.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        per_label = F.broadcast(per_label)
    out = state.join(per_label, F.col("label").eqNullSafe(F.col("_l")))
    return out.select(F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                      F.lit(books.sha256()).alias("codebooks_sha256"))
