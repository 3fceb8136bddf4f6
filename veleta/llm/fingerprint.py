"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last seven bytes triggers chunk boundaries, so they move with the content; each chunk
gives one character of the signature.  The block size (how rare a trigger is) follows the length,
and a fingerprint carries the signatures for two neighbouring sizes, so texts whose sizes differ by
a factor of two can still be compared by edit distance.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from veleta.llm.common import ODD, U64, arrow_map, octets, parts, stored

CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
SPAN = 7           # bytes that decide about a boundary
SIGNATURE = 64     # the signature length aimed at


def _triggers(data: bytes) -> np.ndarray:
    """The rolling value after every byte: 32 mixed bits of the last seven."""
    padded = b"\0" * 7 + data
    n = len(data)
    view = np.ndarray((n,), dtype="<u8", buffer=padded, strides=(1,))
    return (((view >> U64(8)) * ODD[3]) >> U64(32)).astype(np.uint32)


def _signature(data: bytes, ends: np.ndarray) -> str:
    cuts = [0, *(ends + 1).tolist()]
    if cuts[-1] < len(data):
        cuts.append(len(data))
    crc, chars, view = zlib.crc32, CHARACTERS, memoryview(data)
    return "".join([chars[crc(view[a:b]) * 2654435761 >> 20 & 63] for a, b in zip(cuts, cuts[1:])])


def fingerprint_bytes(data: bytes) -> str:
    """``size:signature:signature at twice the size`` of the whole text."""
    if not data:
        return "4::"
    rolling = _triggers(data)
    size = 4
    while size * SIGNATURE < len(data):
        size *= 2
    while True:
        ends = np.flatnonzero((rolling & np.uint32(size - 1)) == np.uint32(size - 1))
        if len(ends) >= SIGNATURE // 2 or size == 4:
            break
        size //= 2
    double = ends[(rolling[ends] & np.uint32(2 * size - 1)) == np.uint32(2 * size - 1)]
    return f"{size}:{_signature(data, ends)}:{_signature(data, double)}"


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1: one less the edit distance over the longer signature,
    at the block sizes that both have; 0 where they share none.  Runs of one character count as three of
    it, so long equal stretches stay cheap to compare."""
    x, y = F.split(a, ":"), F.split(b, ":")
    part = lambda p, i: F.get(p, F.lit(i))
    size = lambda p: part(p, 0).cast("bigint")

    def near(s: Column, t: Column) -> Column:
        # A character more than three times in a row says no more than three times.
        s, t = (F.regexp_replace(v, r"(.)\1{3,}", "$1$1$1") for v in (s, t))
        longer = F.greatest(F.length(s), F.length(t))
        return F.when(longer == 0, F.lit(0.0)).otherwise(1 - F.levenshtein(s, t) / longer)

    return (F.when(a == b, F.lit(1.0))
            .when(size(x) == size(y), F.greatest(near(part(x, 1), part(y, 1)), near(part(x, 2), part(y, 2))))
            .when(size(x) == 2 * size(y), near(part(x, 1), part(y, 2)))
            .when(2 * size(x) == size(y), near(part(x, 2), part(y, 1)))
            .otherwise(F.lit(0.0)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every text; null is an empty text.  Row by row, no shuffle."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([fingerprint_bytes(t.encode()) for t in texts], pa.string())],
                ["id", "n_chars", "fingerprint"])

    return arrow_map(rows, run, f"id {kind}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


def edit(text: str, other: str) -> str:
    """The last half of ``text`` replaced by as many first characters of ``other`` (or all)."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


_ROW = "doc_id {0}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"


def _describe(text: str, fp: str, other: str, other_fp: str):
    changed = edit(text, other).encode()
    return len(text), hashlib.sha256(changed).hexdigest(), fp, fingerprint_bytes(changed), other_fp


def next_and_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document compared with the next one in descending order of the id (the first follows
    the last) and with its edited text, see ``edit``.

    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The texts are ranged by id once.  A task walks its slice in order and needs only the row
    before; for its first row that is the last row of the slice before, so these two rows of each
    slice are put aside and joined by slice number.  Null texts are empty; rows without id come
    first, equal ids are ordered by a hash of the text; a single row is its own next; an empty table gives an
    empty one.  Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    slices = max(parts(docs), octets(rows, "text") >> 25)
    # Ranged by the id and 64 bits of the text: sampled keys go to the driver, and equal or missing ids spread.
    keys = [F.asc_nulls_first("id"), F.xxhash64("text").asc()]
    laid = rows.repartitionByRange(slices, *keys).sortWithinPartitions(*keys, F.asc("text"))

    def walk(batches):
        here, before, before_fp, seen = TaskContext.get().partitionId(), None, "", None
        for b in batches:
            ids, texts = b.column("id"), b.column("text").to_pylist()
            full, edges = [], []
            for i, text in enumerate(texts):
                fp = fingerprint_bytes(text.encode())
                if before is None:
                    edges.append(("first", i, text))
                else:
                    full.append((i, _describe(text, fp, before, before_fp)))
                before, before_fp = text, fp
            if len(ids):
                seen = ids.slice(len(ids) - 1)
                yield _batch(ids, full, edges, here)
        if seen is not None:
            yield _batch(seen, [], [("last", 0, before)], here)

    def _batch(ids, full, edges, here):
        at = [i for i, _ in full] + [i for _, i, _ in edges]
        cell = lambda k, t: pa.array([d[k] for _, d in full] + [None] * len(edges), t)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(at, pa.int32())), cell(0, pa.int64()), *(cell(k, pa.string()) for k in range(1, 5)),
             pa.array([None] * len(full) + [e[0] for e in edges], pa.string()),
             pa.array([None] * len(full) + [e[2] for e in edges], pa.string()),
             pa.array([here] * len(at), pa.int32())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint",
             "edge", "edge_text", "slice"])

    walked = stored(arrow_map(laid, walk, _ROW.format(kind) + ", edge string, edge_text string, slice int"), "ctph")
    done = walked.filter("edge is null").drop("edge", "edge_text", "slice")
    first, last = walked.filter("edge = 'first'"), walked.filter("edge = 'last'")
    # One row per slice: which slice comes before which.
    chain = last.select("slice", F.coalesce(F.lag("slice").over(Window.orderBy("slice")),
                                            F.max("slice").over(Window.partitionBy())).alias("before"))
    pairs = (first.select("doc_id", "edge_text", "slice").join(chain, "slice")
             .join(last.select(F.col("slice").alias("before"), F.col("edge_text").alias("other")), "before"))

    def join(batches):
        for b in batches:
            found = [_describe(t, fingerprint_bytes(t.encode()), o, fingerprint_bytes(o.encode()))
                     for t, o in zip(b.column("edge_text").to_pylist(), b.column("other").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([d[0] for d in found], pa.int64()),
                 *(pa.array([d[k] for d in found], pa.string()) for k in range(1, 5))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"])

    rest = arrow_map(pairs.select("doc_id", "edge_text", "other"), join, _ROW.format(kind))
    both = done.unionByName(rest)
    return both.select(
        F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
