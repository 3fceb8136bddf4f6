"""Substring dedup with fixed-block anchors, over words.

Every document is cut into non-overlapping reference blocks of half the window; any window then
contains a whole block of its earlier occurrence.  Every rolling run of that many words is a probe
for the blocks.  Around the probes that hit, whole windows are compared, and overlapping repeated
windows make up the maximal exact repeats that are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from veleta.llm import frames
from veleta.llm.common import U64, arrow_map, mix, octets, parts, raw_texts, window_hashes, word_hashes

NO_ID = -2**63     # stands for a missing id
GATHER = 2 << 20   # values a map task gathers before it sends frames


def _keys(id_col: str, text_col: str) -> list[Column]:
    """Never null, so all joins by id share one exchange of the texts."""
    return [F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{text_col}`").alias("text")]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*_keys(id_col, text_col))


class _Gatherer:
    """Collects per-document values and gives frames for what is distinct in the batch.

    Values that occur several times in a batch are sent once, so a value shared by a third of all
    rows costs one entry per batch; ``repeated`` says what to report of the others at once.
    """

    def __init__(self, bits: int, wide: bool, repeated: str):
        self.bits, self.wide, self.repeated, self.counted = bits, wide, repeated, False
        self.clear()

    def clear(self):
        self.values, self.places, self.flags, self.ids, self.counts, self.n = [], [], [], [], [], 0

    def add(self, doc: int, values, places, flags, count: int):
        if len(values):
            self.values.append(values)
            self.places.append(places + self.n)
            self.flags.append(flags)
        self.ids.append(doc)
        self.counts.append(count)
        self.n += count

    def send_counts(self):
        """As ``send``, but of the values known to be repeated only their number per id; the copy
        that is sent is flagged, for it has been counted."""
        for batch in self.send():
            if batch.column("id").null_count:
                yield batch
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(
                    [len(frames.decoded([p])).to_bytes(4, "little") for p in batch.column("places").to_pylist()],
                    pa.binary())], batch.schema.names)

    def send(self):
        """Record batches of (frag, batch, flags, rests, id, places)."""
        if not self.values:
            self.clear()
            return
        values, entry, flags = (np.concatenate(x) for x in (self.values, self.places, self.flags))
        ids, counts = np.array(self.ids, np.int64), np.array(self.counts, np.int64)
        self.clear()
        ends = np.cumsum(counts)
        owner = np.searchsorted(ends, entry, side="right")
        place = entry - (ends - counts)[owner]
        if self.repeated == "later":   # the earliest first
            rank = np.lexsort((place, ids[owner]))
            order, starts, run = frames.runs(values[rank])
            order = rank[order]
        else:
            order, starts, run = frames.runs(values)
        size = np.diff(np.r_[starts, len(order)])
        first = order[starts]
        any_flag = size > 1 if self.counted else np.logical_or.reduceat(flags[order], starts)
        if self.repeated == "all":
            known = order[size[run] > 1]
        else:
            mask = np.ones(len(order), bool)
            mask[starts] = False
            known = order[mask]
        by_entry = np.argsort(first)
        first = first[by_entry]
        sent = frames.pack(values[first], entry[first], any_flag[by_entry], ids, counts, self.bits, self.wide)
        yield _with(sent, None, self.bits)
        if len(known):
            yield _with(None, frames.coded(ids[owner[known]], place[known]), self.bits)


SENT = frames.FRAME + ", id long, places binary"


def _with(sent: pa.RecordBatch | None, known: pa.RecordBatch | None, bits: int) -> pa.RecordBatch:
    """Rows of frames, or of places that need no exchange (dealt over all fragments), in the common layout."""
    if sent is not None:
        n = len(sent)
        return pa.RecordBatch.from_arrays(
            [*sent.columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
            ["frag", "batch", "flags", "rests", "id", "places"])
    n = len(known)
    frag = pa.array((mix(known.column("id").to_numpy().astype(np.uint64)) >> U64(64 - bits)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [frag, *(pa.nulls(n, pa.binary()) for _ in range(3)), known.column("id"), known.column("places")],
        ["frag", "batch", "flags", "rests", "id", "places"])


def exchange(sent: DataFrame, bits: int, wide: bool, decide) -> DataFrame:
    """(id, coded places) that ``decide`` picks from each fragment, and the places already known."""
    def meet(batches):
        for _, rows in frames.by_fragment(batches):
            known = [r for r in rows if r[0] is None]
            if known:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[3] for r in known], pa.int64()),
                     pa.array([r[4] for r in known], pa.binary())], ["id", "places"])
            packed = [r[:3] for r in rows if r[0] is not None]
            if packed:
                values, flags, owner, place, ids = frames.unpack(packed, wide)
                yield decide(values, flags, ids[owner], place)

    laid = sent.repartition(max(parts(sent), min(1 << bits, 1 << 16)), "frag").sortWithinPartitions("frag")
    met = arrow_map(laid, meet, "id long, places binary")
    return met.groupBy("id").agg(F.collect_list("places").alias("places"))


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """(id, places): starts of windows whose words also start earlier, for (id, text) rows."""
    block = window // 2
    bits = frames.fragment_bits(octets(docs, "text") // 6)

    def probes(batches):
        gather = _Gatherer(bits, False, "all")
        for b in batches:
            for doc, text in zip(b.column("id").to_numpy(), raw_texts(b.column("text"))):
                if doc == NO_ID:
                    continue
                h = window_hashes(word_hashes(text.split()), block)
                at = np.arange(len(h))
                gather.add(doc, h, at, at % block == 0, len(h))
                if gather.n >= GATHER:
                    yield from gather.send()
        yield from gather.send()

    def hits(values, flags, ids, place):
        order, starts, run = frames.runs(values)
        size = np.diff(np.r_[starts, len(order)])
        good = (size > 1) & np.logical_or.reduceat(flags[order], starts)
        own = order[good[run]]
        return frames.coded(ids[own], place[own])

    hit = exchange(arrow_map(docs, probes, SENT), bits, False, hits)

    def candidates(batches):
        gather = _Gatherer(bits, True, "later")
        for b in batches:
            for doc, text, places in zip(b.column("id").to_numpy(), raw_texts(b.column("text")),
                                         b.column("places")):
                words = word_hashes(text.split())
                n = len(words) - window + 1
                if n <= 0:
                    continue
                seen = np.r_[0, np.cumsum(frames.mask(places.as_py(), len(words)))]
                reach = window - block + 1
                at = np.flatnonzero(seen[reach:reach + n] > seen[:n])
                gather.add(doc, window_hashes(words, window)[at], at, np.zeros(len(at), bool), n)
                if gather.n >= GATHER:
                    yield from gather.send()
        yield from gather.send()

    def later(values, flags, ids, place):
        rank = np.lexsort((place, ids))
        order, starts, _ = frames.runs(values[rank])
        mask = np.ones(len(order), bool)
        mask[starts] = False
        own = rank[order[mask]]
        return frames.coded(ids[own], place[own])

    touched = docs.join(hit, "id").select("id", "text", "places")
    return exchange(arrow_map(touched, candidates, SENT), bits, True, later)


def covered(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """Mask of ``n`` places inside windows, from the mask of their starts."""
    edge = np.zeros(n + 1, np.int64)
    edge[:len(starts)] += starts
    edge[window:window + len(starts)] -= starts
    return np.cumsum(edge)[:n] > 0


def dedup(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text",
          keep_text: bool = False) -> DataFrame:
    """Remove every word that lies in a ``window`` whose words also start earlier, in a smaller id or
    earlier in the same document; windows are judged on the input.

    Returns id, n_words, n_removed, kept_sha256 (of the kept words joined by one blank), n_repeats
    (maximal removed runs) and, with ``keep_text``, the kept words as text.

    Ids are integers; a row without id has no place in the order, takes no part and keeps its words.
    Rows that repeat an id with the same text get the same result as one document (an id should not
    stand for different texts).  Null, empty and
    short texts have no window and lose nothing.  An empty table gives an empty one; other columns are ignored.
    """
    rows = _keyed(docs, id_col, text_col)
    found = repeated_windows(rows, window)

    def remove(batches):
        for b in batches:
            total, lost, sha, spans, kept_text = [], [], [], [], []
            for text, places in zip(raw_texts(b.column("text")), b.column("places")):
                words = text.split()
                total.append(len(words))
                if places.is_valid:
                    gone = covered(frames.mask(places.as_py(), max(0, len(words) - window + 1)), window, len(words))
                    lost.append(int(gone.sum()))
                    spans.append(int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()))
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    lost.append(0)
                    spans.append(0)
                joined = b" ".join(words)
                sha.append(hashlib.sha256(joined).hexdigest())
                kept_text.append(joined.decode())
            columns = [b.column("id"), pa.array(total, pa.int64()), pa.array(lost, pa.int64()),
                       pa.array(sha), pa.array(spans, pa.int64())]
            names = ["id", "n_words", "n_removed", "kept_sha256", "n_repeats"]
            if keep_text:
                columns.append(pa.array(kept_text))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names)

    out = arrow_map(rows.join(found, "id", "left").select("id", "text", "places"), remove,
                    "id long, n_words long, n_removed long, kept_sha256 string, n_repeats long"
                    + (", kept_text string" if keep_text else ""))
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), *[c for c in out.columns if c != "id"])
