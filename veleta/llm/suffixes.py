"""Dedup of repeated byte strings by hashes of anchored phrases.

Equality of ``length`` bytes is asked for, not the order of suffixes, so no suffix is ranked: this is not the
difference-cover sort that the operator is named after (see the README).  What runs:

1. Texts are parsed so that equal text is parsed alike.  Every start has an anchor, the smallest of the
   ``length * 3 / 5``-byte strings inside its window, and starts with one anchor form a phrase.  Anchors
   that occur once rule out their starts.
2. Phrases that remain are symbols; runs of up to nine symbols are hashed from triples of symbols and
   triples of those, once for each of the groupings of places modulo 3.  Equal hashes are grouped, a
   fragment per task, and all but the first of a group repeat it as deep as the windows of a phrase reach.
3. Starts that are not settled so (around the ends of repeats) are grouped by the hash of their
   ``length`` bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from veleta.llm import frames
from veleta.llm.common import ODD, U64, arrow_map, mix, octets, raw_texts
from veleta.llm.substrings import GATHER, NO_ID, SENT, _Gatherer, _keyed, _keys, covered, exchange

CHUNK = 1 << 20    # starts of one text that are parsed at a time


def _offsets(width: int) -> list[int]:
    """Places of the eight-byte words that cover ``width`` bytes (8 or more)."""
    return [*range(0, width - 7, 8)] + ([width - 8] if width % 8 else [])


def strings_at(data: bytes, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit values of the ``width``-byte strings at the given places."""
    view = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    out = np.zeros(len(at), np.uint64)
    for k, d in enumerate(_offsets(width)):
        out += view[at + d] * ODD[2 + k]
    return mix(out)


def _sliding(data: bytes, width: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(value of the ``width``-byte string at every place, place of the smallest of ``reach``)."""
    n = len(data) - width + 1
    view = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    value = view[:n] * ODD[2]
    for k, d in enumerate(_offsets(width)[1:]):
        value += view[d:d + n] * ODD[3 + k]
    value = mix(value)
    key = (value >> U64(32) << U64(32)) | np.arange(n, dtype=np.uint64)
    pad = -n % reach
    table = np.concatenate([key, np.full(pad, 2**64 - 1, np.uint64)]).reshape(-1, reach)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - reach + 1
    least = np.minimum(right[:starts], left[reach - 1:reach - 1 + starts])
    return value, (least & U64(0xFFFFFFFF)).astype(np.int64)


def phrases(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first start of every phrase, value of its anchor); starts have ``length`` bytes left."""
    starts = len(data) - length + 1
    if starts <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    width = max(8, length * 3 // 5)
    firsts, anchors, last = [], [], -1
    for a in range(0, starts, CHUNK):
        value, place = _sliding(data[a:min(starts, a + CHUNK) + length - 1], width, length - width + 1)
        new = np.flatnonzero(np.r_[place[0] + a != last, place[1:] != place[:-1]])
        firsts.append(new + a)
        anchors.append(value[place[new]])
        last = int(place[-1]) + a
    return np.concatenate(firsts), np.concatenate(anchors)


def _symbols(data: bytes, first: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """A value for the bytes from each wanted phrase to the next, the last one to the end of the text."""
    view, ends, at = memoryview(data), np.r_[first[1:], len(data)], np.flatnonzero(wanted)
    out = np.zeros(len(first), np.uint64)
    out[at] = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first[at].tolist(), ends[at].tolist())),
                          np.uint64, len(at))
    return out


def _named(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for k, c in enumerate(columns):
        out += c * ODD[20 + k]
    return mix(out)


def suffix_keys(data: bytes, first: np.ndarray, open_: np.ndarray, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(phrases, keys) of the three merged orders for the open phrases; keys are equal only if all windows that start
    in the phrases are.

    A name stops at the symbol in which the last of these windows ends, so a suffix is settled up to
    the end of a repeat; deeper than nine symbols it is left to the comparison of starts.
    """
    n = len(first)
    wanted = open_.copy()
    for i in range(1, 9):
        wanted[i:] |= open_[:-i]
    symbol = _symbols(data, first, wanted)
    ends = np.r_[first[1:], len(data)]                               # bytes that a symbol reaches
    last = np.r_[first[1:], len(data) - length + 1] + length - 1      # where a phrase's windows end
    k = np.flatnonzero(open_)
    depth = np.searchsorted(ends, last[k]) - k + 1
    k, depth = k[depth <= 9], depth[depth <= 9]
    # Names of the first 0, 1, 2 and 3 symbols at every place, zeros beyond the end.
    s = np.concatenate([symbol, np.zeros(12, np.uint64)])
    names = np.zeros((4, n + 10), np.uint64)
    for j in range(1, 4):
        names[j] = _named(*(s[i:n + 10 + i] if i < j else np.zeros(n + 10, np.uint64) for i in range(3)))

    def name(at: np.ndarray, deep: np.ndarray) -> np.ndarray:
        """The recursion: a triple of names of triples."""
        return _named(*(names[np.clip(deep - 3 * i, 0, 3), np.minimum(at + 3 * i, n + 9)] for i in range(3)))

    after = s[np.minimum(k + 1, n)]
    orders = ((k % 3 != 0, name(k, depth)), (k % 3 != 2, _named(s[k], name(k + 1, depth - 1))),
              (k % 3 != 1, _named(s[k], np.where(depth > 1, after, U64(0)), name(k + 2, depth - 2))))
    return [(k[own], mix(key ^ U64(m + 1))[own]) for m, (own, key) in enumerate(orders)]


def _later(values, flags, ids, place):
    """What is not the first (smallest id, then place) among equal values."""
    rank = np.lexsort((place, ids))
    order, starts, _ = frames.runs(values[rank])
    mask = np.ones(len(order), bool)
    mask[starts] = False
    own = np.unique(rank[order[mask]])
    return frames.coded(ids[own], place[own])


def _all_repeated(values, flags, ids, place):
    order, starts, run = frames.runs(values)
    own = order[(np.diff(np.r_[starts, len(order)]) > 1)[run]]
    return frames.coded(ids[own], place[own])


def repeats(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """((id, places) of phrases all of whose windows also start earlier, (id, places) of single
    starts of such windows), for rows (id, text)."""
    total = octets(docs, "text")
    bits = frames.fragment_bits(total // 20)

    def anchored(batches):
        gather = _Gatherer(bits, False, "all")
        for b in batches:
            for doc, text in zip(b.column("id").to_numpy(), raw_texts(b.column("text"))):
                if doc == NO_ID:
                    continue
                _, anchors = phrases(text, length)
                gather.add(doc, anchors, np.arange(len(anchors)), np.zeros(len(anchors), bool), len(anchors))
                if gather.n >= GATHER:
                    yield from gather.send()
        yield from gather.send()

    shared = exchange(arrow_map(docs, anchored, SENT), bits, False, _all_repeated)

    def suffixes(batches):
        gather = _Gatherer(bits, True, "later")
        for b in batches:
            for doc, text, places in zip(b.column("id").to_numpy(), raw_texts(b.column("text")), b.column("shared")):
                first, _ = phrases(text, length)
                open_ = frames.mask(places.as_py(), len(first))
                if not open_.any():
                    continue
                at, keys = (np.concatenate(x) for x in zip(*suffix_keys(text, first, open_, length)))
                order = np.argsort(at, kind="stable")
                gather.add(doc, keys[order], at[order], np.zeros(len(at), bool), len(first))
                if gather.n >= GATHER:
                    yield from gather.send()
        yield from gather.send()

    touched = docs.join(shared.withColumnRenamed("places", "shared"), "id").select("id", "text", "shared")
    settled = exchange(arrow_map(touched, suffixes, SENT), bits, True, _later)

    def prefixes(batches):
        gather = _Gatherer(bits, True, "later")
        for b in batches:
            for doc, text, places, done in zip(b.column("id").to_numpy(), raw_texts(b.column("text")),
                                               b.column("shared"), b.column("settled")):
                first, _ = phrases(text, length)
                open_ = frames.mask(places.as_py(), len(first))
                open_ &= ~frames.mask(done.as_py(), len(first))
                starts = len(text) - length + 1
                if not open_.any():
                    continue
                at = np.flatnonzero(np.repeat(open_, np.diff(np.r_[first, starts])))
                gather.add(doc, strings_at(text, at, length), at, np.zeros(len(at), bool), starts)
                if gather.n >= GATHER:
                    yield from gather.send()
        yield from gather.send()

    rest = touched.join(settled.withColumnRenamed("places", "settled"), "id", "left").select(
        "id", "text", "shared", "settled")
    return settled, exchange(arrow_map(rest, prefixes, SENT), bits, True, _later)


def removed(text: bytes, length: int, settled: list[bytes] | None, single: list[bytes] | None) -> np.ndarray:
    """Mask of the bytes inside windows that start in settled phrases or at single starts."""
    starts = max(0, len(text) - length + 1)
    mask = frames.mask(single, starts)
    if settled:
        first, _ = phrases(text, length)
        mask |= np.repeat(frames.mask(settled, len(first)), np.diff(np.r_[first, starts]))
    return covered(mask, length, len(text))


def dedup(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
          keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every byte that lies in a ``length``-byte string which also starts earlier, in a smaller
    id or earlier in the same document; overlaps count, strings are judged on the input and never
    cross documents.

    Returns id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, with
    ``keep_text``, what is left as text; a character of which only some bytes are left is dropped from it.
    Columns named in ``carry`` come along.

    Ids are integers; a row without id has no place in the order, takes no part and keeps its bytes.
    Rows that repeat an id with the same text get the same result as one document (an id should not
    stand for different texts).  Null, empty and short texts lose
    nothing.  An empty table gives an empty one; other columns are ignored.
    """
    settled, single = repeats(_keyed(docs, id_col, text_col), length)
    also = [f"c{k}" for k in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(carry, also)], *_keys(id_col, text_col))
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.select(*also).schema) if also else ""

    def cut(batches):
        for b in batches:
            size, lost, spans, sha, kept_text = [], [], [], [], []
            for text, done, starts in zip(raw_texts(b.column("text")), b.column("settled"), b.column("single")):
                size.append(len(text))
                if done.is_valid or starts.is_valid:
                    gone = removed(text, length, done.as_py(), starts.as_py())
                    lost.append(int(gone.sum()))
                    spans.append(int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()))
                    text = np.frombuffer(text, np.uint8)[~gone].tobytes()
                else:
                    lost.append(0)
                    spans.append(0)
                sha.append(hashlib.sha256(text).hexdigest())
                if keep_text:
                    kept_text.append(text.decode("utf-8", "ignore"))
            columns = [b.column("id"), *(pa.array(x, pa.int64()) for x in (size, lost, spans)), pa.array(sha, pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(kept_text, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays([*columns, *(b.column(a) for a in also)], [*names, *also])

    full = (rows.join(settled.withColumnRenamed("places", "settled"), "id", "left")
            .join(single.withColumnRenamed("places", "single"), "id", "left").select("id", "text", "settled", "single", *also))
    out = arrow_map(full, cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                    + (", kept_text string" if keep_text else "") + kinds)
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), *[c for c in out.columns if c != "id" and c not in also],
                      *[F.col(a).alias(c) for c, a in zip(carry, also)])
