"""Exchange of very many 64-bit values between documents in compact frames.

A map task cuts the values of a batch of documents into fragments (ranges of the value) and sends
one frame per fragment, so a fragment meets in one task as a few hundred arrays instead of millions
of rows.  A frame holds the documents that own an entry of it and, in document order, the gap to the entry
before and the rest of the value below the fragment's prefix; byte planes keep mostly-zero bytes together
for the shuffle's compression.  The number of fragments follows the number of values, so a fragment's size
stays the same at any scale, and a value costs at most its own bytes and those of its document's id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from veleta.llm.common import U64

FRAME = "frag int, batch binary, flags binary, rests binary"


def fragment_bits(values: int, least: int = 6, target: int = 1 << 22) -> int:
    """log2 of the number of fragments with at most about ``target`` values each."""
    return max(least, int(max(1, values // target)).bit_length())


def planes(a: np.ndarray) -> bytes:
    """The bytes of an integer array, least significant bytes of all entries first."""
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    n = len(data) // size
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, n).T).view(kind).ravel()


def coded(ids: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """(id, places) rows: the ascending places of each id as gaps of seven bits a byte."""
    order = np.lexsort((places, ids))
    ids, places = ids[order], places[order].astype(np.int64)
    new = np.ones(len(ids), bool)
    new[1:] = ids[1:] != ids[:-1]
    gap = places.copy()
    gap[1:][~new[1:]] -= places[:-1][~new[1:]]
    size = 1 + sum((gap >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(5):
        own = size > k
        if not own.any():
            break
        out[at[own] + k] = (gap[own] >> 7 * k & 127) | (size[own] > k + 1).astype(np.int64) << 7
    starts = np.flatnonzero(new)
    offsets = np.r_[at[starts], len(out)].astype(np.int32)
    binary = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return pa.RecordBatch.from_arrays([pa.array(ids[starts], pa.int64()), binary], ["id", "places"])


def decoded(parts: list[bytes]) -> np.ndarray:
    """All places of one id from its coded parts, ascending within a part."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    if not len(data):
        return np.empty(0, np.int64)
    ends = np.flatnonzero(data < 128)
    starts = np.r_[0, ends[:-1] + 1]
    within = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    total = np.cumsum(np.add.reduceat((data & 127).astype(np.int64) << 7 * within, starts))
    heads = np.searchsorted(starts, np.cumsum([0, *map(len, parts[:-1])]))
    before = np.r_[0, total][heads]
    return total - np.repeat(before, np.diff(np.r_[heads, len(total)]))


def _deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def pack(values: np.ndarray, entry: np.ndarray, flags: np.ndarray, ids: np.ndarray, counts: np.ndarray,
         bits: int, wide: bool) -> pa.RecordBatch:
    """Frames of a batch.

    ``values`` are the entries' 64-bit values and ``entry`` their ascending place in the batch,
    where document k (``ids[k]``) owns the next ``counts[k]`` places.  A frame names the documents that
    own one of its entries, how many each, and the entries' places.  ``wide`` sends the whole
    value, otherwise the 32 bits below the fragment's prefix: enough to rule out nearly all values
    that occur once, as fragments stay equally large, if a later step compares exactly.
    """
    frag = (values >> U64(64 - bits)).astype(np.int64)
    order = np.argsort(frag.astype(np.uint16) if bits <= 16 else frag, kind="stable")
    bounds = np.searchsorted(frag[order], np.arange((1 << bits) + 1))
    rest = values if wide else ((values << U64(bits)) >> U64(32)).astype(np.uint32)
    ends = np.cumsum(counts)
    who = np.searchsorted(ends, entry[order], side="right")
    place = (entry[order] - (ends - counts)[who]).astype(np.uint32)
    # Where a document begins in a frame, over all frames at once.
    new = np.ones(len(order), bool)
    new[1:] = who[1:] != who[:-1]
    new[bounds[:-1][bounds[:-1] < len(order)]] = True
    gap = place.copy()
    gap[1:][~new[1:]] -= place[:-1][~new[1:]]
    first = np.flatnonzero(new)
    at = np.searchsorted(first, bounds)
    each = np.diff(np.r_[first, len(order)]).astype(np.uint32)
    owners, rest, flags = ids[who[first]].astype(np.int64), rest[order], flags[order]
    rows = ([], [], [], [])
    for f in np.flatnonzero(np.diff(bounds)).tolist():
        a, b, x, y = bounds[f], bounds[f + 1], at[f], at[f + 1]
        rows[0].append(f)
        rows[1].append(np.int64(y - x).tobytes() + planes(_deltas(owners[x:y])) + planes(each[x:y]) + planes(gap[a:b]))
        rows[2].append(np.packbits(flags[a:b]).tobytes())
        rows[3].append(planes(rest[a:b]))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:])],
        ["frag", "batch", "flags", "rests"])


def unpack(rows: list[tuple[bytes, bytes, bytes]], wide: bool):
    """(values below the prefix, flags, owner, place in the owner, owner ids) of all entries."""
    rests, flags, owner, place, ids = [], [], [], [], []
    base = 0
    for batch, flag, rest in rows:
        n = int(np.frombuffer(batch, np.int64, 1)[0])
        each = unplanes(batch[8 + 8 * n:8 + 12 * n], np.uint32).astype(np.int64)
        total = np.cumsum(unplanes(batch[8 + 12 * n:], np.uint32).astype(np.int64))
        first = np.cumsum(each) - each
        before = np.where(first > 0, total[first - 1], 0)
        rests.append(unplanes(rest, np.uint64 if wide else np.uint32))
        flags.append(np.unpackbits(np.frombuffer(flag, np.uint8), count=len(total)).astype(bool))
        place.append((total - np.repeat(before, each)).astype(np.int32))
        owner.append((np.repeat(np.arange(n), each) + base).astype(np.int32))
        ids.append(np.cumsum(unplanes(batch[8:8 + 8 * n], np.int64)))
        base += n
    cat = np.concatenate
    return cat(rests), cat(flags), cat(owner), cat(place), cat(ids)


def by_fragment(batches):
    """(fragment, its frames, its passed-on rows) from partition rows sorted by fragment."""
    now, held = None, []
    for b in batches:
        columns = [c.to_pylist() for c in b.columns]
        for frag, *rest in zip(*columns):
            if frag != now and held:
                yield now, held
                held = []
            now = frag
            held.append(tuple(rest))
    if held:
        yield now, held


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by value, start of every run of equal values in it, run of every place in it)."""
    order = np.argsort(values, kind="stable")
    s = values[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def mask(parts: list[bytes] | None, size: int) -> np.ndarray:
    """Coded places as a mask; those beyond ``size`` (of another row with the id) are left out."""
    out = np.zeros(size, bool)
    if parts:
        places = decoded(parts)
        out[places[places < size]] = True
    return out
