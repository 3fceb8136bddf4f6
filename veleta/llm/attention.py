"""Language-model scoring with a small causal self-attention model written in numpy.

Words are folded, and each is cut into the subword ids of ``" " + word``; an end id closes a text and
stands before the next one.  P(id | context) = P(group | context) P(class | group, context) P(id | class): the
attention model gives a group and one of its classes, counts over every training text give the id
within the class, so no id has probability zero.

Texts are cut into chunks of ``STRIDE`` ids.  A chunk is scored together with the chunk before it, so
windows of twice that length overlap by half and every id is scored once, with 8 to 15 ids before it.
Chunks of many texts are multiplied as one batch under a causal mask.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from veleta.llm.common import U64, arrow_map, raw_texts, stored, word_hashes
from veleta.llm.packing import encoder

STRIDE = 8                 # ids in a chunk; a window is two chunks
WIDTH, HIDDEN = 16, 32     # sizes of the embedding and of the hidden layer
GROUPS, CLASSES = 16, 16   # groups of classes, and classes in a group
SINGLE = 192               # classes of one id (the most frequent); the other 64 hold many
ROWS = 2048                # frequent ids with an embedding of their own; the others share one per class
HEAVY = 1 << 20            # a word with at least this part of all tokens has its count in every task
FLUSH = 250_000            # different words that a task holds at a time
SLICE = 1 << 20            # bytes of text that a task turns into arrays at a time
BEGIN = 64                 # words at a text's beginning that deal it to a round of training


# -- the model ------------------------------------------------------------------------------------------

def shapes(rows: int) -> dict[str, tuple[int, ...]]:
    d, h = WIDTH, HIDDEN
    return {"emb": (rows, d), "query": (d, d), "key": (d, d), "value": (d, d), "near": (2 * STRIDE,), "out": (d, h), "skip": (d, h),
            "bias": (h,), "last": (h, GROUPS), "prior": (GROUPS,), "deep": (GROUPS, h, CLASSES), "deep_prior": (GROUPS, CLASSES)}


def views(flat: np.ndarray, rows: int) -> dict[str, np.ndarray]:
    """The named parameters inside one flat vector."""
    out, at = {}, 0
    for name, shape in shapes(rows).items():
        n = math.prod(shape)
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def _offsets() -> np.ndarray:
    """How far key j lies before query i of a window (negative: after it)."""
    return np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)[None, :]


CAUSAL, OFFSETS = _offsets() >= 0, np.maximum(_offsets(), 0)


def _last_sums(z: np.ndarray) -> np.ndarray:
    """Sums over the last axis, as one product whatever the axes before are."""
    return (z.reshape(-1, z.shape[-1]) @ np.ones(z.shape[-1], z.dtype)).reshape(z.shape[:-1])


def _exp(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """(exp of logits over the last axis; its sums; what was taken off the logits before).

    Nothing is taken off where neither overflow nor underflow threatens, which is nearly always.
    """
    if z.size and z.max() < 60:
        e = np.exp(z)
        total = _last_sums(e)
        if total.min() > 1e-20:
            return e, total, 0.0
    top = z.max(-1, keepdims=True)
    e = np.exp(z - top)
    return e, e.sum(-1), top[..., 0]


def _softmax(z: np.ndarray) -> np.ndarray:
    e, total, _ = _exp(z)
    e /= total[..., None]
    return e


def _masked(s: np.ndarray, p: dict, first: np.ndarray) -> np.ndarray:
    """Attention weights; the first chunk of a text has nothing before it."""
    s += np.where(CAUSAL, p["near"][OFFSETS], np.float32(-1e9))
    s[first, :, :STRIDE] = -1e9
    return _softmax(s)


def chunks(tokens: np.ndarray, lengths: np.ndarray, end: int):
    """(inputs, targets, real, first, owner) of texts that follow each other in ``tokens``, each with
    its end id: rows of STRIDE places, which of them are real, which rows start a text, whose they are."""
    per = -(-lengths // STRIDE)
    start = np.cumsum(per) - per
    at = np.arange(len(tokens)) + np.repeat(start * STRIDE - (np.cumsum(lengths) - lengths), lengths)
    n = int(per.sum())
    inputs, targets, real = np.full(n * STRIDE, end, np.int32), np.full(n * STRIDE, end, np.int32), np.zeros(n * STRIDE, bool)
    targets[at] = tokens
    inputs[at[1:]] = tokens[:-1]       # the end id of the text before stands before a text
    real[at] = True
    first = np.zeros(n, bool)
    first[start] = True
    shape = (n, STRIDE)
    return inputs.reshape(shape), targets.reshape(shape), real.reshape(shape), first, np.repeat(np.arange(len(lengths)), per)


def _side_by_side(p: dict) -> np.ndarray:
    """The matrices that an embedding meets: query (with the root of the width), key, value, skip."""
    return np.concatenate([p["query"] / np.float32(np.sqrt(WIDTH)), p["key"], p["value"], p["skip"]], 1)


def _both_steps(p: dict) -> np.ndarray:
    """Per group the matrix of both softmax steps side by side; its last row is their bias."""
    out = np.empty((GROUPS, HIDDEN + 1, GROUPS + CLASSES), p["last"].dtype)
    out[:, :HIDDEN, :GROUPS], out[:, HIDDEN, :GROUPS] = p["last"], p["prior"]
    out[:, :HIDDEN, GROUPS:], out[:, HIDDEN, GROUPS:] = p["deep"], p["deep_prior"]
    return out


def _windows(x: np.ndarray, step: int = 1) -> np.ndarray:
    """Views of every chunk with the one after it, from every ``step``-th chunk on."""
    m, _, d = x.shape
    a, b, c = x.strides
    return np.ndarray(((m - 2) // step + 1, 2 * STRIDE, d), x.dtype, x, 0, (step * a, b, c))


def _logits(hidden: np.ndarray, places: np.ndarray, bounds: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hidden layer of ``places`` and a one, logits of the groups and of the own group's classes); ``places`` are
    in the order of their groups."""
    act = np.empty((len(places), HIDDEN + 1), hidden.dtype)
    act[:, :HIDDEN], act[:, HIDDEN] = hidden.take(places, 0), 1
    out = np.empty((len(places), GROUPS + CLASSES), hidden.dtype)
    for g, own in _group_slices(bounds):
        np.matmul(act[own], matrix[g], out=out[own])
    return act, out


@dataclass
class Model:
    """Parameters, classes and counts; about 1 MB whatever the corpus is."""

    tokenizer: str
    end: int
    class_of: np.ndarray       # per id: group * CLASSES + class in the group
    inside: np.ndarray         # log P(id | class), per id
    row_of: np.ndarray         # embedding row, per id
    flat: np.ndarray
    tables: dict = field(default_factory=dict, repr=False)

    @property
    def parameters(self) -> dict[str, np.ndarray]:
        return views(self.flat, int(self.row_of.max()) + 1)

    def __getstate__(self):
        return {**self.__dict__, "tables": {}}

    def prepare(self) -> None:
        """Products of every embedding row with the matrices it meets, side by side: a place costs one look-up."""
        p = self.parameters
        group, member = np.divmod(self.class_of, CLASSES)
        self.tables = {"all": p["emb"] @ _side_by_side(p), "group": group.astype(np.uint8), "member": member.astype(np.uint8),
                       "steps": _both_steps(p)}
        self.tables["all"][:, 3 * WIDTH:] += p["bias"]

    def hidden(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What the model sees after every place of chunks (embedding rows); the first chunk is only looked back at."""
        if not self.tables:
            self.prepare()
        x, p = self.tables["all"].take(rows, 0), self.parameters
        both = _windows(x)
        seen = _masked(x[1:, :, :WIDTH] @ both[:, :, WIDTH:2 * WIDTH].transpose(0, 2, 1), p, first)
        hidden = (seen @ both[:, :, 2 * WIDTH:3 * WIDTH]).reshape(-1, WIDTH) @ p["out"]
        hidden += x[1:, :, 3 * WIDTH:].reshape(-1, HIDDEN)
        return np.maximum(hidden, 0, out=hidden)

    def log_probabilities(self, tokens: np.ndarray, lengths: np.ndarray, block: int = 1024) -> np.ndarray:
        """Natural log-probability of every text of ``tokens`` (each ends with the end id)."""
        inputs, targets, real, first, owner = chunks(tokens, lengths, self.end)
        rows = self.row_of.take(inputs)
        out = np.zeros(len(lengths))
        for a in range(0, len(rows), block):
            z = min(a + block, len(rows))
            hidden = self.hidden(rows[a - 1:z] if a else np.concatenate([rows[:1], rows[:z]]), first[a:z])
            want = targets[a:z].ravel()
            group = self.tables["group"].take(want)
            # In the order of the groups, each of which has its own matrix for the second step.
            order, bounds = _group_order(group)
            _, logits = _logits(hidden, order, bounds, self.tables["steps"])
            at = np.arange(0, logits.size, GROUPS + CLASSES)
            flat = logits.ravel()
            picked = flat.take(at + group.take(order)) + flat.take(at + GROUPS + self.tables["member"].take(want.take(order)))
            found = np.empty(len(want))
            found[order] = picked - _log_sums(logits)
            found = np.where(real[a:z].ravel(), found + self.inside.take(want), 0.0).reshape(z - a, STRIDE).sum(1)
            out += np.bincount(owner[a:z], found, len(out))
        return out


STEPS = np.zeros((GROUPS + CLASSES, 2), np.float32)
STEPS[:GROUPS, 0] = STEPS[GROUPS:, 1] = 1


def _log_sums(logits: np.ndarray) -> np.ndarray:
    """Sum of the logarithms of both steps' normalisers, row by row."""
    if logits.max() < 40:
        sums = np.exp(logits) @ STEPS
        if sums.min() > 1e-15:
            return np.log(sums[:, 0] * sums[:, 1])
    out = np.zeros(len(logits), np.float32)
    for z in (logits[:, :GROUPS], logits[:, GROUPS:]):
        top = z.max(1)
        out += top + np.log(np.exp(z - top[:, None]).sum(1))
    return out


def _group_order(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of their groups, where each group begins)."""
    bounds = np.zeros(GROUPS + 1, np.int64)
    np.cumsum(np.bincount(group, minlength=GROUPS), out=bounds[1:])
    return np.argsort(group.astype(np.uint8), kind="stable"), bounds


def _group_slices(bounds: np.ndarray) -> list[tuple[int, slice]]:
    """(group, its places) of the groups that occur."""
    bounds = bounds.tolist()
    return [(g, slice(a, z)) for g, (a, z) in enumerate(zip(bounds, bounds[1:])) if z > a]


def gradients(p: dict, now: np.ndarray, before: np.ndarray, first: np.ndarray, want: np.ndarray, real: np.ndarray):
    """(loss, gradient of every parameter) for the classes ``want`` after the places of chunks."""
    both = np.stack([before, now], 1).reshape(-1, STRIDE)
    return run_gradients(p, both, first, want, real, np.empty(sum(v.size for v in p.values()), p["emb"].dtype), 2)


def run_gradients(p: dict, run: np.ndarray, first: np.ndarray, want: np.ndarray, real: np.ndarray, into: np.ndarray, step: int = 1):
    """``gradients`` for chunks that follow each other, written to the flat vector ``into``.

    ``run`` has the chunk before the first one too, so every place is looked up and multiplied once, as the
    query that it is and as the key that two windows see.  With ``step`` 2 each chunk has one of its own before it.
    """
    g, n = views(into, len(p["emb"])), max(1, np.count_nonzero(real))
    wide, flat = _side_by_side(p), lambda m: m.reshape(-1, m.shape[-1])
    x = p["emb"].take(run.ravel(), 0)
    y = (x @ wide).reshape(-1, STRIDE, wide.shape[1])
    q, both = y[1::step, :, :WIDTH], _windows(y, step)
    k, v = both[:, :, WIDTH:2 * WIDTH], both[:, :, 2 * WIDTH:3 * WIDTH]
    a = _masked(q @ k.transpose(0, 2, 1), p, first)
    mixed = a @ v
    hidden = flat(mixed) @ p["out"]
    hidden += y[1::step, :, 3 * WIDTH:].reshape(-1, HIDDEN)
    hidden += p["bias"]
    np.maximum(hidden, 0, out=hidden)

    # Both softmax steps of the real places, in the order of their groups.
    places = np.flatnonzero(real.ravel())
    want = want.ravel().take(places)
    order, bounds = _group_order(want // CLASSES)
    places, want, matrix = places.take(order), want.take(order).astype(np.int64), _both_steps(p)
    act, dz = _logits(hidden, places, bounds, matrix)
    picks = np.arange(0, dz.size, GROUPS + CLASSES)
    picks = np.concatenate([picks + want // CLASSES, picks + GROUPS + want % CLASSES])
    for z in (dz.reshape(-1, CLASSES),) if GROUPS == CLASSES else (dz[:, :GROUPS], dz[:, GROUPS:]):
        z[...] = _softmax(z)
    shares = dz.ravel()
    loss = -float(np.log(np.maximum(shares.take(picks), 1e-30)).sum()) / n
    shares[picks] -= 1
    dz *= np.float32(1 / n)
    dsteps, dact = np.zeros_like(matrix), np.empty((len(act), HIDDEN), act.dtype)
    for c, own in _group_slices(bounds):
        np.matmul(act[own].T, dz[own], out=dsteps[c])
        np.matmul(dz[own], matrix[c, :HIDDEN].T, out=dact[own])
    g["last"][:], g["prior"][:] = dsteps[:, :HIDDEN, :GROUPS].sum(0), dsteps[:, HIDDEN, :GROUPS].sum(0)
    g["deep"][:], g["deep_prior"][:] = dsteps[:, :HIDDEN, GROUPS:], dsteps[:, HIDDEN, GROUPS:]
    dh = np.zeros_like(hidden)
    dh[places] = dact
    dh *= hidden > 0
    g["out"][:], g["bias"][:] = flat(mixed).T @ dh, np.ones(len(dh), dh.dtype) @ dh

    dm = (dh @ p["out"].T).reshape(mixed.shape)
    ds = dm @ v.transpose(0, 2, 1)
    ds -= _last_sums(ds * a)[..., None]
    ds *= a
    g["near"][:] = np.bincount(OFFSETS.ravel(), (ds.sum(0) * CAUSAL).ravel(), 2 * STRIDE)
    dk, dv = ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dm
    dy = np.zeros_like(y)
    np.matmul(ds, k, out=dy[1::step, :, :WIDTH])
    for at, d in ((WIDTH, dk), (2 * WIDTH, dv)):
        dy[:-1:step, :, at:at + WIDTH] = d[:, :STRIDE]
        dy[1::step, :, at:at + WIDTH] += d[:, STRIDE:]
    dy[1::step, :, 3 * WIDTH:] = dh.reshape(-1, STRIDE, HIDDEN)
    dy = flat(dy)
    d = x.T @ dy
    g["query"][:], g["key"][:] = d[:, :WIDTH] / np.float32(np.sqrt(WIDTH)), d[:, WIDTH:2 * WIDTH]
    g["value"][:], g["skip"][:] = d[:, 2 * WIDTH:3 * WIDTH], d[:, 3 * WIDTH:]
    at = run.reshape(-1, 1) * np.int64(WIDTH) + np.arange(WIDTH)
    g["emb"][:] = np.bincount(at.ravel(), (dy @ wide.T).ravel(), g["emb"].size).reshape(g["emb"].shape)
    return loss, g


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.s, self.held = np.zeros(size, np.float32), np.zeros(size, np.float32), np.empty(size, np.float32)
        self.rate, self.t = rate, 0

    def step(self, flat: np.ndarray, g: np.ndarray) -> None:
        """Changes ``flat``, and ``g`` too."""
        self.t += 1
        rate, held = self.rate / np.sqrt(1 + self.t / 100), self.held
        np.multiply(g, g, out=held)
        held -= self.s
        held *= np.float32(0.01)
        self.s += held
        g -= self.m
        g *= np.float32(0.1)
        self.m += g
        np.multiply(self.s, np.float32(1 / (1 - 0.99 ** self.t)), out=held)
        np.sqrt(held, out=held)
        held += np.float32(1e-6)
        np.divide(self.m, held, out=held)
        held *= np.float32(rate / (1 - 0.9 ** self.t))
        flat -= held


# -- ids of words ----------------------------------------------------------------------------------------

class WordIds(dict):
    """word -> its subword ids as bytes of uint32; forgets all when it has grown beyond ``limit`` words."""

    def __init__(self, tokenizer: str, limit: int = 300_000):
        super().__init__()
        self.encode, self.limit = encoder(tokenizer), limit
        # Whether an id's text begins with a blank.
        name, size = self.encode.__self__.decode_single_token_bytes, self.encode.__self__.max_token_value + 1
        self.blank = np.array([name(i)[:1] == b" " for i in range(size)])

    def learn(self, words: list[bytes]) -> None:
        """Encode the words that are not known.

        Encoded together they give what they give alone: each begins with a blank, the only one in it, so
        the vocabulary's pattern cuts between words.  Words with other white space are encoded alone.
        """
        if len(self) >= self.limit:
            self.clear()
        new = [w for w in set(words) if w not in self]
        if not new:
            return
        text = [w.decode("utf-8", "replace") for w in new]
        plain = [k for k, t in enumerate(text) if not any(map(str.isspace, t))] if not all(map(str.isprintable, text)) else range(len(new))
        ids = np.array(self.encode("".join([" " + text[k] for k in plain])), np.uint32) if len(plain) else np.empty(0, np.uint32)
        starts = np.flatnonzero(self.blank[ids])
        if len(starts) == len(plain):
            raw, ends = ids.tobytes(), [*(4 * starts[1:]).tolist(), 4 * len(ids)]
            self.update(zip([new[k] for k in plain], [raw[a:z] for a, z in zip((4 * starts).tolist(), ends)]))
        for w, t in zip(new, text):
            if w not in self:
                self[w] = np.array(self.encode(" " + t), np.uint32).tobytes()

    def texts(self, texts: list[list[bytes]], end: bytes) -> list[bytes]:
        """The ids of every text and the end id."""
        self.learn([w for words in texts for w in words])
        return [b"".join(map(self.__getitem__, words)) + end for words in texts]


def _binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose rows hold ``lengths`` of ``values`` each."""
    offsets = np.r_[0, np.cumsum(lengths * values.itemsize)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _coded(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, how many each has) of a column of ``coded``."""
    kind = np.dtype(np.uint16 if end < 1 << 16 else np.uint32)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return raw.view(kind).astype(np.int32), np.diff(offsets) // kind.itemsize


def _pieces(lengths: np.ndarray, most: int):
    """(begin, end) of runs of rows with at most ``most`` ids, or of one row."""
    ends, begin = np.cumsum(lengths), 0
    while begin < len(lengths):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, "right")))
        yield begin, stop
        begin = stop


def coded(rows: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Stored (id, held_out, text, begin, ids): every text cut into ids once, for counting, training and scoring.

    ``ids`` are two bytes each (four in a vocabulary beyond 65,536), ``begin`` is a hash of how the text begins.
    """
    kind = np.uint16 if end < 1 << 16 else np.uint32

    def cut(batches):
        ids, close = WordIds(tokenizer), np.uint32(end).tobytes()
        for b in batches:
            for begin, texts in _slices(b):
                found = ids.texts(texts, close)
                lengths = np.array([len(t) // 4 for t in found], np.int64)
                own = b.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("held_out"), own.column("text"),
                     pa.array([zlib.crc32(b" ".join(words[:BEGIN])) for words in texts], pa.int64()),
                     _binary(np.frombuffer(b"".join(found), np.uint32).astype(kind), lengths)],
                    ["id", "held_out", "text", "begin", "ids"])

    id_type, text_type = (rows.schema[c].dataType.simpleString() for c in ("id", "text"))
    return stored(arrow_map(rows, cut, f"id {id_type}, held_out boolean, text {text_type}, begin long, ids binary"), "coded")


def _slices(batch: pa.RecordBatch):
    """(first row, folded words of every text) of rows with about ``SLICE`` bytes at a time."""
    held, size, begin = [], 0, 0
    for k, t in enumerate(raw_texts(batch.column("text"))):
        held.append(t.lower().split())
        size += len(t)
        if size >= SLICE:
            yield begin, held
            held, size, begin = [], 0, k + 1
    if held:
        yield begin, held


# -- fitting ---------------------------------------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """Stored (h, word, n): how often every word occurs in all training texts, with its 64-bit hash."""
    def count(batches):
        held: Counter = Counter()

        def send():
            words = list(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64).view(np.int64)),
                 pa.array(words, pa.binary()), pa.array(list(held.values()), pa.int64())], ["h", "word", "n"])
            held.clear()

        for b in batches:
            for _, texts in _slices(b):
                for words in texts:
                    held.update(words)
                if len(held) >= FLUSH:
                    yield from send()
        if held:
            yield from send()

    return stored(arrow_map(docs.filter("not held_out").select("text"), count, "h long, word binary, n long")
                  .groupBy("h", "word").agg(F.sum("n").alias("n")), "words")


def subword_counts(words: DataFrame, tokenizer: str, size: int) -> np.ndarray:
    """How often every subword id occurs in all training texts, from the word counts (without the ends of texts)."""
    def count(batches):
        encode, total = encoder(tokenizer), np.zeros(size, np.int64)
        for b in batches:
            ids, n = [], []
            for word, times in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
                found = encode(" " + word.decode("utf-8", "replace"))
                ids += found
                n += [times] * len(found)
            np.add.at(total, np.array(ids, np.int64), np.array(n, np.int64))
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own])], ["id", "n"])

    out = np.zeros(size, np.int64)
    for r in arrow_map(words.select("word", "n"), count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r[0]] = r[1]
    return out


def id_counts(texts: DataFrame, size: int, end: int) -> np.ndarray:
    """How often every id occurs in all training texts, ends with them, from the ids of ``coded``."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(_coded(b.column("ids"), end)[0], minlength=size)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own])], ["id", "n"])

    out = np.zeros(size, np.int64)
    found = arrow_map(texts.filter("not held_out").select("ids"), count, "id long, n long")
    for r in found.groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r[0]] = r[1]
    return out


def start_model(counts: np.ndarray, end: int, tokenizer: str, names: list[bytes]) -> Model:
    """The model before training: shares of groups and classes as the corpus has them, small fixed weights.

    The most frequent ids are classes of their own; the others, in the order of their spelling, are
    cut into classes of equal mass, and classes that follow each other make up a group, so what begins
    alike stays together.
    """
    size = len(counts)
    often = np.lexsort((np.arange(size), -counts))
    spelled = np.array(sorted(range(size), key=lambda i: (names[i], i)))
    label = np.full(size, -1, np.int64)
    label[often[:SINGLE]] = np.arange(min(SINGLE, size))
    rest = spelled[label[spelled] < 0]
    shared = GROUPS * CLASSES - SINGLE
    mass = np.cumsum(counts[rest] + 1)
    label[rest] = SINGLE + (mass - 1) * shared // max(1, int(mass[-1]) if len(mass) else 1)
    # Classes in the order in which their first id is spelled.
    used, first, label = np.unique(label[spelled], return_index=True, return_inverse=True)
    rank = np.empty(len(used), np.int64)
    rank[np.argsort(first)] = np.arange(len(used))
    class_of = np.empty(size, np.int64)
    class_of[spelled] = rank[label]
    per = np.bincount(class_of, counts + 1.0, GROUPS * CLASSES)
    inside = np.log((counts + 1.0) / per[class_of])
    row_of = ROWS + class_of
    row_of[often[:ROWS]] = np.arange(min(ROWS, size))
    rows = int(row_of.max()) + 1
    flat = np.random.default_rng(11).normal(0, 0.15, sum(int(np.prod(x)) for x in shapes(rows).values())).astype(np.float32)
    p = views(flat, rows)
    for name in ("near", "bias"):
        p[name][:] = 0
    per = per.reshape(GROUPS, CLASSES)
    share = lambda m, whole: np.where(m > 0, np.log(np.maximum(m, 1) / np.maximum(whole, 1)), -1e9)
    p["prior"][:] = share(per.sum(1), per.sum())
    p["deep_prior"][:] = share(per, per.sum(1, keepdims=True))
    return Model(tokenizer, end, class_of.astype(np.int32), inside, row_of.astype(np.int32), flat)


def _averaged(rows: DataFrame, size: int, slices: int = 16) -> np.ndarray | None:
    """Mean of the tasks' parameters by the places they learnt from, slice by slice in as many tasks."""
    cuts = np.linspace(0, size, slices + 1).astype(int)

    def cut(batches):
        for b in batches:
            for part, n, raw in zip(*(c.to_pylist() for c in b.columns)):
                flat = np.frombuffer(raw, np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(slices), pa.int32()), pa.array([part] * slices, pa.int32()), pa.array([n] * slices, pa.int64()),
                     pa.array([flat[a:z].tobytes() for a, z in zip(cuts, cuts[1:])], pa.binary())], ["slice", "part", "n", "flat"])

    def mean(batches):
        now, total, weight = None, None, 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())],
                                              ["slice", "flat"])

        for b in batches:
            for s, _, n, raw in zip(*(c.to_pylist() for c in b.columns)):
                if s != now:
                    if now is not None:
                        yield done()
                    now, total, weight = s, 0.0, 0
                total = total + n * np.frombuffer(raw, np.float32).astype(np.float64)
                weight += n
        if now is not None:
            yield done()

    sliced = arrow_map(rows, cut, "slice int, part int, n long, flat binary")
    found = arrow_map(sliced.repartition(slices, "slice").sortWithinPartitions("slice", "part"), mean, "slice int, flat binary").collect()
    if not found:
        return None
    return np.frombuffer(b"".join(r[1] for r in sorted(found)), np.float32).copy()


def train(texts: DataFrame, model: Model, rounds: int, share: int = 1, batch: int = 128, rate: float = 0.03, most: int = 512) -> Model:
    """Local steps in every task, averaged after each round.

    The rounds deal the training texts of ``coded`` among them (by a hash of how a text begins), so every place of every
    training text is learnt from once, in the windows that score it.  A step takes ``batch`` chunks, and more the further
    a task has come, ``most`` in the end.  ``share`` above 1, for trials, leaves out the texts that fall on no round.
    """
    for step in range(rounds):
        now = model

        def learn(batches):
            flat, rows = now.flat.copy(), int(now.row_of.max()) + 1
            p, adam, into = views(flat, rows), Adam(len(flat), rate / (1 + step)), np.empty_like(flat)
            row_of, class_of = now.row_of.astype(np.uint16), now.class_of.astype(np.uint16)
            held, seen = None, 0

            def steps(all_of_it: bool):
                """Learn from what is held, whose first chunk is only looked back at."""
                nonlocal held, seen
                run, want, real, first = held
                a, n = 1, len(run)
                while a < n:
                    z = a + min(most, batch + adam.t)
                    if z > n and not all_of_it:
                        break
                    z = min(z, n)
                    run_gradients(p, run[a - 1:z], first[a:z], want[a:z], real[a:z], into)
                    adam.step(flat, into)
                    seen += np.count_nonzero(real[a:z])
                    a = z
                held = [c[a - 1:] for c in held]

            for b in batches:
                ids, lengths = _coded(b.column("ids"), now.end)
                at = np.r_[0, np.cumsum(lengths)]
                for begin, stop in _pieces(lengths, SLICE):
                    inputs, targets, real, first, _ = chunks(ids[at[begin]:at[stop]], lengths[begin:stop], now.end)
                    more = [row_of.take(inputs), class_of.take(targets), real, first]
                    held = [np.concatenate(c) for c in zip(held or [c[:1] for c in more], more)]
                    steps(False)
            if held:
                steps(True)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([seen], pa.int64()),
                                                  pa.array([flat.tobytes()], pa.binary())], ["part", "n", "flat"])

        rows = arrow_map(texts.filter((~F.col("held_out")) & (F.col("begin") % (share * rounds) == step)).select("ids"), learn,
                         "part int, n long, flat binary")
        flat = _averaged(rows, len(model.flat))
        if flat is None:
            continue   # no text fell on this round
        model = Model(model.tokenizer, model.end, model.class_of, model.inside, model.row_of, flat)
    return model


@dataclass
class Fitted:
    """A trained model with the word counts of its training texts."""

    model: Model
    words: DataFrame           # stored (h, word, n)
    texts: int                 # training texts
    tokens: int                # N: words and ends
    distinct: int              # V: different words, and the end
    coded: DataFrame | None = None   # all rows of the table that it was fitted on, cut into ids (stored)
    source: tuple | None = None      # that table and its columns of ids and texts


def keyed(docs: DataFrame, id_col: str, text_col: str, modulus: int = 7, held_out: int = 2) -> DataFrame:
    """(id, held_out, text); a row without id counts as one with an empty id."""
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), (F.crc32(name.cast("binary")) % modulus == held_out).alias("held_out"),
                       F.col(f"`{text_col}`").alias("text"))


def fit(docs: DataFrame, tokenizer: str, rounds: int = 2, share: int = 1, id_col: str = "doc_id", text_col: str = "text") -> Fitted:
    """Count words and subwords of all training rows (those not held out) and train the model on them.

    ``tokenizer`` is a byte-level vocabulary file that every executor can open; it is never trained.
    The attention weights and the counts see every place of every training text; ``share`` is that of ``train``.
    """
    from tokenizers import Tokenizer

    rows = keyed(docs, id_col, text_col)
    words = word_counts(rows)
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True)
    size = max(vocabulary.values()) + 1
    end = next((i for t, i in sorted(vocabulary.items()) if t.startswith("<|end")), 0)
    names = [b""] * size
    for token, i in vocabulary.items():
        names[i] = token.encode()
    cut = coded(rows, tokenizer, end)
    texts = cut.filter("not held_out").count()
    model = train(cut, start_model(id_counts(cut, size, end), end, tokenizer, names), rounds, share)
    return Fitted(model, words, texts, n + texts, v + (texts > 0), cut, (docs, id_col, text_col))


# -- scoring ---------------------------------------------------------------------------------------------

class LogCounts(dict):
    """word -> 16 bytes: log10(count + 1), not a number unless the word is a heavy one, and its hash."""

    def __init__(self, hashes: np.ndarray, logs: np.ndarray, limit: int = 300_000):
        super().__init__()
        self.hashes, self.logs, self.limit = np.r_[hashes, U64(2**64 - 1)], np.r_[logs, np.nan], limit

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(logs, hashes) of words."""
        if len(self) >= self.limit:
            self.clear()
        new = [w for w in set(words) if w not in self]
        h = word_hashes(new)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        raw = np.stack([np.where(self.hashes[at] == h, self.logs[at], np.nan).view(np.uint64), h], 1).tobytes()
        self.update(zip(new, [raw[k:k + 16] for k in range(0, len(raw), 16)]))
        both = np.frombuffer(b"".join(map(self.__getitem__, words)), np.uint64).reshape(-1, 2)
        return both[:, 0].copy().view(np.float64), both[:, 1]


_PART = ("held_out boolean, uid long, n_tokens long, n_heavy long, heavy double, score double, "
         "hashes array<long>, times array<int>")


def score(docs: DataFrame, fitted: Fitted, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the model's log10 probability of the whole text with its end, ``base_score`` that of
    single words with counts one too high.  The counts of heavy words (at most ``HEAVY`` can hold a
    ``HEAVY``-th of all tokens each, 16 MB) go to every task; the others are joined by their hash, and none
    of them is frequent enough to make a hot key.  The table that the model was fitted on is not cut into ids again.

    Null, empty and blank texts are an end alone.  Equal texts get equal scores; repeated rows come back
    one by one; a row without id is a training row.  Very long texts are scored whole, window by
    window.  An empty table gives an empty one; without training rows all counts are zero and the
    model is untrained.  Other columns are ignored.
    """
    n, v, model = fitted.tokens, fitted.distinct, fitted.model
    table, *names = fitted.source or (None,)
    rows = (fitted.coded if table is docs and names == [id_col, text_col] else
            coded(keyed(docs, id_col, text_col), model.tokenizer, model.end)).drop("begin")
    id_type = rows.schema["id"].dataType.simpleString()
    heavy = fitted.words.filter(F.col("n") * HEAVY >= n).select("h", "n").toPandas()
    hashes = heavy["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, logs = hashes[order], np.log10(heavy["n"].to_numpy(np.float64)[order] + 1)
    end_log, some = float(np.log10(fitted.texts + 1)), int(fitted.texts > 0)
    shared = rows.sparkSession.sparkContext.broadcast((model, hashes, logs))

    def run(batches):
        model, hashes, logs = shared.value
        number = TaskContext.get().partitionId() << 40
        known = LogCounts(hashes, logs)
        for b in batches:
            ids, lengths = _coded(b.column("ids"), model.end)
            at = np.r_[0, np.cumsum(lengths)]
            for begin, texts in _slices(b):
                size, m = np.array([len(w) for w in texts], np.int64), len(texts)
                found = model.log_probabilities(ids[at[begin]:at[begin + m]], lengths[begin:begin + m])
                log, h = known.look_up([w for words in texts for w in words])
                owner = np.repeat(np.arange(m), size)
                rare = np.isnan(log)
                sums = np.bincount(owner[~rare], log[~rare], m) + end_log
                seen = np.bincount(owner[~rare], minlength=m) + some
                # Every other word of a text once, with how often it occurs.
                owner, h = owner[rare], h[rare]
                order = np.lexsort((h, owner))
                owner, h = owner[order], h[order]
                new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.empty(0, np.int64)
                times = np.diff(np.r_[new, len(h)]).astype(np.int32)
                offsets = pa.array(np.searchsorted(owner[new], np.arange(m + 1)), pa.int32())
                rows = b.slice(begin, m)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("held_out"), pa.array(number + np.arange(m)), pa.array(size + 1), pa.array(seen, pa.int64()),
                     pa.array(sums), pa.array(found / np.log(10)), pa.ListArray.from_arrays(offsets, pa.array(h[new].view(np.int64))),
                     pa.ListArray.from_arrays(offsets, pa.array(times))],
                    ["id", "held_out", "uid", "n_tokens", "n_heavy", "heavy", "score", "hashes", "times"])
                number += m

    parts = stored(arrow_map(rows, run, f"id {id_type}, {_PART}"), "parts")
    rare = (parts.select("uid", F.explode(F.arrays_zip("hashes", "times")).alias("x"))
            .select("uid", F.col("x.hashes").alias("h"), F.col("x.times").alias("times")))
    rarely = fitted.words.filter(F.col("n") * HEAVY < n).groupBy("h").agg(F.sum("n").alias("n"))
    more = (rare.join(rarely, "h").groupBy("uid")
            .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("also")))
    out = parts.drop("hashes", "times").join(more, "uid", "left")
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_heavy") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("heavy") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"), "score")
