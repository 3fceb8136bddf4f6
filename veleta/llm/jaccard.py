"""N-gram Jaccard join with vertical partitioning.

The shingles of a document are ordered by their 64-bit value and that order is cut into fragments.
Each fragment counts, apart from the others, which documents share its shingles; the partial counts
are summed per document (how many of its shingles can match at all, and how rare they are) and, where
documents meet, per pair (its overlap).

Only groups are wanted, so no row is ever made for a pair.  Of two sets that link, the first
n - need(n) + 1 shingles in rare-first order have one in common; documents are joined into blocks over
these.  A block is compared inside a task, or for a large block inside tasks for pairs of its parts: overlaps
add up fragment by fragment until a pair cannot reach what it needs, and a task gives only links that
join two groups, fewer than it has documents.  In a large block the document with the fewest
shingles of its own goes first; only documents that do not link to it are compared with the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from veleta.llm import frames
from veleta.llm.common import U64, arrow_map, octets, parts, raw_texts, release, stored, window_hashes, word_hashes
from veleta.llm.components import roots
from veleta.llm.substrings import GATHER, NO_ID, SENT, _Gatherer, _keyed

PERCENT = 75
BLOCK_ROWS = 2048          # documents that meet in one task (twice as many where two parts meet)
BLOCK_SHINGLES = 1 << 21   # and their shingles
FRAGMENTS = 8              # steps in which a task adds overlaps up


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit values; short texts are one shingle."""
    words = word_hashes(text.lower().split())
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(size, len(words))) ^ U64(min(size, len(words))))


def need(n):
    """Shingles that a set of ``n`` must share with any set it links to."""
    return (PERCENT * n + 99) // 100


def _signature(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, text_hash, n, s1, s2): size and 128-bit signature of every document's set."""
    def run(batches):
        for b in batches:
            found = [shingles(t, size) for t in raw_texts(b.column("text"))]
            half = np.frombuffer(b"".join(map(_signature, found)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("text_hash"), pa.array([len(s) for s in found], pa.int64()),
                 pa.array(half[:, 0]), pa.array(half[:, 1])], ["id", "text_hash", "n", "s1", "s2"])

    return arrow_map(with_text_hash(docs, "text_hash"), run, "id long, text_hash long, n long, s1 long, s2 long")


def _sharing(docs: DataFrame, size: int) -> DataFrame:
    """(id, shared): how many of a document's first shingles other documents have among theirs.

    Of two sets that link, the k-th smallest common shingle is among the first n - need(n) + k of
    both.  With k = 15 % of n, 40 % of the shingles are exchanged, and a document goes on only if
    it shares k of the smallest set it could link to.
    """
    bits = frames.fragment_bits(octets(docs, "text") // 15)

    def first(batches):
        gather = _Gatherer(bits, False, "all")
        gather.counted = True
        for b in batches:
            seen = set()
            for doc, text in zip(b.column("id").to_numpy(), raw_texts(b.column("text"))):
                s = shingles(text, size)
                sign = xxhash.xxh3_128_digest(s.tobytes())
                if not len(s) or sign in seen:   # a copy in the batch has the same fate
                    continue
                seen.add(sign)
                s = s[:len(s) - need(len(s)) + max(1, 15 * len(s) // 100)]
                gather.add(doc, s, np.arange(len(s)), np.zeros(len(s), bool), len(s))
                if gather.n >= GATHER:
                    yield from gather.send_counts()
        yield from gather.send_counts()

    def meet(batches):
        for _, rows in frames.by_fragment(batches):
            known = [r for r in rows if r[0] is None]
            if known:
                yield pa.RecordBatch.from_arrays([pa.array([r[3] for r in known], pa.int64()),
                                                  pa.array([int.from_bytes(r[4], "little") for r in known], pa.int64())], ["id", "shared"])
            packed = [r[:3] for r in rows if r[0] is not None]
            if packed:
                values, counted, owner, _, ids = frames.unpack(packed, False)
                order, starts, run = frames.runs(values)
                many = np.diff(np.r_[starts, len(order)]) > 1
                own = order[many[run]]
                n = np.bincount(owner[own[~counted[own]]], minlength=len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(ids[n > 0]), pa.array(n[n > 0].astype(np.int64))],
                                                 ["id", "shared"])

    sent = arrow_map(docs, first, SENT)
    laid = sent.repartition(max(parts(sent), min(1 << bits, 1 << 16)), "frag").sortWithinPartitions("frag")
    return arrow_map(laid, meet, "id long, shared long").groupBy("id").agg(F.sum("shared").alias("shared"))


def _profile(state: DataFrame, bits: int) -> DataFrame:
    """(id, df, values): of every fragment a document has shared shingles in, these shingles and in how
    many documents each occurs."""
    def cut(batches):
        held, n = [], 0
        for b in batches:
            for doc, raw in zip(b.column("id").to_pylist(), b.column("set").to_pylist()):
                held.append((doc, np.frombuffer(raw, np.uint64)))
                n += len(held[-1][1])
                if n >= GATHER:
                    yield send(held)
                    held, n = [], 0
        if held:
            yield send(held)

    def send(held):
        counts = np.array([len(s) for _, s in held], np.int64)
        values = np.concatenate([s for _, s in held])
        return frames.pack(values, np.arange(len(values)), np.zeros(len(values), bool),
                           np.array([doc for doc, _ in held], np.int64), counts, bits, True)

    def meet(batches):
        for _, rows in frames.by_fragment(batches):
            values, _, owner, _, ids = frames.unpack(rows, True)
            order, starts, run = frames.runs(values)
            df = np.diff(np.r_[starts, len(order)])[run]
            own = order[df > 1]
            by = np.argsort(owner[own], kind="stable")
            own, df = own[by], df[df > 1][by].astype(np.uint32)
            first = np.flatnonzero(np.r_[True, np.diff(owner[own]) > 0]) if len(own) else np.empty(0, np.int64)
            ends = [*first[1:].tolist(), len(own)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[owner[own[first]]]), pa.array([df[a:z].tobytes() for a, z in zip(first, ends)], pa.binary()),
                 pa.array([values[own[a:z]].tobytes() for a, z in zip(first, ends)], pa.binary())], ["id", "df", "values"])

    sent = arrow_map(state.select("id", "set"), cut, frames.FRAME)
    laid = sent.repartition(max(parts(sent), min(1 << bits, 1 << 16)), "frag").sortWithinPartitions("frag")
    return arrow_map(laid, meet, "id long, df binary, values binary")


def _probes(state: DataFrame, bits: int) -> DataFrame:
    """(id, shared, keys): how many shingles a document shares with others at all, and its first shared
    shingles in rare-first order; documents that share too few are left out."""
    def choose(batches):
        for b in batches:
            out = ([], [], [])
            for doc, n, df, values in zip(*(c.to_pylist() for c in b.columns)):
                df, values = np.frombuffer(b"".join(df), np.uint32), np.frombuffer(b"".join(values), np.uint64)
                take = len(values) - need(n) + 1
                if take > 0:
                    first = values[np.lexsort((values, df))[:take]]
                    for column, value in zip(out, (doc, len(values), first.view(np.int64))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.list_(pa.int64()))], ["id", "shared", "keys"])

    # Both lists come from the same rows in the same order.
    both = _profile(state, bits).groupBy("id").agg(F.collect_list(F.struct("df", "values")).alias("x"))
    rows = both.join(state.select("id", "n"), "id").select("id", "n", F.col("x.df").alias("df"), F.col("x.values").alias("values"))
    return arrow_map(rows, choose, "id long, shared long, keys array<long>")


def _blocks(probes: DataFrame) -> DataFrame:
    """Stored (node, root): documents that are connected over common keys of ``probes``."""
    keys = probes.select("id", F.explode("keys").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last")
    # A key of very many documents is one row of ``hubs``; the adaptive planner splits its other side.
    return roots(keys.join(hubs, "key").filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct())


class _Groups:
    """Which documents of a task are known to be connected."""

    def __init__(self, group: np.ndarray):
        self.of = np.unique(group, return_inverse=True)[1]
        self.size = np.bincount(self.of)

    def join(self, x: int, y: int) -> None:
        a, b = self.of[x], self.of[y]
        if self.size[a] < self.size[b]:
            a, b = b, a
        self.of[self.of == b] = a
        self.size[a] += self.size[b]
        self.size[b] = 0


def spanning_links(ids: np.ndarray, n: np.ndarray, group: np.ndarray, side: np.ndarray, cuts: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect all groups of documents that links connect, at most one less than documents.

    With two sides only documents of different sides are compared.  A document is compared with all of
    other groups at once: the fragments of the shingle order add to the overlaps one after the other, and
    a pair drops out as soon as what is left cannot make up what it needs.
    """
    m = len(ids)
    size = np.array([len(c) for c in cuts], np.int64)
    owner = np.repeat(np.arange(m), size)
    order, starts, run = frames.runs(np.concatenate(cuts))
    count = np.diff(np.r_[starts, len(order)])
    who = owner[order]
    run_of = np.empty(len(order), np.int64)
    run_of[order] = run
    shared = count[run_of] > 1
    held, own_runs = np.r_[0, np.cumsum(np.bincount(owner[shared], minlength=m))], run_of[shared]
    groups, links, done = _Groups(group), [], np.zeros(m, bool)
    two = bool(side.any()) and not side.all()

    def compare(x: int) -> None:
        left = int(held[x + 1] - held[x])
        wanted = (PERCENT * (n[x] + n) + 99 + PERCENT) // (100 + PERCENT)
        alive = (groups.of != groups.of[x]) & ~done & (100 * np.minimum(n, n[x]) >= PERCENT * np.maximum(n, n[x]))
        if two:
            alive &= side != side[x]
        alive &= wanted <= left
        same = np.zeros(m, np.int64)
        for part in np.array_split(own_runs[held[x]:held[x + 1]], max(1, min(FRAGMENTS, left // 16))):
            if not alive.any():
                break
            k = count[part]
            at = np.arange(int(k.sum())) + np.repeat(starts[part] - (np.cumsum(k) - k), k)
            same += np.bincount(who[at], minlength=m)
            left -= len(part)
            alive &= same + left >= wanted
        for y in np.flatnonzero(alive).tolist():
            if groups.of[y] != groups.of[x]:
                groups.join(x, y)
                links.append((int(ids[x]), int(ids[y])))

    # First who has the fewest shingles of its own: it is the likeliest to link to many.
    open_ = np.argsort(n - np.diff(held), kind="stable")
    if two:
        for x in open_[side[open_] == 0].tolist():
            compare(x)
        return links
    while len(open_):
        for x in open_.tolist():
            # Members of the largest group wait: whoever is outside it compares itself with them.
            if groups.size[groups.of[x]] == 1 or groups.of[x] != groups.size.argmax():
                compare(x)
                done[x] = True
        rest = np.flatnonzero(~done)
        open_ = rest[groups.of[rest] != groups.size.argmax()]
    return links


MEMBER = "id long, n long, grp long, side int, set binary"


def _meet(rows: DataFrame) -> DataFrame:
    """(a, b): the spanning links of every task of ``rows(block, x, y, id, n, grp, side, set)``."""
    def work(batches):
        for _, members in frames.by_fragment(batches):
            if len(members) > 1:
                ids, n, group = (np.array([r[k] for r in members], np.int64) for k in range(3))
                links = spanning_links(ids, n, group, np.array([r[3] for r in members]),
                                       [np.frombuffer(r[4], np.uint64) for r in members])
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = rows.select(F.struct("block", "x", "y").alias("task"), "id", "n", "grp", "side", "set")
    laid = rows.repartition(F.col("task.block"), F.col("task.x"), F.col("task.y")).sortWithinPartitions("task", "id")
    flat = laid.select(F.concat_ws(",", "task.block", "task.x", "task.y").alias("task"), "id", "n", "grp", "side", "set")
    return arrow_map(flat, work, "a long, b long")


def _links(members: DataFrame, state: DataFrame) -> DataFrame:
    """Stored (a, b) links that connect what links connect, of ``members(block, id, n, shared)`` with the
    sets of ``state``.

    Tasks are laid out with thin rows; the sets are joined by document and dealt by task, so a large
    block is never in one place.
    """
    def meet(rows: DataFrame) -> DataFrame:
        return stored(_meet(rows.join(state.select("id", "set"), "id")), "links")

    pieces = lambda rows, shingles: F.ceil(F.greatest(rows / BLOCK_ROWS, shingles / BLOCK_SHINGLES)).cast("int")
    whole = members.groupBy("block").agg(pieces(F.count(F.lit(1)), F.sum("n")).alias("p"),
                                         F.min_by("id", F.struct(F.col("n") - F.col("shared"), F.col("id"))).alias("leader"))
    rows = members.select("block", "id", "n").join(whole, "block")
    zero = F.lit(0)
    near = meet(rows.filter("p = 1").select("block", zero.alias("x"), zero.alias("y"), "id", "n", F.col("id").alias("grp"), zero.alias("side")))
    large = stored(rows.filter("p > 1"), "large")
    if large.isEmpty():
        release(large)
        return near
    # The leader of a large block is sent to each of its parts.
    part = F.when(F.col("id") == F.col("leader"), F.sequence(zero, F.col("p") - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), "p").cast("int")))
    star = meet(large.select("block", F.explode(part).alias("x"), zero.alias("y"), "id", "n", F.col("id").alias("grp"),
                             F.when(F.col("id") == F.col("leader"), 0).otherwise(1).alias("side")))
    linked = star.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("closed", F.lit(True))
    rest = large.join(linked, "id", "left").withColumn("closed", F.col("closed").isNotNull())
    sizes = rest.groupBy("block").agg(
        F.coalesce(pieces(F.count_if(~F.col("closed")), F.sum(F.when(~F.col("closed"), F.col("n")))), zero).alias("po"),
        F.coalesce(pieces(F.count_if("closed"), F.sum(F.when(F.col("closed"), F.col("n")))), zero).alias("pc"))
    rest = rest.drop("p").join(sizes, "block").filter("po > 0")
    slot = F.pmod(F.xxhash64("id"), F.when(F.col("closed"), F.col("pc")).otherwise(F.col("po"))).cast("int")
    rest = rest.withColumn("slot", F.when(F.col("closed"), F.col("po")).otherwise(0) + slot)
    cell = lambda x, y, side: F.struct(x.alias("x"), y.alias("y"), F.lit(side).alias("side"))
    slot = F.col("slot")
    # Part x (never of closed ones) against part y: all pairs of different parts, and open parts with themselves.
    up = F.when(~F.col("closed"), F.transform(F.sequence(slot, F.col("po") + F.col("pc") - 1), lambda y: cell(slot, y, 0)))
    down = F.transform(F.filter(F.sequence(zero, F.col("po")), lambda x: (x < slot) & (x < F.col("po"))), lambda x: cell(x, slot, 1))
    tasks = F.explode(F.concat(F.coalesce(up, F.array().cast("array<struct<x:int,y:int,side:int>>")), down)).alias("t")
    group = F.when(F.col("closed"), F.col("leader")).otherwise(F.col("id")).alias("grp")
    far = meet(rest.select("block", tasks, "id", "n", group).select("block", "t.x", "t.y", "id", "n", "grp", "t.side"))
    out = stored(near.unionByName(star).unionByName(far), "links")
    release(near, star, far, large)
    return out


def with_text_hash(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the ``text_hash`` of ``join`` as column ``name``."""
    return docs.withColumn(name, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def link_groups(docs: DataFrame, size: int = 5) -> tuple[DataFrame, DataFrame]:
    """(all rows (id, text_hash, n, s1, s2), their classes (s1, s2, n, id, node, grp)).

    A class holds the rows with one set of shingles, ``id`` is its smallest id; classes with the same
    ``grp`` are connected by links.  Both tables are stored.
    """
    sets = stored(_sets(docs, size), "sets")
    docs = docs.filter(F.col("id") != NO_ID)
    classes = stored(sets.filter((F.col("n") > 0) & (F.col("id") != NO_ID)).groupBy("s1", "s2")
                     .agg(F.min("id").alias("id"), F.first("n").alias("n")).withColumn("node", F.monotonically_increasing_id()), "classes")
    # A class goes on if it may link.
    least = F.greatest(F.lit(1), F.floor(F.expr(f"15 * floor({PERCENT} * n / 100) / 100")))
    share = _sharing(docs, size)
    # Copies of a set are skipped inside a batch, so any member may carry the count.
    fate = sets.join(share, "id").groupBy("s1", "s2").agg(F.max("shared").alias("shared"))
    chosen = classes.join(fate, ["s1", "s2"]).filter(F.col("shared") >= least).select("id", "node", "s1", "s2")

    def full(batches):
        for b in batches:
            out = ([], [], [])
            for node, s1, s2, text in zip(*(b.column(c).to_pylist() for c in ("node", "s1", "s2")), raw_texts(b.column("text"))):
                s = shingles(text, size)
                if np.frombuffer(_signature(s), np.int64).tolist() == [s1, s2]:   # not another text with the id
                    for column, value in zip(out, (node, len(s), s.tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                                             ["id", "n", "set"])

    texts = (docs.join(chosen, "id").withColumn("h", F.xxhash64("text")).dropDuplicates(["id", "node", "h"])
             .select("node", "s1", "s2", "text"))
    state = stored(arrow_map(texts, full, "id long, n long, set binary"), "shingles")
    bits = frames.fragment_bits(state.agg(F.sum("n")).first()[0] or 0, least=5, target=1 << 20)
    probes = stored(_probes(state, bits), "probes")
    blocks = _blocks(probes)
    of = blocks.unionByName(blocks.select(F.col("root").alias("node"), "root").distinct()).select(F.col("node").alias("id"), F.col("root").alias("block"))
    members = stored(state.select("id", "n").join(of, "id").join(probes.select("id", "shared"), "id"), "members")
    links = _links(members, state)
    moved = roots(links)
    grouped = stored(classes.join(moved, "node", "left").withColumn("grp", F.coalesce("root", "node")).drop("root"), "groups")
    release(classes, state, probes, blocks, members, links, moved)
    return sets, grouped


def join(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text", keep_group: bool = False) -> DataFrame:
    """Per row: id, n_shingles and component_id, the smallest id reachable over links; two documents
    link at a Jaccard similarity of 0.75 or more of their sets of ``size``-word shingles.  With
    ``keep_group`` also text_hash (64 bits of the text) and grp (one value per component).

    Equal sets form one class that is compared once; links between classes are exact.  Null, empty and
    blank texts have no shingle and stand alone; texts of fewer words are one shingle.  A row without id
    links with nothing and has no component.  Rows that repeat an id are documents of their own: the same
    text gives the same result, different texts are linked by their shingles only.  Very long texts
    are compared whole.  An empty table gives an empty one; other columns are ignored.
    """
    sets, classes = link_groups(_keyed(docs, id_col, text_col), size)
    least = classes.groupBy("grp").agg(F.min("id").alias("least"))
    found = classes.select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), "grp").join(least, "grp")
    out = sets.join(found, (F.col("id") != NO_ID) & (F.col("n") > 0) & (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")), "left")
    real = lambda c: F.when(c != NO_ID, c)
    return out.select(real(F.col("id")).alias(id_col), F.col("n").alias("n_shingles"),
                      real(F.coalesce("least", "id")).alias("component_id"), *(["text_hash", "grp"] if keep_group else []))
