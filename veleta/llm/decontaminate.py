"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are windows of ``window`` consecutive benchmark words (a shorter item is one window).
All windows of one length form a matcher: a table of word blocks says how far the search may jump
from the block it looks at; a block that ends a test string selects the bucket of strings with that
suffix, and the words themselves are compared to confirm an occurrence.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veleta.llm.common import arrow_map, octets, raw_texts, release, stored

# Every byte that no word contains becomes a blank; A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def fold_words(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of digits, ASCII letters and all characters beyond ASCII."""
    return text.translate(_FOLD).split()


class Matcher:
    """Wu-Manber tables for test strings of one length, in words."""

    def __init__(self, strings: Iterable[tuple[bytes, ...]], block: int = 3):
        strings = set(strings)
        self.length = len(next(iter(strings)))
        self.block = min(block, self.length)
        self.jump = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], set[tuple[bytes, ...]]] = {}
        for s in strings:
            for end in range(self.block, self.length + 1):
                key, far = s[end - self.block:end], self.length - end
                if far < self.shift.get(key, self.jump):
                    self.shift[key] = far
            self.buckets.setdefault(s[-self.block:], set()).add(s)

    def scan(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, test string) of every occurrence, overlapping ones included."""
        length, block, jump, far, end = self.length, self.block, self.jump, self.shift.get, self.length
        while end <= len(words):
            key = tuple(words[end - block:end])
            step = far(key, jump)
            if step:
                end += step
                continue
            found = tuple(words[end - length:end])
            if found in self.buckets[key]:
                yield end - length, found
            end += 1


class Searcher:
    """Matchers for all window lengths of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = fold_words(text)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                self.owners.setdefault(tuple(words[i:i + size]), set()).update(
                    [] if item is None else [item])
        by_length: dict[int, list] = {}
        for s in self.owners:
            by_length.setdefault(len(s), []).append(s)
        self.matchers = [Matcher(x) for x in by_length.values()]

    def search(self, words: list[bytes]) -> tuple[set[int], set[str]]:
        """(positions of words inside occurrences, items that occur)."""
        hit: set[int] = set()
        items: set[str] = set()
        for m in self.matchers:
            for start, s in m.scan(words):
                hit.update(range(start, start + m.length))
                items |= self.owners[s]
        return hit, items


def _between(done: DataFrame, last: DataFrame | None, blocks: int) -> DataFrame:
    """With several blocks each is searched in a job of its own, so a task holds one at a time."""
    if blocks == 1:
        return done
    done = stored(done, "hits")
    if last is not None:
        release(last)
    return done


def _count(benchmark: DataFrame, item_text: str, block_bytes: int) -> int:
    body = benchmark.select(F.col(f"`{item_text}`").alias("body")).filter("body is not null")
    return max(1, -(-octets(body, "body") // block_bytes))


def _blocks(benchmark: DataFrame, item_col: str, item_text: str, blocks: int) -> Iterator:
    """The benchmark as broadcasts of (item, text) lists, each of about ``block_bytes`` at most."""
    bench = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                             F.col(f"`{item_text}`").cast("binary").alias("body")).filter("body is not null")
    for k in range(blocks):
        part = bench.filter(F.pmod(F.xxhash64("body"), F.lit(blocks)) == k) if blocks > 1 else bench
        found = benchmark.sparkSession.sparkContext.broadcast([(r[0], bytes(r[1])) for r in part.collect()])
        yield found
        if blocks > 1:   # its job is done
            found.destroy()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  block_bytes: int = 16 << 20) -> DataFrame:
    """Per document: id, n_words, n_hit, items (sorted ids of the benchmark items with a window in
    it), n_items, items_sha256 and contaminated.

    The benchmark is measured first and searched for in blocks of at most about ``block_bytes``
    of its text, one job after the other, so what is broadcast and held at once is bounded however
    large it grows; each block passes over all documents, and every word of every document is searched.

    Null or empty texts have no words and are never hit; a benchmark row without text has no
    window; one without id still marks words but is not listed.  Repeated documents give repeated
    rows, repeated items count once per id.  An empty benchmark hits nothing.  Other columns are
    ignored.
    """
    blocks, last = _count(benchmark, item_text, block_bytes), None
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.lit(0).cast("long").alias("n_words"),
                       F.array().cast("array<int>").alias("hit"),
                       F.array().cast("array<string>").alias("items"))
    id_type = rows.schema["id"].dataType.simpleString()
    for found in _blocks(benchmark, item_col, item_text, blocks):
        def search(batches, found=found):
            searcher = Searcher(found.value, window)
            for b in batches:
                n, hits, items = [], [], []
                for text, h, i in zip(raw_texts(b.column("text")), b.column("hit").to_pylist(),
                                      b.column("items").to_pylist()):
                    words = fold_words(text)
                    new, owners = searcher.search(words)
                    n.append(len(words))
                    hits.append(sorted(new | set(h)) if new else h)
                    items.append(sorted(owners | set(i)) if owners else i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("text"), pa.array(n, pa.int64()),
                     pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                    ["id", "text", "n_words", "hit", "items"])

        rows = last = _between(arrow_map(rows, search, f"id {id_type}, text string, n_words long, hit array<int>, items array<string>"),
                               last, blocks)
    return rows.select(
        F.col("id").alias(id_col), "n_words", F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items",
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark window occurs."""
    place, schema = docs.columns.index(text_col), docs.schema
    blocks, last = _count(benchmark, item_text, block_bytes), None
    for found in _blocks(benchmark, item_col, item_text, blocks):
        def clean(batches, found=found):
            searcher = Searcher(found.value, window)
            for b in batches:
                yield b.filter(pa.array([not searcher.search(fold_words(t))[0] for t in raw_texts(b.column(place))],
                                        pa.bool_()))

        docs = last = _between(arrow_map(docs, clean, schema), last, blocks)
    return docs
