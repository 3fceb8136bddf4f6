"""Importance resampling towards a target distribution, with n-gram buckets from prefix checksums.

A text is folded and its words are joined by single spaces.  That string is read once and the CRC-32 of
every prefix that ends with a word is kept.  CRC-32 is linear over GF(2): the checksum of ``AB`` is the
checksum of ``A`` shifted by ``len(B)`` zero bytes, xor the checksum of ``B``.  So the checksum of any
run of words comes from two prefixes, by cancelling the shifted one, and no n-gram is ever built.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from veleta.llm.common import arrow_map, raw_texts, stored

# A-Z folded; every other byte below 0x80 that is no letter or digit separates words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
PIECE = re.compile(rb" ?[^ ]+")
NEAR = 64          # shifts below this many bytes have a table of their own
SPACE = np.uint32(zlib.crc32(b" "))


def _apply(op: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as the images of the 256 values of each byte."""
    return op[0][c & 255] ^ op[1][c >> 8 & 255] ^ op[2][c >> 16 & 255] ^ op[3][c >> 24]


@lru_cache(maxsize=1)
def shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps that shift a checksum by 0 to 63 zero bytes, and by 64, 128, 256 … (up to 2^36) of them."""
    one = np.empty((4, 256), np.uint32)
    for byte in range(4):
        for v in range(256):
            c = v << 8 * byte
            for _ in range(8):
                c = c >> 1 ^ 0xEDB88320 if c & 1 else c >> 1
            one[byte, v] = c
    near = [np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)], np.uint32)]
    while len(near) < NEAR:
        near.append(np.array([_apply(one, row) for row in near[-1]]))
    far = [np.array([_apply(one, row) for row in near[-1]])]
    while len(far) < 31:
        far.append(np.array([_apply(far[-1], row) for row in far[-1]]))
    return np.array(near), far


def shifted(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums ``c`` (uint32) shifted by ``n`` zero bytes each."""
    near, far = shift_tables()
    low = n & NEAR - 1
    c = near[low, 0, c & 255] ^ near[low, 1, c >> 8 & 255] ^ near[low, 2, c >> 16 & 255] ^ near[low, 3, c >> 24]
    high, k = n // NEAR, 0
    while (high >> k).any():
        own = np.flatnonzero(high >> k & 1)
        c[own] = _apply(far[k], c[own])
        k += 1
    return c


def prefixes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(checksum, length) of the prefixes of the normalised text that end with a word."""
    pieces = PIECE.findall(b" ".join(text.translate(FOLD).split()))
    crc = zlib.crc32
    running = accumulate(pieces, lambda c, piece: crc(piece, c), initial=0)
    next(running)
    return (np.fromiter(running, np.uint32, len(pieces)),
            np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))))


def ngram_checksums(crc: np.ndarray, end: np.ndarray, first: np.ndarray, least: int, most: int):
    """(checksum, place of the last word) of every run of ``least`` to ``most`` words that stays inside a
    document.  ``crc`` and ``end`` are the prefixes of documents one after the other, ``first`` the
    place of the first word of the document that owns each prefix."""
    place = np.arange(len(crc))
    # What stands before a word: the empty prefix of its document, or the prefix before it and a space.
    before = np.zeros(len(crc), np.uint32)
    start = np.zeros(len(crc), np.int64)
    inner = np.flatnonzero(place > first)
    before[inner] = shifted(crc[inner - 1], np.ones(len(inner), np.int64)) ^ SPACE
    start[inner] = end[inner - 1] + 1
    for n in range(least, most + 1):
        last = np.flatnonzero(place - first >= n - 1)
        head = last - (n - 1)
        yield crc[last] ^ shifted(before[head], end[last] - start[head]), last


def _checksums(texts: list[bytes], least: int, most: int):
    """(words of every text, [(checksums, owning text)] for every length of run)."""
    found = [prefixes(t) for t in texts]
    count = np.array([len(c) for c, _ in found], np.int64)
    if not count.sum():
        return count, []
    owner = np.repeat(np.arange(len(texts)), count)
    first = np.repeat(np.cumsum(count) - count, count)
    crc, end = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    return count, [(c, owner[last]) for c, last in ngram_checksums(crc, end, first, least, most)]


def bucket_counts(texts: DataFrame, least: int, most: int, buckets: int) -> np.ndarray:
    """How many features of all texts of ``texts(text)`` fall into each bucket.

    A task adds its own counts up, so at most ``buckets`` rows a task are shuffled; the driver gets
    one row a bucket.
    """
    def count(batches):
        sums = np.zeros(buckets, np.int64)
        for b in batches:
            for crc, _ in _checksums(raw_texts(b.column("text")), least, most)[1]:
                sums += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(sums[own])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in arrow_map(texts, count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r[0]] = r[1]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share in the target over that in the source, per bucket."""
    s, t, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((b + 1) * (s + k) / ((a + 1) * (t + k))))
                     for a, b in zip(source.tolist(), target.tolist())], np.int64)


def _gumbel(seed: int, doc: str) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(docs: DataFrame, gain: np.ndarray, least: int, most: int, seed: int) -> DataFrame:
    """(id, n_words, n_features, weight, score) of ``docs(id, text)``, row by row; ``gain`` is 8 bytes a bucket."""
    kind = docs.schema["id"].dataType.simpleString()
    buckets = np.uint32(len(gain))

    def run(batches):
        for b in batches:
            words, runs = _checksums(raw_texts(b.column("text")), least, most)
            n, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            for crc, owner in runs:
                n += np.bincount(owner, minlength=len(n))
                # Gains are small integers: these sums of doubles are exact.
                total += np.bincount(owner, gain[crc % buckets], len(n)).astype(np.int64)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            noise = [_gumbel(seed, "" if i is None else str(i)) for i in b.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(words), pa.array(n), pa.array(weight), pa.array(weight + np.array(noise, np.int64))],
                ["id", "n_words", "n_features", "weight", "score"])

    return arrow_map(docs, run, f"id {kind}, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, least: int = 1, most: int = 1, buckets: int = 10000,
             seed: int = 2024, percent: int = 10, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """Draw documents whose hashed n-grams look like those of ``target``, without replacement.

    Per row: id, n_features, weight (floored mean gain of its features, 0 without any), score (weight plus
    Gumbel noise that only ``seed`` and the id decide) and rank (1, 2, 3 … of the drawn rows in falling
    score, smaller id first; null for the others).  ``percent`` of the rows with ``min_words`` words are drawn.

    Scores are integers in a range that the logarithms bound (about 100,000 values), so ranks need no sort
    of the table: the counts per score give the rows ahead of each, and only rows of equal score are
    numbered among themselves.  Null and empty texts have no features, weight 0 and are not drawn.  A row
    without id takes the noise of an empty id and comes after the others of its score; repeated rows count
    and are drawn one by one; very long texts are read whole.  An empty table gives an empty one, an
    empty target favours nothing but rare buckets.  Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    source = bucket_counts(rows.select("text"), least, most, buckets)
    wanted = bucket_counts(target.select(F.col(f"`{target_text}`").alias("text")), least, most, buckets)
    scored = stored(weights(rows, gains(source, wanted), least, most, seed), "scores")
    entitled = F.col("n_words") >= min_words
    # One row a score; the window below sees these rows only.
    tally = scored.filter(entitled).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    total = tally.agg(F.sum("n")).first()[0] or 0
    draw = total * percent // 100
    ahead = (tally.withColumn("ahead", F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)))
             .select(F.col("score").alias("s"), F.coalesce("ahead", F.lit(0)).alias("ahead")).filter(F.col("ahead") < draw))
    lowest = ahead.agg(F.min("s")).first()[0]
    chosen = entitled & (F.col("score") >= lowest) if lowest is not None else F.lit(False)
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.asc_nulls_last("id")))
    rank = (F.col("ahead") + place).cast("long")
    drawn = (scored.filter(chosen).join(F.broadcast(ahead), F.col("score") == F.col("s"))
             .withColumn("rank", F.when(rank <= draw, rank)))
    rest = scored.filter(~chosen).withColumn("rank", F.lit(None).cast("long"))
    out = ["id", "n_features", "weight", "score", "rank"]
    return drawn.select(*out).unionByName(rest.select(*out)).withColumnRenamed("id", id_col)
