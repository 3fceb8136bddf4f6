"""Language by naive Bayes over letter triples, fitted from labelled texts.

Texts are folded by native expressions; tasks then count and score the triples of whole batches in numpy.
The counts are one aggregation over all texts.  A model is a small table (languages x buckets) of whole
numbers, so scores are exact sums; it travels with the scoring function.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veleta.functions.once import bind

BUCKETS = 8192
MAX_LANGUAGES = 64         # 64 x 8192 numbers: about 4 MB in a task
FACTORS = (1, 127, 16129)  # how the code points of a triple make a bucket
SLICE = 1 << 20            # bytes of text that a task turns into arrays at a time


def letters(text: Column) -> Column:
    """Lower-cased words between single blanks, nothing but letters; blanks at both ends."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _finder(buckets: int):
    """A function from an array of ``letters`` to (bucket of every three characters in a row of all texts, one
    after the other; how many each text has).  It holds all it needs, so workers do not import this package."""
    def find(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
        found = points[:-2] * FACTORS[0] + points[1:-1] * FACTORS[1] + points[2:] * FACTORS[2]
        # Every text has at least its two blanks: no triple begins at its last two characters.
        inner = np.ones(len(points), bool)
        ends = np.cumsum(lengths)
        inner[ends - 1] = inner[ends - 2] = False
        return found[inner[:-2]] % buckets, lengths - 2

    return find


def _cutter():
    """A function that cuts an array of texts into parts of about ``SLICE`` bytes, one text at least."""
    def cut(texts: pa.Array):
        total, begin = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while begin < len(texts):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + SLICE, "right")))
            yield texts.slice(begin, end - begin)
            begin = end

    return cut


@dataclass(frozen=True)
class LanguageModel:
    """Per language 1000 ln P(bucket | language), floored, for every bucket."""

    weights: dict[str, list[int]]

    def scores(self, text: Column) -> Column:
        """Array of structs (peso, idioma), one a language in alphabetical order; null without letters."""
        names = sorted(self.weights)
        tables = [np.array(self.weights[x], np.int64) for x in names]
        find, cut = _finder(len(tables[0])), _cutter()

        @F.arrow_udf("array<bigint>")
        def sums(texts: pa.Array) -> pa.Array:
            parts = []
            for part in cut(texts):
                found, n = find(part)
                some = n > 0
                out = np.zeros((len(n), len(tables)), np.int64)
                if some.any():
                    begin = (np.cumsum(n) - n)[some]
                    for k, table in enumerate(tables):
                        out[some, k] = np.add.reduceat(table[found], begin)
                offsets = pa.array(np.arange(len(n) + 1) * len(tables), pa.int32())
                parts.append(pa.ListArray.from_arrays(offsets, pa.array(out.ravel()), mask=pa.array(~some)))
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

        return F.transform(sums(letters(text)), lambda w, i: F.struct(
            w.alias("peso"), F.get(F.array(*map(F.lit, names)), i).alias("idioma")))

    def language(self, text: Column, unknown: str = "und") -> Column:
        """The likeliest language, ties to the first in the alphabet; ``unknown`` without letters."""
        if not self.weights:
            return F.lit(unknown)

        def best(scores: Column) -> Column:
            top = F.array_max(F.transform(scores, lambda s: s["peso"]))
            first = F.get(F.filter(scores, lambda s: s["peso"] == top), F.lit(0))
            return F.coalesce(first["idioma"], F.lit(unknown))

        return bind(self.scores(text), best)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(lang, b, w) for lang, ws in sorted(self.weights.items()) for b, w in enumerate(ws)]
        spark.createDataFrame(rows, "idioma string, cubeta int, peso int").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> LanguageModel:
    found: dict[str, dict[int, int]] = {}
    for r in spark.read.parquet(path).collect():
        found.setdefault(r["idioma"], {})[r["cubeta"]] = r["peso"]
    return LanguageModel({lang: [ws[b] for b in range(len(ws))] for lang, ws in found.items()})


def fit(texts: DataFrame, text: str = "texto", lang: str = "idioma", buckets: int = BUCKETS) -> LanguageModel:
    """A model of all rows with a language; more than ``MAX_LANGUAGES`` languages are an error.

    Triples are counted where the texts are, so at most one row per task, language and bucket is
    shuffled and one per language and bucket reaches the driver.
    """
    rows = texts.filter(F.col(lang).isNotNull())
    names = [r[0] for r in rows.select(lang).distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    places, find, cut = {name: k for k, name in enumerate(names)}, _finder(buckets), _cutter()

    def count(batches):
        total = np.zeros(len(places) * buckets, np.int64)
        for batch in batches:
            owner, begin = np.array([places[x] for x in batch.column(0).to_pylist()], np.int64), 0
            for part in cut(batch.column(1)):
                found, n = find(part)
                total += np.bincount(np.repeat(owner[begin:begin + len(part)], n) * buckets + found, minlength=len(total))
                begin += len(part)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own // buckets, pa.int32()), pa.array(own % buckets, pa.int32()),
                                          pa.array(total[own])], ["l", "b", "n"])

    counts = rows.select(F.col(lang), letters(F.col(text)).alias("t")).mapInArrow(count, "l int, b int, n bigint") \
        .groupBy("l", "b").agg(F.sum("n").alias("n"))
    table = {name: [0] * buckets for name in names}
    for r in counts.collect():
        table[names[r["l"]]][r["b"]] = r["n"]
    return LanguageModel({name: [math.floor(1000 * math.log((n + 1) / (sum(ns) + buckets))) for n in ns]
                          for name, ns in table.items()})
