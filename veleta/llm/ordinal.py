"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document is its set of hashed words and a few measures of its surface.  One weight vector gives a
score; ordered thresholds cut the score into grades, P(grade <= k) = sigmoid(threshold_k - score).
The expected grade and the tail probability P(grade >= k) select documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from veleta.llm.common import U64, arrow_map, raw_texts, word_hashes
from veleta.llm.decontaminate import _FOLD

BITS = 18
SURFACE = 14
_UPPER = bytes(range(65, 91))
_ALNUM = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
_SPACES = b" \t\n\r\x0b\x0c"
_RUN = re.compile(rb"([!-/:-@\[-`{-~])\1")


def surface(text: bytes, words: list[bytes], distinct: int) -> list[float]:
    """Measures between 0 and 1 (or so) of how a text looks, whatever its words mean."""
    n = max(1, len(text))
    tokens = text.split()
    count = max(1, len(tokens))
    upper = n - len(text.translate(None, _UPPER))
    letters = n - len(text.translate(None, _ALNUM))
    marks = len(text.translate(None, _ALNUM + _SPACES))
    digits = n - len(text.translate(None, b"0123456789"))
    lines = text.split(b"\n")
    alone = sum(1 for t in tokens if len(t) == 1 and not t.isalnum())
    doubled = len(_RUN.findall(text))
    repeated = sum(1 for a, b in zip(words, words[1:]) if a == b)
    short = min(1.0, len(words) / 40)
    return [1.0, upper / max(1, letters), marks / n * 4, digits / n * 4, alone / count, doubled / count,
            1 - distinct / max(1, len(words)), repeated / count, 1 - len(set(lines)) / len(lines),
            min(3.0, letters / count / 5), short, float(not words), min(1.0, len(lines) / count * 4),
            min(3.0, np.log1p(len(words)) / 3)]


def features(text: bytes) -> tuple[np.ndarray, list[float]]:
    """(slots of the distinct words, surface measures)."""
    words = text.translate(_FOLD).split()
    own = set(words)
    slots = np.unique(word_hashes(list(own)) >> U64(64 - BITS)).astype(np.int32)
    return slots, surface(text, words, len(own))


@dataclass
class Model:
    """Weights of word slots and surface measures, ascending thresholds."""

    words: np.ndarray
    measures: np.ndarray
    thresholds: np.ndarray

    def scores(self, rows: list[tuple[np.ndarray, list[float]]]) -> np.ndarray:
        dense = np.array([m for _, m in rows]).reshape(-1, SURFACE) @ self.measures
        return dense + np.array([self.words[s].sum() for s, _ in rows])

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def train(rows: list[tuple[np.ndarray, list[float]]], grades: np.ndarray, levels: int, epochs: int = 200,
          rate: float = 0.05, penalty: float = 2e-3, least: int = 4) -> Model:
    """Fit by full-batch Adam on the likelihood; words of fewer than ``least`` rows get no weight.

    Starts from zero, so equal rows give an equal model."""
    lens = np.array([len(s) for s, _ in rows], int)
    slots = np.concatenate([s for s, _ in rows]) if len(rows) else np.empty(0, np.int32)
    often = np.bincount(slots, minlength=1 << BITS) >= least
    used = np.flatnonzero(often)
    dense_of = np.full(1 << BITS, -1)
    dense_of[used] = np.arange(len(used))
    row = np.repeat(np.arange(len(rows)), lens)[often[slots]]
    col = dense_of[slots[often[slots]]]
    x = np.array([m for _, m in rows], float).reshape(-1, SURFACE)
    y = np.asarray(grades)
    share = np.bincount(y, minlength=levels) / max(1, len(y))
    balance = (1 / np.maximum(share, 1e-9) ** 0.5)[y]
    balance = balance / max(1e-9, balance.mean() if len(y) else 1.0)
    # Parameters: words, measures, first threshold, log gaps.
    p = np.zeros(len(used) + SURFACE + levels - 1)
    below = np.clip(np.cumsum(share)[:-1], 0.01, 0.99)
    start = np.log(below / (1 - below))
    p[len(used) + SURFACE] = start[0]
    p[len(used) + SURFACE + 1:] = np.log(np.maximum(np.diff(start), 0.1))
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def cuts(p):
        t = p[len(used) + SURFACE:]
        return np.cumsum(np.r_[t[0], np.exp(t[1:])])

    for step in range(1, epochs + 1 if len(rows) else 1):
        w, d = p[:len(used)], p[len(used):len(used) + SURFACE]
        score = np.bincount(row, w[col], minlength=len(rows)) + x @ d
        edge = np.r_[-np.inf, cuts(p), np.inf]
        hi, lo = sigmoid(edge[y + 1] - score), sigmoid(edge[y] - score)
        like = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / like * balance, lo * (1 - lo) / like * balance
        g_score = (dhi - dlo) / len(rows)                    # of the negative log likelihood
        g_cut = np.zeros(levels + 1)
        np.add.at(g_cut, y + 1, -dhi / len(rows))
        np.add.at(g_cut, y, dlo / len(rows))
        tail = np.cumsum(g_cut[1:-1][::-1])[::-1]            # a gap moves all later thresholds
        g_t = tail.copy()
        g_t[1:] *= np.exp(p[len(used) + SURFACE + 1:])
        g = np.r_[np.bincount(col, g_score[row], minlength=len(used)) + penalty * w, x.T @ g_score + penalty * d, g_t]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    words = np.zeros(1 << BITS)
    words[used] = p[:len(used)]
    return Model(words, p[len(used):len(used) + SURFACE], cuts(p))


def grade_of(quality: Column, toxic: Column) -> Column:
    """Graded rating: 0 toxic, 1 of low quality, 2 good; null where a label is missing."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)


def fit(docs: DataFrame, ratings: DataFrame, levels: int = 3, sample: int = 20_000, id_col: str = "doc_id",
        text_col: str = "text", grade_col: str = "grade") -> Model:
    """A model from documents joined with ``ratings(id, grade)``, grades 0 to ``levels`` - 1.

    At most ``sample`` rated documents are used, those of smallest hashed id; that bounds the join,
    which is broadcast, and the hashed features that are collected.  Ratings outside the levels or
    null are ignored, of several ratings of an id the lowest counts; without any rating every document
    scores the same.  Null and empty texts are documents without words, very long ones are read whole.
    """
    rated = (ratings.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{grade_col}`").cast("int").alias("grade"))
             .filter(F.col("id").isNotNull() & F.col("grade").between(0, levels - 1)).groupBy("id").agg(F.min("grade").alias("grade")))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 32))
    total = rated.count()
    # Thinned before the sort, so that no task sees more than about the sample.
    few = rated.filter(place < F.lit((1 << 32) * min(1.0, 1.2 * sample / max(1, total)))).orderBy(place, "id").limit(sample)
    chosen = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
              .join(F.broadcast(few), "id").select("id", "grade", "text"))
    kind = chosen.schema["id"].dataType.simpleString()

    def hashed(batches):
        for b in batches:
            rows = [features(t) for t in raw_texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("grade"), pa.array([s for s, _ in rows], pa.list_(pa.int32())),
                 pa.array([m for _, m in rows], pa.list_(pa.float64()))], ["id", "grade", "slots", "measures"])

    got = arrow_map(chosen, hashed, f"id {kind}, grade int, slots array<int>, measures array<double>").toArrow()
    rows = sorted(zip(got["id"].to_pylist(), got["grade"].to_pylist(),
                      (x.values.to_numpy() for x in got["slots"]), got["measures"].to_pylist()), key=lambda r: r[:2])
    return train([r[2:] for r in rows], np.array([r[1] for r in rows], int), levels)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          least: float = 0.5) -> DataFrame:
    """Per row: the columns of ``docs``' id, expected_grade, p_ge_1 ... p_ge_K and keep (the tail
    probability of the highest grade is ``least`` or more).

    Row by row.  Null and empty texts are texts without words and are scored as such; repeated rows
    are scored once each; an empty table gives an empty one; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)    # 2 ** BITS weights
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = [f"p_ge_{k + 1}" for k in range(len(model.thresholds))]

    def run(batches):
        for b in batches:
            tails = held.value.tails(held.value.scores([features(t) for t in raw_texts(b.column("text"))]))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(tails.sum(1)), *(pa.array(np.ascontiguousarray(t)) for t in tails.T)],
                ["id", "expected_grade", *names])

    out = arrow_map(rows, run, f"id {kind}, expected_grade double, " + ", ".join(f"{n} double" for n in names))
    return out.select(F.col("id").alias(id_col), "expected_grade", *names, (F.col(names[-1]) >= least).alias("keep"))


def select(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose highest grade is likely enough."""
    names = docs.columns
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = names.index(text_col)

    def run(batches):
        for b in batches:
            tails = held.value.tails(held.value.scores([features(t) for t in raw_texts(b.column(place))]))
            yield b.filter(pa.array(tails[:, -1] >= least))

    return arrow_map(docs, run, docs.schema)
