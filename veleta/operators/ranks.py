"""Exact ranks, running sums and quantiles without a single-task window.

Rows are range-partitioned on (keys, order), so every task holds one contiguous slice of the
global order even if a single key owns most rows.  Inside a slice a window gives the local
running sum; across slices only one carry row per slice boundary is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from veleta.session import durable


# Two doubles per value: about 16 MB of data.
BROADCAST_VALUES = 1_000_000


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str,
                out: str = "antes") -> DataFrame:
    """Add ``out`` = sum of ``value`` over the rows of the same keys strictly earlier in
    ``order`` (0 for the first), and ``out_n`` = the number of those rows.

    ``order`` must be unique inside a key.  The range layout is materialised once: its
    boundaries come from sampling and would differ if a lost task were recomputed.  The
    broadcast carries have at most one row per slice boundary.
    """
    laid = durable(df.repartitionByRange(*keys, *order)
                   .withColumn("_slice", F.spark_partition_id()))
    slice_keys = ["_slice", *keys]
    local = (Window.partitionBy(*slice_keys).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, -1))
    previous = (Window.partitionBy(*keys).orderBy("_slice")
                .rowsBetween(Window.unboundedPreceding, -1))
    carries = (
        laid.groupBy(*slice_keys)
        .agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_carry", F.sum("_s").over(previous))
        .withColumn("_carry_n", F.sum("_n").over(previous))
        .filter(F.col("_carry_n").isNotNull())
        .select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(slice_keys)],
                "_carry", "_carry_n"))
    match = reduce(lambda a, b: a & b,
                   [F.col(k).eqNullSafe(F.col(f"_c{i}")) for i, k in enumerate(slice_keys)])
    return (
        laid.withColumn("_local", F.sum(value).over(local))
        .withColumn("_local_n", F.count(F.lit(1)).over(local))
        .join(F.broadcast(carries), match, "left")
        .withColumn(out, F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0)))
        .withColumn(out + "_n", F.coalesce("_local_n", F.lit(0)) + F.coalesce("_carry_n", F.lit(0)))
        .drop("_slice", "_local", "_local_n", "_carry", "_carry_n",
              *[f"_c{i}" for i in range(len(slice_keys))])
    )


def value_positions(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columna, valor, n, antes): how often each value occurs and how many are smaller.

    Values are counted before they are ordered, so a value shared by a third of all rows
    is a single row here.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if len(columns) == 1:
        long = long.select(F.lit(columns[0]).alias("columna"), F.col(columns[0]).alias("valor"))
    else:
        long = long.unpivot([], columns, "columna", "valor")
    counts = (long.filter(F.col("valor").isNotNull()).groupBy("columna", "valor")
              .agg(F.count(F.lit(1)).alias("n")))
    return running_sum(counts, ["columna"], ["valor"], "n").drop("antes_n")


def quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: (columna, q, valor)."""
    return quantiles_at(value_positions(df, columns), probs)


def quantiles_at(at: DataFrame, probs: list[float]) -> DataFrame:
    """The quantiles of already ordered value counts."""
    sizes = at.groupBy("columna").agg(F.sum("n").alias("total"))
    q = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("q")
    wanted = sizes.select(F.col("columna").alias("_col"), "total", q).select(
        "_col", "q", (F.col("q") * (F.col("total") - 1)).alias("pos"))
    lo, hi = F.floor("pos"), F.ceil("pos")
    end = F.col("antes") + F.col("n")
    inside = lambda p: (F.col("antes") <= p) & (p < end)
    # One row per requested column and quantile: a fixed, tiny build side.
    hits = at.join(F.broadcast(wanted), (F.col("columna") == F.col("_col"))
                   & (inside(lo) | inside(hi)))
    return hits.groupBy("columna", "q").agg(
        F.max(F.when(inside(lo), F.col("valor"))).alias("bajo"),
        F.max(F.when(inside(hi), F.col("valor"))).alias("alto"),
        F.max(F.col("pos") - lo).alias("resto"),
    ).select("columna", "q",
             (F.col("bajo") + F.col("resto") * (F.col("alto") - F.col("bajo"))).alias("valor"))


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rank correlation of every pair, ties get average ranks: (variable_a, variable_b, rho).

    Ranks belong to distinct values; rows look theirs up by value.  The stored value counts
    tell how many there are: up to ``BROADCAST_VALUES`` the lookup is broadcast, beyond that
    both sides are shuffled and the adaptive planner splits hot values.
    """
    at = value_positions(df, columns)
    sizes = {r[0]: r[1] for r in at.groupBy("columna").count().collect()}
    rank = F.col("antes") + (F.col("n") + 1) / 2
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    for c in columns:
        table = at.filter(F.col("columna") == c).select(F.col("valor").alias(f"_v_{c}"),
                                                        rank.alias(f"_r_{c}"))
        if sizes.get(c, 0) <= BROADCAST_VALUES:
            table = F.broadcast(table)
        rows = rows.join(table, F.col(c) == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = rows.agg(*[F.corr(f"_r_{a}", f"_r_{b}").alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("variable_a"), F.lit(b).alias("variable_b"),
                      (F.lit(1.0) if a == b else
                       F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`")).alias("rho"))
             for a in columns for b in columns]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")
