"""Data profiling and exploratory tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from veleta.functions.values import equal_width_bin
from veleta.operators.ranks import quantiles_at, value_positions


def group_counts(df: DataFrame, group: str, key: str = "id", out: str = "total_posts") -> DataFrame:
    """Rows with a non-null key per group."""
    return df.groupBy(group).agg(F.count(key).cast("bigint").alias(out))


def distribution(counts: DataFrame, count: str, out: str, digits: int = 1,
                 scale: float = 100.0) -> DataFrame:
    """Share of the total; the global window only sees already grouped rows."""
    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn(out, F.round(F.col(count) * F.lit(scale) / total, digits))


def top_groups(df: DataFrame, group: str, limit: int = 10) -> DataFrame:
    return (df.filter(F.col(group).isNotNull()).groupBy(group)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .orderBy(F.desc("n"), group).limit(limit))


def date_range(df: DataFrame, epoch: str) -> DataFrame:
    return df.agg(F.timestamp_seconds(F.min(epoch)).alias("desde"),
                  F.timestamp_seconds(F.max(epoch)).alias("hasta"))


def _per_column(df: DataFrame, aggs, build) -> DataFrame:
    """One pass over the table, then one output row per column."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[a for c in df.columns for a in aggs(c)])
    cells = F.array(*[build(c) for c in df.columns])
    return one.select(F.explode(cells).alias("x")).select("x.*")


def null_profile(df: DataFrame, limit: int | None = 10) -> DataFrame:
    """Null share per column, largest first."""
    out = _per_column(
        df,
        lambda c: [F.count(c).alias(f"n_{c}")],
        lambda c: F.struct(F.lit(c).alias("columna"), _null_share(c).alias("fraccion_nulos")))
    return out.orderBy(F.desc("fraccion_nulos"), "columna").limit(limit) if limit else out


def _null_share(c: str) -> Column:
    rows = F.nullif(F.col("_rows"), F.lit(0))
    return (F.col("_rows") - F.col(f"n_{c}")).cast("double") / rows


def variable_dictionary(df: DataFrame, key: str = "id") -> DataFrame:
    """Type, null percentage and first non-null value (by key) of every column."""
    types = dict(df.dtypes)
    return _per_column(
        df,
        lambda c: [F.count(c).alias(f"n_{c}"),
                   F.min_by(F.col(c).cast("string"), F.when(F.col(c).isNotNull(), F.col(key)))
                   .alias(f"e_{c}")],
        lambda c: F.struct(F.lit(c).alias("columna"), F.lit(types[c]).alias("dtype"),
                           (_null_share(c) * 100).alias("pct_nulos"),
                           F.coalesce(F.col(f"e_{c}"), F.lit("")).alias("ejemplo")))


def text_report(df: DataFrame, text: str) -> DataFrame:
    """Row count, column count and mean text length."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("filas"),
                  F.lit(len(df.columns)).cast("bigint").alias("columnas"),
                  F.avg(F.length(text)).alias("longitud_media"))


def numeric_describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per column.

    Everything is read off the ordered value counts: the input is scanned once, and the
    deviation is summed around the mean.
    """
    at = value_positions(df, columns)
    size = at.groupBy("columna").agg(F.sum("n").alias("_n"),
                                     (F.sum(F.col("valor") * F.col("n")) / F.sum("n")).alias("_mean"))
    # One row per column.
    around = at.join(F.broadcast(size), "columna")
    base = around.groupBy("columna").agg(
        F.max("_n").cast("bigint").alias("count"), F.max("_mean").alias("mean"),
        F.sqrt(F.try_divide(F.sum(F.pow(F.col("valor") - F.col("_mean"), 2) * F.col("n")),
                            (F.max("_n") - 1).cast("double"))).alias("std"),
        F.min("valor").alias("min"), F.max("valor").alias("max"))
    q = quantiles_at(at, [0.25, 0.5, 0.75]).groupBy("columna").agg(
        *[F.max(F.when(F.col("q") == p, F.col("valor"))).alias(n)
          for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return base.join(q, "columna", "left")


def histogram(df: DataFrame, columns: list[str], bins: int, log10: bool = False) -> DataFrame:
    """Equal-width counts over each column's own range: (columna, bin, desde, hasta, n, media).

    Ranges come from a one-row scalar subquery; empty bins are included.
    """
    def shown(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(x > 0, F.log10(x)) if log10 else x

    data = df.select(*[shown(c).alias(c) for c in columns])
    edges = data.agg(F.struct(
        *[F.min(c).alias(f"lo_{c}") for c in columns],
        *[F.max(c).alias(f"hi_{c}") for c in columns]).alias("r")).scalar()
    binned = data.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).alias("x"),
                 edges.getField(f"lo_{c}").alias("lo"), edges.getField(f"hi_{c}").alias("hi"))
        for c in columns])).alias("s")).select("s.*").filter("x is not null")
    counts = binned.groupBy(
        "columna", "lo", "hi", equal_width_bin(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("suma"))
    # From here on at most bins rows per column.
    full = counts.groupBy("columna", "lo", "hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"),
        (F.sum("suma") / F.sum("n")).alias("media"))
    width = (F.col("hi") - F.col("lo")) / bins
    return full.select(
        "columna", "lo", "hi", "media", "m",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin")
    ).select("columna", "bin", (F.col("lo") + width * F.col("bin")).alias("desde"),
             (F.col("lo") + width * (F.col("bin") + 1)).alias("hasta"),
             F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).cast("bigint").alias("n"),
             "media")


def posts_per_month(df: DataFrame, ts: str) -> DataFrame:
    """Posts per calendar month, months without posts included as 0.

    The gap filling works on the monthly counts, one row per month with data.
    """
    monthly = (df.filter(F.col(ts).isNotNull())
               .groupBy(F.to_date(F.date_trunc("month", ts)).alias("desde"))
               .agg(F.count(F.lit(1)).alias("n")))
    nxt = F.lead("desde").over(Window.orderBy("desde"))
    last = F.coalesce(F.add_months(nxt, -1), F.col("desde"))
    return monthly.withColumn("hasta", last).select(
        "desde", "n", F.explode(F.expr("sequence(desde, hasta, interval 1 month)")).alias("mes")
    ).select("mes", F.when(F.col("mes") == F.col("desde"), F.col("n")).otherwise(0)
             .cast("bigint").alias("n"))


def rolling_mean(monthly: DataFrame, months: int = 3) -> DataFrame:
    """Mean over the current and the previous months, shorter at the start."""
    w = Window.orderBy("mes").rowsBetween(1 - months, 0)
    return monthly.withColumn("media_movil", F.avg("n").over(w))


def token_stats(df: DataFrame, key: str, n_tokens: Column, sample: int = 20000,
                max_length: int = 256, seed: int = 42, keys: DataFrame | None = None) -> DataFrame:
    """Token-length figures of a deterministic sample of at most ``sample`` rows.

    The sample is the feature here: the rows with the smallest seeded digests; rows without key
    have none and come last.  Rows are counted by the first digits of their digest; digests behind
    the one where the sample is full are left out in the map tasks, and only the sample is tokenised.
    ``keys`` are the keys of ``df`` from a table that is cheaper to read, so that its texts are computed once.
    """
    digest = F.md5(F.concat(F.col(key), F.lit(f"|{seed}")))
    rows, start = df.withColumn("_d", digest), F.substring("_d", 1, 4)
    all_keys = (df if keys is None else keys).select(digest.alias("_d"))
    counts = all_keys.filter("_d is not null").groupBy(start.alias("start")).agg(F.count(F.lit(1)).alias("n"))
    upto = counts.select("start", F.sum("n").over(Window.orderBy("start")).alias("upto"))
    full = upto.filter(F.col("upto") >= sample).agg(F.min("start")).first()[0]
    if full is not None:
        rows = rows.filter(start <= full)
    picked = rows.orderBy(F.asc_nulls_last("_d")).limit(sample).select(n_tokens.cast("double").alias("n"))
    p = lambda q: F.floor(F.percentile("n", F.lit(q))).cast("bigint")
    return picked.agg(
        F.count(F.lit(1)).cast("bigint").alias("muestra"), F.avg("n").alias("mean_tokens"),
        p(0.50).alias("p50"), p(0.90).alias("p90"), p(0.95).alias("p95"), p(0.99).alias("p99"),
        F.max("n").cast("bigint").alias("max"),
        F.avg((F.col("n") > max_length).cast("double")).alias("trunc_rate"))


def target_report(df: DataFrame, group: str, targets) -> DataFrame:
    """Which wanted communities occur: (subreddit, encontrado)."""
    wanted = sorted({t.lower() for t in targets})
    present = df.agg(*[F.coalesce(F.bool_or(F.lower(group) == t), F.lit(False)).alias(t)
                       for t in wanted])
    return present.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("subreddit"), F.col(f"`{t}`").alias("encontrado"))
        for t in wanted])).alias("x")).select("x.*")
