"""Weak labels, confidence, neutral mining, class balance and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from veleta.functions import probs as P
from veleta.functions.once import add_once
from veleta.operators.ranks import quantiles, running_sum
from veleta.schemas import MIN_TEXT_LENGTH


def weak_labels(df: DataFrame, stars: tuple[str, ...] = ("p1", "p2", "p3", "p4", "p5")) -> DataFrame:
    """Five star probabilities to a label, its id and three class probabilities."""
    p = [F.col(c) for c in stars]
    label = P.star_label(*p)
    return add_once(df, sentimiento_label=label, p_neg=p[0] + p[1], p_neu=p[2],
                    p_pos=p[3] + p[4]) \
        .withColumn("label", P.label_id(F.col("sentimiento_label"))).drop(*stars)


def with_confidence(df: DataFrame) -> DataFrame:
    """Add the largest class probability and whether the own class reaches its threshold."""
    three = [F.col("p_neg"), F.col("p_neu"), F.col("p_pos")]
    return add_once(df, confianza=F.greatest(*three),
                    alta_confianza=P.confident(F.col("sentimiento_label"), *three))


def _picked(candidates: DataFrame, order: list[Column], missing: Column, target: int) -> DataFrame:
    """The ``missing`` best candidates; at most ``target`` rows ever reach the ranking window."""
    best = candidates.orderBy(*order).limit(target)
    return best.withColumn("_rn", F.row_number().over(Window.orderBy(*order))) \
        .filter(F.col("_rn") <= missing).drop("_rn")


def _missing_neutrals(high: DataFrame, target: int) -> Column:
    have = high.agg(F.count_if(F.col("sentimiento_label") == "neu")).scalar()
    return F.lit(target) - have


def mine_neutrals(df: DataFrame, target: int = P.NEUTRAL_TARGET) -> DataFrame:
    """High-confidence rows plus, while neutrals are fewer than ``target``, the best
    low-confidence neutrals by (p_neu, margin).  Adds ``minado``."""
    rated = with_confidence(df)
    high, low = rated.filter("alta_confianza"), rated.filter("not alta_confianza")
    margin = P.neutral_margin(F.col("p_neg"), F.col("p_neu"), F.col("p_pos"))
    order = [F.desc("p_neu"), margin.desc(), F.col("id")]
    mined = _picked(low.filter("sentimiento_label = 'neu'"), order,
                    _missing_neutrals(high, target), target)
    return high.withColumn("minado", F.lit(False)) \
        .unionByName(mined.withColumn("minado", F.lit(True)))


def relax_neutrals(df: DataFrame, chosen: DataFrame, target: int = P.NEUTRAL_TARGET,
                   floor: float = P.RELAXED_FLOOR) -> DataFrame:
    """Neutrals not chosen yet with p_neu >= ``floor``, best first, up to ``target`` in all.

    The stepwise lowering of the threshold always takes the highest p_neu that is left, so
    one ranked pass down to the last step gives the same rows.
    """
    free = df.filter((F.col("sentimiento_label") == "neu") & (F.col("p_neu") >= floor)) \
        .join(chosen.select("id"), "id", "left_anti")
    return _picked(free, [F.desc("p_neu"), F.col("id")], _missing_neutrals(chosen, target), target)


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Share per class, three digits; the window only sees one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return counts.withColumn("proporcion",
                             F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 3))


def binary_fallback(df: DataFrame, least: int = 2) -> DataFrame:
    """With three classes of which one has fewer than ``least`` rows, keep neg and pos only;
    with fewer than two classes fail."""
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    facts = counts.agg(F.struct(F.count(F.lit(1)).alias("k"), F.min("n").alias("m")).alias("f")) \
        .scalar()
    k, smallest = facts.getField("k"), facts.getField("m")
    keep = F.when(k < 2, F.raise_error(F.lit("fewer than two classes")).cast("boolean")) \
        .when((k == 3) & (smallest < least), F.col("label").isin(0, 2)).otherwise(True)
    return df.filter(keep)


def length_window(df: DataFrame, length: str = "longitud_texto", low: int = MIN_TEXT_LENGTH,
                  q: float = 0.999) -> DataFrame:
    """Rows with ``low`` <= length <= exact q-quantile."""
    high = quantiles(df, [length], [q]).agg(F.max("valor")).scalar()
    return df.filter((F.col(length) >= low) & (F.col(length) <= high))


def hash_split(df: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """train / val / test in 80/10/10 by a seeded digest of the key.

    Row-local, no shuffle; every class gets the same proportions in expectation.
    """
    digest = F.substring(F.md5(F.concat(F.col(key), F.lit(f":{seed}"))), 1, 8)
    u = F.conv(digest, 16, 10).cast("double") / F.lit(4294967296.0)
    return df.withColumn("particion", F.when(u < 0.8, "train").when(u < 0.9, "val")
                         .otherwise("test"))


def ranked_split(df: DataFrame, key: str = "id", label: str | None = "label",
                 seed: int = 42) -> DataFrame:
    """The same proportions exact to one row per class (``label=None``: over all rows).

    Positions come from the distributed running count, so a class that owns most rows is
    still spread over many tasks.
    """
    keys = [label] if label else []
    order = df.withColumn("_d", F.md5(F.concat(F.col(key), F.lit(f":{seed}")))) \
        .withColumn("_one", F.lit(1))
    placed = running_sum(order, keys, ["_d", key], "_one", out="_before")
    pos = F.col("_before") + 1
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    if label:
        # One row per class.
        sized = placed.join(F.broadcast(sizes.withColumnRenamed(label, "_label")),
                            F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")
    else:
        sized = placed.withColumn("_total", sizes.scalar())
    cut = lambda share: F.round(F.col("_total") * F.lit(share))
    return sized.withColumn(
        "particion", F.when(pos <= cut(0.8), "train").when(pos <= cut(0.9), "val")
        .otherwise("test")).drop("_d", "_one", "_before", "_before_n", "_total")


def class_weights(df: DataFrame, label: str = "label", floor: float = 1e-6) -> DataFrame:
    """Inverse class frequency scaled to mean 1, keyed by label.  One row per class."""
    everything = Window.partitionBy()
    counts = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    inverse = F.lit(1.0) / F.greatest(F.col("n") / F.sum("n").over(everything), F.lit(floor))
    return counts.withColumn("_inv", inverse).withColumn(
        "peso", F.col("_inv") * F.count(F.lit(1)).over(everything) / F.sum("_inv").over(everything)
    ).drop("_inv")


def weight_of(weights: DataFrame, label: Column) -> Column:
    """Weight of a label as an expression; labels without a weight get 1.0.

    Class weights are one row per class, so reading them to the driver is metadata.
    """
    out = F.lit(1.0)
    for row in weights.select("label", "peso").collect():
        out = F.when(label == row["label"], F.lit(float(row["peso"]))).otherwise(out)
    return out
