"""Comparison of two prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veleta.operators.profile import histogram

KEYS = ["id", "fecha_creacion", "subreddit_nombre"]


def ab_join(pred_a: DataFrame, pred_b: DataFrame) -> DataFrame:
    """Inner join on the three keys; columns of both sides get ``_a`` / ``_b`` (title once)."""
    shared = [c for c in pred_a.columns if c not in KEYS and c != "titulo"]
    left = pred_a.withColumnsRenamed({c: f"{c}_a" for c in shared})
    right = pred_b.withColumnsRenamed({c: f"{c}_b" for c in pred_b.columns if c not in KEYS})
    return left.join(right, KEYS, "inner")


def _sums() -> list:
    return [
        F.count(F.lit(1)).alias("total_registros"),
        F.count_if(F.col("prediccion_a") == 1).alias("predicciones_a_positivas"),
        F.count_if(F.col("prediccion_b") == 1).alias("predicciones_b_positivas"),
        F.count_if(F.col("prediccion_a") == F.col("prediccion_b")).alias("concordancia_ab"),
        F.sum("probabilidad_a").alias("_sa"), F.sum("probabilidad_b").alias("_sb"),
        F.count("probabilidad_a").alias("_na"), F.count("probabilidad_b").alias("_nb"),
        F.sum(F.col("probabilidad_b") - F.col("probabilidad_a")).alias("_sd"),
        F.count(F.col("probabilidad_b") - F.col("probabilidad_a")).alias("_nd"),
    ]


_COUNTS = ["total_registros", "predicciones_a_positivas", "predicciones_b_positivas",
           "concordancia_ab"]


def _finish(df: DataFrame, *first) -> DataFrame:
    div = lambda s, n: F.try_divide(F.col(s), F.col(n).cast("double"))
    return df.select(*first, *[F.col(c).cast("bigint").alias(c) for c in _COUNTS],
                     div("_sd", "_nd").alias("diferencia_prob_media"),
                     div("_sa", "_na").alias("prob_a_media"),
                     div("_sb", "_nb").alias("prob_b_media"))


def ab_metrics(joined: DataFrame) -> DataFrame:
    """Global and per-community metrics, ``ventana`` = 'global' or the community.

    One pass over the rows; the global row is rolled up from the per-community sums, so the
    grouping sets only expand already aggregated rows.
    """
    per = joined.groupBy("subreddit_nombre").agg(*_sums())
    sums = [F.sum(c).alias(c) for c in per.columns if c != "subreddit_nombre"]
    rolled = per.rollup("subreddit_nombre").agg(F.grouping("subreddit_nombre").alias("_g"), *sums)
    ventana = F.when(F.col("_g") == 1, "global").otherwise(F.col("subreddit_nombre"))
    return _finish(rolled, ventana.alias("ventana"))


def ab_metrics_hourly(joined: DataFrame, ts: str = "fecha_creacion") -> DataFrame:
    """The same metrics per hour of the post's time."""
    hour = F.window(ts, "1 hour").start.alias("hora")
    return _finish(joined.groupBy(hour).agg(*_sums()), "hora")


def ab_agreement(joined: DataFrame) -> DataFrame:
    same = (F.col("prediccion_a") == F.col("prediccion_b")).cast("double")
    return joined.groupBy("subreddit_nombre").agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        (F.avg(same) * 100).alias("porcentaje_concordancia"))


def probability_histograms(joined: DataFrame, bins: int = 20) -> DataFrame:
    """20-bin histograms of both probabilities and of their difference, with the mean."""
    data = joined.select("probabilidad_a", "probabilidad_b",
                         (F.col("probabilidad_b") - F.col("probabilidad_a")).alias("diferencia"))
    return histogram(data, ["probabilidad_a", "probabilidad_b", "diferencia"], bins)
