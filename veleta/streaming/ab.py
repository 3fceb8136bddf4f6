"""Live comparison of two models: predictions meet in a stream–stream join, hours are kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from veleta.operators import ab
from veleta.schemas import MICROBATCH_SECONDS
from veleta.streaming import metrics
from veleta.streaming.ingest import start_append

HOURLY = ("hora timestamp, total_registros bigint, predicciones_a_positivas bigint, predicciones_b_positivas bigint, "
          "concordancia_ab bigint, diferencia_prob_media double, prob_a_media double, prob_b_media double, lote bigint")


def paired(pred_a: DataFrame, pred_b: DataFrame, delay: str = "1 day", bound: str = "1 hour") -> DataFrame:
    """Both predictions of a post side by side, as ``ab.ab_join`` has them, for streams.

    ``fecha_creacion`` is a timestamp.  A prediction waits for its partner until the watermark of both streams,
    ``delay`` behind the older one's newest row, has passed it by ``bound``; then its state is dropped.
    """
    shared = [c for c in pred_a.columns if c not in ab.KEYS and c != "titulo"]
    left = pred_a.withColumnsRenamed({c: f"{c}_a" for c in shared}).withWatermark("fecha_creacion", delay)
    right = pred_b.select(F.col("id").alias("_id"), F.col("subreddit_nombre").alias("_sub"), F.col("fecha_creacion").alias("_ts"),
                          *[F.col(c).alias(f"{c}_b") for c in pred_b.columns if c not in ab.KEYS]).withWatermark("_ts", delay)
    near = F.expr(f"_ts between fecha_creacion - interval {bound} and fecha_creacion + interval {bound}")
    same = (F.col("id") == F.col("_id")) & (F.col("subreddit_nombre") == F.col("_sub")) & (F.col("fecha_creacion") == F.col("_ts"))
    return left.join(right, same & near, "inner").drop("_id", "_sub", "_ts")


def start_pairs(pairs: DataFrame, out: str, checkpoint: str, seconds: int = MICROBATCH_SECONDS) -> StreamingQuery:
    """Pairs as they are found, each once; the table is the source of ``start_hourly``."""
    return start_append(pairs, out, checkpoint, seconds)


def start_hourly(spark: SparkSession, pairs: str, schema, out: str, checkpoint: str, delay: str = "1 day",
                 seconds: int = MICROBATCH_SECONDS) -> StreamingQuery:
    """Metrics of every hour that new pairs fall into, rewritten as late partners arrive."""
    stream = spark.readStream.schema(schema).parquet(pairs).withWatermark("fecha_creacion", delay)
    return metrics.start_updates(ab.ab_metrics_hourly(stream), out, checkpoint, seconds)


def hourly(spark: SparkSession, out: str) -> DataFrame:
    """The newest metrics of every hour."""
    return metrics.newest_rows(spark, out, HOURLY, ["hora"])
