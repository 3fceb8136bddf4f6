"""Streaming counters and windowed metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from veleta.schemas import MICROBATCH_SECONDS
from veleta.streaming.ingest import trigger_for


def running_counts(stream: DataFrame, group: str) -> DataFrame:
    """Rows per group since the start; state is one counter per group."""
    return stream.groupBy(group).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def hourly_metrics(stream: DataFrame, group: str, value: str, ts: str = "ts",
                   delay: str = "1 hour") -> DataFrame:
    """Count, sum and mean per hour and group; hours close ``delay`` after their last event."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("w"), group).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.sum(value).alias("suma"),
        F.avg(value).alias("media")).select(F.col("w.start").alias("hora"), group, "n", "suma",
                                            "media")


def start_snapshot(result: DataFrame, out: str, checkpoint: str,
                   seconds: int = MICROBATCH_SECONDS) -> StreamingQuery:
    """Keep the full aggregate as a table, one folder per batch; ``latest`` reads the last.

    A batch that is retried overwrites its own folder, so the table is exact after failures.
    """
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/lote={number:012d}")

    return result.writeStream.outputMode("complete").foreachBatch(save) \
        .option("checkpointLocation", checkpoint).trigger(**trigger_for(seconds)).start()


def latest(spark, out: str, schema) -> DataFrame:
    """Rows of the newest batch of a snapshot table."""
    table = spark.read.schema(schema).parquet(out)
    newest = table.agg(F.max("lote")).scalar()
    return table.filter(F.col("lote") == newest).drop("lote")


def start_updates(result: DataFrame, out: str, checkpoint: str,
                  seconds: int = MICROBATCH_SECONDS) -> StreamingQuery:
    """Append the rows that a batch changed, one folder per batch; ``newest_rows`` reads the table.

    State is dropped behind the watermark, late rows are left out, and a batch that is retried
    overwrites its own folder.
    """
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/lote={number:012d}")

    return result.writeStream.outputMode("update").foreachBatch(save) \
        .option("checkpointLocation", checkpoint).trigger(**trigger_for(seconds)).start()


def newest_rows(spark, out: str, schema, keys: list[str]) -> DataFrame:
    """The last written row of every key of an update table."""
    table = spark.read.schema(schema).parquet(out)
    rest = [c for c in table.columns if c not in keys and c != "lote"]
    return table.groupBy(*keys).agg(F.max_by(F.struct(*rest), "lote").alias("r")).select(*keys, "r.*")


def start_batch_counts(stream: DataFrame, group: str, out: str, checkpoint: str,
                       seconds: int = MICROBATCH_SECONDS) -> StreamingQuery:
    """Per-batch counters per group: (lote, group, n), one overwritable folder per batch."""
    def save(batch: DataFrame, number: int) -> None:
        batch.groupBy(group).agg(F.count(F.lit(1)).cast("bigint").alias("n")) \
            .write.mode("overwrite").parquet(f"{out}/lote={number:012d}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint) \
        .trigger(**trigger_for(seconds)).start()
