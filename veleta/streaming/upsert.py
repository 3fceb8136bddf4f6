"""Newest version wins, in the stream: a later version of a post replaces the one that was seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from veleta.operators.dedup import content_hash
from veleta.schemas import MICROBATCH_SECONDS
from veleta.streaming.ingest import trigger_for

ORDER, PRINT = "_orden", "_huella"
NOW, SPAN, BEST = "_ahora", "_tramo", "_mejor"


def newest_versions(stream: DataFrame, key: str, order: str, ttl_hours: int = 24 * 30) -> DataFrame:
    """The rows of ``stream`` that are newer than any version of their key before, at most one per key and
    batch, with their order and print; repeats and late older versions give nothing.

    The rules are those of ``latest_by_key``: the highest ``order``, nulls last, ties by content.  A native
    aggregation keeps the newest version of a key and the time of the batch that brought it first; a key has a new
    version when that is the time of this batch.  State lives in spans of two ``ttl_hours`` that begin every
    ``ttl_hours``, and the older of the two open spans decides: a version is known for at least ``ttl_hours``
    after it was seen and dropped within twice that; a version that comes again after that is emitted again,
    which ``current`` does not mind.
    """
    rank = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    rows = stream.withColumns({ORDER: rank, PRINT: content_hash(stream), NOW: F.current_timestamp()}) \
        .withWatermark(NOW, "1 hour")
    rest = [c for c in rows.columns if c not in (key, NOW)]
    span = F.window(NOW, f"{2 * ttl_hours} hours", f"{ttl_hours} hours")
    # ~print and -time: the smallest print wins a tie, and the first batch keeps a version that comes again.
    rule = F.struct(F.col(ORDER), F.bitwise_not(PRINT), -F.unix_micros(NOW))
    found = rows.groupBy(span.alias(SPAN), key).agg(
        F.max_by(F.struct(*rest, F.col(NOW).alias(NOW)), rule).alias(BEST))
    older = F.col(f"{SPAN}.end") <= F.current_timestamp() + F.expr(f"interval {ttl_hours} hours")
    return found.filter(older & (F.col(f"{BEST}.{NOW}") == F.current_timestamp())) \
        .select(*[F.col(key) if c == key else F.col(f"{BEST}.{c}").alias(c) for c in [*stream.columns, ORDER, PRINT]])


#: Expired state gives no rows, so no batch is run for it alone (a drained query would never end); state lies on disk
#: in bounded memory, since it holds a row a key, and a batch stores its changes alone.
_ROCKS = "spark.sql.streaming.stateStore.rocksdb."
SETTINGS = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _ROCKS + "changelogCheckpointing.enabled": "true", _ROCKS + "boundedMemoryUsage": "true",
}


def start_upserts(versions: DataFrame, out: str, checkpoint: str, seconds: int = MICROBATCH_SECONDS) -> StreamingQuery:
    """Write the accepted versions, one folder per batch; a batch that is retried overwrites its own."""
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/lote={number:012d}")

    conf = versions.sparkSession.conf
    before = {k: conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        conf.set(k, v)   # a query keeps the settings it was started with
    try:
        return versions.writeStream.outputMode("update").foreachBatch(save) \
            .option("checkpointLocation", checkpoint).trigger(**trigger_for(seconds)).start()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def current(spark: SparkSession, out: str, schema, key: str) -> DataFrame:
    """The newest accepted version of every key; ``schema`` is that of the versions."""
    rows = spark.read.schema(schema).parquet(out)
    best: Column = F.max_by(F.struct(*[c for c in rows.columns if c not in (key, "lote")]), F.struct(F.col(ORDER), -F.col(PRINT)))
    return rows.groupBy(key).agg(best.alias("r")).select(key, "r.*").drop(ORDER, PRINT)
