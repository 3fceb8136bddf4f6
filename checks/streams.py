"""Streaming queries, drained once into fresh folders and read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.ab import rounded
from checks.bronze import raw_lines
from checks.core import BODIES, SQL_ISO, Views, big, check, iso
from veleta.functions.values import epoch_timestamp
from veleta.session import scratch
from veleta.streaming import ab as live_ab, ingest, metrics, upsert

EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def _landing(v: Views, copies: int = 1, late: bool = False) -> DataFrame:
    """Events landed in three thirds a copy, in time order, a third per micro-batch; ``late`` lands
    the first third once more at the end.  A third is cut by time into as many files as its rows ask for."""
    path = scratch(v.spark, "landing")
    events = v.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    *cut, rows = events.agg(*[F.percentile_approx(F.col("ts").cast("double"), q) for q in (1 / 3, 2 / 3)], F.count(F.lit(1))).first()
    third = F.when(F.col("ts").cast("double") < cut[0], 0).when(F.col("ts").cast("double") < cut[1], 1).otherwise(2)
    # Enough rows a file that no range is empty: a third is always this number of files.
    files = 1 if rows < 3000 else max(2, rows // 3_000_000)
    for k in [0, 1, 2] * copies + [0] * late:
        events.filter(third == k).repartitionByRange(files, "ts", "event_id").write.mode("append").parquet(path)
    return v.spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files).parquet(path)


@check("stream_bronze", """
select id, subreddit, cast(score as bigint) as score, strftime(make_timestamp(cast(created_utc * 1000000 as bigint)), '%Y-%m-%d') as fecha, 'bueno' as estado from posts
union all select cast(null as varchar), cast(null as varchar), cast(length(id) as bigint), cast(null as varchar), 'malo' from posts""")
def stream_bronze(v: Views) -> DataFrame:
    """Landed posts, each followed by a broken line, in three micro-batches of as many files as their rows
    ask for: bronze rows and quarantined lines."""
    root = scratch(v.spark, "live")
    files = 1 + v.table("documents").count() // 100_000
    bad = v.posts().select(F.concat(F.lit("{broken "), "id").alias("value"))
    raw_lines(v).unionByName(bad).repartition(3 * files).write.text(root + "/landing")
    ingest.start_live(v.spark, root + "/landing", root + "/bronze", root + "/quarantine", root + "/cp",
                      seconds=0, files_per_batch=files).awaitTermination()
    good = v.spark.read.parquet(root + "/bronze").select(
        "id", "subreddit", "score", F.col("fecha").cast("string").alias("fecha"),
        F.lit("bueno").alias("estado"))
    null = F.lit(None).cast("string")
    lost = v.spark.read.parquet(root + "/quarantine").select(
        null.alias("id"), null.alias("subreddit"), (F.length("linea") - 8).cast("bigint").alias("score"),
        null.alias("fecha"), F.lit("malo").alias("estado"))
    return good.unionByName(lost)


@check("stream_dedup", f"select event_id, event_type, {SQL_ISO.format('ts')} as hora from events")
def stream_dedup(v: Views) -> DataFrame:
    """Every event lands twice, in different batches; one copy survives."""
    root = scratch(v.spark, "dedup")
    unique = ingest.first_seen(_landing(v, copies=2), "event_id", "ts", "40 days")
    ingest.start_append(unique, root + "/out", root + "/cp", seconds=0).awaitTermination()
    return v.spark.read.parquet(root + "/out").select("event_id", "event_type", iso("ts").alias("hora"))


@check("stream_counts", "select event_type, cast(count(*) as bigint) as n from events group by 1")
def stream_counts(v: Views) -> DataFrame:
    root = scratch(v.spark, "counts")
    result = metrics.running_counts(_landing(v), "event_type")
    metrics.start_snapshot(result, root + "/out", root + "/cp", seconds=0).awaitTermination()
    return metrics.latest(v.spark, root + "/out", "event_type string, n bigint, lote bigint")


@check("stream_hourly", f"""
select {SQL_ISO.format("date_trunc('hour', ts)")} as hora, event_type, cast(count(*) as bigint) as n,
  round(sum(value), 2) as suma, true as media_exacta from events group by 1, 2""")
def stream_hourly(v: Views) -> DataFrame:
    """Four batches; the last one holds only rows behind the watermark, which do not count."""
    root = scratch(v.spark, "hourly")
    result = metrics.hourly_metrics(_landing(v, late=True), "event_type", "value")
    metrics.start_updates(result, root + "/out", root + "/cp", seconds=0).awaitTermination()
    out = metrics.newest_rows(v.spark, root + "/out", "hora timestamp, event_type string, n bigint, "
                              "suma double, media double, lote bigint", ["hora", "event_type"])
    return out.select(iso("hora").alias("hora"), "event_type", "n",
                      F.round("suma", 2).alias("suma"),
                      (F.abs(F.col("media") - F.col("suma") / F.col("n")) < 1e-9).alias("media_exacta"))


@check("batch_metrics", "select event_type, cast(count(*) as bigint) as n from events group by 1")
def batch_metrics(v: Views) -> DataFrame:
    """Per-batch counters, added up over the batches."""
    root = scratch(v.spark, "batches")
    metrics.start_batch_counts(_landing(v), "event_type", root + "/out", root + "/cp", seconds=0) \
        .awaitTermination()
    return v.spark.read.parquet(root + "/out").groupBy("event_type").agg(big(F.sum("n")).alias("n"))


@check("stream_upsert", f"""
select event_id, cast(case when event_id % 7 = 0 then 3 when event_id % 3 = 0 then 2 else 1 end as bigint) as version,
  case when event_id % 7 = 0 then value + 3 when event_id % 3 = 0 then value + 2 else value + 1 end as value,
  cast(1 + cast(event_id % 3 = 0 as int) + cast(event_id % 7 = 0 as int) as bigint) as aceptadas from events""")
def stream_upsert(v: Views) -> DataFrame:
    """Three landings, the last one after a restart: repeats, edits, late older versions and a newest one."""
    root = scratch(v.spark, "upsert")
    events = v.table("events").select("event_id", "event_type", "value")
    files = 1 + events.count() // 3_000_000

    def land(rows: DataFrame) -> None:
        rows.repartition(files, "event_id").write.mode("append").parquet(root + "/in")

    def version(k: int, rows: DataFrame) -> DataFrame:
        return rows.withColumns({"version": F.lit(k).cast("bigint"), "value": F.col("value") + k})

    def drain() -> DataFrame:
        stream = v.spark.readStream.schema("event_id bigint, event_type string, value double, version bigint") \
            .option("maxFilesPerTrigger", files).parquet(root + "/in")
        versions = upsert.newest_versions(stream, "event_id", "version")
        upsert.start_upserts(versions, root + "/out", root + "/cp", seconds=0).awaitTermination()
        return versions

    land(version(1, events))
    land(version(1, events.filter("event_id % 2 = 0")).unionByName(version(2, events.filter("event_id % 3 = 0"))))
    drain()
    land(version(0, events.filter("event_id % 5 = 0")).unionByName(version(3, events.filter("event_id % 7 = 0"))))
    schema = drain().schema.add("lote", "long")
    kept = v.spark.read.schema(schema).parquet(root + "/out").groupBy("event_id").agg(big(F.count(F.lit(1))).alias("aceptadas"))
    now = upsert.current(v.spark, root + "/out", schema, "event_id").select("event_id", "version", "value")
    return now.join(kept, "event_id")


@check("stream_ab_hourly", BODIES["ab_metrics_hourly"])
def stream_ab_hourly(v: Views) -> DataFrame:
    """Three landings of both models' predictions; every third prediction of the second model lands one batch
    after its partner, and the hours it falls into are brought up to date."""
    root = scratch(v.spark, "ab")
    time = epoch_timestamp(F.col("fecha_creacion"))
    a, b = v.pred_a().withColumn("fecha_creacion", time), v.pred_b().withColumn("fecha_creacion", time)
    turn = F.pmod(F.xxhash64("id"), F.lit(2)).cast("int")
    late = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0
    # Posts land in no order of time here: the delay is the time that they span, or hours would close before their posts.
    span = a.select("fecha_creacion").unionByName(b.select("fecha_creacion")).agg(
        F.max(F.unix_seconds("fecha_creacion")) - F.min(F.unix_seconds("fecha_creacion"))).first()[0]
    wait = f"{(span or 0) // 86_400 + 2} days"

    def drain() -> None:
        stream = lambda name, like: v.spark.readStream.schema(like.schema).parquet(f"{root}/{name}")
        pairs = live_ab.paired(stream("a", a), stream("b", b), wait)
        live_ab.start_pairs(pairs, root + "/pairs", root + "/cp1", seconds=0).awaitTermination()
        live_ab.start_hourly(v.spark, root + "/pairs", pairs.schema, root + "/hours", root + "/cp2", wait, seconds=0).awaitTermination()

    for k in range(3):
        a.filter(turn == k).write.mode("append").parquet(root + "/a")
        b.filter(turn + late.cast("int") == k).write.mode("append").parquet(root + "/b")
        drain()
    return rounded(live_ab.hourly(v.spark, root + "/hours")).withColumn("hora", iso("hora"))
