from collections import Counter

from pyspark.sql import functions as F

from checks import streams
from checks.core import Views
from veleta.operators.dedup import latest_by_key
from veleta.streaming import upsert


def test_a_third_lands_in_several_files_and_one_batch(spark, folder):
    landed = streams._landing(Views(spark, "/root/testdata/sf0.01"), late=True)
    query = (landed.withColumn("file", F.input_file_name()).writeStream.foreachBatch(
        lambda df, k: df.select("file", "ts", F.lit(k).alias("batch")).write.mode("append").parquet(folder + "/out"))
        .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    rows = spark.read.parquet(folder + "/out").groupBy("batch", "file").agg(F.min("ts").alias("a"), F.max("ts").alias("z")).collect()
    files = Counter(r.batch for r in rows)
    assert len(files) == 4 and min(files.values()) > 1 and len(set(files.values())) == 1
    first = [min(r.a for r in rows if r.batch == k) for k in range(4)]
    last = [max(r.z for r in rows if r.batch == k) for k in range(4)]
    assert last[0] <= first[1] and last[1] <= first[2] and (first[3], last[3]) == (first[0], last[0])


def test_upsert_ties_nulls_and_restart(spark, folder):
    """Ties by content as in the batch rule, a null order loses, a restart keeps what was seen."""
    rows = [[(1, "b", 1.0), (1, "a", 1.0), (2, "x", None), (3, "p", 5.0)],
            [(1, "b", 1.0), (1, "a", 1.0), (2, "y", 0.5), (3, "old", 4.0)], [(3, "p", 5.0), (3, "q", 6.0), (4, "n", None)]]
    schema = "k long, t string, o double"
    counts = []
    for batch in rows:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder + "/in")
        stream = spark.readStream.schema(schema).parquet(folder + "/in")
        versions = upsert.newest_versions(stream, "k", "o")
        upsert.start_upserts(versions, folder + "/out", folder + "/cp", seconds=0).awaitTermination()
        counts.append(spark.read.parquet(folder + "/out").count())
    every = spark.createDataFrame(sum(rows, []), schema)
    want = sorted(map(tuple, latest_by_key(every, "k", "o").collect()))
    got = upsert.current(spark, folder + "/out", versions.schema.add("lote", "long"), "k").select("k", "t", "o")
    assert sorted(map(tuple, got.collect())) == want and counts == [3, 4, 6]


def test_upserts_stay_native(spark, folder):
    """No Python for a key: the plan has none, and the newest of many versions of a key wins in one batch."""
    rows = spark.range(20_000).selectExpr("id % 10000 as k", "id as o", "cast(id as string) as t")
    rows.repartition(3).write.parquet(folder + "/in")
    versions = upsert.newest_versions(spark.readStream.schema(rows.schema).parquet(folder + "/in"), "k", "o")
    assert "Python" not in versions._jdf.queryExecution().analyzed().toString()
    assert "InPandas" not in versions._jdf.queryExecution().analyzed().toString()
    upsert.start_upserts(versions, folder + "/out", folder + "/cp", seconds=0).awaitTermination()
    got = spark.read.parquet(folder + "/out")
    assert got.columns[:3] == ["k", "o", "t"] and got.count() == 10_000 and got.filter("o != k + 10000").count() == 0


def test_live_hours_count_posts_of_any_time(spark, folder):
    """Posts centuries apart land in no order of time; none of them is late."""
    from checks import ab
    ids = [1, 2, 3, 4, 5, 6, 7, 8] + [900_000 + k for k in range(8)]
    docs = spark.createDataFrame([(k, "a text. more", "en", "s", 12) for k in ids], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(folder + "/pages.parquet")
    v = Views(spark, folder)
    assert sorted(map(tuple, streams.stream_ab_hourly(v).collect())) == sorted(map(tuple, ab.ab_metrics_hourly(v).collect()))
