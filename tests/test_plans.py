"""Stages end to end on files, models and streams."""

from pyspark.sql import functions as F

from checks.bronze import json_lines, raw_lines
from checks.core import Views
from veleta.operators import models as M
from veleta.plans import gold, graph, incremental, ingest, prep, silver
from veleta.sources.bronze import read_bronze
from veleta.streaming import ingest as live
from veleta.streaming.ingest import start_live, trigger_for

SF = "/root/testdata/sf0.001"


def test_live_to_reports(spark, folder):
    v = Views(spark, SF)
    raw_lines(v).unionByName(spark.createDataFrame([("broken",)], "value string")) \
        .write.text(folder + "/landing")
    ingest.run_live(spark, folder + "/landing", folder + "/bronze", folder + "/bad", folder + "/cp", 0)
    n = v.table("documents").count()
    assert spark.read.parquet(folder + "/bad").count() == 1
    silver.run(spark, folder + "/bronze", folder + "/silver")
    s = spark.read.parquet(folder + "/silver")
    assert s.count() == n and {"titulo_limpio", "raw_payload", "extras", "fecha_creacion"} <= set(s.columns)
    with open(folder + "/c.csv", "w") as f:
        f.write("concepto,sinonimo\narticulo,the\narticulo,LA\n")
    gold.run_features(spark, folder + "/silver", [folder + "/c.csv"], folder + "/fa", folder + "/fb")
    labels = v.labelled().select("id", F.col("quality").alias("label"))
    gold.run_predict_a(spark, folder + "/fa", folder + "/ma", folder + "/pa", labels)
    gold.run_predict_b(spark, folder + "/fb", folder + "/mb", folder + "/pb", labels)
    gold.run_predict_a(spark, folder + "/fa", folder + "/ma", folder + "/pa2")  # stored model
    a, a2 = (spark.read.parquet(folder + p).drop("ts_prediccion") for p in ("/pa", "/pa2"))
    assert a.exceptAll(a2).count() == 0
    gold.run_compare(spark, folder + "/pa", folder + "/pb", folder + "/report")
    metrics = {r.ventana: r for r in spark.read.parquet(folder + "/report.parquet").collect()}
    assert metrics["global"].total_registros == n
    graph.run_generate(spark, folder + "/silver", folder + "/triples", folder + "/nt")
    graph.run_questions(spark, folder + "/triples", folder + "/cq")
    graph.run_semantic_features(spark, folder + "/triples", folder + "/sem")
    graph.run_quality(spark, folder + "/triples", folder + "/quality")
    assert spark.read.parquet(folder + "/sem").count() == n
    assert spark.read.parquet(folder + "/cq/cq3_post_types.parquet").agg(F.sum("n")).first()[0] == n
    prep.run(spark, folder + "/silver", v.star_probs(), folder + "/prep")
    parts = [spark.read.parquet(f"{folder}/prep/{p}") for p in ("train", "val", "test")]
    ids = [r.id for p in parts for r in p.select("id").collect()]
    assert len(ids) == len(set(ids)) > 0
    assert parts[0].columns[:4] == ["id", "subreddit_nombre", "fecha_creacion_utc", "texto_model"]
    assert spark.read.json(folder + "/prep/class_weights").count() >= 2
    silver.run_report(spark, folder + "/silver", folder + "/rep")
    per = spark.read.parquet(folder + "/rep_comunidades.parquet")
    assert per.agg(F.sum("total_registros_limpios")).first()[0] == n
    assert all(spark.read.parquet(f"{folder}/rep_{x}.parquet").count() > 0 for x in ("fechas", "nulos", "diccionario"))
    assert all(spark.read.parquet(f"{folder}/report_{x}.parquet").count() > 0 for x in ("concordancia", "histogramas"))
    labelled, doubtful = (spark.read.parquet(f"{folder}/prep/{x}") for x in ("silver_sentimiento", "silver_revision"))
    assert 0 < doubtful.count() < labelled.count() and doubtful.agg(F.min("confianza")).first()[0] > 0
    prep.run_train(spark, folder + "/prep", folder + "/ms")
    prep.run_score(spark, folder + "/silver", folder + "/ms", folder + "/scored")
    prep.run_evaluate(spark, folder + "/prep", folder + "/ms", folder + "/eval")
    assert spark.read.parquet(folder + "/scored").select("id").distinct().count() == n
    rows = {r.clase: r.support for r in spark.read.parquet(folder + "/eval_clases.parquet").collect()}
    assert rows["accuracy"] == parts[2].count() == spark.read.parquet(folder + "/eval_confusion.parquet").agg(F.sum("n")).first()[0]
    assert 0 <= spark.read.parquet(folder + "/eval_macro.parquet").first()["f1_macro"] <= 1


def test_trigger():
    assert trigger_for(60) == {"processingTime": "60 seconds"} and trigger_for(0) == {"availableNow": True}


def separable(spark, n=400):
    return spark.range(n).select(
        F.concat(F.lit("d"), "id").alias("id"), (F.col("id") % 4 == 0).cast("int").alias("label"),
        *[(F.col("id") * (i + 3) % 17 + (F.col("id") % 4 == 0).cast("int") * (9 if i == 0 else 0)).cast("double").alias(f"f{i}")
          for i in range(3)])


def test_balanced_models(spark):
    df = separable(spark)
    for train in (M.train_a, M.train_b):
        model = train(df, ["f0", "f1", "f2"])
        out = M.predict(model, df, "m", keep=("id",)).join(df.select("id", "label"), "id")
        right = out.filter("prediccion = label").count() / out.count()
        recall = out.filter("prediccion = 1 and label = 1").count() / 100
        assert right > .7 and recall > .7
        again = M.predict(train(df, ["f0", "f1", "f2"]), df, "m", keep=("id",)).join(out, ["id", "prediccion"])
        assert again.count() == out.count()


def test_text_classifier(spark):
    words = {0: "malo terrible horrible", 1: "normal mesa silla", 2: "bueno excelente genial"}
    rows = [(f"d{i}", words[i % 3] + f" post {i % 7}", i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "id string, texto_model string, label int")
    model, score = M.train_sentiment(df.filter("id < 'd7'"), df.filter("id >= 'd7'"), features=1 << 10)
    assert score > .95
    out = M.score_sentiment(model, df)
    assert out.filter("prediccion = label").count() == 150 and len(out.first().probs) == 3


def test_text_classifier_cuts_every_text_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    rows = [(f"{'malo' if i % 2 else 'bueno'} post {i % 7}", i % 2) for i in range(90)]
    df = spark.createDataFrame(rows, "t string, label int").select(read("t").alias("texto_model"), "label")
    M.train_sentiment(df, df, features=1 << 10, max_iter=3)
    assert seen.value == 2 * 90


def test_external_model(spark):
    def load():
        return lambda texts: [[float(len(t)), 0.0, 1.0] for t in texts]

    df = spark.createDataFrame([("a", "xyz"), ("b", None)], "id string, texto_model string")
    got = {r.id: r.probs for r in M.score_with(df, load, batch=1).collect()}
    assert got == {"a": [3.0, 0.0, 1.0], "b": [0.0, 0.0, 1.0]}


def test_incremental_silver_equals_the_full_run(spark, folder):
    """Two posts change: only their buckets are rewritten; ties and older crawls end as in the full run."""
    posts = Views(spark, SF).posts()
    edited = posts.filter("id in ('d3', 'd4')").withColumn("title", F.lit("edited"))
    tied = posts.filter("id = 'd5'").withColumn("title", F.lit("same time, another text"))

    def land(k, rows, epoch):
        json_lines(rows).coalesce(1).write.text(f"{folder}/in/{k}")
        start_live(spark, folder + "/in", folder + "/bronze", folder + "/bad", folder + "/cp", seconds=0,
                   ingest_epoch=F.lit(float(epoch))).awaitTermination()
        return incremental.update(spark, folder + "/bronze", folder + "/silver", buckets=32)

    assert len(land(0, posts, 1000)) > 16
    before = incremental.manifest(spark, folder + "/silver").count()
    assert len(land(1, edited, 2000)) <= 2
    assert incremental.update(spark, folder + "/bronze", folder + "/silver", buckets=32) == []
    assert len(land(2, tied.unionByName(posts.filter("id = 'd3'")), 1000)) <= 2
    assert incremental.vacuum(spark, folder + "/silver") >= 2 and incremental.vacuum(spark, folder + "/silver") == 0
    now = incremental.manifest(spark, folder + "/silver")
    assert now.count() == before and now.select("version").distinct().count() == 1
    full = silver.silver(read_bronze(spark, folder + "/bronze").drop("lote", "mes"))
    columns = [c for c in full.columns if full.schema[c].dataType.typeName() in ("string", "long", "double", "boolean")]
    got = incremental.read_silver(spark, folder + "/silver").select(columns)
    assert got.count() == posts.count() and got.exceptAll(full.select(columns)).isEmpty()
    assert {r[0] for r in got.filter("id in ('d3', 'd4')").select("titulo").collect()} == {"edited"}


def test_a_parsed_batch_waits_on_disk(spark, folder, monkeypatch):
    """Both sinks read lines parsed once, and no memory of the executors is held between them."""
    seen = []
    write = live.write_bronze

    def spy(df, *rest):
        write(df, *rest)
        seen.extend((x.memSize(), x.diskSize()) for x in spark.sparkContext._jsc.sc().getRDDStorageInfo())

    monkeypatch.setattr(live, "write_bronze", spy)
    good = spark.range(300).selectExpr("to_json(struct('p' || id as id, repeat('word ', 200) as selftext, id as created_utc)) as value")
    bad = spark.createDataFrame([("{broken 1",), ("[]",), ('{"title": "no id"}',), ("",)], "value string")
    good.unionByName(bad).coalesce(1).write.text(folder + "/in")
    pieces = spark.conf.get("spark.sql.inMemoryColumnarStorage.batchSize")
    start_live(spark, folder + "/in", folder + "/bronze", folder + "/bad", folder + "/cp", seconds=0).awaitTermination()
    assert seen and all(memory == 0 < disk for memory, disk in seen)
    assert spark.conf.get("spark.sql.inMemoryColumnarStorage.batchSize") == pieces
    assert spark.read.parquet(folder + "/bronze").select("id").distinct().count() == 300
    assert {r.linea for r in spark.read.parquet(folder + "/bad").collect()} == {"{broken 1", "[]", '{"title": "no id"}', ""}


def test_incremental_silver_reads_few_rows_at_once(spark, folder, monkeypatch):
    """Wide rows are read in small batches during an update; the session's setting is back afterwards."""
    key, seen = "spark.sql.parquet.columnarReaderBatchSize", []
    keep = incremental.latest_by_key
    monkeypatch.setattr(incremental, "latest_by_key", lambda df, **by: (seen.append(int(spark.conf.get(key))), keep(df, **by))[1])
    rows = spark.range(50).selectExpr("'p' || id as id", "'text ' || id as selftext", "cast(id as double) as created_utc",
                                      "1000D as _ingest_ts")
    before = spark.conf.get(key)
    for lote, title in ((0, "first"), (1, "second")):
        rows.withColumns({"title": F.lit(title), "_ingest_ts": F.col("_ingest_ts") + lote}) \
            .write.parquet(f"{folder}/bronze/lote={lote:012d}")
        assert incremental.update(spark, folder + "/bronze", folder + "/silver", buckets=4) == [0, 1, 2, 3]
    assert len(seen) == 3 and max(seen) < 4096 and spark.conf.get(key) == before
    got = incremental.read_silver(spark, folder + "/silver").select("id", "titulo").collect()
    assert len(got) == 50 and {r.titulo for r in got} == {"second"}
