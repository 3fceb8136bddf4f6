import os

import pytest
import zstandard
from pyspark.sql import DataFrameWriter, functions as F

from veleta.operators.extract import bronze_records, newest_per_group, parse_lines
from veleta.operators.harmonize import fill_nulls, fill_sentinel, require, resolve_types
from veleta.schemas import BRONZE_SCHEMA, FIELDS, RENAMES
from veleta.sources.bronze import BY_MONTH, read_bronze, read_drifting, write_bronze
from veleta.sources.historical import keep_posts, scan_archive, select_files, write_months
from veleta.sources.tables import read_concepts, read_ntriples, read_triples, write_ntriples, write_report, write_triples


def test_catalogue():
    assert len(FIELDS) == 82 and len(BRONZE_SCHEMA) == 86 and len(set(RENAMES.values())) == 82


def test_raw_submission(spark):
    lines = [
        '{"id":"a","title":"T","created_utc":1.7e9,"edited":1700000001.0,"media":{"k":1},"nuevo":true,"n":3,"x":null,"o":{"q":1}}',
        '{"id":"b","title":"T","created_utc":1700000000,"edited":true,"media":{},"gallery_data":null,"media_embed":null}',
        '{"id":"c","title":"T","created_utc":1700000000,"edited":false,"author":"[deleted]"}',
        'broken', '{"sin_id":1}',
    ]
    parsed = parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [r.malo for r in parsed.select("malo").collect()] == [False, False, False, True, True]
    a, b, c = bronze_records(parsed, F.lit(5.0)).orderBy("id").collect()
    assert len(a) == 86
    assert (a.edited_bool, a.edited_utc) == (True, 1700000001.0)
    assert (b.edited_bool, b.edited_utc) == (True, None)
    assert (c.edited_bool, c.edited_utc, c.author) == (False, None, "[deleted]")
    assert a.media == '{"k":1}' and b.media is None and b.gallery_data is None
    assert a.media_embed == "{}" and b.media_embed == "null" and a.awarders == "[]"
    assert a.extras == {"nuevo": "True", "n": "3"}
    assert '"x":null' in a.raw_payload and '"o"' not in a.raw_payload
    assert (a.score, a.is_crosspostable, a.stickied, a.view_count) == (0, True, False, None)
    assert a.created_ts.startswith("2023-11-14T22:13:20")


def test_drifting_files(spark, folder):
    frame = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}")
    frame([("a", "1,5k")], "id string, view_count string", "x/1")
    frame([("b", 2.5)], "id string, view_count double", "x/2")
    frame([("c", 7)], "id string, view_count bigint", "y/3")
    frame([("d",)], "id string", "y/4")
    os.makedirs(f"{folder}/z")
    with open(f"{folder}/z/bad.parquet", "wb") as f:
        f.write(b"not a parquet file")
    got = {r.id: r.view_count for r in read_drifting(spark, folder).collect()}
    assert got == {"a": "1,5k", "b": "2.5", "c": "7", "d": None}


def test_type_priority(spark):
    df = lambda s: spark.createDataFrame([], s).schema
    t = resolve_types([df("a bigint, b bigint, c boolean"), df("a double, b boolean, c boolean, d date"),
                       df("d timestamp")])
    assert {k: v.simpleString() for k, v in t.items()} == {
        "a": "double", "b": "bigint", "c": "boolean", "d": "string"}


def test_null_policy(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a string, b bigint, c double, d boolean") \
        .withColumn("e", F.lit(None))
    assert tuple(fill_nulls(df).first()) == ("", 0, 0.0, None, "")
    s = spark.createDataFrame([(None, 3)], "distinguido string, vistas bigint")
    assert tuple(fill_sentinel(s).first()) == ("NA", "3")
    with pytest.raises(ValueError):
        require(s, ["id"])


def test_bronze_layouts(spark, folder):
    df = spark.createDataFrame([("a", "News", 1704067200.0), ("b", None, 1704153600.0)],
                               "id string, subreddit string, created_utc double")
    write_bronze(df, folder + "/day", by=("sub", "fecha"))
    write_bronze(df, folder + "/month", by=BY_MONTH)
    assert os.path.isdir(folder + "/day/sub=news/fecha=2024-01-01")
    assert os.path.isdir(folder + "/month/mes=2024-01")
    assert read_bronze(spark, folder + "/month").count() == 2


def test_triples_are_written_without_a_sort(spark, folder, monkeypatch):
    """Predicates stay in their folders, more of them than open files too, and the setting comes back."""
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(setting)), write(self, *a, **k)))
    rows = spark.range(3000).select(F.concat(F.lit("s"), "id").alias("s"), F.concat(F.lit("p"), F.col("id") % 150).alias("p"),
                                    F.lit("o").alias("o"), *[F.lit(None).cast("string").alias(c) for c in ("o_kind", "o_dtype", "o_lang")])
    before = spark.conf.get(setting)
    write_triples(rows, folder + "/t")
    assert int(seen[0]) > 0 and spark.conf.get(setting) == before
    assert read_triples(spark, folder + "/t").exceptAll(rows).isEmpty() and read_triples(spark, folder + "/t").count() == 3000
    assert read_triples(spark, folder + "/t", ["p7"]).count() == 20 and len([n for n in os.listdir(folder + "/t") if "=" in n]) == 150


def test_bronze_folders_stay_few_over_many_months(spark, folder):
    """A post every ten days over a thousand years, and one without time."""
    posts = spark.range(36525).select(F.col("id").cast("string"), F.lit("News").alias("subreddit"),
                                      (F.col("id") * 864000.0 - 86400).alias("created_utc"))
    posts = posts.unionByName(spark.createDataFrame([("x", "News", None)], "id string, subreddit string, created_utc double"))
    write_bronze(posts, folder + "/bronze")
    names = sorted(n.removeprefix("mes=") for n in os.listdir(folder + "/bronze") if n.startswith("mes="))
    assert len(names) <= 420 + 12 + 1
    assert {"2005-01", "2024-02", "2039-12", "1900-01", "2000-01", "2900-01"} <= set(names) and "2040-01" not in names
    back = spark.read.parquet(folder + "/bronze")
    assert back.select("id", "created_utc").exceptAll(posts.select("id", "created_utc")).isEmpty() and back.count() == 36526
    assert back.filter(F.col("fecha") != F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM-dd")).isEmpty()


def test_archive(spark, folder):
    raw = "\n".join([
        '{"subreddit":"Ecuador","created_utc":1600000000,"title":"el perro y los gatos","selftext":"que"}',
        '{"subreddit":"Ecuador","created_utc":"1600000000","title":"el perro y los gatos"}',
        '{"subreddit":"ecuador","created_utc":1000000000,"title":"el perro y los gatos"}',
        '{"subreddit":"otro","created_utc":1600000000,"title":"el perro y los gatos"}',
        '{"subreddit":"ecuador","created_utc":1600000000,"title":"der Hund und die Katze"}',
        '{malformed',
        '{"subreddit":"ecuador","created_utc":1600000000.5,"title":"the dog and the cat"}'])
    os.makedirs(folder + "/in")
    with open(folder + "/in/a.zst", "wb") as f:
        f.write(zstandard.ZstdCompressor().compress(raw.encode()))
    kept = keep_posts(scan_archive(spark, folder + "/in"), ["ECUADOR"])
    assert sorted(r.mes for r in kept.collect()) == ["2020-09", "2020-09"]
    write_months(kept, folder + "/out")
    lines = {r.value for r in spark.read.text(folder + "/out/sub=ecuador/mes=2020-09").collect()}
    assert lines == {raw.split("\n")[0], raw.split("\n")[6]}


def test_file_selection(spark):
    paths = ["x/submissions/Ecuador/2021-03.zst", "x/submissions/ecuador/2019-12.zst",
             "x/comments/ecuador/2021-03.zst", "d/RS_2019-12.zst", "d/RS_2024-12.zst",
             "d/rs_2020-01.zst", "d/RC_2024-12.zst", "d/RS_2024-13.zst", "d/RS_2024-12.zst.tmp"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.path: r.prioridad for r in select_files(df, ["ecuador"]).collect()}
    assert got == {paths[0]: 7, paths[4]: 6, paths[5]: 6}


def test_newest_per_group(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).alias("g"), "id")
    got = newest_per_group(df, "g", [F.desc("id")], 5).groupBy("g").agg(F.min("id").alias("m"), F.count("*").alias("n"))
    assert {r.g: (r.m, r.n) for r in got.collect()} == {True: (987, 5), False: (992, 5)}


def test_ntriples_round_trip(spark, folder):
    hard = 'a "b" \\n \\ c\n\td\r\\u005C é > <x> .'
    rows = [("http://s/1", "http://p/t", hard, "literal", None, None),
            ("http://s/1", "http://p/t", "hola", "literal", None, "es"),
            ("http://s/1", "http://p/n", "3", "literal", "http://x#integer", None),
            ("http://s/a>b", "http://p/r", "http://o/2", "iri", None, None),
            ("http://s/1", "http://p/b", "_:b0", "bnode", None, None)]
    df = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, o_dtype string, o_lang string")
    write_ntriples(df, folder + "/nt")
    assert {tuple(r) for r in read_ntriples(spark, folder + "/nt").collect()} == set(rows)


def test_dictionary_and_report(spark, folder):
    with open(folder + "/es.csv", "w") as f:
        f.write("concepto,sinonimo\nIA,Robot\nIA,robot\nIA,machine learning\n")
    got = {tuple(r) for r in read_concepts(spark, folder + "/es.csv", folder + "/no.csv").collect()}
    assert got == {("IA", "robot"), ("IA", "machine learning")}
    write_report(spark.createDataFrame([(1,)], "n bigint"), folder + "/r")
    assert spark.read.parquet(folder + "/r.parquet").count() == 1
    assert spark.read.csv(folder + "/r.csv", header=True).columns == ["n"]
