"""Packing, sharding, the registered queries and the pipeline."""

import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from veleta.llm import packing, queries, sharding

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_gives_the_ids_of_the_file(vocabulary):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    whole.encode_special_tokens = True
    texts = ["", "It's  a\n\n test!  ", "Éauouon 123 <|endoftext|>", "　x  y", "a" * 3000, "\t\tif (x):\r\n", "🙂 ok"]
    for t in texts:
        assert packing.encoder(vocabulary)(t) == whole.encode(t, add_special_tokens=False).ids


def test_packing(spark, vocabulary):
    docs = spark.createDataFrame([(1, "word " * 2600, 0), (2, None, 0), (2, None, 0), (None, "", 0), (5, "é ß", 0)],
                                 "doc_id long, text string, length int")
    rows = packing.pack(docs, vocabulary, keep_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    encode = packing.encoder(vocabulary)
    for d, t, _ in docs.collect():
        own = sorted((r for r in rows if r.doc_id == d), key=lambda r: r.start)
        if d == 2:
            assert [(r.start, r.length) for r in own] == [(0, 1), (0, 1)]
            continue
        ids = encode(t or "") + [0]
        assert [i for r in own for i in r.ids] == ids
        for r in own:
            assert r.length in [1 << k for k in range(11)] and r.length == 1 << r.bucket and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert packing.pack(docs.limit(0), vocabulary).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, vocabulary, longest=1000)


def test_packing_gives_the_ids_of_tokenizers(spark, vocabulary):
    """The tokenizer at its defaults: added tokens in a text are one id each."""
    from tokenizers import Tokenizer

    whole, end = Tokenizer.from_file(vocabulary), "<|endoftext|>"
    texts = ["a<|endoftext|>b", end, end * 3, f"so  {end}  it's\n\n{end} ", f"<|endoftext{end}|>", f"x <|{end}", f"é{end}" * 900,
             "<|endoftext |>", "<|ENDOFTEXT|>", "plain  words\t 12", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(docs, vocabulary, keep_ids=True).collect()
    for d, t in enumerate(texts):
        want = whole.encode(t, add_special_tokens=False).ids + [0]
        own = sorted((r for r in rows if r.doc_id == d), key=lambda r: r.start)
        assert [i for r in own for i in r.ids] == want and own[0].doc_tokens == len(want)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(want[r.start:r.start + r.length], "<u4").tobytes())


def test_write_buckets(spark, vocabulary, folder):
    pieces = packing.pack(spark.createDataFrame([(1, "some words " * 99)], "doc_id long, text string"), vocabulary)
    packing.write_buckets(pieces, folder + "/out")
    back = spark.read.parquet(folder + "/out")
    assert back.count() == pieces.count() and back.filter("length <> 1 << bucket").count() == 0


def test_sharding(spark):
    rows = [(k, ("x" * (k % 50 + 1) if k % 3 else "the same text") if k % 11 else None, 1) for k in range(2000)]
    rows += [(0, rows[0][1], 1), (None, "z", 1), (None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard(docs, 8).collect()
    assert len(got) == len(rows)
    load = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert max(load) - min(load) < 0.05 * sum(load)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    by_id = {d: t for d, t, _ in rows if d is not None}
    for r in got:
        if r.doc_id is not None:
            text = (by_id[r.doc_id] or "").encode()
            assert r.text_crc32 == zlib.crc32(text) and r["size"] == len(text) + 1
    assert sharding.shard(docs.limit(0)).count() == 0


def test_shards_of_documents_are_even(spark):
    """Within a hundredth, also where a text that many rows have makes one slot long."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    many = docs.unionByName(spark.range(10**6, 10**6 + 30_000).selectExpr("id as doc_id", "cast(null as string) as text"))
    for table in (docs, many):
        rows = sharding.shard(table).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"),
                                                          F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
        assert len(rows) == 8 and max(r.b for r in rows) <= 1.01 * min(r.b for r in rows)
        assert all(r.n == r.d == r.m + 1 for r in rows)


def test_equal_texts_share_a_shard_unless_hot(spark):
    docs = spark.createDataFrame([(k, f"text {k % 40}" if k < 400 else "hot") for k in range(1600)], "doc_id long, text string")
    got = sharding.shard(docs, 4).join(docs, "doc_id").select("text", "shard").distinct().collect()
    seen = {}
    for t, s in got:
        seen.setdefault(t, set()).add(s)
    assert len(seen["hot"]) == 4 and sum(len(v) > 1 for t, v in seen.items() if t != "hot") <= 40


def test_slot_map_grows_into_the_new_shard_only(spark, folder):
    docs = spark.createDataFrame([(k, f"text {k}" * (k % 9)) for k in range(3000)], "doc_id long, text string")
    weights = (sharding.slotted(docs, 256).groupBy("v").sum("size").withColumnRenamed("sum(size)", "bytes"))
    first = sharding.slot_map(weights, 4, 256)
    second = sharding.grow(first, weights)
    sharding.save_map(first, folder + "/map")
    sharding.save_map(second, folder + "/map")
    stored = spark.read.parquet(folder + "/map")
    assert stored.count() == 512
    old = {r.v: r.shard for r in stored.filter("version = 1").collect()}
    new = {r.v: r.shard for r in stored.filter("version = 2").collect()}
    moved = [v for v in old if old[v] != new[v]]
    assert moved and all(new[v] == 4 for v in moved)
    load = {}
    for v, b in weights.collect():
        load[new[v]] = load.get(new[v], 0) + b
    assert max(load.values()) < 1.25 * min(load.values())
    placed = sharding.shard(docs, 4, 256, mapping=stored).collect()
    assert all(r.shard == new[r.virtual_slot] for r in placed)


def test_queries_cover_the_ten_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 11))


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), docs.schema)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.4 * sizes[0]
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1]
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.select("doc_id").distinct().count() == sizes[-1]


def test_stages_with_odd_rows(spark):
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "plain words " * 5, None, None, None),
           (3, "plain words " * 5, "en", "s", 60), (3, "plain words " * 5, "en", "s", 60)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= max(1, 3 * len(rows)), name


def test_stages_with_clashing_columns(spark):
    """Extra columns of any name come through the two duplicate stages; texts decide, not ids alone."""
    words = lambda p, n=40: " ".join(f"{p}{k}" for k in range(n))
    schema = "doc_id long, text string, _null int, text_hash string, c0 int, no_text int, grp int, id long, n_removed int, n_chars int"
    texts = [(1, words("a")), (2, words("a") + " more"), (3, words("b")), (3, words("c")), (3, words("b")), (4, None), (5, ""),
             (6, words("d", 60)), (7, words("e", 30) + " " + words("d", 60)), (None, words("a"))]
    docs = spark.createDataFrame([(i, t, 1, "h", 2, 3, 4, 5, 6, len(t or "")) for i, t in texts], schema)
    one = corpus_pipeline.one_of_each(spark, docs, SF)
    assert one.columns == docs.columns
    assert sorted((r[0] or 0, (r[1] or "")[:2]) for r in one.collect()) == [
        (0, "a0"), (1, "a0"), (3, "b0"), (3, "c0"), (4, ""), (5, ""), (6, "d0"), (7, "e0")]
    cut = corpus_pipeline.without_repeats(spark, docs, SF)
    assert cut.columns == docs.columns
    rows = {(r["doc_id"], r["text"]): r for r in cut.collect()}
    assert all(tuple(r)[2:9] == (1, "h", 2, 3, 4, 5, 6) for r in rows.values())
    assert (4, None) in rows and (5, "") in rows and (7, words("e", 30) + " ") in rows
    assert rows[(7, words("e", 30) + " ")]["n_chars"] == len(words("e", 30)) + 1
