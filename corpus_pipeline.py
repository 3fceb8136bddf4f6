"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
stage's documents, so a lost executor costs a re-read.  All stages but the last return the columns of
``documents``.  Other tables are read below ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veleta.llm import decontaminate, jaccard, ordinal, packing, suffixes
from veleta.llm.common import remove_folder, table
from veleta.llm.queries import quality_model
from veleta.session import scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, trained on the label table, expects to be good.

    Null and empty texts are scored like others, on no words; rows without id and repeated rows are
    judged by their texts; very long texts are read whole.
    """
    return ordinal.select(docs, quality_model(spark, docs, sf_dir))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of every group of near duplicates.

    Rows that repeat an id with the same text count as one document; different texts with one id are
    documents of their own, and if they belong to one group the one of smallest hash stays.  Rows without
    id cannot be told apart and stay; null, empty and blank texts are alike nothing and stay.
    """
    name = _free(docs, "text_hash")
    groups = jaccard.join(docs.filter("doc_id is not null"), keep_group=True)
    first = (groups.filter("doc_id = component_id")
             # A row without a group (no shingle) is a group of its own.
             .groupBy("doc_id", F.coalesce("grp", F.lit(-1)), F.when(F.col("grp").isNull(), F.col("text_hash")))
             .agg(F.min("text_hash").alias(name)).select("doc_id", name).distinct())
    rows = jaccard.with_text_hash(docs, name)
    kept = rows.join(first, ["doc_id", name], "left_semi").dropDuplicates(["doc_id", name])
    return kept.select(*_names(docs)).unionByName(docs.filter("doc_id is null"))


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have (names are compared without case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of a hundred bytes that occur earlier; a document of which
    nothing is left goes, ``n_chars`` follows the text.

    Null and empty texts stay as they are; rows without id keep their text and stay; rows that repeat
    an id with the same text lose the same bytes.  Columns of any name are carried along.
    """
    aliases = {c: f"c{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    rows = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(a) for c, a in aliases.items()],
                       F.col("text").isNull().alias("no_text"))
    kept = suffixes.dedup(rows, keep_text=True, carry=(*aliases.values(), "no_text"))
    kept = kept.filter((F.col("n_bytes") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    text = F.when(~F.col("no_text"), F.col("kept_text"))
    out = {"doc_id": F.col("doc_id"), "text": text} | {c: F.col(a) for c, a in aliases.items()}
    if "n_chars" in aliases:
        out["n_chars"] = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(out["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return kept.select(*[out[c].alias(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten benchmark words occurs; null and empty texts have none.
    Rows are judged one by one, whatever their ids; very long texts are searched whole."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of at most 1024 tokens; a null or empty text is its end id alone, repeated
    rows and rows without id are packed one by one, very long texts give many pieces."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", keep_good), ("n-gram jaccard join", one_of_each), ("suffix-array dedup", without_repeats),
          ("benchmark decontamination", without_benchmark), ("packing", packed)]

# Training a classifier and a tokenizer's merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's, read back from its files."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = scratch(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
