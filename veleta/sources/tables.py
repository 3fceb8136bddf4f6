"""Small sources and sinks: dictionaries, tables, reports and triples."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veleta.operators.concepts import merge_dictionaries
from veleta.operators.triples import COLUMNS

OPEN_FILES = 64  # more predicates than these in one task are sorted, as always


def read_concepts(spark: SparkSession, *paths: str) -> DataFrame:
    """Concept dictionaries (concepto, sinonimo) with header; a missing file counts as empty."""
    empty = spark.createDataFrame([], "concepto string, sinonimo string")
    parts = [empty]
    for path in paths:
        try:
            parts.append(spark.read.csv(path, header=True).select("concepto", "sinonimo"))
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
    return merge_dictionaries(*parts)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report as parquet and as CSV with header; reports are small aggregates."""
    df.write.mode("overwrite").parquet(path + ".parquet")
    df.write.mode("overwrite").option("header", True).csv(path + ".csv")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_triples(triples: DataFrame, path: str) -> None:
    """Triple table partitioned by predicate, so a question reads only its predicates.

    A task keeps one file open for each of its few predicates: its rows, whole texts among them, are not sorted by folder.
    """
    conf, setting = triples.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(setting)
    conf.set(setting, str(OPEN_FILES))
    try:
        triples.withColumn("predicado", F.substring(F.sha2("p", 256), 1, 12)).hint("rebalance", "p") \
            .write.mode("overwrite").partitionBy("predicado").parquet(path)
    finally:
        conf.set(setting, before)


def read_triples(spark: SparkSession, path: str, predicates: list[str] | None = None) -> DataFrame:
    """The stored table, or only some predicates of it (partition pruning)."""
    out = spark.read.parquet(path)
    if predicates:
        folders = [hashlib.sha256(p.encode()).hexdigest()[:12] for p in predicates]
        out = out.filter(F.col("predicado").isin(folders) & F.col("p").isin(predicates))
    return out.select(*COLUMNS)


def triple_source(spark: SparkSession, path: str):
    """The stored table as a source for questions; each reads only its predicates' folders."""
    def rows(*predicates: str, obj: str | None = None) -> DataFrame:
        out = read_triples(spark, path, list(predicates))
        return out if obj is None else out.filter(F.col("o") == obj)

    return rows


_ESCAPES = (("\\", "\\u005C"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def _quote(c: Column) -> Column:
    for plain, escaped in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def _unquote(c: Column) -> Column:
    for plain, escaped in reversed(_ESCAPES):
        c = F.replace(c, F.lit(escaped), F.lit(plain))
    return c


def to_ntriples(triples: DataFrame) -> DataFrame:
    """One N-Triples line per row.  A backslash is written as its code point, which keeps
    every escape sequence unambiguous."""
    iri = lambda c: F.concat(F.lit("<"), F.replace(c, F.lit(">"), F.lit("\\u003E")), F.lit(">"))
    literal = F.concat(F.lit('"'), _quote(F.col("o")), F.lit('"'), F.coalesce(
        F.concat(F.lit("@"), F.col("o_lang")), F.concat(F.lit("^^<"), F.col("o_dtype"), F.lit(">")),
        F.lit("")))
    obj = F.when(F.col("o_kind") == "literal", literal).when(
        F.col("o_kind") == "bnode", F.col("o")).otherwise(iri(F.col("o")))
    return triples.select(F.concat(iri(F.col("s")), F.lit(" "), iri(F.col("p")), F.lit(" "), obj,
                                   F.lit(" .")).alias("value"))


def write_ntriples(triples: DataFrame, path: str) -> None:
    to_ntriples(triples).write.mode("overwrite").text(path)


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Parse lines written by ``write_ntriples``."""
    pattern = (r'^<([^>]*)> <([^>]*)> (?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*+)"'
               r'(?:@([A-Za-z-]+)|\^\^<([^>]*)>)?) \.$')
    part = lambda i: F.regexp_extract("value", pattern, i)
    undo = lambda c: F.replace(c, F.lit("\\u003E"), F.lit(">"))
    none = lambda c: F.nullif(c, F.lit(""))
    first = F.substring(F.regexp_replace("value", r"^<[^>]*> <[^>]*> ", ""), 1, 1)
    kind = F.when(first == "<", "iri").when(first == "_", "bnode").otherwise("literal")
    return spark.read.text(path).select(
        undo(part(1)).alias("s"), undo(part(2)).alias("p"),
        F.when(kind == "iri", undo(part(3))).when(kind == "bnode", part(4))
        .otherwise(_unquote(part(5))).alias("o"),
        kind.alias("o_kind"), none(part(7)).alias("o_dtype"), none(part(6)).alias("o_lang"))
