"""Silver to the triple table and the reports on it."""

from __future__ import annotations

from pyspark.sql import SparkSession

from veleta.operators import ontology, questions
from veleta.operators.triples import triples
from veleta.sources.tables import (read_triples, triple_source, write_ntriples, write_report,
                                   write_table, write_triples)


def run_generate(spark: SparkSession, silver_path: str, table_path: str,
                 ntriples_path: str | None = None) -> None:
    graph = triples(spark.read.parquet(silver_path))
    write_triples(graph, table_path)
    if ntriples_path:
        write_ntriples(read_triples(spark, table_path), ntriples_path)


def run_semantic_features(spark: SparkSession, table_path: str, out: str) -> None:
    write_table(questions.semantic_features(triple_source(spark, table_path)), out)


def run_questions(spark: SparkSession, table_path: str, folder: str) -> None:
    g = triple_source(spark, table_path)
    for name, answer in {
        "cq_missing_subreddit": questions.missing_subreddit(g),
        "cq_subreddit_label": questions.subreddit_label(g),
        "cq_technology": questions.technology_posts(g),
        "cq1_posts_by_subreddit": questions.posts_by_subreddit(g),
        "cq2_high_score_tech": questions.high_score_tech(g),
        "cq3_post_types": questions.post_types(g),
    }.items():
        write_report(answer, f"{folder}/{name}")


def run_quality(spark: SparkSession, table_path: str, report: str) -> None:
    schema = ontology.ontology_triples(spark).unionByName(ontology.vocabulary_triples(spark))
    counts = ontology.oquare_counts(schema, triple_source(spark, table_path))
    write_report(ontology.oquare_metrics(counts), report)
