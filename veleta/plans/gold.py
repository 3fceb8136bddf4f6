"""Silver to gold features, predictions and the A/B report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veleta.operators import ab, models
from veleta.operators.features import (features_a, features_b, matrix_a, matrix_b,
                                       matrix_columns_a, matrix_columns_b)
from veleta.sources.tables import read_concepts, write_report, write_table

KEEP = ["id", "fecha_creacion", "subreddit_nombre", "titulo"]


def run_features(spark: SparkSession, silver_path: str, dictionaries: list[str], path_a: str,
                 path_b: str) -> None:
    silver = spark.read.parquet(silver_path)
    write_table(features_a(silver), path_a)
    write_table(features_b(silver, read_concepts(spark, *dictionaries)), path_b)


def labelled(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with a binary label (id, label)."""
    return matrix.join(labels.select("id", F.col("label").cast("int").alias("label")), "id")


def run_predict_a(spark: SparkSession, features_path: str, model_path: str, out: str,
                  labels: DataFrame | None = None) -> None:
    """Score with the stored model, or train it first when labels are given."""
    table = spark.read.parquet(features_path)
    cols, matrix = matrix_columns_a(table.columns), matrix_a(table, KEEP)
    train = None if labels is None else (lambda: models.train_a(labelled(matrix, labels), cols))
    model = models.load_or_train(model_path, train)
    write_table(models.predict(model, matrix, "modelo_a", F.current_timestamp().cast("string")), out)


def run_predict_b(spark: SparkSession, features_path: str, model_path: str, out: str,
                  labels: DataFrame | None = None) -> None:
    table = spark.read.parquet(features_path)
    cols, matrix = matrix_columns_b(table), matrix_b(table, KEEP)
    train = None if labels is None else (lambda: models.train_b(labelled(matrix, labels), cols))
    model = models.load_or_train(model_path, train)
    write_table(models.predict(model, matrix, "modelo_b", F.current_timestamp().cast("string")), out)


def run_compare(spark: SparkSession, path_a: str, path_b: str, report: str) -> None:
    """Metrics, agreement per community and probability histograms of two prediction tables."""
    joined = ab.ab_join(spark.read.parquet(path_a), spark.read.parquet(path_b))
    write_report(ab.ab_metrics(joined).withColumn(
        "timestamp_calculo", F.current_timestamp().cast("string")), report)
    write_report(ab.ab_agreement(joined), f"{report}_concordancia")
    write_report(ab.probability_histograms(joined), f"{report}_histogramas")
