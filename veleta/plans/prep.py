"""Silver to a labelled, split sentiment data set, and training on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veleta.functions.lang import language
from veleta.functions.once import add_once
from veleta.functions.text import model_text
from veleta.functions.values import epoch_timestamp
from veleta.functions import probs as P
from veleta.operators import evaluate, labels, models
from veleta.operators.dedup import first_by_text
from veleta.operators.harmonize import require
from veleta.schemas import (DROPPED, KEEP_FIRST, LANGUAGES, MIN_TEXT_LENGTH, TARGET_SUBREDDITS,
                            TEXT_CHOICES, TRAINING_FIRST)
from veleta.session import scratch
from veleta.sources.tables import write_json, write_report, write_table


def ordered(df: DataFrame, first, drop=()) -> DataFrame:
    """Without ``drop``, the columns of ``first`` that exist in front, the rest behind."""
    left = [c for c in df.columns if c not in drop]
    head = [c for c in first if c in left]
    return df.select(*head, *[c for c in left if c not in head])


def text_column(columns: list[str]) -> str:
    """First usable text column."""
    found = [c for c in TEXT_CHOICES if c in columns]
    if not found:
        raise ValueError(f"no text column among {list(TEXT_CHOICES)}")
    return found[0]


def with_model_text(silver: DataFrame) -> DataFrame:
    col = lambda c: F.col(c) if c in silver.columns else F.lit(None).cast("string")
    text = model_text(col("titulo"), col("texto"), col("titulo_limpio"), col("texto_limpio"))
    return add_once(silver, texto_model=text).withColumn("longitud_texto", F.length("texto_model"))


def usable(df: DataFrame) -> DataFrame:
    """No media posts, no empty or very short texts."""
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    for flag in ("solo_media", "es_video", "es_galeria"):
        if flag in df.columns:
            df = df.filter(no(flag))
    return df.filter((F.col("texto_model") != "") & (F.col("longitud_texto") >= MIN_TEXT_LENGTH))


def in_languages(df: DataFrame, languages=LANGUAGES) -> DataFrame:
    found = add_once(df, idioma_detectado=language(F.col("texto_model"), "unk"))
    return found.filter(F.col("idioma_detectado").isin(list(languages)))


def clean(silver: DataFrame) -> DataFrame:
    """Clean set over all communities."""
    require(silver, ["id", "subreddit_nombre", "fecha_creacion_utc"],
            ["texto", "texto_limpio", "titulo", "titulo_limpio"])
    rows = usable(with_model_text(silver)) \
        .withColumn("fecha_creacion_utc", epoch_timestamp(F.col("fecha_creacion_utc")))
    return ordered(in_languages(rows), KEEP_FIRST, DROPPED)


def targeted(df: DataFrame, targets=TARGET_SUBREDDITS) -> DataFrame:
    return df.filter(F.lower("subreddit_nombre").isin([t.lower() for t in targets]))


def label_and_select(rows: DataFrame, stars: DataFrame) -> DataFrame:
    """Exact-text duplicates out, weak labels on, length outliers out, training order."""
    unique = first_by_text(rows, "texto_model")
    labelled = labels.weak_labels(unique.join(stars, "id")) \
        .dropna(subset=["texto_model", "label"])
    return ordered(labels.length_window(labelled), TRAINING_FIRST)


def balanced(labelled: DataFrame) -> DataFrame:
    """High-confidence rows with mined neutrals, binary when a class is too rare."""
    mined = labels.mine_neutrals(labelled)
    extra = labels.relax_neutrals(labels.with_confidence(labelled), mined)
    full = mined.unionByName(extra.withColumn("minado", F.lit(True)))
    return labels.binary_fallback(full)


def for_review(labelled: DataFrame) -> DataFrame:
    """Rows whose own class does not reach its threshold, the least certain first in a file: these are read
    by people before they are used."""
    return labels.with_confidence(labelled).filter(~F.coalesce("alta_confianza", F.lit(False))).drop("alta_confianza") \
        .sortWithinPartitions("confianza", "id")


def run(spark: SparkSession, silver_path: str, stars: DataFrame, folder: str,
        exact_split: bool = False) -> None:
    """Write clean, ready, labelled, review, train / val / test tables and the class weights."""
    write_table(clean(spark.read.parquet(silver_path)), f"{folder}/silver_clean")
    ready = targeted(spark.read.parquet(f"{folder}/silver_clean"))
    write_table(ready, f"{folder}/silver_sentiment_ready")
    ready = spark.read.parquet(f"{folder}/silver_sentiment_ready")
    # Without any target community the whole clean set is used.
    source = ready if not ready.isEmpty() else spark.read.parquet(f"{folder}/silver_clean")
    write_table(label_and_select(source, stars), f"{folder}/silver_sentimiento")
    write_table(for_review(spark.read.parquet(f"{folder}/silver_sentimiento")), f"{folder}/silver_revision")
    chosen = balanced(spark.read.parquet(f"{folder}/silver_sentimiento"))
    split = labels.ranked_split(chosen) if exact_split else labels.hash_split(chosen)
    parts = scratch(spark, "split")
    write_table(split, parts)
    split = spark.read.parquet(parts)
    for name in ("train", "val", "test"):
        write_table(split.filter(F.col("particion") == name).drop("particion"), f"{folder}/{name}")
    write_json(labels.class_weights(spark.read.parquet(f"{folder}/train")),
               f"{folder}/class_weights")


def run_train(spark: SparkSession, folder: str, model_path: str) -> float:
    """Fit on train, choose on val, store the model; returns the validation macro F1."""
    train, val = (spark.read.parquet(f"{folder}/{p}") for p in ("train", "val"))
    model, score = models.train_sentiment(train, val, text_column(train.columns))
    model.write().overwrite().save(model_path)
    return score


def run_score(spark: SparkSession, silver_path: str, model_path: str, out: str) -> None:
    """Class, probabilities and confidence of every post by a stored model; blank texts get the neutral record."""
    texts = with_model_text(spark.read.parquet(silver_path)).select("id", "texto_model")
    scored = models.score_sentiment(models.load_or_train(model_path, None), texts)
    record = P.prediction_record(F.col("texto_model"), F.col("probs"))
    write_table(scored.select("id", record.alias("r")).select("id", "r.*"), out)


def run_evaluate(spark: SparkSession, folder: str, model_path: str, report: str) -> None:
    """Classification report, macro measures and confusion matrix of a stored model on the test part."""
    test = spark.read.parquet(f"{folder}/test")
    scored = models.score_sentiment(models.load_or_train(model_path, None), test.withColumn(
        "texto_model", F.col(text_column(test.columns)))).select("id", "label", "prediccion")
    path = scratch(spark, "scored")
    write_table(scored, path)
    scored = spark.read.parquet(path)
    write_report(evaluate.classification_report(scored), f"{report}_clases")
    write_report(evaluate.macro_metrics(scored), f"{report}_macro")
    write_report(evaluate.confusion_matrix(scored), f"{report}_confusion")
