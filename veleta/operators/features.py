"""Baseline (A) and concept (B) features and the matrices built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from veleta.functions.text import word_count
from veleta.functions.values import iso_timestamp, iso_weekday
from veleta.operators.concepts import count_expressions, dictionary_metadata

# Model A's inputs in order, and the name prefixes that select model B's.
COLUMNS_A = (
    "long_titulo", "long_texto", "palabras_titulo", "palabras_texto", "hora_dia", "dia_semana",
    "interaccion_proxy", "ratio_puntos_comentarios", "es_adulto_int", "es_video_int",
)
PREFIXES_B = (
    "long_", "palabras_", "hora_", "dia_", "interaccion_", "ratio_", "es_", "n_", "total_",
    "diversidad_",
)
MIN_FEATURES = 5


def features_a(df: DataFrame) -> DataFrame:
    """Length, time, engagement and simple text features; one projection, no shuffle."""
    ts = F.col("fecha_creacion")
    if isinstance(df.schema["fecha_creacion"].dataType, T.StringType):
        df = df.withColumn("fecha_creacion", iso_timestamp(ts))
    comments = F.greatest(F.col("total_comentarios"), F.lit(1))
    return df.withColumns({
        "long_titulo": F.length("titulo"),
        "long_texto": F.length("texto"),
        "palabras_titulo": word_count(F.col("titulo")),
        "palabras_texto": word_count(F.col("texto")),
        "hora_dia": F.hour("fecha_creacion"),
        "dia_semana": iso_weekday(ts),
        "interaccion_proxy": F.col("puntaje") + F.col("total_comentarios"),
        "ratio_puntos_comentarios": F.col("puntaje") / comments,
        "contiene_pregunta": F.contains("titulo", F.lit("?")),
        "titulo_mayusculas": F.upper("titulo") == F.col("titulo"),
        "es_adulto_int": F.col("es_adulto").cast("tinyint"),
        "es_video_int": F.col("es_video").cast("tinyint"),
        "suscriptores_subreddit": F.coalesce("subreddit_suscriptores", F.lit(0).cast("bigint")),
    })


def _wide_local(df: DataFrame, concepts: dict[str, list[str]]) -> DataFrame:
    arrays = df.withColumns({
        "_t": count_expressions(F.coalesce(F.col("titulo"), F.lit("")), concepts),
        "_x": count_expressions(F.coalesce(F.col("texto"), F.lit("")), concepts)})
    cols: dict[str, Column] = {}
    for i, c in enumerate(concepts):
        title, body = F.get("_t", F.lit(i)), F.get("_x", F.lit(i))
        cols[f"n_{c}_titulo"] = title
        cols[f"n_{c}_texto"] = body
        cols[f"es_{c}"] = title + body > 0
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    present = lambda a: F.size(F.filter(a, lambda x: x > 0))
    cols["total_conceptos_titulo"] = total("_t")
    cols["total_conceptos_texto"] = total("_x")
    cols["diversidad_conceptos_titulo"] = present("_t")
    cols["diversidad_conceptos_texto"] = present("_x")
    return arrays.withColumns(cols).drop("_t", "_x")


def features_b(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Features A plus, per concept, counts in title and body and a flag, and their totals.

    The columns are the same for every size of the dictionary: its concepts are the table's
    metadata and are counted inside the row.  Counts agree with ``concepts.concept_counts``, the
    long form for dictionaries with more concepts than a table should have columns.
    """
    base = features_a(df)
    concepts = dictionary_metadata(dictionary)
    return _wide_local(base, concepts) if concepts else base


def _numeric(c: str) -> Column:
    return F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c)


def matrix_columns_a(columns: list[str]) -> list[str]:
    found = [c for c in COLUMNS_A if c in columns]
    if len(found) < MIN_FEATURES:
        raise ValueError(f"only {len(found)} of the baseline features are present: {found}")
    return found


def matrix_a(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` plus the baseline features as doubles, nulls 0, zero-padded to ten columns."""
    found = matrix_columns_a(df.columns)
    padding = [F.lit(0.0).alias(f"relleno_{i}") for i in range(len(found), len(COLUMNS_A))]
    return df.select(*keep, *[_numeric(c) for c in found], *padding)


def matrix_columns_b(df: DataFrame) -> list[str]:
    """Columns chosen by prefix, in table order, each once; text and time columns cannot be
    model inputs and are left out."""
    usable = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.NumericType, T.BooleanType))}
    found = [c for c in dict.fromkeys(df.columns) if c.startswith(PREFIXES_B) and c in usable]
    if len(found) < MIN_FEATURES:
        raise ValueError(f"only {len(found)} features match the prefixes: {found}")
    return found


def matrix_b(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, *[_numeric(c) for c in matrix_columns_b(df)])
