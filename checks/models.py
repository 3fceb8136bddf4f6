"""Classifiers; results depend on an optimiser, so only rows are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.core import Views, big, check, r6
from veleta.operators import features as X, models as M
from veleta.operators.labels import hash_split
from veleta.plans.gold import KEEP, labelled
from veleta.plans.prep import with_model_text
from veleta.session import durable, scratch


def _binary(v: Views) -> DataFrame:
    return v.labelled().select("id", F.col("quality").alias("label"))


def _kept(v: Views, df: DataFrame, name: str) -> DataFrame:
    """A table that is used more than once, written and read back."""
    path = scratch(v.spark, name)
    df.write.parquet(path)
    return v.spark.read.schema(df.schema).parquet(path)


def _shown(df: DataFrame) -> DataFrame:
    return df.select("id", "subreddit_nombre", big("prediccion").alias("prediccion"),
                     r6("probabilidad").alias("probabilidad"), "modelo")


def _matrix_a(v: Views) -> tuple[list[str], DataFrame]:
    table = X.features_a(v.silver())
    return X.matrix_columns_a(table.columns), _kept(v, X.matrix_a(table, KEEP), "matrix-a")


def _matrix_b(v: Views) -> tuple[list[str], DataFrame]:
    table = X.features_b(v.silver(), v.concepts())
    return X.matrix_columns_b(table), _kept(v, X.matrix_b(table, KEEP), "matrix-b")


@check("predict_a")
def predict_a(v: Views) -> DataFrame:
    """Train on the labelled posts, store, load and score all posts."""
    cols, matrix = _matrix_a(v)
    path = scratch(v.spark, "model-a")
    M.load_or_train(path, lambda: M.train_a(labelled(matrix, _binary(v)), cols))
    return _shown(M.predict(M.load_or_train(path, None), matrix, "modelo_a"))


@check("predict_b")
def predict_b(v: Views) -> DataFrame:
    cols, matrix = _matrix_b(v)
    model = M.train_b(labelled(matrix, _binary(v)), cols)
    return _shown(M.predict(model, matrix, "modelo_b"))


@check("predict_facts", """
select id, modelo, true as prob_valida, true as clase_mas_probable, true as igual_recargado, true as aprende
from posts cross join (values ('modelo_a'), ('modelo_b')) m(modelo)""")
def predict_facts(v: Views) -> DataFrame:
    """What must hold whatever the optimiser finds: every post is scored once by each model, with a
    probability, its likelier class, the same after the model was stored and loaded, and classes recalled
    better than by chance on the labelled posts."""
    out = None
    for name, (cols, matrix), train in (("modelo_a", _matrix_a(v), M.train_a), ("modelo_b", _matrix_b(v), M.train_b)):
        labels, path = _binary(v), scratch(v.spark, name)
        known = labelled(matrix, labels)
        fresh = M.predict(M.load_or_train(path, lambda: train(known, cols)), matrix, name, keep=("id",))
        again = M.predict(M.load_or_train(path, None), matrix, name, keep=("id",)).select(
            "id", F.col("prediccion").alias("c"), F.col("probabilidad").alias("p"))
        hit = F.avg((F.col("prediccion") == F.col("label")).cast("double"))
        recall = fresh.join(labels, "id").groupBy("label").agg(hit.alias("r")).agg(F.avg("r")).first()[0]
        rows = fresh.join(again, "id").select(
            "id", "modelo", F.col("probabilidad").between(0, 1).alias("prob_valida"),
            (F.col("prediccion") == (F.col("probabilidad") > 0.5).cast("int")).alias("clase_mas_probable"),
            ((F.col("prediccion") == F.col("c")) & (F.abs(F.col("probabilidad") - F.col("p")) < 1e-12)).alias("igual_recargado"),
            F.lit(recall > 0.5).alias("aprende"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _texts(v: Views) -> DataFrame:
    return _kept(v, with_model_text(v.silver()).select("id", "texto_model"), "texts")


def _fitted(v: Views, texts: DataFrame):
    rows = durable(hash_split(texts.join(v.labelled().select("id", F.col("real").alias("label")), "id")))
    part = lambda name: rows.filter(F.col("particion") == name)
    return M.train_sentiment(part("train"), part("val")), rows


@check("sentiment_train_eval")
def sentiment_train_eval(v: Views) -> DataFrame:
    """Classification report of the text classifier on the held-out part; only labelled posts are cleaned."""
    from veleta.operators.evaluate import classification_report

    posts = v.silver().join(v.labelled().select("id"), "id", "left_semi")
    (model, _), rows = _fitted(v, with_model_text(posts).select("id", "texto_model"))
    scored = M.score_sentiment(model, rows.filter("particion = 'test'"))
    return classification_report(scored)


@check("sentiment_score")
def sentiment_score(v: Views) -> DataFrame:
    """Class and probabilities for every post."""
    from veleta.functions.probs import prediction_record

    texts = _texts(v)
    (model, _), _ = _fitted(v, texts)
    rec = prediction_record(F.col("texto_model"), F.col("probs"))
    return M.score_sentiment(model, texts).select("id", rec.alias("r")).select(
        "id", "r.prediction", r6("r.confidence").alias("confidence"))


@check("sentiment_facts", """
select id, true as suma_uno, true as clase_mas_probable, true as igual_recargado, true as aprende from silver""")
def sentiment_facts(v: Views) -> DataFrame:
    """Every post is scored once: probabilities sum to one, the class is the likeliest, a stored model gives the
    same, and the held-out part is classified better than by one class for all."""
    texts, path = _texts(v), scratch(v.spark, "sentiment")
    (model, _), rows = _fitted(v, texts)
    model.write().overwrite().save(path)
    again = M.score_sentiment(M.load_or_train(path, None), texts).select("id", "texto_model", F.col("probs").alias("q"))
    held = M.score_sentiment(model, rows.filter("particion = 'test'")).withColumn("prediction", F.col("prediccion"))
    classes = held.select("label").distinct().count()
    learns = M.macro_f1(held, "label") > 1 / (classes * (classes + 1) / 2) if classes else True
    at = lambda k: F.get("probs", F.col("prediccion") + F.lit(0) if k is None else F.lit(k))
    # Both models in one scan: no join brings their scores together.
    scored = M.score_sentiment(model, again)
    return scored.select(
        "id", (F.abs(F.aggregate("probs", F.lit(0.0), lambda s, x: s + x) - 1) < 1e-9).alias("suma_uno"),
        (at(None) == F.array_max("probs")).alias("clase_mas_probable"),
        F.forall(F.arrays_zip("probs", "q"), lambda x: F.abs(x["probs"] - x["q"]) < 1e-12).alias("igual_recargado"),
        F.lit(learns).alias("aprende"))
