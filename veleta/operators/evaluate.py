"""Classifier evaluation from one aggregate row; no table is scanned twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veleta.functions.values import ratio

CLASSES = (0, 1, 2)


def _hit(c: str, k: int) -> Column:
    return F.coalesce(F.col(c) == k, F.lit(False))


def confusion_matrix(df: DataFrame, real: str = "label", pred: str = "prediccion",
                     classes=CLASSES) -> DataFrame:
    """All (real, prediccion) cells, empty ones 0."""
    cells = [(r, p) for r in classes for p in classes]
    one = df.agg(*[F.count_if(_hit(real, r) & _hit(pred, p)).alias(f"c{r}_{p}") for r, p in cells])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(r).cast("bigint").alias("real"), F.lit(p).cast("bigint").alias("prediccion"),
                 F.col(f"c{r}_{p}").cast("bigint").alias("n")) for r, p in cells
    ])).alias("x")).select("x.*")


def _class_sums(df: DataFrame, real: str, pred: str, classes) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(real) == F.col(pred)).alias("aciertos")]
    for k in classes:
        aggs += [F.count_if(_hit(real, k) & _hit(pred, k)).alias(f"tp_{k}"),
                 F.count_if(_hit(real, k)).alias(f"real_{k}"),
                 F.count_if(_hit(pred, k)).alias(f"pred_{k}")]
    return df.agg(*aggs)


def _scores(k: int) -> dict[str, Column]:
    tp, real, pred = F.col(f"tp_{k}"), F.col(f"real_{k}"), F.col(f"pred_{k}")
    return {"precision": ratio(tp, pred), "recall": ratio(tp, real),
            "f1": ratio(tp * 2, real + pred)}


def classification_report(df: DataFrame, real: str = "label", pred: str = "prediccion",
                          classes=CLASSES) -> DataFrame:
    """precision, recall, f1 and support per class, then accuracy, macro and weighted means."""
    one = _class_sums(df, real, pred, classes)
    per = {k: _scores(k) for k in classes}
    names = ("precision", "recall", "f1")
    accuracy = ratio(F.col("aciertos"), F.col("total"))

    def row(name: str, values: dict[str, Column], support: Column) -> Column:
        return F.struct(F.lit(name).alias("clase"), *[values[n].alias(n) for n in names],
                        support.cast("bigint").alias("support"))

    def mean(n: str, weighted: bool) -> Column:
        if weighted:
            return ratio(sum((per[k][n] * F.col(f"real_{k}") for k in classes), F.lit(0.0)),
                         F.col("total"))
        return sum((per[k][n] for k in classes), F.lit(0.0)) / len(classes)

    rows = [row(str(k), per[k], F.col(f"real_{k}")) for k in classes]
    rows.append(row("accuracy", {n: accuracy for n in names}, F.col("total")))
    rows.append(row("macro avg", {n: mean(n, False) for n in names}, F.col("total")))
    rows.append(row("weighted avg", {n: mean(n, True) for n in names}, F.col("total")))
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def macro_metrics(df: DataFrame, real: str = "label", pred: str = "prediccion",
                  classes=CLASSES) -> DataFrame:
    """Macro accuracy (mean recall), macro F1 and weighted F1 in one row."""
    one = _class_sums(df, real, pred, classes)
    per = {k: _scores(k) for k in classes}
    return one.select(
        (sum((per[k]["recall"] for k in classes), F.lit(0.0)) / len(classes)).alias("acc_macro"),
        (sum((per[k]["f1"] for k in classes), F.lit(0.0)) / len(classes)).alias("f1_macro"),
        ratio(sum((per[k]["f1"] * F.col(f"real_{k}") for k in classes), F.lit(0.0)),
              F.col("total")).alias("f1_weighted"))


def validation_accuracy(df: DataFrame, category: str, expected: str, predicted: str) -> DataFrame:
    """Accuracy per category and overall ('total'), with the quality tier of each.

    The overall row is rolled up from the per-category counts.
    """
    per = df.groupBy(category).agg(
        F.count_if(F.col(expected) == F.col(predicted)).alias("aciertos"),
        F.count(F.lit(1)).alias("total"))
    rolled = per.rollup(category).agg(F.grouping(category).alias("_g"),
                                      F.sum("aciertos").cast("bigint").alias("aciertos"),
                                      F.sum("total").cast("bigint").alias("total"))
    accuracy = ratio(F.col("aciertos"), F.col("total"))
    return rolled.select(
        F.when(F.col("_g") == 1, "total").otherwise(F.col(category)).alias("categoria"),
        "aciertos", "total", accuracy.alias("precision"),
        F.when(accuracy >= 0.8, "excelente").when(accuracy >= 0.7, "bueno")
        .otherwise("insuficiente").alias("nivel"))
