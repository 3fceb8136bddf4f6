"""Classifiers as Spark ML pipelines: train on real labels, store, load and score."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from veleta.functions.text import NOT_WORD
from veleta.operators.labels import class_weights, weight_of


def balanced_weight(df: DataFrame, label: str = "label") -> tuple[Column, float]:
    """n / (classes · class size) as an expression, and the sum of all weights.

    One count per class comes to the driver.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    total = sum(counts.values())
    out = F.lit(1.0)
    for k, n in counts.items():
        out = F.when(F.col(label) == k, F.lit(total / (len(counts) * n))).otherwise(out)
    return out, float(total)


def train_a(matrix: DataFrame, features: list[str], label: str = "label", c: float = 1.0,
            max_iter: int = 100) -> PipelineModel:
    """Class-balanced logistic regression; inverse strength ``c`` becomes a per-weight penalty."""
    weight, total = balanced_weight(matrix, label)
    data = matrix.withColumn("_w", weight)
    model = LogisticRegression(labelCol=label, weightCol="_w", regParam=1.0 / (c * total),
                               elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"),
                            model]).fit(data)


def train_b(matrix: DataFrame, features: list[str], label: str = "label", trees: int = 50,
            depth: int = 10, seed: int = 42) -> PipelineModel:
    """Class-balanced random forest."""
    weight, _ = balanced_weight(matrix, label)
    model = RandomForestClassifier(labelCol=label, weightCol="_w", numTrees=trees, maxDepth=depth,
                                   seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"),
                            model]).fit(matrix.withColumn("_w", weight))


def predict(model: PipelineModel, matrix: DataFrame, name: str, stamp: Column | None = None,
            keep: tuple[str, ...] = ("id", "fecha_creacion", "subreddit_nombre", "titulo")
            ) -> DataFrame:
    """Prediction table: keys, class, probability of class 1, model name and time."""
    out = model.transform(matrix)
    cols = [F.col(c) for c in keep if c in matrix.columns]
    extra = [] if stamp is None else [stamp.alias("ts_prediccion")]
    return out.select(*cols, F.col("prediction").cast("int").alias("prediccion"),
                      F.get(vector_to_array("probability"), F.lit(1)).alias("probabilidad"),
                      F.lit(name).alias("modelo"), *extra)


def load_or_train(path: str, train: Callable[[], PipelineModel] | None) -> PipelineModel:
    """The stored model, or a freshly trained and stored one; never an untrained stand-in."""
    try:
        return PipelineModel.load(path)
    except Py4JJavaError as problem:
        # Any other trouble must not replace a stored model.
        if train is None or "Input path does not exist" not in str(problem.java_exception):
            raise
    except AnalysisException as problem:
        if train is None or problem.getCondition() != "PATH_NOT_FOUND":
            raise
    model = train()
    model.write().overwrite().save(path)
    return model


def train_sentiment(train: DataFrame, val: DataFrame, text: str = "texto_model",
                    label: str = "label", features: int = 1 << 16,
                    strengths: tuple[float, ...] = (0.001, 0.01),
                    max_iter: int = 30, least_documents: int = 2) -> tuple[PipelineModel, float]:
    """Three-class text classifier with class-weighted loss; the penalty is chosen by macro F1
    on the validation part.  Texts are cut into words and counted once, for all fits; words of
    fewer than ``least_documents`` training texts get no weight."""
    words = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=NOT_WORD, toLowercase=True)
    hashed = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features)
    counted = lambda df: hashed.transform(words.transform(df)).select(label, "_tf").persist()
    known, held = counted(train), counted(val)
    best: tuple[PipelineModel, float] | None = None
    try:
        idf = IDF(inputCol="_tf", outputCol="features", minDocFreq=least_documents).fit(known)
        weight = weight_of(class_weights(known, label).withColumnRenamed(label, "label"), F.col(label))
        ready = idf.transform(known).select(label, "features").withColumn("_w", weight)
        for strength in strengths:
            fitted = LogisticRegression(labelCol=label, weightCol="_w", family="multinomial",
                                        regParam=strength, maxIter=max_iter).fit(ready)
            score = macro_f1(fitted.transform(idf.transform(held)), label)
            if best is None or score > best[1]:
                best = (PipelineModel(stages=[words, hashed, idf, fitted]), score)
    finally:
        known.unpersist()
        held.unpersist()
    return best


def macro_f1(scored: DataFrame, label: str = "label") -> float:
    """Mean F1 over the classes present.  One aggregation; a handful of cells reach the driver."""
    cells = {(int(r[0]), int(r[1])): r[2] for r in
             scored.groupBy(label, "prediction").count().collect()}
    classes = {k for k, _ in cells}
    f1 = []
    for k in classes:
        hits = cells.get((k, k), 0)
        both = sum(n for (r, p), n in cells.items() for side in (r, p) if side == k)
        f1.append(2 * hits / both if both else 0.0)
    return sum(f1) / len(f1) if f1 else 0.0


def score_sentiment(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``probs`` (class probabilities) and ``prediccion``."""
    out = model.transform(df)
    return out.withColumn("probs", vector_to_array("probability")) \
        .withColumn("prediccion", F.col("prediction").cast("int")) \
        .drop("_tokens", "_tf", "features", "rawPrediction", "probability", "prediction")


def score_with(df: DataFrame, load: Callable[[], Callable], text: str = "texto_model",
               out: str = "probs", batch: int = 32) -> DataFrame:
    """Score with an external model: ``load`` runs once per task and returns a function from a
    list of texts to a list of probability lists.  The only Python in the row path."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(frames: Iterator):
        model = load()
        for frame in frames:
            texts = frame[text].fillna("").tolist()
            scored = []
            for i in range(0, len(texts), batch):
                scored.extend(model(texts[i:i + batch]))
            yield frame.assign(**{out: [[float(x) for x in row] for row in scored]})

    return df.mapInPandas(run, schema)
