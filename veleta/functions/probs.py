"""Expressions over class probabilities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veleta.functions.once import bind

# Label ids, display names and thresholds.
LABEL_IDS = {"neg": 0, "neu": 1, "pos": 2}
DISPLAY = ("Negativo", "Neutro", "Positivo")
BLANK_NAME, BLANK_CONFIDENCE, BLANK_PROBS = "Neutro", 0.33, (0.33, 0.34, 0.33)
HIGH_CONFIDENCE = {"neg": 0.60, "neu": 0.45, "pos": 0.60}
NEUTRAL_TARGET = 60
RELAXED_FLOOR = 0.38


def label_id(c: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in LABEL_IDS.items() for x in kv])[c]


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, shifted by the maximum so large values are safe."""
    def shares(powers: Column) -> Column:
        total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
        return bind(total, lambda t: F.transform(powers, lambda x: x / t))

    powers = bind(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))
    return bind(powers, shares)


def argmax(values: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def star_label(p1: Column, p2: Column, p3: Column, p4: Column, p5: Column) -> Column:
    """Three-way label of the most probable star; the first maximum wins."""
    top = F.greatest(p1, p2, p3, p4, p5)
    return F.when((p1 == top) | (p2 == top), "neg").when(p3 == top, "neu").otherwise("pos")


def confident(label: Column, p_neg: Column, p_neu: Column, p_pos: Column) -> Column:
    """Does the probability of the row's own label reach its threshold?"""
    own = {"neg": p_neg, "neu": p_neu, "pos": p_pos}
    out = F.lit(False)
    for name, least in HIGH_CONFIDENCE.items():
        out = F.when(label == name, own[name] >= least).otherwise(out)
    return F.coalesce(out, F.lit(False))


def neutral_margin(p_neg: Column, p_neu: Column, p_pos: Column) -> Column:
    return p_neu - F.greatest(p_neg, p_pos)


def prediction_record(text: Column, probs: Column) -> Column:
    """Struct (prediction, confidence, probabilities); blank text gets the fixed neutral record."""
    blank = F.coalesce(text, F.lit("")).rlike(r"^[\s\x0b\x1c-\x1f\x85\p{Z}]*$")
    pick = argmax(probs)
    names = F.array(*[F.lit(n) for n in DISPLAY])
    return F.struct(
        F.when(blank, F.lit(BLANK_NAME)).otherwise(F.get(names, pick)).alias("prediction"),
        F.when(blank, F.lit(BLANK_CONFIDENCE)).otherwise(F.array_max(probs)).alias("confidence"),
        F.when(blank, F.array(*[F.lit(p) for p in BLANK_PROBS])).otherwise(probs)
        .alias("probabilities"),
    )


def sentiment_value(p_neg: Column, p_pos: Column) -> Column:
    """Signed strength in -1 … 1."""
    return p_pos - p_neg


def intensity_bucket(strength: Column) -> Column:
    """Low [0, .3), medium [.3, .7), high [.7, 1]."""
    return (F.when(strength < 0.3, "IntensidadBaja").when(strength < 0.7, "IntensidadMedia")
            .when(strength <= 1.0, "IntensidadAlta"))
