from pyspark.sql import Row, functions as F

from veleta.functions import lang, probs as P, text as X, values as N, vocab as V


def one(spark, expr, **cols):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in cols.items())
    df = spark.createDataFrame([tuple(v for _, v in cols.values())], schema)
    return df.select(expr.alias("r")).first()[0]


def text(spark, fn, value):
    return one(spark, fn(F.col("c")), c=("string", value))


def test_clean_text(spark):
    clean = lambda s: text(spark, X.clean_text, s)
    assert clean(None) == "" and clean("   ") == ""
    assert clean("Ver HTTPS://Foo.bar/x?y=1#frag  ahora") == "ver #frag ahora"
    assert clean("hola @Pepe_1 y /u/Ana y u/otro fin") == "hola y y fin"
    assert clean("menu/item") == "men"
    assert clean("a  \t\n b ") == "a b"
    assert clean("señor @ñandú!") == "señor !"
    keep = lambda c: X.clean_text(c, collapse=False)
    assert text(spark, keep, "  a   b  ") == "a   b"


def test_long_address_is_safe(spark):
    assert text(spark, X.clean_text, "x http://a.b/" + "q" * 50000 + " y") == "x y"


def test_clean_basic(spark):
    basic = lambda s: text(spark, X.clean_basic, s)
    assert basic(None) == ""
    assert basic("Ver http://a.b/c y www.x.y\r\n\tFIN  ya") == "ver y fin ya"
    assert basic("HTTP://NO.borra") == "http://no.borra"


def test_model_text(spark):
    go = lambda t, b, tl, bl: one(spark, X.model_text(*map(F.col, "abcd")), a=("string", t),
                                  b=("string", b), c=("string", tl), d=("string", bl))
    assert go("T", "B", "t", "b") == "t\nb"
    assert go("T  X", "B", "", "b") == "t x\nb"
    assert go("T", "", "t", "") == "t"
    assert go(None, None, None, None) == ""


def test_counts(spark):
    count = lambda s: text(spark, X.word_count, s)
    assert [count(""), count("a"), count("a  b ")] == [1, 1, 4]
    assert text(spark, X.token_count, "¡Hola, mundo_1!") == 2


def test_dirty_numbers(spark):
    d = lambda s: text(spark, N.dirty_double, s)
    b = lambda s: text(spark, N.dirty_bigint, s)
    assert [d("$1.5k"), d("1.5e-7"), d(None), d("-2"), d("--")] == [1.5, 0.0, 0.0, -2.0, 0.0]
    assert [b("1,234"), b("abc"), b(None), b("3-4"), b("true")] == [1234, 0, 0, 0, 0]


def test_language(spark):
    go = lambda s: text(spark, lang.language, s)
    assert go("this is the end of the story") == "en"
    assert go("el perro y los gatos que duermen") == "es"
    assert go("12345 !!!") == "und" and go("") == "und"


def test_softmax_and_argmax(spark):
    p = one(spark, P.softmax(F.col("l")), l=("array<double>", [1000.0, 1000.0, 0.0]))
    assert p == [0.5, 0.5, 0.0]
    assert one(spark, P.argmax(F.col("l")), l=("array<double>", [1.0, 3.0, 3.0])) == 1


def test_star_label_first_maximum_wins(spark):
    def go(*p):
        return one(spark, P.star_label(*[F.col(f"p{i}") for i in range(5)]),
                   **{f"p{i}": ("double", x) for i, x in enumerate(p)})
    assert go(.1, .3, .3, .2, .1) == "neg"
    assert go(.1, .1, .4, .4, .0) == "neu"
    assert go(.1, .1, .2, .2, .4) == "pos"


def test_prediction_record(spark):
    go = lambda t: one(spark, P.prediction_record(F.col("t"), F.array(F.lit(.2), F.lit(.1), F.lit(.7))),
                       t=("string", t))
    assert go("x") == Row(prediction="Positivo", confidence=.7, probabilities=[.2, .1, .7])
    assert go(" \n ") == Row(prediction="Neutro", confidence=.33, probabilities=[.33, .34, .33])
    assert go(None).prediction == "Neutro"


def test_intensity_edges(spark):
    go = lambda x: one(spark, P.intensity_bucket(F.col("x")), x=("double", x))
    assert [go(0.0), go(0.3), go(0.7), go(1.0)] == [
        "IntensidadBaja", "IntensidadMedia", "IntensidadAlta", "IntensidadAlta"]


def test_vocabulary(spark):
    assert text(spark, V.norm_subreddit, "  TechNews ") == "technews"
    assert text(spark, V.norm_subreddit, "  ") is None
    assert text(spark, V.topic, "Health") == "Health" and text(spark, V.topic, "cats") is None
    assert text(spark, V.coarse_topic, "Programming") == "Technology"
    assert text(spark, V.iri_safe, "a b/c") == "a_b_c"
    kind = lambda *f: one(spark, V.post_type(*map(F.col, "abcd")), a=("boolean", f[0]),
                          b=("boolean", f[1]), c=("boolean", f[2]), d=("string", f[3]))
    assert kind(None, None, None, "link") == "LinkPost"
    assert kind(True, True, True, "link") == "TextPost"
    assert kind(False, True, True, "link") == "VideoPost"
    assert kind(None, False, True, None) == "GalleryPost"
    assert kind(False, False, False, "image") == "TextPost"
