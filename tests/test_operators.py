import hashlib
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veleta.operators import ab, concepts as C, evaluate as E, features as X, labels as L
from veleta.operators import langmodel, ontology as O, profile, questions as Q, ranks, triples as T
from veleta.operators.dedup import dedup_report, first_by_text, latest_by_key
from veleta.functions import vocab as V


def skewed(spark, n=3000):
    """One value and one key own a third of the rows."""
    third = F.col("id") % 3 == 0
    return spark.range(n).select(
        "id", F.when(third, 0).otherwise(F.col("id") * 7919 % 501).cast("double").alias("v"),
        F.when(third, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"),
        (F.col("id") * 104729 % 1009).cast("double").alias("w"))


def test_latest_by_key_hot(spark):
    df = skewed(spark).select("k", F.col("id").cast("double").alias("_ingest_ts"), "v")
    got = {r.k: r._ingest_ts for r in latest_by_key(df, "k").collect()}
    want = df.toPandas().groupby("k")._ingest_ts.max().to_dict()
    assert got == want
    plan = latest_by_key(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    same = df.select("k", F.lit(1.0).alias("_ingest_ts"), "v")
    assert sorted(map(tuple, latest_by_key(same, "k").collect())) == sorted(
        map(tuple, latest_by_key(same.repartition(7), "k").collect()))


def test_text_dedup_and_report(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "id string, t string")
    assert {tuple(r) for r in first_by_text(df, "t").collect()} == {("a", "x"), ("c", "y")}
    assert tuple(dedup_report(df.union(df)).first()) == (6, 3, 3)


def test_running_sum_hot_key(spark):
    df = skewed(spark)
    got = ranks.running_sum(df, ["k"], ["w", "id"], "v").toPandas().set_index("id").sort_index()
    pdf = df.toPandas().sort_values(["k", "w", "id"])
    want = pdf.groupby("k").v.cumsum() - pdf.v
    want.index = pdf.id
    assert np.allclose(got.antes, want.sort_index())
    counts = pdf.groupby("k").cumcount()
    counts.index = pdf.id
    assert (got.antes_n.values == counts.sort_index().values).all()


def test_quantiles_and_describe(spark):
    df = skewed(spark)
    pdf = df.toPandas()
    got = {(r.columna, r.q): r.valor for r in ranks.quantiles(df, ["v", "w"], [0, .25, .999, 1]).collect()}
    for c in ("v", "w"):
        for q in (0, .25, .999, 1):
            assert got[c, q] == pytest.approx(pdf[c].quantile(q))
    d = profile.numeric_describe(df, ["v", "w"]).toPandas().set_index("columna")
    want = pdf[["v", "w"]].describe().T
    assert np.allclose(d.loc[["v", "w"], ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]],
                       want.values)


def test_spearman_ties(spark):
    df = skewed(spark).withColumn("z", F.col("v") * 2 - F.col("w") / 100)
    got = ranks.spearman(df, ["v", "w", "z"]).toPandas().pivot(
        index="variable_a", columns="variable_b", values="rho")
    assert np.allclose(got, df.toPandas()[["v", "w", "z"]].corr(method="spearman"))


def test_months_with_gap(spark):
    df = spark.sql("select explode(array(timestamp'2024-01-05', timestamp'2024-01-06', timestamp'2024-04-01')) t")
    m = profile.rolling_mean(profile.posts_per_month(df, "t")).orderBy("mes").collect()
    assert [(str(r.mes), r.n, round(r.media_movil, 3)) for r in m] == [
        ("2024-01-01", 2, 2.0), ("2024-02-01", 0, 1.0), ("2024-03-01", 0, 0.667), ("2024-04-01", 1, 0.333)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0, 5, 10)], "x double")
    n = [r.n for r in profile.histogram(df, ["x"], 5).orderBy("bin").collect()]
    assert n == [2, 0, 1, 0, 1]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert profile.histogram(flat, ["x"], 4).agg(F.sum("n")).first()[0] == 2


def test_profiles(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "q", None), ("c", "r", None)], "id string, s string, n bigint")
    assert [tuple(r) for r in profile.null_profile(df).collect()][0][0] == "n"
    d = {r.columna: r for r in profile.variable_dictionary(df).collect()}
    assert d["s"].ejemplo == "q" and d["n"].ejemplo == "1" and d["n"].dtype == "bigint"


def posts(spark):
    return spark.createDataFrame(
        [("p1", "La IA y el machine learning", "Robot, robot! ia. machine  learning machine-learning"),
         ("p2", "robots", None), ("p3", "IA?", "robot machine learning robot")],
        "id string, titulo string, texto string")


def in_row(df, d):
    names = C.dictionary_metadata(d)
    rows = df.select("id", C.count_expressions(F.coalesce("titulo", F.lit("")), names).alias("t"),
                     C.count_expressions(F.coalesce("texto", F.lit("")), names).alias("x")).collect()
    return sorted((r.id, c, r.t[i], r.x[i]) for r in rows for i, c in enumerate(names) if r.t[i] + r.x[i])


def test_concept_routes_agree(spark):
    d = spark.createDataFrame([("IA", "ia"), ("IA", "robot"), ("ML", "learning")], "concepto string, sinonimo string")
    joined = sorted(map(tuple, C.concept_counts(posts(spark), d).collect()))
    assert joined == in_row(posts(spark), d) == [("p1", "IA", 1, 3), ("p1", "ML", 1, 2), ("p3", "IA", 1, 2), ("p3", "ML", 0, 1)]


def test_concept_phrases(spark):
    d = spark.createDataFrame([("ML", "machine learning"), ("ML", "robot")], "concepto string, sinonimo string")
    got = {r.id: (r.n_titulo, r.n_texto) for r in C.concept_counts(posts(spark), d).collect()}
    assert got == {"p1": (1, 2), "p3": (0, 3)}  # a phrase matches as written, not across other blanks


def test_concept_symbols_and_overlaps(spark):
    d = spark.createDataFrame([("x", "new york"), ("x", "york"), ("y", "c++"), ("w", "b b"), ("z", "++"), ("e", " "), ("q", r"a\qb")],
                              "concepto string, sinonimo string")
    p = spark.createDataFrame([(1, "new york", "york"), (2, "I like c++ and c", "x"), (3, "new-york new  york", "b b b"),
                               (4, "vitamin c", None), (5, r"a\qb", "+++")], "id bigint, titulo string, texto string")
    want = [(1, "x", 1, 1), (2, "y", 1, 0), (3, "w", 0, 1), (3, "x", 2, 0), (5, "q", 1, 0), (5, "z", 0, 1)]
    assert sorted(map(tuple, C.concept_counts(p, d).collect())) == want == in_row(p, d)


def test_concept_matcher_on_random_texts(spark):
    """Nested, touching, symbol-only and blank-edged synonyms against one pattern per concept."""
    r = random.Random(8)
    pieces = ["a", "b", "ab", "é", "+", "-", ".", " ", "  ", "\n", "a b", "a-b", "\u00a0"]
    text = lambda n: "".join(r.choice(pieces) for _ in range(r.randint(0, n)))
    for trial in range(3):
        d = [(f"c{r.randrange(4)}", text(4)) for _ in range(14)] + ([("c0", " a"), ("c1", "b ")] if trial else [])
        d = spark.createDataFrame([x for x in d if x[1].strip()], "concepto string, sinonimo string")
        p = spark.createDataFrame([(i, text(25), text(40)) for i in range(40)], "id bigint, titulo string, texto string")
        assert sorted(map(tuple, C.concept_counts(p, d).collect())) == in_row(p, d)


def test_concept_matcher_has_one_plan_for_all_dictionaries(spark):
    """50,000 synonyms: the plan has the steps of a plan for two, and the text is read once."""
    few = spark.createDataFrame([("a", "ia"), ("b", "machine learning")], "concepto string, sinonimo string")
    some, many = (spark.range(n).selectExpr("'c' || id % 700 as concepto", "'palabra ' || id as sinonimo").unionByName(few) for n in (5, 50_000))
    size = lambda d: len(C.concept_counts(posts(spark), d)._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(many) == size(some)
    assert sorted(map(tuple, C.concept_counts(posts(spark), many).collect())) == sorted(map(tuple, C.concept_counts(posts(spark), few).collect()))


def silver(spark):
    return spark.sql("""select 'p1' id, 'HOLA?' titulo, 'a  b' texto, timestamp'2024-01-07 23:10:00' fecha_creacion,
      10L puntaje, 0L total_comentarios, 0.5D ratio_upvotes, true es_adulto, false es_video, true es_texto,
      cast(null as bigint) subreddit_suscriptores""")


def test_features(spark):
    r = X.features_a(silver(spark)).first()
    assert (r.long_titulo, r.palabras_texto, r.hora_dia, r.dia_semana) == (5, 3, 23, 7)
    assert (r.interaccion_proxy, r.ratio_puntos_comentarios, r.contiene_pregunta) == (10, 10.0, True)
    assert (r.titulo_mayusculas, r.es_adulto_int, r.suscriptores_subreddit) == (True, 1, 0)
    text_time = silver(spark).withColumn("fecha_creacion", F.lit("2024-01-07T23:10:00+00:00"))
    assert X.features_a(text_time).first().hora_dia == 23
    d = spark.createDataFrame([("saludo", "hola")], "concepto string, sinonimo string")
    b = X.features_b(silver(spark), d)
    assert (b.first().n_saludo_titulo, b.first().es_saludo, b.first().diversidad_conceptos_titulo) == (1, True, 1)
    assert (b.first().total_conceptos_titulo, b.first().diversidad_conceptos_texto) == (1, 0)
    cols = X.matrix_columns_b(b)
    assert "es_texto" in cols and "total_comentarios" in cols and "titulo_mayusculas" not in cols
    few = X.matrix_a(X.features_a(silver(spark)).drop("hora_dia"), ["id"])
    assert len(few.columns) == 11 and few.first()["relleno_9"] == 0.0
    with pytest.raises(ValueError):
        X.matrix_columns_a(["long_titulo"])


def test_ab_columns(spark):
    a = spark.createDataFrame([("1", "t", "s", "x", 1, .9, "a")],
                              "id string, fecha_creacion string, subreddit_nombre string, titulo string, prediccion int, probabilidad double, modelo string")
    j = ab.ab_join(a, a.withColumn("modelo", F.lit("b")))
    assert {"titulo", "titulo_b", "prediccion_a", "prediccion_b", "modelo_b"} <= set(j.columns)
    assert [r.ventana for r in ab.ab_metrics(j).orderBy("ventana").collect()] == ["global", "s"]
    assert ab.ab_metrics(j.filter("false")).collect() == []


def weak(spark, neu_low):
    rows = [(f"h{i}", "pos", 2, .1, .1, .8) for i in range(5)] + [(f"n{i}", "neg", 0, .8, .1, .1) for i in range(5)]
    rows += [(f"u{i:03d}", "neu", 1, .3, p, .7 - p) for i, p in enumerate(neu_low)]
    return spark.createDataFrame(rows, "id string, sentimiento_label string, label int, p_neg double, p_neu double, p_pos double")


def test_neutral_mining(spark):
    df = weak(spark, [.5] * 2 + [.36, .40, .44, .41])
    got = L.mine_neutrals(df, target=4)
    assert {r.id for r in got.filter("minado").collect()} == {"u004", "u005"}
    rated = L.with_confidence(df)
    extra = L.relax_neutrals(rated, rated.filter("alta_confianza"), target=10)
    assert {r.id for r in extra.collect()} == {"u003", "u004", "u005"}
    assert L.mine_neutrals(df, target=2).filter("minado").count() == 0


def test_binary_fallback(spark):
    df = weak(spark, [.5])
    assert {r.label for r in L.binary_fallback(df).collect()} == {0, 2}
    assert L.binary_fallback(weak(spark, [.5, .5])).count() == 12
    with pytest.raises(Exception, match="fewer than two classes"):
        L.binary_fallback(df.filter("label = 0")).collect()


def test_splits(spark):
    df = skewed(spark).select(F.concat(F.lit("d"), "id").alias("id"), F.when(F.col("k") == "hot", 0)
                              .otherwise(F.col("w") % 2 + 1).cast("int").alias("label"))
    exact = L.ranked_split(df).toPandas()
    assert len(exact) == 3000 and exact.id.is_unique
    for _, g in exact.groupby("label"):
        n = g.particion.value_counts()
        assert abs(n["train"] - .8 * len(g)) <= 1 and abs(n["val"] - .1 * len(g)) <= 1
    quick = L.hash_split(df).toPandas()
    assert abs((quick.particion == "train").mean() - .8) < .03


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(2,)] * 2, "label int")
    w = {r.label: r.peso for r in L.class_weights(df).collect()}
    assert w == {0: pytest.approx(.5), 2: pytest.approx(1.5)}
    e = L.weight_of(L.class_weights(df), F.col("label"))
    assert spark.createDataFrame([(1,)], "label int").select(e).first()[0] == 1.0


def test_evaluation(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (2, 2), (2, 2)], "label int, prediccion int")
    r = {x.clase: x for x in E.classification_report(df).collect()}
    assert r["1"].precision == 0.0 and r["1"].support == 0
    assert r["0"].recall == .5 and r["2"].precision == pytest.approx(2 / 3)
    assert r["accuracy"].f1 == .75
    assert r["weighted avg"].recall == pytest.approx(.75)
    assert sum(x.n for x in E.confusion_matrix(df).collect()) == 4
    v = E.validation_accuracy(spark.createDataFrame(
        [("a", 1, 1)] * 4 + [("a", 1, 2)], "c string, e int, p int"), "c", "e", "p").collect()
    assert {(x.categoria, x.nivel) for x in v} == {("a", "excelente"), ("total", "excelente")}


def graph_rows(spark):
    cols = """id string, titulo string, texto string, autor string, subreddit_nombre string, fecha_creacion_utc double,
      puntaje bigint, total_comentarios bigint, url string, es_texto boolean, es_video boolean, es_galeria boolean,
      pista_contenido string, dominio string"""
    return spark.createDataFrame([
        ("a", "T", "x", "ana", "Technology", 1.7e9, 500, 1, "u", True, False, False, None, "d e"),
        ("b", "", None, "[deleted]", " technology ", 0.0, 50, 0, None, False, True, True, None, ""),
        ("c", "T", "", None, None, None, 300, 2, "", None, None, None, "link", None),
        (None, "T", "x", "ana", "health", 1.7e9, 1, 1, "u", True, False, False, None, "d")], cols)


def test_triples(spark):
    rows = T.triples(graph_rows(spark)).collect()
    assert len(rows) == len(set(rows))
    assert {tuple(r) for r in rows} == {tuple(r) for r in T.triple_view(graph_rows(spark)).collect()}
    assert T.triples(graph_rows(spark).unionAll(graph_rows(spark)), unique_ids=False).count() == len(rows)
    assert T.rdf_stats(graph_rows(spark)).first().total_triples == len(rows)
    by = {}
    for r in rows:
        by.setdefault(r.s.rsplit("/", 1)[-1], []).append(r.p.split("#")[-1].rsplit("/", 1)[-1])
    assert "hasAuthor" not in by["b"] and "title" not in by["b"] and "generatedAtTime" not in by["b"]
    assert "hasSubreddit" not in by["c"] and "url" not in by["c"]
    assert len(by["a"]) == 14


def test_questions_on_stored_table(spark):
    g = T.triples(graph_rows(spark))
    assert Q.missing_subreddit(g).first().n == 1
    assert [tuple(r) for r in Q.high_score_tech(g).collect()] == [("a", 500, "technology")]
    assert [tuple(r) for r in Q.posts_by_subreddit(g).collect()] == [(V.BASE + "r/technology", 2)]
    assert [r.post_id for r in Q.technology_posts(g, 10).collect()] == ["a", "b"]
    f = {r.reddit_id: r for r in Q.semantic_features(g).collect()}
    assert f["c"].topic is None and f["c"].post_type == "LinkPost" and f["b"].post_type == "VideoPost"
    assert {tuple(r) for r in Q.semantic_distribution(Q.semantic_features(g)).collect()} >= {("topic", None, 1)}


def test_stored_source_prunes(spark, folder):
    from veleta.sources.tables import triple_source, write_triples

    write_triples(T.triples(graph_rows(spark)), folder + "/t")
    g = triple_source(spark, folder + "/t")
    assert g().count() == T.triples(graph_rows(spark)).count()
    assert [tuple(r) for r in Q.high_score_tech(g).collect()] == [("a", 500, "technology")]
    plan = g(V.RR + "score")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [predicado" in plan or "(predicado#" in plan.split("PartitionFilters")[1][:80]
    assert T.statement_source(graph_rows(spark))("http://none").count() == 0


def test_ontology_golden(spark):
    c = O.oquare_counts(O.ontology_triples(spark), T.triples(graph_rows(spark)).limit(0)).first()
    assert (c.clases, c.propiedades_objeto, c.propiedades_datos, c.propiedades_anotacion,
            c.relaciones_jerarquicas, c.instancias) == (13, 11, 97, 0, 16, 0)
    m = O.oquare_metrics(spark.createDataFrame([c])).first()
    assert (round(m.rronto, 4), round(m.aronto, 4), round(m.inronto, 4)) == (.1888, 7.4615, 1.3333)


def test_ontology_checks(spark):
    g = T.triples(graph_rows(spark))
    bad = {(r.post, r.propiedad): r.n for r in O.cardinality_violations(g).collect()}
    assert bad == {("b", "titulo"): 0, ("b", "fecha_creacion"): 0, ("b", "tieneAutor"): 0,
                   ("c", "fecha_creacion"): 0, ("c", "tieneAutor"): 0, ("c", "perteneceASubreddit"): 0}
    types = O.type_membership(graph_rows(spark))
    assert [tuple(r) for r in O.disjoint_violations(types).collect()] == [("b", "PublicacionVideo", "PublicacionGaleria")]
    assert ("b", "Publicacion") in {tuple(r) for r in O.subclass_closure(types).collect()}


def test_author_history_hot_author(spark):
    df = skewed(spark).select("id", F.col("k").alias("autor"), F.col("w").alias("fecha_creacion_utc"),
                              F.col("v").alias("valor_sentimiento"))
    got = O.author_history(df).toPandas().set_index("id").historial.sort_index()
    pdf = df.toPandas().sort_values(["autor", "fecha_creacion_utc", "id"])
    want = pdf.groupby("autor").valor_sentimiento.transform(lambda s: s.expanding().mean().shift())
    want.index = pdf.id
    pd.testing.assert_series_equal(got, want.sort_index(), check_names=False)


def test_token_sample_with_a_repeated_key(spark):
    """A third of the rows has one key of a late digest; the sample is full all the same."""
    hot = next(k for k in map(str, range(100000, 200000)) if hashlib.md5(f"{k}|42".encode()).hexdigest() > "f")
    rows = spark.range(60000).select(F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id").cast("string")).alias("k"))
    assert profile.token_stats(rows, "k", F.lit(1)).first().muestra == 20000


def test_token_sample_leaves_rows_without_key_to_the_end(spark):
    for n in (300, 3000):
        rows = spark.range(n + 50).select(F.when(F.col("id") < n, F.col("id").cast("string")).alias("k"))
        tokens = F.when(F.col("k").isNull(), 9).otherwise(1)
        assert profile.token_stats(rows, "k", tokens, sample=100).first().max == 1
        assert profile.token_stats(rows, "k", tokens, sample=n + 10).first().max == 9


def test_language_model_on_held_out_texts(spark, folder):
    """Fitted on one half of the documents, right on the other: macro accuracy over the languages."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    half = F.xxhash64("doc_id") % 2 == 0
    model = langmodel.fit(docs.filter(half), "text", "lang")
    rows = docs.filter(~half).select("lang", (model.language(F.col("text")) == F.col("lang")).cast("int").alias("ok"))
    shares = [r[0] for r in rows.groupBy("lang").agg(F.avg("ok")).select("avg(ok)").collect()]
    assert len(shares) == 4 and sum(shares) / 4 >= 0.95
    model.save(spark, folder + "/model")
    again = langmodel.load(spark, folder + "/model")
    assert again == model


def test_language_model_of_odd_texts(spark):
    rows = [("abc abd", "x"), ("xyz xyw", "y"), (None, "x"), ("", "y"), ("123 !", "y"), ("éé", None)]
    texts = spark.createDataFrame(rows, "t string, l string")
    model = langmodel.fit(texts, "t", "l")
    got = [r[0] for r in texts.select(model.language(F.col("t"))).collect()]
    assert got[:5] == ["x", "y", "und", "und", "und"] and got[5] in ("x", "y")
    many = spark.range(70).selectExpr("'a' as t", "'l' || id as l")
    with pytest.raises(ValueError, match="languages"):
        langmodel.fit(many, "t", "l")
    none = langmodel.fit(texts.limit(0), "t", "l")
    assert texts.select(none.language(F.col("t"))).distinct().first()[0] == "und"


def test_language_scores_count_code_points_and_long_texts(spark, monkeypatch):
    """Sums equal those by hand, also for letters beyond 16 bits, with a text longer than a slice among blank ones."""
    monkeypatch.setattr(langmodel, "SLICE", 64)
    rows = [("Äbc, \U00010400\U00010401\U00010402x", "a"), ("", "b"), ("palabra larga " * 20, "b"), ("7", "a"), ("zz", "a"), (None, "b")]
    texts = spark.createDataFrame(rows, "t string, l string").coalesce(1)
    model = langmodel.fit(texts, "t", "l", buckets=97)

    def found(text):
        folded = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        p = [ord(c) for c in f" {' '.join(folded.split())} "]
        return [(p[i] + 127 * p[i + 1] + 16129 * p[i + 2]) % 97 for i in range(len(p) - 2)]

    for lang in "ab":
        seen = Counter(b for t, l in rows if l == lang for b in found(t))
        assert model.weights[lang] == [math.floor(1000 * math.log((seen[b] + 1) / (seen.total() + 97))) for b in range(97)]
    got = [r[0] for r in texts.select(model.scores(F.col("t"))).collect()]
    want = [[(sum(model.weights[lang][b] for b in found(t)), lang) for lang in "ab"] if found(t) else None for t, _ in rows]
    assert [x and [tuple(y) for y in x] for x in got] == want


def test_closure_of_odd_hierarchies(spark):
    """Self loops, cycles, repeated and null edges, a diamond and a long chain."""
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d"), ("a", "b"), (None, "x"), ("y", None),
             ("p", "q"), ("p", "r"), ("q", "t"), ("r", "t")] + [(f"n{k}", f"n{k + 1}") for k in range(9)]
    up = {}
    for s, o in edges:
        if s and o:
            up.setdefault(s, set()).add(o)
            up.setdefault(o, set())
    want = set()
    for s in up:
        seen, todo = {s}, [s]
        while todo:
            new = up[todo.pop()] - seen
            seen |= new
            todo += new
        want |= {(s, t) for t in seen}
    got = O.closure(spark.createDataFrame(edges, "s string, o string")).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    types = spark.createDataFrame([(1, "n7"), (1, "n8"), (2, "unknown")], "id int, clase string")
    members = O.members_of(types, spark.createDataFrame(sorted(want), "sub string, top string"))
    assert sorted(map(tuple, members.collect())) == [(1, "n7"), (1, "n8"), (1, "n9"), (2, "unknown")]
    assert O.closure(spark.createDataFrame([], "s string, o string")).count() == 0


def test_closure_doubles_its_reach(spark, monkeypatch):
    """A chain of 40 classes with a short cut and a cycle at its top: few rounds, every pair once."""
    steps, durable = [], O.durable
    monkeypatch.setattr(O, "durable", lambda df: steps.append(1) or durable(df))
    edges = [(f"k{i}", f"k{i + 1}") for i in range(39)] + [("k3", "k20"), ("k39", "k37"), ("k5", "k5")]
    up = {a: {b for x, b in edges if x == a} for a in {x for e in edges for x in e}}
    want = set()
    for a in up:
        seen, todo = {a}, [a]
        while todo:
            new = up[todo.pop()] - seen
            seen |= new
            todo += new
        want |= {(a, b) for b in seen}
    got = list(map(tuple, O.closure(spark.createDataFrame(edges, "s string, o string")).collect()))
    assert len(got) == len(want) and set(got) == want and len(steps) <= 9
