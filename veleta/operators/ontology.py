"""The ontology as a small triple table, quality measures and rule checks.

Only rules that are ordinary table work are evaluated; there is no reasoner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veleta.functions import vocab as V
from veleta.operators.ranks import running_sum
from veleta.operators.triples import COLUMNS, source_of
from veleta.schemas import FIELDS
from veleta.session import durable

# Classes with their superclass.
CLASSES = {
    "Publicacion": None,
    "Autor": None,
    "Subreddit": None,
    "PublicacionTexto": "Publicacion",
    "PublicacionVideo": "Publicacion",
    "PublicacionGaleria": "Publicacion",
    "PostPositivo": "Publicacion",
    "PostNegativo": "Publicacion",
    "PostNeutral": "Publicacion",
    "IntensidadEmocional": None,
    "IntensidadBaja": "IntensidadEmocional",
    "IntensidadMedia": "IntensidadEmocional",
    "IntensidadAlta": "IntensidadEmocional",
}
FLAG_CLASSES = {
    "es_texto": "PublicacionTexto",
    "es_video": "PublicacionVideo",
    "es_galeria": "PublicacionGaleria",
}
DISJOINT = (
    ("Publicacion", "Autor"),
    ("Publicacion", "Subreddit"),
    ("Autor", "Subreddit"),
    ("PublicacionTexto", "PublicacionVideo"),
    ("PublicacionTexto", "PublicacionGaleria"),
    ("PublicacionVideo", "PublicacionGaleria"),
    ("PostPositivo", "PostNegativo"),
    ("PostPositivo", "PostNeutral"),
    ("PostNegativo", "PostNeutral"),
    ("IntensidadBaja", "IntensidadMedia"),
    ("IntensidadBaja", "IntensidadAlta"),
    ("IntensidadMedia", "IntensidadAlta"),
)
OBJECT_PROPERTIES = (
    "tieneAutor", "esAutorDe", "perteneceASubreddit", "esSubredditDe",
    "tienePolaridadSentimiento", "tieneIntensidadEmocional", "comparteSentimientoCon",
    "contradiceElSentimientoDe", "esSentimientoContradichotPor", "influyeEnElSentimientoDe",
    "esSentimientoInfluidoPor",
)
INVERSES = {
    "tieneAutor": "esAutorDe",
    "perteneceASubreddit": "esSubredditDe",
    "contradiceElSentimientoDe": "esSentimientoContradichotPor",
    "influyeEnElSentimientoDe": "esSentimientoInfluidoPor",
}
FUNCTIONAL = (
    "tieneAutor", "perteneceASubreddit", "tienePolaridadSentimiento", "tieneIntensidadEmocional",
)
EXTRA_PROPERTIES = (
    "valorSentimiento", "confianzaSentimiento", "complejidadLinguistica", "nivelEngagement",
    "historalSentimientoAutor", "tendenciaSentimientoSubreddit",
    "autor_nombre", "autor_nombre_completo_val", "autor_es_premium", "autor_tiene_patreon",
    "autor_bloqueado_val",
    "subreddit_nombre_val", "subreddit_id_val", "subreddit_tipo_val", "subreddit_suscriptores_val",
)
RESTRICTIONS = (  # property, least, most (None = no upper bound)
    ("titulo", 1, None),
    ("fecha_creacion", 1, None),
    ("tieneAutor", 1, 1),
    ("perteneceASubreddit", 1, 1),
)
ANNOTATIONS = (V.RDFS + "label", V.RDFS + "comment", V.SKOS + "prefLabel", V.SKOS + "altLabel",
               V.SKOS + "definition")

# How the generated graph spells the ontology's terms.
ALIASES = {
    "titulo": V.DCT + "title",
    "fecha_creacion": V.PROV + "generatedAtTime",
    "tieneAutor": V.RR + "hasAuthor",
    "perteneceASubreddit": V.RR + "hasSubreddit",
}
INSTANCE_PROPERTIES = ("hasSubreddit", "hasAuthor", "linksToDomain", "hasPostType", "hasTopic")


def _frame(spark: SparkSession, rows) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    return spark.createDataFrame([(s, p, o, kind, None, None) for s, p, o, kind in rows], schema)


def ontology_triples(spark: SparkSession) -> DataFrame:
    """Classes, properties, disjointness, inverses and restrictions as triples."""
    rr, typ = lambda n: V.RR + n, V.RDF_TYPE
    rows = [(rr(c), typ, V.OWL + "Class", "iri") for c in CLASSES]
    sub = V.RDFS + "subClassOf"
    rows += [(rr(c), sub, rr(up), "iri") for c, up in CLASSES.items() if up]
    rows += [(rr(c), sub, f"_:{flag}", "bnode") for flag, c in FLAG_CLASSES.items()]
    rows += [(rr("Publicacion"), sub, f"_:min_{p}", "bnode") for p, _, _ in RESTRICTIONS]
    rows += [(rr(a), V.OWL + "disjointWith", rr(b), "iri") for a, b in DISJOINT]
    rows += [(rr(p), typ, V.OWL + "ObjectProperty", "iri") for p in OBJECT_PROPERTIES]
    rows += [(rr(p), typ, V.OWL + "FunctionalProperty", "iri") for p in FUNCTIONAL]
    rows += [(rr(p), V.OWL + "inverseOf", rr(q), "iri") for p, q in INVERSES.items()]
    properties = [silver for _, silver, _ in FIELDS] + list(EXTRA_PROPERTIES)
    rows += [(rr(p), typ, V.OWL + "DatatypeProperty", "iri") for p in properties]
    return _frame(spark, rows)


def vocabulary_triples(spark: SparkSession) -> DataFrame:
    """Terms used by the generated instances: classes, relations and the topic scheme."""
    rr, typ = lambda n: V.RR + n, V.RDF_TYPE
    rows = [(rr(c), typ, V.OWL + "Class", "iri") for c in ("Post", "Author", "Domain", *V.POST_TYPES)]
    rows += [(rr(c), V.RDFS + "subClassOf", rr("Post"), "iri") for c in V.POST_TYPES]
    rows += [(rr(p), typ, V.OWL + "ObjectProperty", "iri") for p in INSTANCE_PROPERTIES]
    rows += [(rr(t), typ, V.SKOS + "Concept", "iri") for t in V.TOPICS.values()]
    # Narrower topics: a topic grouped under another one by the coarse map.
    rows += [(rr(V.TOPICS[m]), V.SKOS + "broader", rr(top), "iri")
             for top, members in V.COARSE_TOPICS.items() for m in members
             if m in V.TOPICS and V.TOPICS[m] != top]
    return _frame(spark, rows)


def oquare_counts(schema: DataFrame, instances) -> DataFrame:
    """Basic counts over ontology ∪ instances in one row.

    ``schema`` is the small ontology table, ``instances`` a triple table or source without
    schema statements; both are sets.  The wide side is read once: its statements are counted by
    subject, then its total, its posts and their relations are added up.  The list of declared
    relations is a fixed-size metadata read.
    """
    is_a = lambda *o: (F.col("p") == V.RDF_TYPE) & F.col("o").isin(list(o))
    broader = F.col("p") == V.SKOS + "broader"
    own = lambda cond: F.count_distinct(F.when(cond, F.col("s")))
    small = schema.agg(
        own(is_a(V.OWL + "Class", V.SKOS + "Concept")).alias("clases"),
        (own(is_a(V.OWL + "ObjectProperty", V.SKOS + "broader"))
         + F.max(broader.cast("int"))).alias("propiedades_objeto"),
        own(is_a(V.OWL + "DatatypeProperty")).alias("propiedades_datos"),
        own(is_a(V.OWL + "AnnotationProperty") & F.col("s").isin(list(ANNOTATIONS)))
        .alias("propiedades_anotacion"),
        F.count(F.lit(1)).alias("_schema"),
        F.count_if((F.col("p") == V.RDFS + "subClassOf") | broader).alias("relaciones_jerarquicas"))
    declared = [r[0] for r in schema.filter(is_a(V.OWL + "ObjectProperty")).select("s").distinct()
                .collect()]
    subjects = source_of(instances)().groupBy("s").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(is_a(V.RR + "Post")).alias("post"),
        F.count_if(F.col("p").isin(declared)).alias("rel"))
    wide = subjects.agg(F.sum("n").alias("_total"), F.count_if("post").alias("_posts"),
                        F.sum(F.when(F.col("post"), F.col("rel"))).alias("_rel"))
    big = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    names = ("clases", "propiedades_objeto", "propiedades_datos", "propiedades_anotacion",
             "relaciones_jerarquicas")
    # Two tables of one row each.
    return small.withColumn("_k", F.lit(1)).join(wide.withColumn("_k", F.lit(1)), "_k").select(
        *[big(F.col(c)).alias(c) for c in names],
        big(F.col("_schema") + F.coalesce("_total", F.lit(0))).alias("total_triples"),
        big(F.col("_posts")).alias("instancias"), big(F.col("_rel")).alias("relaciones_instancias"))


def oquare_metrics(counts: DataFrame) -> DataFrame:
    """Relationship, attribute and inheritance richness with zero guards."""
    c, o = F.col("clases"), F.col("propiedades_objeto")
    possible = F.when(c > 0, o * c).otherwise(1)
    actual = o + F.col("relaciones_jerarquicas") \
        + F.col("relaciones_instancias") / F.greatest(F.col("instancias"), F.lit(1))
    zero = lambda q: F.coalesce(q, F.lit(0.0))
    return counts.select(
        zero(F.try_divide(actual, possible.cast("double"))).alias("rronto"),
        zero(F.try_divide((F.col("propiedades_datos") + F.col("propiedades_anotacion"))
                          .cast("double"), c.cast("double"))).alias("aronto"),
        zero(F.try_divide(F.col("relaciones_jerarquicas").cast("double"),
                          F.greatest(c - 1, F.lit(1)).cast("double"))).alias("inronto"))


def type_membership(posts: DataFrame) -> DataFrame:
    """Class membership by flag: (id, clase); row-local."""
    cells = F.array(*[F.when(F.col(flag), F.lit(cls)) for flag, cls in FLAG_CLASSES.items()])
    return posts.select("id", F.explode(F.array_compact(cells)).alias("clase"))


def disjoint_violations(types: DataFrame, pairs=DISJOINT) -> DataFrame:
    """Subjects that belong to two disjoint classes: (id, clase_a, clase_b).

    Membership is reduced to one flag per declared class and subject, then the declared
    pairs are read off: the number of rows per subject never multiplies.
    """
    names = sorted({c for p in pairs for c in p})
    flags = types.filter(F.col("clase").isin(names)).groupBy("id").agg(
        *[F.bool_or(F.col("clase") == c).alias(c) for c in names])
    cells = F.array(*[F.when(F.col(a) & F.col(b), F.struct(F.lit(a).alias("clase_a"),
                                                           F.lit(b).alias("clase_b")))
                      for a, b in pairs])
    return flags.select("id", F.explode(F.array_compact(cells)).alias("x")).select("id", "x.*")


def cardinality_violations(g) -> DataFrame:
    """Posts that break a cardinality restriction: (post, propiedad, n)."""
    is_post = (F.col("p") == V.RDF_TYPE) & (F.col("o") == V.RR + "Post")
    rows = source_of(g)(*[ALIASES[p] for p, _, _ in RESTRICTIONS]) \
        .unionByName(source_of(g)(V.RDF_TYPE, obj=V.RR + "Post"))
    per = rows.groupBy("s").agg(
        F.bool_or(is_post).alias("post"),
        *[F.count_if(F.col("p") == ALIASES[p]).alias(p) for p, _, _ in RESTRICTIONS]).filter("post")

    def broken(p: str, least: int, most: int | None) -> Column:
        n = F.col(p)
        bad = n < least if most is None else (n < least) | (n > most)
        return F.when(bad, F.struct(F.lit(p).alias("propiedad"), n.cast("bigint").alias("n")))

    return per.select(V.last_segment(F.col("s")).alias("post"), F.explode(F.array_compact(
        F.array(*[broken(*r) for r in RESTRICTIONS]))).alias("x")).select("post", "x.*")


def functional_violations(g, properties: list[str]) -> DataFrame:
    """Subjects with more than one value of a functional property: (s, p, n)."""
    return source_of(g)(*properties).select("s", "p", "o").distinct() \
        .groupBy("s", "p").agg(F.count(F.lit(1)).cast("bigint").alias("n")).filter("n > 1")


def inverse_triples(g, inverses: dict[str, str]) -> DataFrame:
    """Materialise o p⁻¹ s for every s p o with a declared inverse; row-local."""
    target = F.create_map(*[F.lit(x) for kv in inverses.items() for x in kv])
    return source_of(g)(*inverses).filter(F.col("o_kind") == "iri").select(
        F.col("o").alias("s"), target[F.col("p")].alias("p"), F.col("s").alias("o"),
        "o_kind", "o_dtype", "o_lang")


def superclasses() -> dict[str, list[str]]:
    """Every class with itself and all its ancestors."""
    out = {}
    for c in CLASSES:
        chain, up = [c], CLASSES[c]
        while up:
            chain.append(up)
            up = CLASSES[up]
        out[c] = chain
    return out


def subclass_closure(types: DataFrame) -> DataFrame:
    """Membership in all superclasses: (id, clase), each once per subject."""
    closure = F.create_map(*[x for c, up in superclasses().items()
                             for x in (F.lit(c), F.array(*[F.lit(u) for u in up]))])
    own = F.coalesce(F.try_element_at(closure, F.col("clase")), F.array("clase"))
    return types.select("id", F.explode(own).alias("clase")).distinct()


def closure(edges: DataFrame, sub: str = "s", top: str = "o") -> DataFrame:
    """(sub, top): every class with itself and all its ancestors, for a hierarchy of any depth.

    Every round doubles the distance that is known: pairs exactly that far apart are joined with all pairs known so
    far, so a hierarchy n deep takes about log2(n) rounds, and a pair is written once.  Pairs that are known are
    left out, so a cycle ends like a chain and the classes in it become ancestors of each other.
    """
    up = durable(edges.select(F.col(sub).alias("sub"), F.col(top).alias("top")).filter("sub is not null and top is not null").distinct())
    nodes = up.select("sub").unionByName(up.select(F.col("top").alias("sub"))).distinct()
    fresh = known = up.filter("sub <> top").withColumn("far", F.lit(1))
    reach = 1
    while not fresh.isEmpty():
        # The first ``reach`` steps of a shortest path lead exactly that far.
        step = (fresh.filter(F.col("far") == reach).select("sub", F.col("top").alias("mid"))
                .join(known.select(F.col("sub").alias("mid"), "top", (F.col("far") + reach).alias("far")), "mid").filter("sub <> top"))
        fresh = durable(step.groupBy("sub", "top").agg(F.min("far").alias("far")).join(known, ["sub", "top"], "left_anti"))
        known, reach = known.unionByName(fresh), 2 * reach
    return nodes.select("sub", F.col("sub").alias("top")).unionByName(known.select("sub", "top"))


def subclass_edges(triples: DataFrame) -> DataFrame:
    """(s, o) of all subclass statements between named classes."""
    return triples.filter((F.col("p") == V.RDFS + "subClassOf") & (F.col("o_kind") == "iri")).select("s", "o")


def members_of(types: DataFrame, ancestors: DataFrame, key: str = "id", clase: str = "clase") -> DataFrame:
    """Membership in all superclasses by a ``closure``: (key, clase), each once; a class that the hierarchy
    does not have stays as it is."""
    joined = types.join(ancestors, F.col(clase) == F.col("sub"), "left")
    return joined.select(key, F.coalesce("top", F.col(clase)).alias(clase)).distinct()


def author_history(df: DataFrame, author: str = "autor", ts: str = "fecha_creacion_utc",
                   value: str = "valor_sentimiento", key: str = "id") -> DataFrame:
    """Mean value of the author's earlier posts, null for the first: adds ``historial``.

    Uses the distributed running sum, so a prolific author is spread over many tasks.
    """
    out = running_sum(df, [author], [ts, key], value, out="_sum")
    return out.withColumn("historial", F.try_divide(F.col("_sum"), F.col("_sum_n").cast("double"))) \
        .drop("_sum", "_sum_n")


def subreddit_trend(df: DataFrame, group: str = "subreddit_nombre", ts: str = "fecha_creacion",
                    value: str = "valor_sentimiento") -> DataFrame:
    """Mean value per community and month, and over the community's whole history.

    The community mean is computed from the monthly sums.
    """
    monthly = df.groupBy(F.col(group).alias("subreddit"), F.date_format(ts, "yyyy-MM").alias("mes")) \
        .agg(F.count(value).alias("n"), F.sum(value).alias("s"))
    w = Window.partitionBy("subreddit")
    return monthly.select(
        "subreddit", "mes", F.col("n").cast("bigint").alias("n"),
        F.try_divide(F.col("s"), F.col("n").cast("double")).alias("media_mes"),
        F.try_divide(F.sum("s").over(w), F.sum("n").over(w).cast("double")).alias("media_total"))
