"""Ontology quality and rule checks over the generated graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.core import Views, check, r6
from checks.graph import _TRIPLES, BASE, RR, graph
from checks.labels import weak
from veleta.functions import probs as P
from veleta.functions import vocab as V
from veleta.operators import ontology as O
from veleta.operators import triples as T

# Sizes of the fixed schema tables, counted by hand from their definition.
_CLASSES = 13 + 7 + 10
_OBJECT = 11 + 5 + 1
_DATA = 97
_HIERARCHY = 16 + 4 + 4
_SCHEMA = 13 + 16 + 12 + 11 + 4 + 4 + 97 + 7 + 4 + 5 + 10 + 4
_RELATIONS = "(select count(*) from ({0}) t where p in ({1}))".format(
    _TRIPLES, ", ".join(f"'{RR}{p}'" for p in O.INSTANCE_PROPERTIES))


def counts(v: Views) -> DataFrame:
    schema = O.ontology_triples(v.spark).unionByName(O.vocabulary_triples(v.spark))
    return O.oquare_counts(schema, graph(v))


@check("oquare_counts", f"""
select cast({_CLASSES} as bigint) as clases, cast({_OBJECT} as bigint) as propiedades_objeto,
  cast({_DATA} as bigint) as propiedades_datos, cast(0 as bigint) as propiedades_anotacion,
  cast({_SCHEMA} + (select count(*) from ({_TRIPLES}) t) as bigint) as total_triples,
  cast((select count(*) from grafo) as bigint) as instancias, cast({_HIERARCHY} as bigint) as relaciones_jerarquicas,
  cast({_RELATIONS} as bigint) as relaciones_instancias""")
def oquare_counts(v: Views) -> DataFrame:
    return counts(v)


@check("oquare_metrics", f"""
select round(({_OBJECT} + {_HIERARCHY} + {_RELATIONS} / cast((select count(*) from grafo) as double)) / cast({_OBJECT * _CLASSES} as double), 6) as rronto,
  round({_DATA} / cast({_CLASSES} as double), 6) as aronto, round({_HIERARCHY} / cast({_CLASSES - 1} as double), 6) as inronto""")
def oquare_metrics(v: Views) -> DataFrame:
    return O.oquare_metrics(counts(v)).withColumns({c: r6(c) for c in ("rronto", "aronto", "inronto")})


_TYPES = """(select id, 'PublicacionTexto' as clase from silver where es_texto union all
  select id, 'PublicacionVideo' from silver where es_video union all
  select id, 'PublicacionGaleria' from silver where es_galeria)"""


@check("onto_types", f"select * from {_TYPES} t")
def onto_types(v: Views) -> DataFrame:
    return O.type_membership(v.silver())


@check("onto_disjoint", """
select id, 'PublicacionTexto' as clase_a, 'PublicacionVideo' as clase_b from silver where es_texto and es_video
union all select id, 'PublicacionTexto', 'PublicacionGaleria' from silver where es_texto and es_galeria
union all select id, 'PublicacionVideo', 'PublicacionGaleria' from silver where es_video and es_galeria""")
def onto_disjoint(v: Views) -> DataFrame:
    return O.disjoint_violations(O.type_membership(v.silver()))


@check("onto_cardinality", """
select id as post, 'titulo' as propiedad, cast(0 as bigint) as n from grafo where titulo = ''
union all select id, 'tieneAutor', cast(0 as bigint) from grafo where u is null
union all select id, 'perteneceASubreddit', cast(0 as bigint) from grafo where sub is null""")
def onto_cardinality(v: Views) -> DataFrame:
    return O.cardinality_violations(graph(v))


@check("onto_functional", f"""
select '{BASE}post/' || id as s, p, cast(count(distinct o) as bigint) as n from (
  select id, '{V.DCT}title' as p, title as o from posts_dup union all select id, '{RR}score', cast(score as varchar) from posts_dup
  union all select id, '{RR}hasAuthor', author from posts_dup) q group by 1, 2 having count(distinct o) > 1""")
def onto_functional(v: Views) -> DataFrame:
    """Title, score and author are single-valued; edited crawls break the first two."""
    d = v.posts_dup().select(
        "id", F.col("title").alias("titulo"), F.col("selftext").alias("texto"),
        F.col("author").alias("autor"), F.col("subreddit").alias("subreddit_nombre"),
        F.col("created_utc").alias("fecha_creacion_utc"), F.col("score").alias("puntaje"),
        F.col("num_comments").alias("total_comentarios"), F.col("is_self").alias("es_texto"),
        F.col("is_video").alias("es_video"), F.col("is_gallery").alias("es_galeria"),
        F.col("post_hint").alias("pista_contenido"), F.col("domain").alias("dominio"), "url")
    return O.functional_violations(T.statement_source(d), [V.DCT + "title", RR + "score", RR + "hasAuthor"])


@check("onto_inverse", f"""
select '{BASE}u/' || u as s, '{RR}esAutorDe' as p, '{BASE}post/' || id as o from grafo where u is not null
union all select '{BASE}r/' || sub, '{RR}esSubredditDe', '{BASE}post/' || id from grafo where sub is not null""")
def onto_inverse(v: Views) -> DataFrame:
    inverses = {O.ALIASES[p]: RR + q for p, q in O.INVERSES.items() if p in O.ALIASES}
    return O.inverse_triples(graph(v), inverses).select("s", "p", "o")


@check("onto_subclass", f"""
select * from {_TYPES} t union select id, 'Publicacion' from {_TYPES} t""")
def onto_subclass(v: Views) -> DataFrame:
    return O.subclass_closure(O.type_membership(v.silver()))


_DEEP = f"""deep as (select '{RR}k' || p_partkey as s, '{RR}k' || p_partkey // 3 as o from part union all select '{RR}k0', '{RR}k1'),
up as (select s, o from deep union select up.s, d.o from up join deep d on d.s = up.o)"""


def deep_types(v: Views) -> DataFrame:
    """A hierarchy that grows with a table, about log3(rows) deep, with a cycle at its top, as triples."""
    null = F.lit(None).cast("string")
    name = lambda e: F.concat(F.lit(RR + "k"), F.expr(e).cast("bigint").cast("string"))
    rows = v.table("part").select(name("p_partkey").alias("s"), name("floor(p_partkey / 3)").alias("o"))
    rows = rows.unionByName(v.spark.createDataFrame([(RR + "k0", RR + "k1")], "s string, o string"))
    return rows.select("s", F.lit(V.RDFS + "subClassOf").alias("p"), "o", F.lit("iri").alias("o_kind"), null.alias("o_dtype"), null.alias("o_lang"))


@check("onto_closure", f"""
with recursive {_DEEP}
select s as sub, o as top from up union select s, s from deep union select o, o from deep""")
def onto_closure(v: Views) -> DataFrame:
    return O.closure(O.subclass_edges(deep_types(v)))


@check("onto_deep_members", f"""
with recursive {_DEEP}, c as (select c_custkey as id, '{RR}k' || c_custkey as clase from customer)
select id, clase from c union select c.id, up.o from c join up on up.s = c.clase""")
def onto_deep_members(v: Views) -> DataFrame:
    """Members of a class belong to all its ancestors; classes the hierarchy does not know stay alone."""
    types = v.table("customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit(RR + "k"), F.col("c_custkey").cast("string")).alias("clase"))
    return O.members_of(types, O.closure(O.subclass_edges(deep_types(v))))


@check("sentiment_value", "select id, round(v, 6) as valor, round(confianza, 6) as confianza from valor")
def sentiment_value(v: Views) -> DataFrame:
    w = weak(v)
    return v.silver().select("id").join(w, "id").select(
        "id", r6(P.sentiment_value(F.col("p_neg"), F.col("p_pos"))).alias("valor"),
        r6(F.greatest("p_neg", "p_neu", "p_pos")).alias("confianza"))


@check("intensity_bucket", """
select id, case when abs(v) < 0.3::double then 'IntensidadBaja' when abs(v) < 0.7::double then 'IntensidadMedia' else 'IntensidadAlta' end as intensidad from valor""")
def intensity_bucket(v: Views) -> DataFrame:
    value = F.abs(P.sentiment_value(F.col("p_neg"), F.col("p_pos")))
    return v.silver().select("id").join(weak(v), "id").select(
        "id", P.intensity_bucket(value).alias("intensidad"))


def valued(v: Views) -> DataFrame:
    value = P.sentiment_value(F.col("p_neg"), F.col("p_pos")).alias("valor_sentimiento")
    return v.silver().select("id", "autor", "subreddit_nombre", "fecha_creacion_utc",
                             "fecha_creacion").join(weak(v).select("id", value), "id")


@check("author_history", """
select id, autor, round(avg(v) over (partition by autor order by fecha_creacion_utc, id rows between unbounded preceding and 1 preceding), 6) as historial from valor""")
def author_history(v: Views) -> DataFrame:
    return O.author_history(valued(v)).select("id", "autor", r6("historial").alias("historial"))


@check("subreddit_trend", """
select subreddit_nombre as subreddit, strftime(fecha_creacion, '%Y-%m') as mes, cast(count(*) as bigint) as n,
  round(avg(v), 6) as media_mes, round((select avg(v) from valor t where t.subreddit_nombre = valor.subreddit_nombre), 6) as media_total
from valor group by 1, 2, valor.subreddit_nombre""")
def subreddit_trend(v: Views) -> DataFrame:
    return O.subreddit_trend(valued(v)).withColumns({c: r6(c) for c in ("media_mes", "media_total")})


