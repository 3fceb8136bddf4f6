"""Triple table, competency questions and semantic features.

The SQL answers every question straight from the posts, independent of the triples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.core import SQL_ISO, Views, big, check
from veleta.functions import vocab as V
from veleta.operators import questions as Q
from veleta.operators import triples as T
from veleta.session import scratch
from veleta.sources.tables import read_ntriples, read_triples, write_ntriples, write_triples

RR, BASE, TYPE = V.RR, V.BASE, V.RDF_TYPE


def graph(v: Views):
    return T.statement_source(v.silver())


@check("norm_subreddit", "select id, nullif(lower(trim('  ' || subreddit || ' ')), '') as sub from posts")
def norm_subreddit(v: Views) -> DataFrame:
    return v.posts().select("id", V.norm_subreddit(
        F.concat(F.lit("  "), "subreddit", F.lit(" "))).alias("sub"))


@check("post_type", "select id, tipo from grafo")
def post_type(v: Views) -> DataFrame:
    return v.silver().select("id", V.post_type(
        F.col("es_texto"), F.col("es_video"), F.col("es_galeria"), F.col("pista_contenido"))
        .alias("tipo"))


@check("topic_map", "select id, tema from grafo")
def topic_map(v: Views) -> DataFrame:
    return v.silver().select("id", V.topic(F.col("subreddit_nombre")).alias("tema"))


@check("topic_map_legacy", """
select id, case when lower(subreddit) in ('technology','technews','machinelearning','programming') then 'Technology'
  when lower(subreddit) = 'worldnews' then 'WorldNews' when lower(subreddit) in ('science','health') then 'Science'
  when lower(subreddit) = 'politics' then 'Politics' when lower(subreddit) in ('business','economics') then 'Economics' end as tema from posts""")
def topic_map_legacy(v: Views) -> DataFrame:
    return v.posts().select("id", V.coarse_topic(F.col("subreddit")).alias("tema"))


def _lit(o: str, p: str, dtype: str = "null", where: str = "true", kind: str = "literal") -> str:
    return (f"select '{BASE}post/' || id as s, '{p}' as p, {o} as o, '{kind}' as o_kind, "
            f"cast({dtype} as varchar) as o_dtype, cast(null as varchar) as o_lang from grafo where {where}")


_IRI = dict(kind="iri")
_TRIPLES = " union all ".join([
    _lit(f"'{RR}Post'", TYPE, **_IRI),
    _lit("id", RR + "redditId", f"'{V.XSD}string'"),
    _lit("titulo", V.DCT + "title", where="titulo <> ''"),
    _lit("texto", V.SCHEMA + "text", where="texto <> ''"),
    _lit(SQL_ISO.format("fecha_creacion"), V.PROV + "generatedAtTime", f"'{V.XSD}dateTime'",
         "fecha_creacion_utc <> 0"),
    _lit("cast(puntaje as varchar)", RR + "score", f"'{V.XSD}integer'"),
    _lit("cast(total_comentarios as varchar)", V.SCHEMA + "commentCount", f"'{V.XSD}integer'"),
    _lit("url", V.SCHEMA + "url", where="url <> ''"),
    _lit(f"'{BASE}r/' || sub", RR + "hasSubreddit", where="sub is not null", **_IRI),
    _lit(f"'{BASE}u/' || u", RR + "hasAuthor", where="u is not null", **_IRI),
    _lit(f"'{BASE}domain/' || dom", RR + "linksToDomain", where="dom is not null", **_IRI),
    _lit(f"'{RR}' || tipo", TYPE, **_IRI),
    _lit(f"'{RR}' || tipo", RR + "hasPostType", **_IRI),
    _lit(f"'{RR}' || tema", RR + "hasTopic", where="tema is not null", **_IRI),
] + [
    f"select distinct '{BASE}{folder}' || {c}, '{TYPE}', '{RR}{cls}', 'iri', cast(null as varchar), cast(null as varchar) "
    f"from grafo where {c} is not null" for folder, c, cls in
    (("r/", "sub", "Subreddit"), ("u/", "u", "Author"), ("domain/", "dom", "Domain"))
] + [f"select distinct '{BASE}r/' || sub, '{V.RDFS}label', 'r/' || sub, 'literal', cast(null as varchar), 'en' "
     "from grafo where sub is not null"])


@check("triples", f"select * from ({_TRIPLES}) t")
def triples(v: Views) -> DataFrame:
    """The whole table through the partitioned store and back."""
    path = scratch(v.spark, "triples")
    write_triples(T.triples(v.silver()), path)
    return read_triples(v.spark, path)


@check("triple_view", f"select * from ({_TRIPLES}) t")
def triple_view(v: Views) -> DataFrame:
    return T.triple_view(v.silver())


@check("graph_union", f"""
select p, cast(count(*) as bigint) as n from (select * from ({_TRIPLES}) t
  union select '{BASE}post/' || id, '{V.DCT}title', title, 'literal', cast(null as varchar), cast(null as varchar) from posts_dup where title <> ''
  union select '{BASE}post/' || id, '{RR}score', cast(score as varchar), 'literal', '{V.XSD}integer', cast(null as varchar) from posts_dup) x
group by 1""")
def graph_union(v: Views) -> DataFrame:
    """Graph of the posts merged, as a set, with statements of all their crawls."""
    again = v.posts_dup().select(
        F.col("id"), F.col("title").alias("titulo"), F.col("score").alias("puntaje"))
    s = F.concat(F.lit(BASE + "post/"), "id")
    null = F.lit(None).cast("string")
    row = lambda p, o, t: again.select(
        s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"),
        F.lit("literal").alias("o_kind"), t.alias("o_dtype"), null.alias("o_lang")).filter("o <> ''")
    merged = T.as_graph(graph(v)(), row(V.DCT + "title", F.col("titulo"), null),
                        row(RR + "score", F.col("puntaje"), F.lit(V.XSD + "integer")))
    return merged.groupBy("p").agg(big(F.count(F.lit(1))).alias("n"))


@check("rdf_stats", f"""
select cast(count(*) as bigint) as posts, cast(count(distinct sub) as bigint) as subreddits, cast(count(distinct u) as bigint) as autores,
  cast(count(distinct dom) as bigint) as dominios, cast(count(tema) as bigint) as con_tema,
  round(count(tema) * 100.0::double / count(*), 1) as pct_con_tema, cast(count(*) as bigint) as con_tipo,
  cast((select count(*) from ({_TRIPLES}) t) as bigint) as total_triples from grafo""")
def rdf_stats(v: Views) -> DataFrame:
    return T.rdf_stats(v.silver())


@check("cq_missing_subreddit", "select cast(count(*) as bigint) as n from grafo where sub is null")
def cq_missing_subreddit(v: Views) -> DataFrame:
    return Q.missing_subreddit(graph(v))


@check("cq_subreddit_label", f"""
select id as post_id, '{BASE}r/' || sub as subreddit_iri, 'r/' || sub as label from grafo where sub is not null
order by id, sub limit 50""")
def cq_subreddit_label(v: Views) -> DataFrame:
    return Q.subreddit_label(graph(v))


@check("cq_technology", f"""
select id as post_id, cast(puntaje as bigint) as score, '{BASE}r/' || sub as subreddit_iri from grafo
where tema = 'Technology' and puntaje > 100 order by puntaje desc, id limit 50""")
def cq_technology(v: Views) -> DataFrame:
    return Q.technology_posts(graph(v))


@check("cq1_posts_by_subreddit", f"""
select '{BASE}r/' || sub as subreddit_iri, cast(count(*) as bigint) as post_count from grafo where sub is not null group by 1""")
def cq1(v: Views) -> DataFrame:
    return Q.posts_by_subreddit(graph(v))


@check("cq2_high_score_tech", """
select id as post_id, cast(puntaje as bigint) as score, coalesce(sub, 'None') as subreddit from grafo
where tema = 'Technology' and puntaje > 100 and sub is not null order by puntaje desc, id limit 10""")
def cq2(v: Views) -> DataFrame:
    return Q.high_score_tech(graph(v))


@check("cq3_post_types", "select tipo as post_type, cast(count(*) as bigint) as n from grafo group by 1")
def cq3(v: Views) -> DataFrame:
    return Q.post_types(graph(v))


@check("semantic_features", """
select id as reddit_id, tipo as post_type, tema as topic, cast(puntaje as bigint) as score,
  cast(total_comentarios as bigint) as comment_count from grafo""")
def semantic_features(v: Views) -> DataFrame:
    return Q.semantic_features(graph(v))


@check("semantic_distribution", """
select 'post_type' as rasgo, tipo as valor, cast(count(*) as bigint) as n from grafo group by 2
union all select 'topic', tema, cast(count(*) as bigint) from grafo group by 2""")
def semantic_distribution(v: Views) -> DataFrame:
    return Q.semantic_distribution(Q.semantic_features(graph(v)))


@check("ntriples_roundtrip", f"select * from ({_TRIPLES}) t")
def ntriples_roundtrip(v: Views) -> DataFrame:
    path = scratch(v.spark, "nt")
    write_ntriples(T.triples(v.silver()), path)
    return read_ntriples(v.spark, path)
