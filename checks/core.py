"""Registry of checked queries and the views they read.

Every check pairs a Spark query with SQL that computes the same table independently.  The
views turn the given tables into posts; each exists once as a DataFrame and once as SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from veleta.functions.text import clean_text
from veleta.functions.values import epoch_timestamp
from veleta.operators.harmonize import fill_nulls, rename_fields

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BODIES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register ``fn(v: Views) -> DataFrame`` under ``name`` with its SQL twin."""
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Views(spark, sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            BODIES[name] = sql
        return fn
    return add


class Views:
    """The given tables and the post-shaped views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def posts(self) -> DataFrame:
        pages = self.table("pages").selectExpr("page_id", "url as page_url")
        d = self.table("documents").join(pages, F.col("doc_id") == F.col("page_id"), "left")
        return d.selectExpr(
            "'d' || doc_id as id",
            f"if(doc_id % 11 = 0, upper({TITLE}), {TITLE}) || if(doc_id % 5 = 0, '?', '') as title",
            "if(doc_id % 17 = 0, '', text) || coalesce(' see ' || page_url || ' cc @user' || doc_id % 7"
            " || ' via u/bot' || doc_id % 3, '') as selftext",
            "if(doc_id % 50 = 0, '[deleted]', 'user' || doc_id % 97) as author",
            "get(array('Technology', 'technews', 'worldnews', 'science', 'politics', 'business',"
            " 'Economics', 'Health', 'futurology'), cast(doc_id * doc_id % 23 % 10 as int)) as subreddit",
            "if(doc_id % 19 = 0, null, 1000 + doc_id * 7919 % 900000) as subreddit_subscribers",
            "cast(1704067200 + doc_id * 43207 + if(doc_id >= 100, 7776000, 0) as double) as created_utc",
            "doc_id * 37 % 997 - 50 as score", "doc_id * 13 % 211 as num_comments",
            "cast(doc_id * 29 % 101 as double) / 100D as upvote_ratio",
            "doc_id % 3 = 0 as is_self", "doc_id % 7 = 0 as is_video", "doc_id % 11 = 0 as is_gallery",
            "if(doc_id % 2 = 0, 'link', null) as post_hint", "doc_id % 17 = 0 as media_only",
            "doc_id % 13 = 0 as over_18",
            "if(doc_id % 4 = 0, 'self.post', 'm.example.net/x y') as domain", "page_url as url", "lang",
            "1717200000D as _ingest_ts")

    def posts_dup(self) -> DataFrame:
        """Posts and a later, edited crawl of every labelled one."""
        seen = self.table("labels").select(F.concat(F.lit("d"), F.col("doc_id").cast("string"))
                                           .alias("id")).distinct()
        p = self.posts()
        again = p.join(seen, "id", "left_semi").withColumns({
            "title": F.concat("title", F.lit(" (edit)")), "score": F.col("score") + 5,
            "num_comments": F.col("num_comments") + 1, "_ingest_ts": F.col("_ingest_ts") + 3600.0})
        return p.unionByName(again)

    def silver(self) -> DataFrame:
        """Silver rows of the (already unique) posts."""
        rows = self.posts().withColumn("created_ts", epoch_timestamp(F.col("created_utc")))
        return rename_fields(fill_nulls(rows)).withColumns({
            "titulo_limpio": clean_text(F.col("titulo")),
            "texto_limpio": clean_text(F.col("texto"))})

    def concepts(self) -> DataFrame:
        rows = [tuple(x) for x in CONCEPTS]
        return self.spark.createDataFrame(rows, "concepto string, sinonimo string")

    def _n(self) -> DataFrame:
        return self.posts().selectExpr("*", "cast(substr(id, 2) as bigint) as n")

    def star_probs(self) -> DataFrame:
        w = [f"cast((n * {a} + {b}) % {m} + 1 as double)" for a, b, m in STAR_SEEDS]
        return self._n().selectExpr("id", *[f"{x} as w{i}" for i, x in enumerate(w, 1)]).selectExpr(
            "id", *[f"w{i} / (w1 + w2 + w3 + w4 + w5) as p{i}" for i in range(1, 6)])

    def _pred(self, posts: DataFrame, factor: int, cut: int, name: str) -> DataFrame:
        u = f"n * {factor} % 101"
        return posts.selectExpr(
            "id", "created_utc as fecha_creacion", "subreddit as subreddit_nombre",
            "title as titulo", f"if({u} >= {cut}, 1, 0) as prediccion",
            f"cast({u} as double) / 100D as probabilidad", f"'{name}' as modelo")

    def pred_a(self) -> DataFrame:
        return self._pred(self._n(), 37, 50, "modelo_a")

    def pred_b(self) -> DataFrame:
        """The second model does not score posts that only carry media."""
        return self._pred(self._n().filter(~F.col("media_only")), 53, 45, "modelo_b")

    def labelled(self) -> DataFrame:
        """Three-way truth from the label table: toxic 0, good 2, the rest 1."""
        real = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1)
        return self.table("labels").select(
            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), real.alias("real"),
            "quality")


# First sentence; a post that is all media carries its whole text as title.
TITLE = (r"replace(if(doc_id % 17 = 0, replace(text, '\n', ' '),"
         r" substring_index(substring_index(text, '\n', 1), '.', 1)), 'ß', 'ss')")
CONCEPTS = (
    ("articulo", "the"), ("articulo", "la"), ("articulo", "le"), ("articulo", "der"),
    ("articulo", "el"), ("conjuncion", "and"), ("conjuncion", "et"), ("conjuncion", "und"),
    ("conjuncion", "que"), ("prueba", "ein"), ("prueba", "to"),
)
STAR_SEEDS = ((7919, 11, 1000), (104729, 23, 1000), (1299709, 37, 1200), (15485863, 41, 1000),
              (32452843, 59, 1000))

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NOT_SPACE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
TOKENS = r"regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}_]+')"


def sql_sub(expr: str, pattern: str, by: str) -> str:
    return f"regexp_replace({expr}, '{pattern}', '{by}', 'g')"


def sql_strip(expr: str) -> str:
    return sql_sub(expr, f"^{SPACE}+|{SPACE}+$", "")


def sql_clean(c: str) -> str:
    out = sql_sub(f"lower(coalesce({c}, ''))", "https?://[!$-_a-z]+", "")
    for p in (f"@{WORD}+", f"/u/{WORD}+", f"u/{WORD}+"):
        out = sql_sub(out, p, "")
    return sql_strip(sql_sub(out, SPACE + "+", " "))


def sql_basic(c: str) -> str:
    out = sql_sub(f"coalesce({c}, '')", f"http{NOT_SPACE}+|www\\.{NOT_SPACE}+", " ")
    out = sql_sub(out, r"[\r\n\t]+", " ")
    return f"lower({sql_strip(sql_sub(out, SPACE + '{2,}', ' '))})"


_VALUES = lambda rows: ", ".join("('" + "','".join(r) + "')" for r in rows)

VIEWS = {
    "posts": """
select 'd' || cast(doc_id as varchar) as id,
  case when doc_id % 11 = 0 then upper(t0) else t0 end || case when doc_id % 5 = 0 then '?' else '' end as title,
  case when doc_id % 17 = 0 then '' else text end || coalesce(' see ' || p.url || ' cc @user' || cast(doc_id % 7 as varchar) || ' via u/bot' || cast(doc_id % 3 as varchar), '') as selftext,
  case when doc_id % 50 = 0 then '[deleted]' else 'user' || cast(doc_id % 97 as varchar) end as author,
  case (doc_id * doc_id) % 23 % 10 when 0 then 'Technology' when 1 then 'technews' when 2 then 'worldnews' when 3 then 'science' when 4 then 'politics' when 5 then 'business' when 6 then 'Economics' when 7 then 'Health' when 8 then 'futurology' else null end as subreddit,
  case when doc_id % 19 = 0 then null else 1000 + (doc_id * 7919) % 900000 end as subreddit_subscribers,
  cast(1704067200 + doc_id * 43207 + case when doc_id >= 100 then 7776000 else 0 end as double) as created_utc,
  (doc_id * 37) % 997 - 50 as score,
  (doc_id * 13) % 211 as num_comments,
  cast((doc_id * 29) % 101 as double) / cast(100 as double) as upvote_ratio,
  doc_id % 3 = 0 as is_self, doc_id % 7 = 0 as is_video, doc_id % 11 = 0 as is_gallery,
  case when doc_id % 2 = 0 then 'link' else null end as post_hint,
  doc_id % 17 = 0 as media_only, doc_id % 13 = 0 as over_18,
  case when doc_id % 4 = 0 then 'self.post' else 'm.example.net/x y' end as domain, p.url as url,
  lang, cast(1717200000 as double) as _ingest_ts
from (select *, replace(case when doc_id % 17 = 0 then replace(text, chr(10), ' ') else split_part(split_part(text, chr(10), 1), '.', 1) end, 'ß', 'ss') as t0 from documents) d
left join pages p on p.page_id = d.doc_id""",
    "posts_dup": """
select * from posts union all
select id, title || ' (edit)' as title, selftext, author, subreddit, subreddit_subscribers, created_utc, score + 5 as score, num_comments + 1 as num_comments, upvote_ratio, is_self, is_video, is_gallery, post_hint, media_only, over_18, domain, url, lang, _ingest_ts + 3600 as _ingest_ts
from posts where id in (select 'd' || cast(doc_id as varchar) from labels)""",
    "latest": """
select * from (select *, row_number() over (partition by id order by _ingest_ts desc) as rn from posts_dup) x where rn = 1""",
    "silver": f"""
select id, title as titulo, selftext as texto, author as autor, coalesce(subreddit, '') as subreddit_nombre,
  coalesce(subreddit_subscribers, 0) as subreddit_suscriptores, created_utc as fecha_creacion_utc,
  make_timestamp(cast(created_utc * 1000000 as bigint)) as fecha_creacion,
  score as puntaje, num_comments as total_comentarios, upvote_ratio as ratio_upvotes,
  is_self as es_texto, is_video as es_video, is_gallery as es_galeria, media_only as solo_media,
  over_18 as es_adulto, coalesce(post_hint, '') as pista_contenido, domain as dominio,
  coalesce(url, '') as url, lang, _ingest_ts,
  {sql_clean('title')} as titulo_limpio, {sql_clean('selftext')} as texto_limpio
from posts""",
    "con_texto": f"""
select *, length(texto_model) as longitud_texto from (
select *, {sql_strip("case when t1 <> '' and t2 <> '' then t1 || chr(10) || t2 else t1 || t2 end")} as texto_model
from (select *, coalesce(nullif(titulo_limpio, ''), {sql_basic('titulo')}) as t1, coalesce(nullif(texto_limpio, ''), {sql_basic('texto')}) as t2 from silver) a) b""",
    "util": """
select * from con_texto where not coalesce(solo_media, false) and not coalesce(es_video, false)
  and not coalesce(es_galeria, false) and texto_model <> '' and longitud_texto >= 20""",
    "concepts": f"select * from (values {_VALUES(CONCEPTS)}) t(concepto, sinonimo)",
    "star_probs": """
select id, w1/(w1+w2+w3+w4+w5) as p1, w2/(w1+w2+w3+w4+w5) as p2, w3/(w1+w2+w3+w4+w5) as p3, w4/(w1+w2+w3+w4+w5) as p4, w5/(w1+w2+w3+w4+w5) as p5 from (
select id, cast((n*7919 + 11) % 1000 + 1 as double) as w1, cast((n*104729 + 23) % 1000 + 1 as double) as w2, cast((n*1299709 + 37) % 1200 + 1 as double) as w3, cast((n*15485863 + 41) % 1000 + 1 as double) as w4, cast((n*32452843 + 59) % 1000 + 1 as double) as w5
from (select id, cast(substr(id, 2) as bigint) as n from posts) a) b""",
    "weak": """
select *, case sentimiento_label when 'neg' then 0 when 'neu' then 1 else 2 end as label,
  p_neu - greatest(p_neg, p_pos) as margen, greatest(p_neg, p_neu, p_pos) as confianza,
  case sentimiento_label when 'neg' then p_neg >= 0.60::double when 'pos' then p_pos >= 0.60::double else p_neu >= 0.45::double end as alta
from (select id, case list_position([p1,p2,p3,p4,p5], greatest(p1,p2,p3,p4,p5)) when 1 then 'neg' when 2 then 'neg' when 3 then 'neu' else 'pos' end as sentimiento_label,
  p1 + p2 as p_neg, p3 as p_neu, p4 + p5 as p_pos from star_probs) a""",
    "pred_a": """
select id, created_utc as fecha_creacion, subreddit as subreddit_nombre, title as titulo, case when (n*37) % 101 >= 50 then 1 else 0 end as prediccion, cast((n*37) % 101 as double) / cast(100 as double) as probabilidad, 'modelo_a' as modelo from (select *, cast(substr(id, 2) as bigint) as n from posts) t""",
    "pred_b": """
select id, created_utc as fecha_creacion, subreddit as subreddit_nombre, title as titulo, case when (n*53) % 101 >= 45 then 1 else 0 end as prediccion, cast((n*53) % 101 as double) / cast(100 as double) as probabilidad, 'modelo_b' as modelo from (select *, cast(substr(id, 2) as bigint) as n from posts) t where not media_only""",
    "ab": """
select a.id, a.fecha_creacion, a.subreddit_nombre, a.titulo, a.prediccion as prediccion_a, a.probabilidad as probabilidad_a, a.modelo as modelo_a,
  b.titulo as titulo_b, b.prediccion as prediccion_b, b.probabilidad as probabilidad_b, b.modelo as modelo_b
from pred_a a join pred_b b on a.id = b.id and a.fecha_creacion = b.fecha_creacion and a.subreddit_nombre = b.subreddit_nombre""",
    "evaluado": """
select w.id, l.real, w.label as prediccion from weak w join (
  select 'd' || cast(doc_id as varchar) as id, case when toxic = 1 then 0 when quality = 1 then 2 else 1 end as real from labels) l on l.id = w.id""",
    "valor": """
select s.id, s.autor, s.subreddit_nombre, s.fecha_creacion_utc, s.fecha_creacion, w.p_pos - w.p_neg as v, w.confianza
from silver s join weak w on w.id = s.id""",
    "grafo": """
select *, nullif(lower(trim(subreddit_nombre)), '') as sub,
  case when es_texto then 'TextPost' when es_video then 'VideoPost' when es_galeria then 'GalleryPost' when pista_contenido = 'link' then 'LinkPost' else 'TextPost' end as tipo,
  case nullif(lower(trim(subreddit_nombre)), '') when 'technology' then 'Technology' when 'technews' then 'TechNews' when 'machinelearning' then 'MachineLearning' when 'artificialintelligence' then 'ArtificialIntelligence' when 'worldnews' then 'WorldNews' when 'science' then 'Science' when 'politics' then 'Politics' when 'business' then 'Business' when 'economics' then 'Economics' when 'health' then 'Health' end as tema,
  case when autor <> '' and autor <> '[deleted]' then replace(replace(autor, ' ', '_'), '/', '_') end as u,
  nullif(replace(replace(dominio, ' ', '_'), '/', '_'), '') as dom
from silver""",
}


def with_views(body: str) -> str:
    """Prefix a query with the view definitions it (transitively) names."""
    needed: list[str] = []

    def visit(text: str, own: str | None = None) -> None:
        for name in VIEWS:
            if name != own and name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(VIEWS[name], name)
                needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    views = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in needed)
    body = body.strip()
    glue = ",\n" + body[5:] if body[:5].lower() == "with " else "\n" + body
    return f"with {views}{glue}"


def oracle() -> dict[str, str]:
    return {name: with_views(body) for name, body in BODIES.items()}


def big(c) -> object:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def r6(c) -> object:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def iso(c) -> object:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


SQL_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"


def sql_language(source: str, text: str, unknown: str = "und") -> str:
    """CTEs ending in ``idioma(id, lengua)``: stop words joined to tokens, most hits win."""
    from veleta.functions.lang import STOP_WORDS

    words = ", ".join(f"('{lang}', {i}, '{w}')" for i, (lang, ws) in enumerate(STOP_WORDS.items())
                      for w in ws)
    return f"""vacias as (select * from (values {words}) t(lang, prio, palabra)),
fichas as (select id, unnest({TOKENS.format(text)}) as tok from {source}),
aciertos as (select id, lang, prio, count(*) as n from fichas join vacias on tok = palabra group by 1, 2, 3),
mejores as (select *, row_number() over (partition by id order by n desc, prio) as rn from aciertos),
idioma as (select s.id, coalesce(m.lang, '{unknown}') as lengua from {source} s left join mejores m on m.id = s.id and m.rn = 1)"""
