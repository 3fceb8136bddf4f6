"""Preparation and exploration of the sentiment data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.core import Views, big, check, r6, sql_basic, sql_language
from veleta.functions.lang import language
from veleta.operators import langmodel
from veleta.functions.text import clean_basic, token_count
from veleta.operators import profile
from veleta.operators.dedup import first_by_text
from veleta.operators.labels import length_window
from veleta.operators.ranks import spearman
from veleta.plans import prep
from veleta.schemas import NUMERIC_PROFILE, TARGET_SUBREDDITS
from veleta.session import durable


def texts(v: Views) -> DataFrame:
    return prep.with_model_text(v.silver())


def usable(v: Views) -> DataFrame:
    return prep.usable(texts(v))


def numbers(v: Views) -> DataFrame:
    """The numeric columns of the usable posts, kept so that later passes do not clean texts
    again (in the stage plans the cleaned table is stored)."""
    return durable(usable(v).select("id", "fecha_creacion", *NUMERIC_PROFILE))


@check("clean_basic", f"select id, {sql_basic('title')} as titulo, {sql_basic('selftext')} as texto from posts")
def basic(v: Views) -> DataFrame:
    return v.posts().select("id", clean_basic(F.col("title")).alias("titulo"),
                            clean_basic(F.col("selftext")).alias("texto"))


@check("texto_model", "select id, texto_model, cast(longitud_texto as bigint) as longitud_texto from con_texto")
def texto_model(v: Views) -> DataFrame:
    return texts(v).select("id", prep.text_column(texts(v).columns),
                           big("longitud_texto").alias("longitud_texto"))


@check("prep_filter", "select id, cast(longitud_texto as bigint) as longitud_texto from util")
def prep_filter(v: Views) -> DataFrame:
    return usable(v).select("id", big("longitud_texto").alias("longitud_texto"))


_POINTS = "list_transform(string_split(' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}]+', ' ', 'g')) || ' ', ''), lambda c: unicode(c))"


@check("lang_model", f"""
with p as (select doc_id, lang, {_POINTS} as p from documents),
t as (select doc_id, lang, unnest(list_transform(range(1, greatest(len(p) - 1, 1)), lambda i: (p[i] + 127 * p[i + 1] + 16129 * p[i + 2]) % 8192)) as b from p),
c as (select lang, b, count(*) as n from t group by 1, 2), s as (select lang, sum(n) as total from c group by 1),
w as (select s.lang, k.b, cast(floor(1000 * ln((coalesce(c.n, 0) + 1) / (cast(s.total as double) + 8192))) as bigint) as w
  from s cross join (select distinct b from c) k left join c on c.lang = s.lang and c.b = k.b),
d as (select doc_id, b, count(*) as n from t group by 1, 2),
z as (select doc_id, w.lang, sum(n * w) as peso from d join w using (b) group by 1, 2),
m as (select doc_id, lang, row_number() over (partition by doc_id order by peso desc, lang) as rn from z)
select q.doc_id, coalesce(m.lang, 'und') as idioma, q.lang as real from documents q left join m on m.doc_id = q.doc_id and rn = 1""")
def lang_model(v: Views) -> DataFrame:
    """A model of letter triples from all documents, applied to all of them."""
    docs = v.table("documents")
    model = langmodel.fit(docs, "text", "lang")
    return docs.select("doc_id", model.language(F.col("text")).alias("idioma"), F.col("lang").alias("real"))


@check("lang_detect", f"""
with {sql_language('con_texto', 'texto_model', 'unk')}
select idioma.id, lengua as idioma_detectado, s.lang as real from idioma join silver s on s.id = idioma.id""")
def lang_detect(v: Views) -> DataFrame:
    return texts(v).select("id", language(F.col("texto_model"), "unk").alias("idioma_detectado"),
                           F.col("lang").alias("real"))


@check("lang_filter", f"""
with {sql_language('util', 'texto_model', 'unk')}
select id, lengua as idioma_detectado from idioma where lengua in ('es', 'en')""")
def lang_filter(v: Views) -> DataFrame:
    return prep.in_languages(usable(v)).select("id", "idioma_detectado")


@check("column_prune", f"""
with {sql_language('util', 'texto_model', 'unk')}
select '01 id 02 subreddit_nombre 03 fecha_creacion_utc 04 titulo 05 texto 06 titulo_limpio 07 texto_limpio 08 puntaje 09 total_comentarios 10 ratio_upvotes 11 autor 12 es_adulto 13 solo_media 14 texto_model 15 idioma_detectado 16 longitud_texto' as primeras,
  cast(count(*) as bigint) as filas, cast(sum(longitud_texto) as bigint) as caracteres
from util where id in (select id from idioma where lengua in ('es', 'en'))""")
def column_prune(v: Views) -> DataFrame:
    """The clean data set: column order as text, rows and characters."""
    out = prep.clean(v.silver())
    head = " ".join(f"{i:02d} {c}" for i, c in enumerate(out.columns[:16], 1))
    return out.agg(F.lit(head).alias("primeras"), big(F.count(F.lit(1))).alias("filas"),
                   big(F.sum("longitud_texto")).alias("caracteres"))


@check("target_subs", """
select t.s as subreddit, p.lo is not null as encontrado, cast(coalesce(p.n, 0) as bigint) as filas
from (values ('technology'), ('artificial'), ('futurology')) t(s)
left join (select lower(subreddit_nombre) as lo, count(*) as n from silver group by 1) p on p.lo = t.s""")
def target_subs(v: Views) -> DataFrame:
    report = profile.target_report(v.silver(), "subreddit_nombre", TARGET_SUBREDDITS)
    rows = prep.targeted(v.silver()).groupBy(F.lower("subreddit_nombre").alias("subreddit")) \
        .agg(F.count(F.lit(1)).alias("filas"))
    return report.join(rows, "subreddit", "left").withColumn(
        "filas", big(F.coalesce("filas", F.lit(0))))


@check("dedup_text", "select texto_model, min(id) as id from con_texto group by 1")
def dedup_text(v: Views) -> DataFrame:
    return first_by_text(texts(v).select("id", "texto_model"), "texto_model")


def _hist(expr: str, bins: int, name: str) -> str:
    return f"""select '{name}' as escala, b.bin, round(lo + (hi - lo) / {bins} * b.bin, 6) as desde,
  cast(coalesce(c.n, 0) as bigint) as n from (select min(x) as lo, max(x) as hi from (select {expr} as x from util) q) e
cross join (select cast(unnest(range({bins})) as bigint) as bin) b
left join (select cast(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) as bigint) as bin, count(*) as n
  from (select {expr} as x from util) q, (select min({expr}) as lo, max({expr}) as hi from util) z group by 1) c on c.bin = b.bin"""


@check("length_histogram", _hist("cast(longitud_texto as double)", 50, "lineal") + " union all "
       + _hist("log10(cast(longitud_texto as double))", 100, "log10"))
def length_histogram(v: Views) -> DataFrame:
    rows = numbers(v)
    out = [profile.histogram(rows, ["longitud_texto"], bins, log).withColumn("escala", F.lit(name))
           for bins, log, name in ((50, False, "lineal"), (100, True, "log10"))]
    return out[0].unionByName(out[1]).select("escala", "bin", r6("desde").alias("desde"), "n")


_MONTHS = """meses as (select cast(date_trunc('month', fecha_creacion) as date) as mes, count(*) as n from util group by 1),
serie as (select strftime(s.m, '%Y-%m-%d') as mes, cast(coalesce(n, 0) as bigint) as n
  from (select cast(unnest(generate_series((select min(mes) from meses), (select max(mes) from meses), interval 1 month)) as date) as m) s
  left join meses on meses.mes = s.m)"""


@check("posts_per_month", f"with {_MONTHS} select mes, n from serie")
def posts_per_month(v: Views) -> DataFrame:
    return profile.posts_per_month(usable(v), "fecha_creacion").withColumn(
        "mes", F.date_format("mes", "yyyy-MM-dd"))


@check("posts_rolling3", f"""with {_MONTHS}
select mes, n, round(avg(n) over (order by mes rows between 2 preceding and current row), 6) as media_movil from serie""")
def posts_rolling3(v: Views) -> DataFrame:
    out = profile.rolling_mean(profile.posts_per_month(usable(v), "fecha_creacion"))
    return out.select(F.date_format("mes", "yyyy-MM-dd").alias("mes"), "n",
                      r6("media_movil").alias("media_movil"))


_STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")
_DESCRIBE = " union all ".join(f"""
select '{c}' as columna, cast(count(x) as bigint) as count, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as std,
  round(min(x), 6) as min, round(quantile_cont(x, 0.25), 6) as p25, round(quantile_cont(x, 0.5), 6) as p50,
  round(quantile_cont(x, 0.75), 6) as p75, round(max(x), 6) as max from (select cast({c} as double) as x from util) q"""
                               for c in NUMERIC_PROFILE)


@check("numeric_describe", _DESCRIBE)
def numeric_describe(v: Views) -> DataFrame:
    return profile.numeric_describe(usable(v).select(*NUMERIC_PROFILE), list(NUMERIC_PROFILE)).withColumns(
        {c: r6(c) for c in _STATS})


_RANKS = ", ".join(f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0::double as {c}"
                   for c in NUMERIC_PROFILE)


@check("spearman_corr", f"with r as (select {_RANKS} from util)" + " union all ".join(
    f" select '{a}' as variable_a, '{b}' as variable_b, " + ("max(1.0::double)" if a == b else f"round(corr({a}, {b}), 6)")
    + " as rho from r" for a in NUMERIC_PROFILE for b in NUMERIC_PROFILE))
def spearman_corr(v: Views) -> DataFrame:
    return spearman(numbers(v), list(NUMERIC_PROFILE)).withColumn("rho", r6("rho"))


_SILVER = ("id", "titulo", "autor", "subreddit", "suscriptores", "pista", "url", "puntaje", "es_video")
_NULLABLE = """(select id, title as titulo, author as autor, subreddit, subreddit_subscribers as suscriptores,
  post_hint as pista, url, score as puntaje, is_video as es_video from posts) q"""


def _nullable(v: Views) -> DataFrame:
    return v.posts().select(
        "id", F.col("title").alias("titulo"), F.col("author").alias("autor"), "subreddit",
        F.col("subreddit_subscribers").alias("suscriptores"), F.col("post_hint").alias("pista"),
        "url", F.col("score").alias("puntaje"), F.col("is_video").alias("es_video"))


@check("null_profile", "select * from (" + " union all ".join(
    f"select '{c}' as columna, round(avg(case when {c} is null then 1.0::double else 0 end), 6) as fraccion_nulos from {_NULLABLE}"
    for c in _SILVER) + ") t order by fraccion_nulos desc, columna limit 10")
def null_profile(v: Views) -> DataFrame:
    return profile.null_profile(_nullable(v)).withColumn("fraccion_nulos", r6("fraccion_nulos"))


@check("text_report", """select cast(count(*) as bigint) as filas, cast(2 as bigint) as columnas,
  round(avg(length(texto_model)), 6) as longitud_media from con_texto""")
def text_report(v: Views) -> DataFrame:
    return profile.text_report(texts(v).select("id", "texto_model"), "texto_model") \
        .withColumn("longitud_media", r6("longitud_media"))


@check("top_subreddits", """select subreddit, cast(count(*) as bigint) as n from posts where subreddit is not null
group by 1 order by n desc, subreddit limit 10""")
def top_subreddits(v: Views) -> DataFrame:
    return profile.top_groups(v.posts(), "subreddit", 10)


@check("variable_dictionary", " union all ".join(f"""
select '{c}' as columna, '{t}' as dtype, round(avg(case when {c} is null then 1.0::double else 0 end) * 100, 6) as pct_nulos,
  coalesce(arg_min(cast({c} as varchar), id) filter (where {c} is not null), '') as ejemplo from {_NULLABLE}"""
    for c, t in zip(_SILVER, ("string", "string", "string", "string", "bigint", "string", "string", "bigint", "boolean"))))
def variable_dictionary(v: Views) -> DataFrame:
    return profile.variable_dictionary(_nullable(v)).withColumn("pct_nulos", r6("pct_nulos"))


@check("length_outliers", """select id, cast(longitud_texto as bigint) as longitud_texto from con_texto
where longitud_texto between 20 and (select quantile_cont(cast(longitud_texto as double), 0.999) from con_texto)""")
def length_outliers(v: Views) -> DataFrame:
    return length_window(durable(texts(v).select("id", "longitud_texto"))).withColumn(
        "longitud_texto", big("longitud_texto"))


@check("token_stats", """
select cast(count(*) as bigint) as muestra, round(avg(n), 6) as mean_tokens,
  cast(floor(quantile_cont(n, 0.5)) as bigint) as p50, cast(floor(quantile_cont(n, 0.9)) as bigint) as p90,
  cast(floor(quantile_cont(n, 0.95)) as bigint) as p95, cast(floor(quantile_cont(n, 0.99)) as bigint) as p99,
  cast(max(n) as bigint) as max, round(avg(case when n > 256 then 1.0::double else 0 end), 6) as trunc_rate
from (select cast(len(list_filter(regexp_split_to_array(lower(texto_model), '[^\\p{L}\\p{N}_]+'), lambda x: x <> '')) as double) as n
  from con_texto order by md5(id || '|42') limit 20000) q""")
def token_stats(v: Views) -> DataFrame:
    out = profile.token_stats(texts(v), "id", token_count(F.col("texto_model")), keys=v.posts().select("id"))
    return out.withColumns({c: r6(c) for c in ("mean_tokens", "trunc_rate")})


