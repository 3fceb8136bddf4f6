"""Gold: concept dictionary, features and matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.core import CONCEPTS, TOKENS, Views, big, check, r6
from veleta.functions.text import tokens
from veleta.operators import concepts as C, features as X
from veleta.session import scratch
from veleta.sources.tables import read_concepts


@check("concept_dict", """
select distinct concepto, lower(sinonimo) as sinonimo from (
  select p_brand as concepto, upper(p_name) as sinonimo from part
  union all select p_brand, upper(p_type) from part)""")
def concept_dict(v: Views) -> DataFrame:
    """Two CSV dictionaries with upper-case and repeated synonyms, and one missing file."""
    root = scratch(v.spark, "concepts")
    part = v.table("part")
    for column in ("p_name", "p_type"):
        part.select(F.col("p_brand").alias("concepto"), F.upper(column).alias("sinonimo")) \
            .write.option("header", True).csv(f"{root}/{column}")
    return read_concepts(v.spark, f"{root}/p_name", f"{root}/p_type", f"{root}/none")


@check("concept_counts", f"""
with t as (select id, unnest({TOKENS.format('titulo')}) as tok, 1 as ti, 0 as tx from silver
  union all select id, unnest({TOKENS.format('texto')}), 0, 1 from silver)
select id, concepto, cast(sum(ti) as bigint) as n_titulo, cast(sum(tx) as bigint) as n_texto
from t join concepts on tok = sinonimo group by 1, 2""")
def concept_counts(v: Views) -> DataFrame:
    return C.concept_counts(v.silver(), v.concepts())


# Phrases, symbols, nested and repeated synonyms over part names.
HARD = (("pieza", "widget"), ("pieza", "cold widget"), ("pieza", "bolt"), ("color", "blue"), ("color", "blue rod"),
        ("lenguaje", "c++"), ("lenguaje", "c"), ("promo", "promo-c++"), ("signo", "++"), ("doble", "widget widget"),
        ("doble", "bolt bolt"), ("coma", "rod, "), ("nada", "absent phrase"))
_HARD_NAMES = list(dict.fromkeys(c for c, _ in HARD))
_HARD_POSTS = """
select s.* exclude (titulo, texto), p_name || ' ' || p_brand as titulo,
  p_type || '-c++ ' || p_name || ' ' || p_name || ', ' || lower(p_type) || ' c++, c ++ +++' as texto
from silver s join part on p_partkey = cast(substr(id, 2) as bigint)"""


def _sql_phrases(column: str, synonyms: list[str]) -> str:
    """Whole-word matches without overlap.  Separators are doubled, so a match may take the one before
    and the one after it and still leave them to its neighbours."""
    w = r"[^\p{L}\p{N}_]"
    double = lambda s: "".join(c if c.isalnum() or c == "_" else c * 2 for c in s)
    quote = lambda s: "".join(c if c.isalnum() or c == " " else "\\" + c for c in s)
    either = "|".join(quote(double(s)) for s in sorted(synonyms, key=lambda s: (-len(s), s)))
    text = f"regexp_replace(lower({column}), '({w})', '\\1\\1', 'g')"
    return f"len(regexp_extract_all({text}, '(?:^|{w})(?:{either})(?:{w}|$)'))"


_HARD_HITS = ", ".join(f"{_sql_phrases(col, [s for c, s in HARD if c == n])} as n_{n}_{col}"
                       for n in _HARD_NAMES for col in ("titulo", "texto"))
_HARD_LONG = " union all ".join(
    f"select id, '{n}' as concepto, cast(n_{n}_titulo as bigint) as n_titulo, cast(n_{n}_texto as bigint) as n_texto from h"
    f" where n_{n}_titulo + n_{n}_texto > 0" for n in _HARD_NAMES)


def _hard(v: Views) -> tuple[DataFrame, DataFrame]:
    part = v.table("part")
    posts = v.silver().join(part, F.expr("p_partkey = cast(substr(id, 2) as bigint)")).withColumns({
        "titulo": F.expr("p_name || ' ' || p_brand"),
        "texto": F.expr("p_type || '-c++ ' || p_name || ' ' || p_name || ', ' || lower(p_type) || ' c++, c ++ +++'")})
    return posts, v.spark.createDataFrame(list(HARD), "concepto string, sinonimo string")


@check("concept_counts_joined", f"with h as (select id, {_HARD_HITS} from ({_HARD_POSTS}) p) {_HARD_LONG}")
def concept_counts_joined(v: Views) -> DataFrame:
    """Long form: every synonym by its first word, confirmed where it stands."""
    return C.concept_counts(*_hard(v))


@check("concept_counts_large", f"""
with d as (select distinct substr(tok, 1, 1) as concepto, tok as sinonimo from (select unnest({TOKENS.format("text")}) as tok from benchmark) b where tok <> ''),
t as (select id, unnest({TOKENS.format('titulo')}) as tok, 1 as ti, 0 as tx from silver
  union all select id, unnest({TOKENS.format('texto')}), 0, 1 from silver)
select id, concepto, cast(sum(ti) as bigint) as n_titulo, cast(sum(tx) as bigint) as n_texto
from t join d on tok = sinonimo group by 1, 2""")
def concept_counts_large(v: Views) -> DataFrame:
    """A dictionary that grows with a table: every word of the benchmark, by its first letter."""
    word = F.explode(F.array_distinct(tokens(F.col("text"))))
    d = v.table("benchmark").select(word.alias("sinonimo")).filter("sinonimo <> ''").distinct()
    return C.concept_counts(v.silver(), d.select(F.substring("sinonimo", 1, 1).alias("concepto"), "sinonimo"))


@check("concept_phrases", f"with h as (select id, {_HARD_HITS} from ({_HARD_POSTS}) p) {_HARD_LONG}")
def concept_phrases(v: Views) -> DataFrame:
    """The in-row route that the wide features use, unpivoted."""
    posts, d = _hard(v)
    names = C.dictionary_metadata(d)
    counted = posts.select("id", C.count_expressions(F.col("titulo"), names).alias("t"),
                           C.count_expressions(F.col("texto"), names).alias("x"))
    cells = F.array(*[F.struct(F.lit(n).alias("concepto"), big(F.get("t", F.lit(i))).alias("n_titulo"),
                               big(F.get("x", F.lit(i))).alias("n_texto")) for i, n in enumerate(names)])
    return counted.select("id", F.inline(cells)).filter("n_titulo + n_texto > 0")


_A = """cast(length(titulo) as bigint) as long_titulo, cast(length(texto) as bigint) as long_texto,
  cast(len(string_split(titulo, ' ')) as bigint) as palabras_titulo, cast(len(string_split(texto, ' ')) as bigint) as palabras_texto,
  cast(hour(fecha_creacion) as bigint) as hora_dia, cast(isodow(fecha_creacion) as bigint) as dia_semana,
  cast(puntaje + total_comentarios as bigint) as interaccion_proxy,
  round(cast(puntaje as double) / greatest(total_comentarios, 1), 6) as ratio_puntos_comentarios"""
_A_COLS = ["long_titulo", "long_texto", "palabras_titulo", "palabras_texto", "hora_dia",
           "dia_semana", "interaccion_proxy"]


@check("features_a", f"""
select id, {_A}, contains(titulo, '?') as contiene_pregunta, upper(titulo) = titulo as titulo_mayusculas,
  cast(es_adulto as bigint) as es_adulto_int, cast(es_video as bigint) as es_video_int,
  cast(subreddit_suscriptores as bigint) as suscriptores_subreddit from silver""")
def features_a(v: Views) -> DataFrame:
    a = X.features_a(v.silver())
    return a.select("id", *[big(c).alias(c) for c in _A_COLS],
                    r6("ratio_puntos_comentarios").alias("ratio_puntos_comentarios"),
                    "contiene_pregunta", "titulo_mayusculas",
                    *[big(c).alias(c) for c in ("es_adulto_int", "es_video_int",
                                                "suscriptores_subreddit")])


_NAMES = list(dict.fromkeys(c for c, _ in CONCEPTS))


def _sql_hits(column: str, concept: str) -> str:
    words = ", ".join(f"'{s}'" for c, s in CONCEPTS if c == concept)
    return f"len(list_filter({TOKENS.format(column)}, lambda x: x in ({words})))"


_HITS = ", ".join(f"{_sql_hits(col, c)} as n_{c}_{col}" for c in _NAMES for col in ("titulo", "texto"))
_SUM = {col: " + ".join(f"n_{c}_{col}" for c in _NAMES) for col in ("titulo", "texto")}
_DIV = {col: " + ".join(f"cast(n_{c}_{col} > 0 as bigint)" for c in _NAMES)
        for col in ("titulo", "texto")}
_B_COLS = ([f"n_{c}_{col}" for c in _NAMES for col in ("titulo", "texto")]
           + [f"total_conceptos_{c}" for c in ("titulo", "texto")]
           + [f"diversidad_conceptos_{c}" for c in ("titulo", "texto")])
_B_SQL = (", ".join(f"cast(n_{c}_{col} as bigint) as n_{c}_{col}" for c in _NAMES
                    for col in ("titulo", "texto"))
          + f", cast({_SUM['titulo']} as bigint) as total_conceptos_titulo"
          + f", cast({_SUM['texto']} as bigint) as total_conceptos_texto"
          + f", cast({_DIV['titulo']} as bigint) as diversidad_conceptos_titulo"
          + f", cast({_DIV['texto']} as bigint) as diversidad_conceptos_texto")


@check("features_b", f"""
select id, {_A}, {_B_SQL}, {", ".join(f"n_{c}_titulo + n_{c}_texto > 0 as es_{c}" for c in _NAMES)}
from (select *, {_HITS} from silver) x""")
def features_b(v: Views) -> DataFrame:
    b = X.features_b(v.silver(), v.concepts())
    return b.select("id", *[big(c).alias(c) for c in _A_COLS + _B_COLS],
                    r6("ratio_puntos_comentarios").alias("ratio_puntos_comentarios"),
                    *[f"es_{c}" for c in _NAMES])


@check("features_b_phrases", f"""
select id, {", ".join(f"cast(n_{n}_{c} as bigint) as n_{n}_{c}" for n in _HARD_NAMES for c in ("titulo", "texto"))},
  {", ".join(f"n_{n}_titulo + n_{n}_texto > 0 as es_{n}" for n in _HARD_NAMES)},
  cast({" + ".join(f"n_{n}_texto" for n in _HARD_NAMES)} as bigint) as total_conceptos_texto,
  cast({" + ".join(f"cast(n_{n}_titulo > 0 as bigint)" for n in _HARD_NAMES)} as bigint) as diversidad_conceptos_titulo
from (select id, {_HARD_HITS} from ({_HARD_POSTS}) p) h""")
def features_b_phrases(v: Views) -> DataFrame:
    b = X.features_b(*_hard(v))
    return b.select("id", *[big(f"n_{n}_{c}").alias(f"n_{n}_{c}") for n in _HARD_NAMES for c in ("titulo", "texto")],
                    *[f"es_{n}" for n in _HARD_NAMES],
                    *[big(c).alias(c) for c in ("total_conceptos_texto", "diversidad_conceptos_titulo")])


_D = lambda names: ", ".join(f"cast({n} as double) as {n}" for n in names)


@check("features_a_matrix", f"""
select id, {_D([c for c in X.COLUMNS_A if c != 'ratio_puntos_comentarios' and not c.endswith('_int')])},
  ratio_puntos_comentarios, cast(es_adulto as double) as es_adulto_int, cast(es_video as double) as es_video_int
from (select *, {_A} from silver) x""")
def features_a_matrix(v: Views) -> DataFrame:
    return X.matrix_a(X.features_a(v.silver()), ["id"]).withColumn(
        "ratio_puntos_comentarios", r6("ratio_puntos_comentarios"))


_B_MATRIX = ["es_texto", "es_video", "es_galeria", "es_adulto", "total_comentarios",
             *_A_COLS, *_B_COLS]


@check("features_b_matrix", f"""
select id, {_D(_B_MATRIX)}, round(ratio_upvotes, 6) as ratio_upvotes, ratio_puntos_comentarios,
  cast(es_adulto as double) as es_adulto_int, cast(es_video as double) as es_video_int,
  {", ".join(f"cast(n_{c}_titulo + n_{c}_texto > 0 as double) as es_{c}" for c in _NAMES)}
from (select *, {", ".join(f"{_SUM[c]} as total_conceptos_{c}, {_DIV[c]} as diversidad_conceptos_{c}" for c in ("titulo", "texto"))}
  from (select *, {_A}, {_HITS} from silver) y) x""")
def features_b_matrix(v: Views) -> DataFrame:
    m = X.matrix_b(X.features_b(v.silver(), v.concepts()), ["id"])
    return m.withColumns({c: r6(c) for c in ("ratio_upvotes", "ratio_puntos_comentarios")})
