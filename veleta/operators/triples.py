"""Silver posts as a triple table (s, p, o, o_kind, o_dtype, o_lang)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from veleta.functions import vocab as V
from veleta.functions.values import epoch_timestamp, iso_seconds

COLUMNS = ("s", "p", "o", "o_kind", "o_dtype", "o_lang")
DELETED = "[deleted]"


def _row(s: Column, p: str, o: Column, kind: str = "iri", dtype: str | None = None,
         lang: str | None = None) -> list[Column]:
    return [s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"),
            F.lit(kind).alias("o_kind"), F.lit(dtype).cast("string").alias("o_dtype"),
            F.lit(lang).cast("string").alias("o_lang")]


def _filled(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def author_key() -> Column:
    name = V.iri_safe(_filled("autor"))
    return F.when(name != DELETED, name)


def domain_key() -> Column:
    return V.iri_safe(_filled("dominio"))


def subreddit_iri(name: Column) -> Column:
    return F.concat(F.lit(V.BASE + "r/"), name)


def _post_statements() -> list[list[Column]]:
    return [cells for _, _, cells in _statement_list()]


def _statement_list() -> list[tuple[str, tuple[str, ...] | None, list[Column]]]:
    """(predicate, possible objects or None, columns) of every statement about a post; the
    object is null where it does not apply."""
    pid = V.iri_safe(_filled("id"))
    s = F.concat(F.lit(V.BASE + "post/"), pid)
    rr = lambda name: V.RR + name
    iri = lambda folder, name: F.concat(F.lit(V.BASE + folder), name)
    created = F.nullif(F.col("fecha_creacion_utc"), F.lit(0.0))
    kind = F.concat(F.lit(V.RR), V.post_type(F.col("es_texto"), F.col("es_video"),
                                             F.col("es_galeria"), F.col("pista_contenido")))
    whole = "integer"

    def say(p: str, o: Column, *kind: str, fixed: tuple[str, ...] | None = None):
        return p, fixed, _row(s, p, o, *kind)

    return [
        say(V.RDF_TYPE, F.lit(rr("Post")), fixed=(rr("Post"),)),
        say(rr("redditId"), pid, "literal", V.XSD + "string"),
        say(V.DCT + "title", _filled("titulo"), "literal"),
        say(V.SCHEMA + "text", _filled("texto"), "literal"),
        say(V.PROV + "generatedAtTime", iso_seconds(epoch_timestamp(created)), "literal",
             V.XSD + "dateTime"),
        say(rr("score"), F.col("puntaje").cast("bigint"), "literal", V.XSD + whole),
        say(V.SCHEMA + "commentCount", F.col("total_comentarios").cast("bigint"), "literal",
             V.XSD + whole),
        say(V.SCHEMA + "url", _filled("url"), "literal"),
        say(rr("hasSubreddit"), iri("r/", V.norm_subreddit(F.col("subreddit_nombre")))),
        say(rr("hasAuthor"), iri("u/", author_key())),
        say(rr("linksToDomain"), iri("domain/", domain_key())),
        say(V.RDF_TYPE, kind, fixed=tuple(map(rr, V.POST_TYPES))),
        say(rr("hasPostType"), kind),
        say(rr("hasTopic"), F.concat(F.lit(V.RR), V.topic(F.col("subreddit_nombre"))),
            fixed=tuple(map(rr, V.TOPICS.values()))),
    ]


def _with_id(posts: DataFrame) -> DataFrame:
    return posts.filter(F.coalesce(F.col("id"), F.lit("")) != "")


def entity_triples(posts: DataFrame) -> DataFrame:
    """Type and label statements of communities, authors and domains, each once.

    One narrow scan; the distinct runs on names, combined in the map tasks, so a name that
    occurs in a third of the posts costs one row per task.
    """
    named = lambda kind, name: F.struct(F.lit(kind).alias("k"), name.alias("n"))
    names = _with_id(posts).select(F.explode(F.array(
        named("r/", V.norm_subreddit(F.col("subreddit_nombre"))),
        named("u/", author_key()), named("domain/", domain_key()))).alias("x")) \
        .select("x.k", "x.n").filter("n is not null").distinct()
    s = F.concat(F.lit(V.BASE), F.col("k"), F.col("n"))
    cls = F.when(F.col("k") == "r/", "Subreddit").when(F.col("k") == "u/", "Author") \
        .otherwise("Domain")
    label = F.when(F.col("k") == "r/", F.concat(F.lit("r/"), F.col("n")))
    both = F.array(
        F.struct(*_row(s, V.RDF_TYPE, F.concat(F.lit(V.RR), cls))),
        F.struct(*_row(s, V.RDFS + "label", label, "literal", None, "en")))
    return names.select(F.explode(both).alias("t")).select("t.*").filter("o is not null")


def post_triples(posts: DataFrame) -> DataFrame:
    """All statements about posts in a single scan, without a shuffle."""
    cells = F.array(*[F.struct(*cells) for cells in _post_statements()])
    return _with_id(posts).select(F.explode(cells).alias("t")).select("t.*") \
        .filter("o is not null")


def triples(posts: DataFrame, unique_ids: bool = True) -> DataFrame:
    """The graph as a table, for writing.

    Statements of different posts cannot coincide when post ids are unique, which silver
    guarantees, so only entity statements need duplicate removal.  Pass ``unique_ids=False``
    for raw input: the whole table is then made a set.
    """
    out = post_triples(posts).unionByName(entity_triples(posts))
    return out if unique_ids else as_graph(out)


def statement_source(posts: DataFrame):
    """Virtual triple table for questions: ``rows(p, …)`` gives the statements with these
    predicates, ``rows(V.RDF_TYPE, obj=…)`` those with one constant object.

    All wanted statements about posts come from one scan that builds only these, and all
    statements about communities, authors and domains from another; ``rows()`` gives all of them.
    """
    base = _with_id(posts)
    entities = tuple(V.RR + c for c in ("Subreddit", "Author", "Domain"))

    def rows(*predicates: str, obj: str | None = None) -> DataFrame:
        wanted = lambda p, o: (not predicates or p in predicates) and (obj is None or o is None or obj in o)
        cells = [c for p, o, c in _statement_list() if wanted(p, o)]
        picked = []
        if len(cells) == 1:
            picked.append(base.select(*cells[0]))
        elif cells:
            picked.append(base.select(F.inline(F.array(*[F.struct(*c) for c in cells]))))
        if wanted(V.RDF_TYPE, entities) or wanted(V.RDFS + "label", None):
            named = entity_triples(posts)
            picked.append(named.filter(F.col("p").isin(list(predicates))) if predicates else named)
        if not picked:
            return base.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS))
        out = reduce(DataFrame.unionByName, picked).filter("o is not null")
        return out if obj is None else out.filter(F.col("o") == obj)

    return rows


def triple_view(posts: DataFrame) -> DataFrame:
    """The rows of ``triples``, from the source of virtual statements."""
    return statement_source(posts)()


def stored_source(table: DataFrame):
    """The same access to a triple table, stored or computed."""
    def rows(*predicates: str, obj: str | None = None) -> DataFrame:
        out = table.filter(F.col("p").isin(list(predicates))) if predicates else table
        return out if obj is None else out.filter(F.col("o") == obj)

    return rows


def source_of(graph):
    """``graph`` is a triple table or already a source."""
    return stored_source(graph) if isinstance(graph, DataFrame) else graph


def as_graph(*parts: DataFrame) -> DataFrame:
    """Union of graphs as a set of statements."""
    return reduce(DataFrame.unionByName, [p.select(*COLUMNS) for p in parts]).distinct()


def rdf_stats(posts: DataFrame) -> DataFrame:
    """Counts of the generated graph, taken from the posts: no triple is built for them."""
    cells = _post_statements()
    statements = sum((F.when(c[2].isNotNull(), 1).otherwise(0) for c in cells), F.lit(0))
    base = _with_id(posts).select(
        V.norm_subreddit(F.col("subreddit_nombre")).alias("r"), author_key().alias("u"),
        domain_key().alias("d"), V.topic(F.col("subreddit_nombre")).alias("t"),
        statements.alias("n"))
    one = base.agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("r").alias("subreddits"),
        F.count_distinct("u").alias("autores"), F.count_distinct("d").alias("dominios"),
        F.count("t").alias("con_tema"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    share = F.coalesce(F.round(F.try_divide(F.col("con_tema") * F.lit(100.0), F.col("posts")), 1),
                       F.lit(0.0))
    big = lambda c: c.cast("bigint")
    return one.select(
        big(F.col("posts")).alias("posts"), big(F.col("subreddits")).alias("subreddits"),
        big(F.col("autores")).alias("autores"), big(F.col("dominios")).alias("dominios"),
        big(F.col("con_tema")).alias("con_tema"), share.alias("pct_con_tema"),
        big(F.col("posts")).alias("con_tipo"),
        big(F.col("n") + 2 * F.col("subreddits") + F.col("autores") + F.col("dominios"))
        .alias("total_triples"))
