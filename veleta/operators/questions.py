"""Competency questions and semantic features over a triple table.

``g`` is a table with the columns of ``triples`` or a source made from posts; either way a
question reads only the predicates it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veleta.functions import vocab as V
from veleta.operators.triples import source_of

RR = V.RR


def _pairs(g, p: str, out: str) -> DataFrame:
    return source_of(g)(p).select("s", F.col("o").alias(out))


def of_type(g, cls: str) -> DataFrame:
    return source_of(g)(V.RDF_TYPE, obj=RR + cls).select("s")


def missing_subreddit(g) -> DataFrame:
    """Number of posts without a community."""
    linked = _pairs(g, RR + "hasSubreddit", "sub").select("s")
    return of_type(g, "Post").join(linked, "s", "left_anti") \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def subreddit_label(g, limit: int = 50) -> DataFrame:
    """Sample of ``limit`` posts with community and one label of it.

    The sample is cut first (ordered, so reruns agree); labels are only looked up for it.
    """
    some = _pairs(g, RR + "hasSubreddit", "sub").join(of_type(g, "Post"), "s", "left_semi") \
        .distinct().orderBy("s", "sub").limit(limit)
    labels = _pairs(g, V.RDFS + "label", "label").withColumnRenamed("s", "sub")
    return some.join(labels, "sub", "left").groupBy("s", "sub") \
        .agg(F.min("label").alias("label")) \
        .select(V.last_segment(F.col("s")).alias("post_id"), F.col("sub").alias("subreddit_iri"),
                "label")


def _technology(g, score_min: int) -> DataFrame:
    tech = source_of(g)(RR + "hasTopic", obj=RR + "Technology").select("s")
    score = _pairs(g, RR + "score", "o").select("s", F.col("o").try_cast("bigint").alias("score")) \
        .filter(F.col("score") > score_min)
    return score.join(tech, "s", "left_semi").join(of_type(g, "Post"), "s", "left_semi")


def technology_posts(g, score_min: int = 100, limit: int = 50) -> DataFrame:
    """Technology posts above a score, best first, community optional."""
    subs = _pairs(g, RR + "hasSubreddit", "subreddit_iri")
    top = _technology(g, score_min).join(subs, "s", "left") \
        .orderBy(F.desc("score"), "s", "subreddit_iri").limit(limit)
    return top.select(V.last_segment(F.col("s")).alias("post_id"), "score", "subreddit_iri")


def posts_by_subreddit(g) -> DataFrame:
    """CQ1: posts per community, largest first."""
    return _pairs(g, RR + "hasSubreddit", "subreddit_iri") \
        .join(of_type(g, "Post"), "s", "left_semi").groupBy("subreddit_iri") \
        .agg(F.count(F.lit(1)).cast("bigint").alias("post_count")) \
        .orderBy(F.desc("post_count"), "subreddit_iri")


def high_score_tech(g, limit: int = 10) -> DataFrame:
    """CQ2: the ten best Technology posts with score > 100 and the community's plain name.

    The ten rows are chosen before their labels are looked up.
    """
    subs = _pairs(g, RR + "hasSubreddit", "sub")
    order = [F.desc("score"), F.col("s"), F.col("sub")]
    top = _technology(g, 100).join(subs, "s").orderBy(*order).limit(limit)
    labels = _pairs(g, V.RDFS + "label", "label").withColumnRenamed("s", "sub")
    name = F.regexp_replace(F.coalesce("label", F.lit("None")), "^r/", "")
    return top.join(labels, "sub", "left").orderBy(*order, "label").limit(limit) \
        .select(V.last_segment(F.col("s")).alias("post_id"), "score", name.alias("subreddit"))


def post_types(g) -> DataFrame:
    """CQ3: posts per content type, largest first."""
    return _pairs(g, RR + "hasPostType", "o").join(of_type(g, "Post"), "s", "left_semi") \
        .groupBy(V.local_name(F.col("o")).alias("post_type")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n")).orderBy(F.desc("n"), "post_type")


def semantic_features(g) -> DataFrame:
    """(reddit_id, post_type, topic, score, comment_count) per post and topic.

    The single-valued predicates are gathered by one aggregation on the subject; the result
    is already partitioned for the optional topic join.
    """
    wanted = {RR + "redditId": "reddit_id", RR + "hasPostType": "tipo", RR + "score": "score",
              V.SCHEMA + "commentCount": "comment_count"}
    is_post = (F.col("p") == V.RDF_TYPE) & (F.col("o") == RR + "Post")
    rows = source_of(g)(*wanted).unionByName(source_of(g)(V.RDF_TYPE, obj=RR + "Post"))
    core = rows.groupBy("s").agg(
        F.bool_or(is_post).alias("post"),
        *[F.min(F.when(F.col("p") == p, F.col("o"))).alias(n) for p, n in wanted.items()]
    ).filter("post and reddit_id is not null and tipo is not null and score is not null "
             "and comment_count is not null")
    topics = _pairs(g, RR + "hasTopic", "tema")
    return core.join(topics, "s", "left").select(
        "reddit_id", V.local_name(F.col("tipo")).alias("post_type"),
        V.local_name(F.col("tema")).alias("topic"), F.col("score").try_cast("bigint").alias("score"),
        F.col("comment_count").try_cast("bigint").alias("comment_count")).orderBy("reddit_id")


def semantic_distribution(features: DataFrame) -> DataFrame:
    """Posts per content type and per topic; missing topics form a group of their own."""
    cells = F.array(
        F.struct(F.lit("post_type").alias("rasgo"), F.col("post_type").alias("valor")),
        F.struct(F.lit("topic").alias("rasgo"), F.col("topic").alias("valor")))
    return features.select(F.explode(cells).alias("x")).groupBy("x.rasgo", "x.valor") \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
