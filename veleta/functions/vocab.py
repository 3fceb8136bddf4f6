"""Graph vocabulary: IRIs, name normalisation, post types and topics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veleta.functions.text import strip

# Namespaces.
RR = "http://example.org/reddit-ontology#"
BASE = "http://example.org/reddit/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCT = "http://purl.org/dc/terms/"
PROV = "http://www.w3.org/ns/prov#"
SCHEMA = "https://schema.org/"

# Topic of a community, and the older five-topic grouping.
TOPICS = {
    "technology": "Technology",
    "technews": "TechNews",
    "machinelearning": "MachineLearning",
    "artificialintelligence": "ArtificialIntelligence",
    "worldnews": "WorldNews",
    "science": "Science",
    "politics": "Politics",
    "business": "Business",
    "economics": "Economics",
    "health": "Health",
}
POST_TYPES = ("TextPost", "VideoPost", "GalleryPost", "LinkPost")
COARSE_TOPICS = {
    "Technology": ("technology", "technews", "machinelearning", "programming"),
    "WorldNews": ("worldnews",),
    "Science": ("science", "health"),
    "Politics": ("politics",),
    "Economics": ("business", "economics"),
}


def iri_safe(c: Column) -> Column:
    return F.translate(c, " /", "__")


def norm_subreddit(c: Column) -> Column:
    """Trimmed, lower-cased name; null for null or blank names."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def post_type(es_texto: Column, es_video: Column, es_galeria: Column, pista: Column) -> Column:
    """First rule that holds wins; null flags count as false."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (F.when(yes(es_texto), "TextPost").when(yes(es_video), "VideoPost")
            .when(yes(es_galeria), "GalleryPost").when(pista == "link", "LinkPost")
            .otherwise("TextPost"))


def topic(subreddit: Column) -> Column:
    """Topic of the normalised community name, null when it has none."""
    name = norm_subreddit(subreddit)
    return F.try_element_at(
        F.create_map(*[F.lit(x) for kv in TOPICS.items() for x in kv]), name)


def coarse_topic(subreddit: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, members in COARSE_TOPICS.items():
        out = F.when(F.lower(subreddit).isin(*members), name).otherwise(out)
    return out


def local_name(c: Column) -> Column:
    """Part after the last '#'; the whole value when there is none."""
    return F.substring_index(c, "#", -1)


def last_segment(c: Column) -> Column:
    return F.substring_index(c, "/", -1)
