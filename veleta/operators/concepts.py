"""Concept dictionary matching: whole-word counts per concept in title and body."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from veleta.functions.once import bind
from veleta.functions.text import WORD, count_in, tokens

# One character that is neither part of a word nor white space.
SYMBOL = r"[^\p{L}\p{N}_\s]"

def merge_dictionaries(*parts: DataFrame) -> DataFrame:
    """Union of (concepto, sinonimo) tables: synonyms lower-cased, each pair once."""
    out = None
    for part in parts:
        clean = part.select("concepto", F.lower("sinonimo").alias("sinonimo")) \
            .filter("concepto is not null and sinonimo is not null")
        out = clean if out is None else out.unionByName(clean)
    return out.distinct()


def dictionary_metadata(dictionary: DataFrame) -> dict[str, list[str]]:
    """Concept -> synonyms, as metadata of a table with columns per concept."""
    out: dict[str, list[str]] = {}
    for concepto, sinonimo in sorted((r[0], r[1]) for r in _entries(dictionary).collect()):
        out.setdefault(concepto, []).append(sinonimo)
    return out


def _entries(dictionary: DataFrame) -> DataFrame:
    return dictionary.select("concepto", "sinonimo") \
        .filter("concepto is not null and trim(sinonimo) <> ''").distinct()


def _single(synonyms: list[str]) -> bool:
    return all(re.fullmatch(r"\w+", s) for s in synonyms)


def _pattern(synonyms: list[str]) -> str:
    """A concept's synonyms as whole words, the longest first: matches do not overlap."""
    longest_first = sorted(synonyms, key=lambda s: (-len(s), s))
    quoted = "|".join(r"\Q" + s.replace(r"\E", r"\E\\E\Q") + r"\E" for s in longest_first)
    return f"(?<!{WORD})(?:{quoted})(?!{WORD})"


def _keyword(synonym: str) -> str:
    """The longest word of a synonym; one without words is found by its first character."""
    words = [w for w in re.split(r"\W+", synonym.lower()) if w]
    return max(words, key=len) if words else synonym.strip()[0]


def count_expressions(text: Column, concepts: dict[str, list[str]]) -> Column:
    """Array of counts, one per concept in dictionary order, for one text.

    The text is tokenised once and reduced to dictionary words once.  A concept of single words
    counts over those few hits; one with phrases or symbols uses its pattern, and only on texts
    with one of its keywords.
    """
    words = {c: s for c, s in concepts.items() if _single(s)}
    keys = {c: sorted({_keyword(x) for x in s}) for c, s in concepts.items() if c not in words}
    every = sorted({w for s in (*words.values(), *keys.values()) for w in s})

    def pattern_count(hits: Column, concept: str) -> Column:
        found = F.regexp_count(F.lower(text), F.lit(_pattern(concepts[concept])))
        if all(re.fullmatch(r"\w+", k) for k in keys[concept]):
            return F.when(count_in(hits, keys[concept]) > 0, found).otherwise(0)
        return found

    def all_counts(hits: Column) -> Column:
        return F.array(*[count_in(hits, s) if c in words else pattern_count(hits, c)
                         for c, s in concepts.items()])

    hits = F.filter(tokens(text), lambda t: t.isin(every)) if every else F.array().cast("array<string>")
    return bind(hits, all_counts)


FIRST = rf"^(?:{WORD}+|(?s:.))"


def _starts(around: str, blanks: bool) -> str:
    """Places where a synonym may begin: a word, or another character that follows no word.  White space
    counts only where the dictionary has synonyms that begin with it."""
    other = "(?s:[^" + WORD[1:] + ")" if blanks else SYMBOL
    return f"(?<!{WORD}){around}(?:{WORD}+|{other})"


def synonym_index(dictionary: DataFrame) -> DataFrame:
    """(concepto, sinonimo, primera, largo, sencillo): the synonyms by their first word or symbol;
    ``sencillo`` where all synonyms of the concept are single words, which cannot overlap."""
    entries = _entries(dictionary)
    simple = entries.groupBy("concepto").agg(F.every(F.col("sinonimo").rlike(rf"^{WORD}+$")).alias("sencillo"))
    return entries.join(simple, "concepto").select(
        "concepto", "sinonimo", F.regexp_extract("sinonimo", FIRST, 0).alias("primera"),
        F.length("sinonimo").alias("largo"), "sencillo")


def concept_matches(posts: DataFrame, dictionary: DataFrame, key: str = "id", title: str = "titulo",
                    body: str = "texto") -> DataFrame:
    """(id, concepto, sinonimo, campo, lugar, ocupa, largo, sencillo): every whole-word occurrence of a
    synonym, overlapping ones too; ``campo`` is 0 for the title and 1 for the body.

    A text is walked once.  At every place where a synonym may begin (numbered by ``lugar``) the
    next characters, as many as the longest synonym has, are taken along, so a synonym found by its first word is
    confirmed where it stands and no text is joined back.  ``ocupa`` is how many such places it covers.
    The plan is the same for every dictionary; the engine broadcasts the index when its measured size allows it.
    """
    index = synonym_index(dictionary)
    # The only two facts about the dictionary that the expressions need.
    ahead, blanks = index.agg(F.max(F.col("largo") - F.length("primera")),
                              F.max(F.col("sinonimo").rlike(r"^\s"))).first()
    here = _starts("", bool(blanks))
    ahead = 0 if not ahead else ahead + 1
    context = _starts(rf"(?=((?:{WORD}+|(?s:.))(?s:.{{0,{ahead}}})))", bool(blanks))
    index = index.withColumn("ocupa", F.regexp_count("sinonimo", F.lit(here)))
    fields = F.array(*[F.struct(F.lit(i).alias("campo"), F.lower(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias("t"))
                       for i, c in enumerate((title, body))])
    places = (posts.select(F.col(key).alias("_id"), F.inline(fields))
              .select("_id", "campo", F.posexplode(F.regexp_extract_all("t", F.lit(context), F.lit(1))).alias("lugar", "_texto"))
              .withColumn("primera", F.regexp_extract("_texto", FIRST, 0) if ahead else F.col("_texto")))
    after = F.substr("_texto", F.col("largo") + 1, F.lit(1))
    whole = F.startswith("_texto", "sinonimo") & ~after.rlike(WORD) if ahead else F.lit(True)
    return places.join(index, "primera").filter(whole).select(
        F.col("_id").alias(key), "concepto", "sinonimo", "campo", "lugar", "ocupa", "largo", "sencillo")


def concept_counts(posts: DataFrame, dictionary: DataFrame, key: str = "id",
                   title: str = "titulo", body: str = "texto") -> DataFrame:
    """(id, concepto, n_titulo, n_texto) for the concepts that occur in a post, for a dictionary
    of any size.

    A concept counts its synonyms as whole words, phrases and symbols as written, the first place
    first, there the longest, and without overlap.  Single words are counted as they come; only the matches
    of concepts with phrases or symbols are gathered, per post, to drop the overlapping ones.
    """
    found = concept_matches(posts, dictionary, key, title, body)
    match = F.struct("campo", "lugar", (-F.col("largo")).alias("corto"), "ocupa")
    hits = found.groupBy(key, "concepto").agg(
        F.count_if(F.col("sencillo") & (F.col("campo") == 0)).alias("s0"),
        F.count_if(F.col("sencillo") & (F.col("campo") == 1)).alias("s1"),
        F.sort_array(F.collect_list(F.when(~F.col("sencillo"), match))).alias("m"))
    start = F.struct(F.lit(0).alias("n0"), F.lit(0).alias("n1"), F.lit(-1).alias("campo"), F.lit(0).alias("libre"))

    def step(state: Column, x: Column) -> Column:
        free = (x["campo"] != state["campo"]) | (x["lugar"] >= state["libre"])
        one = lambda f: F.when(free & (x["campo"] == f), 1).otherwise(0)
        return F.struct((state["n0"] + one(0)).alias("n0"), (state["n1"] + one(1)).alias("n1"), x["campo"].alias("campo"),
                        F.when(free, x["lugar"] + x["ocupa"]).otherwise(state["libre"]).cast("int").alias("libre"))

    return (hits.withColumn("c", F.aggregate("m", start, step))
            .select(key, "concepto", (F.col("s0") + F.col("c.n0")).cast("bigint").alias("n_titulo"),
                    (F.col("s1") + F.col("c.n1")).cast("bigint").alias("n_texto")))
