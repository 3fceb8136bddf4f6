"""License scan with a positional rare-token index, in DataFrame functions only.

Templates are word sequences of license notices.  The index is a literal table: every template with its
words, their inverse document frequency over the scanned files, and the places of its mandatory key phrases.
A file looks up which templates have their rarest words in it; the places of these words, less their
places in the template, are intersected to alignments; an alignment counts if all mandatory key phrases
stand at their places.  The index is data, so the plan is the same for any number of templates.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from veleta.functions.once import add_once, bind

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The only other character whose lower case is an ASCII letter; it is not part of A-Z.
KELVIN, KEPT = "\u212a", "\ue000"

# The phrases that every scan counts, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# (label, words, mandatory key phrases inside the words); customary wording of license notices.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ("permission is hereby granted free of charge", "of this software")),
    ("apache-2", "licensed under the apache license version 2 0 the license", ("apache license version 2",)),
    ("apache-2", "licensed under the apache 2 0 license", ("apache 2 0 license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use in source and binary forms",)),
    ("gpl", "under the terms of the gnu general public license", ("gnu general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license",
     ("creative commons attribution sharealike",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license",
     ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "cc by sa", ("cc by sa",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
    ("gpl", "gnu general public license version 3", ("gnu general public license version 3",)),
    ("mit", "released under the mit license", ("the mit license",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of digits, ASCII letters and characters beyond ASCII."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(KEPT)))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


INDEX = ("array<struct<label:string, base:boolean, words:array<string>, idf:array<double>, total:double, whole:boolean, "
         "must:array<struct<at:int, word:string>>, rare:array<struct<at:int, word:string>>>>")


def document_counts(docs: DataFrame, templates=TEMPLATES, text_col: str = "text") -> DataFrame:
    """(word, df) for every template word that occurs, and ('', number of rows); one row per
    template word at most, counted over all rows."""
    vocabulary = sorted({w for _, words, _ in templates for w in words.split()})
    have = F.array_intersect(words_of(F.col(f"`{text_col}`")), _literal(vocabulary, "array<string>"))
    return (docs.select(F.explode(F.concat(F.array(F.lit("")), have)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("df")))


def _literal(value, kind: str) -> Column:
    """A nested literal; it is parsed once, when the query is planned."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def entry(label: str, words: str, keys: tuple[str, ...], base: bool, df: dict[str, int], rarest: int) -> dict:
    """The index entry of a template: mandatory places and, by document counts, its rarest words."""
    listed = words.split()
    must: dict[int, str] = {}
    for key in keys:
        k = key.split()
        at = next(i for i in range(len(listed)) if listed[i:i + len(k)] == k)
        must |= {at + j: w for j, w in enumerate(k)}
    idf = [math.log((df.get("", 0) + 1) / max(1, df.get(w, 0))) for w in listed]
    rare: dict[str, int] = {}
    for i in sorted(must, key=lambda i: (-idf[i], i)):
        if len(rare) < rarest:
            rare.setdefault(listed[i], i)
    pairs = lambda d: [{"at": i, "word": w} for i, w in d]
    return {"label": label, "base": base, "words": listed, "idf": idf, "total": sum(idf) or 1.0,
            "whole": len(must) == len(listed) or not sum(idf), "must": pairs(sorted(must.items())),
            "rare": pairs((i, w) for w, i in rare.items())}


def _starts(t: Column, words: Column, postings: Column) -> Column:
    """Starts of all alignments of template ``t`` on which its rare words agree and every key phrase stands."""
    def aligned(r: Column) -> Column:
        return F.transform(F.filter(postings, lambda p: p["word"] == r["word"]), lambda p: p["at"] - r["at"])

    first = aligned(F.get(t["rare"], F.lit(0)))
    common = F.aggregate(F.slice(t["rare"], 2, F.size(t["rare"])), first, lambda found, r: F.array_intersect(found, aligned(r)))
    stands = lambda s: F.forall(t["must"], lambda m: F.coalesce(F.get(words, s + m["at"]) == m["word"], F.lit(False)))
    return F.filter(common, lambda s: (s >= 0) & stands(s))


def _coverage(t: Column, words: Column, starts: Column) -> Column:
    """Best share of the notice's words that stand at a verified place, weighted by idf."""
    def share(s: Column) -> Column:
        part = F.transform(t["words"], lambda w, i: F.when(F.get(words, s + i) == w, F.get(t["idf"], i)).otherwise(0.0))
        return F.least(F.lit(1.0), F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / t["total"])

    return F.when(t["whole"], F.lit(1.0)).otherwise(F.array_max(F.transform(starts, share)))


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE, rarest: int = 3, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base (places of a base phrase), first_word, last_word (smallest and
    largest start of one, else null), base_labels, labels (those and the templates'; sorted,
    distinct, comma-joined) and score (share of the words of the best verified notice, weighted by
    inverse document frequency; 0 without label).

    The document counts of the template words (at most one row each) are collected first and choose
    every template's ``rarest`` words; the scan itself is row by row and shuffles nothing.  All
    words and places of a text count, however long it is.

    Null and empty texts have no words and no labels.  Several templates of one label or at one place each
    count; the best decides the score.  Repeated rows are scanned once each, an empty table gives an empty
    one, other columns are ignored.
    """
    known = [(label, phrase, (phrase,)) for phrase, label in base]
    extra = [t for t in templates if t not in known]
    df = {r[0]: r[1] for r in document_counts(docs, (*known, *extra), text_col).collect()}
    entries = [entry(*t, k < len(known), df, rarest) for k, t in enumerate((*known, *extra))]
    rare_words = _literal(sorted({r["word"] for e in entries for r in e["rare"]}), "array<string>")
    index = _literal(entries, INDEX)

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = add_once(rows, w=words_of(F.col("text"))).drop("text")
    # The rare license words of the file (by hash), and the templates that have all of theirs in it.
    rows = add_once(rows, here=F.array_intersect("w", rare_words))
    possible = lambda here: F.filter(index, lambda t: F.forall(t["rare"], lambda r: F.array_contains(here, r["word"])))
    none = F.lit(None).cast(INDEX)
    rows = add_once(rows, t=F.when(F.size("here") > 0, possible(F.col("here"))).otherwise(none))
    wanted = F.array_distinct(F.flatten(F.transform("t", lambda t: F.transform(t["rare"], lambda r: r["word"]))))
    posted = bind(wanted, lambda own: F.filter(F.transform("w", lambda x, i: F.struct(x.alias("word"), i.alias("at"))),
                                               lambda p: F.array_contains(own, p["word"])))
    rows = add_once(rows, p=F.when(F.size("t") > 0, posted))
    w, p = F.col("w"), F.col("p")
    found = F.filter(F.transform("t", lambda t: F.struct(t.alias("t"), _starts(t, w, p).alias("s"))), lambda x: F.size(x["s"]) > 0)
    rows = add_once(rows, n=F.size("w"), f=F.transform(found, lambda x: F.struct(
        x["t"]["label"].alias("label"), x["t"]["base"].alias("base"), x["s"].alias("s"), _coverage(x["t"], w, x["s"]).alias("share"))))
    found = F.when(F.size("p") > 0, F.col("f")).otherwise(F.array().cast("array<struct<label:string, base:boolean, s:array<int>, share:double>>"))
    own = F.filter(found, lambda x: x["base"])
    places = F.flatten(F.transform(own, lambda x: x["s"]))
    joined = lambda a: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))))
    return rows.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"), joined(own).alias("base_labels"), joined(found).alias("labels"),
        F.coalesce(F.array_max(F.transform(found, lambda x: x["share"])), F.lit(0.0)).alias("score"))
