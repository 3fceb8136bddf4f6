"""Language scoring by stop words, row-local and native."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veleta.functions.once import bind
from veleta.functions.text import count_in, tokens

STOP_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "and", "of", "to", "is", "in", "that", "it", "for", "was", "with", "on", "are",
           "you", "this", "what", "not"),
    "es": ("el", "los", "las", "y", "que", "una", "por", "con", "del", "como", "más", "pero",
           "para", "está", "al", "lo", "su"),
    "fr": ("le", "les", "et", "des", "du", "dans", "est", "qui", "pour", "une", "au", "avec",
           "aux", "ce", "pas", "sur"),
    "de": ("der", "die", "und", "das", "ist", "ein", "nicht", "mit", "den", "von", "zu", "auf",
           "für", "dem", "im", "sich"),
}


def language(c: Column, unknown: str = "und") -> Column:
    """Language with most stop-word hits; ties go to the first of ``STOP_WORDS``.

    The words of the row are filtered once against all lists; each language then only
    looks at the few hits, so the row is tokenised and scanned a single time.
    """
    every = [w for words in STOP_WORDS.values() for w in words]
    hits = F.filter(tokens(c), lambda t: t.isin(every))

    def scored(found: Column) -> Column:
        counts = {lang: count_in(found, list(words)) for lang, words in STOP_WORDS.items()}
        best = F.greatest(*counts.values())
        out = F.lit(unknown)
        for lang in reversed(STOP_WORDS):
            out = F.when((counts[lang] == best) & (best > 0), lang).otherwise(out)
        return out

    return bind(hits, scored)
