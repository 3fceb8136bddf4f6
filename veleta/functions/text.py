"""Text expressions; all native, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veleta.functions.once import bind

# Java classes written out, because \w and \s are ASCII-only there.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]+"
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NOT_SPACE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"

# Cleaning patterns, applied to lower-cased text in this order.  The address
# class is the range-folded form of the original alternation, which overflows Java's stack.
URL_LOWER = r"https?://[!$-_a-z]+"
MENTIONS = (r"@" + WORD + "+", r"/u/" + WORD + "+", r"u/" + WORD + "+")
URL_LOOSE = r"http" + NOT_SPACE + r"+|www\." + NOT_SPACE + "+"


# The characters of SPACE, for trimming without a pattern.
BLANKS = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
          + "".join(chr(c) for c in range(0x2000, 0x200B)))
# Only the runs that change: two or more, or a single one that is not a plain blank.
UNEVEN = "(?:" + SPACE + "{2,}|[" + SPACE[1:-1] + "&&[^ ]])"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.btrim(c, F.lit(BLANKS))


def _drop(c: Column, marker: str, pattern: str, by: str = "") -> Column:
    """Replace a pattern, skipping the pattern engine for texts without its fixed part.

    The value is bound once, so a chain of steps grows by one step each."""
    return bind(c, lambda t: F.when(F.contains(t, F.lit(marker)), F.regexp_replace(t, pattern, by)).otherwise(t))


def clean_text(c: Column, collapse: bool = True) -> Column:
    """Lower-case, drop addresses and mentions, collapse white space and strip.

    Null gives the empty string.  ``collapse=False`` keeps inner white space as it is.
    The last mention rule also eats inside words ("menu/item" becomes "men").
    """
    out = _drop(F.lower(F.coalesce(c, F.lit(""))), "http", URL_LOWER)
    for marker, pattern in zip(("@", "/u/", "u/"), MENTIONS):
        out = _drop(out, marker, pattern)
    return F.trim(F.regexp_replace(out, UNEVEN, " ")) if collapse else strip(out)


def clean_basic(c: Column) -> Column:
    """Addresses and line breaks become blanks, runs of white space shrink, then lower-case."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), URL_LOOSE, " ")
    out = F.regexp_replace(out, r"[\r\n\t]+", " ")
    out = F.regexp_replace(out, SPACE + "{2,}", " ")
    return F.lower(strip(out))


def model_text(titulo: Column, texto: Column, titulo_limpio: Column, texto_limpio: Column) -> Column:
    """Title and body joined by a line break; a blank cleaned column falls back to the raw one."""
    head = F.coalesce(F.nullif(titulo_limpio, F.lit("")), clean_basic(titulo))
    body = F.coalesce(F.nullif(texto_limpio, F.lit("")), clean_basic(texto))
    return strip(F.concat_ws("\n", F.nullif(head, F.lit("")), F.nullif(body, F.lit(""))))


def word_count(c: Column) -> Column:
    """Pieces between single blanks: the empty string counts 1, double blanks count twice."""
    return F.size(F.split(c, " ", -1))


def tokens(c: Column) -> Column:
    """Lower-cased words; empty strings at the ends are possible and match nothing."""
    return F.split(F.lower(c), NOT_WORD, -1)


def token_count(c: Column) -> Column:
    """Number of words, without the empty pieces at the ends."""
    return F.size(F.array_remove(tokens(c), ""))


def count_in(words: Column, wanted: list[str]) -> Column:
    """How many elements of an array are among ``wanted``."""
    return F.size(F.filter(words, lambda t: t.isin(wanted)))
