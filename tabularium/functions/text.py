"""Text expressions (JVM side, whole texts)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabularium.vocabulary import HEDGES, LIVE_MARKER, STOPWORDS

WORD = r"[\p{L}\p{N}_]+"


def tokens(text: Column) -> Column:
    """Lower-cased word tokens; letters and digits of any script count as word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    """Split after sentence punctuation followed by white space."""
    return F.split(text, r"(?<=[.!?])\s+")


def clean_sentences(text: Column) -> Column:
    """Sentences of a text with line breaks flattened, trimmed, empty ones removed."""
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    # A one-argument lambda: F.trim has two parameters, so transform would pass the index as its trim set.
    return F.filter(F.transform(sentences(flat), lambda s: F.trim(s)), lambda s: s != "")


def words(text: Column) -> Column:
    """White-space separated words without empty pieces."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def strip_markers(text: Column) -> Column:
    """Remove source tags, the live-state header and document headers."""
    no_source = F.regexp_replace(text, r"\[Source:[^\]]*\]\n*", "")
    no_live = F.replace(no_source, F.lit(LIVE_MARKER), F.lit(""))
    return F.trim(F.regexp_replace(no_live, r"DOCUMENT:\s*\S+\s*", ""))


def is_hedged(text: Column) -> Column:
    """True when the text contains an uncertainty phrase."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(p)) for p in HEDGES])


def content_tokens(toks: Column) -> Column:
    """Tokens that are not stop words (repeats kept)."""
    return F.filter(toks, lambda t: ~t.isin(*STOPWORDS))


def strip(text: Column) -> Column:
    """Remove surrounding white space of any kind."""
    return F.trim(text, F.lit(" \t\n\r\x0b\x0c"))
