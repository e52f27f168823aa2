"""Text column functions, all Catalyst expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .entities import decode_entities

# Fixed patterns.
TAG_PATTERN = r"(?d)<.*?>"        # (?d): only a line feed ends a line
NON_ALNUM_SPACE = r"[^a-z0-9\s]"
WHITESPACE_RUN = r"\s+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_for_storage(c) -> Column:
    """Ingest cleaner: HTML character references decoded, tags -> space, lower case, every
    character outside [a-z0-9 whitespace] -> space, runs of whitespace
    collapsed, trimmed; empty result -> null."""
    t = decode_entities(_c(c).cast("string"))
    t = F.regexp_replace(t, TAG_PATTERN, " ")
    t = F.lower(t)
    t = F.regexp_replace(t, NON_ALNUM_SPACE, " ")
    t = F.trim(F.regexp_replace(t, WHITESPACE_RUN, " "))
    return F.nullif(t, F.lit(""))


def clean_for_shingles(c) -> Column:
    """Near-duplicate cleaner: lower case, characters outside
    [a-z0-9 whitespace] deleted (not replaced), trimmed."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), NON_ALNUM_SPACE, ""))


def tokens(c) -> Column:
    """Whitespace tokens of an already cleaned text."""
    return F.split(_c(c), WHITESPACE_RUN)


def ngrams(tok, n: int = 3) -> Column:
    """Word n-grams joined by one space, in text order, duplicates kept
    (the MLlib NGram transformer's output); empty when fewer than n tokens.

    Built from n shifted slices zipped together, so the work is linear in
    the number of tokens (no per-gram lambda over the whole token array).
    """
    t = _c(tok)
    m = F.size(t) - n + 1
    shifted = [F.slice(t, k + 1, F.greatest(m, F.lit(1))) for k in range(n)]
    zipped = F.arrays_zip(*shifted)
    grams = F.transform(zipped, lambda z: F.concat_ws(" ", *[z[str(k)] for k in range(n)]))
    return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))


def shingle_set(tok, n: int = 3) -> Column:
    """Distinct word n-grams: the set a Jaccard similarity is taken over."""
    return F.array_distinct(ngrams(tok, n))


def concat_parts(*cols) -> Column:
    """Join the non-blank parts by one space; null when every part is blank."""
    parts = [F.when(F.trim(_c(x)) != "", _c(x)) for x in cols]
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))
