"""Column-expression helpers for strings: genres, titles, tags, tokens.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
runs JVM-side inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
NO_GENRE = "(no genres listed)"
YEAR_PATTERN = r"\((\d{4})\)$"            # year at the very end of the title
YEAR_PATTERN_TRIM = r"\((\d{4})\)\s*$"    # runtime variant: trailing blanks allowed
TITLE_YEAR_SUFFIX = r"\s*\(\d{4}\)$"      # stripped to form the clean title
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"      # word runs of >= 2 characters


def extract_year(title: Column, trim_tail: bool = False) -> Column:
    """Release year from ``Title (YYYY)``; null when absent."""
    pat = YEAR_PATTERN_TRIM if trim_tail else YEAR_PATTERN
    return F.nullif(F.regexp_extract(title, pat, 1), F.lit("")).try_cast("int")


def clean_title(title: Column) -> Column:
    """Title without the trailing `` (YYYY)``, trimmed."""
    return F.trim(F.regexp_replace(title, TITLE_YEAR_SUFFIX, ""))


def genre_array(genres: Column, drop_sentinel: bool = True, strip: bool = True) -> Column:
    """Split the pipe list; strip parts, drop blanks (and the sentinel)."""
    parts = F.split(F.coalesce(genres, F.lit("")), r"\|")
    if strip:
        parts = F.transform(parts, lambda g: F.trim(g))
    keep = (lambda g: (g != "") & (g != NO_GENRE)) if drop_sentinel else (lambda g: g != "")
    return F.filter(parts, keep)


def genre_vocab_array(genres: Column) -> Column:
    """Genre tokens as the multi-hot vectoriser sees them: raw pipe split, case
    kept, no strip, null genres count as the sentinel; distinct (binary)."""
    return F.array_distinct(F.split(F.coalesce(genres, F.lit(NO_GENRE)), r"\|"))


def genre_tokens(genres: Column) -> Column:
    """``|`` -> blank, sentinel literal removed."""
    return F.replace(F.replace(genres, F.lit("|"), F.lit(" ")), F.lit(NO_GENRE), F.lit(""))


def normalise_tag(tag: Column) -> Column:
    """lower + trim (P6); null handling is the caller's ``where``."""
    return F.trim(F.lower(tag))


def tokens(text: Column) -> Column:
    """Lower-cased runs of >= 2 word characters, in text order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)
