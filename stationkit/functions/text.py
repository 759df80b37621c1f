"""Text normalisation for station names and pollutant labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_only(text: Column) -> Column:
    """Drop every character outside 7-bit ASCII."""
    return F.regexp_replace(text, r"[^\x00-\x7F]+", "")


def has_ascii(text: Column) -> Column:
    """True if something but spaces is left by ``ascii_only``."""
    return text.rlike(r"[\x00-\x1F\x21-\x7F]")


def has_words(text: Column) -> Column:
    """True if something is left by ``slug``."""
    return text.rlike("[A-Za-z0-9]")


def slug(text: Column) -> Column:
    """Lower-case ASCII words joined by single underscores.

    ASCII stripping comes first: lower-casing could otherwise turn a symbol
    such as the Kelvin sign into a plain letter. One pass then replaces each
    run of other characters, so no separate space handling is needed.
    """
    words = F.regexp_replace(F.lower(ascii_only(text)), "[^a-z0-9]+", "_")
    return F.btrim(words, F.lit("_"))


def code(text: Column) -> Column:
    """Upper-case label in which every non-alphanumeric becomes an underscore."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "_")


def is_blank(text: Column) -> Column:
    """True for null, empty and space-only text."""
    return F.coalesce(F.trim(text) == "", F.lit(True))


def null_if_blank(text: Column) -> Column:
    """The text unchanged, or null where it is empty or only spaces."""
    return F.when(F.trim(text) != "", text)
