"""Predicates and labels on a star rating and its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rating scale and its split into classes.
VALID_STARS = (1, 2, 3, 4, 5)
NEGATIVE_STARS = (1, 2)
NEUTRAL_STARS = (3,)
POSITIVE_STARS = (4, 5)


def is_invalid_rating(stars: Column) -> Column:
    """True off the scale; null for a null rating, which is counted apart."""
    return ~stars.isin(*VALID_STARS)


def is_blank(text: Column, strict: bool = False) -> Column:
    """Text that is present but empty after trimming.

    Only spaces are trimmed by default, so a tab alone is not blank. ``strict``
    counts every kind of white space.
    """
    if strict:
        return text.isNotNull() & ~text.rlike(r"(?U)\S")
    return text.isNotNull() & (F.length(F.trim(text)) == 0)


def has_text(text: Column, strict: bool = False) -> Column:
    """Text that is present and not blank."""
    if strict:
        return text.isNotNull() & text.rlike(r"(?U)\S")
    return text.isNotNull() & (F.length(F.trim(text)) > 0)


def label_from_stars(stars: Column) -> Column:
    """1.0 for 4 and 5 stars, 0.0 for 1 and 2 stars, null for everything else."""
    return F.when(stars.isin(*POSITIVE_STARS), F.lit(1.0)).when(
        stars.isin(*NEGATIVE_STARS), F.lit(0.0)
    )
