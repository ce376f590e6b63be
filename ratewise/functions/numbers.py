"""Tolerant numbers, guarded ratios and key hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
SPECIAL_PATTERN = r"(?i)^[+-]?(inf|infinity|nan)$"


def _stripped(text: Column) -> Column:
    """Outer white space and digit-group underscores removed."""
    bare = F.regexp_replace(text.cast("string"), r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(bare, r"(?<=\d)_(?=\d)", "")


def safe_double(text: Column, default: float | None = 0.0) -> Column:
    """Number in ``text``, or ``default`` when there is none."""
    bare = _stripped(text)
    readable = bare.rlike(NUMBER_PATTERN) | bare.rlike(SPECIAL_PATTERN)
    return F.coalesce(F.when(readable, bare.try_cast("double")), F.lit(default).cast("double"))


def safe_long(text: Column, default: int | None = 0) -> Column:
    """Number in ``text`` cut towards zero, or ``default`` when there is none."""
    bare = _stripped(text)
    whole = F.when(bare.rlike(NUMBER_PATTERN), bare.try_cast("double").try_cast("long"))
    return F.coalesce(whole, F.lit(default).cast("long"))


def ratio(top: Column, bottom: Column, undefined: float | None = 0.0) -> Column:
    """``top / bottom``, or ``undefined`` when the bottom is not positive."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(undefined).cast("double"))


def key_bucket(key: Column, seed: int = 42, buckets: int = 100) -> Column:
    """Bucket of a row from its key alone.

    It does not depend on row order, file layout or the columns selected, so two
    jobs that read the table in different ways agree on every row.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets
