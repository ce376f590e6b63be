"""Cleaning, labelling, duplicate removal and the key-hash split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.numbers import key_bucket
from ratewise.functions.ratings import has_text, label_from_stars
from ratewise.schema import REVIEW_COLUMNS, project_existing, require_columns
from ratewise.session import durable

TRAIN_PERCENT = 80


def clean_rows(reviews: DataFrame, strict: bool = False) -> DataFrame:
    """Rows whose text is present and not blank."""
    require_columns(reviews, ["text", "stars"])
    return reviews.where(has_text(F.col("text"), strict))


def label_rows(reviews: DataFrame) -> DataFrame:
    """Binary label from the rating; rows without a class are dropped."""
    labeled = reviews.withColumn("label", label_from_stars(F.col("stars")))
    return project_existing(labeled.where(F.col("label").isNotNull()), REVIEW_COLUMNS)


def labeled_reviews(reviews: DataFrame, strict: bool = False) -> DataFrame:
    """Clean, then label."""
    return label_rows(clean_rows(reviews, strict))


def drop_repeated_keys(reviews: DataFrame, key: str = "review_id") -> DataFrame:
    """One row per key: the least one, so a rerun keeps the same row.

    Rows without a key are all kept. Repeated keys are found from the key column
    alone; rows of other keys stay where they are. Of a repeated key each task sends
    its least row only.
    """
    rest = [name for name in reviews.columns if name != key]
    repeated = (
        reviews.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(key)
    )
    single = reviews.join(repeated, key, "left_anti").select(*reviews.columns)
    copies = reviews.join(repeated, key, "left_semi")
    least = copies.groupBy(key).agg(F.min(F.struct(*rest)).alias("row"))
    return single.unionAll(least.select(key, "row.*").select(*reviews.columns))


def drop_repeated_texts(reviews: DataFrame, key: str = "review_id") -> DataFrame:
    """Of rows with exactly the same text keep one, and all rows without a text.

    The one with the least key stays, of rows with that key the one whose content has
    the least hash, and a row without a key only if no copy has one. Texts are
    compared by SHA-256 digest. The first pass shuffles digests, pre-aggregated, and
    stores those that occur more than once. Rows of other texts stay where they are
    if that table is small enough to broadcast; beyond that adaptive execution splits
    the rows of a hot text. Of a repeated text each task sends its best row only.
    """
    digest = F.unhex(F.sha2("text", 256))
    digests = reviews.where(F.col("text").isNotNull()).select(digest.alias("copied"))
    copied = durable(
        digests.groupBy("copied").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("copied"),
        "copied-texts",
    )
    marked = reviews.select(F.struct(*reviews.columns).alias("row"), digest.alias("digest"))
    same = F.col("digest") == F.col("copied")
    single = marked.join(copied, same, "left_anti").select("row.*")
    order = F.struct(
        F.col(f"row.{key}").isNull(), F.col(f"row.{key}"), F.xxhash64("row")
    )
    copies = marked.join(copied, same, "left_semi").groupBy("digest")
    return single.unionAll(copies.agg(F.min_by("row", order).alias("row")).select("row.*"))


def row_content() -> Column:
    """A digest of rating and text, for rows without a key; equal rows are alike."""
    stars = F.coalesce(F.col("stars").cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", stars, F.coalesce("text", F.lit(""))))


def assign_split(
    df: DataFrame, key: str = "review_id", train_percent: int = TRAIN_PERCENT, seed: int = 42
) -> DataFrame:
    """Add ``split``: ``train`` or ``test``, from a hash of the key.

    Rows without a key, and all rows of a table that has none, are split by their
    rating and text, so equal rows share a side.
    """
    if key in df.columns:
        own = F.col(key).cast("string")
        if {"stars", "text"} <= set(df.columns):
            own = F.coalesce(own, row_content())
        else:
            missing = F.raise_error(F.lit(f"rows without {key} need stars and text to be split"))
            own = F.coalesce(own, missing.cast("string"))
    else:
        require_columns(df, ["stars", "text"])
        own = row_content()
    bucket = key_bucket(own, seed)
    return df.withColumn(
        "split", F.when(bucket < train_percent, F.lit("train")).otherwise(F.lit("test"))
    )
