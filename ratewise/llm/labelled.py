"""Bounded, repeatable samples of labelled texts, and the fold that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text leaves the remainder ``fold``; a null key never does."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, held_out: Column
) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` labelled ids of each class, one row each.

    Ids come from the label table alone, in the order of their hash, so the draw
    does not depend on how the tables are laid out. At most ``2 * per_class`` ids
    are broadcast to the documents; of an id that has several rows the text with the
    least hash stays, and each task shuffles one text of an id at most. An id labelled
    both ways, or with null, is left out.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out)
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("most"))
        .where("label = most")
        .select(F.col("doc_id").alias("labelled_id"), "label")
    )
    order = (F.xxhash64("labelled_id"), F.col("labelled_id"))
    chosen = [known.where(F.col("label") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    ids = F.broadcast(chosen[0].unionAll(chosen[1]))
    return (
        docs.join(ids, docs["doc_id"] == ids["labelled_id"])
        .groupBy(docs["doc_id"], ids["label"])
        .agg(F.min_by(docs["text"], F.xxhash64(docs["text"])).alias("text"))
        .select("doc_id", "text", "label")
    )
