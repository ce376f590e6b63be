"""From raw documents to token digests of clean training text, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns the rows it keeps with the columns of ``documents``; the last one returns
what encoding and decoding makes of them.

Null and empty texts are kept by every stage unless a classifier rejects them; of all texts
without words one stays. Null and repeated ids are kept: rows are judged by their texts, and
of equal rows one stays, as of all near copies. Ties go to the least id, and where ids do not
tell rows apart to the least hash of the row. Very long texts are never cut; memory follows
the longest. Columns of any other name pass all stages but the last as they are. Empty tables
give no rows, and models learned from no labels reject nothing they have no reason for.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import bpe, decontam, quality, simhash, toxicity
from ratewise.llm.labelled import in_fold
from ratewise.llm.queries import table
from ratewise.session import durable


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    held_out = in_fold(F.col("doc_id"), 3, 1)
    weights = quality.train(docs, table(spark, sf_dir, "labels"), "quality", held_out)
    return quality.accepted(docs, weights)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not found toxic."""
    held_out = in_fold(F.col("doc_id"), 3, 1)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", held_out)
    return toxicity.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link: shingles of three words, three
    differing bits at most, and no other check."""
    return simhash.one_of_each(docs, simhash.CLOSE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and the decoded text."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: Models learned by descent and bit votes over hashes have no SQL form; tests hold
#: each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
