"""Scans and sinks of the review, labelled and feature tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.schema import REVIEW_SCHEMA, require_columns
from ratewise.session import fits_broadcast

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
#: A row of labels is counted as so many bytes.
LABEL_BYTES = 24
MAX_RECORDS_PER_FILE = 300_000


def scan_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Reviews, one JSON object per line.

    Which fields occur is found by a pass over the whole input: text and stars must,
    optional columns that do not are absent. Types are those of ``REVIEW_SCHEMA``. A
    caller who passes a schema vouches for it and saves the pass. A line that is not
    JSON becomes a row of nulls and is counted as such.
    """
    if schema is None:
        found = set(spark.read.json(path).columns)
        schema = T.StructType([field for field in REVIEW_SCHEMA if field.name in found])
        missing = sorted({"text", "stars"} - found)
        if missing:
            raise ValueError(f"missing required columns: {', '.join(missing)}")
    reviews = spark.read.schema(schema).json(path)
    return require_columns(reviews, ["text", "stars"])


def table_texts(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    """The review table without its rating: a plain scan of ``documents``.

    ``partitions`` deals the rows over so many tasks, for tables in few splits.
    """
    documents = spark.read.schema(DOCUMENTS).parquet(f"{folder}/documents.parquet")
    if partitions is not None:
        documents = documents.repartition(partitions)
    return documents.select(
        F.col("doc_id").alias("review_id"),
        F.col("lang").alias("user_id"),
        F.col("source").alias("business_id"),
        "text",
    )


def table_reviews(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    """The review table as a view of the ``documents`` and ``labels`` tables.

    Unlabelled documents take the neutral rating. Labels are sent to the texts while they
    are few, so that no text moves; as ``labels`` grows with the data, its size decides.
    """
    labels = spark.read.schema(LABELS).parquet(f"{folder}/labels.parquet")
    if fits_broadcast(spark, lambda: LABEL_BYTES * labels.count()):
        labels = F.broadcast(labels)
    quality, toxic = F.col("quality"), F.col("toxic")
    stars = (
        F.when((quality == 0) & (toxic == 1), 1.0)
        .when((quality == 0) & (toxic == 0), 2.0)
        .when((quality == 1) & (toxic == 1), 4.0)
        .when((quality == 1) & (toxic == 0), 5.0)
        .otherwise(3.0)
    )
    texts = table_texts(spark, folder, partitions)
    rated = texts.join(labels, texts["review_id"] == labels["doc_id"], "left")
    return rated.select("review_id", "user_id", "business_id", stars.alias("stars"), "text")


def scan_labeled(spark: SparkSession, path: str) -> DataFrame:
    """One run of the labelled table; the label comes back from the path."""
    return require_columns(spark.read.parquet(path), ["text", "label"])


def write_labeled(
    labeled: DataFrame,
    path: str,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    compact: bool = False,
) -> None:
    """Write labelled rows, one folder per label, replacing an older table.

    Rows go straight from the scan to the files: hashing on a two-valued label
    would send the whole table through two tasks. ``compact`` adds one shuffle
    that merges small files and still splits each label over many tasks.
    """
    if compact:
        labeled = labeled.hint("rebalance", "label")
    (
        labeled.write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("label")
        .parquet(path)
    )


#: Partition column of a table that holds many runs, and the ids that name a folder.
RUN = "run_id"
RUN_ID = re.compile(r"[A-Za-z0-9_.-]+")


def write_run(
    labeled: DataFrame,
    path: str,
    run_id: str,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    compact: bool = False,
) -> None:
    """Write one run into a table of many, by run and label.

    A run of the same id is replaced as a whole, labels that it no longer has included;
    other runs stay as they are. The id comes back from the path, as text.
    """
    if not RUN_ID.fullmatch(run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    write_labeled(labeled, f"{path}/{RUN}={run_id}", max_records_per_file, compact)


def run_ids(spark: SparkSession, path: str) -> list[str]:
    """The ids of all runs of a table, in their order, by its folders alone."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(name[len(RUN) + 1 :] for name in names if name.startswith(f"{RUN}="))


def scan_runs(spark: SparkSession, path: str, run_id: str | None = None, newest: bool = False) -> DataFrame:
    """All runs of a table as one, with their ``run_id``; or a single one, or the newest.

    The newest is the greatest id. Folders of other runs are not opened. An unknown run
    gives no rows; a table without any run raises.
    """
    found = run_ids(spark, path)
    if not found:
        raise ValueError(f"no run in {path}")
    # ids are text, even where they look like numbers
    kinds = spark.read.parquet(path).schema
    kinds = T.StructType([T.StructField(f.name, T.StringType()) if f.name == RUN else f for f in kinds])
    runs = require_columns(spark.read.schema(kinds).parquet(path), ["text", "label"])
    wanted = found[-1] if newest else run_id
    return runs if wanted is None else runs.where(F.col(RUN) == wanted)


def scan_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The feature table, or only one side of its split.

    The split is a folder of the table, so the other side is never opened.
    """
    features = require_columns(spark.read.parquet(path), ["features", "label"])
    return features if split is None else features.where(F.col("split") == split)


def write_features(features: DataFrame, path: str) -> None:
    """Write the feature table, replacing an older one."""
    writer = features.write.mode("overwrite")
    if "split" in features.columns:
        writer = writer.partitionBy("split")
    writer.parquet(path)
