"""Schemas and the checks and projections made on column names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and types of the review table and of the run logs.
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)
REVIEW_COLUMNS = ("review_id", "user_id", "business_id", "date", "stars", "text", "label")
SAMPLE_COLUMNS = ("stars", "text", "date", "user_id", "business_id")

FEATURE_LOG = (
    "run_id string, total_rows long, vocab_uni int, vocab_bi int, "
    "out_parquet string, out_model string"
)
LABELING_LOG = "run_id string, total_before long, total_after long, out_parquet string"
TRAINING_LOG = (
    "run_id string, start_ts timestamp, duration_sec double, spark_master string, "
    "driver_memory string, executor_memory string, shuffle_partitions int, "
    "features_path string, rows_total long, rows_train long, rows_test long, "
    "model_path string, acc double, f1 double, precision double, recall double, auc double"
)
EVALUATION_LOG = (
    "eval_run_id string, start_ts timestamp, duration_sec double, spark_master string, "
    "driver_memory string, executor_memory string, model_path string, "
    "features_path string, rows_total long, rows_train long, rows_test long, "
    "accuracy double, f1 double, weighted_precision double, weighted_recall double, "
    "auc double, tp long, fp long, tn long, fn long, pos_precision double, "
    "pos_recall double, source_training_run_id string"
)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` itself, or ``ValueError`` naming the columns it lacks."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def project_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that ``df`` has, in the order of the list."""
    return df.select(*[name for name in names if name in df.columns])


def normal_name(name: str) -> str:
    """Header cell without byte-order mark, outer white space and upper case."""
    return name.replace("\ufeff", "").strip().lower()
