"""The stages from review file to scaling report, each reading what the last wrote.

Every job takes paths any executor can reach. Tables and logs are written by
Spark; only single metrics come back to the driver.
"""

from __future__ import annotations

import functools
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise import schema
from ratewise.functions.text import stop_words
from ratewise.operators import classifier, labeling, metrics, profile, scaling
from ratewise.session import durable, work_tables
from ratewise.sources import reviews as tables
from ratewise.sources import runlog

RUN_ID_FORMAT = "%Y%m%d_%H%M%S"


def new_run_id() -> str:
    """Run id from the clock; ids sort in the order of their runs, and no two are equal."""
    return f"{datetime.now(timezone.utc).strftime(RUN_ID_FORMAT)}_{uuid.uuid4().hex[:6]}"


def job(run: Callable) -> Callable:
    """A job removes its intermediate tables when it ends."""

    @functools.wraps(run)
    def wrapped(spark: SparkSession, *args, **options):
        with work_tables(spark):
            return run(spark, *args, **options)

    return wrapped


def _session_values(spark: SparkSession) -> dict[str, object]:
    settings = spark.sparkContext.getConf()
    return {
        "spark_master": spark.sparkContext.master,
        "driver_memory": settings.get("spark.driver.memory", "default"),
        "executor_memory": settings.get("spark.executor.memory", "default"),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }


def _first(df: DataFrame, what: str) -> dict[str, object]:
    row = df.first()
    if row is None:
        raise ValueError(f"{what} is empty")
    return row.asDict()


@job
def ingest(spark: SparkSession, input_path: str, out: str) -> str:
    """First look at a review file: columns, rating histogram and a sample.

    The file is parsed once to see which fields it has and once to store it.
    """
    raw = durable(tables.scan_json_lines(spark, input_path), "raw")
    runlog.write_report(profile.column_profile(raw, approximate=True), f"{out}/column_profile")
    runlog.write_report(profile.histogram(raw, "stars"), f"{out}/rating_histogram")
    runlog.write_report(profile.sample_rows(raw), f"{out}/sample_rows")
    return out


@job
def validate(spark: SparkSession, input_path: str, out: str) -> str:
    """Data-quality report of a JSON-lines review file; returns its path."""
    path = f"{out}/validation_report"
    raw = tables.scan_json_lines(spark, input_path)
    runlog.write_report(profile.validation_profile(raw, store_facts=True), path)
    return path


@job
def label(
    spark: SparkSession, input_path: str, out: str, run_id: str | None = None, runs: str | None = None
) -> str:
    """Clean and label a review file; returns the path of the labelled table.

    The file is parsed once to see which fields it has and once to store it; rows are
    counted from what was stored.

    Every run has a folder of its own, so a later scan reads exactly one run. ``runs`` names
    a table of many runs to write into as well, which ``build_features`` reads as one.
    """
    run_id = run_id or new_run_id()
    path = f"{out}/labeled/{run_id}"
    raw = durable(tables.scan_json_lines(spark, input_path), "raw")
    tables.write_labeled(labeling.labeled_reviews(raw), path)
    if runs is not None:
        tables.write_run(tables.scan_labeled(spark, path), runs, run_id)
    labeled, before = tables.scan_labeled(spark, path), raw.count()
    runlog.write_report(profile.stored_labeling_report(labeled, before), f"{out}/labeling_report")
    row = runlog.one_row(
        spark,
        schema.LABELING_LOG,
        run_id=run_id,
        total_before=before,
        total_after=labeled.count(),
        out_parquet=path,
    )
    runlog.append_run(row, f"{out}/labeling_log", schema.LABELING_LOG)
    return path


@job
def build_features(
    spark: SparkSession,
    labeled_path: str | None,
    out: str,
    run_id: str | None = None,
    key: str = "review_id",
    fit_on: str = "train",
    min_documents: int = classifier.MIN_DOCUMENTS,
    vocab_size: int = classifier.VOCAB_SIZE,
    keep_negations: bool = False,
    unicode_words: bool = False,
    partitions: int | None = None,
) -> str:
    """Feature table and saved feature model; returns the run id.

    Without a path the newest labelled table is taken. ``partitions`` deals its rows
    over so many tasks, for a table of few files.
    """
    run_id = run_id or new_run_id()
    if labeled_path is None:
        log = runlog.scan_run_log(spark, f"{out}/labeling_log", schema.LABELING_LOG)
        labeled_path = _first(runlog.latest_value(log, "out_parquet"), "labeling log")["out_parquet"]
    labeled = tables.scan_labeled(spark, labeled_path)
    if partitions is not None:
        labeled = labeled.repartition(partitions)
    model, features = classifier.split_features(
        labeled,
        key,
        fit_on,
        vocab_size=vocab_size,
        min_documents=min_documents,
        words=stop_words(keep_negations),
        unicode_words=unicode_words,
    )
    out_parquet, out_model = f"{out}/features/{run_id}", f"{out}/models/features-{run_id}"
    tables.write_features(features, out_parquet)
    classifier.save_model(model.stages, out_model)
    row = runlog.one_row(
        spark,
        schema.FEATURE_LOG,
        run_id=run_id,
        total_rows=tables.scan_features(spark, out_parquet).count(),
        vocab_uni=model.unigrams,
        vocab_bi=model.bigrams,
        out_parquet=out_parquet,
        out_model=out_model,
    )
    runlog.append_run(row, f"{out}/feature_log", schema.FEATURE_LOG)
    return run_id


def _split_counts(features: DataFrame) -> dict[str, int]:
    counts = features.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(F.col("split") == "train").alias("rows_train"),
        F.count_if(F.col("split") == "test").alias("rows_test"),
    )
    return _first(counts, "feature table")


@job
def train(spark: SparkSession, out: str, run_id: str | None = None) -> str:
    """Train on the newest feature table, log test metrics; returns the run id."""
    started, clock = datetime.now(timezone.utc), time.monotonic()
    run_id = run_id or new_run_id()
    log = runlog.scan_run_log(spark, f"{out}/feature_log", schema.FEATURE_LOG)
    path = _first(runlog.latest_value(log, "out_parquet"), "feature log")["out_parquet"]
    sides = _split_counts(tables.scan_features(spark, path))
    if not sides["rows_train"] or not sides["rows_test"]:
        raise ValueError(f"one side of the split is empty: {sides}")
    model = classifier.train_classifier(tables.scan_features(spark, path, "train"))
    model_path = f"{out}/models/classifier-{run_id}"
    classifier.save_model(model, model_path)
    test = tables.scan_features(spark, path, "test").select("label", "features")
    found = _first(metrics.evaluation_metrics(classifier.score_rows(model, test)), "test side")
    row = runlog.one_row(
        spark,
        schema.TRAINING_LOG,
        run_id=run_id,
        start_ts=started,
        features_path=path,
        model_path=model_path,
        acc=found["accuracy"],
        f1=found["f1"],
        precision=found["weighted_precision"],
        recall=found["weighted_recall"],
        auc=found["auc"],
        **sides,
        **_session_values(spark),
        duration_sec=time.monotonic() - clock,
    )
    runlog.append_run(row, f"{out}/training_log", schema.TRAINING_LOG)
    return run_id


@job
def evaluate(spark: SparkSession, out: str, run_id: str | None = None) -> str:
    """Reload the newest model, score the same test side, log every metric."""
    started, clock = datetime.now(timezone.utc), time.monotonic()
    run_id = run_id or new_run_id()
    log = runlog.scan_run_log(spark, f"{out}/training_log", schema.TRAINING_LOG)
    trained = _first(runlog.latest_run(log), "training log")
    path = trained["features_path"]
    model = classifier.load_classifier(trained["model_path"])
    test = tables.scan_features(spark, path, "test").select("label", "features")
    found = _first(metrics.evaluation_metrics(classifier.score_rows(model, test)), "test side")
    row = runlog.one_row(
        spark,
        schema.EVALUATION_LOG,
        eval_run_id=run_id,
        start_ts=started,
        features_path=path,
        model_path=trained["model_path"],
        source_training_run_id=trained["run_id"],
        **{**found, **_split_counts(tables.scan_features(spark, path))},
        **_session_values(spark),
        duration_sec=time.monotonic() - clock,
    )
    runlog.append_run(row, f"{out}/evaluation_log", schema.EVALUATION_LOG)
    return run_id


def summarise_scaling(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    phase: str,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Speedup and efficiency of a hand-kept run log, written as CSV."""
    rows = runlog.scan_run_csv(spark, input_path, ["cores", "duration_sec", *extra])
    runs = scaling.numeric_runs(rows).withColumn("phase", F.lit(phase))
    summary = scaling.scaling_summary(runs)
    runlog.write_columns(summary, output_path, ["cores", "duration_sec", "speedup", "eff", *extra])
    return summary
