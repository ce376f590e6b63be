"""Metric reports and run logs."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.schema import normal_name, require_columns


def write_report(report: DataFrame, path: str) -> None:
    """Write a small report as CSV with a header, replacing an older one."""
    report.write.mode("overwrite").option("header", True).csv(path)


def write_columns(df: DataFrame, path: str, names: Sequence[str]) -> None:
    """Write only the named columns as CSV; a column ``df`` lacks stays empty."""
    columns = [F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names]
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def one_row(spark: SparkSession, schema: str, **values: object) -> DataFrame:
    """A run-log row from driver-side values; columns not given are null."""
    names = spark.createDataFrame([], schema).columns
    return spark.createDataFrame([tuple(values.get(name) for name in names)], schema)


def append_run(runs: DataFrame, path: str, schema: str) -> None:
    """Append run rows to the log under its fixed schema.

    Columns are matched by name, so the log keeps one layout whatever the order
    or extra columns of ``runs``; columns it lacks are null.
    """
    columns = []
    for field in runs.sparkSession.createDataFrame([], schema).schema:
        value = F.col(field.name) if field.name in runs.columns else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    runs.select(*columns).write.mode("append").parquet(path)


def scan_run_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def scan_run_csv(
    spark: SparkSession,
    path: str,
    required: Iterable[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A run log kept as CSV by hand, read tolerantly as text columns.

    Header names lose their byte-order mark, padding and upper case; of equal names
    the later ones get their number as a suffix. Quoted cells may hold line ends.
    Short rows end in nulls, surplus cells are dropped, and rows of blanks are skipped.
    ``columns`` replaces the header where that names too few columns.
    """
    if columns is None:
        head = spark.read.options(multiLine=True, escape='"').csv(path).first()
        columns = [cell or f"_c{i}" for i, cell in enumerate(head or ())]
    names = []
    for name in map(normal_name, columns):
        earlier = names.count(name) and sum(1 for n in names if re.sub(r"_\d+$", "", n) == name)
        names.append(f"{name}_{earlier + 1}" if earlier else name)
    text_columns = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rows = spark.read.schema(text_columns).options(header=True, multiLine=True, escape='"').csv(path)
    require_columns(rows, [normal_name(name) for name in required])
    filled = [F.trim(F.coalesce(F.col(f"`{name}`"), F.lit(""))) != "" for name in names]
    some_cell = filled[0]
    for cell in filled[1:]:
        some_cell = some_cell | cell
    return rows.where(some_cell)


def latest_run(log: DataFrame, order: str = "run_id") -> DataFrame:
    """The row of the newest run; no row when the log is empty."""
    newest = log.agg(F.max_by(F.struct("*"), order).alias("run"))
    return newest.where(F.col("run").isNotNull()).select("run.*")


def latest_value(log: DataFrame, column: str, order: str = "run_id") -> DataFrame:
    """One column of the newest run, as a one-row table."""
    require_columns(log, [column, order])
    newest = log.agg(F.max_by(column, order).alias(column))
    return newest.where(F.col(column).isNotNull())
