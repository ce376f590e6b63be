"""Speedup and efficiency of runs over core counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.numbers import ratio, safe_double, safe_long
from ratewise.schema import require_columns


def numeric_runs(rows: DataFrame, keep_unreadable: bool = True) -> DataFrame:
    """Run rows read as text, with ``cores`` and the measures made numbers.

    Unreadable numbers become 0. With ``keep_unreadable`` off they become null
    and rows without a core count are dropped.
    """
    default = 0 if keep_unreadable else None
    columns = {}
    for name in ("cores", "duration_sec", "speedup", "eff"):
        if name in rows.columns:
            read = safe_long if name == "cores" and keep_unreadable else safe_double
            columns[name] = read(F.col(name), default)
    numeric = rows.withColumns(columns)
    return numeric if keep_unreadable else numeric.dropna(subset=["cores"])


def baselines(runs: DataFrame, phase: str = "phase") -> DataFrame:
    """Per phase the run with the fewest cores; of several, the shortest.

    A map-side minimum rather than a window, so a phase that holds most of the
    runs is never gathered in one task.
    """
    require_columns(runs, [phase, "cores", "duration_sec"])
    least = runs.groupBy(phase).agg(F.min(F.struct("cores", "duration_sec")).alias("base"))
    return least.select(
        phase,
        F.col("base.cores").alias("base_cores"),
        F.col("base.duration_sec").alias("base_sec"),
    )


def _with_phase_facts(runs: DataFrame, facts: DataFrame, phase: str) -> DataFrame:
    """Join what is known of each phase; a null phase matches a null phase."""
    facts = facts.withColumnRenamed(phase, "phase_of_facts")
    return runs.join(facts, runs[phase].eqNullSafe(facts["phase_of_facts"])).drop("phase_of_facts")


def _speedup() -> Column:
    return ratio(F.col("base_sec"), F.col("duration_sec"))


def _efficiency(speedup: Column) -> Column:
    return ratio(speedup, ratio(F.col("cores"), F.col("base_cores")))


def scaling_summary(runs: DataFrame, phase: str = "phase") -> DataFrame:
    """Add speedup against the phase's baseline, and efficiency per core.

    Both are 0 where a denominator is not positive. Runs without a phase are a phase
    of their own. The baselines are one row per phase: adaptive execution broadcasts
    them if their true size allows, and the runs stay where they are.
    """
    joined = _with_phase_facts(runs, baselines(runs, phase), phase)
    speedup = _speedup()
    return (
        joined.withColumn("speedup", F.round(speedup, 4))
        .withColumn("eff", F.round(_efficiency(speedup), 4))
        .drop("base_cores", "base_sec")
        .orderBy(phase, "cores", "duration_sec")
    )


def fill_scaling(runs: DataFrame, phase: str = "phase") -> DataFrame:
    """Speedup and efficiency, computed only for phases that lack either.

    A phase lacks a measure when the column is absent or null in all its rows.
    Its rows without a core count or a duration cannot be measured and are left
    out; a phase that has both measures is returned as it is.
    """
    for name in ("speedup", "eff"):
        if name not in runs.columns:
            runs = runs.withColumn(name, F.lit(None).cast("double"))
    measurable = F.col("cores").isNotNull() & F.col("duration_sec").isNotNull()
    state = runs.groupBy(phase).agg(
        F.min(F.when(measurable, F.struct("cores", "duration_sec"))).alias("base"),
        ((F.count("speedup") > 0) & (F.count("eff") > 0)).alias("complete"),
    )
    state = state.select(
        phase,
        "complete",
        F.col("base.cores").alias("base_cores"),
        F.col("base.duration_sec").alias("base_sec"),
    )
    joined = _with_phase_facts(runs, state, phase)
    joined = joined.where(F.col("complete") | measurable)
    speedup = _speedup()
    filled = {
        "speedup": F.when(F.col("complete"), F.col("speedup")).otherwise(speedup),
        "eff": F.when(F.col("complete"), F.col("eff")).otherwise(_efficiency(speedup)),
    }
    return (
        joined.withColumns(filled)
        .drop("complete", "base_cores", "base_sec")
        .orderBy(phase, "cores", "duration_sec")
    )
