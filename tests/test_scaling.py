import pytest
from pyspark.sql import functions as F

from ratewise.operators import scaling

GOLDEN = [
    ("train", 2, 277.90, 1.0000, 1.0000),
    ("train", 4, 209.68, 1.3254, 0.6627),
    ("train", 8, 209.33, 1.3276, 0.3319),
    ("train", 16, 303.11, 0.9168, 0.1146),
    ("eval", 2, 242.43, 1.0000, 1.0000),
    ("eval", 4, 173.74, 1.3954, 0.6977),
    ("eval", 8, 118.31, 2.0491, 0.5123),
    ("eval", 16, 166.20, 1.4587, 0.1823),
]
RUNS = "phase string, cores long, duration_sec double"


def test_golden_summary(spark):
    df = spark.createDataFrame([row[:3] for row in GOLDEN], RUNS)
    assert sorted(map(tuple, scaling.scaling_summary(df).collect())) == sorted(GOLDEN)
    assert {tuple(r) for r in scaling.baselines(df).collect()} == {
        ("train", 2, 277.90), ("eval", 2, 242.43),
    }


def test_summary_guards_against_zero(spark):
    df = spark.createDataFrame([("p", 0, 10.0), ("p", 4, 0.0), ("p", 8, 5.0)], RUNS)
    rows = [tuple(r)[1:] for r in scaling.scaling_summary(df).collect()]
    assert rows == [(0, 10.0, 1.0, 0.0), (4, 0.0, 0.0, 0.0), (8, 5.0, 2.0, 0.0)]


def test_numeric_runs(spark):
    df = spark.createDataFrame(
        [(" 2.9 ", "10"), ("x", "1e1"), (None, ""), ("4", "bad")], "cores string, duration_sec string"
    )
    assert scaling.numeric_runs(df).collect() == [(2, 10.0), (0, 10.0), (0, 0.0), (4, 0.0)]
    assert scaling.numeric_runs(df, keep_unreadable=False).collect() == [(2.9, 10.0), (4.0, None)]


MEASURED = RUNS + ", speedup double, eff double"


def test_fill_only_where_missing(spark):
    rows = [
        ("kept", 2, 10.0, 7.0, None),
        ("kept", 4, 5.0, None, 9.0),
        ("filled", 2, 10.0, 7.0, None),
        ("filled", 4, 5.0, None, None),
        ("filled", None, 5.0, None, None),
        ("filled", 8, None, None, None),
    ]
    found = scaling.fill_scaling(spark.createDataFrame(rows, MEASURED)).collect()
    assert [tuple(r) for r in found] == [
        ("filled", 2, 10.0, 1.0, 1.0),
        ("filled", 4, 5.0, 2.0, 1.0),
        ("kept", 2, 10.0, 7.0, None),
        ("kept", 4, 5.0, None, 9.0),
    ]


def test_fill_without_the_columns(spark):
    df = spark.createDataFrame([("p", 2, 10.0), ("p", 4, 5.0)], RUNS)
    assert [tuple(r)[3:] for r in scaling.fill_scaling(df).collect()] == [(1.0, 1.0), (2.0, 1.0)]


@pytest.mark.parametrize("run", [scaling.scaling_summary, scaling.fill_scaling])
def test_hot_phase_is_never_gathered(spark, run):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("phase"),
        (F.col("id") % 16 + 1).alias("cores"),
        (F.col("id") + 1).cast("double").alias("duration_sec"),
    )
    found = run(df)
    assert len(found.collect()) == 3000
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert "Window" not in final and "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    plan = scaling.baselines(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_runs_without_a_phase_are_kept(spark):
    rows = [("a", 2, 8.0), (None, 2, 6.0), (None, 4, 3.0), ("a", 4, 4.0)]
    df = spark.createDataFrame(rows, "phase string, cores int, duration_sec double")
    for found in (scaling.scaling_summary(df), scaling.fill_scaling(df)):
        assert sorted((r.phase or "", r.cores, r.speedup) for r in found.collect()) == [
            ("", 2, 1.0), ("", 4, 2.0), ("a", 2, 1.0), ("a", 4, 2.0)]
