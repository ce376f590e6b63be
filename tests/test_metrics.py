import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from ratewise.operators import metrics

GOLDEN = [(1.0, 1.0, 922833), (0.0, 1.0, 18324), (0.0, 0.0, 305356), (1.0, 0.0, 13646)]
WEIGHTED = {
    "accuracy": 0.974630,
    "f1": 0.974569,
    "weighted_precision": 0.974544,
    "weighted_recall": 0.974630,
}


def _golden(spark):
    return spark.createDataFrame(GOLDEN, "label double, prediction double, n long")


def test_golden_counts(spark):
    df = _golden(spark)
    found = metrics.class_metrics(df, weight="n").first().asDict()
    assert {k: round(v, 6) for k, v in found.items()} == WEIGHTED
    row = metrics.positive_pr(df, weight="n").first()
    assert (round(row.pos_precision, 6), round(row.pos_recall, 6)) == (0.980530, 0.985428)
    assert tuple(metrics.confusion_matrix(df, weight="n").first()) == (922833, 18324, 305356, 13646)
    scored = df.withColumn("score", F.col("prediction"))
    row = metrics.evaluation_metrics(scored, weight="n").first().asDict()
    assert {k: round(row[k], 6) for k in WEIGHTED} == WEIGHTED
    assert row["rows_test"] == 1260159


def _random(spark, seed, rows=800, values=50):
    """Scores with ties; a third of the rows share one score."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        label = float(rng.random() < 0.3)
        score = 0.5 if i % 3 == 0 else rng.randrange(values) / values + 0.1 * label
        data.append((label, score, float(score >= 0.5)))
    return data, spark.createDataFrame(data, "label double, score double, prediction double")


def _auc_by_hand(data):
    pos = [s for label, s, *_ in data if label == 1.0]
    neg = [s for label, s, *_ in data if label == 0.0]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_auc_by_brute_force(spark, seed, partitions):
    data, df = _random(spark, seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        for on in ("true", "false"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", on)
            assert abs(metrics.roc_auc(df).first()[0] - _auc_by_hand(data)) < 1e-12
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_metrics_equal_mllib(spark):
    _, df = _random(spark, 9)
    row = metrics.evaluation_metrics(df).first().asDict()
    names = {"accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall"}
    by_class = metrics.class_metrics(df).first().asDict()
    for ours, theirs in names.items():
        wanted = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert abs(row[ours] - wanted) < 1e-12 and abs(by_class[ours] - wanted) < 1e-12
    area = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert abs(row["auc"] - area) < 1e-12


def test_class_metrics_of_many_classes(spark):
    rng = random.Random(1)
    rows = [(float(rng.randrange(4)), float(rng.randrange(5))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    found = metrics.class_metrics(df).first()
    for ours, theirs in (("f1", "f1"), ("weighted_precision", "weightedPrecision")):
        wanted = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert abs(found[ours] - wanted) < 1e-12


def test_undefined_measures(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.2), (0.0, 0.0, 0.3)], "label double, prediction double, score double")
    row = metrics.evaluation_metrics(df).first()
    assert (row.auc, row.pos_precision, row.pos_recall, row.accuracy) == (None, 0.0, 0.0, 1.0)
    empty = metrics.evaluation_metrics(df.limit(0)).first()
    assert (empty.rows_test, empty.accuracy, empty.auc) == (0, None, None)


def test_predictions_are_read_once(spark, tmp_path):
    path = str(tmp_path / "p")
    _random(spark, 2)[1].write.parquet(path)
    plan = metrics.evaluation_metrics(spark.read.parquet(path))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_rows_without_a_score_count(spark):
    rows = [(1.0, 1.0, 0.9), (0.0, 0.0, 0.2), (0.0, 1.0, None)]
    df = spark.createDataFrame(rows, "label double, prediction double, score double")
    row = metrics.evaluation_metrics(df).first()
    assert (row.rows_test, row.tp, row.fp, row.tn, row.fn) == (3, 1, 1, 1, 0)
    assert tuple(metrics.confusion_matrix(df).first()) == (1, 1, 1, 0)
    assert row.auc == 1.0 and row.accuracy == pytest.approx(2 / 3)


@pytest.mark.parametrize("odd", [(2.0, 1.0, 0.5), (1.0, 3.0, 0.5), (None, 1.0, 0.5)])
def test_reports_of_two_classes_refuse_others(spark, odd):
    df = spark.createDataFrame([(1.0, 1.0, 0.9), odd], "label double, prediction double, score double")
    for report in (metrics.evaluation_metrics, metrics.confusion_matrix):
        with pytest.raises(Exception, match="must be 0 or 1"):
            report(df).collect()


def test_area_of_many_scores_in_two_exchanges(spark):
    """10^5 distinct scores, some missing: one exchange by score, one by range; only a row
    per task goes on."""
    n = 100_000
    score = F.when(F.col("id") % 1000 != 7, (F.col("id") * 7919 % n).cast("double"))
    df = spark.range(n).select(
        score.alias("score"),
        ((F.col("id") * 31 % 97) < 40).cast("double").alias("label"),
        F.lit(1.0).alias("prediction"),
    )
    row = metrics.evaluation_metrics(df).first()
    data = [(r.label, r.score) for r in df.where("score IS NOT NULL").collect()]
    assert row.rows_test == n and row.auc == pytest.approx(_auc_by_hand_sorted(data), abs=1e-12)
    plan = metrics.roc_auc(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and plan.count("rangepartitioning") == 1


def _auc_by_hand_sorted(data):
    """The area from ranks; scores are distinct."""
    ordered = sorted(data, key=lambda pair: pair[1])
    below, pairs = 0, 0
    for label, _ in ordered:
        if label:
            pairs += below
        else:
            below += 1
    return pairs / (below * (len(data) - below))
