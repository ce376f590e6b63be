import json
import random

import pytest

from ratewise import schema
from ratewise.__main__ import main as command_line
from ratewise.plans import jobs
from ratewise.sources import reviews as tables
from ratewise.sources import runlog


@pytest.fixture(scope="module")
def review_file(tmp_path_factory):
    rng = random.Random(2)
    path = tmp_path_factory.mktemp("in") / "reviews.json"
    with open(path, "w", encoding="utf-8") as out:
        for i in range(400):
            stars = float(rng.randrange(1, 6))
            mood = "lovely kind warm" if stars > 3 else "nasty dirty loud"
            words = mood.split() + [f"w{rng.randrange(20)}" for _ in range(8)]
            row = {"review_id": f"r{i}", "user_id": "u", "business_id": "b", "date": "2020-01-01",
                   "stars": stars, "text": "" if i % 50 == 0 else " ".join(words)}
            out.write(json.dumps(row) + "\n")
    return str(path)


def test_from_review_file_to_evaluation(spark, review_file, tmp_path):
    out = str(tmp_path)
    report = spark.read.option("header", True).csv(jobs.validate(spark, review_file, out))
    assert {r.metric: float(r.value) for r in report.collect()}["blank_texts"] == 8

    labeled = jobs.label(spark, review_file, out, "20250101_000000")
    assert tables.scan_labeled(spark, labeled).columns[-1] == "label"

    jobs.build_features(spark, None, out, "20250101_000001")
    newest = jobs.build_features(spark, labeled, out, "20250101_000002")
    trained = jobs.train(spark, out, "20250101_000003")
    log = runlog.scan_run_log(spark, f"{out}/training_log", schema.TRAINING_LOG).first()
    assert log.run_id == trained and log.features_path.endswith(newest)
    assert log.rows_total == log.rows_train + log.rows_test == tables.scan_labeled(spark, labeled).count()
    assert log.auc > 0.95 and log.duration_sec > 0

    jobs.evaluate(spark, out, "20250101_000004")
    found = runlog.scan_run_log(spark, f"{out}/evaluation_log", schema.EVALUATION_LOG).first()
    assert found.source_training_run_id == trained
    assert (found.accuracy, found.auc) == pytest.approx((log.acc, log.auc))
    assert found.tp + found.fp + found.tn + found.fn == found.rows_test == log.rows_test


def test_first_look(spark, review_file, tmp_path):
    out = jobs.ingest(spark, review_file, str(tmp_path))
    read = spark.read.option("header", True)
    columns = {r.column_name: r.distinct_values for r in read.csv(f"{out}/column_profile").collect()}
    assert 360 < int(columns["review_id"]) < 440 and columns["date"] == "1"
    ratings = read.csv(f"{out}/rating_histogram").collect()
    assert sum(int(r.cnt) for r in ratings) == 400
    assert read.csv(f"{out}/sample_rows").columns == [
        "review_id", "stars", "text", "date", "user_id", "business_id",
    ]


def test_command_line(spark, review_file, tmp_path, capsys):
    out = str(tmp_path)
    command_line(["label", review_file, out, "--run-id", "r1"])
    assert capsys.readouterr().out.strip() == f"{out}/labeled/r1"
    command_line(["build_features", f"{out}/labeled/r1", out, "--run-id", "r2", "--fit-on", "all"])
    log = runlog.scan_run_log(spark, f"{out}/feature_log", schema.FEATURE_LOG).first()
    assert (log.run_id, log.out_parquet) == ("r2", f"{out}/features/r2")
    with pytest.raises(SystemExit):
        command_line(["unknown"])


def test_training_without_features(spark, tmp_path):
    log = spark.createDataFrame([], schema.FEATURE_LOG)
    runlog.append_run(log, f"{tmp_path}/feature_log", schema.FEATURE_LOG)
    with pytest.raises(ValueError, match="feature log is empty"):
        jobs.train(spark, str(tmp_path))


def test_scaling_summary_job(spark, tmp_path):
    source = tmp_path / "log.csv"
    source.write_text("\ufeffcores,duration_sec,auc\n2,277.90,0.99\n16,303.11,0.98\n", encoding="utf-8")
    out = str(tmp_path / "summary")
    jobs.summarise_scaling(spark, str(source), out, "train", ("auc",))
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["cores", "duration_sec", "speedup", "eff", "auc"]
    assert sorted(map(tuple, back.collect())) == [
        ("16", "303.11", "0.9168", "0.1146", "0.98"), ("2", "277.9", "1.0", "1.0", "0.99"),
    ]
