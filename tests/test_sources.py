import json
import os

import pytest
from pyspark.sql import functions as F

from ratewise import schema
from ratewise.operators import labeling
from ratewise.sources import reviews as tables
from ratewise.sources import runlog


def _json_file(tmp_path, lines):
    path = tmp_path / "reviews.json"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_json_lines(spark, tmp_path):
    lines = [
        json.dumps({"review_id": "a", "stars": 5, "text": "fine", "useful": 3}),
        json.dumps({"review_id": "b", "stars": 1.0, "text": None, "date": "2020-01-02 03:04:05"}),
        "{broken",
    ]
    df = tables.scan_json_lines(spark, _json_file(tmp_path, lines))
    rows = {row.review_id: row for row in df.collect()}
    assert df.columns == ["review_id", "date", "stars", "text"]
    assert (rows["a"].stars, rows["a"].text, rows["a"].date) == (5.0, "fine", None)
    assert rows["b"].date == "2020-01-02 03:04:05"
    assert rows[None].text is None and rows[None].stars is None
    assert len(rows) == 3


def test_required_columns(spark, tmp_path):
    path = _json_file(tmp_path, ["{}"])
    with pytest.raises(ValueError, match="missing required columns: stars, text"):
        tables.scan_json_lines(spark, path, "review_id string")
    for fields, missing in (({"text": "a"}, "stars"), ({"stars": 1}, "text")):
        with pytest.raises(ValueError, match=f"missing required columns: {missing}"):
            tables.scan_json_lines(spark, _json_file(tmp_path, [json.dumps(fields)] * 50))
    spark.range(2).write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError, match="label, text"):
        tables.scan_labeled(spark, str(tmp_path / "p"))
    with pytest.raises(ValueError, match="features, label"):
        tables.scan_features(spark, str(tmp_path / "p"))


def test_project_existing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "text int, other int, stars int")
    assert schema.project_existing(df, schema.REVIEW_COLUMNS).columns == ["stars", "text"]


def _labeled(spark, rows=1000):
    return spark.range(rows).select(
        F.col("id").alias("review_id"),
        F.lit("some text").alias("text"),
        F.when(F.col("id") % 4 == 0, 0.0).otherwise(1.0).alias("label"),
    )


@pytest.mark.parametrize("compact", [False, True])
def test_labeled_table(spark, tmp_path, compact):
    path = str(tmp_path / "labeled")
    tables.write_labeled(_labeled(spark, 10), path)
    tables.write_labeled(_labeled(spark), path, max_records_per_file=100, compact=compact)
    assert sorted(d for d in os.listdir(path) if d.startswith("label")) == ["label=0.0", "label=1.0"]
    df = tables.scan_labeled(spark, path)
    assert dict(df.dtypes)["label"] == "double"
    assert df.groupBy("label").count().orderBy("label").collect() == [(0.0, 250), (1.0, 750)]
    per_file = df.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= 100
    plan = df.where("label = 1.0")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label" in plan


def test_labeling_reads_only_what_it_needs(spark):
    reviews = tables.table_reviews(spark, "/root/testdata/sf0.001")
    labels = labeling.labeled_reviews(reviews).groupBy("label").count()
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "Inner" in plan and "LeftOuter" not in plan
    assert "PushedFilters: [IsNotNull(text)" in plan


RUN_CSV = (
    "\ufeffCores , Run_ID,DURATION_SEC\n"
    "2,r1,277.90\n"
    "4,r2\n"
    "\n"
    " , ,\n"
    "8,r3,209.33,0.99\n"
)


def test_run_csv_is_read_tolerantly(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(RUN_CSV, encoding="utf-8")
    df = runlog.scan_run_csv(spark, str(path), ["Cores", "duration_sec"])
    assert df.columns == ["cores", "run_id", "duration_sec"]
    assert [tuple(r) for r in df.orderBy("cores").collect()] == [
        ("2", "r1", "277.90"), ("4", "r2", None), ("8", "r3", "209.33"),
    ]
    with pytest.raises(ValueError, match="missing required columns: auc"):
        runlog.scan_run_csv(spark, str(path), ["auc"])


def test_run_csv_with_a_header_too_short(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("\ufeffcores,acc\n2,0.9,0.99\n", encoding="utf-8")
    df = runlog.scan_run_csv(spark, str(path), ["auc"], columns=["cores", "acc", "auc"])
    assert df.collect() == [("2", "0.9", "0.99")]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    first = runlog.one_row(spark, schema.FEATURE_LOG, run_id="20250101_000000", total_rows=5, out_parquet="old")
    later = spark.createDataFrame([("new", "20250201_000000", "7", 1)], "out_parquet string, run_id string, total_rows string, extra int")
    runlog.append_run(later, path, schema.FEATURE_LOG)
    runlog.append_run(first, path, schema.FEATURE_LOG)
    log = runlog.scan_run_log(spark, path, schema.FEATURE_LOG)
    assert log.count() == 2
    newest = runlog.latest_run(log).first()
    assert (newest.out_parquet, newest.total_rows, newest.vocab_uni) == ("new", 7, None)
    assert runlog.latest_value(log, "out_parquet").first()[0] == "new"
    assert runlog.latest_run(log.limit(0)).count() == 0
    assert runlog.latest_value(log.limit(0), "out_parquet").count() == 0


def test_write_columns(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, 2.5, "x")], "cores int, speedup double, other string")
    for _ in range(2):
        runlog.write_columns(df, path, ["speedup", "cores", "auc"])
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["speedup", "cores", "auc"]
    assert back.collect() == [("2.5", "1", None)]


def test_run_csv_with_quoted_line_ends_and_repeated_names(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text('\ufeffcores,Note, CORES ,note\n2,"two\nlines, ""quoted""",3,x\n', encoding="utf-8")
    df = runlog.scan_run_csv(spark, str(path), ["cores"])
    assert df.columns == ["cores", "note", "cores_2", "note_2"]
    assert [tuple(r) for r in df.collect()] == [("2", 'two\nlines, "quoted"', "3", "x")]


def test_runs_of_one_table(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = [(i, f"text {i}", float(i % 2)) for i in range(10)]
    df = spark.createDataFrame(rows, "review_id long, text string, label double")
    tables.write_run(df, path, "009")
    tables.write_run(df.where("review_id < 4"), path, "10")
    tables.write_run(df.where("label = 1"), path, "009")  # the other label goes as well
    assert tables.run_ids(spark, path) == ["009", "10"]
    found = {(r.run_id, r.review_id) for r in tables.scan_runs(spark, path).collect()}
    assert found == {("009", i) for i in (1, 3, 5, 7, 9)} | {("10", i) for i in range(4)}
    newest = tables.scan_runs(spark, path, newest=True)
    assert newest.count() == 4 and newest.schema["run_id"].dataType.simpleString() == "string"
    assert tables.scan_runs(spark, path, "009").where("label = 0").count() == 0
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "run_id" not in plan.split("ReadSchema")[1]
    assert tables.scan_runs(spark, path, "none").count() == 0
    with pytest.raises(ValueError, match="not a run id"):
        tables.write_run(df, path, "a/b")
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no run"):
        tables.scan_runs(spark, str(tmp_path / "empty"))


def test_texts_do_not_move_to_meet_few_labels(spark, tmp_path):
    """Also where the session would not broadcast the labels by itself."""
    texts = [(1, "a"), (2, None), (2, "b"), (None, "c"), (3, "d")]
    docs = [(key, text, "en", "web", len(text or "")) for key, text in texts]
    spark.createDataFrame(docs, tables.DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 0, 1), (2, 1, 0), (2, 0, 0), (None, 1, 1)]
    spark.createDataFrame(labels, tables.LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        reviews = tables.table_reviews(spark, str(tmp_path))
        plan = reviews._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        found = sorted((r.review_id or 0, r.text or "", r.stars) for r in reviews.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == [(0, "c", 3.0), (1, "a", 1.0), (2, "", 2.0), (2, "", 5.0), (2, "b", 2.0), (2, "b", 5.0), (3, "d", 3.0)]
