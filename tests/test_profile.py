import random

from pyspark.sql import functions as F

from ratewise.operators import labeling, profile

SCHEMA = "review_id string, stars double, text string"


def _random_reviews(seed=7, rows=400):
    rng = random.Random(seed)
    texts = [None, "", "  ", "\t", "good food", "é😀 ok", "x" * 120, "bad http://a.b"]
    stars = [None, 1.0, 2.0, 3.0, 4.0, 5.0, 0.0, 6.0, 4.5]
    keys = [None, *[f"k{i}" for i in range(150)]]
    return [(rng.choice(keys), rng.choice(stars), rng.choice(texts)) for _ in range(rows)]


def _expected(rows):
    texts = [t for _, _, t in rows if t is not None]
    neg = sum(s in (1, 2) for _, s, _ in rows)
    pos = sum(s in (4, 5) for _, s, _ in rows)
    keys = [k for k, _, _ in rows]
    return {
        "total_rows": len(rows),
        "invalid_stars": sum(s is not None and s not in (1, 2, 3, 4, 5) for _, s, _ in rows),
        "stars_nulls": sum(s is None for _, s, _ in rows),
        "text_nulls": sum(t is None for _, _, t in rows),
        "blank_texts": sum(not t.strip(" ") for t in texts),
        "text_min_len": min(map(len, texts)),
        "text_avg_len": round(sum(map(len, texts)) / len(texts), 2),
        "text_max_len": max(map(len, texts)),
        "dup_review_id": sum(keys.count(k) > 1 for k in set(keys)),
        "label_neg_planned": neg,
        "label_pos_planned": pos,
        "label_neu_planned": sum(s == 3 for _, s, _ in rows),
        "label_pos_pct_planned": round(pos / (neg + pos) * 100, 4),
        "label_neg_pct_planned": round(neg / (neg + pos) * 100, 4),
    }


def _report(df):
    return {row.metric: row.value for row in df.collect()}


def test_validation_profile_by_brute_force(spark):
    rows = _random_reviews()
    df = spark.createDataFrame(rows, SCHEMA)
    assert _report(profile.validation_profile(df)) == _expected(rows)
    assert _report(profile.validation_profile(df, store_facts=True)) == _expected(rows)


def test_profile_of_an_empty_table(spark):
    found = _report(profile.validation_profile(spark.createDataFrame([], SCHEMA)))
    assert found["total_rows"] == 0 and found["text_min_len"] is None
    assert found["label_pos_pct_planned"] == 0.0


def test_duplicates_without_the_key_column(spark):
    df = spark.createDataFrame([(1.0, "a")], "stars double, text string")
    assert profile.duplicate_keys(df).first()[0] is None
    assert _report(profile.validation_profile(df))["dup_review_id"] is None


def test_labeling_report_by_brute_force(spark):
    rows = _random_reviews(8)
    df = spark.createDataFrame(rows, SCHEMA)
    kept = [s for _, s, t in rows if t is not None and t.strip(" ") and s in (1, 2, 4, 5)]
    neg, pos = sum(s < 3 for s in kept), sum(s > 3 for s in kept)
    assert _report(profile.labeling_report(df)) == {
        "total_before": len(rows),
        "total_after": len(kept),
        "label_neg": neg,
        "label_pos": pos,
        "label_neg_pct": round(neg / (neg + pos) * 100, 4),
        "label_pos_pct": round(pos / (neg + pos) * 100, 4),
    }
    labels = labeling.labeled_reviews(df).select("label").distinct().collect()
    assert {row.label for row in labels} == {0.0, 1.0}


def test_published_class_shares(spark):
    counts = {1.0: 1613801, 5.0: 4684545, 3.0: 691934}
    df = spark.createDataFrame(list(counts.items()), "stars double, n long")
    df = df.select("stars", F.explode(F.sequence(F.lit(1), (F.col("n") / 1000).cast("int"))))
    row = profile.class_balance(df).first()
    assert (row.neg, row.pos, row.neu, row.kept) == (1613, 4684, 691, 6297)
    assert abs(row.pos_pct - 74.3774) < 0.02 and abs(row.neg_pct - 25.6226) < 0.02


def test_column_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 2.0)], "s string, d double")
    rows = [tuple(row) for row in profile.column_profile(df).orderBy("position").collect()]
    assert rows == [(0, "s", "string", 3, 1, 1), (1, "d", "double", 3, 1, 2)]


def test_histogram_is_ordered(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (None,), (2.0,)], "stars double")
    assert profile.histogram(df, "stars").collect() == [(None, 1), (1.0, 1), (2.0, 2)]


def test_profile_reads_disjoint_columns(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame(_random_reviews(), SCHEMA).write.parquet(path)
    plan = profile.validation_profile(spark.read.schema(SCHEMA).parquet(path))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<stars:double,text:string>" in plan
    assert "ReadSchema: struct<review_id:string>" in plan
    assert plan.count("FileScan parquet") == 2 and "Cartesian" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_profiles_of_runs_merge(spark):
    """States of any parts merge to the state of the whole; counts are exact."""
    rows = _random_reviews(rows=3000)
    df = spark.createDataFrame(rows, SCHEMA)
    parts = [spark.createDataFrame(rows[i::3], SCHEMA) for i in range(3)] + [df.limit(0)]
    states = profile.profile_state(parts[0])
    for part in parts[1:]:
        states = states.unionAll(profile.profile_state(part))
    found = {r.column_name: r for r in profile.read_profile(profile.merge_profiles(states)).collect()}
    whole = {r.column_name: r for r in profile.read_profile(profile.profile_state(df)).collect()}
    for i, name in enumerate(df.columns):
        values = [row[i] for row in rows if row[i] is not None]
        assert (found[name].rows, found[name].nulls) == (3000, 3000 - len(values))
        assert abs(found[name].distinct_values - len(set(values))) <= 1 + 0.02 * len(set(values))
        assert found[name].distinct_values == whole[name].distinct_values
    texts = [t for _, _, t in rows if t is not None]
    assert found["text"].greatest_length == max(map(len, texts)) and found["text"].least_length == 0
    assert abs(found["text"].average_length - sum(map(len, texts)) / len(texts)) < 1e-9
    stars = sorted(s for _, s, _ in rows if s is not None)
    low, high = (stars[int(q * len(stars))] for q in (0.45, 0.55))
    assert low <= found["stars"].median <= high and found["text"].median is None


def test_a_profile_state_is_one_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = profile.profile_state(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_a_profile_of_nothing(spark):
    df = spark.createDataFrame([], "a int, b string, c array<int>, d date, e double")
    rows = profile.read_profile(profile.profile_state(df)).collect()
    assert [(r.rows, r.nulls, r.distinct_values, r.median) for r in rows] == [(0, 0, 0, None)] * 5
