import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ratewise.operators import labeling

SCHEMA = "review_id long, stars double, text string"


def _rows(seed=3, rows=6000):
    """Every third row is a copy of one text; the others have few copies or none."""
    rng = random.Random(seed)
    return [
        (i, rng.choice([1.0, 3.0, 5.0]), "the hot text" if i % 3 == 0 else f"text {rng.randrange(3000)}")
        for i in range(rows)
    ]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_repeated_texts(spark, broadcast):
    rows = _rows() + [(10000, 1.0, None), (10001, 1.0, None)]
    first = {}
    for key, _, body in rows:
        if body is not None:
            first.setdefault(body, key)
    wanted = sorted([*first.values(), 10000, 10001])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = labeling.drop_repeated_texts(spark.createDataFrame(rows, SCHEMA).repartition(5))
        assert df.columns == ["review_id", "stars", "text"]
        assert sorted(row.review_id for row in df.collect()) == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_one_row_per_text_whatever_the_keys(spark, broadcast):
    rows = [("k1", "x"), ("k1", "x"), ("k2", "x"), (None, "x"), (None, "y"), (None, "y"), ("k3", "z"), (None, None), (None, None)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = labeling.drop_repeated_texts(spark.createDataFrame(rows, "review_id string, text string"))
        found = sorted(map(tuple, df.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == sorted([("k1", "x"), (None, "y"), ("k3", "z"), (None, None), (None, None)], key=str)


def test_repeated_keys(spark):
    rows = [(1, 5.0, "b"), (1, 5.0, "a"), (1, None, "z"), (2, 1.0, None), (None, 1.0, "n"), (None, 2.0, "n")]
    df = labeling.drop_repeated_keys(spark.createDataFrame(rows, SCHEMA))
    found = sorted((tuple(row) for row in df.collect()), key=str)
    assert found == sorted([(1, None, "z"), (2, 1.0, None), (None, 1.0, "n"), (None, 2.0, "n")], key=str)


def test_clean_strict(spark):
    df = spark.createDataFrame([(1, 5.0, "\t"), (2, 5.0, "ok"), (3, 5.0, " ")], SCHEMA)
    assert labeling.clean_rows(df).count() == 2
    assert labeling.clean_rows(df, strict=True).count() == 1


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="stars"):
        labeling.labeled_reviews(spark.createDataFrame([("a",)], "text string"))


def _train_keys(df):
    split = labeling.assign_split(df)
    return {row.review_id for row in split.where("split = 'train'").select("review_id").collect()}


def test_split_does_not_depend_on_layout(spark):
    df = spark.createDataFrame(_rows(rows=2000), SCHEMA)
    train = _train_keys(df)
    assert train == _train_keys(df.select("review_id"))
    assert train == _train_keys(df.repartition(17).orderBy(F.rand(1)))
    test = {row.review_id for row in labeling.assign_split(df).where("split = 'test'").collect()}
    assert not train & test and len(train | test) == 2000
    assert 0.77 < len(train) / 2000 < 0.83
    by_hand = {
        i for i in range(2000)
        if int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) % 100 < 80
    }
    assert train == by_hand


def test_split_follows_its_seed(spark):
    df = spark.range(1000).withColumnRenamed("id", "review_id")
    one = labeling.assign_split(df, seed=1).where("split = 'test'")
    two = labeling.assign_split(df, seed=2).where("split = 'test'")
    assert one.exceptAll(two).count() > 0


def test_split_without_keys(spark):
    rows = [(None, float(i % 5 + 1), f"text {i // 2}") for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    split = labeling.assign_split(df)
    sides = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert 0.7 < sides["train"] / 2000 < 0.9
    alone = labeling.assign_split(df.drop("review_id"))
    both = split.groupBy("stars", "text").agg(F.count_distinct("split").alias("n"))
    assert both.where("n > 1").count() == 0
    assert alone.select("stars", "text", "split").exceptAll(split.select("stars", "text", "split")).count() == 0
    with pytest.raises(ValueError, match="stars, text"):
        labeling.assign_split(spark.range(3))
