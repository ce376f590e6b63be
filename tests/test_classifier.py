import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    NGram,
    RegexTokenizer,
    StopWordsRemover,
    VectorAssembler,
)
from pyspark.sql import functions as F

from ratewise.functions.text import clean_text
from ratewise.operators import classifier, labeling, metrics, terms
from ratewise.sources import reviews as tables

GOOD, BAD = ["great", "tasty", "friendly"], ["awful", "cold", "rude"]
FILLER = [f"word{i}" for i in range(30)]


@pytest.fixture(scope="module")
def labeled(spark):
    """Texts whose label shows in their words, with URLs, capitals and stop words."""
    rng = random.Random(11)
    rows = []
    for i in range(300):
        label = float(i % 3 > 0)
        words = rng.choices(GOOD if label else BAD, k=4) + rng.choices(FILLER, k=12)
        rng.shuffle(words)
        rows.append((i, " ".join(words).title() + " the http://x.y/z not", label))
    return spark.createDataFrame(rows, "review_id long, text string, label double").cache()


@pytest.fixture(scope="module")
def fitted(labeled):
    return classifier.split_features(labeled)


def _by_term(row, vocabulary):
    return {vocabulary[i]: v for i, v in zip(row.features.indices, row.features.values) if v}


def test_features_equal_separate_mllib_stages(spark, labeled):
    cleaned = labeled.withColumn("text_clean", clean_text(F.col("text")))
    staged = Pipeline(
        stages=[
            RegexTokenizer(inputCol="text_clean", outputCol="tokens", pattern=r"\W+", minTokenLength=2, toLowercase=False),
            StopWordsRemover(inputCol="tokens", outputCol="kept"),
            NGram(n=2, inputCol="kept", outputCol="pairs"),
            CountVectorizer(inputCol="kept", outputCol="tf1", vocabSize=50000, minDF=5),
            CountVectorizer(inputCol="pairs", outputCol="tf2", vocabSize=50000, minDF=5),
            IDF(inputCol="tf1", outputCol="w1"),
            IDF(inputCol="tf2", outputCol="w2"),
            VectorAssembler(inputCols=["w1", "w2"], outputCol="features"),
        ]
    ).fit(cleaned)
    theirs = staged.stages[3].vocabulary + staged.stages[4].vocabulary
    wanted = {r.review_id: _by_term(r, theirs) for r in staged.transform(cleaned).collect()}

    model = classifier.fit_features(labeled)
    counters = [s for s in model.stages.stages if hasattr(s, "vocabulary")]
    ours = counters[0].vocabulary + counters[1].vocabulary
    assert (model.unigrams, model.bigrams) == tuple(len(c.vocabulary) for c in counters)
    found = {r.review_id: _by_term(r, ours) for r in classifier.add_features(model.stages, labeled).collect()}
    assert found.keys() == wanted.keys()
    for key in wanted:
        assert found[key] == pytest.approx(wanted[key], rel=1e-12)


def test_features_are_learned_from_the_training_side(labeled, fitted):
    model, features = fitted
    assert features.columns == ["review_id", "text", "label", "split", "features"]
    train = labeling.assign_split(labeled).where("split = 'train'")
    assert classifier.fit_features(train).unigrams == model.unigrams
    everything, _ = classifier.split_features(labeled, fit_on="all")
    assert everything.bigrams > model.bigrams


def test_no_common_term(spark):
    df = spark.createDataFrame([("a few words",)], "text string")
    with pytest.raises(ValueError, match="no term in 5 or more documents"):
        classifier.fit_features(df)


def test_train_score_save_and_reload(spark, labeled, fitted, tmp_path):
    model, features = fitted
    path = str(tmp_path / "features")
    for _ in range(2):
        tables.write_features(features, path)
    train = tables.scan_features(spark, path, "train")
    test = tables.scan_features(spark, path, "test")
    plan = train.select("label", "features")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert "ReadSchema: struct<label:double,features:" in plan
    assert not {r[0] for r in train.select("review_id").collect()} & {
        r[0] for r in test.select("review_id").collect()
    }
    trained = classifier.train_classifier(train)
    scored = classifier.score_rows(trained, test)
    report = metrics.evaluation_metrics(scored).first()
    assert report.auc > 0.95 and report.accuracy > 0.9
    assert scored.where((F.col("prediction") == 1.0) != (F.col("probability") > 0.5)).count() == 0
    assert scored.where((F.col("score") > 0) != (F.col("probability") > 0.5)).count() == 0

    for _ in range(2):
        classifier.save_model(model.stages, str(tmp_path / "stages"))
        classifier.save_model(trained, str(tmp_path / "lr"))
    again = classifier.score_text(
        classifier.load_features(str(tmp_path / "stages")),
        classifier.load_classifier(str(tmp_path / "lr")),
        labeled,
    )
    wanted = {r.review_id: r.score for r in scored.collect()}
    found = {r.review_id: r.score for r in again.collect()}
    assert len(found) == 300
    assert {k: found[k] for k in wanted} == pytest.approx(wanted)


def test_vocabulary_order_and_missing_texts(spark, labeled):
    one, two = (classifier.fit_features(labeled) for _ in range(2))
    counters = [[s.vocabulary for s in m.stages.stages if hasattr(s, "vocabulary")] for m in (one, two)]
    assert counters[0] == counters[1]
    learned = terms.fit_terms(terms.with_tokens(labeled.select("text"))).where("kind = 'unigram'")
    assert counters[0][0] == [r.term for r in learned.orderBy("term_index").collect()]
    texts = spark.createDataFrame([(1, None), (2, "")], "review_id long, text string")
    rows = classifier.add_features(one.stages, texts).collect()
    assert rows[0].features == rows[1].features


def test_unicode_words_and_stop_words(spark):
    rows = [(i, "caf\u00e9 not", float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "review_id long, text string, label double")
    model = classifier.fit_features(df, words=("zzz",), unicode_words=True)
    assert {t for s in model.stages.stages if hasattr(s, "vocabulary") for t in s.vocabulary} == {
        "caf\u00e9", "not", "caf\u00e9 not"}
