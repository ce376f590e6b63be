"""The classifier as a table of weights, against plain sums and against MLlib."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratewise.operators import classifier, term_model, terms

WORDS = [f"word{i}" for i in range(12)]


@pytest.fixture(scope="module")
def labeled(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        label = float(i % 2)
        words = rng.choices(WORDS, k=10) + (["fine"] if rng.random() < 0.3 + 0.4 * label else ["poor"])
        rng.shuffle(words)
        rows.append((i // 2 if i % 7 else None, " ".join(words), label))
    rows += [(900, None, 1.0), (901, "", 0.0)]
    return spark.createDataFrame(rows, "review_id long, text string, label double")


@pytest.fixture(scope="module")
def table(labeled):
    return term_model.numbered_table(terms.with_tokens(labeled))


def _given(table):
    learned = terms.fit_terms(table)
    return learned, learned.select(
        "kind", "term", "idf", ((F.col("term_index") % 5 - 2) / 30).alias("coefficient")
    )


def _plain(labeled, weights, intercept):
    """(label, margin, {term: x}) of each row."""
    known = {(r.kind, r.term): (r.idf, r.coefficient) for r in weights.collect()}
    out = []
    for row in labeled.collect():
        words = (row.text or "").split()
        found = Counter(("unigram", w) for w in words)
        found += Counter(("bigram", f"{a} {b}") for a, b in zip(words, words[1:]))
        x = {t: n * known[t][0] for t, n in found.items() if t in known}
        out.append((row.label, intercept + sum(v * known[t][1] for t, v in x.items()), x))
    return out


def test_scores_equal_plain_sums(labeled, table):
    _, weights = _given(table)
    rows = term_model.score_terms(table, weights, 0.5).collect()
    wanted = sorted(margin for _, margin, _ in _plain(labeled, weights, 0.5))
    assert sorted(r.score for r in rows) == pytest.approx(wanted)
    for r in rows:
        assert r.probability == pytest.approx(1 / (1 + math.exp(-r.score)))
        assert r.prediction == float(r.score > 0)
    assert {r.score for r in rows if r.review_id in (900, 901)} == {0.5}


def test_loss_and_gradient_equal_plain_sums(labeled, table):
    _, weights = _given(table)
    plain = _plain(labeled, weights, -0.25)
    n = len(plain)
    residual = [1 / (1 + math.exp(-m)) - y for y, m, _ in plain]
    by_term = Counter()
    for r, (_, _, x) in zip(residual, plain):
        for term, v in x.items():
            by_term[term] += r * v / n
    found = {(r.kind, r.term): r.gradient for r in term_model.gradient(table, weights, -0.25).collect()}
    assert found.keys() == by_term.keys()
    assert found == pytest.approx(dict(by_term), abs=1e-12)
    row = term_model.log_loss(table, weights, -0.25).first()
    loss = sum(math.log1p(math.exp(m)) - y * m for y, m, _ in plain) / n
    norm = math.sqrt(sum(g * g for g in by_term.values()) + (sum(residual) / n) ** 2)
    assert (row.documents, row.loss) == (n, pytest.approx(loss))
    assert row.gradient_norm == pytest.approx(norm)
    assert row.intercept_gradient == pytest.approx(sum(residual) / n)


def test_large_margins_do_not_overflow(spark, table):
    _, weights = _given(table)
    heavy = weights.withColumn("coefficient", F.lit(1000.0))
    row = term_model.log_loss(table, heavy, 0.0).first()
    assert math.isfinite(row.loss) and row.loss > 100


def test_a_fitted_model_as_a_table(labeled, table):
    sizes = classifier.fit_features(labeled)
    features = classifier.add_features(sizes.stages, labeled)
    model = classifier.train_classifier(features, regularisation=0.0)
    weights = term_model.model_terms(model, sizes.terms)
    assert weights.count() == sizes.unigrams + sizes.bigrams
    theirs = sorted(r.score for r in classifier.score_rows(model, features).collect())
    ours = sorted(r.score for r in term_model.score_terms(table, weights, model.intercept).collect())
    assert ours == pytest.approx(theirs, abs=1e-8)
    fit = term_model.log_loss(table, weights, model.intercept).first()
    zero = term_model.log_loss(table, weights.withColumn("coefficient", F.lit(0.0)), 0.0).first()
    assert fit.loss == pytest.approx(model.summary.objectiveHistory[-1], rel=1e-9)
    assert zero.loss == pytest.approx(math.log(2))
    assert fit.loss < zero.loss and fit.gradient_norm < zero.gradient_norm


def test_no_documents(table):
    _, weights = _given(table)
    none = table.limit(0)
    assert term_model.score_terms(none, weights, 1.0).count() == 0
    row = term_model.log_loss(none, weights, 1.0).first()
    assert (row.documents, row.loss, row.gradient_norm) == (0, None, 0.0)


def test_terms_of_documents_do_not_move_to_be_scored(spark, table):
    """Also in a session that would not broadcast the weights by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    _, weights = _given(table)
    expected = sorted(r.score for r in term_model.score_terms(table, weights, 0.5).collect())
    slopes = {(r.kind, r.term): r.gradient for r in term_model.gradient(table, weights, 0.5).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        scored = term_model.score_terms(table, weights, 0.5)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert "hashpartitioning(kind" not in plan
        steep = term_model.gradient(table, weights, 0.5)
        plan = steep._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and "known" not in plan
        assert sorted(r.score for r in scored.collect()) == pytest.approx(expected)
        again = {(r.kind, r.term): r.gradient for r in steep.collect()}
        assert again == pytest.approx(slopes)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_losses_of_several_models_share_a_pass(labeled, table, monkeypatch):
    """With the figures of one by one, and of the joins that many weights need."""
    _, weights = _given(table)
    halved = weights.withColumn("coefficient", F.col("coefficient") / 2)
    fewer = weights.where("kind = 'unigram'").withColumn("idf", F.col("idf") * 2)
    models = [(weights, 0.5), (halved, -0.5), (fewer, 0.0)]
    together = [tuple(row.first()) for row in term_model.log_losses(table, *models)]
    slopes = {(r.kind, r.term): r.gradient for r in term_model.gradient(table, *models[1]).collect()}
    plan = term_model.gradient(table, weights, 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # no document meets its residual again
    monkeypatch.setattr(terms, "BROADCAST_BYTES", 0)
    alone = [tuple(term_model.log_loss(table, *model).first()) for model in models]
    assert [r[0] for r in together] == [labeled.count()] * 3
    for one, other in zip(together, alone, strict=True):
        assert one == pytest.approx(other)
    joined = {(r.kind, r.term): r.gradient for r in term_model.gradient(table, *models[1]).collect()}
    assert slopes == pytest.approx(joined)


def test_loss_of_documents_without_a_label(spark, table, monkeypatch):
    """They count as documents, but not for the averages, in both ways to add up."""
    _, weights = _given(table)
    some = table.withColumn("label", F.when(F.col("row") % 3 != 0, F.col("label")))
    quick = tuple(term_model.log_loss(some, weights, 0.5).first())
    monkeypatch.setattr(terms, "BROADCAST_BYTES", 0)
    assert quick == pytest.approx(tuple(term_model.log_loss(some, weights, 0.5).first()))


def test_many_documents_are_scored_without_a_join(labeled, table, monkeypatch):
    """In slices, with the figures of the join, and all columns of a document but its counts."""
    _, weights = _given(table)
    some = weights.withColumn("coefficient", F.when(F.col("term") != "fine", F.col("coefficient")))
    joined = {r.review_id: r for r in term_model.score_terms(table, some, 0.5).collect() if r.review_id}
    monkeypatch.setattr(term_model, "MANY_DOCUMENTS", 1)
    monkeypatch.setattr(term_model, "SLICE_ROWS", 7)
    scored = term_model.score_terms(table, some, 0.5)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    rows = scored.collect()
    assert scored.columns == ["review_id", "label", "prediction", "probability", "score"]
    wanted = sorted(margin for _, margin, _ in _plain(labeled, some.na.fill(0.0), 0.5))
    assert sorted(r.score for r in rows) == pytest.approx(wanted)
    for r in rows:
        if r.review_id in (900, 901):
            assert (r.score, r.label) == (0.5, joined[r.review_id].label)
    assert term_model.score_terms(table.limit(0), some, 1.0).count() == 0
