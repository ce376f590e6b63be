import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from ratewise.operators import terms

WORDS = [f"w{i}" for i in range(40)]


def _documents(seed=5, rows=200):
    """Token lists of 0 to 30 words; every third one holds a single hot word."""
    rng = random.Random(seed)
    return [
        (i, ["hot"] * rng.randrange(30) if i % 3 == 0 else rng.choices(WORDS, k=rng.randrange(30)))
        for i in range(rows)
    ]


def _pairs(tokens):
    return [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


def _counts_by_hand(docs):
    return {
        (key, kind, term): n
        for key, tokens in docs
        for kind, found in (("unigram", tokens), ("bigram", _pairs(tokens)))
        for term, n in Counter(found).items()
    }


def _frame(spark, docs):
    return spark.createDataFrame(docs, "doc long, tokens array<string>")


def test_term_counts_by_brute_force(spark):
    docs = _documents() + [(1000, None), (1001, []), (1002, ["one"])]
    counts = terms.term_counts(_frame(spark, docs)).collect()
    found = {(r.doc, r.kind, r.term): r.tf for r in counts}
    assert len(found) == len(counts)
    assert found == _counts_by_hand([(k, t or []) for k, t in docs])


@pytest.mark.parametrize("size", [3, 10, 50_000])
def test_vocabulary_by_brute_force(spark, size):
    docs = _documents()
    cf, df = Counter(), Counter()
    for (_, kind, term), n in _counts_by_hand(docs).items():
        cf[kind, term] += n
        df[kind, term] += 1
    wanted = {}
    for kind in terms.KINDS:
        common = [term for k, term in cf if k == kind and df[k, term] >= 5]
        best = sorted(common, key=lambda term: (-cf[kind, term], term))[:size]
        wanted.update({(kind, t): (i, cf[kind, t], df[kind, t]) for i, t in enumerate(best)})
    rows = terms.vocabulary(_frame(spark, docs), vocab_size=size).collect()
    assert {(r.kind, r.term): (r.term_index, r.cf, r.df) for r in rows} == wanted


def test_ties_at_the_cut_go_to_the_first_term(spark):
    docs = [(i, ["b", "a", "c"]) for i in range(6)]
    rows = terms.vocabulary(_frame(spark, docs), ["unigram"], 2).collect()
    assert sorted(r.term for r in rows) == ["a", "b"]


def test_idf(spark):
    row = spark.range(1).select(terms.inverse_document_frequency(F.lit(399), F.lit(41))).first()
    assert abs(row[0] - 2.253794929) < 1e-9


def test_tfidf_equals_mllib(spark):
    docs = _frame(spark, _documents())
    counter = CountVectorizer(inputCol="tokens", outputCol="tf", minDF=5).fit(docs)
    counted = counter.transform(docs)
    weighed = IDF(inputCol="tf", outputCol="w").fit(counted).transform(counted)
    wanted = {
        (row.doc, counter.vocabulary[i]): v
        for row in weighed.collect()
        for i, v in zip(row.w.indices, row.w.values)
    }
    learned = terms.fit_terms(docs, ["unigram"])
    rows = terms.tfidf(terms.term_counts(docs, ["unigram"]), learned).collect()
    found = {(r.doc, r.term): r.tfidf for r in rows}
    assert found.keys() == wanted.keys()
    assert all(math.isclose(found[k], wanted[k], rel_tol=1e-12) for k in found)


def test_idf_counts_documents_without_terms(spark):
    docs = [(i, ["a", "b"]) for i in range(6)] + [(7, []), (8, None), (9, ["seldom"])]
    learned = terms.fit_terms(_frame(spark, docs))
    assert learned.columns == ["kind", "term", "term_index", "cf", "df", "idf"]
    assert {r.term for r in learned.collect()} == {"a", "b", "a b"}
    assert {round(r.idf, 12) for r in learned.collect()} == {round(math.log(10 / 7), 12)}
    assert terms.fit_terms(_frame(spark, docs[:3])).count() == 0


def test_only_vocabulary_terms_get_a_weight(spark):
    docs = _frame(spark, _documents() + [(2000, ["seldom"])])
    counts = terms.term_counts(docs, ["unigram"])
    learned = terms.fit_terms(docs, ["unigram"])
    known = {r.term for r in learned.collect()}
    assert "seldom" not in known
    assert {r.term for r in terms.tfidf(counts, learned).collect()} == known
    assert {r.term for r in terms.known_terms(counts, learned).collect()} == known


def test_vocabulary_sizes(spark):
    sizes = terms.vocabulary_size(_frame(spark, _documents()), vocab_size=7)
    assert {r.kind: r.terms for r in sizes.collect()} == {"unigram": 7, "bigram": 7}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_top_k_over_all_terms(spark):
    plan = _plan(terms.vocabulary(_frame(spark, _documents())))
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6])
def test_many_ties_at_the_cut(spark, size):
    docs = [(i, ["e", "b", "d", "b", "a", "c"]) for i in range(6)]
    rows = terms.vocabulary(_frame(spark, docs), ["unigram"], size).collect()
    assert [r.term for r in sorted(rows, key=lambda r: r.term_index)] == ["b", "a", "c", "d", "e"][:size]


def test_counting_needs_no_shuffle_and_one_tokenization(spark):
    reviews = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokens = terms.with_tokens(reviews.select("doc_id", "text"))
    counts = terms.term_counts(tokens)
    plan = _plan(counts)
    assert "Exchange" not in plan
    assert plan.count("regexp_extract_all") == 1, "the texts are tokenized more than once"
    statistics = _plan(terms.term_statistics(tokens))
    assert statistics.count("regexp_extract_all") == 1 and statistics.count("Exchange") == 1
    weighed = _plan(terms.tfidf(counts, terms.fit_terms(tokens)))
    assert "BroadcastHashJoin" in weighed and "SortMergeJoin" not in weighed
    assert "hashpartitioning" not in weighed


def test_a_vocabulary_too_large_to_broadcast_is_shuffled(spark):
    docs = _frame(spark, _documents())
    counts, learned = terms.term_counts(docs), terms.fit_terms(docs)
    small = sorted(map(tuple, terms.tfidf(counts, learned).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = terms.tfidf(counts, learned)
        assert "Broadcast" not in _plan(joined)
        assert sorted(map(tuple, joined.collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("size", [2, 10, 3000])
def test_many_tied_terms_are_narrowed_by_their_letters(spark, size):
    """10^5 terms of one frequency: few of them are ever ordered."""
    names = sorted([f"tie{i:06d}" for i in range(99_998)] + ["é", "t"])
    rows = [(names[i : i + 2000],) for i in range(0, len(names), 2000)] + [(["top", "top"],)]
    docs = spark.createDataFrame(rows, "tokens array<string>")
    found = terms.top_terms(docs, size, ["unigram"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "substring" in plan
    order = [r.term for r in found.orderBy("term_index").collect()]
    assert order == ["top", *names[: size - 1]]
    stored = spark.createDataFrame([("unigram", t, 1, 1) for t in names], "kind string, term string, cf long, df long")
    kept = stored.where(terms._first_terms(stored, size, size)).count()
    assert size <= kept <= 2 * size


def test_a_term_table_gives_the_same_weights(spark):
    docs = _frame(spark, _documents() + [(3000, None), (3001, [])])
    table = terms.term_table(docs)
    assert table.count() == docs.count() and "regexp" not in _plan(table)
    fresh = terms.tfidf(terms.term_counts(docs), terms.fit_terms(docs))
    stored = terms.tfidf(terms.term_counts(table), terms.fit_terms(table))
    assert sorted(map(tuple, stored.select(fresh.columns).collect())) == sorted(map(tuple, fresh.collect()))


@pytest.fixture
def low_threshold(spark):
    """A session that by itself would broadcast next to nothing."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("weigh", [terms.tfidf, terms.known_terms])
def test_counts_do_not_move_to_meet_a_bounded_vocabulary(spark, low_threshold, monkeypatch, weigh):
    table = terms.term_table(_frame(spark, _documents()))
    counts, learned = terms.term_counts(table), terms.fit_terms(table)
    joined = weigh(counts, learned)
    assert "BroadcastHashJoin" in _plan(joined) and "hashpartitioning" not in _plan(joined)
    size = sum(len(r.term.encode()) + 64 for r in learned.collect())
    monkeypatch.setattr(terms, "BROADCAST_BYTES", size - 1)
    shuffled = weigh(counts, learned)
    assert "Broadcast" not in _plan(shuffled)
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, joined.collect()))


def test_a_term_table_counts_only_what_occurs_more_often(spark):
    docs = [(0, ["b", "a", "b", "é", "b", "a"]), (1, ["a"]), (2, []), (3, None)]
    table = terms.term_table(_frame(spark, docs))
    held = {r.doc: r.counts for r in table.collect()}
    assert sorted(held[0].unigram.once) == ["é"]
    assert sorted(map(tuple, held[0].unigram.more)) == [("a", 2), ("b", 3)]
    assert sorted(held[0].bigram.once) == ["a b", "b é", "é b"]
    assert list(map(tuple, held[0].bigram.more)) == [("b a", 2)]
    found = sorted(map(tuple, terms.term_counts(table).select("doc", "kind", "term", "tf").collect()))
    fresh = terms.term_counts(_frame(spark, docs)).select("doc", "kind", "term", "tf")
    assert found == sorted(map(tuple, fresh.collect()))
    one = terms.term_table(_frame(spark, docs), ["bigram"])
    assert {r.kind for r in terms.term_counts(one).collect()} == {"bigram"}
    assert terms.fit_terms(table, ["bigram"], min_documents=1).count() == len({r[2] for r in found if " " in r[2]})


def test_terms_are_added_up_before_they_are_sent(spark):
    """A term that many documents of a batch hold leaves it as one row; bigrams do not run
    from one document into the next, and counts stay right where a batch is cut."""
    rows = [(["good", "food"],), (["food", "good", "food"],), (None,), ([],), (["good"],)] * 40
    docs = spark.createDataFrame(rows, "tokens array<string>").coalesce(1)
    found = {(r.kind, r.term): (r.cf, r.df) for r in terms.term_statistics(docs, min_documents=1).collect()}
    assert found == {
        ("unigram", "good"): (120, 120), ("unigram", "food"): (120, 80),
        ("bigram", "good food"): (80, 80), ("bigram", "food good"): (40, 40),
        (terms.DOCUMENT, ""): (0, 200),
    }
    plan = terms.term_statistics(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_numbered_tokens_in_runs():
    import pyarrow as pa

    from ratewise.functions.numbered import numbered_chunks

    lists = [["a", "b", "a"], [], ["b"], ["a", "b", "a", "b"], ["c"]]
    batch = pa.RecordBatch.from_pydict({"tokens": pa.array(lists, pa.list_(pa.string()))})
    for limit in (1, 3, 5, 100):
        runs = list(numbered_chunks(batch, limit))
        assert [t for some, _ in runs for t in some.column("tokens").to_pylist()] == lists
        held = []
        for some, tokens in runs:
            for pairs in (False, True):
                counted = tokens.by_document(pairs)
                held += zip(counted.terms().to_pylist(), counted.tf.tolist())
        assert sorted(held) == sorted(
            [("a", 2), ("b", 1), ("a b", 1), ("b a", 1), ("b", 1), ("a", 2), ("b", 2), ("a b", 2), ("b a", 1), ("c", 1)]
        )
