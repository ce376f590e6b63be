"""Quality and toxicity: learned on words that tell, checked on texts held out."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import packed, quality, toxicity
from ratewise.llm.labelled import in_fold, training_sample

WORDS = [f"{a}{b}{c}" for a in ("ta", "re", "mo", "li") for b in ("n", "st", "r") for c in ("e", "ing", "ou", "a")]
ODD = [None, "", " \n", "...", "x " * 20_000, "one", "ÉÀ ß 日本"]


def _texts(kind, rows=400):
    rng = random.Random(4)
    out = []
    for i in range(rows):
        words = rng.choices(WORDS, k=rng.randrange(20, 80))
        bad = i % 3 == 0
        if bad and kind == "quality":
            words = [w.upper() + "!!" for w in words]
        if bad and kind == "toxic":
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["grumblefool", "grumblefools", "grumblefoool"])
        out.append((i, " ".join(words), int(bad if kind == "toxic" else not bad)))
    return out


@pytest.fixture(scope="module", params=["quality", "toxic"])
def case(request, spark):
    rows = _texts(request.param)
    docs = [(i, t, "en") for i, t, _ in rows] + [(1000 + i, t, None) for i, t in enumerate(ODD)]
    docs += [(None, rows[0][1], "en"), docs[0], docs[0]]
    labels = [(i, y) for i, _, y in rows] + [(5, None), (None, 1), (7, rows[7][2]), (9, 0), (9, 1)]
    return (
        request.param,
        quality if request.param == "quality" else toxicity,
        spark.createDataFrame(docs, "doc_id long, text string, label string"),
        spark.createDataFrame(labels, f"doc_id long, {request.param} int"),
        rows,
    )


def test_held_out_accuracy_and_odd_rows(case):
    kind, module, docs, labels, rows = case
    model = module.train(docs, labels, kind, in_fold(F.col("doc_id"), 3, 1))
    found = module.scored(docs, model)
    assert found.columns == ["doc_id", "score"]
    scores = [(r["doc_id"], r["score"]) for r in found.collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for _, s in scores)
    by_id = dict(scores)
    held = [(by_id[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((s >= 0.5) == (y == 1) for s, y in held)
    assert right / len(held) > 0.97
    assert by_id[1000] == by_id[1001] == by_id[1002]  # null, empty and blank texts
    assert by_id[None] == by_id[0] and len([k for k, _ in scores if k == 0]) == 3
    again = {r["doc_id"]: r["score"] for r in module.scored(docs.repartition(3), model).collect()}
    assert again == by_id


def test_unseen_misspellings_share_subwords(spark):
    rows = _texts("toxic")
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    scorer = toxicity.Scorer(toxicity.train(docs, labels, "toxic", F.lit(False)))
    calm = " ".join(WORDS)
    assert scorer([f"{calm} grumbleefool grumblefoolx".encode()])[0] > scorer([calm.encode()])[0] + 0.3


def test_without_both_classes_every_score_is_half(case, spark):
    kind, module, docs, labels, _ = case
    for some in (labels.limit(0), labels.where(f"{kind} = 1 AND doc_id < 9")):
        model = module.train(docs, some, kind, F.lit(False))
        assert model is None
        assert {r["score"] for r in module.scored(docs, model).collect()} == {0.5}
    assert module.scored(docs.limit(0), None).count() == 0
    assert module.accepted(docs, None, 0.4 if kind == "quality" else 0.6).columns == docs.columns


def test_filters_keep_whole_rows(case):
    kind, module, docs, labels, rows = case
    model = module.train(docs, labels, kind, F.lit(False))
    kept = module.accepted(docs, model)
    assert kept.schema == docs.schema
    score = {r["doc_id"]: r["score"] for r in module.scored(docs, model).collect()}
    good = {k for k, s in score.items() if (s >= 0.5 if kind == "quality" else s < 0.7)}
    assert {r["doc_id"] for r in kept.collect()} == good


def test_sample_is_bounded_and_does_not_depend_on_layout(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    docs = labels.select("doc_id", F.lit("t").alias("text"))
    one = training_sample(docs, labels, "y", 100, in_fold(F.col("doc_id"), 3, 1))
    two = training_sample(docs.repartition(7), labels.repartition(5), "y", 100, in_fold(F.col("doc_id"), 3, 1))
    found = sorted(map(tuple, one.select("doc_id", "label").collect()))
    assert found == sorted(map(tuple, two.select("doc_id", "label").collect()))
    assert sum(y for _, y in found) == 100 and len(found) == 200
    assert not [k for k, _ in found if zlib.crc32(str(k).encode()) % 3 == 1]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_sample_has_one_row_of_each_id(spark):
    labels = spark.range(10).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("y"))
    once = labels.select("doc_id", F.concat(F.lit("t"), "doc_id").alias("text"))
    hot = spark.range(500).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("u"), F.col("id") % 7).alias("text"))
    docs = once.unionAll(hot).unionAll(spark.createDataFrame([(3, None)], "doc_id long, text string"))
    one = training_sample(docs, labels, "y", 100, F.lit(False))
    two = training_sample(docs.repartition(7), labels, "y", 100, F.lit(False))
    rows = sorted(map(tuple, one.collect()), key=str)
    assert [r[0] for r in rows] == list(range(10))
    assert rows == sorted(map(tuple, two.collect()), key=str)


def test_no_cut_but_the_ids_of_each_class(case, spark, monkeypatch):
    """A labelled id with many long rows takes no place from the ids after it."""
    kind, module, docs, labels, rows = case
    monkeypatch.setattr(module, "SAMPLE_ENTRIES", 2000, raising=False)
    some = docs.where("doc_id < 400").dropDuplicates(["doc_id"])
    hot = spark.range(300).select(F.lit(0).cast("long"), F.lit(rows[0][1]), F.lit("en"))
    model = module.train(some.unionAll(hot), labels, kind, in_fold(F.col("doc_id"), 3, 1))
    score = {r["doc_id"]: r["score"] for r in module.scored(some, model).collect()}
    held = [(score[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((s >= 0.5) == (y == 1) for s, y in held) / len(held) > 0.97


def test_tokens_by_brute_force():
    texts = ["Ab  ab!!c 12", "", "É é\t--", "x"]
    data, offsets = packed.pack([t.encode() for t in texts])
    tokens = packed.Tokens(data, offsets)
    words = [data[a:b].tobytes().decode() for a, b in zip(tokens.start, tokens.end)]
    assert words == ["Ab", "ab", "!!", "c", "12", "É", "é", "--", "x"]
    assert tokens.count.tolist() == [5, 0, 3, 1] and tokens.text.tolist() == [0] * 5 + [2] * 3 + [3]
    assert tokens.hash[0] == tokens.hash[1] and len(set(tokens.hash.tolist())) == 8
    assert packed.sums(np.arange(4.0), np.array([0, 2, 0, 2])).tolist() == [0, 1, 0, 5]
